"""Sources: field and combined reports, candidate documents, file inventories, archives, run logs, comet tables."""

from __future__ import annotations

import fnmatch
import io
import zipfile
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from nightsift.operators import comets, coverage, lightcurve, reports
from nightsift.schema import CANDIDATE_DOCUMENT
from nightsift.sources.revisions import opened
from nightsift.sources.sinks import SCHEMA_VERSION


def _whole_files(spark: SparkSession, root: str, *levels: str) -> DataFrame:
    """path, mtime, size_bytes, text of the files root/level/..., each level a name or a pattern; empty and hidden files are left out.

    A task lists the first level; its names are dealt out, and tasks list the levels below and read the files. So neither the
    driver's memory nor the number of tasks grows with the number of files, as they do where Spark lists them.
    """

    def found(at: str, level: str, directory: bool):  # noqa: ANN202
        from pyarrow import fs

        store, path = opened(at)
        kind = fs.FileType.Directory if directory else fs.FileType.File
        plain = not any(x in level for x in "*?[")
        infos = [store.get_file_info(f"{path}/{level}")] if plain else store.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return ((f"{at}/{x.base_name}", x) for x in infos if x.type == kind and x.base_name[:1] not in "._" and (plain or fnmatch.fnmatchcase(x.base_name, level)))

    def top(_: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _b in _:
            if len(_b):
                names = [p for p, _i in found(root, levels[0], len(levels) > 1)]
                for i in range(0, len(names), 10_000):
                    yield pd.DataFrame({"at": names[i : i + 10_000]})

    def files(at: str, below: tuple[str, ...]) -> Iterator[tuple]:
        if below:
            for path, info in found(at, below[0], len(below) > 1):
                yield from files(path, below[1:]) if len(below) > 1 else [(path, info)]
        else:
            store, path = opened(at)
            yield at, store.get_file_info(path)

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns, held, n = ["path", "ms", "size_bytes", "body"], [], 0
        for b in batches:
            for at in b["at"]:
                for uri, info in files(at, levels[1:]):
                    if info.size:
                        store, path = opened(uri)
                        with store.open_input_stream(path) as f:
                            held.append((uri, info.mtime_ns // 1_000_000, info.size, f.read()))
                        n += info.size
                        if n > 4 << 20:
                            yield pd.DataFrame(held, columns=columns)
                            held, n = [], 0
        if held:
            yield pd.DataFrame(held, columns=columns)

    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = spark.range(0, 1, 1, 1).mapInPandas(top, "at string").repartition(tasks, "at").mapInPandas(read, "path string, ms long, size_bytes long, body binary")
    return rows.select("path", F.timestamp_millis("ms").alias("mtime"), "size_bytes", F.col("body").cast("string").alias("text"))


def _in_tasks(spark: SparkSession, root: str) -> bool:
    """Whether tasks can list and read a folder themselves."""
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getScheme() in IN_PARTS and not any(x in root for x in "*?[{") and files.exists(where) and files.getFileStatus(where).isDirectory()


def read_field_reports(spark: SparkSession, root: str, glob: str = "results*/index.html") -> DataFrame:
    """report_id (the directory), mtime, size_bytes, text (line ends made \\n)."""
    if _in_tasks(spark, root) and "{" not in glob:
        df = _whole_files(spark, root.rstrip("/"), *glob.split("/"))
        return df.select(F.element_at(F.split("path", "/"), -2).alias("report_id"), "mtime", "size_bytes", F.regexp_replace("text", "\r\n?", "\n").alias("text"))
    df = spark.read.text(f"{root}/{glob}", wholetext=True)
    return df.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("report_id"), F.col("_metadata.file_modification_time").alias("mtime"), F.col("_metadata.file_size").alias("size_bytes"), F.regexp_replace("value", "\r\n?", "\n").alias("text"))


def read_combined_reports(spark: SparkSession, path: str) -> DataFrame:
    """report_id (the file name), date_utc, session, camera, text."""
    if _in_tasks(spark, path):
        df = _whole_files(spark, path.rstrip("/"), "*").select(F.element_at(F.split("path", "/"), -1).alias("report_id"), F.regexp_replace("text", "\r\n?", "\n").alias("text"))
    else:
        df = spark.read.text(path, wholetext=True)
        df = df.select(F.col("_metadata.file_name").alias("report_id"), F.regexp_replace("value", "\r\n?", "\n").alias("text"))
    return reports.parse_session_name(df, "report_id")


def read_candidate_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """S3: candidate documents of either schema version; empty and error documents have null parts. What is no such document is left out."""
    return split_candidate_json(spark, path, lines)[0]


def split_candidate_json(spark: SparkSession, path: str, lines: bool = False, newest: int = SCHEMA_VERSION) -> tuple[DataFrame, DataFrame]:
    """S3: the documents, and those set aside: path, reason, document (its text).

    A document is a file, or a line of one (`lines`: what K1 writes). Set aside are texts that are no JSON object, that have
    a field of another type than the schema's, without a version or candidates, or of a version after `newest`; columns
    that the schema does not know are no fault. Nothing else of a file or table is lost by them.
    """
    text = spark.read.text(path, wholetext=not lines).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("document"))
    fields = StructType.fromDDL(CANDIDATE_DOCUMENT).fields
    schema = StructType([*fields, StructField("_broken", StringType())])
    rows = text.where(F.trim("document", F.lit(" \t\r\n")) != "").withColumn("d", F.from_json("document", schema, {"columnNameOfCorruptRecord": "_broken", "mode": "PERMISSIVE"}))
    reason = (
        F.when(F.col("d").isNull() | F.col("d._broken").isNotNull(), "not readable")
        .when(F.col("d.schema_version").isNull(), "no version")
        .when(F.col("d.schema_version") > newest, "newer version")
        .when(F.col("d.candidates").isNull(), "no candidates")
    )
    rows = rows.withColumn("reason", reason)
    return rows.where("reason is null").select(*(F.col(f"d.{f.name}") for f in fields)), rows.where("reason is not null").select("path", "reason", "document")


def _files(spark: SparkSession, path: str, recursive: bool) -> DataFrame:
    df = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
    return df.select("path", "length", F.col("modificationTime").alias("mtime"))  # contents are not read


def read_image_inventory(spark: SparkSession, uploads: str) -> DataFrame:
    """S4."""
    return lightcurve.image_inventory(_files(spark, uploads, True))


def read_reference_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Top level alone, by path."""
    return coverage.reference_inventory(_files(spark, path, False)).orderBy("path")


def read_run_log(spark: SparkSession, path: str, banner: str = "####") -> DataFrame:
    """An entry per run; entries end with a banner line."""
    df = spark.read.option("lineSep", banner).text(path).where(F.col("value").rlike("min  -- Total"))
    return reports.parse_run_log(df.withColumnRenamed("value", "entry"))


def read_comet_table(spark: SparkSession, path: str) -> DataFrame:
    """S11."""
    return comets.parse_comet_table(spark.read.text(path))


#: File systems whose files the tasks can read in part; archives elsewhere are read whole (2 GB at most, Spark's limit).
IN_PARTS = ("file", "hdfs", "s3", "gs", "abfs", "abfss")


def _directory(file: BinaryIO) -> list[str]:
    """Names in a ZIP's directory, which is found from the end of the file (ZIP64 included); entries are not read."""
    with zipfile.ZipFile(file) as z:
        return z.namelist()


def _entries(archive: str, size: int, magic: bytes, names: list[str] | None) -> pd.DataFrame:
    known = names or [None]
    return pd.DataFrame({"archive": archive, "size_bytes": size, "ext": "." + archive.rpartition(".")[2].lower(), "magic": magic, "pos": [None if x is None else i for i, x in enumerate(known)], "entry": known}).astype({"pos": "Int64"})


def read_archive_entries(spark: SparkSession, path: str, glob: str = "*.{zip,rar}") -> DataFrame:
    """Archive, size_bytes, ext, magic, pos, entry; pos and entry are null for what is no readable ZIP, and for an empty one.

    Of a ZIP only its end and its directory are read, by ranges, so archives of any size are listed in little memory; a task
    opens its archives one after another. Rows are dealt out by path, so that many small listings do not share a task.
    """

    def ranged(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for p, n in zip(b["path"], b["length"], strict=True):
                store, name = opened(p)
                with store.open_input_file(name) as f:
                    magic = f.read(4)
                    try:
                        names = _directory(f)
                    except (zipfile.BadZipFile, NotImplementedError, ValueError):  # a place before the file's beginning is a ValueError here
                        names = None
                yield _entries(p, n, magic, names)

    def whole(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for p, n, content in zip(b["path"], b["length"], b["content"], strict=True):
                try:
                    names = _directory(io.BytesIO(content))
                except (zipfile.BadZipFile, NotImplementedError, UnicodeDecodeError):
                    names = None
                yield _entries(p, n, bytes(content[:4]), names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    schema = "archive string, size_bytes long, ext string, magic binary, pos long, entry string"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() not in IN_PARTS:
        return files.select("path", "length", "content").mapInPandas(whole, schema)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path", "length").repartition(partitions, "path").mapInPandas(ranged, schema)  # contents are not read
