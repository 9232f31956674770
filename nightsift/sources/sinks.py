"""Sinks: candidate documents, tables, text files and the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA_VERSION = 2
PARTS = ("id", "field", "classification", "mean", "second_epoch_separation", "cutouts", "discovery_images", "crossmatches", "forced_photometry", "external_links", "report_stubs", "parse_warnings")


def candidate_documents(cands: DataFrame, reports: DataFrame | None, generated_at: str, base_url: str = "") -> DataFrame:
    """K1: one document per report: envelope, totals, and candidates in their order (those without an id only counted).

    reports (report_id, and session columns if it has them) adds documents of reports without candidates. A report one of
    whose candidates has no pre block is an error document: no totals, error set. A report's candidates are gated to about
    a hundred before they come here, so a document's array stays small. parse_warnings of a document are what concerns no
    single one of its candidates.
    """
    have = [x for x in PARTS if x in cands.columns]
    kind = lambda k: F.count_if(F.col("classification") == k).alias(k)
    broken = F.bool_or(F.col("pre").isNull()) if "pre" in cands.columns else F.lit(False)
    by_pos = lambda a, b: F.when(a["pos"] < b["pos"], -1).when(a["pos"] > b["pos"], 1).otherwise(0)
    rows = F.array_sort(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("pos", F.struct(*have).alias("c")))), by_pos)
    docs = cands.groupBy("report_id").agg(F.count("*").alias("total"), kind("new"), kind("known_asteroid"), kind("known_variable"), kind("known_transient"), rows.alias("rows"), broken.alias("broken"), F.count_if(F.col("id").isNull()).alias("without_id"))
    if reports is not None:
        docs = reports.join(docs, "report_id", "left")
    zero = lambda x: F.coalesce(F.col(x), F.lit(0).cast("long")).alias(x)
    bad = F.coalesce("broken", F.lit(False))
    array = F.transform("rows", lambda r: r["c"])
    session = F.struct(*(F.col(x) if x in docs.columns else F.lit(None).cast("string").alias(x) for x in ("date_utc", "session", "camera")))
    return docs.select(
        F.lit(SCHEMA_VERSION).cast("long").alias("schema_version"),
        F.lit(generated_at).alias("generated_at_utc"),
        F.col("report_id").alias("source_report"),
        F.lit(base_url).alias("url_of_data_processing_root"),
        session.alias("session"),
        F.when(~bad, F.struct(*map(zero, ("total", "new", "known_asteroid", "known_variable", "known_transient")))).alias("totals"),
        F.when(bad, F.slice(array, 1, 0)).otherwise(F.coalesce(array, F.array())).alias("candidates"),
        F.filter(F.array(F.when(F.col("without_id") > 0, F.concat(F.lit("candidates: without an id, only counted: "), F.col("without_id").cast("string")))), lambda x: x.isNotNull()).alias("parse_warnings"),
        F.when(bad, F.lit("a candidate has no pre block")).alias("error"),
    )


def write_candidate_documents(cands: DataFrame, reports: DataFrame | None, path: str, generated_at: str, base_url: str = "") -> None:
    candidate_documents(cands, reports, generated_at, base_url).write.mode("append").json(path)


def write_summary(runs: DataFrame, path: str) -> None:
    """K2: partitioned by night and session."""
    runs.write.mode("append").partitionBy("session_date", "session").parquet(path)


def write_comets(lines: DataFrame, path: str) -> None:
    """K3: text lines by name; a range sort, so files in order hold the whole table in order."""
    lines.orderBy("name", "line").select("line").write.mode("overwrite").text(path)


def write_lightcurve(points: DataFrame, limits: DataFrame, path: str) -> None:
    """K4: the two text files of a light curve."""
    points.select("line").write.mode("overwrite").text(f"{path}/points")
    limits.select("line").write.mode("overwrite").text(f"{path}/limits")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any file system that Hadoop knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def finished(spark: SparkSession, path: str) -> list[str]:
    """The folders under path that a writer has finished (they have its _SUCCESS mark), in order of name."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    found = (str(x.getPath().toString()) for x in fs.listStatus(p) if x.isDirectory())
    return sorted(x for x in found if exists(spark, f"{x}/_SUCCESS"))


def append_ledger(reports: DataFrame, path: str, batch: str) -> None:
    """K6: the batch's report ids (and mtime, if there), in a folder of the batch's own, written once.

    `batch` names what a repeat of it would write again, and nothing else (for a stream: its id and the epoch). A batch whose
    folder is finished is left as it is, one that failed half-way is replaced; readers see finished folders alone, so a
    repeat neither loses nor doubles ids.
    """
    folder = f"{path}/batch={batch}"
    if not exists(reports.sparkSession, f"{folder}/_SUCCESS"):
        reports.select(*(x for x in ("report_id", "mtime") if x in reports.columns)).dropDuplicates(["report_id"]).write.mode("overwrite").parquet(folder)


def read_ledger(spark: SparkSession, path: str, but: str | None = None, schema: str = "report_id string, mtime timestamp") -> DataFrame:
    """The ids of all finished batches, but for one that is being repeated; an empty table if there are none."""
    folders = [x for x in finished(spark, path) if not x.endswith(f"/batch={but}")]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def combine_once(reports: DataFrame, path: str, ledger: str, batch: str) -> None:
    """Reports that no other batch has combined go to path, then their ids to the ledger.

    Both are folders of the batch: one that fails between them and runs again writes the same rows to the same place, and
    one that is finished does nothing.
    """
    if exists(reports.sparkSession, f"{ledger}/batch={batch}/_SUCCESS"):
        return
    new = reports.join(read_ledger(reports.sparkSession, ledger, but=batch).select("report_id"), "report_id", "left_anti").dropDuplicates(["report_id"])
    new.write.mode("overwrite").parquet(f"{path}/batch={batch}")
    append_ledger(reports.sparkSession.read.parquet(f"{path}/batch={batch}"), ledger, batch)


def write_skips(skips: DataFrame, path: str) -> None:
    """K8."""
    skips.write.mode("append").json(path)
