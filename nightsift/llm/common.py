"""Helpers that the training-data operators share."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but these six white-space characters.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; read by Spark alone, so any path that Hadoop knows works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir.

    Only where the session names none and Spark is local (tests) a temporary folder of this machine is set for it; on a
    cluster, whose executors would not see such a folder, that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/nightsift/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it again.

    This cuts the lineage, survives lost executors, and fixes values that depend on how a run was cut into tasks.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the column as text, modulo n; null counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is evaluated once, however often f names it."""
    return F.get(F.transform(F.array(value), f), 0)


def whole_row(docs: DataFrame, keep: bool) -> Column:
    """All columns of a row in one struct, where they clash with no name; a stub if they are not to be kept."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)) if keep else F.struct(F.lit(0).alias("_"))


def bits_of(numbers: DataFrame, column: str) -> DataFrame:
    """A set of non-negative whole numbers as bitmaps of 4096 bytes: bucket, bits; one row for each 32768 numbers that has some."""
    x = F.col(column) + 1  # Spark's buckets begin at 1
    return numbers.groupBy(F.bitmap_bucket_number(x).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(x)).alias("bits"))


def in_bits(number: Column) -> Column:
    """Condition of a join with such bitmaps: whether the number is in the set."""
    at = F.bitmap_bit_position(number + 1)
    byte = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (F.bitmap_bucket_number(number + 1) == F.col("bucket")) & (F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1)


def text_bytes(column: pa.Array) -> np.ndarray:
    """Bytes of text in each value of a column, those of a struct's fields included."""
    if pa.types.is_struct(column.type):
        return sum((text_bytes(c) for c in column.flatten()), np.zeros(len(column), np.int64))
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.zeros(len(column), np.int64)


def give_back() -> None:
    """Memory that earlier tasks of this worker are done with goes back to the system (workers live from stage to stage)."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # glibc alone has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most so many rows and bytes of text (a longer text alone), so that Python objects and
    features are made for few texts at a time."""
    give_back()
    for batch in batches:
        ends = np.cumsum(sum((text_bytes(c) for c in batch.columns), np.zeros(batch.num_rows, np.int64)))
        at = 0
        while at < batch.num_rows:
            fit = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most_bytes, "right"))
            end = min(max(fit, at + 1), at + rows, batch.num_rows)
            yield batch.slice(at, end - at)
            at = end
    give_back()


def texts_of(batch: pa.RecordBatch, text: str, row: str, field: str | None) -> list[bytes]:
    """The batch's texts as bytes (null: empty): of the column `text`, or of that field of whole rows, where each text is there once."""
    column = batch.column(text) if field is None else pc.struct_field(batch.column(row), field).cast(pa.binary())
    return [x or b"" for x in column.to_pylist()]


def text_unless(docs: DataFrame, text_col: str, keep: bool) -> Column:
    """The text for a function in Arrow, null where whole rows go with it (see texts_of)."""
    return (F.lit(None) if keep else F.col(text_col)).cast("binary")
