"""Uploads and plot requests: names, sizes and contents of archives, addresses, admission."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

#: Fixed values.
MIN_BYTES, MAX_BYTES = 2 * 1024 * 1024, 2 * 1024 * 1024 * 1024
IMAGE_NAME = r"(?i)\.(fits|fit|fts)$"
SAFE_NAME = r"(?U)^[\w.-]+$"


def unsafe_name(entry: Column) -> Column:
    """Of the base name alone: empty, with .. or a leading dot, or with anything but word characters, dash and dot."""
    name = F.substring_index(entry, "/", -1)
    return ~name.rlike(SAFE_NAME) | F.contains(name, F.lit("..")) | name.startswith(".")


def size_ok(size: Column, lo: int = MIN_BYTES, hi: int = MAX_BYTES) -> Column:
    """C17: both ends count as good."""
    return size.between(lo, hi)


def type_ok(ext: Column, content: Column) -> Column:
    """The ending agrees with the first bytes."""
    magic = F.hex(F.substring(content, 1, 4))
    return ((F.lower(ext) == ".zip") & magic.isin("504B0304", "504B0506", "504B0708")) | ((F.lower(ext) == ".rar") & (magic == "52617221"))


def archive_verdict(entries: DataFrame, min_images: int = 2) -> DataFrame:
    """Ok and message of each archive: its first bad entry (name before ending), else too few images."""
    name = F.substring_index("entry", "/", -1)
    bad = F.when(unsafe_name(F.col("entry")), F.concat(F.lit("unsafe name: "), name)).when(~name.rlike(IMAGE_NAME), F.concat(F.lit("not an image: "), name))
    rows = entries.where(~F.col("entry").endswith("/")).select("archive_id", "pos", bad.alias("bad"), name.rlike(IMAGE_NAME).alias("image"))
    out = rows.groupBy("archive_id").agg(F.min_by("bad", F.when(F.col("bad").isNotNull(), F.col("pos"))).alias("bad"), F.count_if("image").alias("images"))
    return out.withColumn("message", F.coalesce("bad", F.when(F.col("images") < min_images, F.lit("too few images")))).withColumn("ok", F.col("message").isNull()).drop("bad")


def rejection_reasons(archives: DataFrame) -> DataFrame:
    """The first reason in the order of checks: name, type, size, contents."""
    return archives.withColumn("reason", F.coalesce(F.when(F.col("bad_name"), F.lit("name")), F.when(~F.col("type_ok"), F.lit("type")), F.when(~F.col("size_ok"), F.lit("size")), F.when(~F.col("contents_ok"), F.lit("contents"))))


def plan_dataset(images: DataFrame) -> DataFrame:
    """For each file (dataset, name) its new name and whether it goes; and the dataset's ending: the first of fts, fits, fit it has."""
    new = F.regexp_replace(F.replace("name", F.lit("-SF"), F.lit("")), "2021_", "2021-")
    rank = F.when(F.col("name").endswith(".fts"), 1).when(F.col("name").endswith(".fits"), 2).when(F.col("name").endswith(".fit"), 3)
    ext = images.groupBy("dataset").agg(F.min(rank).alias("r"))
    ext = ext.select("dataset", F.when(F.col("r") == 2, "fits").when(F.col("r") == 3, "fit").otherwise("fts").alias("dataset_ext"))
    out = images.withColumn("new_name", new).withColumn("action", F.when(F.col("name").startswith("fd_"), "drop").when(F.col("name") != F.col("new_name"), "rename").otherwise("keep"))
    return out.join(ext, "dataset")


def normalize_requests(df: DataFrame, base_url: str) -> DataFrame:
    """C20: safe_url, candidate_id, reject_reason."""
    page, ident = F.substring_index("url", "#", 1), F.when(F.contains("url", F.lit("#")), F.substring_index("url", "#", -1))
    path = F.when(F.contains(page, F.lit("/uploads/")), F.substring_index(page, "/uploads/", -1))
    path = F.when(path.endswith("/"), F.concat(path, F.lit("index.html"))).when(path.endswith(".html"), path).otherwise(F.concat(path, F.lit("/index.html")))
    reason = (
        F.when(ident.isNull() | (ident == ""), "no candidate id")
        .when(F.length(ident) > 256, "id too long")
        .when(~ident.rlike(r"^[A-Za-z0-9_.+-]+$"), "bad id")
        .when(path.isNull(), "not under uploads")
        .when(F.contains(page, F.lit("..")), "parent directory")
        .when(~path.rlike(r"^[A-Za-z0-9_.+/-]+$"), "bad path")
    )
    return df.withColumn("reject_reason", reason).withColumn("candidate_id", F.when(F.col("reject_reason").isNull(), ident)).withColumn("safe_url", F.when(F.col("reject_reason").isNull(), F.concat(F.lit(base_url.rstrip("/") + "/uploads/"), path, F.lit("#"), ident)))


def normalize_targets(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Canonical coordinates of two colon tokens, six numbers, or two decimals; else the reason."""
    t = F.trim(F.regexp_replace(F.regexp_replace(text_col, ",", " "), r"\s+", " "))
    p = F.split(t, " ")
    numeric = F.forall(p, lambda x: x.rlike(r"^[+-]?[0-9]+(\.[0-9]*)?$"))
    sexagesimal = F.forall(p, lambda x: x.rlike(r"^[+-]?[0-9]{1,3}:[0-9]{1,2}:[0-9]{1,2}(\.[0-9]*)?$"))
    reason = F.when(t == "", "empty").when(~t.rlike(r"^[0-9:+. -]+$"), "bad character").when((F.size(p) == 2) & (sexagesimal | numeric), F.lit(None)).when((F.size(p) == 6) & numeric, F.lit(None)).otherwise("not a position")
    coords = F.when(F.size(p) == 6, F.concat(F.array_join(F.slice(p, 1, 3), ":"), F.lit(" "), F.array_join(F.slice(p, 4, 3), ":"))).otherwise(t)
    return df.withColumn("reason", reason).withColumn("coords", F.when(reason.isNull(), coords))


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def rolling_count(df: DataFrame, key: str, ts: str, seconds: int = 3600, windows_a_slice: int = 4) -> DataFrame:
    """Events of the key in the trailing seconds, this one and others at its time included.

    Time is cut into slices of some windows. A slice is counted with a halo: the rows of one window before it, which go to
    it as well and are dropped after counting. So no task needs a whole key, and a row is held twice at most. Rows without a
    time are counted with each other, per key.
    """
    span = seconds * 1_000_000
    length = windows_a_slice * span
    own = F.floor(F.col("_t") / length)
    next_one = F.when(F.col("_t") >= (own + 1) * length - span, F.struct((own + 1).alias("slice"), F.lit(True).alias("halo")))
    places = F.filter(F.array(F.struct(own.alias("slice"), F.lit(False).alias("halo")), next_one), lambda x: x.isNotNull())
    rows = df.withColumn("_t", _micros(ts)).withColumn("_at", F.explode(places))
    trailing = Window.partitionBy(key, "_at.slice").orderBy("_t").rangeBetween(-span, 0)
    return rows.withColumn("in_window", F.count("*").over(trailing)).where(~F.col("_at.halo")).drop("_t", "_at")


def stretches(df: DataFrame, key: str, t: str, span: int) -> DataFrame:
    """key, _slice, _stretch: time is cut into slices of `span` microseconds, and a key's slices into stretches without a gap of `span`.

    A gap so long always reaches over the end of a slice, so the first and last times of slices show all of them; only these
    are ranked, not rows.
    """
    slices = df.groupBy(key, F.floor(F.col(t) / span).alias("_slice")).agg(F.min(t).alias("lo"), F.max(t).alias("hi"))
    by_time = Window.partitionBy(key).orderBy("_slice")
    gap = F.coalesce(F.col("lo") - F.lag("hi").over(by_time) >= span, F.lit(True))
    begun = slices.withColumn("_gap", gap.cast("int"))
    return begun.select(key, "_slice", F.sum("_gap").over(by_time.rowsBetween(Window.unboundedPreceding, 0)).alias("_stretch"))


def admit(df: DataFrame, key: str, ts: str, order: str, limit: int = 5, seconds: int = 3600) -> DataFrame:
    """Greedy admission: accepted if fewer than `limit` of the key's requests were accepted in the seconds before.

    A refused request does not count, so each decision needs those before it, but none from before a gap of the whole time:
    a key is cut at its gaps, and the stretches between them are decided in tasks of their own (a stretch without a gap
    stays in one). Rows are sorted within partitions by key, stretch, time and order, and decided as they stream by; only the
    times of at most `limit` accepted requests are held. Requests without a time are accepted and do not count.
    """
    span = seconds * 1_000_000
    names = [order, *(c for c in df.columns if c != order)]
    rows = df.select(*names, _micros(ts).alias("_t"))
    timed = rows.where("_t is not null").withColumn("_slice", F.floor(F.col("_t") / span))
    marks = stretches(timed, key, "_t", span).withColumnRenamed(key, "_key")
    timed = timed.join(marks.withColumnRenamed("_slice", "_s"), F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_s")))
    timed = timed.select(*names, "_t", "_stretch")
    key_at, type_of = names.index(key), {f.name: f for f in df.schema}
    schema = StructType([*(type_of[n] for n in names), StructField("accepted", BooleanType())])

    def decide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = object(), deque()
        for b in batches:
            out = []
            for k, t, s in zip(*(b.column(i).to_pylist() for i in (key_at, len(names), len(names) + 1)), strict=True):
                if (k, s) != last:
                    last = (k, s)
                    held.clear()
                while held and held[0] <= t - span:
                    held.popleft()
                out.append(len(held) < limit)
                if out[-1]:
                    held.append(t)
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(out, pa.bool_())], [*names, "accepted"])

    decided = timed.repartition(key, "_stretch").sortWithinPartitions(key, "_stretch", "_t", order).mapInArrow(decide, schema)
    return decided.union(rows.where("_t is null").select(*names, F.lit(limit > 0).alias("accepted")))


def cached_archive(requests: DataFrame, inventory: DataFrame) -> DataFrame:
    """A finished archive of the candidate, .tar.gz before .tar.bz2."""
    pattern = r"(?:^|/)fastplot__.*__([^/]+?)\.tar\.(gz|bz2)$"
    files = inventory.select("file", F.regexp_extract("file", pattern, 1).alias("candidate_id"), F.when(F.regexp_extract("file", pattern, 2) == "gz", 1).otherwise(2).alias("p")).where("candidate_id <> ''")
    best = files.groupBy("candidate_id").agg(F.min(F.struct("p", "file")).alias("b")).select("candidate_id", F.col("b.file").alias("archive"))
    return requests.join(best, "candidate_id", "left")
