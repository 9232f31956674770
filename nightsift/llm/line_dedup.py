"""Line dedup over levelled sorted runs of line hashes (operator 13, native).

Documents come in batches, those of the largest ids first. A batch's line hashes, one row for each hash with the number
of its documents, are merge-anti-joined with the runs written so far: what no run holds is first seen here, and the batch's
largest document keeps it. Then the batch becomes a run of its own. Runs are tables bucketed and sorted by the hash, so
neither the anti-joins nor the merging of runs shuffles them. Where a level has `fanout` runs they are compacted to one of
the next level. In the end one run holds, for each hash, its number of documents and the one that keeps it.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, once, scratch
from .linear import sample_of

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def key_of(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased (other letters stay)."""
    x = F.trim(line, F.lit(BLANKS))
    plain = F.octet_length(x) == F.length(x)  # then lower() changes A-Z alone, and is faster
    return F.when(plain, F.lower(x)).otherwise(F.translate(x, UPPER, LOWER))


def hash_of(key: Column) -> Column:
    return F.unhex(F.md5(key.cast("binary")))


def keys_of(text: Column, least_chars: int) -> Column:
    """The distinct keys of at least so many code points of a text's lines."""
    return F.array_distinct(F.filter(F.transform(F.split(text, "\n", -1), key_of), lambda k: F.length(k) >= least_chars))


class LineRuns:
    """Levelled runs of (k, n, keeper): a line's hash, in how many documents, and the id that keeps it in the run of its first batch."""

    def __init__(self, spark: SparkSession, fanout: int = 2, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def write(self, rows: DataFrame) -> DataFrame:
        """A sorted run in the shared folder; rows that are partitioned by k already are not shuffled again."""
        name = f"line_run_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, "k").sortBy("k").option("path", scratch(self.spark, "line-run")).saveAsTable(name)
        return self.spark.table(name)

    def add(self, batch: DataFrame) -> DataFrame:
        """Adds a batch (k, n, id: a row for each hash) and returns its run; keeper is null where an earlier batch holds the hash."""
        fresh = reduce(lambda left, run: left.join(run, "k", "left_anti"), self.runs(), batch)
        if self.levels:
            batch = batch.join(fresh.select("k", F.col("id").alias("keeper"), F.lit(True).alias("new")), "k", "left")
        else:
            batch = batch.withColumns({"keeper": F.col("id"), "new": F.lit(True)})
        run = self.write(batch.select("k", "n", "keeper", F.coalesce("new", F.lit(False)).alias("new")))
        self.push(run, 0)
        return run

    def push(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self.push(self.write(merged(runs)), level + 1)


def merged(runs: list[DataFrame]) -> DataFrame:
    """Runs merged by hash: numbers add up, and at most one of them has the keeper."""

    def two(a: DataFrame, b: DataFrame) -> DataFrame:
        a, b = a.alias("a"), b.alias("b")
        n = F.coalesce("a.n", F.lit(0)) + F.coalesce("b.n", F.lit(0))
        keeper = F.when(F.coalesce("a.new", F.lit(False)), F.col("a.keeper")).otherwise(F.col("b.keeper"))
        new = F.coalesce("a.new", F.lit(False)) | F.coalesce("b.new", F.lit(False))
        return a.join(b, "k", "full").select("k", n.cast("long").alias("n"), keeper.alias("keeper"), new.alias("new"))

    return reduce(two, runs)


def batches_of(rows: DataFrame, batches: int, sample: int = 2000) -> list[Column]:
    """Conditions on id that cut rows into batches of like size, the largest ids first; null ids come last.

    Only balance depends on the bounded sample of ids.
    """
    known = rows.where(F.col("id").isNotNull())
    ids = sorted(r[0] for r in sample_of(known.select("id"), "id", sample).collect())
    cuts = sorted({ids[len(ids) * i // batches] for i in range(1, batches)}) if ids else []
    edges = [None, *cuts, None]
    out = []
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        c = F.lit(True)
        if hi is not None:
            c = c & (F.col("id") < F.lit(hi))
        c = c & (F.col("id") >= F.lit(lo)) if lo is not None else c | F.col("id").isNull()
        out.insert(0, c)
    return out


def marked_lines(text: Column, dropped: Column) -> Column:
    """The text's lines as an array of (line, drop); dropped: sorted hashes, searched by halving. Short lines never match, as their keys are in no run."""
    size = F.size(dropped)
    steps = F.transform(F.sequence(F.lit(0), F.lit(30)), lambda i: F.call_function("shiftright", F.lit(1 << 30), i))
    steps = F.filter(steps, lambda s: s <= size)

    def holds(h: Column) -> Column:
        n = F.aggregate(steps, F.lit(0), lambda at, s: F.when((at + s <= size) & (F.get(dropped, at + s - 1) <= h), at + s).otherwise(at))
        return F.coalesce(F.get(dropped, n - 1) == h, F.lit(False))

    return F.transform(F.split(text, "\n", -1), lambda x: F.struct(x.alias("line"), once(hash_of(key_of(x)), holds).alias("drop")))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 20, least_docs: int = 3, batches: int = 4, fanout: int = 2) -> DataFrame:
    """Per row: the id, n_lines (before), n_dropped, kept (the text that stays).

    A line's key is the line without white space at its ends, A-Z lower-cased. Keys of at least `least_chars` code points in
    at least `least_docs` documents lose all their lines but those in the document of the largest id that holds them. Each
    row counts as a document; rows that share the largest id all keep the line. Null texts are one empty line, as empty ones
    are; null ids are the smallest, and rows with them share one id. An empty table gives an empty one; other columns are
    not used. Ids are of any type that has an order.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    each = rows.select("id", F.xxhash64("t").alias("at"), F.explode(keys_of(F.col("t"), least_chars)).alias("key")).select("id", "at", hash_of(F.col("key")).alias("k"))

    store = LineRuns(spark, fanout)
    for part in batches_of(rows, batches):
        store.add(each.where(part).groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("id")))  # combined before its shuffle
    whole = materialize(merged(store.runs()), "line-runs")

    # A hash with at least a 10,000th of all (document, hash) pairs: at most 10,000 are so, whatever the corpus. They are
    # broadcast; the others are too rare to fill a task.
    pairs = whole.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * 10_000 >= pairs
    hot = F.broadcast(whole.where(often).select("k", "n", "keeper"))
    known = each.join(hot, "k", "left")
    gone = lambda df: df.where((F.col("n") >= least_docs) & ~F.col("id").eqNullSafe(F.col("keeper"))).select("id", "at", "k")
    rare = known.where(F.col("n").isNull()).select("id", "at", "k").join(whole.where(~often & (F.col("n") >= least_docs)), "k")
    dropped = gone(known).union(gone(rare)).groupBy("id", "at").agg(F.array_sort(F.collect_set("k")).alias("dropped"))

    left, right = rows.withColumn("at", F.xxhash64("t")).alias("l"), dropped.alias("r")
    out = left.join(right, F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.at") == F.col("r.at")), "left").select("l.id", "t", "dropped")
    out = out.withColumn("lines", F.when(F.col("dropped").isNotNull(), marked_lines(F.col("t"), F.col("dropped"))))
    kept = F.array_join(F.transform(F.filter("lines", lambda x: ~x["drop"]), lambda x: x["line"]), "\n")
    n_lines = F.when(F.col("lines").isNotNull(), F.size("lines")).otherwise(F.length("t") - F.length(F.replace("t", F.lit("\n"), F.lit(""))) + 1)
    n_dropped = F.when(F.col("lines").isNotNull(), F.size(F.filter("lines", lambda x: x["drop"]))).otherwise(0)
    return out.select(F.col("id").alias(id_col), n_lines.cast("long").alias("n_lines"), n_dropped.cast("long").alias("n_dropped"), F.coalesce(kept, "t").alias("kept"))
