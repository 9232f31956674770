"""Mixing sources to target weights by weighted sampling without replacement (operator 2, native).

Every document draws an exponential key, scaled by its quality weight (Efraimidis-Spirakis): smaller keys come first, so
better documents come earlier. A source whose target is k times its size and a fraction is taken whole k times; then its
documents are taken in the order of their keys until the fraction is reached, the last of them in part (its first words).

Only the place where each source's fraction ends has to be found: keys fall into ranges ("buckets"), whose sums (at most
`buckets` rows a source) are prefix-summed by source, and documents are ordered only in the one bucket that the end falls in.
That place, one row per source, then decides for each document where it stands: texts do not move, and no source meets in
one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, materialize, whole_row, word_count

#: Characters whose share lowers a document's quality weight.
SYMBOLS = "#*$%&|<>"


def uniform(id_col: str) -> Column:
    """A number in (0, 1) from the id alone, the same in every run: 52 bits of its MD5."""
    digits = F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def quality_weight(text: Column, size: Column) -> Column:
    """(words + 1) / (words + 1 + symbols), in (0, 1]."""
    symbols = F.coalesce(F.length(text) - F.length(F.translate(text, SYMBOLS, "")), F.lit(0))
    return (size + 1.0) / (size + 1.0 + symbols)


def source_key(source_col: str) -> Column:
    """A key that is never null and sorts as sources do: by code point, null last."""
    return F.when(F.col(source_col).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source_col).cast("string")))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """sizes (source, a source_key; source_size; one row each) with target.

    Sources in their order have the weights in turn and share `share` of all sizes; a target stops at `most`
    times its source's size and the excess is reshared by weight. In order of size by weight, a source is capped if its
    share of what the earlier ones left is not less than its cap; after the first that is not, none is.
    The windows see one row per source.
    """
    everywhere = Window.partitionBy()
    turn = (F.row_number().over(everywhere.orderBy(F.col("source").asc())) - 1) % len(weights)
    rows = sizes.select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("double").alias("w"))
    rows = rows.withColumn("cap", most * F.col("source_size")).withColumn("budget", share * F.sum("source_size").over(everywhere))
    up = everywhere.orderBy(F.col("cap") / F.col("w"), F.col("source"))
    earlier = F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    later = F.sum("w").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("capped", (F.col("budget") - earlier) * F.col("w") >= F.col("cap") * later)
    given = F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everywhere), F.lit(0.0))
    level = (F.col("budget") - given) / F.sum(F.when(~F.col("capped"), F.col("w"))).over(everywhere)
    return rows.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(level * F.col("w")).alias("target"))


def cut_rows(rows: DataFrame, by_bucket: DataFrame, planned: DataFrame) -> DataFrame:
    """The row of each source that is taken in part: source, cut (its key, id and size), cut_part (its words taken), peers
    (rows that tie with it, itself included) and earlier (those of them that come before it).

    Sums of buckets give the bucket that the source's rest ends in; only rows of that one bucket are ordered.
    """
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    b = by_bucket.withColumn("before", F.coalesce(F.sum("bucket_size").over(before), F.lit(0))).join(planned.select("source", "rest"), "source")
    b = b.where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("bucket_size")))
    near = rows.join(b.select("source", "bucket", (F.col("rest") - F.col("before")).alias("left")), ["source", "bucket"])
    order = Window.partitionBy("source").orderBy("key", "id", "size")
    within = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    near = near.select("source", F.struct("key", "id", "size").alias("cut"), "size", (F.col("left") - within).alias("cut_part"), F.count("*").over(order.rangeBetween(Window.currentRow, Window.currentRow)).alias("peers"), (F.row_number().over(order) - F.rank().over(order)).alias("earlier"))
    return near.where((F.col("cut_part") >= 0) & (F.col("cut_part") < F.col("size"))).drop("size")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: bool = False, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, buckets: int = 4096) -> DataFrame:
    """Per row: the id, size (words), source_size, target (of its source), taken (words, repeats counted); with keep also row, a struct of all columns.

    Null texts have size 0 and are taken 0 times; null sources are one source, the last. Rows with one id tie in their
    key and are ordered by size; repeated rows count each. An empty table gives an empty one. Reruns agree.
    The words taken of a source are its target, rounded down.
    """
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id"), whole_row(docs, keep).alias("row"), source_key(source_col).alias("source"), word_count(text).alias("size"), quality_weight(text, word_count(text)).alias("quality"), uniform(id_col).alias("u"))
    rows = rows.select("id", "row", "source", "size", (-F.log("u") / F.col("quality")).alias("key"))
    narrow = rows.withColumn("bucket", F.floor(buckets * F.col("key") / (1 + F.col("key"))).cast("int"))
    narrow = materialize(narrow if not keep else narrow.drop("row"), "mix")

    by_bucket = materialize(narrow.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"), F.count("*").alias("rows")), "mix-buckets")
    targets = source_targets(by_bucket.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size"))).otherwise(0)
    planned = targets.withColumn("epochs", whole).withColumn("rest", F.floor("target") - F.col("epochs") * F.col("source_size"))
    planned = materialize(planned, "mix-targets")
    held = by_bucket.groupBy("source").agg(F.sum("rows").alias("rows"))
    cuts = materialize(planned.join(cut_rows(narrow, by_bucket, planned), "source", "left").join(held, "source"), "mix-cuts")

    # Sources with a 10,000th of all rows or more, at most 10,000 of them, are broadcast; rows of smaller ones, if there are
    # any, go by source, and none of these fills a task.
    often = F.col("rows") * 10_000 >= (cuts.agg(F.sum("rows")).first()[0] or 0)
    large, small, from_rows = F.broadcast(cuts.where(often)), cuts.where(~often), rows if keep else narrow
    placed = from_rows.join(large, "source")
    if not small.isEmpty():
        placed = placed.unionByName(from_rows.join(large.select("source"), "source", "left_anti").join(small, "source"))
    mine = F.struct("key", "id", "size")
    tied = mine.eqNullSafe(F.col("cut")) & (F.col("peers") > 1)
    if cuts.where("peers > 1").isEmpty():
        placed = placed.withColumn("rank", F.lit(0))
    else:  # only rows that tie with a cut move
        rank = F.row_number().over(Window.partitionBy("source").orderBy("size")) - 1
        placed = placed.where(~tied).withColumn("rank", F.lit(0)).union(placed.where(tied).withColumn("rank", rank))
    at_cut = F.when(F.col("rank") < F.col("earlier"), F.col("size")).when(F.col("rank") == F.col("earlier"), F.col("cut_part")).otherwise(0)
    part = F.when(mine < F.col("cut"), F.col("size")).when(mine.eqNullSafe(F.col("cut")), at_cut).otherwise(0)
    taken = (F.col("epochs") * F.col("size") + part).cast("long").alias("taken")
    return placed.select(F.col("id").alias(id_col), "size", F.col("source_size").cast("long").alias("source_size"), "target", taken, *["row"] * keep)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself, with the columns of docs: a row for each time a document is taken; in part: its first words, space-joined.

    Texts without words (null and empty ones too) are never taken; null sources are one source; repeated rows are taken each.
    An empty table gives an empty one.
    """
    rows = mix(docs, id_col, text_col, source_col, True, **options).where("taken > 0").select("row", "size", "taken")
    text = F.col(f"row.`{text_col}`")
    words = F.filter(F.split(text, rf"[{SPACE}]+"), lambda w: w != "")
    part = F.col("taken") % F.col("size")
    cut = F.array_join(F.slice(words, F.lit(1), part.cast("int")), " ")
    whole = F.floor(F.col("taken") / F.col("size")).cast("int")
    copies = F.when(part == 0, F.array_repeat(text, whole)).otherwise(F.concat(F.array_repeat(text, whole), F.array(cut)))
    out = rows.select("row", F.explode(copies).alias("text"))
    return out.select(*(F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
