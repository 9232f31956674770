"""Document fingerprints: Merkle trees over paragraphs and sections (operator 8, native).

A text is cut into paragraphs: runs of at most eight words that a line break or the end of a sentence may close early.
Their hashes are the leaves; a leaf that begins with 0 or 1 closes a section (as does the 32nd), so sections come back in
step after an edit; the root hashes the sections' hashes. A fingerprint holds the whole tree: the root, and for each
section eight digits of its hash and of its leaves. Roots test equality; where they differ, sections are compared by their
hashes, and leaves only in the sections that differ, which locates edits.

The next document in descending order of ids is found without a global sort: ids fall into ranges (of sampled
quantiles, then evenly; rows of one id, and those without, by a hash of their text), the window runs inside a range, and
only the first document of each range is looked up for the range above. Texts move once.
"""

from __future__ import annotations

import os.path
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import materialize, once
from .linear import hashed

#: One paragraph; one section of leaves of 16 digits.
PARAGRAPH = r"(?:[^.!?\n\x20]*\x20){0,7}[^.!?\n\x20]*(?:[.!?\n]+|\x20|\z)"
SECTION = r"(?:[2-9a-f][0-9a-f]{15}){0,31}[0-9a-f]{16}"


def fingerprint(text: Column) -> Column:
    """32 digits of the root; for each section a space, 8 digits of its hash, a colon, and 8 digits of each leaf. Null counts as empty, which has no leaf."""
    text = F.coalesce(text, F.lit(""))
    paragraphs = F.filter(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), lambda x: x != "")
    leaves = F.array_join(F.transform(paragraphs, lambda x: F.substring(F.md5(x.cast("binary")), 1, 16)), "")
    nodes = F.transform(F.regexp_extract_all(leaves, F.lit(SECTION), F.lit(0)), lambda x: F.struct(F.md5(x.cast("binary")).alias("hash"), x.alias("leaves")))

    def tree(sections: Column) -> Column:
        root = F.substring(F.sha2(F.array_join(F.transform(sections, lambda x: x["hash"]), "").cast("binary"), 256), 1, 32)
        below = F.transform(sections, lambda x: F.concat(F.lit(" "), F.substring(x["hash"], 1, 8), F.lit(":"), F.regexp_replace(x["leaves"], "([0-9a-f]{8})[0-9a-f]{8}", "$1")))
        return F.concat(root, F.array_join(below, ""))

    return once(nodes, tree)


def sections_of(print_: Column) -> Column:
    """The sections of a fingerprint: hash, colon, leaves."""
    parts = F.split(print_, " ")
    return F.slice(parts, F.lit(2), F.size(parts) - 1)


def leaves_of(section: Column) -> Column:
    return F.regexp_extract_all(F.substring_index(section, ":", -1), F.lit("[0-9a-f]{8}"), F.lit(0))


def leaf_count(sections: Column) -> Column:
    return F.aggregate(sections, F.lit(0), lambda n, s: n + ((F.length(s) - 9) / 8).cast("int"))


def compared(a: Column, b: Column) -> Column:
    """struct<likeness, same_sections, same_paragraphs> of two fingerprints, from the root down.

    same_sections, same_paragraphs: how many lead before the first that differs; null if the roots are equal. likeness: 1 if
    they are; else twice what both hold over what each holds, counting leaves of sections that both have and, in the
    sections that differ, distinct leaves that both have; or leading leaves if that gives more (texts that repeat
    themselves). It stays under 1 where roots differ.
    """

    def differing(x: Column) -> Column:
        left, right = x["a"], x["b"]
        shared = leaf_count(F.array_intersect(left, right))
        mine = F.array_distinct(F.flatten(F.transform(F.array_except(left, right), leaves_of)))
        other = F.array_distinct(F.flatten(F.transform(F.array_except(right, left), leaves_of)))
        both = once(F.struct(mine.alias("m"), other.alias("o"), shared.alias("s")), lambda y: F.struct((y["s"] + F.size(F.array_intersect(y["m"], y["o"]))).alias("both"), (2 * y["s"] + F.size(y["m"]) + F.size(y["o"])).alias("all")))
        at = F.array_position(F.zip_with(left, right, lambda p, q: ~p.eqNullSafe(q)), True).cast("int")  # from 1
        none = F.array().cast("array<string>")
        inside = F.zip_with(F.coalesce(leaves_of(F.get(left, at - 1)), none), F.coalesce(leaves_of(F.get(right, at - 1)), none), lambda p, q: ~p.eqNullSafe(q))
        lead = leaf_count(F.slice(left, F.lit(1), F.greatest(at - 1, F.lit(0)))) + F.array_position(inside, True).cast("int") - 1
        every = leaf_count(left) + leaf_count(right)
        return F.struct(both.alias("n"), (at - 1).alias("sections"), F.greatest(lead, F.lit(0)).alias("lead"), every.alias("every"))

    def result(d: Column) -> Column:
        near = F.greatest(2.0 * d["n"]["both"] / F.greatest(d["n"]["all"], F.lit(1)), 2.0 * d["lead"] / F.greatest(d["every"], F.lit(1)))
        return F.struct(F.least(near, 1 - 1.0 / F.greatest(d["every"], F.lit(1))).alias("likeness"), d["sections"].cast("long").alias("same_sections"), d["lead"].cast("long").alias("same_paragraphs"))

    equal = F.struct(F.lit(1.0).alias("likeness"), F.lit(None).cast("long").alias("same_sections"), F.lit(None).cast("long").alias("same_paragraphs"))
    below = once(F.struct(sections_of(a).alias("a"), sections_of(b).alias("b")), lambda x: once(differing(x), result))
    return F.when(F.substring(a, 1, 32) == F.substring(b, 1, 32), equal).otherwise(below)


def as_number(docs: DataFrame, id_col: str) -> tuple[Column, bool]:
    """A whole number that does not fall as the id grows, and whether equal numbers mean equal ids.

    Texts: the seven bytes that follow what all ids begin with.
    """
    if not isinstance(docs.schema[id_col].dataType, StringType):
        return F.col(id_col).cast("long"), docs.schema[id_col].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    ends = docs.agg(F.min(F.encode(id_col, "UTF-8")), F.max(F.encode(id_col, "UTF-8"))).first()
    common = len(os.path.commonprefix([bytes(x or b"") for x in ends]))
    part = F.hex(F.substring(F.encode(id_col, "UTF-8"), common + 1, 7))
    return F.conv(F.rpad(part, 14, "0"), 16, 10).cast("long"), False


def range_of(docs: DataFrame, id_col: str, hash_col: str, per_range: int, coarse: int = 1024, sample: int = 200_000) -> tuple[Column, Column, int]:
    """Two columns, coarse and fine, that do not fall as (id, hash) grows, about per_range rows each; and the number of rows.

    Only balance depends on the sample of ids. Rows of an id that fills more than a coarse range, and rows without an id (a
    coarse range of their own, below all others), are cut by the hash.
    """
    i, exact = as_number(docs, id_col)
    ids = docs.select(i.alias("i"))
    rows, n = ids.agg(F.count("*"), F.count("i")).first()
    k = max(1, min(coarse, n // max(1, per_range)))
    quantiles = ids.where(F.col("i").isNotNull() & (hashed("i") <= max(sample, 1) / max(n, 1))).agg(F.percentile_approx("i", [j / k for j in range(k + 1)], 10_000)).first()[0] or [0, 0]
    cuts, often = sorted(set(quantiles)), Counter(quantiles)
    cuts = cuts if len(cuts) > 1 else [cuts[0], cuts[0] + 1]
    fine = max(1, -(-n // (k * per_range)))
    same = [often[c] * fine if exact and often[c] > 1 else 0 for c in cuts]  # ranges for rows of just this id
    array, parts, last = F.array(*map(F.lit, cuts)), F.array(*map(F.lit, same)), len(cuts) - 1
    steps = max(1, last.bit_length())
    # binary search for the last cut that is not above the id (position from 1)
    at = F.aggregate(F.array(*(F.lit(1 << (steps - 1 - s)) for s in range(steps))), F.lit(1), lambda lo, s: F.when((lo + s <= last) & (F.get(array, lo + s - 1) <= i), lo + s).otherwise(lo))
    low, high, own = F.get(array, at - 1), F.get(array, at), F.get(parts, at - 1)
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (i - low) / F.greatest(high - low, F.lit(1))))
    by_hash = F.col(hash_col) / float(1 << 64) + 0.5
    within = F.when((i == low) & (own > 0), F.floor(by_hash * own)).otherwise(own + F.floor(share * (fine - 1)))
    without = F.floor(by_hash * max(1, -(-(rows - n) // per_range)))
    zero = F.lit(0).cast("long")  # tells Spark that neither is null, so joins on them add no filters
    return F.coalesce(F.when(i.isNotNull(), at.cast("long")), zero), F.coalesce(F.when(i.isNull(), without).otherwise(within).cast("long"), zero), rows


def with_next(docs: DataFrame, id_col: str, text_col: str, derived: dict[str, Column] | None = None, per_range: int = 256) -> DataFrame:
    """docs with `derived` columns (of text_col), and next_<column> for text_col and those: of the next row in descending order of (id, text hash); after the last, of the first."""
    derived = derived or {}
    hashed_rows = docs.withColumn("_h", F.xxhash64(text_col))
    at, fine, n = range_of(hashed_rows, id_col, "_h", per_range)
    rows = hashed_rows.withColumn("_c", at).withColumn("_r", fine)
    heads = materialize(rows.groupBy("_c", "_r").agg(F.max(F.struct(F.col(id_col).alias("id"), F.col("_h").alias("h"))).alias("head")), "heads")
    coarse = heads.groupBy("_c").agg(F.max_by("head", "_r").alias("head"), F.max("_r").alias("_r"))  # at most as many rows as there are coarse ranges
    down = Window.partitionBy().orderBy(F.col("_c").desc())
    place = F.struct("_c", "_r")
    coarse = coarse.select("_c", F.coalesce(F.lead(place).over(down), F.first(place).over(down)).alias("below"))
    inner = Window.partitionBy("_c").orderBy(F.col("_r").desc())
    below = heads.withColumn("in", F.lead(place).over(inner)).join(coarse, "_c").select(F.coalesce("in", "below").alias("of"), "_c", "_r")
    below = below.select(F.col("of._c").alias("_c"), F.col("of._r").alias("_r"), F.struct("_c", "_r").alias("above"))

    partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // 8192 + 1)
    moved = rows.repartition(partitions, "_c", "_r")  # the only time that texts move
    payload = [text_col, *derived]
    # the head is the greatest of its range; an equality would become a join key, and texts would move again
    tops = moved.join(heads, ["_c", "_r"]).where(F.struct(F.col(id_col).alias("id"), F.col("_h").alias("h")) >= F.col("head"))
    tops = tops.select("_c", "_r", text_col).dropDuplicates(["_c", "_r"])
    first = below.join(tops, ["_c", "_r"]).select(F.col("above._c").alias("_c"), F.col("above._r").alias("_r"), text_col).select("_c", "_r", text_col, *(c.alias(k) for k, c in derived.items()))
    first = first.select("_c", "_r", F.struct(*payload).alias("first"))
    order = Window.partitionBy("_c", "_r").orderBy(F.col(id_col).desc_nulls_last(), F.col("_h").desc())
    moved = moved.select("*", *(c.alias(k) for k, c in derived.items()))
    led = moved.withColumn("_p", F.lead(F.struct(*payload)).over(order)).join(first, ["_c", "_r"], "left")
    use = F.coalesce("_p", "first")
    return led.select(*(F.col(c) for c in docs.columns), *derived, *(use[c].alias(f"next_{c}") for c in payload))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, same_sections, same_paragraphs.

    The edited text has its last third (rounded down, code points) replaced by as many (or all) of the first of the next
    document's. same_sections, same_paragraphs: where the edit begins: leading sections and paragraphs that text and edited
    text share, null if they are equal. Null texts are empty: equal fingerprints, likeness 1 to each other. Ids are whole
    numbers or text (in order of code points). Rows with one id are ordered by a hash of their text; repeated rows stay.
    Null ids come last. A single row is its own next. An empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = with_next(rows, "id", "t", {"print": fingerprint(F.col("t"))})
    n, third = F.length("t"), F.floor(F.length("t") / 3).cast("int")
    edited = F.concat(F.substring("t", F.lit(1), n - third), F.substring("next_t", F.lit(1), third))
    rows = rows.select("id", n.cast("long").alias("n_chars"), edited.alias("e"), "print", "next_print")
    rows = rows.select("id", "n_chars", F.sha2(F.col("e").cast("binary"), 256).alias("edited_sha256"), "print", fingerprint(F.col("e")).alias("e_print"), "next_print")
    rows = rows.select("*", compared(F.col("print"), F.col("e_print")).alias("edit"), compared(F.col("print"), F.col("next_print")).alias("next"))
    return rows.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", F.col("print").alias("fingerprint"), F.col("e_print").alias("edited_fingerprint"), F.col("edit.likeness").alias("near_edited"), F.col("next.likeness").alias("near_next"), "edit.same_sections", "edit.same_paragraphs")
