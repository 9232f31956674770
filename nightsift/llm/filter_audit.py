"""Filter interaction audit (operator 11).

One pass of a finite-state transducer over the UTF-8 bytes of each text counts words, capitals, code points and symbols,
and puts the spans of words into a hash table that verifies equality byte by byte, so distinct words are exact. The
filters that a text fails become the bits of one number; how any order of the filters would act follows from the number of
texts for each set of bits, so texts are read once for all orders.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices

FILTERS = "ABCDE"
SPACES, SYMBOLS = b" \t\n\v\f\r", b"#$%&*|"
#: Classes of bytes, as bits of the transducer's table: part of a word, first of a code point, capital, symbol.
IN_WORD, FIRST, CAPITAL, SYMBOL = 1, 2, 4, 8
TABLE = np.array([IN_WORD * (b not in SPACES) | FIRST * (not 0x80 <= b < 0xC0) | CAPITAL * (65 <= b <= 90) | SYMBOL * (b in SYMBOLS) for b in range(256)], np.uint8)
BLOCK = 1 << 20


def spans(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words. The transducer's state after a byte, in a word or outside of one, is a bit of the byte's class."""
    inside = (classes & IN_WORD).astype(np.int8)
    step = np.diff(inside, prepend=0, append=0)
    return np.flatnonzero(step > 0), np.flatnonzero(step < 0)


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the spans at a and at b of these sizes (all over 0) hold the same bytes."""
    first = np.cumsum(sizes) - sizes
    within = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    return np.logical_and.reduceat(data[np.repeat(a, sizes) + within] == data[np.repeat(b, sizes) + within], first) if len(sizes) else np.zeros(0, bool)


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each span; the spans do not touch."""
    if not len(start):
        return np.zeros(0, np.uint64)
    sizes = end - start
    power = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15 | 1, np.uint64))
    at = np.repeat(start, sizes) + (np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    h = np.add.reduceat((data[at].astype(np.uint64) + np.uint64(1)) * power[at - np.repeat(start, sizes)], np.cumsum(sizes) - sizes)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def first_of_each(data: np.ndarray, owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether a span is in the table for the first time: an open-addressing table of (owner, word), all spans probed at once.

    A round looks at one slot for each span still on its way: an empty slot is taken by one of those that came to it; a span
    whose owner, length and bytes are those of the slot's is found; others go on to the next slot.
    """
    bits = max(4, int(len(start) * 2).bit_length())
    table = np.full(1 << bits, -1, np.int64)
    h = hashes(data, start, end) ^ (owner.astype(np.uint64) * np.uint64(0x94D049BB133111EB))
    slot = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
    new = np.zeros(len(start), bool)
    way = np.arange(len(start))
    while len(way):
        at = slot[way].astype(np.int64)
        free = table[at] < 0
        table[at[free]] = way[free]  # of several, the last one takes it
        held = table[at]
        new[way[held == way]] = True
        maybe = (held != way) & (h[held] == h[way]) & (owner[held] == owner[way]) & (end[held] - start[held] == end[way] - start[way])
        same = held == way
        same[maybe] = same_bytes(data, start[held[maybe]], start[way[maybe]], end[way[maybe]] - start[way[maybe]])
        way = way[~same]
        slot[way] = (slot[way] + np.uint64(1)) & np.uint64((1 << bits) - 1)
    return new


def counts_of(texts: list[bytes]) -> np.ndarray:
    """Rows of n_words, n_distinct, n_capitals, n_points, n_symbols, one for each text; texts together are about a block."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)  # a text's end ends its last word
    ends = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
    begins = ends - [len(t) + 1 for t in texts]
    classes = TABLE[data]
    start, end = spans(classes)
    owner = np.searchsorted(ends, start, "right")
    new = first_of_each(data, owner, start, end)
    by_text = lambda bit: np.add.reduceat((classes & bit) > 0, begins, dtype=np.int64)
    return np.stack([np.bincount(owner, minlength=len(texts)), np.bincount(owner[new], minlength=len(texts)), by_text(CAPITAL), by_text(FIRST) - 1, by_text(SYMBOL)], 1)


def counts_of_long(text: bytes, block: int = BLOCK) -> np.ndarray:
    """The same for one text of any length, a block at a time; a block ends at white space unless a single word is longer."""
    total, seen, at = np.zeros(5, np.int64), set(), 0
    while at < len(text):
        stop = min(at + block, len(text))
        if stop < len(text):
            cut = max(text.rfind(bytes([c]), at, stop) for c in SPACES)
            stop = cut + 1 if cut >= 0 else min((x for c in SPACES if (x := text.find(bytes([c]), stop)) >= 0), default=len(text))
        if stop - at > block:  # one word, but for a space before it: its bytes are counted in parts
            for part in range(at, stop, block):
                c = TABLE[np.frombuffer(text[part : min(part + block, stop)], np.uint8)]
                total += [0, 0, *(int(((c & bit) > 0).sum()) for bit in (CAPITAL, FIRST, SYMBOL))]
            words = text[at:stop].split()
            total[0] += len(words)
        else:
            piece = text[at:stop]
            data = np.frombuffer(piece + b"\n", np.uint8)
            start, end = spans(TABLE[data])
            new = first_of_each(data, np.zeros(len(start), np.int64), start, end)
            words = [piece[a:b] for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)]
            total += counts_of([piece])[0] * [1, 0, 1, 1, 1]
        seen.update(words)
        at = stop
    total[1] = len(seen)
    return total


def failures(counts: np.ndarray) -> np.ndarray:
    """Bits of the filters A to D that each row of counts fails."""
    words, distinct, capitals, points, symbols = counts.T
    return (words < 50) | (100 * distinct < 65 * words) << 1 | (100 * capitals > 5 * points) << 2 | (symbols > 0) << 3


def judged(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """Per row: part, mask (bits of the filters it fails, A lowest), good, toxic."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1024, BLOCK):
            texts = [x or b"" for x in b.column(2).to_pylist()]
            counts = counts_of_long(texts[0])[None] if len(texts) == 1 and len(texts[0]) > BLOCK else counts_of(texts)
            yield pa.RecordBatch.from_arrays([*b.columns[:2], b.column(3), pa.array(failures(counts).astype(np.int32))], ["id", "part", "digest", "mask"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("t", 256)))
    rows = materialize(rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, part string, digest binary, mask int"), "judged")

    has = F.col("id").isNotNull()
    first = rows.where(has).groupBy("digest").agg(F.min("id").alias("id"))  # combined before its shuffle: copies do not meet
    first = first.groupBy("id").agg(F.collect_set("digest").alias("firsts"))  # of an id's own texts
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    known = rows.where(has).join(first, "id", "left").join(marks, "id", "left")
    copy = ~F.coalesce(F.array_contains("firsts", F.col("digest")), F.lit(False))
    no = F.lit(False)
    known = known.select("part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))
    return known.union(rows.where(~has).select("part", "mask", no, no))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Per part, order of the five filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Filters: A under 50 words; B under 65 % of words distinct; C over 5 % capitals A-Z; D any of #$%&*|; E equal to the text
    of a smaller id anywhere in the table. labels (id_col, quality, toxic): a document is good or toxic if any row of its id
    says so. shapley: what the step's filter removes, summed over all orders. Null texts are empty; a null part and the empty
    one are one part; null ids are neither smaller nor larger than others, so they are no copies and have none. Rows that
    repeat an id are documents each, and no copies of one another. An empty table gives no rows; other columns are not used.
    """
    per = judged(docs, labels, id_col, text_col, part_col).groupBy("part", "mask").agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    per = per.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("sets"))  # at most 32 each
    orders = [(i, "".join(o)) for i, o in enumerate(permutations(FILTERS))]
    steps = F.flatten(F.transform(F.array(*(F.lit(o) for _, o in orders)), lambda o: F.transform(F.sequence(F.lit(1), F.lit(5)), lambda s: F.struct(o.alias("filter_order"), s.alias("step")))))
    rows = per.select("part", "sets", F.explode(steps).alias("at")).select("part", "sets", "at.*")
    bit = lambda c: F.call_function("shiftleft", F.lit(1), F.instr(F.lit(FILTERS), c) - 1)
    before = F.aggregate(F.sequence(F.lit(1), F.lit(5)), F.lit(0), lambda m, i: m + F.when(i < F.col("step"), bit(F.substring("filter_order", i, F.lit(1)))).otherwise(0))
    rows = rows.withColumn("bit", bit(F.substring("filter_order", F.col("step"), F.lit(1)))).withColumn("before", before)

    def total(what: str, keep) -> Column:
        return F.aggregate(F.filter("sets", keep), F.lit(0).cast("long"), lambda a, x: a + x[what])

    failing = lambda x: x["mask"].bitwiseAND(F.col("bit")) > 0
    earlier = lambda x: x["mask"].bitwiseAND(F.col("before")) > 0
    removed = lambda x: failing(x) & ~earlier(x)
    # of the 120 orders of five filters, a text that fails k meets this one first in 120 / k
    shapley = F.aggregate(F.filter("sets", failing), F.lit(0).cast("long"), lambda a, x: a + x["n"] * F.floor(120 / F.bit_count(x["mask"])).cast("long"))
    return rows.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        total("n", lambda x: ~failing(x) & ~earlier(x)).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda x: failing(x) & earlier(x)).alias("redundant"),
        total("n", lambda x: x["mask"] == F.col("bit")).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        shapley.alias("shapley"),
    )
