"""SimHash near-duplicate detection by bit-sliced comparison (operator 10).

Copies share a fingerprint, so only distinct ones are compared. Two fingerprints at most 2 bits apart have two of their
four 16-bit blocks alike: each goes to six buckets of two blocks. Buckets over `tile` fingerprints are cut further by
thirds of their other 32 bits (one of which is alike, too), and what is still larger into pairs of tiles; no bucket has a
cap. In a tile, fingerprints stand as bit planes, 64 of them to a word: for each query and word, the planes that differ
are added by carry-save counters (ones, twos, over), and words whose 64 fingerprints are all over the radius are left.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices, text_unless, texts_of, whole_row
from .components import stars

RADIUS = 2


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """The unsigned SimHash of a UTF-8 text: bit set if set in over half of its shingles' hashes."""
    words = text.lower().split()  # A-Z alone; the six ASCII white-space characters alone
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) <= width:
        return int.from_bytes(digest(b" ".join(words), seed), "big")
    ones, n = np.zeros(64, np.int64), len(words) - width + 1
    for at in range(0, n, 1 << 16):
        part = words[at : at + (1 << 16) + width - 1]
        h = b"".join([digest(b" ".join(x), seed) for x in zip(*(part[i:] for i in range(width)), strict=False)])
        ones += np.unpackbits(np.frombuffer(h, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int, seed: int, keep: bool) -> DataFrame:
    """Per row: id, fp (signed long), row (a struct of all columns, or a stub)."""
    kept = docs.select(F.col(id_col).alias("id"), text_unless(docs, text_col, keep).alias("t"), whole_row(docs, keep).alias("row"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fps = np.array([fingerprint(x, width, seed) for x in texts_of(b, "t", "row", text_col if keep else None)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), b.column(2)], ["id", "fp", "row"])

    return kept.mapInArrow(run, f"id {kept.schema['id'].dataType.simpleString()}, fp long, row {kept.schema['row'].dataType.simpleString()}")


def planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes, (64, words): bit i of a word of plane p is bit p of its i-th fingerprint; the last word is padded."""
    words = -(-len(fps) // 64)
    bits = np.zeros((64, words * 64), np.uint8)
    bits[:, : len(fps)] = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def near(queries: np.ndarray, fps: np.ndarray, radius: int = RADIUS, step: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in queries, in fps) of all pairs at most `radius` (1 to 3) bits apart."""
    at = planes(fps)
    n, words = len(queries), at.shape[1]
    ask = np.where((queries[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1), np.uint64(2**64 - 1), np.uint64(0))
    q, w = np.repeat(np.arange(n), words), np.tile(np.arange(words), n)
    ones = np.zeros(len(q), np.uint64)
    twos, over = ones.copy(), ones.copy()
    for p in range(64):
        d = ask[q, p] ^ at[p, w]
        carry = ones & d
        ones ^= d
        over |= twos & carry  # four or more
        twos ^= carry
        if p % step == step - 1 or p == 63:
            above = (over, over | (twos & ones), over | twos)[3 - radius]
            alive = ~above != 0
            if not alive.all():
                q, w, ones, twos, over, above = (x[alive] for x in (q, w, ones, twos, over, above))
            if not len(q):
                return q, w
    bits = np.unpackbits((~above).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    cell, bit = np.nonzero(bits)
    j = w[cell] * 64 + bit
    real = j < len(fps)
    return q[cell][real], j[real]


def clusters(fps: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint the position of the first one in its cluster of links."""
    root = np.arange(len(fps))
    for at in range(0, len(fps), 256):
        i, j = near(fps[at : at + 256], fps, radius)
        i = i + at
        while True:  # links pull both ends' roots to the lesser one
            a, b = root[i], root[j]
            if (a == b).all():
                break
            low = np.minimum(a, b)
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            while (root != (next_ := root[root])).any():
                root = next_
    return root


def links(fps: DataFrame, radius: int = RADIUS, tile: int = 512) -> DataFrame:
    """fps (fp; distinct) -> edges (a, b) that connect what chains of links at most `radius` bits long connect."""
    if not 1 <= radius <= 2:
        raise ValueError("two of four blocks are alike only up to 2 bits")
    block = [F.shiftrightunsigned("fp", 16 * i).bitwiseAND(0xFFFF) for i in range(4)]
    keyed = []
    for c, (i, j) in enumerate(combinations(range(4), 2)):
        k, m = (x for x in range(4) if x not in (i, j))
        keyed.append(F.struct((F.lit(c << 32) + block[i] * 65536 + block[j]).alias("key"), (block[k] * 65536 + block[m]).alias("rest")))
    first = fps.select("fp", F.explode(F.array(*keyed)).alias("k")).select("fp", "k.key", "k.rest")
    shared = first.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = materialize(first.join(shared, "key"), "buckets")

    thirds = [F.struct(F.lit(s).alias("s"), F.shiftright("rest", at).bitwiseAND((1 << n) - 1).alias("v")) for s, (at, n) in enumerate(((0, 11), (11, 11), (22, 10)))]
    second = met.where(F.col("n") > tile).select("fp", "key", F.explode(F.array(*thirds)).alias("t"))
    second = second.select("fp", (F.col("key") * 8192 + F.col("t.s") * 2048 + F.col("t.v") + (1 << 61)).alias("key"))
    larger = second.join(second.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    cut = larger.withColumn("mine", F.pmod(F.xxhash64("fp"), tiles).cast("int")).select("fp", "key", "mine", F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other"))
    groups = met.where(F.col("n") <= tile).select("fp", "key", F.lit(0).alias("i"), F.lit(0).alias("j")).union(cut.select("fp", "key", F.least("mine", "other"), F.greatest("mine", "other")))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = []

        def edges(rows: np.ndarray) -> pa.RecordBatch:
            # whole groups in order; several small ones share a tile, and any pair in reach is a link
            ends = np.flatnonzero(np.r_[(rows[1:, :3] != rows[:-1, :3]).any(1), True]) + 1
            a, b, at = [], [], 0
            while at < len(rows):
                k = max(np.searchsorted(ends, at + tile, "right") - 1, np.searchsorted(ends, at, "right"))
                part = np.unique(rows[at : ends[k], 3])
                root = clusters(part.view(np.uint64), radius)
                a.append(part[root != np.arange(len(part))])
                b.append(part[root[root != np.arange(len(part))]])
                at = ends[k]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x or [np.zeros(0, np.int64)])) for x in (a, b)], ["a", "b"])

        for batch in batches:
            rows = np.column_stack([c.to_numpy().astype(np.int64) for c in batch.columns])
            if not len(rows):
                continue
            cut = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(1))
            last = cut[-1] + 1 if len(cut) else 0  # the last group may go on
            if last or rest and (rest[-1][-1, :3] != rows[0, :3]).any():
                yield edges(np.concatenate([*rest, rows[:last]]))
                rest = []
            rest.append(rows[last:])
        if rest:
            yield edges(np.concatenate(rest))

    ordered = groups.select("key", "i", "j", "fp").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return ordered.mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42, radius: int = RADIUS, keep: bool = False) -> DataFrame:
    """Per row: the id, fingerprint (16 hexadecimal digits), component_id (least id that links reach); with keep also row, a struct of all columns.

    Null and empty texts have the fingerprint 0, which links like any other. Repeated rows stay, in one component; null
    ids count only where a component has no other (component_id null). An empty table gives an empty one.
    """
    prints, by_fp = grouped(docs, id_col, text_col, width, seed, radius, keep)
    out = prints.join(by_fp, "fp")
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first.id").alias("component_id"), *["row"] * keep)


def grouped(docs: DataFrame, id_col: str, text_col: str, width: int, seed: int, radius: int, keep: bool) -> tuple[DataFrame, DataFrame]:
    """The rows with fp and a row number n, and for each fp its component's first row: struct (id, n)."""
    prints = with_fingerprints(docs, id_col, text_col, width, seed, keep)
    prints = materialize(prints.withColumn("n", F.monotonically_increasing_id()), "prints")
    low = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "n"))
    lows = materialize(prints.groupBy("fp").agg(low.alias("low")), "lows")
    star = stars(links(lows.select("fp"), radius))
    member = lows.join(star.toDF("fp", "root"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    least = member.groupBy("root").agg(F.min("low").alias("first"))
    return prints, member.join(least, "root").select("fp", "first")


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42, radius: int = RADIUS) -> DataFrame:
    """docs with one row of each component: that of the least id (of repeated ids, one of them).

    Null and empty texts are alike, so one of them stays; a row with a null id goes if its component has an id. An empty table
    gives an empty one. Only the numbers of the rows that go are joined to whole rows: a broadcast if they are few.
    """
    prints, by_fp = grouped(docs, id_col, text_col, width, seed, radius, True)
    goes = materialize(prints.select("fp", "n").join(by_fp, "fp").where(F.col("n") != F.col("first.n")).select("n"), "copies")
    return prints.join(goes, "n", "left_anti").select("row.*")
