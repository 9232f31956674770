"""Best-fit packing by patterns (operator 4).

Texts become token ids and one closing id; pieces of at most `capacity` tokens are packed into sequences:

1. tokenize: a narrow pass writes one small row per piece, with its rank among the pieces of equal length in its task.
2. histogram: the counts by length (at most `capacity` rows) go to the driver.
3. plan: patterns of two or three lengths that fill a sequence are enumerated, their repeat counts fitted to the
   histogram by non-negative least squares and rounded down; what is left is packed best-fit, longest first, by counts
   of equal lengths and never piece by piece. The plan's size depends on `capacity`, not on the corpus.
4. place: each piece's rank among all of its length (task offsets are summed by a window over per-task counts) selects
   its sequence and offset. Hot lengths need no care: no step gathers the pieces of a length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, slices
from .word_bpe import WordIds


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per piece: the id, piece, start, length, ids_crc32, task and rank_in_task (by length); with_ids adds ids (binary).

    Null and empty texts have the closing id alone.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    names = [id_col, "piece", "start", "length", "ids_crc32", "task", "rank_in_task"] + ["ids"] * with_ids

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = WordIds(sent.value), np.array([end_id], "<u4").tobytes()
        task, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for b in slices(batches):
            rows, cols = [], [[] for _ in names[1:]]
            for i, text in enumerate(b.column(1).to_pylist()):
                ids = words.text_ids(text or b"") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    n = len(part) // 4
                    rows.append(i)
                    for col, x in zip(cols, (piece, at // 4, n, zlib.crc32(part), task, seen[n], part), strict=False):
                        col.append(x)
                    seen[n] += 1
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=False))], names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, task int, rank_in_task long" + ", ids binary" * with_ids
    return docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, schema)


def patterns(counts: np.ndarray, capacity: int, common: int = 24) -> list[tuple[int, ...]]:
    """Full patterns of two lengths, and of three of which one is among the most common lengths. All lengths occur."""
    have = [n for n in range(1, capacity) if counts[n]]
    there = set(have)
    found = {(a, capacity - a) for a in have if 2 * a >= capacity and capacity - a in there}
    for c in sorted(have, key=lambda n: (-counts[n], n))[:common]:
        found |= {tuple(sorted((a, capacity - c - a, c), reverse=True)) for a in have if 2 * a >= capacity - c and capacity - c - a in there}
    return sorted(found, reverse=True)


def fit(counts: np.ndarray, pats: list[tuple[int, ...]], steps: int = 400) -> np.ndarray:
    """Non-negative least squares: repeat counts x >= 0 that bring sum(x * pattern) nearest to the histogram.

    Accelerated projected gradient; the step is the inverse of a bound on the largest eigenvalue.
    """
    if not pats:
        return np.zeros(0)
    width = max(map(len, pats))
    cells = np.array([[*p, *[0] * (width - len(p))] for p in pats])
    use = (cells > 0).astype(float)
    size = len(counts)
    target = counts.astype(float)
    target[0] = 0
    degree = np.bincount(cells.ravel(), use.ravel(), minlength=size)
    rate = 1 / max(1.0, width * degree.max())
    x = y = np.zeros(len(pats))
    t = 1.0
    for _ in range(steps):
        rest = np.bincount(cells.ravel(), (use * y[:, None]).ravel(), minlength=size) - target
        new = np.maximum(0, y - rate * (rest[cells] * use).sum(1))
        t, last = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        y = new + (last - 1) / t * (new - x)
        x = new
    return x


def plan(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences), all pieces used; counts[n] pieces of length n."""
    left = [int(x) for x in counts]
    out = [((capacity,), left[capacity])] if left[capacity] else []
    left[capacity] = 0
    pats = patterns(counts, capacity)
    x = fit(counts, pats)
    for k in np.argsort(-x, kind="stable"):
        need = Counter(pats[k])
        n = min([int(x[k] + 1e-6), *(left[a] // m for a, m in need.items())])
        if n > 0:
            out.append((pats[k], n))
            for a, m in need.items():
                left[a] -= n * m
    return out + best_fit(left, capacity)


def best_fit(left: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts of equal lengths: open sequences are kept as (contents, how many) by free space."""
    open_by: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    free: list[int] = []  # sorted free spaces in use


    def put(space: int, contents: tuple[int, ...], n: int) -> None:
        if not open_by[space]:
            insort(free, space)
        open_by[space].append((contents, n))

    for size in range(capacity, 0, -1):
        n = left[size]
        while n:
            at = bisect_left(free, size)
            if at < len(free):
                space = free[at]
                contents, many = open_by[space].pop()
                if not open_by[space]:
                    free.pop(at)
                fits = space // size  # of this length in one such sequence
                if n >= fits * many:
                    put_n, each = many, fits
                else:
                    each = min(fits, n)
                    put_n = n // each
                if many > put_n:
                    put(space, contents, many - put_n)
                put(space - each * size, contents + (size,) * each, put_n)
                n -= put_n * each
            else:
                each = capacity // size
                if n >= each:
                    put(capacity - each * size, (size,) * each, n // each)
                    n %= each
                else:
                    put(capacity - n * size, (size,) * n, 1)
                    n = 0
    return [x for space in sorted(open_by) for x in open_by[space]]


def placements(planned: list[tuple[tuple[int, ...], int]], capacity: int) -> tuple[dict[int, tuple[np.ndarray, ...]], int]:
    """Per length: first ranks of its runs, their first sequences and offsets; and the number of sequences."""
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    used: Counter = Counter()
    sequences = 0
    for lengths, n in planned:
        offset = 0
        for size in lengths:
            runs[size].append((used[size], sequences, offset))
            used[size] += n
            offset += size
        sequences += n
    return {size: tuple(np.array(x, np.int64).T) for size, x in runs.items()}, sequences


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per piece: the id, piece, start, length, ids_crc32, sequence_id, offset (and ids if asked for).

    Every row of docs gives at least one piece: null and empty texts one of the closing id alone. Repeated rows are
    packed each. An empty table gives an empty one. Other columns of docs are not used. Sequences are gapless from 0.
    """
    spark = docs.sparkSession
    cut = materialize(pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, with_ids), "pieces")
    by_task = materialize(cut.groupBy("length", "task").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r.length] = r.n
    sent = spark.sparkContext.broadcast(placements(plan(counts, capacity), capacity)[0])

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = cut.join(first, ["length", "task"]).withColumn("rank", F.col("first") + F.col("rank_in_task"))
    names = [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
            order = np.argsort(size, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
                if len(rows):
                    starts, firsts, offsets = sent.value[int(size[rows[0]])]
                    run = np.searchsorted(starts, rank[rows], "right") - 1
                    sequence[rows], offset[rows] = firsts[run] + rank[rows] - starts[run], offsets[run]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset), *b.columns[6:]], names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long" + ", ids binary" * with_ids
    return ranked.select(id_col, "piece", "start", "length", "ids_crc32", "rank", *["ids"] * with_ids).mapInArrow(place, schema)
