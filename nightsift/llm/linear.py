"""Hashed n-gram features and logistic regression for the classifiers of this subpackage.

A model is fitted on the driver, on a sample whose size is a bounded parameter; scoring runs in Arrow batches.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

BITS = 14


def codes_ngrams(texts: list[np.ndarray], sizes: tuple[int, ...], bits: int = BITS, block: int = 1 << 19) -> np.ndarray:
    """(texts, 2**bits) counts of hashed n-grams of numbers (bytes, or code points); none reaches over the end of a text.

    `block` numbers are hashed at a time, so memory does not grow with the texts' length.
    """
    out = np.zeros(len(texts) << bits, np.float32)
    ends = np.cumsum([len(x) for x in texts])
    data = np.concatenate(texts) if texts else np.zeros(0, np.uint32)
    for at in range(0, len(data), block):
        for n in sizes:
            part = data[at : at + block + n - 1].astype(np.uint32)
            if len(part) < n:
                continue
            h = np.full(len(part) - n + 1, n, np.uint32)
            for i in range(n):
                h = (h ^ part[i : len(h) + i]) * np.uint32(0x01000193)
                h ^= h >> np.uint32(15)
            first = at + np.arange(len(h))
            row = np.searchsorted(ends, first, "right")
            inside = first + n <= ends[row]
            cell = (row[inside] << bits) + (h[inside] >> np.uint32(32 - bits)).astype(np.int64)
            out += np.bincount(cell, minlength=len(out)).astype(np.float32)
    return out.reshape(len(texts), -1)


def byte_ngrams(texts: list[bytes], sizes: tuple[int, ...], bits: int = BITS) -> np.ndarray:
    """Counts of hashed byte n-grams."""
    return codes_ngrams([np.frombuffer(x, np.uint8) for x in texts], sizes, bits)


def character_ngrams(texts: list[bytes], sizes: tuple[int, ...], bits: int = BITS) -> np.ndarray:
    """Counts of hashed n-grams of the code points of UTF-8 texts."""
    return codes_ngrams([np.frombuffer(x.decode("utf-8", "replace").encode("utf-32-le"), "<u4") for x in texts], sizes, bits)


def word_ngrams(words: list[list[bytes]], sizes: tuple[int, ...] = (1, 2), bits: int = BITS) -> np.ndarray:
    """Counts of hashed n-grams of the words of texts."""
    return codes_ngrams([np.fromiter(map(zlib.crc32, x), np.uint32, len(x)) for x in words], sizes, bits)


def unit(counts: np.ndarray) -> np.ndarray:
    """Square roots of counts, each row scaled to length 1 (rows of zeros stay)."""
    x = np.sqrt(counts)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    return x


def sample_of(rows: DataFrame, id_col: str, bound: int) -> DataFrame:
    """About `bound` rows at most, chosen by a hash of the id: all rows of an id or none, the same in every run."""
    share = min(1.0, bound / max(1, rows.count()))
    return rows if share >= 1 else rows.where(hashed(id_col) < share)


def hashed(id_col: str) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_003)) / 1_000_003


def sparse_sample(rows: DataFrame, features: Callable[[list[bytes]], np.ndarray], labels: list[str], text_col: str = "text") -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, list]]:
    """Computes features in the tasks and brings the bounded sample to the driver: row, column, value, labels."""
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in labels)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 16):
            x = features([t or b"" for t in b.column(0).to_pylist()])
            at = [np.flatnonzero(r) for r in x]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.list_(pa.int32())), pa.array([r[i] for r, i in zip(x, at, strict=True)], pa.list_(pa.float32())), *b.columns[1:]], ["at", "x", *labels])

    got = rows.select(F.col(text_col).cast("binary").alias("t"), *labels).mapInArrow(run, f"at array<int>, x array<float>, {kinds}").toArrow()
    if not got.num_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32), {c: [] for c in labels}
    at, x = (got.column(c).combine_chunks() for c in ("at", "x"))
    row = np.repeat(np.arange(got.num_rows), at.value_lengths().to_numpy())
    return row, at.flatten().to_numpy(), x.flatten().to_numpy(), {c: got.column(c).to_pylist() for c in labels}


def minimize(f: Callable[[np.ndarray], tuple[float, np.ndarray]], at: np.ndarray, steps: int, tolerance: float = 1e-5, memory: int = 8) -> np.ndarray:
    """A minimum of a smooth convex function (value and gradient) by a quasi-Newton method with a line search.

    A step is taken only where the value falls, so no run leaves what it started from for something worse.
    """
    value, g = f(at)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if not np.isfinite(value) or np.abs(g).max() < tolerance:
            break
        d, back = -g, []
        for s, y in reversed(pairs):
            back.append(s @ d / (s @ y))
            d = d - back[-1] * y
        if pairs:
            d = d * (pairs[-1][0] @ pairs[-1][1] / (pairs[-1][1] @ pairs[-1][1]))
        for (s, y), a in zip(pairs, reversed(back), strict=True):
            d = d + (a - y @ d / (s @ y)) * s
        slope = g @ d
        if slope >= 0:
            d, slope, pairs = -g, -(g @ g), []
        size = 1.0
        for _ in range(40):
            new = at + size * d
            new_value, new_g = f(new)
            if new_value <= value + 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        s, y = new - at, new_g - g
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y)][-memory:]
        at, value, g = new, new_value, new_g
    return at


def logistic(row: np.ndarray, col: np.ndarray, x: np.ndarray, y: np.ndarray, weight: np.ndarray, width: int, steps: int = 60, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression over sparse rows, in order; decay: of the squared weights, which keeps them finite."""
    share = weight / max(weight.sum(), 1e-12)
    n = np.bincount(row, minlength=len(y))
    begins = (np.cumsum(n) - n)[n > 0]

    def loss(at: np.ndarray) -> tuple[float, np.ndarray]:
        w = at[:-1]
        z = np.full(len(y), at[-1])
        if len(begins):
            z[n > 0] += np.add.reduceat(x * w[col], begins)
        g = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) * share
        value = (share * (np.logaddexp(0, z) - y * z)).sum() + decay / 2 * (w @ w)
        return value, np.r_[np.bincount(col, x * np.repeat(g, n), minlength=width) + decay * w, g.sum()]

    at = minimize(loss, np.zeros(width + 1), steps, 1e-6)
    return at[:-1], float(at[-1])


def logistics(row: np.ndarray, col: np.ndarray, x: np.ndarray, y: np.ndarray, weight: np.ndarray, width: int, steps: int = 150, rate: float = 4.0, decay: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """The same for several outputs at once, y (rows, outputs): weights (width, outputs) and intercepts.

    Rows become one dense matrix over the columns that occur (rows times columns numbers of 4 bytes), so that a step is two
    matrix products for all outputs.
    """
    used, at = np.unique(col, return_inverse=True)
    dense = np.zeros((len(y), len(used)), np.float32)
    dense[row, at] = x
    share = (weight / max(weight.sum(), 1e-12)).astype(np.float32)[:, None]
    w, b = np.zeros((len(used), y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    vw, vb, t = w, b, 1.0
    for _ in range(steps):
        g = (1 / (1 + np.exp(-np.clip(dense @ vw + vb, -30, 30))) - y).astype(np.float32) * share
        new, newb = vw - np.float32(rate) * (dense.T @ g + np.float32(decay) * vw), vb - np.float32(rate) * g.sum(0)
        t, last = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        more = np.float32((last - 1) / t)
        vw, vb = new + more * (new - w), newb + more * (newb - b)
        w, b = new, newb
    out = np.zeros((width, y.shape[1]))
    out[used] = w
    return out, b.astype(float)


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float] | None:
    """Slope and intercept that make sigmoid(slope * z + intercept) a probability of y, with Platt's soft targets.

    None where there are not both classes, or where larger margins do not mean likelier ones.
    """
    pos, neg = y.sum(), len(y) - y.sum()
    if not pos or not neg or not np.isfinite(z).all():
        return None
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = z.std() or 1.0

    def loss(at: np.ndarray) -> tuple[float, np.ndarray]:
        m = at[0] * z / scale + at[1]
        g = 1 / (1 + np.exp(-np.clip(m, -500, 500))) - target
        return (np.logaddexp(0, m) - target * m).mean() + 1e-6 / 2 * at[0] ** 2, np.array([(g * z).mean() / scale + 1e-6 * at[0], g.mean()])

    a, c = minimize(loss, np.array([0.0, np.log((pos + 1) / (neg + 1))]), 200, 1e-9)
    return (float(a / scale), float(c)) if a > 0 and np.isfinite([a, c]).all() else None


def calibrated(row: np.ndarray, col: np.ndarray, x: np.ndarray, y: np.ndarray, fold: np.ndarray, width: int, **fit: float) -> tuple[np.ndarray, float] | None:
    """Weights and intercept of calibrated log odds: fitted on all rows; slope and intercept from margins of rows whose fold was left out.

    Every row is held out once, so few labels still give both classes. Folds without which a class is missing give none.
    None where no calibration can be had.
    """
    z, out = np.zeros(len(y)), np.zeros(len(y), bool)
    for k in np.unique(fold):
        test = fold == k
        if 0 < y[~test].sum() < (~test).sum():
            w, b = logistic(row, col, x, y, (~test).astype(float), width, **fit)
            z[test] = np.bincount(row, x * w[col], minlength=len(y))[test] + b
            out |= test
    line = platt(z[out], y[out])
    if line is None:
        return None
    w, b = logistic(row, col, x, y, np.ones(len(y)), width, **fit)
    return line[0] * w, line[0] * b + line[1]
