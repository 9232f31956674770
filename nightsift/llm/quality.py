"""Quality rules with a trained verdict (operator 6).

Fixed base rules on words, lines and repeated three-word windows; what passes them is judged by a logistic regression on
hashed word 1- and 2-grams and character 3-grams, trained on labelled quality rows, calibrated on margins of rows that a fit
did not see (four folds), and held against a fixed threshold. One narrow pass in Arrow batches; no shuffle of texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, slices, text_unless, texts_of, whole_row
from .linear import BITS, calibrated, character_ngrams, sample_of, sparse_sample, unit, word_ngrams

#: Fixed values.
SYMBOLS = b"#*$%&|<>"
NOT_IN_WORDS = b" \t\n\v\f\r" + bytes(range(0x80, 0xC0))  # white space, and continuation bytes, which start no code point


def features(texts: list[bytes]) -> np.ndarray:
    """Hashed character 3-grams beside hashed word 1- and 2-grams, each part of length 1."""
    return np.concatenate([unit(character_ngrams(texts, (3,))), unit(word_ngrams([x.split() for x in texts]))], axis=1)


def rules(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\v\f\r")]
    n = len(words)
    repeated = 0
    if n > 3:
        numbers: dict[bytes, int] = {}
        w = np.fromiter((numbers.setdefault(x, len(numbers)) for x in words), np.int64, n)
        pairs = np.unique(w[:-1] * len(numbers) + w[1:], return_inverse=True)[1]
        window = pairs[:-1] * len(numbers) + w[2:]
        _, of, count = np.unique(window, return_inverse=True, return_counts=True)
        twice = count[of] > 1
        covered = np.zeros(n, bool)
        for i in range(3):
            covered[i : n - 2 + i] |= twice
        repeated = int(covered.sum())
    return n, len(text.translate(None, NOT_IN_WORDS)), len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, bound: int, folds: int = 4) -> tuple[np.ndarray, float]:
    """Weights and intercept of the calibrated log odds that a text is of low quality.

    Where labels give none (one class alone, or held-out margins that do not tell the classes apart) they are such that
    nothing is rejected.
    """
    known = labels.where("quality is not null").groupBy(id_col).agg(F.max("quality").alias("quality"))
    known = sample_of(known.where(F.col(id_col).isNotNull()), id_col, bound)
    rows = docs.select(id_col, text_col).join(F.broadcast(known), id_col).withColumn("fold", crc_mod(id_col, folds))  # broadcast: at most about `bound` ids
    row, col, x, got = sparse_sample(rows, features, ["quality", "fold"], text_col)
    width = 2 << BITS
    fit = calibrated(row, col, x, 1.0 - np.array(got["quality"], float), np.array(got["fold"]), width)
    return fit or (np.zeros(width), -9.0)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = 3000, reject: float = 0.7, least_words: int = 50, keep: bool = False) -> DataFrame:
    """Per row: the id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, p_low; with keep also row, a struct of all columns.

    labels (id_col, quality): 1 good, 0 low; about `bound` labelled rows at most are used for training, chosen by a hash
    of the id. base_failed: under least_words words, or over half of them in repeated windows. kept: not base_failed and
    p_low < reject. Null and empty texts have no words and fail; repeated rows stay. Where labels do not tell the classes
    apart (few rows, one class alone) the base rules decide alone, and p_low is near 0. An empty table gives an empty one.
    """
    w, b = train(docs, labels, id_col, text_col, bound)
    sent = docs.sparkSession.sparkContext.broadcast((w.astype(np.float32), b))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    names = ["id", *counts, "p_low", "row"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, add = sent.value
        for part in slices(batches, 16):
            texts = texts_of(part, "t", "row", text_col if keep else None)
            z = features(texts) @ weights + add
            cols = np.array([rules(x) for x in texts], np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, cols), pa.array((1 / (1 + np.exp(-np.clip(z, -30, 30)))).astype(float)), part.column(2)], names)

    rows = docs.select(F.col(id_col).alias("id"), text_unless(docs, text_col, keep).alias("t"), whole_row(docs, keep).alias("row"))
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("id", "row")}
    out = rows.mapInArrow(run, f"id {kinds['id']}, {', '.join(f'{c} long' for c in counts)}, p_low double, row {kinds['row']}")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("p_low") < reject))
    return out.select(F.col("id").alias(id_col), *counts, "base_failed", "kept", "p_low", *["row"] * keep)
