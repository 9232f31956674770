"""Language identification with error-correcting output codes (operator 9).

Each learned language has a codeword of bits; one logistic regression on hashed byte 1- to 3-grams of the lower-cased text
predicts each bit. Decoding adds up each bit's logistic loss against a codeword, weighted by the bit's held-out
accuracy, and takes the codeword of least loss; a small lead over the runner-up is flagged as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices
from .linear import BITS, byte_ngrams, hashed, logistics, sparse_sample, unit

UNKNOWN = "und"


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """(n, bits) of -1 and 1: all splits of up to 5 languages in two; beyond, the best of random codes of 15 log2(n) bits."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 5:
        return np.array([(1, *x) for x in product((-1, 1), repeat=n - 1) if -1 in x], float).T
    rng, best, most = np.random.default_rng(seed), None, -1
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, int(np.ceil(15 * np.log2(n)))))
        code = code[:, abs(code.sum(0)) < n]
        apart = (code.shape[1] - code @ code.T)[~np.eye(n, dtype=bool)].min()
        if apart > most:
            best, most = code, apart
    return best


def features(texts: list[bytes]) -> np.ndarray:
    return unit(byte_ngrams([x.decode("utf-8", "replace").lower().encode() for x in texts], (1, 2, 3)))


def train(docs: DataFrame, trainable: Column, id_col: str, text_col: str, lang_col: str, bound: int) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Languages, codewords, weights (features, bits), intercepts, and the bits' weights in decoding."""
    rows = docs.where(trainable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(id_col, text_col, lang_col)
    sizes = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}  # one row a language
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((0, 1)), np.zeros((1 << BITS, 1)), np.zeros(1), np.ones(1)
    each = max(1, bound // len(langs))
    share = F.create_map(*(F.lit(x) for k in langs for x in (k, min(1.0, each / sizes[k]))))
    rows = rows.where(hashed(id_col) <= share[F.col(lang_col)]).withColumn("_fold", F.pmod(F.xxhash64(text_col), F.lit(5)))  # copies stay together
    row, col, x, got = sparse_sample(rows, features, [lang_col, "_fold"], text_col)
    of = np.array([langs.index(k) for k in got[lang_col]], np.int64)
    code = codewords(len(langs))
    share_of = 1 / np.maximum(np.bincount(of, minlength=len(langs)), 1)
    test = np.array(got["_fold"], np.int64) == 0
    y = (code[of] > 0).astype(np.float32)
    w, b = logistics(row, col, x, y, np.where(test, 0, share_of[of]), 1 << BITS, steps=80, rate=8)
    z = np.stack([np.bincount(row, x * w[col, k], minlength=len(of)) for k in range(code.shape[1])], 1) + b
    right = ((z > 0) == (y > 0))[test]
    held = (right.sum(0) + 1) / (len(right) + 2)  # held-out accuracy of each bit
    trust = np.maximum(0.0, np.log(held / (1 - held)))
    if not trust.any():  # no bit is better than chance on what it did not see: all count alike
        trust = np.ones(len(trust))
    return langs, code, w, b, trust / trust.sum()


def decode(z: np.ndarray, code: np.ndarray, trust: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of bit margins: the nearest codeword, its share of exp(-loss), and its lead in loss over the next."""
    loss = (np.logaddexp(0, -z[:, None, :] * code[None]) * trust).sum(2)
    order = np.argsort(loss, axis=1, kind="stable")
    e = np.exp(-(loss - loss.min(1, keepdims=True)) * code.shape[1])
    first = order[:, 0]
    at = np.arange(len(z))
    lead = loss[at, order[:, 1]] - loss[at, first] if code.shape[0] > 1 else np.ones(len(z))
    return first, e[at, first] / e.sum(1), lead


def identify(docs: DataFrame, trainable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", bound: int = 3000, ambiguous_under: float = 0.1) -> DataFrame:
    """Per row: the id, lang_pred, score (0 to 1), ambiguous, held_out (not trainable).

    Learns from rows where `trainable` holds and text and language are not null: about `bound` at most, equally many of
    each language, chosen by a hash of the id. Null texts and texts without a letter are `und` with score 0 and not
    ambiguous, as is every text if nothing could be learned. Repeated rows stay; an empty table gives an empty one.
    """
    langs, code, w, b, trust = train(docs, trainable, id_col, text_col, lang_col, bound)
    sent = docs.sparkSession.sparkContext.broadcast((langs, code, w.astype(np.float32), b, trust))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, code, w, b, trust = sent.value
        for part in slices(batches, 32):
            first, score, lead = decode(features([x or b"" for x in part.column(2).to_pylist()]) @ w + b, code, trust)
            none = part.column(2).is_null().to_numpy(False)
            names = pa.array([UNKNOWN if x else langs[i] for i, x in zip(first, none, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), names, pa.array(np.where(none, 0, score)), pa.array(~none & (lead < ambiguous_under))], ["id", "held_out", "lang_pred", "score", "ambiguous"])

    kind = docs.schema[id_col].dataType.simpleString()
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), (~trainable).alias("held_out"), F.when(letters, F.col(text_col)).cast("binary").alias("t"))
    schema = f"id {kind}, held_out boolean, lang_pred string, score double, ambiguous boolean"
    if langs:
        out = rows.mapInArrow(run, schema)
    else:
        out = rows.select("id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("ambiguous"))
    return out.select(F.col("id").alias(id_col), "held_out", "lang_pred", "score", "ambiguous")

