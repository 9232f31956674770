"""Toxicity by noisy-channel deobfuscation (operator 1).

A character trigram model is counted over the whole corpus. Tokens that look disguised (letters mixed with leetspeak,
letters repeated, letters spaced out) become lattices of what each character may stand for; Viterbi decoding under the
model picks the likeliest path. The restored text is scored: words and word beginnings, and how often they occur, that the
labelled rows tie to toxic texts (a lexicon learned by likelihood ratio), their weights summed over the whole text, and a
logistic regression on those sums, which are taken with lexicons that did not see the text (folds). Tokens repeat, so each
worker keeps the features of those it met in a bounded memory.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices
from .linear import sample_of

#: The alphabet (0 is any other character), what a character may stand for, and marks around words.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâäåãæçèéêëìíîïñòóôöõøùúûüýÿßœ"
STANDS_FOR = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l"}
MARKS = ".,;:?\"'()[]{}<>%#*&_-~`/\\="
SYMBOLS = 64

#: Costs (natural logarithms) of the channel: a stand-in, a dropped sign or digit, a letter written more often than meant,
#: a spelled-out run that is more than one word, and a digit in one (there the model takes it for the end of a word).
STAND_IN, DROPPED, DROPPED_DIGIT, REPEATED, SPLIT, DIGIT_APART = -1.0, -4.0, -8.0, -0.5, -6.0, -4.0
#: Cost of one certain character of those that share the number 0 in the model: a digit (of ten), another letter (of many).
DIGIT, OTHER = -2.3, -4.6

NUMBER = {c: i for i, c in enumerate(LETTERS, 1)}
DISGUISED = re.compile(r"(?=.*[^\W\d_])(?=.*[0-9@$!|+€£])[\w@$!|+€£.*-]+$")
TRIPLE = re.compile(r"([^\W\d_])\1\1")
DOTTED = re.compile(r"[\w@$!|+](?:[.\-_*~/][\w@$!|+]){2,}$")
SPACED = re.compile(r"(?<!\S)[\w@$!|+](?: [\w@$!|+]){2,}(?!\S)")
DOUBLE = re.compile(r"(.)\1+")


def numbers_of(texts: list[str]) -> np.ndarray:
    """The texts, each between two zeros, as numbers of the alphabet."""
    codes = np.frombuffer("\0\0".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    table = np.zeros(0x180, np.int64)
    for c, i in NUMBER.items():
        table[ord(c)] = i
    return np.where(codes < 0x180, table[np.minimum(codes, 0x17F)], 0)


def character_model(docs: DataFrame, text_col: str) -> np.ndarray:
    """Log probabilities of a character after two others, (64**3,), counted over all texts and smoothed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for b in slices(batches):
            x = numbers_of([t.lower() for t in b.column(0).to_pylist() if t])
            total += np.bincount((x[:-2] * SYMBOLS + x[1:-1]) * SYMBOLS + x[2:], minlength=SYMBOLS**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])

    counts = docs.select(text_col).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()  # at most 64**3 rows
    n = np.zeros(SYMBOLS**3)
    n[counts.column(0).to_numpy()] = counts.column(1).to_numpy()
    n = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    pair = n.sum(0)  # of the last two characters
    back = (pair + 0.1) / (pair + 0.1).sum(1, keepdims=True)
    return np.log((n + 5 * back[None]) / (n.sum(2, keepdims=True) + 5)).ravel()


def as_written(c: str) -> float:
    """Cost of a character as it stands."""
    return 0.0 if c in NUMBER else DIGIT if c.isdigit() else OTHER


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each run of a character: the strings it may stand for, and their costs. Letters and digits may stand for themselves."""
    out = []
    for m in re.finditer(r"(.)\1*", token, re.S):
        c, n = m[1], len(m[0])
        options = []
        if c.isalpha():
            options.append((c, as_written(c) + REPEATED * (n > 1)))
            if n > 1:
                options.append((c + c, 2 * as_written(c) + REPEATED * (n > 2)))
        elif c.isdigit():
            options.append((m[0], n * DIGIT))
        for s in STANDS_FOR.get(c, ""):
            options += [(s, STAND_IN + REPEATED * (n > 1))] + [(s + s, STAND_IN + REPEATED * (n > 2))] * (n > 1)
        if not c.isalpha():
            options.append(("", DROPPED_DIGIT if c.isdigit() else DROPPED if c in STANDS_FOR else -0.1))
        out.append(options)
    return out


def with_breaks(options: list[list[tuple[str, float]]]) -> list[list[tuple[str, float]]]:
    """The options of a spelled-out run, where a word may end between any two characters."""
    out = []
    for i, step in enumerate(options):
        step = [(s, c + DIGIT_APART * s.isdigit()) for s, c in step]
        inner = [*step, *((s[0] + " " + s[1:], c) for s, c in step if len(s) == 2)]
        out.append(inner + [(" " + s, c) for s, c in inner if s] * (i > 0))
    return out


def best_path(options: list[list[tuple[str, float]]], model: list[float]) -> tuple[float, str]:
    """Score and letters of the likeliest path of a lattice under the trigram model, word edges included."""
    best, back = {(0, 0): 0.0}, []
    for step in options:
        new: dict[tuple[int, int], float] = {}
        came: dict[tuple[int, int], tuple[tuple[int, int], str]] = {}
        for state, score in best.items():
            for letters, cost in step:
                (a, b), s = state, score + cost
                for c in letters:
                    k = NUMBER.get(c, 0)
                    s += model[(a * SYMBOLS + b) * SYMBOLS + k]
                    a, b = b, k
                if (a, b) not in new or new[a, b] < s:
                    new[a, b], came[a, b] = s, (state, letters)
        best = new
        back.append(came)
    score, state = max((s + model[(a * SYMBOLS + b) * SYMBOLS], (a, b)) for (a, b), s in best.items())
    out = []
    for came in reversed(back):
        state, letters = came[state]
        out.append(letters)
    return score, "".join(reversed(out))


def viterbi(token: str, model: list[float]) -> str:
    """The likeliest letters behind a token."""
    return best_path(lattice(token), model)[1]


def parts_of(word: str) -> list[str]:
    """A word's features: itself and its beginnings of five and six letters (marked with ^)."""
    return [word, *("^" + word[:n] for n in (5, 6) if len(word) > n)]


class Restorer:
    """Undoes disguises; `known` limits which doubled letters are worth decoding."""

    def __init__(self, model: np.ndarray, known: frozenset[str] = frozenset()):
        self.model = model.tolist()
        self.single = {DOUBLE.sub(r"\1", x.lstrip("^")) for x in known}

    def token(self, token: str) -> str:
        word = token.strip(MARKS)
        if word.isalpha():
            if TRIPLE.search(word) or self.single and DOUBLE.search(word) and DOUBLE.sub(r"\1", word) in self.single:
                return viterbi(word, self.model)
            return word
        if len(word) > 2 and (DOTTED.match(word) or DISGUISED.match(word)):
            return viterbi(re.sub(r"[.\-_*~/]", "", word), self.model)
        return word

    def spaced(self, run: str) -> str:
        """Single characters with a space between each: one word, or several if that is likelier by enough."""
        if not any(map(str.isalpha, run)):
            return run
        options = lattice(run.replace(" ", ""))
        one, several = best_path(options, self.model), best_path(with_breaks(options), self.model)
        return several[1] if several[0] + SPLIT > one[0] else one[1]

    def text(self, text: str) -> list[str]:
        """The words of the restored text."""
        return [self.token(x) for x in SPACED.sub(lambda m: self.spaced(m[0]), text.lower()).split()]


#: A feature may count for a text that has it so often.
LEVELS = (1, 2, 3, 4)


class Features(dict):
    """Token -> the lexicon's features of the word behind it."""

    def __init__(self, restorer: Restorer, lexicon: dict[str, float], most: int = 500_000):
        super().__init__()
        self.restorer, self.most = restorer, most
        self.levels: dict[str, list[tuple[int, float]]] = {}
        for key, w in lexicon.items():
            f, _, n = key.rpartition(" ")
            self.levels.setdefault(f, []).append((int(n), w))

    def __missing__(self, token: str) -> tuple[str, ...]:
        found = tuple(f for f in parts_of(self.restorer.token(token)) if f in self.levels)
        if len(self) >= self.most:
            self.clear()
        self[token] = found
        return found

    def sums(self, text: str) -> tuple[float, ...]:
        """Of a whole text: 1, log of the summed weights, the largest weight, and whether there are any."""
        text = text.lower()
        if SPACED.search(text):
            text = SPACED.sub(lambda m: self.restorer.spaced(m[0]), text)
        often = Counter(chain.from_iterable(map(self.__getitem__, text.split())))
        weights = [w for f, n in often.items() for level, w in self.levels[f] if n >= level]
        return 1.0, math.log1p(sum(weights)), max(weights, default=0.0), float(bool(weights))


def likelihood_ratio(a: int, b: int, all_a: int, all_b: int) -> float:
    """Statistic of the difference between a of all_a and b of all_b."""
    part = lambda k, n: k * math.log(k / n) if k else 0.0
    n = all_a + all_b
    return 2 * (part(a, (a + b) * all_a / n) + part(b, (a + b) * all_b / n) + part(all_a - a, (n - a - b) * all_a / n) + part(all_b - b, (n - a - b) * all_b / n))


def lexicons_of(rows: DataFrame, model: np.ndarray, folds: int, least: float = 9.0, least_texts: int = 3) -> list[dict[str, float]]:
    """Log odds of features ("word 1", "^begin 2": that often at least) that toxic rows (text, toxic, fold) hold more than others do.

    Kept are those in `least_texts` toxic texts with a likelihood ratio of `least`. One lexicon for each fold, without its
    rows, and then that of all rows.
    """
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, counts = Restorer(sent.value), {}
        for b in slices(batches):
            for text, toxic, fold in zip(*(c.to_pylist() for c in b.columns), strict=True):
                often = Counter(f for w in restorer.text(text or "") for f in parts_of(w))
                counts.setdefault((toxic, fold), Counter()).update([f"{f} {n}" for f, m in often.items() for n in LEVELS if m >= n] + [""])
        for (toxic, fold), c in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array([2 * fold + toxic] * len(c), pa.int32()), pa.array(list(c.values()), pa.int64())], ["f", "k", "n"])

    sums = rows.select("text", "toxic", "fold").mapInArrow(run, "f string, k int, n long").groupBy("f").agg(*(F.sum(F.when(F.col("k") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(2 * folds)))
    sums = sums.where((sum((F.col(f"n{2 * k + 1}") for k in range(folds)), F.lit(0)) >= least_texts) | (F.col("f") == ""))
    got = {r[0]: np.array(r[1:]).reshape(folds, 2) for r in sums.collect()}  # bounded as the sample is
    every = got.pop("", np.zeros((folds, 2), int))
    out = []
    for left_out in [*range(folds), None]:
        use = np.array([k != left_out for k in range(folds)])
        all_b, all_a = every[use].sum(0).tolist()
        lexicon = {}
        for f, n in got.items():
            b, a = n[use].sum(0).tolist()
            if a >= least_texts and a * all_b > b * all_a and likelihood_ratio(a, b, all_a, all_b) >= least:
                lexicon[f] = math.log((a + 0.5) / (all_a + 1) / ((b + 0.5) / (all_b + 1)))
        out.append(lexicon)
    return out


#: What the regression on a text's sums begins from: few labels move it little, many decide it.
PRIOR = np.array([-4.0, 2.5, 1.0, -5.0])


def regression(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, prior: np.ndarray = PRIOR) -> np.ndarray:
    """Coefficients of a logistic regression with a few columns, drawn towards a prior, by damped Newton steps."""
    c = prior.copy()
    for _ in range(80):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(c)), x.T @ (p - y) + ridge * (c - prior))
        c -= step * min(1.0, 4 / max(abs(step).max(), 1e-9))
        if abs(step).max() < 1e-6:
            break
    return c


def score(docs: DataFrame, labels: DataFrame, trainable: Column, id_col: str = "doc_id", text_col: str = "text", bound: int = 6000, threshold: float = 0.7, folds: int = 4) -> DataFrame:
    """Per row: the id, held_out (not trainable), score (0 to 1), predicted (1 if score >= threshold).

    labels (id_col, toxic): about `bound` labelled rows at most whose id is trainable are learned from, chosen by a hash
    of the id; equal texts are one (toxic if one of them is). Null texts count as empty; without labels of both classes all
    scores are 0. Repeated rows stay; an empty table gives an empty one; other columns are not used.
    """
    context = docs.sparkSession.sparkContext
    known = labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & trainable).groupBy(id_col).agg(F.max("toxic").alias("toxic"))
    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(sample_of(known, id_col, bound)), id_col)  # broadcast: at most about `bound` ids
    rows = rows.groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    rows = materialize(rows.select("text", "toxic", F.pmod("h", F.lit(folds)).cast("int").alias("fold")), "labelled")
    model = character_model(docs, text_col)
    lexicons = lexicons_of(rows, model, folds)
    sent = context.broadcast((model, lexicons))

    def features(k: int) -> Features:
        lexicon = sent.value[1][k]
        return Features(Restorer(sent.value[0], frozenset(f.rpartition(" ")[0] for f in lexicon)), lexicon)

    def unseen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of labelled texts, with the lexicon of the other folds."""
        by_fold = [features(k) for k in range(folds)]
        for b in slices(batches):
            x = [by_fold[k].sums(t) for t, k in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(1)], ["x", "toxic"])

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = features(folds)
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array([whole.sums(t or "") for t in b.column(0).to_pylist()], pa.list_(pa.float64())), *b.columns[1:]], ["x", *b.schema.names[1:]])

    got = rows.mapInArrow(unseen, "x array<double>, toxic int").toArrow()
    x, y = np.array(got.column(0).to_pylist() or np.zeros((0, 4))), np.array(got.column(1).to_pylist(), float)
    c = regression(x, y) if 0 < y.sum() < len(y) else np.array([-40.0, 0, 0, 0])
    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("id"), (~trainable).alias("held_out")).mapInArrow(sums, f"x array<double>, id {kind}, held_out boolean")
    z = sum((F.col("x")[i] * float(w) for i, w in enumerate(c)), F.lit(0.0))
    out = out.select(F.col("id").alias(id_col), "held_out", (1 / (1 + F.exp(-z))).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
