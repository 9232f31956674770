"""Disguises of any length and density are undone."""

from collections import Counter
from itertools import product
from random import Random

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightsift.llm import toxicity
from nightsift.llm.toxicity import NUMBER, SYMBOLS, Restorer, best_path, lattice, numbers_of, with_breaks


TEXT = "you are a stupid idiot and this is shit so go away from here and never come back to this place again you idiot ( 1985 , 22 - 333 ) in the 1990s "


def restorer_of(text):
    x = numbers_of([text])
    n = np.bincount((x[:-2] * SYMBOLS + x[1:-1]) * SYMBOLS + x[2:], minlength=SYMBOLS**3).reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    pair = n.sum(0)
    back = (pair + 0.1) / (pair + 0.1).sum(1, keepdims=True)
    return Restorer(np.log((n + 5 * back[None]) / (n.sum(2, keepdims=True) + 5)).ravel())


@pytest.fixture(scope="module")
def restorer():
    return restorer_of(TEXT * 200)


@pytest.mark.parametrize(
    ("written", "meant"),
    [
        ("st" + "u" * 40 + "pid", ["stupid"]),
        ("st" + "u" * 5000 + "pid", ["stupid"]),
        ("1d" + "1" * 20 + "o" * 20 + "t", ["idiot"]),
        ("1d10t", ["idiot"]),
        ("5h17", ["shit"]),
        (" ".join("youareastupididiotandthisisshit"), "you are a stupid idiot and this is shit".split()),
        (" ".join("y0uar3astup1d1d10tandth1s1ssh1t"), "you are a stupid idiot and this is shit".split()),
        (" ".join("kretin"), ["kretin"]),
    ],
)
def test_forms(restorer, written, meant):
    assert restorer.text(written) == meant


def test_numbers_stay(restorer):
    assert restorer.text("2026-05-12 12345") == ["2026-05-12", "12345"]


@pytest.mark.parametrize(
    ("written", "meant"),
    [
        ("привееет", {"привет", "привеет"}),
        ("日日日本", {"日本", "日日本"}),
        ("słłłowo", {"słowo", "słłowo"}),
        ("covid19", {"covid19"}),
        ("i" + "d" * 20 + "i" * 20 + "o" * 10 + "t" * 9, {"idiot"}),
        ("5" + "t" * 15 + "u" * 15 + "p" * 15 + "1" * 6 + "d" * 9, {"stupid", "5tupid"}),
    ],
)
def test_no_letter_is_lost(restorer, written, meant):
    """Letters and digits of any script may stand for themselves; disguises of 60 characters are decoded."""
    (got,) = restorer.text(written)
    assert got in meant


def test_digits_after_known_words_stay():
    """Where the corpus has words that digits follow, a digit stands for itself."""
    r = restorer_of((TEXT + "an mp3 file, an mp4 file, mp 3 files ") * 200)
    assert r.text("mp3 mp4 1d10t") == ["mp3", "mp4", "idiot"]


def test_viterbi_is_exact(restorer):
    """The best path is the best of all paths, also where words may end between characters."""
    model, r = restorer.model, Random(4)

    def score(strings, costs):
        x = [0, 0, *(NUMBER.get(c, 0) for s in strings for c in s), 0]
        return sum(costs) + sum(model[(a * SYMBOLS + b) * SYMBOLS + c] for a, b, c in zip(x, x[1:], x[2:], strict=False))

    for _ in range(40):
        token = "".join(r.choices("stupid1053@aaooł日", k=r.randint(1, 5)))
        for options in (lattice(token), with_breaks(lattice(token))):
            paths = [([s for s, _ in p], [c for _, c in p]) for p in product(*options)]
            best, text = best_path(options, model)
            assert abs(best - max(score(*p) for p in paths)) < 1e-9
            assert abs(best - max(score(*p) for p in paths if "".join(p[0]) == text)) < 1e-9


def test_lexicon_and_model_are_recounted(spark):
    r = Random(8)
    words = ["".join(r.choices("abcdefgh", k=5)) for _ in range(30)]
    rows = [(" ".join(r.choices(words, k=12)) + (" zorgul" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(90)]
    df = spark.createDataFrame(rows, "text string, toxic int").repartition(3)
    model = toxicity.character_model(df, "text")
    counts = Counter()
    for t, _ in rows:
        x = [0, *(NUMBER.get(c, 0) for c in t), 0]
        counts.update(zip([0, *x], x, [*x[1:], 0], strict=False))
    folds = [(t, toxic, i % 4) for i, (t, toxic) in enumerate(rows)]
    lexicons = toxicity.lexicons_of(spark.createDataFrame(folds, "text string, toxic int, fold int").repartition(3), model, 4)
    for k, lexicon in enumerate(lexicons):  # recounted by a plain loop, each without its fold
        seen = [(Counter(f for w in t.split() for f in toxicity.parts_of(w)), toxic) for t, toxic, fold in folds if fold != k]
        n = [sum(toxic == c for _, toxic in seen) for c in (0, 1)]
        want = {}
        for f in {f for often, _ in seen for f in often}:
            for level in toxicity.LEVELS:
                b, a = (sum(often[f] >= level for often, toxic in seen if toxic == c) for c in (0, 1))
                if a >= 3 and a * n[0] > b * n[1] and toxicity.likelihood_ratio(a, b, n[1], n[0]) >= 9:
                    want[f"{f} {level}"] = np.log((a + 0.5) / (n[1] + 1) / ((b + 0.5) / (n[0] + 1)))
        assert lexicon.keys() == want.keys() and np.allclose([lexicon[f] for f in want], list(want.values()))
        assert {"zorgul 1", "^zorgu 1"} <= lexicon.keys()
    both = (counts[1, 2, 3], sum(n for (a, b, _), n in counts.items() if (a, b) == (1, 2)))
    pair = Counter()
    for (_, b, c), n in counts.items():
        pair[b, c] += n
    back = (pair[2, 3] + 0.1) / (sum(n for (b, _), n in pair.items() if b == 2) + 0.1 * SYMBOLS)
    assert abs(model[(1 * SYMBOLS + 2) * SYMBOLS + 3] - np.log((both[0] + 5 * back) / (both[1] + 5))) < 1e-9


def test_null_and_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a b c d " * 3), (3, "a b c d " * 3), (None, "x")], "doc_id long, text string").withColumn("toxic", F.lit("clash")).withColumn("x", F.lit(1))
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score(docs, labels, F.lit(True)).collect()
    assert len(got) == 5 and all(0 <= g.score <= 1 for g in got)
