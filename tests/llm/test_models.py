"""Verdicts and decoding against plain loops; long texts in one batch; pipeline stages on odd rows."""

import math
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from nightsift.llm import language, linear, packing, quality, secrets, simhash, token_counts, toxicity
from nightsift.llm.common import crc_mod
from tests.llm.test_operators import BYTE_BPE, WORD_BPE, prose, rows

GOOD = [(i, prose(120, i)) for i in range(50)]
BAD = [(100 + i, prose(120, 500 + i).upper() + "!!") for i in range(40)]


def bucket(numbers):
    h = len(numbers)
    for x in numbers:
        h = ((h ^ x) * 0x01000193) & 0xFFFFFFFF
        h ^= h >> 15
    return h >> (32 - linear.BITS)


def ngrams(numbers, sizes):
    out = [0.0] * (1 << linear.BITS)
    for n in sizes:
        for i in range(len(numbers) - n + 1):
            out[bucket(numbers[i : i + n])] += 1
    root = [math.sqrt(x) for x in out]
    length = math.sqrt(sum(x * x for x in root))
    return [x / length if length else 0.0 for x in root]


def test_quality_verdict(spark):
    """p_low and kept, recomputed feature by feature from the trained weights."""
    odd = [(200, None), (201, ""), (202, "é ß " * 30), (203, "one"), (204, prose(60, 3) + " 日本 $$$")]
    df = spark.createDataFrame(GOOD + BAD + odd, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in GOOD + BAD], "doc_id long, quality int").where("doc_id % 2 = 0")
    w, b = quality.train(df, labels, "doc_id", "text", 3000)
    got = {r.doc_id: r for r in quality.judge(df, labels).collect()}
    for i, t in [*GOOD[:6], *BAD[:6], *odd]:
        x = ngrams([ord(c) for c in t or ""], (3,)) + ngrams([zlib.crc32(v) for v in (t or "").encode().split()], (1, 2))
        z = sum(a * c for a, c in zip(x, w, strict=True)) + b
        p = 1 / (1 + math.exp(-max(-30, min(30, z))))
        assert got[i].p_low == pytest.approx(p, abs=1e-4) and got[i].kept == (not got[i].base_failed and got[i].p_low < 0.7)


def test_decoding(spark):
    """The nearest codeword, by plain loops over codewords and bits."""
    r = np.random.default_rng(3)
    for n in (2, 3, 5, 9):
        code = language.codewords(n)
        z, trust = r.normal(0, 3, (40, code.shape[1])), r.random(code.shape[1])
        trust /= trust.sum()
        first, share, lead = language.decode(z, code, trust)
        for i in range(40):
            loss = [sum(t * math.log1p(math.exp(-margin * bit)) for t, margin, bit in zip(trust, z[i], word, strict=True)) for word in code]
            order = sorted(range(n), key=lambda k: loss[k])
            assert first[i] == order[0] and lead[i] == pytest.approx(loss[order[1]] - loss[order[0]])
            e = [math.exp(-(x - min(loss)) * code.shape[1]) for x in loss]
            assert share[i] == pytest.approx(max(e) / sum(e))


def test_language_flags_mixtures(spark):
    kinds = {"a": "lorem ipsum dolor sit amet", "b": "xyzzy kwyjibo qwerty zxcvb"}
    docs = [(i, " ".join(np.random.default_rng(i).choice(kinds["ab"[i % 2]].split(), 40)), "ab"[i % 2]) for i in range(80)]
    mix = [(900 + i, kinds["a"] + " " + kinds["b"], None) for i in range(5)]
    out = {r.doc_id: r for r in language.identify(spark.createDataFrame(docs + mix, "doc_id long, text string, lang string"), F.lit(True), ambiguous_under=0.5).collect()}
    assert all(out[i].lang_pred == lang and not out[i].ambiguous for i, _, lang in docs) and any(out[900 + i].ambiguous for i in range(5))


@pytest.fixture(scope="module")
def long_docs(spark, tmp_path_factory):
    """Texts of 2 MB, all in one Arrow batch, and shorter ones between them."""
    base = prose(40_000, 77)
    texts = [(i, (f"{i} " + base * 12)[: 2 << 20] if i % 2 else "short text " * i, "en") for i in range(16)]
    path = str(tmp_path_factory.mktemp("long"))
    spark.createDataFrame(texts, "doc_id long, text string, lang string").coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_long_texts(spark, long_docs):
    labels = spark.createDataFrame([(i, i % 3 == 0, i % 2) for i in range(16)], "doc_id long, q boolean, toxic int").selectExpr("doc_id", "CAST(q AS INT) AS quality", "toxic")
    assert toxicity.score(long_docs, labels, crc_mod("doc_id", 3) != 1).count() == 16
    assert quality.judge(long_docs, labels).agg(F.sum("word_chars")).first()[0] > 8 << 20
    assert language.identify(long_docs, crc_mod("doc_id", 4) != 2).where("lang_pred = 'en'").count() == 15
    assert simhash.near_duplicates(long_docs).select("component_id").distinct().count() < 16
    counts = token_counts.count_tokens(long_docs, BYTE_BPE).agg(F.sum("n_bytes"), F.sum("n_tokens")).first()
    packed = packing.pack(long_docs, WORD_BPE).agg(F.sum("length"), F.countDistinct("doc_id")).first()
    assert counts[0] > 16 << 20 and counts[1] > 1 << 20 and packed[0] > 1 << 20 and packed[1] == 16


def test_feature_memory():
    text = prose(40_000, 78).encode() * 60
    tracemalloc.start()
    linear.byte_ngrams([text[: 16 << 20]], (1, 2, 3))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 128 << 20


def test_merger_is_there():
    """The packing operator merges with a method that tiktoken does not document: this fails where it moves."""
    from tokenizers import Tokenizer

    from nightsift.llm.word_bpe import WordIds

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = f.read()
    text = "An unusualword, and others."
    assert np.frombuffer(WordIds(spec).text_ids(text.encode()), "<u4").tolist() == Tokenizer.from_str(spec).encode(text, add_special_tokens=False).ids


def odd_documents(spark):
    """Nulls in every column, repeated rows, empty texts, and extra columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, n_chars long, id string, fp int, kept int, t string, size string, n int")
    return df.selectExpr("*", "'x' AS row", "1 AS key", "2 AS spans", "'y' AS live", "3 AS taken", "4 AS bucket", "5 AS first", "6 AS owner", "7 AS p_low")


@pytest.mark.parametrize("which", ["odd", "empty"])
def test_stages_on_odd_rows(spark, tmp_path, which):
    docs = odd_documents(spark)
    docs = docs if which == "odd" else docs.where("false")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(14)] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == docs.columns, name
        n = out.count()
        assert n == 0 if which == "empty" else n > 0
        if k in (1, 2):  # dedup leaves one of equal texts; masking keeps all rows
            texts = [r[0] or "" for r in out.select("text").collect()]
            assert len(set(texts)) == len(texts) if k == 1 else n == docs.count()
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert (run.count() == 0) == (which == "empty")
    scanned = secrets.scan(docs, repo_col="lang", keep=True)
    assert scanned.count() == docs.count() and scanned.select("row.*").columns == docs.columns
