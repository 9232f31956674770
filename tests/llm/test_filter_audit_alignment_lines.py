"""Operators 11 to 13 against brute-force versions, on odd texts, ties, repeated rows, clashing columns and empty tables."""

import hashlib
import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from nightsift.llm import alignment, filter_audit, line_dedup
from nightsift.llm.common import table
from tests.llm.test_operators import BYTE_BPE, SCHEMA, WORD, prose, rows

PIECES = public_tokenizers.path("piece_bpe_32k.model")
LINE = "This line is found in many documents."
MORE = [
    (200, f"{LINE}\nown line of two hundred, not elsewhere\n\t{LINE.upper()} \n", "en", "b"),
    (201, f"  {LINE}\r\n{LINE}\nx", "en", "b"),
    (202, f"{LINE}\nÉ ÉTAIT une LIGNE longue ici\nx", "de", None),
    (203, "é était une ligne longue ici\nÉ était une ligne LONGUE ici\nÉ était une ligne longue ici", "de", ""),
    (204, "É était UNE ligne longue ici\nx", "de", "é"),
    (204, f"É était UNE ligne longue ici\n{LINE}", "de", "é"),
    (None, f"{LINE}\nshort", None, None),
    (205, "A" * 30 + " " + "B" * 3000 + "\n" + "日本語" * 50 + " ½ \x00   end", "en", "a"),
    (206, "a  b   c\t\td\n\n e " * 20 + "=" * 700 + " " + "-=" * 300, "en", "a"),
    (207, "▁x ▁▁y <s> </s> <0x41> <unk> <|endoftext|>", "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("more"))
    more = [(*r, len(r[1]), "x", 1, 2, "clash", "big", 7) for r in MORE]
    df = spark.createDataFrame(rows() + more, SCHEMA).selectExpr("*", "'x' AS row", "1 AS pair", "2 AS pairs", "'y' AS k", "3 AS keeper", "4 AS part", "5 AS mask", "6 AS digest", "7 AS at", "8 AS dropped")
    df.repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i // 2) % 2) for i in range(14)] + [(None, 1, 0), (3, None, None), (201, 1, 1), (201, 0, 0)], "doc_id long, quality int, toxic int")


def aligned(texts):
    """Per text: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, by plain loops."""
    a_lib, b_lib = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_lib.encode_special_tokens = True
    names = {i: k for k, i in a_lib.get_vocab().items()}
    of = {c: b for c, b in zip((chr(b) if 33 <= b < 127 or 161 <= b < 173 or b > 173 else None for b in range(256)), range(256)) if c}  # noqa: B905
    of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or b > 173))}
    piece = lambda i: bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", b_lib.id_to_piece(i)) else b_lib.id_to_piece(i).replace("▁", " ").encode()
    out = []
    for t in texts:
        a, b = a_lib.encode(" " + (t or ""), add_special_tokens=False).ids, b_lib.encode(t or "")
        x, y = [bytes(map(of.__getitem__, names[i])) for i in a], [piece(i) for i in b]
        if not t or b"".join(x) != (" " + t).encode() or b"".join(y) != (" " + t).encode():
            out.append((0, 0, [], ""))
            continue
        ends = sorted(set(np.cumsum([len(v) for v in x]).tolist()) & set(np.cumsum([len(v) for v in y]).tolist()))
        groups, i, j, at_a, at_b = [], 0, 0, 0, 0
        for e in ends:
            ga, gb = [], []
            while at_a < e:
                ga.append(a[i])
                at_a += len(x[i])
                i += 1
            while at_b < e:
                gb.append(b[j])
                at_b += len(y[j])
                j += 1
            groups.append((ga, gb))
        sha = hashlib.sha256(";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups).encode()).hexdigest()
        out.append((len(a), len(b), groups, sha))
    links = [Counter(p for g, h in groups for p in itertools.product(g, h)) for _, _, groups, _ in out]
    count = Counter(p for x in links for p in x)
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    return [(n_a, n_b, len(groups), sum(x.values()), sum(m for p, m in x.items() if count[p] == top[p[0]]), sum(count[p] * m for p, m in x.items()), sha) for (n_a, n_b, groups, sha), x in zip(out, links, strict=True)]


@pytest.mark.parametrize("hot", [100_000, 40])
def test_alignment(docs, hot):
    """hot = 40: nearly all pairs are joined by a shuffle."""
    all_ = docs.select("doc_id", "text").collect()
    want = sorted(((r.doc_id, *x) for r, x in zip(all_, aligned([r.text for r in all_]), strict=True)), key=repr)
    got = alignment.align(docs, BYTE_BPE, PIECES, most_hot=hot)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert alignment.align(docs.where("false"), BYTE_BPE, PIECES).count() == 0


def test_alignment_of_parts_and_forgetting(spark):
    """Long texts in parts, windows that share a hash, and a memory that is full give the same."""
    with open(BYTE_BPE, encoding="utf-8") as f, open(PIECES, "rb") as g:
        whole = alignment.Aligner(f.read(), g.read())
    texts = [prose(400, i) + " é. " * (i % 3) + "x" * (90 * (i % 2)) for i in range(6)]
    want = [x[:4] + x[-1:] for x in aligned(texts)]
    plain = whole.align(texts)

    def read(batch):
        return [tuple(batch.column(i)[k].as_py() for i in range(5)) for k in range(len(texts))]

    assert read(plain) == want
    whole.part = 300
    assert read(whole.align(texts)) == want
    whole.windows.most = 0
    assert read(whole.align(texts)) == want
    whole.mix = [m * np.uint64(0) for m in whole.mix]
    assert read(whole.align(texts)) == want
    assert whole.align(texts).column(5) == plain.column(5) and whole.align(texts).column(6) == plain.column(6)
    assert whole.align([]).num_rows == 0


def audited(all_, marks):
    masks = []
    for r in all_:
        t = r.text or ""
        w = WORD.findall(t)
        fails = [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), re.search(r"[#$%&*|]", t) is not None]
        fails.append(r.doc_id is not None and any(o.doc_id is not None and o.doc_id < r.doc_id and (o.text or "") == t for o in all_))
        masks.append((r.source or "", {f for f, x in zip("ABCDE", fails, strict=True) if x}, r.doc_id))
    good = {m.doc_id for m in marks if m.quality == 1 and m.doc_id is not None}
    toxic = {m.doc_id for m in marks if m.toxic == 1 and m.doc_id is not None}
    orders = ["".join(o) for o in itertools.permutations("ABCDE")]
    out, shapley = {}, Counter()
    for part in {p for p, _, _ in masks}:
        mine = [(m, i) for p, m, i in masks if p == part]
        for o in orders:
            left = mine
            for s, f in enumerate(o, 1):
                gone = [x for x in left if f in x[0]]
                stay = [x for x in left if f not in x[0]]
                redundant = sum(f in m for m, _ in mine) - len(gone)
                out[part, o, s] = [len(stay), len(gone), redundant, sum(m == {f} for m, _ in mine), sum(i in good for _, i in gone), sum(i in toxic for _, i in gone)]
                shapley[part, f] += len(gone)
                left = stay
    return sorted((p, o, s, *v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items())


def test_audit(docs, labels):
    got = filter_audit.audit(docs, labels)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == audited(docs.collect(), labels.collect())
    assert filter_audit.audit(docs.where("false"), labels).count() == 0
    assert filter_audit.audit(docs, labels.where("false")).agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0


def counted(t):
    w = t.split()
    return [len(w), len(set(w)), sum(65 <= c <= 90 for c in t), sum(not 0x80 <= c < 0xC0 for c in t), sum(c in b"#$%&*|" for c in t)]


def test_transducer(monkeypatch):
    texts = [(r[1] or "").encode() for r in rows()] + [r[1].encode() for r in MORE] + [b" ", b"x" * 5000 + b" y", b"ab " * 3000]
    assert filter_audit.counts_of(texts).tolist() == list(map(counted, texts))
    for block in (7, 100, 4096):  # a word longer than a block, blocks that end within runs of white space
        assert [filter_audit.counts_of_long(t, block).tolist() for t in texts] == list(map(counted, texts))
    monkeypatch.setattr(filter_audit, "hashes", lambda data, start, end: np.zeros(len(start), np.uint64))  # all words collide
    assert filter_audit.counts_of(texts[:12]).tolist() == list(map(counted, texts[:12]))


def lower(line):
    return line.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})


def deduped(all_):
    holds, keeper = Counter(), {}
    rank = lambda i: (i is not None, i or 0)
    for r in all_:
        for k in {lower(x) for x in (r.text or "").split("\n")}:
            if len(k) >= 20:
                holds[k] += 1
                keeper[k] = max(keeper.get(k, r.doc_id), r.doc_id, key=rank)
    out = []
    for r in all_:
        lines = (r.text or "").split("\n")
        stay = [x for x in lines if holds[lower(x)] < 3 or keeper[lower(x)] == r.doc_id]
        out.append((r.doc_id, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (4, 2), (7, 3)])
def test_line_dedup(docs, batches, fanout):
    got = line_dedup.drop_repeated_lines(docs, batches=batches, fanout=fanout)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    want = deduped(docs.select("doc_id", "text").collect())
    assert sorted(map(tuple, got.collect()), key=repr) == want and sum(r[2] for r in want) > 6
    assert line_dedup.drop_repeated_lines(docs.where("false"), batches=batches).count() == 0


def test_line_dedup_rare_keys(spark):
    """More than 10,000 hashes, so that most are joined by a shuffle and one is hot; ids are text."""
    data = [(f"id{i:05d}", "\n".join([LINE, *(f"a line that three documents hold, number {j}" for j in range(i - i % 3, i - i % 3 + 3)), *(f"a line of document {i} alone, {j}" for j in range(5))])) for i in range(3000)]
    df = spark.createDataFrame(data, "doc_id string, text string")
    got = {r.doc_id: r for r in line_dedup.drop_repeated_lines(df).collect()}
    for i in range(3000):
        assert got[f"id{i:05d}"].n_dropped == (i < 2999) + 3 * (i % 3 < 2)


def test_line_runs(spark):
    """Batches are joined with every run before, and levels are compacted."""
    store = line_dedup.LineRuns(spark, fanout=2, buckets=3)
    seen = {}
    for b in range(5):
        batch = {bytes([k]): (k % 4 + 1, 100 - b) for k in range(b, 20, b + 1)}
        run = store.add(spark.createDataFrame([(bytearray(k), n, i) for k, (n, i) in batch.items()], "k binary, n long, id long"))
        assert {bytes(r.k) for r in run.where("new").collect()} == batch.keys() - seen.keys()
        for k, (n, i) in batch.items():
            seen[k] = (seen.get(k, (0, i))[0] + n, seen.get(k, (0, i))[1])
    assert list(map(len, store.levels)) == [1, 0, 1]
    assert {bytes(r.k): (r.n, r.keeper) for r in line_dedup.merged(store.runs()).collect()} == seen
    plan = store.runs()[0].join(store.runs()[1], "k", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_on_given_tables(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    all_ = docs.select("doc_id", "text").collect()
    want = sorted(((r.doc_id, *x) for r, x in zip(all_, aligned([r.text for r in all_]), strict=True)), key=repr)
    assert sorted(map(tuple, alignment.align(docs, BYTE_BPE, PIECES).collect()), key=repr) == want
