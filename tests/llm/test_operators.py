"""Each operator against a brute-force version, on texts with nulls, empties, ties, repeats, long texts and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from nightsift.llm import language, linear, merkle, mixing, packing, quality, secrets, simhash, token_counts, toxicity, warc
from nightsift.llm.common import crc_mod
from nightsift.llm.components import stars

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
random.seed(5)
SYLLABLES = "ka lo mi ru te sa no vi de pu ran tel mos kin bar".split()


def prose(n, seed):
    r = random.Random(seed)
    words = ["".join(r.choices(SYLLABLES, k=r.randint(1, 3))) for _ in range(n)]
    return re.sub(r"(\S+ \S+ \S+ \S+ \S+ \S+)", r"\1.", " ".join(words))


SECRET = "AKIA" + "Q7" * 9
TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "Two Words",
    "tie tie tie tie tie tie",
    prose(80, 1),
    prose(80, 1),
    prose(80, 1).replace("ka", "KA", 1),
    prose(300, 2),
    prose(6000, 3),
    f"x password = 'hunter2hunter2' y {SECRET} z token=short token: {'ab12' * 10}\nend",
    f"é {'ab12' * 10} secret:\"é\" API_KEY=0123456789abcdef",
    "<|endoftext|> don't I'LL ÀÉ ß 日本語 ½ x\x1cy <|startoftext|>",
    "line\nline\n\nline\nOther ##$ %%",
    "a b c a b c a b c d " * 10,
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, fp int, kept int, t string, size string, n int"


def rows():
    out = []
    for i, t in enumerate(TEXTS):
        out.append((i, t, ("en", "de", None)[i % 3], ("b", "a", None, "é")[i % 4], None if t is None else len(t), "x", 1, 2, "clash", "big", 7))
    return [*out, out[6], (None, prose(60, 9), None, None, 3, None, None, None, None, None, None), (100, prose(90, 4), "en", "b", 1, "", 0, 0, "", "", 0)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i // 2) % 2) for i in range(14)] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def by_id(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_token_counts(docs, empty):
    library = Tokenizer.from_file(BYTE_BPE)
    want = sorted(((r[0], len((r[1] or "").encode()), n := len(library.encode(r[1] or "", add_special_tokens=False).ids), n > 1024) for r in rows()), key=repr)
    assert by_id(token_counts.count_tokens(docs, BYTE_BPE)) == want
    assert token_counts.count_tokens(empty, BYTE_BPE).count() == 0


def test_token_counter_cuts_long_texts():
    with open(BYTE_BPE, encoding="utf-8") as f:
        spec = f.read()
    small = token_counts.Counter(spec, token_counts.whole_tokens(spec), most=60_000, chunk=100)
    for t in (TEXTS[10], TEXTS[13] * 30, "  ".join([prose(50, 8)] * 4), "\n\n x" * 200):
        assert small.count(t) == len(small.tokenizer.encode(t, add_special_tokens=False).ids)


def test_packing(docs, empty):
    library = Tokenizer.from_file(WORD_BPE)
    got = packing.pack(docs, WORD_BPE, capacity=256, with_ids=True).collect()
    want = []
    for r in rows():
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 0]
        want += [(r[0], k, at, ids[at : at + 256]) for k, at in enumerate(range(0, len(ids), 256))]
    assert sorted(((r.doc_id, r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in got), key=repr) == sorted(want, key=repr)
    bins = defaultdict(list)
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        b.sort()
        assert b[0][0] == 0 and all(x[0] + x[1] == y[0] for x, y in zip(b, b[1:], strict=False)) and sum(b[-1]) <= 256
    total = sum(r.length for r in got)
    assert len(bins) <= -(-total // 256) + 2 and sorted(bins) == list(range(len(bins)))
    assert packing.pack(empty, WORD_BPE).count() == 0


@pytest.mark.parametrize("kind", ["uniform", "one", "large", "small"])
def test_plan_uses_every_piece(kind):
    r = np.random.default_rng(3)
    sizes = {"uniform": r.integers(1, 2049, 50_000), "one": np.full(10_001, 1200), "large": r.integers(1500, 2049, 5000), "small": r.integers(1, 50, 90_000)}[kind]
    counts = np.bincount(sizes, minlength=2049)
    planned = packing.plan(counts, 2048)
    used = Counter()
    for lengths, n in planned:
        assert sum(lengths) <= 2048 and n > 0
        for x in lengths:
            used[x] += n
    assert used == Counter(sizes.tolist())
    if kind in ("uniform", "small"):
        assert sum(n for _, n in planned) <= np.ceil(sizes.sum() / 2048) * 1.01 + 1


def test_mixing(docs, empty):
    got = mixing.mix(docs, buckets=8).collect()
    sizes = [len(WORD.findall(r[1] or "")) for r in rows()]
    of = defaultdict(int)
    for r, n in zip(rows(), sizes, strict=True):
        of[r[3]] += n
    names = sorted((s for s in of if s is not None), key=lambda s: s.encode()) + [None]
    weight, left, target = dict(zip(names, (5, 2, 1, 5), strict=True)), 1.5 * sum(sizes), {}
    free = set(names)
    while True:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= 2 * of[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 2.0 * of[s] for s in over}
        left -= sum(2 * of[s] for s in over)
        free -= over
        if not free:
            break
    assert sorted(((r.doc_id, r.size) for r in got), key=repr) == sorted(((r[0], n) for r, n in zip(rows(), sizes, strict=True)), key=repr)
    taken = Counter()
    source_of = {r[0]: r[3] for r in rows()}
    for r in got:
        s = source_of[r.doc_id]
        assert r.source_size == of[s] and r.target == pytest.approx(target[s]) and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert all(taken[s] == int(target[s]) for s in names)
    assert by_id(mixing.mix(docs.repartition(5), buckets=8)) == by_id(mixing.mix(docs, buckets=8))
    assert mixing.mix(empty).count() == 0
    mixed = mixing.mixed(docs, buckets=8)
    assert mixed.columns == docs.columns
    assert sum(len(WORD.findall(r.text)) for r in mixed.collect()) == sum(taken.values())


def test_mixing_of_very_many_sources(spark):
    """One source with most rows and thousands of small ones, which are not broadcast, against the plain rule for each."""
    df = spark.range(24_000).selectExpr("id AS doc_id", "repeat('w ', CAST(1 + id % 5 AS INT)) AS text", "CASE WHEN id % 2 = 0 THEN 'big' ELSE concat('host', lpad(id, 6, '0')) END AS source")
    got = mixing.mix(df).join(df, "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("source_size").alias("source_size"), F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    assert len(got) == 12_001 and sum(r.n for r in got) == 24_000
    assert all(r.source_size == r.size and r.taken == int(r.target) <= 2 * r.size for r in got)


@pytest.mark.parametrize("doc_id", [7, None])
def test_mixing_ends_among_rows_that_tie(spark, doc_id):
    docs = spark.createDataFrame([(doc_id, "a b c", "x")] * 101 + [(1, None, "y"), (2, "", "y")], "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert Counter(r.taken for r in got) == {6: 50, 4: 1, 3: 50, 0: 2}  # 454 words of 303: once all, then 151
    assert Counter(r.text for r in mixing.mixed(docs).collect()) == {"a b c": 151, "a": 1}


def print_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    parts = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def chains(prints, radius=2):
    ids, group = list(prints), {}
    for i in ids:
        group[i] = {i}
    for a in ids:
        for b in ids:
            if (prints[a] ^ prints[b]).bit_count() <= radius and group[a] is not group[b]:
                group[a] |= group[b]
                for x in group[b]:
                    group[x] = group[a]
    return group


def test_simhash(docs, empty):
    rows_ = [(r[0], print_of(r[1])) for r in rows()]
    group = chains(dict.fromkeys({f for _, f in rows_}) and {f: f for _, f in rows_})
    want = sorted(((i, f"{f:016x}", min((j for j, g in rows_ if g in group[f] and j is not None), default=None)) for i, f in rows_), key=repr)
    assert by_id(simhash.near_duplicates(docs)) == want
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.without_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted({c for *_, c in want}, key=repr)


@pytest.mark.parametrize("tile", [4, 512])
def test_links_find_all_chains(spark, tile):
    """Random families, also with buckets far above the tile, link exactly as all pairs would."""
    r = random.Random(tile)
    fps = set()
    for _ in range(12):
        base = r.getrandbits(64)
        for _ in range(25):
            x = base
            for b in r.sample(range(64), r.randint(0, 3)):
                x ^= 1 << b
            fps.add(x)
    fps |= {r.getrandbits(64) for _ in range(200)}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    star = stars(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), tile=tile))
    root = {x.a: x.b for x in star.collect()}
    got = defaultdict(set)
    for s in signed:
        got[root.get(s, s)].add(s % (1 << 64))
    assert sorted(map(sorted, got.values())) == sorted({tuple(sorted(g)) for g in chains({x: x for x in fps}).values()} and [sorted(g) for g in {tuple(sorted(g)) for g in chains({x: x for x in fps}).values()}])


def test_near_is_exact():
    r = np.random.default_rng(1)
    a = r.integers(0, 1 << 63, 150, dtype=np.uint64)
    b = np.concatenate([a[:70] ^ np.uint64(5), a[70:100] ^ np.uint64(7), r.integers(0, 1 << 63, 80, dtype=np.uint64)])
    for radius in (1, 2, 3):
        i, j = simhash.near(a, b, radius)
        want = {(x, y) for x in range(len(a)) for y in range(len(b)) if int(a[x] ^ b[y]).bit_count() <= radius}
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, j) for j in range(101, 140)] + [(200, 200)]
    got = {r.a: r.b for r in stars(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {j: 100 for j in range(101, 140)}


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(t):
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    found += [(m.start(), m.end(), 1) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    found += [(m.start(), m.end(), 2) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    found.sort(key=lambda x: (x[0], x[2]))
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, b, k in found]


def test_secrets(docs, empty, spark):
    got = {(r.doc_id, r.base_sha256): r for r in secrets.scan(docs).collect()}
    for r in rows():
        spans = base_spans(r[1] or "")
        g = got[r[0], hashlib.sha256(",".join(spans).encode()).hexdigest()]
        assert set(spans) <= set(filter(None, g.spans.split(",")))
        assert [g.n_assign, g.n_access, g.n_hex] == [sum(x.startswith(k) for x in spans) for k in ("assign", "access", "hex")]
    assert secrets.scan(empty).count() == 0
    value = "Zx9" * 6
    made = [(0, f"token = {value}", "a"), (1, f"seen {value}. here", "b"), *((i, f"secret=example{7:020d}", f"o{i}") for i in range(2, 9))]
    out = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(made, "doc_id long, text string, source string")).collect()}
    assert out[1].spans == f"bare:5:{5 + len(value) + 1}" and out[0].n_live == 1 and out[4].n_live == 0 and out[4].n_example == 1
    masked = secrets.scan(docs, keep=True).select("doc_id", secrets.masked(F.col("row.text"), F.col("live")).alias("m"), "row.text").collect()
    for r in masked:
        assert (r.text is None and r.m is None) or not (base_spans(r.m))


def test_running_results(spark):
    r = random.Random(2)
    lists = [[], [0], [5], *([r.randint(0, 99) for _ in range(n)] for n in (63, 64, 65, 1000))]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, x array<int>")
    got = df.select("i", secrets.before(F.col("x"), lambda a, b: a + b).alias("s"), secrets.before(F.col("x"), F.greatest).alias("m")).collect()
    for g in got:
        x = lists[g.i]
        assert g.s == [sum(x[:k]) for k in range(len(x))] and g.m == [max(x[:k], default=0) for k in range(len(x))]


def test_ownership(spark):
    """Owners and repositories of each value, counted by hand."""
    r = random.Random(6)
    rows_ = [(i, f"token = value{r.randint(0, 12):08d} {SECRET if i % 9 == 0 else ''}", r.choice(["a", "b", "c", "", None]), r.choice(["x", "y", None])) for i in range(120)]
    df = spark.createDataFrame(rows_, "doc_id long, text string, source string, repo string").repartition(4)
    owners, repos = defaultdict(set), defaultdict(set)
    for _, t, o, p in rows_:
        for v in re.findall("value[0-9]+|AKIA[A-Z0-9]+", t):
            owners[v].add(o)
            repos[v].add((o, p))
    for most_owners, most_repos in ((2, 4), (3, 100), (100, 5), (5, 15)):
        got = {g.doc_id: g for g in secrets.scan(df, repo_col="repo", live_owners=most_owners, live_repos=most_repos).collect()}
        for i, t, _, _ in rows_:
            held = re.findall("value[0-9]+|AKIA[A-Z0-9]+", t)
            live = sum(len(owners[v]) <= most_owners and len(repos[v]) <= most_repos for v in held)
            assert (got[i].n_live, got[i].n_example) == (live, len(held) - live)
            assert (got[i].owners, got[i].repos) == (max(len(owners[v]) for v in held), max(len(repos[v]) for v in held))


def test_secrets_recur(spark):
    """Short values and such without digits recur; runs that overlap base spans, or only hold the value, do not count."""
    made = [(0, "password: swordfish", "a"), (1, "a swordfish. swordfishes x/swordfish token=swordfish", "b"), (2, "é" * 5000 + " swordfish " + "é" * 9000 + " swordfish", "b")]
    out = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(made, "doc_id long, text string, source string"), keep=True).withColumn("m", secrets.masked(F.col("row.text"), F.col("live"))).collect()}
    assert out[1].spans == "bare:2:12,assign:37:52" and out[2].spans == "bare:5001:5010,bare:14012:14021"
    assert out[1].m == "a [secret] swordfishes x/swordfish [secret]" and out[2].m == "é" * 5000 + " [secret] " + "é" * 9000 + " [secret]"
    text = prose(3000, 7)
    places = sorted((a, a + random.Random(a).randint(1, 9000)) for a in random.Random(1).sample(range(9000), 40))
    want, at = "", 0
    for a, b in places:
        want += text[at:a] + "[secret]" if a >= at else ""
        at = max(at, b)
    df = spark.createDataFrame([(text, [(a, min(b, len(text))) for a, b in places]), (None, []), ("", [])], "t string, live array<struct<start:int,end:int>>")
    assert [r[0] for r in df.select(secrets.masked(F.col("t"), F.col("live"), chunk=100)).collect()] == [want + text[at:], None, ""]


def test_warc(spark, empty):
    big = "é<html>" + "x" * 1200
    pages = [(1, "http://a/ b\n", big), (9, None, big), (4, "u", big), (5, "u", "small"), (6, "u", "small"), (7, "u", None), (8, "u", ""), (2, "u", "\r\n\r\n0\r\n" * 9000), (None, "u", big), (3, "u", "y" * 100_000), (3, "u", "z")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    got = warc.round_trip(df, segment=500)
    want = []
    for i, _, h in pages:
        p = (h or "").encode()
        revisit = len(p) >= 1000 and h == big and i != 9
        want.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", 9 if revisit else None, True))
    assert by_id(got) == sorted(want, key=repr)
    assert warc.round_trip(df.where("false")).count() == 0


def test_warc_copies_ids_and_columns(spark):
    """10,000 copies of a page; ids that are text, with line breaks, empty or null; extra columns with clashing names."""
    big = "x" * 3000
    df = spark.range(10_000).selectExpr("CAST(id AS STRING) AS page_id", f"'{big}' AS html", "'u' AS url")
    odd = spark.createDataFrame([("a\r\nWARC-Type: x: y", "odd" * 900, "u"), ("", "e", None), (None, "f", ""), ("ü:1", "odd" * 900, "v\n")], "page_id string, html string, url string")
    df = df.union(odd).selectExpr("*", "'c' AS row", "1 AS digest", "2 AS first", "3 AS payload", "4 AS id", "5 AS n", "6 AS refers")
    path = warc.scratch(spark, "odd")
    df.write.parquet(path)
    got = {r.page_id: r for r in warc.round_trip(spark.read.parquet(path)).collect()}
    assert len(got) == 10_004 and all(r.intact for r in got.values())
    assert sum(r.refers_to == "9999" for r in got.values()) == 9999 and got["9999"].record_type == "response"
    assert got["a\r\nWARC-Type: x: y"].refers_to == "ü:1" and got["ü:1"].refers_to is None
    assert got[""].payload_bytes == got[None].payload_bytes == 1


def test_multi_member_archives(spark, tmp_path):
    """The usual form of .warc.gz: a gzip member for each record."""
    import gzip

    blocks = [list(warc.records(i, 0, "u", p, hashlib.sha1(p).hexdigest(), None, "d", 1000)) for i, p in enumerate((b"a" * 10, b"b" * 5000, b"", b"c" * 200_000))]
    members = [gzip.compress(r + warc.END) for rs in blocks for r in rs]
    (tmp_path / "m.warc.gz").write_bytes(b"".join(members) + b"\0\0")
    got = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted(r.bytes for r in got) == [0, 10, 5000, 200_000] and all(r.intact for r in got)
    with pytest.raises(ValueError):
        warc.unpacked(members[0][:-4])
    assert warc.unpacked(b"plain") == b"plain"


def test_broken_segments(spark, tmp_path):
    """A missing segment, or a wrong total length, is seen."""
    whole = list(warc.records(1, 0, "u", b"p" * 3000, hashlib.sha1(b"p" * 3000).hexdigest(), None, "d", 1000))
    for name, parts in {"whole": whole[::-1], "missing": whole[:1] + whole[2:], "cut": whole[:-1]}.items():
        (tmp_path / name).mkdir()
        import gzip

        (tmp_path / name / "a.gz").write_bytes(gzip.compress(b"".join(p + warc.END for p in parts)))
        assert [r.intact for r in warc.read_archives(spark, str(tmp_path / name)).collect()] == [name == "whole"]
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabcdeXX0\r\n\r\n")


def rules(t):
    w = WORD.findall(t)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_quality(docs, labels, empty):
    got = quality.judge(docs, labels, keep=True).select("*", "row.text")
    for r in got.collect():
        want = rules(r.text or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)
    assert got.count() == len(rows())
    assert quality.judge(empty, labels).count() == 0
    assert quality.judge(docs, labels.where("false")).where("kept = base_failed").count() == 0


def test_quality_learns(spark):
    good = [(i, prose(120, i)) for i in range(60)]
    bad = [(100 + i, prose(120, 500 + i).upper() + "!!") for i in range(40)]
    df = spark.createDataFrame(good + bad, "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i < 100)) for i, _ in good + bad], "doc_id long, quality int")
    kept = {r.doc_id for r in quality.judge(df, lab.where("doc_id % 2 = 0")).where("kept").collect()}
    assert kept == {i for i, _ in good}


def test_language(docs, spark, empty):
    got = language.identify(docs, crc_mod("doc_id", 4) != 2).collect()
    for r, g in zip(sorted(rows(), key=lambda r: repr(r[0])), sorted(got, key=lambda g: repr(g.doc_id)), strict=True):
        assert g.held_out == (zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 4 == 2) and 0 <= g.score <= 1
        assert (g.lang_pred == "und") == (not any(c.isalpha() for c in r[1] or ""))
    assert language.identify(empty, F.lit(True)).count() == 0
    assert {r.lang_pred for r in language.identify(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True)).collect()} == {"und"}
    kinds = {k: ["".join(random.Random(k + str(i)).choices(a, k=4)) for i in range(40)] for k, a in zip("abcdefg", ("aeiou", "bcdfg", "hjklm", "npqrs", "tvwxz", "aoxyz", "lmnei"), strict=True)}
    texts = [(i, " ".join(random.Random(i).choices(kinds["abcdefg"[i % 7]], k=30)), "abcdefg"[i % 7]) for i in range(280)]
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    out = language.identify(df, F.col("doc_id") % 4 != 2).join(df, "doc_id")
    assert out.where("held_out AND lang_pred = lang").count() >= 0.97 * out.where("held_out").count()


def test_codewords():
    for n in (1, 2, 3, 4, 5, 9):
        code = language.codewords(n)
        assert code.shape[0] == n and (n < 2 or len({tuple(r) for r in code}) == n) and (n < 2 or (abs(code.sum(0)) < n).all())


def paragraphs(t):
    return [x for x in re.findall(r"(?:[^.!?\n ]* ){0,7}[^.!?\n ]*(?:[.!?\n]+| |\Z)", t) if x]


def test_fingerprints(docs, empty):
    ordered = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    got = defaultdict(list)
    for r in merkle.fingerprints(docs).collect():
        got[r.doc_id].append(r)
    for k, r in enumerate(ordered):
        t, nxt = r[1] or "", ordered[(k + 1) % len(ordered)][1] or ""
        third = len(t) // 3
        edited = t[: len(t) - third] + nxt[:third]
        assert "".join(paragraphs(t)) == t
        matching = [g for g in got[r[0]] if g.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()]
        assert matching and matching[0].n_chars == len(t)
        g = matching[0]
        assert (g.near_edited == 1.0) == (t == edited) and 0 <= g.near_next <= 1
        leaves = [hashlib.md5(p.encode()).hexdigest() for p in paragraphs(t)]
        root, *sections = g.fingerprint.split(" ")
        assert [x[:8] for x in leaves] == [s[i : i + 8] for s in sections for i in range(9, len(s), 8)]
        whole, k = [], 0
        for s in sections:
            n = (len(s) - 9) // 8
            whole.append(hashlib.md5("".join(x[:16] for x in leaves[k : k + n]).encode()).hexdigest())
            assert whole[-1][:8] == s[:8]
            k += n
        assert hashlib.sha256("".join(whole).encode()).hexdigest()[:32] == root
        lead = next((i for i, (p, q) in enumerate(zip([*paragraphs(t), 0], [*paragraphs(edited), 1], strict=False)) if p != q), None)
        assert g.same_paragraphs == (None if t == edited else lead)
        assert len({x.fingerprint for x in got[r[0]]}) == 1
    assert got[6][0].fingerprint == got[7][0].fingerprint != got[8][0].fingerprint
    assert merkle.fingerprints(empty).count() == 0
    one = docs.where("doc_id = 100")
    assert merkle.fingerprints(one).first().near_next == 1.0


def test_ranges_keep_the_order(spark):
    """Next rows are right however ids are spread, over many ranges."""
    ids = [*range(500), *range(10**12, 10**12 + 300, 3), -5, 7 * 10**15]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "id long, t string").repartition(4)
    got = {r.id: r.next_t for r in merkle.with_next(df, "id", "t", per_range=16).collect()}
    down = sorted(ids, reverse=True)
    assert got == {i: f"t{j}" for i, j in zip(down, down[1:] + down[:1], strict=True)}


def test_edits_are_located(spark):
    """The comparison walks from the root to the differing section and its paragraph."""
    text = prose(4000, 31)
    parts = paragraphs(text)
    changed = [*parts[:200], "entirely new words here. ", *parts[201:]]
    moved = [*parts[100:], *parts[:100]]
    df = spark.createDataFrame([(0, text, "".join(changed)), (1, text, "".join(moved)), (2, text, text), (3, "", text), (4, "a b", "c d")], "i int, a string, b string")
    got = {r.i: r.c for r in df.select("i", merkle.compared(merkle.fingerprint(F.col("a")), merkle.fingerprint(F.col("b"))).alias("c")).collect()}
    assert got[0].same_paragraphs == 200 and got[0].likeness > 0.97 and 0 < got[0].same_sections < 200
    assert 0.9 < got[1].likeness < 1 and got[1].same_paragraphs == 0
    assert got[2].likeness == 1 and got[2].same_paragraphs is None and got[2].same_sections is None
    assert got[3].likeness == got[4].likeness == 0


def test_order_of_text_shared_and_null_ids(spark):
    ids = [f"document-{i:06d}" for i in range(300)] + ["é", "", "document", None]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "id string, t string").repartition(4)
    got = {r.id: r.next_t for r in merkle.with_next(df, "id", "t", per_range=16).collect()}
    down = sorted((i for i in ids if i is not None), key=str.encode, reverse=True) + [None]
    assert got == {i: f"t{j}" for i, j in zip(down, down[1:] + down[:1], strict=True)}
    rows_ = [(7 if k % 2 else None if k % 3 else k, f"t{k}") for k in range(3000)]
    df = spark.createDataFrame(rows_, "id long, t string").repartition(4).withColumn("h", F.xxhash64("t"))
    at, fine, n = merkle.range_of(df, "id", "h", 16)
    sizes = [r["count"] for r in df.groupBy(at.alias("c"), fine.alias("r")).count().collect()]
    assert n == 3000 and max(sizes) < 150  # rows of one id, or without any, are spread
    h = {r.t: r.h for r in df.collect()}
    down = sorted(rows_, key=lambda r: (r[0] is not None, r[0] or 0, h[r[1]]), reverse=True)
    got = {r.t: r.next_t for r in merkle.with_next(df.drop("h"), "id", "t", per_range=16).collect()}
    assert got == {a[1]: b[1] for a, b in zip(down, down[1:] + down[:1], strict=True)}


def test_toxicity(spark, docs, labels, empty):
    bad = ["zorgul", "kretin", "vermun"]
    made = []
    for i in range(240):
        text = prose(60, 1000 + i)
        if i % 4 == 0:
            w = text.split()
            w[10:10] = random.Random(i).choices(bad, k=4)
            text = " ".join(w)
        made.append((i, text))
    hidden = {900: "z0rgul", 901: "k r e t i n", 902: "vermuuuun", 903: "v.e.r.m.u.n", 904: "kr3t1n", 905: "zzorggul"}
    made += [(i, prose(20, i) + f" {w} " + prose(20, i + 1) + f" {w}") for i, w in hidden.items()]
    made += [(950 + i, prose(40, 5000 + i) + " 12 a1b2c3 b 4 you x2") for i in range(20)]
    df = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    lab = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(240)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score(df, lab, crc_mod("doc_id", 3) != 1).collect()}
    assert all(got[i].predicted == int(i % 4 == 0) for i in range(240)), [i for i in range(240) if got[i].predicted != int(i % 4 == 0)]
    assert [i for i in hidden if not got[i].predicted] == []
    assert not any(got[950 + i].predicted for i in range(20))
    out = toxicity.score(docs, labels, crc_mod("doc_id", 3) != 1).collect()
    assert len(out) == len(rows()) and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score(empty, labels, F.lit(True)).count() == 0


def test_learning_pieces():
    assert linear.byte_ngrams([b"", b"ab", b"abc"], (3,)).sum(1).tolist() == [0, 0, 1]
    x = linear.byte_ngrams([b"hello", b"hello world"], (2,))
    assert x[0].sum() == 4 and (x[1] >= x[0]).all()
    long = [b"abcdefg" * 50, b"", b"xy", b"hello world" * 9]
    for f in (linear.byte_ngrams, linear.character_ngrams):
        assert (f(long, (1, 2, 3)) == np.concatenate([f([t], (1, 2, 3)) for t in long])).all()
    codes = [np.frombuffer(t, np.uint8) for t in long]
    assert (linear.codes_ngrams(codes, (1, 2, 3), block=16) == linear.codes_ngrams(codes, (1, 2, 3))).all()
    assert linear.character_ngrams(["日本語".encode()], (3,)).sum() == 1
    assert linear.word_ngrams([b"a b c".split()]).sum() == 5
    r = np.random.default_rng(0)
    dense = (r.random((60, 40)) < 0.2).astype(np.float32)
    at = np.nonzero(dense)
    labels = (r.random((60, 3)) < 0.5).astype(np.float32)
    w, b = linear.logistics(*at, dense[at], labels, np.ones(60), 40, steps=900, rate=0.4, decay=1e-2)
    for k in range(3):
        one, add = linear.logistic(*at, dense[at], labels[:, k].astype(float), np.ones(60), 40, decay=1e-2)
        assert np.allclose(w[:, k], one, atol=1e-3) and abs(b[k] - add) < 1e-3
    z = np.linspace(-3, 3, 400)
    slope, add = linear.platt(z, (np.random.default_rng(0).random(400) < 1 / (1 + np.exp(-2 * z))).astype(float))
    assert 1 < slope < 4 and abs(add) < 1


@pytest.mark.parametrize("rows", [64])
def test_slices_by_bytes(rows):
    import pyarrow as pa

    from nightsift.llm.common import slices

    texts = ["x" * n for n in (10, 0, 5000, 3, 900, 900, 900, 2)] + [None] * 3 + ["y"] * 200
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["i", "t"])
    parts = list(slices([batch], rows, 1000))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(len(texts)))
    assert all(p.num_rows <= rows and (p.num_rows == 1 or sum(len(t or "") for t in p.column(1).to_pylist()) <= 1000) for p in parts)
