"""Cross-tokenizer alignment by whitespace-token anchors (operator 12).

Each text is tokenised whole by a byte-level BPE (A) and a sentencepiece model (B), and the tokens' bytes are checked
against the text's. A place is an anchor where tokens of both end and the next token of both begins with a space; anchors
cut a document into windows of token ids, mostly words. How the tokens of a window align depends on its ids alone, so
each worker keeps the alignments it has made under the pair of id tuples. Windows give a document its groups (cut where
tokens of both end) and its id pairs with their numbers of links; how many documents hold a pair, and which pairs are the
commonest of their A id, is then counted over the corpus.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices
from .token_counts import CUT, PRETOKEN, UNSURE, byte_alphabet

#: Pairs are numbered a * WIDTH + b; ids of B are below it.
WIDTH = 1 << 20
NAMES = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"]


class ByteLevel:
    """A: ids of a byte-level BPE vocabulary; special strings are ordinary text."""

    def __init__(self, tokenizer_json: str):
        import tiktoken
        from tokenizers import Tokenizer

        spec, of = json.loads(tokenizer_json), byte_alphabet()
        vocab = {k: i for k, i in spec["model"]["vocab"].items() if of.keys() >= set(k)}
        ranks = {bytes(map(of.__getitem__, k)): i for k, i in vocab.items()}
        self.library = Tokenizer.from_str(tokenizer_json)
        self.library.encode_special_tokens = True
        self.fast = tiktoken.Encoding("ranks", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.unsure = regex.compile(UNSURE).search  # characters that regular-expression engines class differently
        self.bytes: list[bytes] = [b""] * (max(spec["model"]["vocab"].values()) + 1)
        for k, i in ranks.items():
            self.bytes[i] = k

    def ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids if self.unsure(text) else self.fast(text)


class Pieces:
    """B: ids of a sentencepiece model, which adds the space before a text itself."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        #: No piece has a space after another character, so no merge reaches over the beginning of a word.
        self.words_apart = not any("▁" in p.lstrip("▁") for p in pieces)

    def ids(self, text: str) -> list[int]:
        return self.library.encode(text)


def parts_of(text: str, most: int) -> Iterator[str]:
    """The text in parts of about `most` characters, cut at spaces between words (which go), where both tokenizers part words anyway."""
    cut, at = regex.compile(CUT), 0
    while len(text) - at > most and (m := cut.search(text, at + most)):
        yield text[at : m.start()]
        at = m.end()
    yield text[at:]


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] numbers), start[1], ..."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class Numbers:
    """An array of whole numbers that grows by doubling."""

    def __init__(self) -> None:
        self.data, self.n = np.zeros(1024, np.int64), 0

    def extend(self, x: np.ndarray) -> None:
        if self.n + len(x) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(len(self.data) + len(x), np.int64)])
        self.data[self.n : self.n + len(x)] = x
        self.n += len(x)


class Windows(dict):
    """(ids of A, ids of B as bytes) -> number of the window's alignment.

    New windows are aligned together. An alignment is the text of its groups, their number, the number of links, and a run of
    (pair, links) entries; a pair may have several. The bytes of both sides are compared; `raw` has those on which they agree,
    None for others. `trim` forgets all where they hold over `most` bytes; numbers given before are void then. Groups of over
    `many` links are counted by distinct ids (a long run of one character has few).
    """

    def __init__(self, bytes_a: list[bytes], bytes_b: list[bytes], most: int = 96 << 20, many: int = 256):
        super().__init__()
        self.bytes_a, self.bytes_b, self.most, self.many = bytes_a, bytes_b, most, many
        self.size_a, self.size_b = (np.array([len(t) for t in x], np.int64) for x in (bytes_a, bytes_b))
        numbers = [str(i) for i in range(max(len(bytes_a), len(bytes_b)))]
        self.width, self.strings = len(numbers), [n + c for c in ",|;\n" for n in numbers]
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.held = 0
        self.texts: list[str] = []
        self.raw: list[bytes | None] = []
        self.groups, self.links, self.start, self.size, self.pairs, self.times = (Numbers() for _ in range(6))

    def trim(self) -> None:
        if self.held > self.most:
            self.reset()

    def numbers(self, keys: list[tuple[bytes, bytes]]) -> np.ndarray:
        """The windows' numbers; new ones are aligned."""
        found = list(map(self.get, keys))
        if None in found:
            self.learn(list(dict.fromkeys(k for k, n in zip(keys, found, strict=True) if n is None)))
            found = list(map(self.__getitem__, keys))
        return np.array(found, np.int64)

    def learn(self, keys: list[tuple[bytes, bytes]]) -> None:
        a, b = (np.frombuffer(b"".join(x), "<u4").astype(np.int64) for x in zip(*keys, strict=True))
        ends_a = np.cumsum([len(k) // 4 for k, _ in keys])  # of windows, in tokens
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])  # of tokens, in bytes
        at = np.zeros(int(end_a[-1]) + 1, bool)
        at[end_b] = True
        to_a = np.flatnonzero(at[end_a]) + 1  # groups: ends and numbers of tokens
        to_b = np.searchsorted(end_b, end_a[to_a - 1]) + 1
        from_a, from_b = np.r_[0, to_a[:-1]], np.r_[0, to_b[:-1]]
        n_a, n_b = to_a - from_a, to_b - from_b
        window = np.searchsorted(ends_a, from_a, "right")

        raw_a, raw_b = b"".join(map(self.bytes_a.__getitem__, a.tolist())), b"".join(map(self.bytes_b.__getitem__, b.tolist()))
        cuts = [0, *end_a[ends_a - 1].tolist()]
        raw = [raw_a[s:e] for s, e in zip(cuts, cuts[1:])]  # noqa: B905
        if raw_a != raw_b:
            raw = [x if x == raw_b[s:e] else None for x, s, e in zip(raw, cuts, cuts[1:])]  # noqa: B905

        # the groups' text: each token's number with the mark after it
        marks = np.zeros(len(a) + len(b), np.int64)
        mark_a = a.copy()
        mark_a[to_a - 1] += self.width
        mark_b = b.copy()
        mark_b[to_b - 1] += 2 * self.width
        mark_b[to_b[np.searchsorted(to_a, ends_a)] - 1] += self.width
        marks[np.arange(len(a)) + np.repeat(from_b, n_a)] = mark_a
        marks[np.arange(len(b)) + np.repeat(to_a, n_b)] = mark_b
        texts = "".join(map(self.strings.__getitem__, marks.tolist())).split("\n")[:-1]

        count = n_a * n_b
        few = np.flatnonzero(count <= self.many)
        of = np.repeat(few, count[few])
        k = spread(np.zeros(len(few), np.int64), count[few])
        pairs = [a[from_a[of] + k // n_b[of]] * WIDTH + b[from_b[of] + k % n_b[of]]]
        times, where = [np.ones(len(k), np.int64)], [window[of]]
        for g in np.flatnonzero(count > self.many).tolist():
            (ka, na), (kb, nb) = (np.unique(x, return_counts=True) for x in (a[from_a[g] : to_a[g]], b[from_b[g] : to_b[g]]))
            pairs.append((ka[:, None] * WIDTH + kb[None]).ravel())
            times.append((na[:, None] * nb[None]).ravel())
            where.append(np.full(len(pairs[-1]), window[g]))
        pairs, times, where = map(np.concatenate, (pairs, times, where))
        if len(few) < len(count):
            order = np.argsort(where, kind="stable")
            pairs, times, where = pairs[order], times[order], where[order]
        size = np.bincount(where, minlength=len(keys))

        first = len(self.texts)
        self.update(zip(keys, range(first, first + len(keys)), strict=True))
        self.texts += texts
        self.raw += raw
        self.groups.extend(np.bincount(window, minlength=len(keys)))
        self.links.extend(np.bincount(window, count, len(keys)).astype(np.int64))
        self.start.extend(self.pairs.n + np.cumsum(size) - size)
        self.size.extend(size)
        self.pairs.extend(pairs)
        self.times.extend(times)
        self.held += 550 * len(keys) + len(raw_a) + 4 * (len(a) + len(b)) + sum(map(len, texts)) + 16 * len(pairs)

    def entries(self, kinds: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of these windows, and their links when each window occurs so often."""
        size = self.size.data[kinds]
        at = spread(self.start.data[kinds], size)
        return self.pairs.data[at], self.times.data[at] * np.repeat(often, size)


class Aligner:
    """Aligns texts, long ones in parts of about `part` characters."""

    def __init__(self, tokenizer_json: str, model: bytes, part: int = 1 << 18):
        self.a, self.b, self.part = ByteLevel(tokenizer_json), Pieces(model), part
        space = lambda x: np.array([t.startswith(b" ") for t in x.bytes])
        self.space_a, self.space_b = space(self.a), space(self.b)
        self.windows = Windows(self.a.bytes, self.b.bytes)
        random = np.random.default_rng(12)
        self.mix = [random.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1) for n in (len(self.space_a), len(self.space_b), 1 << 12)]

    def parts(self, text: str) -> list[str]:
        return [text] if len(text) <= self.part or not self.b.words_apart else list(parts_of(text, self.part))

    def cut(self, a: np.ndarray, b: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where windows begin, in tokens of each side; `begins`: places, in bytes, of the parts' beginnings, which are anchors."""
        start_a, start_b = (np.cumsum(size) - size for size in (self.windows.size_a[a], self.windows.size_b[b]))
        marked = np.zeros(max(int(start_a[-1]), int(start_b[-1])) + 1, np.int8)
        marked[start_a[self.space_a[a]]] = 1
        marked[start_b[self.space_b[b]]] += 1
        marked[begins] = 2
        anchors = np.flatnonzero(marked > 1)
        return np.searchsorted(start_a, anchors), np.searchsorted(start_b, anchors)

    def numbers(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
        """The windows' numbers. Equal windows of these texts are found by a hash and verified, so that one of them is looked up."""
        size_a, size_b = np.diff(at_a, append=len(a)), np.diff(at_b, append=len(b))
        place = len(self.mix[2]) - 1
        h = [np.add.reduceat(mix[ids] * self.mix[2][spread(np.zeros_like(size), size) & place], at) for mix, ids, at, size in ((self.mix[0], a, at_a, size_a), (self.mix[1], b, at_b, size_b))]
        _, first, of = np.unique(h[0] ^ (h[1] * np.uint64(0x9E3779B97F4A7C15)), return_index=True, return_inverse=True)
        like = first[of]
        same = (size_a == size_a[like]).all() and (size_b == size_b[like]).all() and (a == a[spread(at_a[like], size_a)]).all() and (b == b[spread(at_b[like], size_b)]).all()
        if not same:  # two windows share a hash: look all of them up
            first = of = np.arange(len(at_a))
        ids_a, ids_b = a.astype("<u4").tobytes(), b.astype("<u4").tobytes()
        bounds = zip(*((4 * x).tolist() for x in (at_a[first], (at_a + size_a)[first], at_b[first], (at_b + size_b)[first])), strict=True)
        return self.windows.numbers([(ids_a[s:e], ids_b[t:f]) for s, e, t, f in bounds])[of]

    def align(self, texts: list[str]) -> pa.RecordBatch:
        """Per text: n_a, n_b, n_groups, n_links, groups_sha256, distinct pairs and their links; zeros where a tokenizer loses bytes."""
        self.windows.trim()
        of, size_of = self.windows, (self.windows.size_a, self.windows.size_b)
        owner, data, sides = [], [], ([], [])
        for i, text in enumerate(texts):
            got = [((" " + p).encode(), np.array(self.a.ids(" " + p), np.int64), np.array(self.b.ids(p), np.int64)) for p in (self.parts(text) if text else [])]
            if all(len(d) == size_of[0][x].sum() == size_of[1][y].sum() for d, x, y in got):
                for d, x, y in got:
                    owner.append(i)
                    data.append(d)
                    sides[0].append(x)
                    sides[1].append(y)
        out = np.zeros((4, len(texts)), np.int64)
        shas, codes, links = [""] * len(texts), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if owner:
            a, b = map(np.concatenate, sides)
            count_a, count_b = (np.array(list(map(len, x))) for x in sides)
            begins = np.cumsum([0, *map(len, data[:-1])])
            at_a, at_b = self.cut(a, b, begins)
            w = self.numbers(a, b, at_a, at_b)
            edge = np.searchsorted(at_a, np.cumsum(count_a) - count_a)  # of parts, in windows
            listed, edges = w.tolist(), [*edge.tolist(), len(w)]
            right, said = [True] * len(texts), {}
            for i, d, s, e in zip(owner, data, edges, edges[1:]):  # noqa: B905
                raw = list(map(of.raw.__getitem__, listed[s:e]))
                right[i] &= None not in raw and b"".join(raw) == d
                if i in said:  # another part of the same text
                    said[i].update(b";")
                said.setdefault(i, hashlib.sha256()).update(";".join(map(of.texts.__getitem__, listed[s:e])).encode())
            for row, x in enumerate((count_a, count_b, np.add.reduceat(of.groups.data[w], edge), np.add.reduceat(of.links.data[w], edge))):
                np.add.at(out[row], owner, x)
            out *= right
            shas = [said[i].hexdigest() if i in said and right[i] else "" for i in range(len(texts))]

            text_of = np.repeat(np.array(owner), np.diff(edges))
            keep = np.array(right)[text_of]
            kinds, often = np.unique(text_of[keep] * len(of.texts) + w[keep], return_counts=True)
            text_of, kinds = kinds // len(of.texts), kinds % len(of.texts)
            pairs, times = of.entries(kinds, often)
            codes, at = np.unique(np.repeat(text_of, of.size.data[kinds]) << 40 | pairs, return_inverse=True)
            links = np.bincount(at, times, len(codes)).astype(np.int64)
        ends = np.searchsorted(codes, np.arange(len(texts) + 1) << 40).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (codes & ((1 << 40) - 1), links)]
        return pa.RecordBatch.from_arrays([*map(pa.array, out), pa.array(shas, pa.string()), *lists], NAMES)


def align(docs: DataFrame, byte_bpe_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", most_hot: int = 100_000) -> DataFrame:
    """Per row: the id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Links are the pairs of an A and a B token of one group. A pair of ids counts the rows that hold it linked, over the
    whole corpus; n_best: links whose count is the highest of their A id (ties included); count_sum: counts summed over
    links. Null and empty texts, and those whose tokens lose or change bytes, have zeros and an empty groups_sha256.
    Repeated rows stay and count as rows each; an empty table gives an empty one; other columns are not used.

    Texts are tokenised once: pairs go to the shared folder. A pair that has at least one of `most_hot` parts of all (row,
    pair) rows is broadcast with its count, as there are at most `most_hot` of those; the others are joined by a shuffle, in
    which none fills a task.
    """
    with open(byte_bpe_path, encoding="utf-8") as f, open(piece_path, "rb") as g:
        sent = docs.sparkSession.sparkContext.broadcast((f.read(), g.read()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        aligner = Aligner(*sent.value)
        for b in slices(batches, 1024, 2 << 20):
            out = aligner.align([t or "" for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), *out.columns], ["id", *NAMES])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    rows = rows.mapInArrow(run, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, links array<long>")
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "aligned")  # written, so a row's number is fixed

    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = materialize(counts, "pairs")
    first = F.floor(F.col("pair") / WIDTH)
    top = counts.groupBy(first.alias("a")).agg(F.max("n").alias("top"))  # at most as many rows as A has ids
    total = counts.agg(F.sum("n")).first()[0] or 0
    counts = counts.withColumn("a", first).join(F.broadcast(top), "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    often = F.col("n") * most_hot >= total
    each = rows.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.links").alias("m"))
    known = each.join(F.broadcast(counts.where(often)), "pair", "left")
    rare = known.where(F.col("n").isNull()).select("row", "pair", "m").join(counts.where(~often), "pair")
    sums = lambda df: df.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("m")).alias("count_sum"))
    both = sums(known.where(F.col("n").isNotNull())).union(sums(rare)).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return rows.drop("pairs", "links").join(both, "row", "left").select(F.col("id").alias(id_col), *NAMES[:4], zero("n_best"), zero("count_sum"), "groups_sha256")
