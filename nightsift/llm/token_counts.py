"""Token counts with a whole-token shortcut (operator 7).

A byte-level BPE vocabulary holds many strings that, as a pre-token, encode alone as one token. Which ones do is proved
offline: the driver encodes every vocabulary string once with the library itself and keeps those that come back as
their own single id. Tasks cut texts into pre-tokens, count the proved ones directly, and merge only the rest, each
distinct one once per worker as long as its bounded memory holds. The merging is done by a faster public library over
the ranks of the same vocabulary, whose ids are in the order of its merges.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: The published pre-token pattern of byte-level BPE, and the code points that the library's regular
#: expressions and Python's class alike. Texts with others are given whole to the library.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
UNSURE = r"[^\x00-\x1b\x20-\x84\x86-ͷЀ-ҁ‐-‧‰-⁞€ぁ-ゖァ-ヺ一-龥가-힣]"
#: A pre-token always begins at such a space, so long texts may be cut there.
CUT = r"(?<=\S) (?=[A-Za-z])"


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def whole_tokens(tokenizer_json: str) -> frozenset[str]:
    """Vocabulary strings that are one pre-token and that the library encodes alone as exactly their own id."""
    from tokenizers import Tokenizer

    tokenizer, of = Tokenizer.from_str(tokenizer_json), byte_alphabet()
    special = {x["content"] for x in json.loads(tokenizer_json)["added_tokens"]}
    split, texts = regex.compile(PRETOKEN), {}
    for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
        try:
            text = bytes(of[c] for c in token).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if text not in special and (m := split.fullmatch(text)):
            texts[m[0]] = i
    encoded = tokenizer.encode_batch(list(texts), add_special_tokens=False)
    return frozenset(t for (t, i), e in zip(texts.items(), encoded, strict=True) if e.ids == [i])


def merger(tokenizer_json: str) -> Callable[[str], list[int]]:
    """Encodes a pre-token by merging its bytes in the order of the vocabulary's ids."""
    import tiktoken

    of = byte_alphabet()
    ranks = {bytes(map(of.__getitem__, k)): i for k, i in json.loads(tokenizer_json)["model"]["vocab"].items() if of.keys() >= set(k)}
    return tiktoken.Encoding("ranks", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class PretokenCounts(dict):
    """Pre-token -> number of tokens. Proved ones are there from the start; others are merged when first met."""

    def __init__(self, merge: Callable[[str], list[int]], whole: frozenset[str], most: int):
        super().__init__(dict.fromkeys(whole, 1))
        self.merge, self.whole, self.most = merge, whole, most

    def __missing__(self, pretoken: str) -> int:
        n = len(self.merge(pretoken))
        if len(self) >= self.most:
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        self[pretoken] = n
        return n


class Counter:
    """Counts the tokens of texts as the library would."""

    def __init__(self, tokenizer_json: str, whole: frozenset[str], most: int = 400_000, chunk: int = 1 << 20):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.counts = PretokenCounts(merger(tokenizer_json), whole, most)
        self.split, self.unsure, self.cut = regex.compile(PRETOKEN).findall, regex.compile(UNSURE).search, regex.compile(CUT)
        special = [regex.escape(x["content"]) for x in json.loads(tokenizer_json)["added_tokens"]]
        self.special = regex.compile("|".join(special)) if special else None
        self.chunk = chunk

    def pieces(self, text: str) -> Iterator[str]:
        """The text in pieces of about `chunk` characters whose pre-tokens are those of the text."""
        at = 0
        while len(text) - at > self.chunk and (m := self.cut.search(text, at + self.chunk)):
            yield text[at : m.start()]
            at = m.start()
        yield text[at:] if at else text

    def count(self, text: str) -> int:
        if self.unsure(text):
            return sum(len(self.tokenizer.encode(x, add_special_tokens=False).ids) for x in self.pieces(text))
        n = 0
        if self.special and self.special.search(text):  # the library's default: one token each
            parts = self.special.split(text)
            n, texts = len(parts) - 1, parts
        else:
            texts = [text]
        of = self.counts.__getitem__
        return n + sum(sum(map(of, self.split(x))) for part in texts for x in self.pieces(part))


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """Per row: the id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    tokenizer_path: a byte-level BPE tokenizer.json; it is read on the driver and sent to the tasks, as is the bounded
    set of proved whole tokens. Narrow: no shuffle. Null texts count as empty (0, 0, false); repeated rows stay; an
    empty table gives an empty one; other columns of docs are not used.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    sent = docs.sparkSession.sparkContext.broadcast((tokenizer_json, whole_tokens(tokenizer_json)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter = Counter(*sent.value)
        for b in slices(batches):
            n = [counter.count(x or "") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    out = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
