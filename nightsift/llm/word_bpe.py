"""Token ids of a BPE vocabulary with word ends, white space dropped, as the library gives them.

White space never stays in a token, so the white-space separated chunks of a text are encoded on their own, each distinct
one once per worker as long as its bounded memory holds. Merging is left to a fast public library: the end-of-word
mark becomes the byte 0xFF, which UTF-8 never holds, and the vocabulary's ids are in the order of its merges.
"""

from __future__ import annotations

import json
import os
import unicodedata
from array import array

import regex

from .token_counts import UNSURE, byte_alphabet

#: The vocabulary's pre-token pattern and end-of-word mark.
WORD_PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
END_BYTE = b"\xff"


class WordIds(dict):
    """Chunk (UTF-8, no white space) -> its ids as unsigned 32-bit numbers in the machine's (little-endian) order."""

    def __init__(self, tokenizer_json: str, most: int = 400_000):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.most, self.library = most, Tokenizer.from_str(tokenizer_json)
        spec, of = json.loads(tokenizer_json), byte_alphabet()
        ranks = {}
        for token, i in spec["model"]["vocab"].items():
            core, end = (token[: -len(WORD_END)], END_BYTE) if token.endswith(WORD_END) else (token, b"")
            if of.keys() >= set(core):
                ranks[bytes(map(of.__getitem__, core)) + end] = i
        ranks.setdefault(END_BYTE, 1 << 30)
        self.merge = tiktoken.Encoding("ranks", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.split, self.unsure = regex.compile(WORD_PRETOKEN).findall, regex.compile(UNSURE).search
        self.special = [x["content"] for x in spec["added_tokens"]]

    def encode(self, text: str) -> list[int]:
        if self.unsure(text) or any(s in text for s in self.special):
            return self.library.encode(text, add_special_tokens=False).ids
        text = unicodedata.normalize("NFC", text)
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()  # the library knows no final form
        return [i for word in ([text] if text.isalpha() else self.split(text)) for i in self.merge(word.encode() + END_BYTE)]

    def __missing__(self, chunk: bytes) -> bytes:
        if chunk.isalpha():  # ASCII letters alone, the most frequent kind
            ids = array("I", self.merge(chunk.lower() + END_BYTE)).tobytes()
        elif (core := chunk[:-1]).isalpha() and chunk[-1] in b".,:;!?":
            ids = self[core] + self[chunk[-1:]]
        else:
            ids = array("I", self.encode(chunk.decode())).tobytes()
        if len(self) >= self.most:
            self.clear()
        self[chunk] = ids
        return ids

    def text_ids(self, text: bytes) -> bytes:
        """The ids of a whole UTF-8 text. bytes.split cuts at the six ASCII white-space characters alone.

        Lower-casing A-Z first makes chunks fewer; special tokens, which begin with <|, must be seen as they are.
        """
        return b"".join(map(self.__getitem__, (text if b"<|" in text else text.lower()).split()))
