"""Token ids of texts as packed little-endian unsigned 32-bit numbers."""

from __future__ import annotations

import base64
import re
from array import array
from functools import lru_cache

SPECIAL = "<|endoftext|>"
CACHED_WORDS = 1_000_000


class WordCache(dict):
    """Bytes of the ids of a piece of text; computed when missing, emptied when full."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        packed = array("I", self.encode(piece)).tobytes()
        if len(piece) < 64:
            self[piece] = packed
        return packed


class Encoder:
    """Byte-level BPE ids, equal to those of the tokenizer file without added special tokens.

    A space between two other characters that are no white space always starts a new pre-token, so a text is cut there
    and the parts, which repeat much, are encoded once and kept. Texts with other white space next to a space are encoded
    whole, and a text that holds the special token's string goes to the tokenizer itself, which gives it its own id.
    """

    odd = re.compile(r" \s|\s ")

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        plain = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.encode = plain.encode_ordinary
        self.first = WordCache(self.encode)
        self.later = WordCache(lambda piece: self.encode(" " + piece))

    def packed(self, text: str) -> bytes:
        if SPECIAL in text:
            return array("I", self.full.encode(text, add_special_tokens=False).ids).tobytes()
        if self.odd.search(text):
            return array("I", self.encode(text)).tobytes()
        head, *rest = text.split(" ")
        return self.first[head] + b"".join(map(self.later.__getitem__, rest))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and tokenizer file."""
    return Encoder(path)
