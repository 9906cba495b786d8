"""Token ids of byte-level BPE vocabularies, a white-space unit at a time."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

#: Unicode White_Space, which is what the vocabulary's own splitting goes by.
SPACES = "\t-\r \x85\xa0  -     　"
#: A word takes one space before it; the rest of a run of white space stands apart.
UNIT = re.compile(f" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]")
CACHE_UNITS = 400_000


def _byte_of_letter() -> dict[str, int]:
    """The letters such vocabularies write bytes with: visible Latin-1 as itself, the rest from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteTokens:
    """Encodes ordinary text; strings of special tokens in it are ordinary text too."""

    def __init__(self, blob: bytes):
        import public_tokenizers
        import tiktoken

        spec = json.loads(blob)
        before = spec["pre_tokenizer"]
        if before["type"] != "ByteLevel" or before["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("only byte-level BPE without normaliser and prefix space")
        special = {t["content"] for t in spec["added_tokens"]}
        letters = _byte_of_letter()
        ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        order = [spec["model"]["vocab"]["".join(m)] for m in merges]
        if order != sorted(order):
            raise ValueError("merges are not in the order of their ids")
        self.encoding = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.cache: dict[str, bytes] = {}

    def _learn(self, units: Sequence[str]) -> None:
        encode = self.encoding.encode_ordinary
        for unit in units:
            self.cache[unit] = array("I", encode(unit)).tobytes()

    def encode_batch(self, texts: Sequence[str]) -> Iterator[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        for at in range(0, len(texts), 1000):
            lists = [UNIT.findall(t) for t in texts[at : at + 1000]]
            if len(self.cache) > CACHE_UNITS:
                self.cache.clear()
            self._learn(list(set().union(*lists).difference(self.cache)))
            for units in lists:
                yield b"".join(map(self.cache.__getitem__, units))


@lru_cache(maxsize=4)
def tokens_of(blob: bytes) -> ByteTokens:
    """One vocabulary per worker and file."""
    return ByteTokens(blob)
