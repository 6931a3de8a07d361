"""Splitting texts into the pieces that byte-level BPE merges separately, and a bounded memo."""

from __future__ import annotations

import regex

#: Pieces that a worker remembers at most; past that it forgets them all and starts anew.
MEMO = 100_000

#: White_Space of Unicode, which the pattern's \s means.
SPACE = r"\t-\r \x85\xa0  -     　"


def splitter(pattern: str) -> regex.Pattern:
    """The pattern with \\s and \\S spelled out, as regex's own \\s also takes U+001C to U+001F."""
    out = pattern.replace(r"[^\s", rf"[^{SPACE}").replace(r"\S", rf"[^{SPACE}]").replace(r"\s", rf"[{SPACE}]")
    return regex.compile(out)


class Memo(dict):
    """piece -> little-endian uint32 ids; learn() encodes what is missing in one call."""

    def __init__(self, encode_many, limit: int = MEMO):
        self.encode_many, self.limit = encode_many, limit

    def learn(self, pieces: set) -> None:
        if len(self) > self.limit:
            self.clear()
        missing = [p for p in pieces if p not in self]
        if missing:
            self.update(zip(missing, self.encode_many(missing), strict=True))

    def encode(self, docs: list[list[str]]) -> list[bytes]:
        """The ids of each document's pieces; documents go in groups that the memo can hold."""
        out, a = [], 0
        while a < len(docs):
            known, b = set(), a
            while b < len(docs) and (b == a or len(known) < self.limit // 2):
                known.update(docs[b])
                b += 1
            self.learn(known)
            out += [b"".join(map(self.__getitem__, d)) for d in docs[a:b]]
            a = b
        return out
