"""Distinct word shingles of texts as 64-bit hashes, or as exact numbers among a few texts.

Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return, after A-Z became a-z. A shingle is `width` words in a row; a text with
fewer words, but at least one, has its whole sequence as its only shingle. Hashes only
propose: what depends on equality is confirmed on the words themselves by exact_sets.
"""

from __future__ import annotations

import hashlib

import numpy as np

U = np.uint64
ODD = 0x9E3779B97F4A7C15
#: The key of the word hash.
KEY = 0x6A09E667F3BCC908
#: Bytes that are hashed at once, about; longer spans than LONG bytes are hashed one by one.
PIECE, LONG = 1 << 20, 512
#: The first k bytes of eight.
FIRST_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], U)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit (the finalizer of SplitMix64)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def span_hashes(buf: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A keyed hash of each span, eight bytes at a time, each mixed into what came before.

    buf goes on for eight bytes past the last span."""
    size = stop - start
    h = mix(size.astype(U) * U(ODD) ^ U(KEY))
    if not len(size):
        return h
    eights = np.ndarray(len(buf) - 7, "<u8", buf, strides=(1,))
    some = size > 0
    h[some] = mix((h[some] ^ (eights[start[some]] & FIRST_BYTES[np.minimum(size[some], 8)])) + U(ODD))
    todo, done = np.nonzero((size > 8) & (size <= LONG))[0], 8
    while len(todo):
        part = eights[start[todo] + done] & FIRST_BYTES[np.minimum(size[todo] - done, 8)]
        h[todo] = mix((h[todo] ^ part) + U(ODD))
        done += 8
        todo = todo[size[todo] > done]
    for i in np.nonzero(size > LONG)[0].tolist():
        raw = hashlib.blake2b(buf[start[i] : stop[i]].tobytes(), digest_size=8, key=KEY.to_bytes(8, "little")).digest()
        h[i] = int.from_bytes(raw, "little")
    return h


def hashed(piece: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of a piece of bytes that begins and ends between words."""
    buf = np.frombuffer(piece.lower() + bytes(8), np.uint8)
    gap = (buf == 32) | ((buf >= 9) & (buf <= 13))
    gap[len(piece) :] = True
    edge = np.diff(np.concatenate([[True], gap]).view(np.int8))
    start, stop = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
    return start, span_hashes(buf, start, stop)


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the number of words of each text.

    Bytes go through in pieces of about PIECE that are cut between words, so that memory
    stays a small multiple of the text however long one is."""
    raw = [(t or "").encode() for t in texts]
    if not raw:
        return np.empty(0, U), np.empty(0, np.int64)
    ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
    joined = b" ".join(raw) + b" "
    starts, words, a = [], [], 0
    while a < len(joined):
        b = min(a + PIECE, len(joined))
        if b < len(joined):
            at = max(joined.rfind(g, a, b) for g in (b" ", b"\n"))
            if at < 0:  # a word longer than a piece: up to the next space, which there is
                at = joined.find(b" ", b)
            b = at + 1
        s, w = hashed(joined[a:b])
        starts.append(s + a)
        words.append(w)
        a = b
    start = np.concatenate(starts)
    return np.concatenate(words), np.diff(np.concatenate([[0], np.searchsorted(start, ends)]))


def sequence(text: str | None) -> bytes:
    """The words of a text with a space between them: equal for equal word sequences."""
    return b" ".join((text or "").encode().lower().split())


def runs(count: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of texts with so many words, one after another: how many words are left at each place,
    and whether a shingle starts there."""
    first = np.cumsum(count) - count
    place = np.arange(int(count.sum())) - np.repeat(first, count)
    left = np.repeat(count, count) - place
    return left, (left >= width) | (place == 0)


def shingle_sets(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, ascending within each text, and how many each text has."""
    word, count = words_of(texts)
    left, kept = runs(count, width)
    shingle = np.zeros(len(word), U)
    for i in range(width):
        inside = left > i
        part = np.zeros(len(word), U)
        part[inside] = word[np.nonzero(inside)[0] + i]
        shingle = mix(shingle * U(0xA0761D6478BD642F) + part + U(i + 1))
    owner = np.repeat(np.arange(len(count)), count)[kept]
    shingle = shingle[kept]
    sizes = np.bincount(owner, minlength=len(count))
    ends = np.cumsum(sizes)
    for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        shingle[a:b].sort()
    new = np.ones(len(shingle), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])
    return shingle[new], np.bincount(owner[new], minlength=len(count))


def exact_sets(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Like shingle_sets, but numbers that are equal only for equal shingles of these texts."""
    number: dict[bytes, int] = {}
    split = [(t or "").encode().lower().split() for t in texts]
    count = np.fromiter(map(len, split), np.int64, len(split))
    word = np.fromiter((number.setdefault(w, len(number) + 1) for s in split for w in s), np.int64, int(count.sum()))
    left, kept = runs(count, width)
    at = np.nonzero(kept)[0]
    code, top, many = np.zeros(len(at), np.int64), 1, len(number) + 1
    for i in range(width):
        part = np.zeros(len(at), np.int64)  # 0 stands past the end of a short text
        inside = left[at] > i
        part[inside] = word[at[inside] + i]
        if top * many >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
            top = len(at) + 1
        code, top = code * many + part, top * many
    owner = np.repeat(np.arange(len(count)), count)[kept]
    order = np.lexsort((code, owner))
    code, owner = code[order], owner[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
    return code[new], np.bincount(owner[new], minlength=len(count))
