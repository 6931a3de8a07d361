"""Byte-level BPE by ranks, with a segment tree over byte positions, and its decoding.

Each leaf of the tree stands for a byte position and holds the rank of the pair that
starts there; the root gives the leftmost pair of lowest rank. A merge changes three
leaves (the merged pair, its live left neighbour and the swallowed right part), each a
logarithmic update. Short pieces of a batch are merged side by side, one tree a row of a
matrix; longer ones have a tree of their own, so a piece of n bytes costs n log n.

Defined results: a null text is empty and gives no ids; equal rows give equal rows.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pick, ship, text_chunks
from .pieces import Memo, splitter

NONE = np.int64(1) << 62
WIDEST = 64
#: Leaves of the trees that are worked on together; bytes of text that are split together.
CELLS, TEXT = 1 << 17, 1 << 19


class Ranks:
    """Ranks of byte strings, and of the pairs of ids whose bytes together have a rank."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = [b""] * (max(self.rank.values()) + 1)
        for token, r in self.rank.items():
            self.bytes_of[r] = token
        self.byte_id = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        pairs = [((self.rank[t[:i]] << 20) | self.rank[t[i:]], r) for t, r in self.rank.items() for i in range(1, len(t)) if t[:i] in self.rank and t[i:] in self.rank]
        bits = max(10, len(pairs).bit_length() + 1)
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, NONE, np.int64)
        keys, values = np.array(pairs, np.int64).reshape(-1, 2).T
        at = self.place(keys)
        while len(keys):  # linear probing, all keys a step at a time
            free = self.keys[at] < 0
            _, first = np.unique(at[free], return_index=True)
            won = np.nonzero(free)[0][first]
            self.keys[at[won]], self.values[at[won]] = keys[won], values[won]
            rest = np.ones(len(keys), bool)
            rest[won] = False
            keys, values, at = keys[rest], values[rest], (at[rest] + 1) & self.mask
        self.memo = Memo(self.encode_pieces)

    def place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; an id below 0 has no pair."""
        keys = np.where((a < 0) | (b < 0), -2, (a << 20) | b)
        at = self.place(keys)
        out = np.full(len(keys), NONE, np.int64)
        todo = np.nonzero(keys >= 0)[0]
        while len(todo):
            seen = self.keys[at[todo]]
            hit = seen == keys[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (seen >= 0)]
            at[todo] = (at[todo] + 1) & self.mask
        return out

    def rank_of(self, a: int, b: int) -> int | None:
        """The rank of one pair, for trees of their own."""
        key = (a << 20) | b
        at = ((key * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF) >> int(self.shift)
        while (seen := self.keys.item(at)) != key:
            if seen < 0:
                return None
            at = (at + 1) & self.mask
        return self.values.item(at)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        raw = [p.encode() for p in pieces]
        out: list[bytes | None] = [None] * len(raw)
        groups: dict[int, list[int]] = {}
        for i, w in enumerate(raw):
            whole = self.rank.get(w)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(w) > WIDEST:
                out[i] = np.array(self.merge_one(w), "<u4").tobytes()
            else:
                groups.setdefault(max(8, 1 << (len(w) - 1).bit_length()), []).append(i)
        for width, rows in groups.items():
            step = max(1, CELLS // width)
            for a in range(0, len(rows), step):
                part = rows[a : a + step]
                for i, ids in zip(part, self.merge_many([raw[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def merge_many(self, words: list[bytes], width: int) -> list[bytes]:
        n, levels = len(words), width.bit_length() - 1
        sizes = np.fromiter(map(len, words), np.int64, n)
        text = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        inside = np.arange(width) < sizes[:, None]
        ids = np.full((n, width + 1), -1, np.int64)
        ids[:, :width][inside] = self.byte_id[text[inside]]
        nxt = np.minimum(np.arange(1, width + 2), sizes[:, None])
        nxt[nxt >= sizes[:, None]] = width
        prv = np.tile(np.arange(-1, width), (n, 1))
        tree = np.full((n, 2 * width), NONE, np.int64)
        rank = self.ranks_of(ids[:, :width].ravel(), ids[:, 1:].ravel()).reshape(n, width)
        tree[:, width:] = np.where(rank < NONE, rank * width + np.arange(width), NONE)
        for j in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * j], tree[:, 2 * j + 1], out=tree[:, j])
        tree, ids, nxt, prv = tree.ravel(), ids.ravel(), nxt.ravel(), prv.ravel()

        def put(rows, pos, value):
            base = rows * (2 * width)
            j = pos + width
            tree[base + j] = value
            for _ in range(levels):
                j = j >> 1
                k = base + 2 * j
                tree[base + j] = np.minimum(tree[k], tree[k + 1])

        def pair_at(rows, pos, after):
            row = rows * (width + 1)
            r = self.ranks_of(ids[row + pos], ids[row + after])
            return np.where(r < NONE, r * width + pos, NONE)

        rows = np.arange(n)
        while True:
            root = tree[rows * (2 * width) + 1]
            rows, root = rows[root < NONE], root[root < NONE]
            if not len(rows):
                break
            row, pos = rows * (width + 1), root % width
            right = nxt[row + pos]
            after = nxt[row + right]
            ids[row + pos] = root // width
            ids[row + right] = -1
            nxt[row + pos] = after
            prv[row + after] = pos
            put(rows, right, NONE)
            put(rows, pos, pair_at(rows, pos, after))
            left = prv[row + pos]
            has = left >= 0
            put(rows[has], left[has], pair_at(rows[has], left[has], pos[has]))
        ids = ids.reshape(n, width + 1)
        live = ids >= 0
        ends = np.cumsum(live.sum(axis=1)).tolist()
        flat = ids[live].astype("<u4").tobytes()
        return [flat[4 * a : 4 * b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def merge_one(self, word: bytes) -> list[int]:
        n = len(word)
        width = 1 << (n - 1).bit_length()
        ids = [int(self.byte_id[b]) for b in word]
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        none, pair = (1 << 62), self.rank_of
        tree = [none] * (2 * width)
        for i in range(n - 1):
            r = pair(ids[i], ids[i + 1])
            if r is not None:
                tree[width + i] = r * width + i
        for j in range(width - 1, 0, -1):
            tree[j] = min(tree[2 * j], tree[2 * j + 1])

        def put(pos, value):
            j = pos + width
            tree[j] = value
            j >>= 1
            while j:
                best = tree[2 * j] if tree[2 * j] < tree[2 * j + 1] else tree[2 * j + 1]
                if tree[j] == best:
                    break
                tree[j] = best
                j >>= 1

        def pair_at(pos, after):
            r = pair(ids[pos], ids[after]) if after < n else None
            return none if r is None else r * width + pos

        while tree[1] < none:
            r, pos = divmod(tree[1], width)
            right = nxt[pos]
            after = nxt[right]
            ids[pos], ids[right], nxt[pos] = r, -1, after
            if after < n:
                prv[after] = pos
            put(right, none)
            put(pos, pair_at(pos, after))
            if prv[pos] >= 0:
                put(prv[pos], pair_at(prv[pos], pos))
        return [i for i in ids if i >= 0]

    def decode(self, ids: bytes) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])


_RANKS: dict[str, Ranks] = {}


def ranks(path: str) -> Ranks:
    if path not in _RANKS:
        _RANKS[path] = Ranks(path)
    return _RANKS[path]


def round_trip(path: str, pattern: str, with_ids: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] + ([("ids", pa.binary())] if with_ids else []))

    def run(batches):
        table, split = ranks(path), splitter(pattern)
        for b in text_chunks(batches, TEXT):
            docs = [split.findall(t or "") for t in b.column(1).to_pylist()]
            ids = table.memo.encode(docs)
            cols = [b.column(0).cast(pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids]), pa.array([hashlib.sha256(table.decode(x)).hexdigest() for x in ids])]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(ids, pa.binary())] if with_ids else []), schema=schema)

    return run


def encode_documents(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and with_ids: the ids as bytes)."""
    ship(docs.sparkSession)
    return pick(docs, "doc_id", "text").mapInArrow(round_trip(path, pattern, with_ids), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids binary" if with_ids else ""))
