"""Token ids as Re-Pair grammars: binary shards with random access.

Documents are put in the order of doc_id, encoded, closed with an end id and cut into
blocks of about BLOCK ids at document bounds. In each block frequent pairs of ids become
nonterminals until no pair is left whose replacement would make the written block smaller:
a rule takes as many bytes as two symbols and a length, so that is a pair that occurs five
times, or four times past 65,536 symbols. The order of replacement: the first round takes
all pairs that occur at least half as often as the most frequent one, each further round
halves that number. Of more rules than two bytes can tell apart, the most frequent ones come
first, and a round that needs wider symbols is only made if the block still gets smaller.
Where two pairs overlap, the more frequent one goes first, of equals the one with the
smaller ids; runs of one symbol pair up from the left. A shard file (Parquet) has a row a block: rules, expansion lengths,
the symbols that are left, and the documents' ids and lengths, so any range of ids is
decoded by expanding only the symbols that cover it.

Defined results: a null text is empty (its only id is the end id); null ids come first;
rows with equal ids follow in the order of a hash of their texts.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import new_folder, pick, ship, shuffle_partitions, text_chunks
from .shingles import FIRST_BYTES, span_hashes

BLOCK = 1 << 20
END_ID = 2
HASH_BITS = 20
#: So many symbols fit two bytes.
SHORT = 1 << 16
#: Bytes of text that are encoded together, about; a longer text is cut between words.
TEXT = 4 << 20
#: A worker remembers 0.7 * 2 ** MEMO_BITS words of at most LONGEST bytes.
MEMO_BITS, LONGEST = 22, 200
#: Controls, and all that some library may take for white space.
SPACES = re.compile("[\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]")
#: A place where a text may be cut: a single space between plain letters or digits.
CUT = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


class Grammar:
    """base terminals, rules (pairs of symbols), their expansion lengths, and the symbols left."""

    def __init__(self, base: int, rules: np.ndarray, lengths: np.ndarray, symbols: np.ndarray):
        self.base, self.rules, self.lengths, self.symbols = base, rules, lengths, symbols

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Symbols to ids: the rules that they need are expanded once, the shallow ones first."""
        base, rules = self.base, self.rules
        needed, found = np.zeros(len(rules), bool), np.zeros(len(rules), bool)
        found[symbols[symbols >= base] - base] = True
        while found.any():
            needed |= found
            below = rules[found].ravel()
            found = np.zeros(len(rules), bool)
            found[below[below >= base] - base] = True
            found &= ~needed
        k = np.nonzero(needed)[0]
        size, start = self.lengths_of(np.arange(base + len(rules))), np.arange(base + len(rules))
        start[base + k] = base + np.cumsum(size[base + k]) - size[base + k]
        pool = np.empty(base + int(size[base + k].sum()), np.uint32)
        pool[:base] = np.arange(base)
        ready = np.zeros(base + len(rules), bool)
        ready[:base] = True
        while len(k):
            now = ready[rules[k]].all(axis=1)
            level, k = k[now], k[~now]
            for child, shift in ((rules[level, 0], 0), (rules[level, 1], size[rules[level, 0]])):
                pool[spread(start[base + level] + shift, size[child])] = pool[spread(start[child], size[child])]
            ready[base + level] = True
        return pool[spread(start[symbols], size[symbols])]

    def lengths_of(self, symbols: np.ndarray) -> np.ndarray:
        every = np.concatenate([np.ones(self.base, np.int64), self.lengths.astype(np.int64)])
        return every[symbols]

    def ids(self) -> np.ndarray:
        return self.expand(self.symbols)

    def ranges(self, begin: np.ndarray, stop: np.ndarray) -> list[np.ndarray]:
        """The ids from each begin to its stop, from the symbols that cover them."""
        ends = np.cumsum(self.lengths_of(self.symbols))
        out = []
        for a, b in zip(begin.tolist(), stop.tolist(), strict=True):
            i, j = np.searchsorted(ends, [a, max(a, b - 1)], side="right")
            before = int(ends[i - 1]) if i else 0
            out.append((self.symbols[i : j + 1] if b > a else self.symbols[:0], a - before, b - before))
        whole = self.expand(np.concatenate([s for s, _, _ in out])) if out else np.empty(0, np.uint32)
        cuts = np.cumsum([int(self.lengths_of(s).sum()) for s, _, _ in out])
        return [part[a:b] if b > a else part[:0] for part, (_, a, b) in zip(np.split(whole, cuts[:-1]), out, strict=True)] if out else []

    def range(self, a: int, b: int) -> np.ndarray:
        return self.ranges(np.array([a]), np.array([b]))[0]

    def row(self) -> dict:
        width = width_of(self.base, len(self.rules))
        kind = f"<u{width}"
        return {"base": self.base, "width": width, "rules": self.rules.astype(kind).tobytes(), "rule_lengths": self.lengths.astype("<u4").tobytes(), "symbols": self.symbols.astype(kind).tobytes()}

    @staticmethod
    def of_row(row: dict) -> Grammar:
        kind = f"<u{row['width']}"
        rules = np.frombuffer(row["rules"], kind).astype(np.int64).reshape(-1, 2)
        return Grammar(row["base"], rules, np.frombuffer(row["rule_lengths"], "<u4"), np.frombuffer(row["symbols"], kind).astype(np.int64))


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1 ... of each stretch, one after another."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


def width_of(base: int, n_rules: int) -> int:
    return 2 if base + n_rules <= SHORT else 4


def written(base: int, n_rules: int, n_symbols: int) -> int:
    """Bytes of a block: symbols, two of them a rule, and four for a rule's expansion length."""
    return width_of(base, n_rules) * (n_symbols + 2 * n_rules) + 4 * n_rules


def compress(ids: np.ndarray, base: int) -> Grammar:
    s = ids.astype(np.uint32)
    rules, lengths, known = [np.empty((0, 2), np.int64)], [], np.ones(base, np.int64)
    least = len(s)
    while len(s) > 1:
        worth = 4 // width_of(base, len(known) - base) + 3
        # as many slots as keep the pairs that share one rare beside the wanted number
        bits = max(14, min(HASH_BITS, len(s).bit_length(), (8 * len(s) // max(worth, least // 2)).bit_length()))
        slot = (s[:-1] * np.uint32(0x9E3779B1) + s[1:] * np.uint32(0x85EBCA77)) >> np.uint32(32 - bits)
        slot = slot.astype(np.intp)
        count = np.bincount(slot, minlength=1 << bits)
        least, last = max(worth, min(least, int(count.max())) // 2), least
        at = np.nonzero(np.take(count >= least, slot, mode="clip"))[0]  # pairs may share a slot: count these exactly
        key = (s[at].astype(np.uint64) << np.uint64(32)) | s[at + 1]
        pairs, which, n = np.unique(key, return_inverse=True, return_counts=True)
        good = np.nonzero(n >= least)[0]
        good = good[np.lexsort((pairs[good], -n[good]))]
        if len(known) < SHORT < len(known) + len(good):
            good = good[: SHORT - len(known)]
        rank = np.full(len(pairs), len(pairs), np.int64)
        rank[good] = np.arange(len(good))
        rank = rank[which]
        at, rank = at[rank < len(pairs)], rank[rank < len(pairs)]
        took, first = leftmost(at, rank)
        used, place = np.unique(first, return_inverse=True)
        if not len(used):
            if last == worth:
                break
            continue
        new = np.stack([pairs[good[used]] >> np.uint64(32), pairs[good[used]] & np.uint64(0xFFFFFFFF)], 1).astype(np.int64)
        start, n_rules = len(known), len(known) - base
        if written(base, n_rules + len(new), len(s) - len(took)) >= written(base, n_rules, len(s)):
            break
        rules.append(new)
        lengths.append(known[new[:, 0]] + known[new[:, 1]])
        known = np.concatenate([known, lengths[-1]])
        s[took] = (start + place).astype(np.uint32)
        keep = np.ones(len(s), bool)
        keep[took + 1] = False
        s = s[keep]
    return Grammar(base, np.concatenate(rules), np.concatenate([np.empty(0, np.int64), *lengths]), s.astype(np.int64))


def leftmost(at: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ascending places of pairs, those that are replaced, and their ranks: a place gives way
    to an overlapping one of lower rank; of a run of one pair, as in aaaa, every other."""
    if not len(at):
        return at, rank
    new = np.ones(len(at), bool)  # a run: neighbouring places of one rank
    touch = np.zeros(len(at) + 1, bool)
    touch[1:-1] = at[1:] == at[:-1] + 1
    new[1:] = ~touch[1:-1] | (rank[1:] != rank[:-1])
    first = np.nonzero(new)[0]
    size = np.diff(first, append=len(at))
    last = first + size - 1
    value, none = rank[first], np.int64(1) << 62
    before = np.where(touch[first], rank[first - 1], none)
    after = np.where(touch[last + 1], rank[np.minimum(last + 1, len(at) - 1)], none)
    low = (value < before) & (value < after)
    steps = (size[low] + 1) // 2
    ends = np.cumsum(steps)
    step = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - steps, steps)
    return at[np.repeat(first[low], steps) + 2 * step], np.repeat(value[low], steps)


def same_bytes(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether size bytes at these places are equal; eight more bytes follow the last place."""
    x, y = (np.ndarray(len(z) - 7, "<u8", z, strides=(1,)) for z in (a, b))
    out, done = ((x[a_at] ^ y[b_at]) & FIRST_BYTES[np.minimum(size, 8)]) == 0, 8
    todo = np.nonzero(size > done)[0]
    while len(todo):
        mask = FIRST_BYTES[np.minimum(size[todo] - done, 8)]
        out[todo] &= ((x[a_at[todo] + done] ^ y[b_at[todo] + done]) & mask) == 0
        done += 8
        todo = todo[size[todo] > done]
    return out


class WordTable:
    """A bounded memo in arrays: a word's bytes -> a stretch of ids. Full, it starts anew.

    A hash finds a word's slot; what is there counts only if the bytes are the same.
    """

    def __init__(self, kind: np.dtype, bits: int = MEMO_BITS):
        self.bits, self.kind = bits, kind
        self.clear()

    def clear(self) -> None:
        self.key = np.zeros(1 << self.bits, np.uint64)
        self.rows = np.zeros((1 << self.bits, 4), np.int32)  # where ids and bytes begin, how many there are
        self.pool, self.used, self.count = np.empty(1 << 20, self.kind), 0, 0
        self.bytes, self.held = np.zeros(1 << 20, np.uint8), 0

    def find(self, key: np.ndarray) -> np.ndarray:
        """The slot of each key, or -1."""
        out = np.full(len(key), -1, np.int64)
        at = (key >> np.uint64(64 - self.bits)).astype(np.int64)
        todo = np.arange(len(key))
        while len(todo):
            seen = self.key[at[todo]]
            hit = seen == key[todo]
            out[todo[hit]] = at[todo[hit]]
            todo = todo[~hit & (seen != 0)]
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
        return out

    def get(self, slot: np.ndarray, buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each slot's word is the one at start, and where its ids begin and how many they
        are; a slot may be -1. buf goes on for eight bytes past the last word."""
        rows = self.rows[slot]
        same = np.nonzero((slot >= 0) & (rows[:, 3] == length))[0]
        same = same[same_bytes(self.bytes, rows[same, 1].astype(np.int64), buf, start[same], length[same])]
        held = np.zeros(len(slot), bool)
        held[same] = True
        return held, rows[:, 0].astype(np.int64), np.where(held, rows[:, 2], 0).astype(np.int64)

    def add(self, key: np.ndarray, text: np.ndarray, length: np.ndarray, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Puts in words with different keys that aren't there; text and ids have theirs one after
        another, of so many bytes and ids each. Their slots."""
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty(len(self.pool), self.kind)])
        while self.held + len(text) + 8 > len(self.bytes):
            self.bytes = np.concatenate([self.bytes, np.zeros(len(self.bytes), np.uint8)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.bytes[self.held : self.held + len(text)] = text
        off, word = self.used + np.cumsum(size) - size, self.held + np.cumsum(length) - length
        self.used, self.held, self.count = self.used + len(ids), self.held + len(text), self.count + len(key)
        slot = (key >> np.uint64(64 - self.bits)).astype(np.int64)
        todo = np.arange(len(key))
        while len(todo):  # linear probing, all words a step at a time; the last of those at a slot has it
            free = todo[self.key[slot[todo]] == 0]
            self.key[slot[free]] = key[free]
            won = free[self.key[slot[free]] == key[free]]
            self.rows[slot[won]] = np.stack([off[won], word[won], size[won], length[won]], 1)
            rest = np.ones(len(key), bool)
            rest[won] = False
            todo = todo[rest[todo]]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
        return slot


class LibraryEncoder:
    """The tokenizers library's ids; each different word of a batch is looked up or asked for once.

    Byte-level pre-tokenizers always start a piece at a single space between other
    characters, and a single line feed is a piece of its own. So a text whose white space
    is only that is the sum of its words, each with the space or line feed before it. Texts
    with any other white space or control, with the name of a special token, with a word
    of over LONGEST bytes, or with a word whose hash is another word's, go whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.base = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if self.base <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, "rb") as f:
            made = json.load(f)
        pre = made.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        self.by_word = plain and not made.get("normalizer") and not any(SPACES.search(x) for x in self.special)
        if self.by_word:
            # ids that begin with a space or a line feed, as byte-level vocabularies write these
            self.led = {lead: np.zeros(self.base, bool) for lead in (32, 10)}
            for t, i in self.tokenizer.get_vocab().items():
                if t[:1] in ("\u0120", "\u010a"):
                    self.led[ord(t[0]) - 256][i] = True
            self.tokenizer.model._resize_cache(0)  # what recurs is remembered here
            self.words = WordTable(self.kind)

    def ask(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def long(self, text: str) -> np.ndarray:
        """Ids of a text that goes whole; where words tell its pieces apart, a long one is cut between words."""
        parts, a = [], 0
        while self.by_word and len(text) - a > TEXT and (m := CUT.search(text, a + TEXT // 2)):
            parts.append(text[a : m.start()])
            a = m.start()
        return np.concatenate([x for t in [*parts, text[a:]] for x in self.ask([t])])

    def learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """words with the space or line feed before them: the places of those that can be encoded
        on their own, their ids one after another, their sizes."""
        rest = [w[1:] if w[:1] in (" ", "\n") else w for w in words]
        good = [i for i, w in enumerate(rest) if w and not self.odd(w)]
        ids = self.ask([words[i] for i in good])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.array(good, np.int64), np.concatenate([np.empty(0, self.kind), *ids]), sizes

    def learn_all(self, raw: bytes, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.learn([raw[e - n : e].decode() for e, n in zip(np.cumsum(length).tolist(), length.tolist(), strict=True)])

    def odd(self, text: str) -> bool:
        """Whether it has white space, a control or the name of a special token."""
        return bool(SPACES.search(text)) or any(x in text for x in self.special)

    def learn_joined(self, raw: bytes, length: np.ndarray, lead: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for words that all have a space, or all a line feed, before them: one after
        another, some thousands at once."""
        ends = np.cumsum(length)
        places, ids, sizes = [], [], []
        for a in range(0, len(length), 4000):
            e = min(a + 4000, len(length))
            text = raw[int(ends[a] - length[a]) : int(ends[e - 1])].decode()
            part = self.ask([text])[0]
            at = np.nonzero(self.led[lead][part])[0]  # each word's first id has it
            if len(at) == e - a and at[0] == 0 and not self.odd(text.replace(chr(lead), "")):
                places.append(np.arange(a, e))
                ids.append(part)
                sizes.append(np.diff(at, append=len(part)))
            else:
                good, x, n = self.learn([raw[j - k : j].decode() for j, k in zip(ends[a:e].tolist(), length[a:e].tolist(), strict=True)])
                places.append(a + good)
                ids.append(x)
                sizes.append(n)
        empty = np.empty(0, np.int64)
        return np.concatenate([empty, *places]), np.concatenate([np.empty(0, self.kind), *ids]), np.concatenate([empty, *sizes])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_word or not texts:
            return [self.long(t) for t in texts]
        short = [len(t) <= TEXT for t in texts]
        if not all(short):
            some = iter(self.encode([t for t, s in zip(texts, short, strict=True) if s]))
            return [next(some) if s else self.long(t) for t, s in zip(texts, short, strict=True)]
        raw = [t.encode() for t in texts]
        joined = b"\x00".join(raw) + bytes(9)
        buf = np.frombuffer(joined, np.uint8)
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)  # past the zero byte after each
        first = np.concatenate([[0], ends[:-1]])
        gap = (buf[: ends[-1]] == 32) | (buf[: ends[-1]] == 10)
        head = gap.copy()
        head[first] = True
        start = np.nonzero(head)[0]
        of = np.searchsorted(ends, start, side="right")
        stop = np.minimum(np.append(start[1:], ends[-1]), ends[of] - 1)
        whole = np.zeros(len(raw), bool)
        odd = np.nonzero(((buf[: ends[-1]] < 32) & (buf[: ends[-1]] != 10)) | (buf[: ends[-1]] == 127))[0]
        odd = np.setdiff1d(odd, ends - 1, assume_unique=True)
        whole[np.searchsorted(ends, odd, side="right")] = True
        length = stop - start
        whole[of[(length > LONGEST) | ((length == 1) & gap[start])]] = True  # a gap without a word after it
        inside = (length > 0) & ~whole[of]
        start, stop, of, length = start[inside], stop[inside], of[inside], length[inside]
        key = span_hashes(buf, start, stop) | np.uint64(1)
        slot = self.slots(buf, start, stop, key)
        known, off, n = self.words.get(slot, buf, start, length)
        whole[of[~known]] = True
        ids = self.words.pool[spread(off, n)]
        per = np.bincount(of, weights=n, minlength=len(raw)).astype(np.int64)
        out = np.split(ids, np.cumsum(per)[:-1])
        for i in np.nonzero(whole)[0].tolist():
            out[i] = self.long(texts[i])
        return out

    def slots(self, buf: np.ndarray, start: np.ndarray, stop: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The memo's slot for every word's key, of which one word is learned; -1 for what isn't learned."""
        table = self.words
        slot = table.find(key)
        lack = np.nonzero(slot < 0)[0]
        new, rep = np.unique(key[lack], return_index=True)
        if table.count + len(new) > 0.7 * (1 << table.bits):
            table.clear()
            new, rep = np.unique(key, return_index=True)
            slot[:], lack = -1, np.arange(len(key))
        if len(new) > 0.7 * (1 << table.bits):
            return slot
        begin, size = start[lack[rep]], (stop - start)[lack[rep]]
        for lead in (32, 10, None):
            of = np.nonzero(buf[begin] == lead if lead else (buf[begin] != 32) & (buf[begin] != 10))[0]
            text = buf[spread(begin[of], size[of])]
            good, ids, n = self.learn_joined(text.tobytes(), size[of], lead) if lead else self.learn_all(text.tobytes(), size[of])
            if len(good) < len(of):
                text = buf[spread(begin[of[good]], size[of[good]])]
            table.add(new[of[good]], text, size[of[good]], ids, n)
        slot[lack] = table.find(key[lack])
        return slot


_ENCODERS: dict[str, LibraryEncoder] = {}


def encoder(path: str) -> LibraryEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = LibraryEncoder(path)
    return _ENCODERS[path]


FILE = "shard int, block int, doc_id array<bigint>, n_tokens array<bigint>, base int, width int, rules binary, rule_lengths binary, symbols binary"
ROWS = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("doc_id", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64()))]
                 + [("base", pa.int32()), ("width", pa.int32()), ("rules", pa.binary()), ("rule_lengths", pa.binary()), ("symbols", pa.binary())])


def write_blocks(path: str, end_id: int, block: int):
    def run(batches):
        enc, shard, at = encoder(path), TaskContext.get().partitionId(), 0
        held, ids, size = [], [], 0

        def row():
            nonlocal held, ids, size, at
            g = compress(np.concatenate(held), max(enc.base, end_id + 1))
            out = {k: [v] for k, v in ({"shard": shard, "block": at, "doc_id": ids, "n_tokens": [len(x) + 1 for x in held[::2]]} | g.row()).items()}
            held, ids, size, at = [], [], 0, at + 1
            return pa.RecordBatch.from_pydict(out, schema=ROWS)

        end = np.array([end_id], np.uint32)
        for b in text_chunks(batches, TEXT):
            texts = [t or "" for t in b.column(1).to_pylist()]
            for doc, x in zip(b.column(0).to_pylist(), enc.encode(texts), strict=True):
                if held and size + len(x) + 1 > block:
                    yield row()
                held += [x, end]
                ids.append(doc)
                size += len(x) + 1
        if held:
            yield row()

    return run


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, block: int = BLOCK) -> None:
    """Encodes the documents and writes them as shards of grammar blocks, in the order of doc_id."""
    spark = docs.sparkSession
    ship(spark)
    rows = pick(docs, "doc_id", "text")
    n = max(shuffle_partitions(spark), rows.rdd.getNumPartitions())
    # the last two keys tell rows of one id apart, so that these can lie in several partitions
    order = ["doc_id", "_hash", "_row"]
    keyed = rows.withColumn("_hash", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")
    ordered.mapInArrow(write_blocks(tokenizer, end_id, block), FILE).write.option("parquet.page.size.row.check.min", 4).option("parquet.block.size.row.check.min", 4).parquet(folder)


def read_windows(width: int):
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                n = np.array(row["n_tokens"])
                middle = np.cumsum(n) - n + n // 2
                found = Grammar.of_row(row).ranges(middle, np.minimum(middle + width, np.cumsum(n)))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(row["doc_id"], pa.int64()), "first": pa.array(n // 2, pa.int64()),
                    "ids": pa.array([x.astype(np.int64) for x in found], pa.list_(pa.int64())),
                })

    return run


def token_windows(spark, folder: str, width: int = 16) -> DataFrame:
    """doc_id, first, ids: width ids from the middle of every document (place floor(n / 2) of
    its ids, the end id among them), by random access: only the symbols over them are expanded."""
    return spark.read.schema(FILE).parquet(folder).mapInArrow(read_windows(width), "doc_id long, first long, ids array<bigint>")


def read_documents(batches):
    for b in batches:
        for row in b.to_pylist():
            ids = Grammar.of_row(row).ids().astype("<u4")
            ends = np.cumsum(row["n_tokens"])
            starts = ends - np.array(row["n_tokens"])
            crc = [zlib.crc32(ids[a:e].tobytes()) for a, e in zip(starts, ends, strict=True)]
            n = len(crc)
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([row["shard"]] * n, pa.int32()), "block": pa.array([row["block"]] * n, pa.int32()), "doc_id": pa.array(row["doc_id"], pa.int64()),
                "inside": pa.array(starts, pa.int64()), "n_tokens": pa.array(row["n_tokens"], pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
            })


def read_ids(spark, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the shards."""
    files = spark.read.schema(FILE).parquet(folder)
    blocks = files.select("shard", "block", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    shards = blocks.groupBy("shard").agg(F.sum("n").alias("n")).withColumn(
        "_shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).select(F.col("shard").alias("_s"), "_shard")
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = blocks.withColumn("_inside", inside).join(shards, F.col("shard") == F.col("_s")).select(
        F.col("shard").alias("_s"), F.col("block").alias("_b"), (F.col("_inside") + F.col("_shard")).alias("_before"),
    )
    docs = files.mapInArrow(read_documents, "shard int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return docs.join(before, (F.col("shard") == F.col("_s")) & (F.col("block") == F.col("_b"))).select(
        "doc_id", (F.col("_before") + F.col("inside")).cast("long").alias("start"), "n_tokens", "ids_crc32",
    )


def token_files(docs: DataFrame, tokenizer: str, end_id: int = END_ID, block: int = BLOCK, folder: str | None = None) -> DataFrame:
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-ids")
    write_ids(docs, folder, tokenizer, end_id, block)
    return read_ids(spark, folder)
