"""The conversation trie against a plain one, with long, hot, tied and absent conversations."""

import hashlib
import random
import zlib

import pytest

from wayfold.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, TURN string, depth int"


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest(), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        b = c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = (own.get(b, [])[:h] + own[c][h:])
    members, out = {}, []
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    for p, cs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(built[c]) == len(p)))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children.get(p, ())), sum(q not in children for q in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(spark, rows):
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, trie.prefix_trie(df).collect()), key=repr)


def made(seed, n, most=9, texts=4):
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "assistant"]), f"t{r.randrange(texts)}é" * r.randint(0, 2)) for c in r.sample(range(-n, 3 * n), n) for t in range(r.randint(1, most))]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_plain_trie(spark, seed):
    rows = made(seed, 60, texts=2)
    assert got(spark, rows) == brute(rows)


def test_awkward_rows(spark):
    rows = [(None, 0, "user", "x"), (0, None, None, None), (0, 1, "user", "a"), (0, 1, "user", "a"), (0, 1, "assistant", "a"), (3, 5, None, ""), (3, None, "", None), (-1, 2, "user", "日本"), (-5, 0, "user", "a"), (-7, 0, "x", "y"), (7, 0, "user", ":a"), (8, 0, "user:", "a"), (10**12, 0, "user", "a"), (2**63 - 1, 9, "u", "v")]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == [] and got(spark, [(None, 1, "a", "b")]) == []
    assert got(spark, [(4, 0, "a", "b")]) == brute([(4, 0, "a", "b")])


def test_long_conversations_in_stretches(spark, monkeypatch):
    """Half of all turns in one conversation, copies of it, and windows of a few depths."""
    monkeypatch.setattr(trie, "STRETCH", 7)
    long = [("user" if t % 2 else "assistant", f"turn {t % 11}") for t in range(150)]
    rows = [(c, t, *x) for c in (20, 21, 22, 33) for t, x in enumerate(long[: 150 - (c % 3) * 9])] + made(5, 15, 5, 2)
    assert got(spark, rows) == brute(rows)


def test_carries_between_partitions():
    """A conversation over several partitions, some of them wholly its own."""
    turns = [(1, 3), (2, 10), (3, 2), (4, 1)]
    digests = {(c, i): hashlib.sha256(f"{c}.{i}".encode()).digest()[:16] for c, n in turns for i in range(n)}
    rows = [(c, digests[c, i]) for c, n in turns for i in range(n)]

    def run(part):
        n, h, last, first, out = 0, 0, None, None, []
        for c, d in part:
            if c != last:
                if last is not None and first is None:
                    first = (last, n, h)
                last, n, h = c, 0, 0
            n, h = n + 1, (h * trie.BASE + trie.number(d) + 1) % trie.PRIME
        kinds = [(1, *first), (2, last, n, h)] if first else [(3, last, n, h)] if part else []
        for kind, c, n, h in kinds:
            out.append(type("R", (), {"kind": kind, "conv_id": c, "nth": n, "hash": trie.name(h)}))
        return out

    want = {}
    for c, d in rows:
        n, h = want.get(c, (0, 0))
        want[c] = (n + 1, (h * trie.BASE + trie.number(d) + 1) % trie.PRIME)
    cuts = [0, 2, 5, 5, 8, 11, 14, 16]
    runs = []
    for p, (a, e) in enumerate(zip(cuts, cuts[1:], strict=False)):
        for r in run(rows[a:e]):
            r.part = p
            runs.append(r)
    carry = trie.carries(runs)
    last = {}
    for r in runs:
        n, h = r.nth, trie.number(r.hash)
        if r.kind != 2 and r.part in carry and carry[r.part][0] == r.conv_id:
            n, h = n + carry[r.part][1], (carry[r.part][2] * pow(trie.BASE, n, trie.PRIME) + h) % trie.PRIME
        last[r.conv_id] = (n, h)
    assert last == want
