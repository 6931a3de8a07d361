"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans.

The fixed patterns give the base spans. Around digits and @ the field scores candidate
segments by features of the whole span and its neighbours; a dynamic program over token
positions picks boundaries and types together. It is fitted by maximum likelihood
(forward-backward over segments) to generated examples whose spans are known. Its spans are
added where they don't overlap a base span.

Candidates are bounded by what they are and not by a number of tokens: numbers of all kinds
have at most 23 digits, which fit REACH characters with their separators; an address or a
key is a whole run of the characters it may hold, however long. Stretches reach AROUND
characters past a digit or @, and on to the next white space, so no token is cut.

Defined results: a null text is empty; no spans give the digest of the empty string;
offsets count code points; equal texts give equal spans.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from array import array
from bisect import bisect_left, bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, ship, text_chunks

KINDS = ["email", "ip", "card", "phone", "iban", "secret", "ssn"]
BASE = KINDS[:4]
AROUND, REACH = 64, 80
#: Characters whose candidates are held at once, about.
PIECE = 4096
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: No match starts inside a run of digits unless one starts with the run, so runs are tried once.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile("[^0-9]+")
TRIGGER = re.compile("[0-9@]+")
NOT_SPACE = re.compile(r"\S*")
TOKEN = re.compile(r"[A-Za-z0-9]+|\s|.", re.S)
#: What a segment must look like to be a candidate of each kind, in the order of KINDS.
SHAPES = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*"),
    re.compile(r"[0-9]{1,4}(?:\.[0-9]{1,4}){3}"),
    re.compile(r"(?=[0-9](?:[ -]?[0-9]){11,22}\Z)[0-9]{3,}(?:[ -][0-9]{3,})*(?:[ -][0-9]{1,2})?"),
    re.compile(r"(?=\+?\(?[0-9](?:[ ().-]{0,2}[0-9]){6,16}\Z)\+?\(?[0-9]+(?:[ ().-]{1,2}[0-9]{2,})*"),
    re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{2,5}){2,8}"),
    re.compile(r"(?=[A-Za-z0-9_-]*[0-9])(?=[A-Za-z0-9_-]*[A-Za-z])[A-Za-z0-9_-]{16,}"),
    re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
]
MIXED, TURN = re.compile(r"(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9])", re.S), re.compile(r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
NUMBER = re.compile(r"\+?\(?[0-9]+(?:[ ().-]{1,2}[0-9]{2,})*(?:[ -][0-9](?![0-9]))?")
ACCOUNT = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9 ]*")
KEY_RUN = re.compile(r"[A-Za-z0-9_-]{16,}")
#: What an address has after its @; unlike the fixed pattern it needs no dot.
HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
CUES = [
    ("mail", "contact"), ("ip", "host", "address", "server"), ("card", "visa", "payment"), ("phone", "tel", "call", "mobile"),
    ("iban", "account", "bank"), ("token", "secret", "key", "password", "passwd", "api", "bearer"), ("ssn", "social", "security"),
]
FEATURES = 25


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the fixed patterns, in order."""
    out, pos, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > pos and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), 0))
            pos = m.end()
        at = text.find("@", max(at + 1, pos))
    for m in IP.finditer(text):
        if all(len(d := p.lstrip("0")) <= 3 and int(d or "0") <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), 1))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            out.append((m.start(), m.end(), 2))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda s: (s[0], s[2], s[1]))


def segments(text: str, start: int, end: int):
    """Candidates (start, end, kind) of text[start:end], sorted, a piece of it at a time: after
    the piece up to `limit`, which comes with them, all that end there or before have come."""
    keys, at, past, lo = KEY_RUN.finditer(text, start, end), text.find("@", start, end), start, start
    key = next(keys, None)
    inner = lambda x: start < x < end and text[x - 1 : x + 1].isascii() and text[x - 1 : x + 1].isalnum()  # noqa: E731  within a token
    while lo < end:
        hi = min(end, lo + PIECE)
        while inner(hi):
            hi += 1
        spans: set[tuple[int, int, int]] = set()
        while key and key.start() < hi:
            if SHAPES[5].fullmatch(key[0]):
                spans.add((key.start(), key.end(), 5))
            key = next(keys, None)
        while 0 <= at < hi:
            a = at
            while a > past and text[a - 1] in LOCAL:
                a -= 1
            m = HOST.match(text, at + 1, end) if a < at else None
            if m:
                spans.add((a, m.end(), 0))
            past, at = at + 1, text.find("@", at + 1, end)
        spans = {x for x in spans if not inner(x[0]) and not inner(x[1])}
        tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text, lo, min(end, hi + REACH))]
        for i, (a, _) in enumerate(tokens):
            if a >= hi:
                break
            c, stop = text[a], min(end, a + REACH)
            if c in "0123456789+(":
                m, kinds = NUMBER.match(text, a, stop), (2, 3)
                spans.update((a, x.end(), k) for k in (1, 6) if (x := SHAPES[k].match(text, a, stop)) and not inner(x.end()))
            elif "A" <= c <= "Z":
                m, kinds = ACCOUNT.match(text, a, stop), (4,)
            else:
                continue
            for j in range(i, len(tokens) if m else i):
                e = tokens[j][1]
                if e > m.end():
                    break
                if text[e - 1] not in " .-()" and not inner(e):
                    spans.update((a, e, k) for k in kinds if SHAPES[k].fullmatch(text, a, e))
        yield hi, sorted(spans)
        lo = hi


def candidates(text: str, start: int, end: int) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, list[float]]]]:
    """Tokens of text[start:end], and segments (first token, past last, kind, features)."""
    tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text, start, end)]
    begins, ends = {a: i for i, (a, _) in enumerate(tokens)}, {e: i + 1 for i, (_, e) in enumerate(tokens)}
    spans = sorted(x for _, part in segments(text, start, end) for x in part)
    return tokens, [(begins[a], ends[e], k, features(text, a, e, text[a:e], k)) for a, e, k in spans]


def cues(text: str, a: int) -> list[bool]:
    context = text[max(0, a - 24) : a].lower()
    return [any(w in context for w in words) for words in CUES]


def features(text: str, a: int, e: int, span: str, kind: int, cue: list[bool] | None = None) -> list[float]:
    digits = NOT_DIGIT.sub("", span)
    n = len(digits)
    before, after = text[a - 1 : a], text[e : e + 1]
    cue = cue or cues(text, a)
    joined = (before.isascii() and before.isalnum()) or (after.isascii() and after.isalnum())
    wider = (before in ".-+_" and before != "" and text[a - 2 : a - 1].isalnum()) or (after in ".-@_" and after != "" and text[e + 1 : e + 2].isalnum())
    parts = span.split(".")
    octets = kind == 1 and all(int(p) <= 255 for p in parts)
    f = [
        1.0, 10 <= n <= 15, 13 <= n <= 19, 14 <= n <= 19 and luhn(digits), octets, joined, wider, before == '"' and after == '"', cue[kind],
        any(c for k, c in enumerate(cue) if k != kind), span[0] == "+", " " in span, "(" in span or "-" in span, kind == 0 and "." in span.partition("@")[2],
        min(len(span), 128) / 32, len(span) >= 32, len(set(span)) / max(len(span), 1), all(c in "0123456789abcdef" for c in span), n / max(len(span), 1),
        span[:1].isupper() and span[:2].isupper(), n < 10, before in "" or before.isspace() or before in "\"'=:,(<[{", bool(MIXED.match(span)),
        len(TURN.findall(span)) / len(span), "-" in span or "_" in span,
    ]
    return [float(x) for x in f]


def windows(text: str):
    """Stretches around digits and @ up to white space, merged where they touch."""
    start = end = -1
    for m in TRIGGER.finditer(text):
        if m.end() + AROUND <= end:
            continue
        a, e = max(0, m.start() - AROUND), NOT_SPACE.match(text, min(len(text), m.end() + AROUND)).end()
        while a > max(end, 0) and not text[a - 1].isspace():
            a -= 1
        if start < 0:
            start, end = a, e
        elif a <= end:
            end = max(end, e)
        else:
            yield start, end
            start, end = a, e
    if start >= 0:
        yield start, end


def decode(weights: np.ndarray, text: str) -> list[tuple[int, int, int]]:
    """The best segmentation of each stretch: its entities as (start, end, kind).

    The best score up to a place only changes where a candidate ends. Of these places alone the
    score, and the candidate that is best there, are kept, in arrays; candidates and their
    features live for a piece of the text.
    """
    out = []
    for a, e in windows(text):
        place, best, start, kind = array("q", [a]), array("d", [0.0]), array("q", [a]), array("b", [-1])
        waiting: list[tuple[int, int, int, float]] = []
        for limit, spans in segments(text, a, e):
            if spans:
                cue = {s: cues(text, s) for s in {x[0] for x in spans}}
                scores = (np.array([features(text, s, t, text[s:t], k, cue[s]) for s, t, k in spans]) * weights[[k for _, _, k in spans]]).sum(axis=1).tolist()
                waiting += [(t, s, k, v) for (s, t, k), v in zip(spans, scores, strict=True)]
            waiting.sort(key=lambda w: w[:3])
            ready = bisect_right(waiting, limit, key=lambda w: w[0])
            for t, s, k, v in waiting[:ready]:
                if v <= 0:
                    continue  # no better than what ends before it
                v += best[bisect_right(place, s) - 1]
                if v > best[-1]:
                    if place[-1] == t:
                        place.pop(), best.pop(), start.pop(), kind.pop()
                    for to, x in ((place, t), (best, v), (start, s), (kind, k)):
                        to.append(x)
            del waiting[:ready]
        i = len(place) - 1
        while i > 0:
            out.append((start[i], place[i], kind[i]))
            i = bisect_right(place, start[i]) - 1
    return sorted(out, key=lambda s: (s[0], s[2], s[1]))


def examples(n: int = 900, seed: int = 7):
    """Generated stretches with the spans they hold, and look-alikes that hold none."""
    r = random.Random(seed)
    number = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice(["an", "er", "tion", "ou", "ed", "le", "que", "sch", "ción", "on"]) for _ in range(r.randint(1, 4)))

    def card():
        d = r.choice("3456") + number(r.randint(13, 17))
        d += next(c for c in "0123456789" if luhn(d + c))
        return d if r.random() < 0.6 else r.choice(" -").join(d[i : i + 4] for i in range(0, len(d), 4))

    def phone():
        return r.choice([
            f"+{r.randint(1, 99)} ({number(3)}) {number(3)}-{number(4)}", f"+{r.randint(1, 99)} {number(3)} {number(3)} {number(4)}",
            f"({number(3)}) {number(3)}-{number(4)}", f"+{number(11)}",
        ])

    letters = lambda k, among: "".join(r.choice(among) for _ in range(k))
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def key():
        hexed = lambda k: letters(k, "0123456789abcdef")
        made = r.choice([
            lambda: hexed(r.choice([32, 40, 40, 64, 124])),
            lambda: hexed(r.choice([32, 40, 40, 64])),
            lambda: letters(r.choice([24, 32, 48, 120]), lower + upper + "0123456789"),
            lambda: r.choice(["AKIA", "ASIA"]) + letters(16, upper + "234567"),
            lambda: r.choice(["ghp_", "sk-", "xoxb-", "pk_live_"]) + letters(r.choice([24, 36, 40]), lower + upper + "0123456789"),
            lambda: "-".join(hexed(k) for k in (8, 4, 4, 4, 12)),
            lambda: "_".join(letters(r.randint(4, 7), lower + upper + "0123456789") for _ in range(r.randint(6, 9))),
            lambda: letters(r.randint(60, 118), lower + upper) + hexed(6),
        ])()
        return made if any(c.isdigit() for c in made) and any(c.isalpha() for c in made) else made + "7f3a9b"

    make = [
        lambda: f"{r.choice(['', word() + '.'])}{word()}{number(r.randint(0, 2))}@{word()}{number(r.randint(0, 1))}.example.{r.choice(['com', 'org', 'net'])}".replace("ó", "o"),
        lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)),
        card,
        phone,
        lambda: r.choice(["DE", "FR", "ES", "GB"]) + number(2) + number(r.randint(12, 18)),
        key,
        lambda: f"{r.randint(100, 899)}-{r.randint(10, 99)}-{r.randint(1000, 9999)}",
    ]
    cue = [["", "mail "], ["", "host "], ["", "card "], ["", "call "], ["IBAN ", "account ", ""], ['token = "', 'key = "', 'password: "', 'secret = "'], ["SSN ", "ssn: ", "social security "]]
    bad = [
        lambda: number(r.randint(1, 8)), lambda: f"Version {r.randint(1, 9)}.{r.randint(0, 9)}.", lambda: f"{r.randint(1900, 2099)}-{r.randint(10, 12)}-{r.randint(10, 28)}",
        lambda: f"{r.randint(1, 9)}.{r.randint(256, 999)}.{r.randint(256, 999)}.{r.randint(0, 9)}", lambda: (d := number(15)) + next(c for c in "0123456789" if not luhn(d + c)), lambda: f"@{word()}", lambda: f"{number(3)}.{number(2)}",
        lambda: f"{word()}{number(2)}{word()}{word()}{word()}{number(1)}", lambda: f"{number(2)}:{number(2)}:{number(2)}", lambda: f"{number(3)},{number(3)},{number(3)}", lambda: f"{number(4)} {number(3)}", lambda: f"{word()}@{word()}", lambda: number(r.randint(20, 30)),
        lambda: "-".join([*(word() for _ in range(r.randint(3, 6))), number(r.choice([1, 2, 4]))]), lambda: "_".join([word(), word(), number(4), word(), number(1)]), lambda: f"{word()}{word()}{word()}{word()}{word()}{number(2)}",
    ]
    for _ in range(n):
        text, spans = "", []
        for _ in range(r.randint(1, 4)):
            text += " ".join(word() for _ in range(r.randint(1, 4))) + " "
            if r.random() < 0.62:
                k = r.randrange(len(KINDS))
                lead = r.choice(cue[k])
                value = make[k]()
                spans.append((len(text) + len(lead), len(text) + len(lead) + len(value), k))
                text += lead + value + ('"' if lead.endswith('"') else "") + r.choice([" ", " ", ". ", "### ", "$$$ ", "!! "])
            else:
                text += r.choice(bad)() + r.choice([" ", ", ", ". "])
        yield text, spans


@lru_cache(maxsize=1)
def fitted(steps: int = 60, rate: float = 0.3, penalty: float = 1e-3) -> np.ndarray:
    """weights[kind, feature] by gradient ascent on the log-likelihood of the examples."""
    data = []
    for text, spans in examples():
        tokens, found = candidates(text, 0, len(text))
        if not found:
            continue
        gold = set(spans)
        label = np.array([(tokens[i][0], tokens[j - 1][1], k) in gold for i, j, k, _ in found], float)
        by_end: dict[int, list[int]] = {}
        by_start: dict[int, list[int]] = {}
        for x, (i, j, _, _) in enumerate(found):
            by_end.setdefault(j, []).append(x)
            by_start.setdefault(i, []).append(x)
        data.append((len(tokens), [(i, j) for i, j, _, _ in found], np.array([k for _, _, k, _ in found]), np.array([f for *_, f in found]), label, by_end, by_start))
    w = np.zeros((len(KINDS), FEATURES))
    m1, m2 = np.zeros_like(w), np.zeros_like(w)
    kinds, feats = np.concatenate([d[2] for d in data]), np.concatenate([d[3] for d in data])
    for step in range(1, steps + 1):
        every = (feats * w[kinds]).sum(axis=1)
        diff, at = np.empty(len(kinds)), 0
        for n, ends, _, f, label, by_end, by_start in data:
            s = every[at : at + len(f)].tolist()
            forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
            for j in range(1, n + 1):
                v = forward[j - 1]
                for x in by_end.get(j, ()):
                    o = forward[ends[x][0]] + s[x]
                    v = max(v, o) + math.log1p(math.exp(-abs(v - o)))
                forward[j] = v
            for i in range(n - 1, -1, -1):
                v = backward[i + 1]
                for x in by_start.get(i, ()):
                    o = backward[ends[x][1]] + s[x]
                    v = max(v, o) + math.log1p(math.exp(-abs(v - o)))
                backward[i] = v
            p = [math.exp(min(0.0, forward[i] + v + backward[j] - forward[n])) for (i, j), v in zip(ends, s, strict=True)]
            diff[at : at + len(f)] = label - p
            at += len(f)
        g = np.zeros_like(w)
        np.add.at(g, kinds, feats * diff[:, None])
        g = g / len(data) - penalty * w
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        w = w + rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    return w


def all_spans(weights: np.ndarray, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and those with the field's spans that overlap none of them."""
    if not TRIGGER.search(text):
        return [], []
    base = base_spans(text)
    taken = sorted((s, e) for s, e, _ in base)
    reach = []  # the furthest end so far, as base spans of different kinds may overlap
    for _, e in taken:
        reach.append(max(e, reach[-1]) if reach else e)
    starts = [s for s, _ in taken]
    more = []
    for s, e, k in decode(weights, text):
        i = bisect_left(starts, e)
        if i == 0 or reach[i - 1] <= s:
            more.append((s, e, k))
    return base, sorted(base + more, key=lambda s: (s[0], s[2], s[1]))


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def finder(weights: np.ndarray):
    def run(batches):
        for b in text_chunks(batches):
            found = [all_spans(weights, t or "") for t in b.column(1).to_pylist()]
            counts = [[sum(k == i for _, _, k in base) for base, _ in found] for i in range(len(BASE))]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).cast(pa.int64()), *[pa.array(c, pa.int64()) for c in counts],
                    pa.array([hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]), pa.array([written(every) for _, every in found]),
                ],
                names=["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans"],
            )

    return run


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row."""
    ship(docs.sparkSession)
    return pick(docs, "doc_id", "text").mapInArrow(finder(fitted()), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted(weights: np.ndarray, text: str) -> str:
    out, at = [], 0
    for s, e, k in all_spans(weights, text)[1]:
        if e <= at:
            continue
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = e
    return "".join(out) + text[at:] if out else text


def redactor(weights: np.ndarray):
    def run(batches):
        for b in text_chunks(batches):
            i = b.schema.get_field_index("text")
            texts = [None if t is None else redacted(weights, t) for t in b.column(i).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, b.column(j).type) if j == i else c for j, c in enumerate(b.columns)], names=b.schema.names)

    return run


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span replaced by its kind in brackets; n_chars, if there, follows."""
    ship(docs.sparkSession)
    names = docs.columns
    plain = docs.toDF(*[n if n == "text" else f"_p{i}" for i, n in enumerate(names)])
    out = plain.mapInArrow(redactor(fitted()), plain.schema).toDF(*names)
    if "n_chars" not in names:
        return out
    at, kind = names.index("n_chars"), docs.schema[names.index("n_chars")].dataType
    cols = out.toDF(*[f"_q{i}" for i in range(len(names))])
    return cols.select(*[(F.length(f"_q{names.index('text')}").cast(kind) if i == at else F.col(f"_q{i}")).alias(n) for i, n in enumerate(names)])
