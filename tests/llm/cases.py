"""Small corpora with nulls, empty texts, ties, repeated rows, periodic and long texts; brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents() -> list[tuple]:
    r = random.Random(5)
    few, many = ["a", "b", "c", "dd", "ee"], [f"w{i}" for i in range(400)]
    passage = [r.choice(many) for _ in range(120)]
    p = " ".join(passage)
    rows = [(1, p), (2, p), (2, p), (None, p), (3, f"x {p} y"), (4, None), (5, ""), (6, " ".join(passage[10:70])), (7, " ".join(passage[:49]))]
    rows += [(8, " ".join(passage[20:69]) + " q " + " ".join(passage[60:])), (9, "a " * 300), (10, "b " + "a " * 300), (11, "a b " * 200), (12, "c a b " * 10 + "a b " * 150)]
    rows += [(13, f"{p} {p}"), (14, " \n\t \n"), (15, "\n".join(passage))]
    for i in range(20, 80):
        own = passage[:]
        for _ in range(r.randrange(4)):
            own[r.randrange(120)] = r.choice(many)
        around = [[r.choice(many) for _ in range(r.randrange(30))] for _ in range(2)]
        rows.append((i if i % 10 else 20, " ".join(around[0] + own[r.randrange(60) :] + around[1])))
    rows += [(i, " ".join(r.choice(few[: 2 + i % 3]) for _ in range(150))) for i in range(200, 230)]
    rows += [(300, "é" * 150), (301, "z" + "é" * 150), (302, "\x00" * 250), (303, "\x00" * 120 + "a"), (304, "ab" * 40), (305, "ab" * 60), (306, " ".join(many) * 60), (307, "W1 w2! w3? " * 9)]
    r.shuffle(rows)
    return [(d, t, "en", "src", len(t or "")) for d, t in rows]


def frame(spark, rows=None, parts: int = 5):
    """``documents`` with further columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(parts)
    return df.withColumns({c: F.lit("extra") for c in ("fp", "key", "score", "words", "spans", "slice", "bucket", "version", "n_words", "kept", "ids")})


def words(text) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def kept_words(rows, window=50):
    first, out = {}, []
    for d, t, *_ in rows:
        w = words(t)
        for s in range(len(w) - window + 1 if d is not None else 0):
            key = tuple(w[s : s + window])
            first[key] = min(first.get(key, d), d)
    for d, t, *_ in rows:
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - window + 1 if d is not None else 0):
            if first[tuple(w[s : s + window])] < d:
                gone[s : s + window] = [True] * window
        out.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g).encode())))
    return sorted(out, key=str)


def kept_bytes(rows, window=100):
    first, out = {}, []
    for d, t, *_ in rows:
        b = (t or "").encode()
        for s in range(len(b) - window + 1 if d is not None else 0):
            first[b[s : s + window]] = min(first.get(b[s : s + window], d), d)
    for d, t, *_ in rows:
        b, own = (t or "").encode(), set()
        gone = bytearray(len(b))
        for s in range(len(b) - window + 1 if d is not None else 0):
            key = b[s : s + window]
            if first[key] < d or key in own:
                gone[s : s + window] = b"\1" * window
            own.add(key)
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(bytes(x for x, g in zip(b, gone) if not g))))
    return sorted(out, key=str)


def lower(text) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def contaminated(rows, items, window=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    wanted = []
    for item, text in items:
        w = split(text)
        if w:
            n = min(len(w), window)
            wanted += [(tuple(w[s : s + n]), item) for s in range(len(w) - n + 1)]
    out = []
    for d, t, *_ in rows:
        w, hit, found = split(t), set(), set()
        for x, item in wanted:
            for s in range(len(w) - len(x) + 1):
                if tuple(w[s : s + len(x)]) == x:
                    hit.update(range(s, s + len(x)))
                    found.add(str(item))
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit)))
    return sorted(out, key=str)


def base_spans(text) -> list[tuple[int, int, int]]:
    t, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(len(x.lstrip("0")) < 4 and int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = [int(c) for c in m[0] if c.isdigit()]
        twice = [x * 2 - 9 * (x > 4) if i % 2 else x for i, x in enumerate(reversed(digits))]
        if 12 <= len(digits) <= 19 and sum(twice) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def statistics(text) -> tuple:
    w = words(text)
    count = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if count[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def fingerprint(text, shingle=3) -> int:
    import xxhash

    w = words(lower(text))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + shingle]).encode(), 42) for i in range(max(1, len(w) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(values: list[int], distance: int = 3) -> list[int]:
    """For each value the index of the first one reachable."""
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= distance:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [root(i) for i in range(len(values))]
