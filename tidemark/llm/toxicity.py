"""Toxicity of texts after undoing disguised spelling.

A character model (trigrams, counted over all documents) and a channel of look-alike signs, separators inside words,
spaced-out letters and repeated letters span a lattice over every word that holds a look-alike, an inner separator or a
repeated letter, however long; numbers stay numbers. Viterbi decoding restores the likeliest spelling, spaced-out runs
are broken into words in all likely ways, and what is scored is the best of a word's readings, itself among them. Scoring
is by evidence of words and word beginnings (log odds against label 1, less one standard error), summarised per document
and calibrated by logistic regression.
Evidence comes from one half of the training rows, calibration from the other.

Labels are read only from rows outside the held-out fold, at most ``TRAIN_ROWS`` of them. Language, source and id are
no inputs. Defined results: null, empty and wordless texts get the score of a text without evidence; without training
rows of both labels every score is the share of label 1 (0 without any); repeated rows score alike; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import LONG_WORD, slices, table, words_of
from tidemark.llm.labelled import held_out, labelled_sample, with_labels

TRAIN_ROWS = 20_000
BUCKETS = 1 << 18
REMEMBERED = 400_000
#: Signs that stand for letters in disguised spelling, and the cost of each kind of disguise.
LOOKALIKE = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e"}
SWAP, DROP, COLLAPSE, KEEP_SIGN = -1.0, -0.7, -0.7, -4.0
#: How much less likely than the best (in log odds) a way to place breaks in spaced-out text may be for its words to count.
NEAR = 8.0
#: Letters of a spaced-out run that are read together, so that memory is bounded, and how many the next stretch repeats.
STRETCH, OVERLAP = 4096, 256
SEPARATORS = "._-*~'`/\\ "
EDGES = ".,;:!?\"'()[]{}<>*#%&$|-_~`"
#: Signs that a disguise may add: all of these, or those that stand for no letter.
ADDED = frozenset(SEPARATORS + EDGES)
ADDED_ONLY = ADDED - set(LOOKALIKE)

# Character classes: 0 for whatever is no letter, then a-z, then the letters of Latin-1.
CLASSES = 64
_CLASS = np.zeros(0x180, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = np.arange(1, 27)
_CLASS[0xDF:0x100] = np.arange(27, 60)
_CLASS[0x100:] = 60
_CLASS_OF = _CLASS.tolist()


def _classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CLASS[np.minimum(points, 0x17F)].astype(np.int64)


def character_counts(docs: DataFrame) -> np.ndarray:
    """Counts of character trigrams over all of ``docs``; the table has CLASSES^3 cells whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for part in slices(batch):
                c = _classes("  " + "  ".join(t or "" for t in part.column("text").to_pylist()).lower() + "  ")
                total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES**3)
        cells = np.flatnonzero(total)
        yield pa.record_batch([pa.array(cells), pa.array(total[cells])], names=["cell", "n"])

    rows = docs.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(CLASSES**3)
    counts[rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    return counts


def character_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a character after two others, interpolated with shorter contexts."""
    three = counts.reshape(CLASSES, CLASSES, CLASSES)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + CLASSES)
    p2 = (two + 20 * p1) / (two.sum(axis=1, keepdims=True) + 20)
    p3 = (three + 20 * p2) / (three.sum(axis=2, keepdims=True) + 20)
    return np.log(p3).astype(np.float32)


def decoded(word: str, model: np.ndarray, collapse: bool = True, added: frozenset[str] = ADDED) -> tuple[str, list[int]]:
    """The likeliest spelling behind ``word`` (lower case), and the place in ``word`` that each of its signs comes from.

    Viterbi over the last two letters of the lattice's paths; without ``collapse`` repeated letters stay. Paths share their
    beginnings, and what all have in common is put aside from time to time: time and memory are linear in the word.
    """
    price = model.item
    paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    before, text, places = "", [], []
    for i, sign in enumerate(word):
        grown: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        alpha = sign.isalpha()
        letters = [(x, _CLASS_OF[min(ord(x), 0x17F)], 0.0 if alpha else SWAP) for x in (sign if alpha else LOOKALIKE.get(sign, ""))]
        for (a, b), (cost, path) in paths.items():
            steps = [((b, c), cost + extra + price(a, b, c), x) for x, c, extra in letters]
            if not alpha:
                if sign in added:
                    steps.append(((a, b), cost + DROP, ""))
                if not letters:
                    steps.append(((b, 0), cost + KEEP_SIGN, sign))
            elif collapse and sign == before and path is not None and path[1] == sign:
                steps.append(((a, b), cost + COLLAPSE, ""))
            for state, total, x in steps:
                if state not in grown or total > grown[state][0]:
                    grown[state] = (total, (path, x, i) if x else path)
        paths, before = grown or paths, sign
        if i % STRETCH == STRETCH - 1:
            paths = _put_aside(paths, text, places)
    path = max(((cost + price(a, b, 0), path) for (a, b), (cost, path) in paths.items()), key=lambda x: x[0])[1]
    for _, x, i in _nodes(path):
        text.append(x)
        places.append(i)
    return "".join(text), places


def _nodes(path: tuple | None) -> list[tuple]:
    out = []
    while path is not None:
        out.append(path)
        path = path[0]
    return out[::-1]


def _put_aside(paths: dict, text: list[str], places: list[int]) -> dict:
    """Move the signs that all ``paths`` begin with to ``text`` and ``places``, but for each path's last one."""
    chains = [_nodes(path) for _, path in paths.values()]
    most = min(len(c) for c in chains) - 1
    same = next((k for k in range(max(most, 0)) if any(c[k] is not chains[0][k] for c in chains)), max(most, 0))
    for _, x, i in chains[0][:same]:
        text.append(x)
        places.append(i)
    out = {}
    for (state, (cost, _)), chain in zip(paths.items(), chains):
        path = None
        for _, x, i in chain[same:]:
            path = (path, x, i)
        out[state] = (cost, path)
    return out


def restore(word: str, model: np.ndarray) -> str:
    return decoded(word, model)[0]


def words_within(letters: str, model: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of each word of ``letters`` (without breaks) in any reading at most ``NEAR`` less likely than the best.

    A reading is a way to place breaks; it costs what the character model says, a break being a character.
    """
    n, price = len(letters), model.item
    c = [0, *(_CLASS_OF[min(ord(x), 0x17F)] for x in letters), 0]  # c[i + 1] is letter i

    # into[i]: a word begins with letter i, after letter i - 1; second[i]: letter i is its second; over[i]: letter i goes
    # on after two of its own; done[i] and lone[i]: it ends after letter i, as one of several letters or the only one.
    into = [price(c[i], 0, c[i + 1]) for i in range(n)]
    second = [price(0, c[i], c[i + 1]) for i in range(n)]
    over = [price(c[i - 1] if i else 0, c[i], c[i + 1]) for i in range(n)]
    done = [price(c[i], c[i + 1], 0) for i in range(n)]
    lone = [price(0, c[i + 1], 0) for i in range(n)]
    # Best cost of what lies before a break at i, and of what lies after one.
    ahead, inside = [0.0] * (n + 1), -math.inf
    for i in range(n):  # inside: best cost up to letter i with its word of two or more letters
        inside = max(inside + over[i], ahead[i - 1] + into[i - 1] + second[i] if i else -math.inf)
        ahead[i + 1] = max(inside + done[i], ahead[i] + into[i] + lone[i])
    behind, rest = [0.0] * (n + 1), [-math.inf] * (n + 1)  # rest[i]: best cost after letter i within a word of two or more
    for i in range(n - 1, -1, -1):
        rest[i] = max(done[i] + behind[i + 1], over[i + 1] + rest[i + 1] if i + 1 < n else -math.inf)
        behind[i] = into[i] + max(lone[i] + behind[i + 1], second[i + 1] + rest[i + 1] if i + 1 < n else -math.inf)
    least = ahead[n] - NEAR
    for i in range(n):
        if ahead[i] + behind[i] < least:
            continue
        cost = ahead[i] + into[i]
        if cost + lone[i] + behind[i + 1] >= least:
            yield i, i + 1
        for j in range(i + 1, n):
            cost += second[j] if j == i + 1 else over[j]
            if cost + rest[j] < least:
                break
            if cost + done[j] + behind[j + 1] >= least:
                yield i, j + 1


def spaced(run: str, model: np.ndarray, breaks: set[int] | None = None) -> Iterator[tuple[int, list[str]]]:
    """Words of spaced-out letters by the place where they begin, whichever way these are broken into words.

    With ``breaks`` words begin at these places only, and end before one. A long run is read in stretches; a word that
    begins in the middle of an overlap or after it belongs to the next.
    """
    for start in range(0, max(1, len(run) - OVERLAP), STRETCH - OVERLAP):
        stop = min(start + STRETCH, len(run))
        low, high = start + OVERLAP // 2 if start else 0, stop - OVERLAP // 2 if stop < len(run) else stop
        found: dict[int, set[str]] = {}
        texts = [decoded(run[start:stop], model, collapse=collapse) for collapse in (True, False)]
        for text, places in texts if texts[0] != texts[1] else texts[:1]:
            at = [start + i for i in places] + [stop]
            for i, j in words_within(text, model):
                if low <= at[i] < high and (breaks is None or at[i] in breaks and (at[j] in breaks or at[j] == stop)):
                    found.setdefault(at[i], set()).add(text[i:j])
        yield from ((place, sorted(words)) for place, words in found.items())


_SIGNS = re.compile("[" + re.escape("".join(LOOKALIKE) + SEPARATORS) + "]")
_INNER = re.compile("[" + re.escape(SEPARATORS) + "]")
_REPEATED = re.compile(r"([^\W\d_])\1+")
_NUMBER = re.compile(r"[\W\d_]+")


def squeezed(word: str, model: np.ndarray) -> str:
    """What ``decoded`` makes of a word of letters only: each run of a letter is decided on its own, as paths meet after it."""
    price, n = model.item, len(word)
    kind = lambda i: _CLASS_OF[min(ord(word[i]), 0x17F)] if 0 <= i < n else 0

    def run(found: re.Match) -> str:
        start, stop = found.span()
        k, a, b, c = stop - start, kind(start - 1), kind(start), kind(stop)
        two = price(a, b, b) + price(b, b, c)
        costs = {1: price(a, b, c) + COLLAPSE * (k - 1), 2: two + COLLAPSE * (k - 2), k: two + (k - 2) * price(b, b, b)}
        return found[1] * max(costs, key=costs.get)

    return _REPEATED.sub(run, word)


def _trimmed(word: str) -> str:
    """``word`` without marks around it, or nothing if it has no disguise: a number is one as written."""
    trimmed = word.rstrip(".,;:?!\"')]}").lstrip("\"'([{")
    if not _SIGNS.search(trimmed):
        return trimmed if _REPEATED.search(trimmed) else ""
    return "" if _NUMBER.fullmatch(trimmed) and not any(x in trimmed for x in LOOKALIKE if not x.isdigit()) else trimmed


def restored(word: str, model: np.ndarray) -> str:
    """The likeliest spelling behind ``word``, read as one word."""
    trimmed = _trimmed(word)
    if not trimmed:
        return word.strip(EDGES) or word
    return squeezed(trimmed, model) if trimmed.isalpha() else restore(trimmed, model)


def readings(word: str, model: np.ndarray) -> list[str]:
    """What ``word`` may stand for: itself, its likeliest spelling as one word, the same with a letter for every look-alike,
    and, if it has separators inside, its parts and whatever likely words these may be joined to."""
    names, trimmed = [word.strip(EDGES) or word, restored(word, model)], _trimmed(word)
    if any(x in ADDED for x in trimmed if x in LOOKALIKE):
        names.append(decoded(trimmed, model, added=ADDED_ONLY)[0])
    if trimmed and _INNER.search(trimmed):
        parts = [p for p in _INNER.split(trimmed) if p]
        names += [restored(p, model) for p in parts] + parts
        breaks = set(np.cumsum([0, *map(len, parts)]).tolist())
        names += [w for _, words in spaced("".join(parts), model, breaks) for w in words]
    return list(dict.fromkeys(names))


def _features(words: list[str]) -> list[int]:
    """Buckets of the readings of a word: the whole of each and its beginnings."""
    names = {x for word in words for x in (word + "$", *[word[:n] for n in (3, 4, 5, 6) if len(word) > n])}
    return [xxhash.xxh3_64_intdigest(x) % BUCKETS for x in names]


class _Reader:
    """Texts as restored words: what each distinct word is worth is worked out once and remembered."""

    def __init__(self, model: np.ndarray, worth):
        self.model, self.worth, self.known = model, worth, {}

    def __call__(self, texts: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
        words, codes, starts = words_of(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
        names = words.to_pylist()
        values = [self.of(w) for w in names]
        # Runs of four or more single letters are read as spaced-out text.
        lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False) if len(words) else np.zeros(0, np.int64)
        alone = (lengths == 1) & np.array([w.isalpha() or w in LOOKALIKE for w in names], bool) if len(words) else np.zeros(0, bool)
        single = alone[codes] if len(codes) else np.zeros(0, bool)
        # A run ends with its document, so that no score depends on the neighbours.
        first, last = np.zeros(len(codes), bool), np.zeros(len(codes), bool)
        filled = np.diff(starts) > 0
        first[starts[:-1][filled]] = last[starts[1:][filled] - 1] = True
        begins = np.flatnonzero(single & (first | ~np.concatenate([[False], single[:-1]])))
        ends = np.flatnonzero(single & (last | ~np.concatenate([single[1:], [False]]))) + 1
        long = ends - begins >= 4
        for a, b in zip(begins[long].tolist(), ends[long].tolist()):
            run = "".join([names[c] for c in codes[a:b].tolist()])
            codes[a:b] = -1
            for place, words in spaced(run, self.model):
                codes[a + place] = len(values)
                values.append(self.worth(words))
        return values, codes, starts

    def of(self, word: str):
        if len(word) > LONG_WORD:
            return self.worth(readings(word, self.model))
        if word not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[word] = self.worth(readings(word, self.model))
        return self.known[word]


def _evidence(train: DataFrame, model: np.ndarray) -> np.ndarray:
    """Log odds, less one standard error, of each bucket over the documents that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, n = _Reader(model, _features), np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for part in slices(batch):
                values, codes, starts = read(part.column("text"))
                for i, label in enumerate(part.column("toxic").to_pylist()):
                    own = np.unique(codes[starts[i] : starts[i + 1]])
                    own = {b for c in own.tolist() if c >= 0 for b in values[c]}
                    if own:
                        n[int(label > 0)][np.fromiter(own, np.int64, len(own))] += 1
        seen = np.flatnonzero(n.any(axis=0))
        yield pa.record_batch([pa.array(seen), pa.array(n[0][seen]), pa.array(n[1][seen])], names=["bucket", "n0", "n1"])

    rows = train.mapInArrow(run, "bucket long, n0 long, n1 long").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where("n1 >= 2").toArrow()
    total = {bool(r.toxic): r.n for r in train.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    n0, n1 = (rows.column(c).to_numpy().astype(float) for c in ("n0", "n1"))
    odds = np.log((n1 + 0.5) / (total.get(True, 0) + 1)) - np.log((n0 + 0.5) / (total.get(False, 0) + 1))
    worth = np.zeros(BUCKETS, np.float32)
    worth[rows.column("bucket").to_numpy()] = np.maximum(0, odds - np.sqrt(1 / (n1 + 0.5) + 1 / (n0 + 0.5)))
    return worth


SUMMARY = 6


def _summaries(read: _Reader, texts: pa.Array) -> np.ndarray:
    """Per text: its three strongest words' evidence, how much strong evidence it has, and its length."""
    values, codes, starts = read(texts)
    worth = np.append(np.array(values, np.float32), np.float32(0))  # code -1 is worth nothing
    each = worth[codes] if len(codes) else np.zeros(0, np.float32)
    out = np.zeros((len(starts) - 1, SUMMARY))
    sizes = np.diff(starts)
    out[:, 5] = np.log1p(sizes)
    strong = np.flatnonzero(each > 1.0)
    owner = np.searchsorted(starts, strong, "right") - 1
    order = np.lexsort((-each[strong], owner))
    owner, x = owner[order], each[strong][order].astype(float)
    first = np.searchsorted(owner, owner)
    place = np.arange(len(owner)) - first
    for k in range(3):
        out[owner[place == k], k] = x[place == k]
    out[:, 3] = np.log1p(np.bincount(owner, x > 3, minlength=len(out)))
    out[:, 4] = np.log1p(np.bincount(owner, x > 5, minlength=len(out)))
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, spread and weights (the last is the offset) by Newton's method."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.hstack([(x - mean) / spread, np.ones((len(x), 1))])
    w, penalty = np.zeros(z.shape[1]), np.append(np.full(x.shape[1], ridge), 1e-6)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9), z.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return mean, spread, w


def _scored(x: np.ndarray, fit) -> np.ndarray:
    mean, spread, w = fit
    return 1 / (1 + np.exp(-np.clip(((x - mean) / spread) @ w[:-1] + w[-1], -30, 30)))


def toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns of ``keep`` and ``score``: the likelihood of label 1 between 0 and 1."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[c for c in keep if c not in ("doc_id", "text")])
    model = character_model(character_counts(rows))
    train = with_labels(rows, labelled_sample(labels, ["toxic"], train_rows)).select("doc_id", "text", "toxic")
    half = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(2))
    worth = _evidence(train.where(half == 0), model)

    def strongest(words: list[str]) -> float:
        return float(worth[_features(words)].max())

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _Reader(model, strongest)
        for batch in batches:
            for part in slices(batch):
                x = _summaries(read, part.column("text"))
                yield pa.record_batch([part.column("toxic"), *[pa.array(c) for c in x.T]], names=["toxic", *[f"x{i}" for i in range(SUMMARY)]])

    shape = "toxic int, " + ", ".join(f"x{i} double" for i in range(SUMMARY))
    held = train.where(half == 1).mapInArrow(summarise, shape).toArrow()
    y = (held.column("toxic").to_numpy() > 0).astype(float)
    x = np.column_stack([held.column(f"x{i}").to_numpy() for i in range(SUMMARY)])
    fit = logistic(x, y) if len(y) and 0 < y.sum() < len(y) else (np.zeros(SUMMARY), np.ones(SUMMARY), np.append(np.zeros(SUMMARY), _logit(y)))

    passed = list(dict.fromkeys(["doc_id", *keep]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _Reader(model, strongest)
        for batch in batches:
            for part in slices(batch):
                score = pa.array(_scored(_summaries(read, part.column("text")), fit))
                yield pa.record_batch([*[part.column(c) for c in passed], score], names=[*passed, "score"])

    return rows.mapInArrow(run, T.StructType([*[rows.schema[c] for c in passed], T.StructField("score", T.DoubleType())]))


def _logit(y: np.ndarray) -> float:
    share = y.mean() if len(y) else 0.0
    return -30.0 if share <= 0 else 30.0 if share >= 1 else math.log(share / (1 - share))


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
