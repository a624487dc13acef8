"""Personal data by weak supervision, in DataFrame functions only.

Strict patterns give the base spans, which always stay. Wider patterns propose further spans, and labelers vote on all
candidates: shape and checksum rules, gazetteers (domains, calling codes, issuers, names of secrets), and cue words in
the text before. Nobody labels a row: expectation-maximisation over the counts of vote patterns (two hidden classes,
each labeler with its own hit and false-alarm rate, each kind with its own share) estimates how reliable the labelers
are, and its posteriors train the final classifier, a logistic regression on features of the span. What it accepts and
no base span touches is added; an accepted secret, which reaches to the end of its value, is added whatever it touches.
Vote patterns and features are small fixed sets, so the fits read a bounded table of counts whatever the corpus;
candidates never leave their document's row.

Defined results: null and empty texts have no spans; texts of any length and with any characters are scanned whole
(positions are code points); repeated rows give one row each; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import stored, table

#: Kinds in the order of a tie. The first four have base spans.
KINDS = ("email", "ip", "card", "phone", "secret", "ssn")
BASE = 4
CONTEXT = 40  # characters before a span that cue words are looked for in

#: The base patterns. Repetitions are possessive where nothing that follows could match less.
# A run of letters or digits is tried once, from its start or from where the match before ended: a later start in it would
# fail or succeed alike.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# Runs of 12 to 19 digits; a run is the longest stretch of digits with single separators.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Wider proposals: (kind, cheap test, pattern).
EMAIL_SPELT = (
    r"(?i)(?:\G|(?<![a-z0-9._%+-]))[a-z0-9._%+-]++\s?[\[({]\s?at\s?[\])}]\s?[a-z0-9-]++"
    r"(?:\s?(?:[\[({]\s?dot\s?[\])}]|\.)\s?[a-z0-9-]++)++"
)
PHONE_LOOSE = r"(?<![0-9.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])"
# A value goes to the next white space, or to the closing quote if one opens it, whatever is inside.
SECRET = (
    r"(?i)\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}"
    r"(?:\"[^\s\"]{6,}+\"?+|'[^\s']{6,}+'?+|[^\s\"']\S{5,}+)"
)
KEY = r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

#: Gazetteers and cue words of the labelers.
DOMAINS = r"(?i)(?:\.|dot[\])}]\s?)(?:com|org|net|edu|gov|mil|info|biz|io|co|de|fr|es|it|nl|uk|us|eu|ch|at|be|ca|au|mx|br|ar|jp|cn|ru|in)$"
CALLING = r"^\+?(?:1|7|20|27|3[0-9]|4[0-9]|5[0-9]|6[0-6]|8[1246]|9[0-58])"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|30[0-5]|36|38)"
CUES = {
    "email": r"(?i)(?:e-?mail|mail|contact|write|correo|courriel)\W{0,3}(?:\w{1,10}\W{1,2}){0,2}$",
    "ip": r"(?i)(?:\bip\b|address|server|host|client|from)\W{0,3}(?:\w{1,10}\W{1,2}){0,2}$",
    "card": r"(?i)(?:card|visa|credit|debit|carte|karte|tarjeta|payment|number)\W{0,3}(?:\w{1,10}\W{1,2}){0,2}$",
    "phone": r"(?i)(?:phone|tel|call|fax|mobile|cell|whatsapp|telefon)\W{0,3}(?:\w{1,10}\W{1,2}){0,2}$",
    "secret": r"(?i)(?:\bkey|aws|login|user|auth|config|export|env)\W{0,3}(?:\w{1,10}\W{1,2}){0,2}$",
    "ssn": r"(?i)(?:ssn|social|security|insured|taxpayer)\W{0,3}(?:\w{1,10}\W{1,2}){0,2}$",
}
UNLIKELY = r"(?i)(?:version|\bv|release|isbn|issn|order|invoice|page|section|chapter|part|sku|\bno|#|\$|€)[.:]?\s?$"


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once however often the body names it."""
    return F.transform(F.array(value), body)[0]


BLOCK = 256
FEW = 16  # spans of a text whose pieces are taken as substrings


def scanned(items: Column, zero: Column, empty: Column, step) -> Column:
    """What ``step(state, item)`` gives out for each item, where it returns the next state and that.

    Results are gathered in blocks and the blocks put together, so that time is not quadratic in the items.
    """

    def inner(state: Column, block: Column) -> Column:
        def one(held: Column, item: Column) -> Column:
            following, out = step(held["state"], item)
            return F.struct(following.alias("state"), F.concat(held["out"], F.array(out)).alias("out"))

        return F.aggregate(block, F.struct(state.alias("state"), empty.alias("out")), one)

    def outer(held: Column, block: Column) -> Column:
        return let(inner(held["state"], block), lambda done: F.struct(done["state"].alias("state"), F.concat(held["outs"], F.array(done["out"])).alias("outs")))

    def whole(all_: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(1), F.size(all_), F.lit(BLOCK)), lambda at: F.slice(all_, at, BLOCK))
        start = F.struct(zero.alias("state"), F.slice(F.array(empty), 1, 0).alias("outs"))
        return F.when(F.size(all_) > 0, F.flatten(F.aggregate(blocks, start, outer, lambda held: held["outs"]))).otherwise(empty)

    return let(items, whole)


def _found(text: Column, kind: str, pattern: str, test: Column, base: bool) -> Column:
    """Every match from left to right with its place, as structs; texts that fail the cheap ``test`` are not scanned."""
    whole = r"(?s)\G(.*?)(" + pattern + ")"
    gaps, hits = F.regexp_extract_all(text, F.lit(whole), F.lit(1)), F.regexp_extract_all(text, F.lit(whole), F.lit(2))
    pairs = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"))
    empty = F.array().cast(_SPANS)

    def step(at: Column, pair: Column) -> tuple[Column, Column]:
        start = at + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        span = F.struct(
            start.alias("start"),
            F.lit(KINDS.index(kind)).alias("kind"),
            end.alias("end"),
            F.lit(base).alias("base"),
            pair["hit"].alias("hit"),
            F.right(pair["gap"], F.lit(CONTEXT)).alias("before"),
        )
        return end, span

    return F.when(test, scanned(pairs, F.lit(0), empty, step)).otherwise(empty)


_SPANS = "array<struct<start:int,kind:int,end:int,base:boolean,hit:string,before:string>>"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit fits."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _octets(x: Column) -> Column:
    """Whether every part is at most 255, leading zeros or not."""
    parts = F.transform(F.split(x, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(parts, lambda p: (F.length(p) < 3) | (F.length(p) == 3) & ((p <= "255")))


def _fits(kind: str, hit: Column) -> Column:
    """The check that a base span of the kind must pass."""
    digits = _digits(hit)
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return _octets(hit)
    if kind == "card":
        return luhn(digits)
    return F.length(digits).between(9, 15)


def spans_of(text: Column) -> tuple[Column, Column]:
    """Base spans and proposals of a text, each an array of structs."""
    at, plus = F.contains(text, F.lit("@")), text.rlike(r"\+[0-9]")
    run = text.rlike(r"(?:[0-9][\x20-]?+){12}")
    found = {
        "email": _found(text, "email", EMAIL, at, True),
        "ip": _found(text, "ip", IP, text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), True),
        "card": _found(text, "card", CARD, run, True),
        "phone": _found(text, "phone", PHONE, plus, True),
    }

    def fitting(kind: str) -> Column:
        return F.filter(found[kind], lambda s: _fits(kind, s["hit"]))

    base = F.concat(*[fitting(kind) for kind in found])
    failed_cards = F.filter(found["card"], lambda s: ~luhn(_digits(s["hit"])))
    wide = F.concat(
        F.transform(failed_cards, lambda s: s.withField("base", F.lit(False))),
        _found(text, "email", EMAIL_SPELT, text.rlike(r"(?i)[\[({]\s?at\s?[\])}]"), False),
        _found(text, "phone", PHONE_LOOSE, text.rlike(r"[0-9]{3}[\x20.-][0-9]{4}"), False),
        _found(text, "secret", SECRET, text.rlike(r"(?i)(?:password|passwd|pwd|secret|token|key)[\"']?\s{0,3}[=:]"), False),
        _found(text, "secret", KEY, F.contains(text, F.lit("AKIA")), False),
        _found(text, "ssn", SSN, text.rlike(r"[0-9]-[0-9]{2}-[0-9]"), False),
    )
    return base, wide


# --- votes ------------------------------------------------------------------------------------------------------------


def _kind_is(s: Column, kind: str) -> Column:
    return s["kind"] == KINDS.index(kind)


def _of_kind(s: Column, by_kind: dict[str, Column]) -> Column:
    """The expression of the span's kind; null for a kind that has none."""
    out = F.lit(None)
    for kind, value in by_kind.items():
        out = F.when(_kind_is(s, kind), value).otherwise(out)
    return out


def votes(s: Column) -> list[Column]:
    """One vote a labeler: 1 for personal data, 0 against, null for no opinion."""
    hit, before = s["hit"], s["before"]
    digits = _digits(hit)
    yes = lambda c: F.when(c, 1)
    either = lambda c: F.when(c, 1).otherwise(0)
    shape = _of_kind(s, {"email": either(s["base"]), "ip": F.lit(1), "card": either(F.length(digits).between(13, 19)), "phone": either(s["base"] | (F.length(digits) == 10)), "secret": either(F.length(hit) >= 16), "ssn": F.lit(1)})
    check = _of_kind(
        s,
        {
            "email": either(~hit.rlike(r"\.\.|^[._%+-]|[._%+-]@")),
            "ip": either(~hit.rlike(r"^(?:0|127|255)\.")),
            "card": either(luhn(digits)),
            "phone": either(F.length(F.array_join(F.array_distinct(F.split(digits, "")), "")) >= 4),
            "secret": either(hit.rlike(r"[0-9]") & hit.rlike(r"[A-Za-z]{2}")),
            "ssn": either(~hit.rlike(r"^(?:000|666|9)|-00-|-0000$")),
        },
    )
    gazetteer = _of_kind(
        s,
        {
            "email": either(hit.rlike(DOMAINS)),
            "card": either(digits.rlike(ISSUERS)),
            "phone": yes(s["base"] & hit.rlike(CALLING)),
            "secret": yes(hit.rlike(r"(?i)^(?:AKIA|password|passwd|pwd|secret|token|api)")),
        },
    )
    context = _of_kind(s, {k: yes(before.rlike(v)) for k, v in CUES.items()})
    unlikely = F.when(before.rlike(UNLIKELY), 0)
    return [shape, check, gazetteer, context, unlikely]


VOTES = 5


def features(s: Column) -> list[Column]:
    """Yes-or-no features of the span that the final classifier sees besides its kind."""
    hit = s["hit"]
    digits = _digits(hit)
    return [
        s["base"],
        _of_kind(s, {k: s["before"].rlike(v) for k, v in CUES.items()}),
        s["before"].rlike(UNLIKELY),
        hit.rlike(DOMAINS),
        F.length(digits).between(9, 15),
        F.length(digits) * 2 >= F.length(hit),
        F.length(hit) >= 16,
        F.when(_kind_is(s, "card") & (F.length(digits) > 1), luhn(digits)).otherwise(F.lit(False)),
        hit.rlike(r"[A-Za-z]") & hit.rlike(r"[0-9]"),
    ]


FEATURES = 9


def _voted(spans: Column) -> Column:
    """Spans with their votes (-1 for none) and features as short strings; the texts of the spans stay behind."""

    def slim(s: Column) -> Column:
        vote = F.concat(*[F.coalesce(v.cast("string"), F.lit("-")) for v in votes(s)])
        feature = F.concat(*[F.when(f, "1").otherwise("0") for f in features(s)])
        return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["base"].alias("base"), vote.alias("votes"), feature.alias("features"))

    return F.transform(spans, slim)


# --- reliabilities and the final classifier -----------------------------------------------------------------------------


def reliabilities(patterns: list[tuple[int, str, int]], rounds: int = 100) -> dict[tuple[int, str], float]:
    """Posterior of each (kind, votes) by expectation-maximisation over their counts.

    Rates start from the belief that labelers are right more often than not, and priors keep them there.
    """
    share = {k: 0.6 for k, _, _ in patterns}
    hit = [[0.8, 0.2] for _ in range(VOTES)]  # P(vote 1 | personal), P(vote 1 | not)
    posterior: dict[tuple[int, str], float] = {}
    for _ in range(rounds):
        moved = 0.0
        for kind, votes_, _n in patterns:
            odds = math.log(share[kind] / (1 - share[kind]))
            for i, v in enumerate(votes_):
                if v != "-":
                    p, q = hit[i]
                    odds += math.log(p / q) if v == "1" else math.log((1 - p) / (1 - q))
            new = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
            moved = max(moved, abs(new - posterior.get((kind, votes_), 0.0)))
            posterior[kind, votes_] = new
        for kind in share:
            own = [(posterior[k, v], n) for k, v, n in patterns if k == kind]
            share[kind] = (sum(p * n for p, n in own) + 3) / (sum(n for _, n in own) + 5)
        for i in range(VOTES):
            seen = [(posterior[k, v], v[i] == "1", n) for k, v, n in patterns if v[i] != "-"]
            yes, no = sum(p * n for p, _, n in seen), sum((1 - p) * n for p, _, n in seen)
            hit[i] = [
                max(0.5, (sum(p * n for p, one, n in seen if one) + 8) / (yes + 10)),
                min(0.5, (sum((1 - p) * n for p, one, n in seen if one) + 2) / (no + 10)),
            ]
        if moved < 1e-9:
            break
    return posterior


def classifier(cells: list[tuple[int, str, float, float]], rounds: int = 400, ridge: float = 0.01) -> tuple[list[float], list[float]]:
    """Weights of kinds and features from ``(kind, features, posterior, count)``: logistic regression by gradient steps."""
    kinds, weights = [0.0] * len(KINDS), [0.0] * FEATURES
    total = sum(n for *_, n in cells) or 1.0
    for _ in range(rounds):
        dk, dw = [ridge * w for w in kinds], [ridge * w for w in weights]
        for kind, bits, target, n in cells:
            z = kinds[kind] + sum(w for w, b in zip(weights, bits) if b == "1")
            error = (1 / (1 + math.exp(-max(-50.0, min(50.0, z)))) - target) * n / total
            dk[kind] += error
            for i, b in enumerate(bits):
                if b == "1":
                    dw[i] += error
        kinds = [w - 1.0 * g for w, g in zip(kinds, dk)]
        weights = [w - 1.0 * g for w, g in zip(weights, dw)]
    return kinds, weights


def untouched(base: Column, wide: Column) -> Column:
    """The proposals that touch no base span, and all secrets: a secret is one value whatever is inside it, so digits of
    a token that look like a card do not save the rest."""
    empty = F.array().cast(_SPANS)

    def free(from_start: bool):
        # Base spans met so far reach up to ``edge`` (or, from the end, down to it).
        def step(edge: Column, s: Column) -> tuple[Column, Column]:
            touches = s["start"] < edge if from_start else s["end"] > edge
            reach = F.greatest(edge, s["end"]) if from_start else F.least(edge, s["start"])
            return F.when(s["base"], reach).otherwise(edge), F.when(s["base"] | _kind_is(s, "secret") | ~touches, s)

        return step

    left = scanned(F.array_sort(F.concat(base, wide)), F.lit(-1), empty, free(True))
    both = scanned(F.reverse(F.filter(left, lambda s: s.isNotNull())), F.lit(2**31 - 1), empty, free(False))
    kept = F.filter(both, lambda s: s.isNotNull() & ~s["base"])
    return F.when((F.size(base) > 0) & (F.size(wide) > 0), F.reverse(kept)).otherwise(wide)


def personal_data(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns of ``keep``, ``base`` and ``spans`` (base and accepted): arrays of (start, kind, end), sorted."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base, wide = spans_of(F.col("body"))
    rows = docs.select("doc_id", *keep, text.alias("body")).select("doc_id", *keep, base.alias("base"), wide.alias("wide"))
    rows = rows.select("doc_id", *keep, _voted(F.col("base")).alias("base"), _voted(untouched(F.col("base"), F.col("wide"))).alias("wide"))
    rows = stored(rows, "personal-spans")

    counts = rows.select(F.explode(F.concat("base", "wide")).alias("s")).groupBy("s.kind", "s.votes", "s.features").agg(F.count("*").alias("n")).collect()
    patterns: dict[tuple[int, str], int] = {}
    for r in counts:
        patterns[r.kind, r.votes] = patterns.get((r.kind, r.votes), 0) + r.n
    posterior = reliabilities(sorted((k, v, n) for (k, v), n in patterns.items()))
    kinds, weights = classifier(sorted((r.kind, r.features, posterior[r.kind, r.votes], float(r.n)) for r in counts))

    def accepted(s: Column) -> Column:
        z = F.element_at(F.array(*[F.lit(w) for w in kinds]), s["kind"] + 1)
        for i, w in enumerate(weights):
            z = z + F.when(F.substring(s["features"], i + 1, 1) == "1", F.lit(w)).otherwise(F.lit(0.0))
        return z >= 0

    place = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    added = F.filter("wide", accepted)
    return rows.select(
        "doc_id",
        *keep,
        F.array_sort(F.transform("base", place)).alias("base"),
        let(F.array_sort(F.transform(F.concat("base", added), place)), lambda all_: F.filter(all_, lambda s, i: (i == 0) | (s != F.get(all_, F.greatest(i - 1, F.lit(0)))))).alias("spans"),
    )


def written_spans(spans: str) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def redacted(text: Column, spans: str) -> Column:
    """``text`` with every span replaced by its kind in brackets; overlapping spans become one, under the first's kind."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    pieces = "array<struct<start:int,stop:int,mark:string>>"

    def step(at: Column, s: Column) -> tuple[Column, Column]:
        # What stands before the span, and its mark; a span that overlaps the one before only moves the end.
        mark = F.when(s["start"] >= at, F.element_at(names, s["kind"] + 1)).otherwise(F.lit(""))
        piece = F.struct(at.alias("start"), F.greatest(at, s["start"]).alias("stop"), mark.alias("mark"))
        return F.greatest(at, s["end"]), piece

    def joined(chars: Column) -> Column:
        def part(p: Column) -> Column:
            at, size = p["start"] + 1, p["stop"] - p["start"]
            return F.concat(F.when(few, F.substring(text, at, size)).otherwise(F.array_join(F.slice(chars, at, size), "")), p["mark"])

        end = F.aggregate(spans, F.lit(0), lambda at, s: F.greatest(at, s["end"]))
        tail = F.struct(end.alias("start"), F.length(text).alias("stop"), F.lit("").alias("mark"))
        cut = scanned(F.col(spans), F.lit(0), F.array().cast(pieces), step)
        return F.array_join(F.transform(F.concat(cut, F.array(tail)), part), "")

    # A substring is counted off from the start of the text; with many spans the text is taken apart once instead.
    few = F.size(spans) <= FEW
    chars = F.when(few, F.array().cast("array<string>")).otherwise(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)))
    return F.when(F.size(spans) > 0, let(chars, joined)).otherwise(text)


def op7_privacy(spark, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    count = [F.size(F.filter(kinds, lambda k: k == F.lit(KINDS.index(name)))).cast("long").alias(f"n_{name}") for name in KINDS[:BASE]]
    return found.select("doc_id", *count, F.sha2(written_spans("base").cast("binary"), 256).alias("base_sha256"), written_spans("spans").alias("spans"))
