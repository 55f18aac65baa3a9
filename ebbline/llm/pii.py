"""Personal data by weak supervision (operator 3), in DataFrame functions only.

Strict patterns give the base spans, which always stay.  Loose patterns propose further
spans.  Five labelers (strict pattern, format, gazetteer, context words, boundaries) vote
1, -1 or 0 on every span; expectation-maximisation estimates from the counts of vote
patterns how reliable each labeler is per kind, and a logistic classifier over votes and
span shape is trained on the resulting probabilities.  Proposed spans that it accepts are
added.  Only counts of vote patterns, at most ``3**5`` per kind and shape, reach the driver.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed kinds, in the order of results.
KINDS = ("email", "ip", "card", "phone")
# Fixed base patterns.  Possessive repeats and look-behinds keep them linear; they match
# what the plain patterns match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|[\[(] ?at ?[\])]) ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Za-z0-9-]++){1,6}",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?: ?\. ?[0-9]{1,3}){3}(?![0-9.])",
    "card": r"(?<![0-9])[0-9](?:[ ./-]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9+])(?:00[1-9][0-9]{0,2}[ .-]?)?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])",
}
# A text without any of these holds no loose match of the kind.
HINTS = {"email": r"@|at ?[\])]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
# Gazetteers: endings of addresses, first digits of cards, calling codes, private networks.
GAZETTEER = {
    "email": r"(?i)(?:com|org|net|edu|gov|io|info|biz|de|fr|es|uk|it|nl|eu|us|ca|au|jp|cn|in|br)$",
    "ip": r"^(?!0|127|22[4-9]|2[3-5][0-9])",
    "card": r"^(?:4|5[1-5]|3[47]|6011|65|2[2-7])",
    "phone": r"^(?:\+|00)(?:1|33|34|44|49|39|31|61|81|86|91|55)",
}
# Only a phone number with one of these in front has a calling code.
PREFIX = r"^(?:\+|00)"
GOOD_WORDS = {
    "email": r"mail|contact|write to|reach",
    "ip": r"\bip\b|host|server|address|login from",
    "card": r"card|visa|amex|credit|debit|payment",
    "phone": r"phone|\btel\b|call|fax|mobile|cell|dial",
}
BAD_WORDS = r"order|invoice|isbn|issn|version|serial|ref\b|article|doi|\bid\b|sku|part no"
CONTEXT = 32
VOTERS = ("strict", "format", "gazetteer", "context", "boundary")
ACCEPT = 0.9
SPAN = "array<struct<kind:string,b:int,e:int,txt:string,base:boolean>>"


def let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), then), 0)


def _matches(text: Column, kind: str, pattern: str, base: bool) -> Column:
    """Spans of all leftmost non-overlapping matches, in code points."""

    def placed(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))

        def step(s: Column, x: Column) -> Column:
            b = s["at"] + x["gap"]
            e = b + F.length(x["txt"])
            span = F.struct(F.lit(kind).alias("kind"), b.alias("b"), e.alias("e"), x["txt"].alias("txt"), F.lit(base).alias("base"))
            return F.struct(e.alias("at"), F.concat(s["out"], F.array(span)).alias("out"))

        start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))
        pairs = F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("txt"), F.length(g).alias("gap")))
        return F.when(F.size(found) > 0, F.aggregate(pairs, start, step, lambda s: s["out"])).otherwise(F.array().cast(SPAN))

    spans = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
    return F.when(F.rlike(text, F.lit(HINTS[kind])), spans).otherwise(F.array().cast(SPAN))


def _digits(txt: Column) -> Column:
    return F.regexp_replace(txt, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the checksum of a string of digits is a multiple of ten."""

    def value(c: Column, i: Column) -> Column:
        d = F.ascii(c) - F.lit(48)
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, x: a + x) % 10 == 0


def _octets(txt: Column) -> Column:
    """Whether all parts are at most 255; zeros in front do not count."""
    parts = F.transform(F.split(F.replace(txt, F.lit(" "), F.lit("")), r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(parts, lambda p: F.when(F.length(p) <= 3, F.coalesce(p.try_cast("int"), F.lit(0)) <= 255).otherwise(F.lit(False)))


def _valid(kind: Column, txt: Column) -> Column:
    """The conditions a base match has to meet."""
    n = F.length(_digits(txt))
    return (
        F.when(kind == "ip", _octets(txt))
        .when(kind == "card", F.when((n >= 16) & (n <= 19), luhn(_digits(txt))).otherwise(F.lit(False)))
        .when(kind == "phone", (n >= 8) & (n <= 15))
        .otherwise(F.lit(True))
    )


def base_spans(text: Column) -> Column:
    """Array of spans of the strict patterns, by kind in the order of KINDS, then start."""
    every = F.concat(*[_matches(text, k, BASE[k], True) for k in KINDS])
    return F.filter(every, lambda s: _valid(s["kind"], s["txt"]))


def candidates(text: Column) -> Column:
    """Base spans and the loose matches that overlap none of them."""

    def both(base: Column) -> Column:
        loose = F.concat(*[_matches(text, k, LOOSE[k], False) for k in KINDS])
        free = F.filter(loose, lambda s: ~F.exists(base, lambda t: (s["b"] < t["e"]) & (t["b"] < s["e"])))
        return F.concat(base, free)

    return let(base_spans(text), both)


def _by_kind(kind: Column, of: dict[str, Column]) -> Column:
    out = F.lit(None)
    for k in KINDS:
        out = F.when(kind == k, of[k]).otherwise(out)
    return out


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))


def votes(text: Column, s: Column) -> Column:
    """Struct of the five votes and the shape of a span."""
    txt, kind = s["txt"], s["kind"]
    n = F.length(_digits(txt))
    ok = (
        F.when(kind == "email", F.rlike(txt, F.lit(r"^[A-Za-z0-9].*[A-Za-z]{2,}$")))
        .when(kind == "ip", _octets(txt))
        .when(kind == "card", luhn(_digits(txt)))
        .otherwise((n >= 10) & (n <= 13))
    )
    listed = _by_kind(kind, {k: F.rlike(F.when(F.lit(k == "card"), _digits(txt)).otherwise(txt), F.lit(GAZETTEER[k])) for k in KINDS})
    before = F.lower(F.substr(text, F.greatest(s["b"] - CONTEXT, F.lit(0)) + 1, F.least(s["b"], F.lit(CONTEXT))))
    good = _by_kind(kind, {k: F.rlike(before, F.lit(GOOD_WORDS[k])) for k in KINDS})
    around = F.concat(F.substr(text, s["b"], F.when(s["b"] > 0, F.lit(1)).otherwise(F.lit(0))), F.substr(text, s["e"] + 1, F.lit(1)))
    return F.struct(
        F.when(s["base"], F.lit(1)).otherwise(F.lit(-1)).alias("strict"),
        _vote(ok, ~ok).alias("format"),
        _vote(listed, ~listed & ((kind != "phone") | F.rlike(txt, F.lit(PREFIX)))).alias("gazetteer"),
        _vote(good, F.rlike(before, F.lit(BAD_WORDS))).alias("context"),
        F.when(F.rlike(around, F.lit(r"[\p{L}\p{N}_]")), F.lit(-1)).otherwise(F.lit(1)).alias("boundary"),
        F.when(F.rlike(txt, F.lit(r"[ ()\[\]./-]")), F.lit(1)).otherwise(F.lit(0)).alias("parted"),
    )


class Model(NamedTuple):
    """Per kind: reliability of each voter, and weights of the classifier (last: constant)."""

    reliability: dict[str, dict[str, float]]
    weights: dict[str, list[float]]


def _estimate(rows: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> tuple[list[float], list[float], float]:
    """Reliabilities, probability of each pattern, share of true spans.

    Two classes and voters that err independently given the class.  Counts start with a
    few virtual spans on which voters are right four times out of five.
    """
    p = [min(max(0.5 + 0.1 * sum(v), 0.05), 0.95) for v, _ in rows]
    share, right = 0.5, [0.8] * len(VOTERS)
    for _ in range(rounds):
        total = sum(c for _, c in rows)
        share = (sum(q * c for q, (_, c) in zip(p, rows)) + 1) / (total + 2)
        for j in range(len(VOTERS)):
            cast = sum(c for v, c in rows if v[j])
            agree = sum(c * (q if v[j] > 0 else 1 - q) for q, (v, c) in zip(p, rows) if v[j])
            right[j] = min(max((agree + 8) / (cast + 10), 0.55), 0.99)
        new = []
        for v, _ in rows:
            odds = math.log(share / (1 - share)) + sum(x * math.log(r / (1 - r)) for x, r in zip(v, right))
            new.append(1 / (1 + math.exp(-odds)))
        moved = max((abs(a - b) for a, b in zip(p, new)), default=0.0)
        p = new
        if moved < 1e-9:
            break
    return right, p, share


def _features(v: tuple[int, ...], parted: int) -> list[float]:
    return [float(x) for x in v] + [float(parted), 1.0]


def _classifier(rows: list[tuple[tuple[int, ...], int, int, float]], steps: int = 300) -> list[float]:
    """Logistic weights for rows of (votes, parted, count, probability)."""
    w = [1.0] * len(VOTERS) + [0.0, 0.0]
    total = sum(c for _, _, c, _ in rows) or 1
    for _ in range(steps):
        grad = [0.02 * x for x in w]
        for v, parted, c, q in rows:
            x = _features(v, parted)
            z = sum(a * b for a, b in zip(w, x))
            err = (1 / (1 + math.exp(-max(min(z, 35.0), -35.0))) - q) * c / total
            grad = [g + err * b for g, b in zip(grad, x)]
        w = [a - 0.5 * g for a, g in zip(w, grad)]
    return w


def fit(docs: DataFrame, *, text_col: str = "text") -> Model:
    """Vote on every candidate of every text, then estimate on the counts of vote patterns."""
    text = F.col("text")
    seen = (
        docs.select(F.col(text_col).cast("string").alias("text"))
        .filter("text <> ''")
        .select("text", F.explode(candidates(text)).alias("s"))
        .select(F.col("s.kind").alias("kind"), votes(text, F.col("s")).alias("v"))
        .select("kind", "v.*")
        .groupBy("kind", *VOTERS, "parted")
        .count()
        .collect()
    )
    reliability, weights = {}, {}
    for kind in KINDS:
        mine = sorted((tuple(r[v] for v in VOTERS), r["parted"], r["count"]) for r in seen if r["kind"] == kind)
        right, p, _ = _estimate([(v, c) for v, _, c in mine])
        reliability[kind] = dict(zip(VOTERS, right))
        weights[kind] = _classifier([(v, parted, c, q) for (v, parted, c), q in zip(mine, p)])
    return Model(reliability, weights)


def probability(model: Model, text: Column, s: Column) -> Column:
    """The classifier's probability that a span is personal data."""

    def score(v: Column, w: list[float]) -> Column:
        z = F.lit(w[-1]) + v["parted"] * F.lit(w[-2])
        for name, x in zip(VOTERS, w):
            z = z + v[name] * F.lit(x)
        return 1 / (1 + F.exp(-z))

    return let(votes(text, s), lambda v: _by_kind(s["kind"], {k: score(v, model.weights[k]) for k in KINDS}))


def find(model: Model, text: Column, *, accept: float = ACCEPT) -> Column:
    """Array of (kind, b, e, txt, base): base spans, then accepted ones, sorted by KINDS and start."""
    kept = F.filter(candidates(text), lambda s: s["base"] | (probability(model, text, s) >= accept))
    return let(kept, lambda spans: F.concat(*[F.array_sort(of_kind(spans, k)) for k in KINDS]))


def of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """(doc_id, spans) for every row of ``docs``; null texts are empty and have no spans."""
    model = fit(docs, text_col=text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    return rows.select("doc_id", find(model, F.col("text"), accept=accept).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """The text with every span written as its kind in brackets; spans that overlap become one."""

    def step(s: Column, x: Column) -> Column:
        mark = F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))
        fresh = F.struct(
            F.greatest(s["at"], x["e"]).alias("at"),
            F.concat(s["out"], F.array(F.substr(text, s["at"] + 1, x["b"] - s["at"]), mark)).alias("out"),
        )
        longer = F.struct(F.greatest(s["at"], x["e"]).alias("at"), s["out"].alias("out"))
        return F.when(x["b"] >= s["at"], fresh).otherwise(longer)

    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["b"].alias("b"), x["e"].alias("e"), x["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(order, start, step, lambda s: F.array_join(F.concat(s["out"], F.array(F.substr(text, s["at"] + 1))), ""))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def told(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["b"], s["e"])), ",")
