"""Secrets and how widely each is copied over the corpus (operator 13), in DataFrame functions only.

Strict patterns give the base spans, which always stay.  Loose patterns propose further
spans of the same kinds.  The value of every span is hashed; one aggregation counts the
distinct repositories and owners of each hash.  A value that many owners hold is a copied
example; one that few owners hold and that looks like a credential (length, mixed
characters, no word of a placeholder) is live.  Proposed spans are added where their value
is live.  Values themselves are in no shuffle and no result, only their digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.pii import let
from ebbline.session import freeze

# Fixed kinds, in the order of results.
KINDS = ("assign", "access", "hex")
# Fixed base patterns and least lengths.  Possessive repeats keep them linear; they match
# what the plain patterns match.  The least length of an access key or a run of hex digits
# stands in the pattern, as a shorter match leaves nothing behind that could match; the one
# of an assigned value is tested afterwards, as its failing matches use up their text.
BASE = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?+\x20*+[:=]\x20*+["']?+([A-Za-z0-9+/_.=-]++)""",
    "access": r"AKIA([A-Z0-9]{14,}+)",
    "hex": r"(?<![0-9a-f])([0-9a-f]{16,}+)",
}
LEAST_VALUE = 12
# Fixed forms of further credentials: other names of secrets, other key prefixes, hex in capitals.
LOOSE = {
    "assign": r"""(?i:pwd|passphrase|credentials?|auth_?key|access_?key|private_?key|signing_?key|bearer)["']?+(?:\x20*+[:=]\x20*+|\x20++)["']?+([A-Za-z0-9+/_.=-]{12,}+)""",
    "access": r"(?<![A-Za-z0-9])(?:ASIA|AROA|AIDA|ghp_|gho_|ghs_|glpat-|xox[abp]-|sk_live_|sk-|AIza)([A-Za-z0-9_-]{14,}+)",
    "hex": r"(?<![0-9A-Za-z])([0-9A-F]{32,}+)(?![0-9A-Za-z])",
}
# A text without any of these holds no match of the kind.
HINTS = {
    "assign": "(?i)passw|secret|token|api_?key",
    "access": "AKIA",
    "hex": "[0-9a-f]{16}",
}
LOOSE_HINTS = {
    "assign": "(?i)pwd|passphrase|credential|_?key|bearer",
    "access": "ASIA|AROA|AIDA|gh[pos]_|glpat-|xox|sk[_-]|AIza",
    "hex": "[0-9A-F]{32}",
}
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|change_me|your|test|xxxx|0000|1234|abcd|foobar|(.)\1{4}"
# Owners from which on a value is a copied example.
WIDE_OWNERS = 3
LEAST_KINDS = 8  # different characters of a live-looking value
SALTS = 16
SPAN = "array<struct<b:int,rank:int,kind:string,e:int,base:boolean,live:boolean,digest:binary>>"


def looks_live(value: Column) -> Column:
    """Whether a value has the shape of a generated credential."""
    different = F.size(F.array_distinct(F.split(value, "")))
    return (F.length(value) >= LEAST_VALUE) & (different >= LEAST_KINDS) & F.rlike(value, F.lit("[0-9]")) & ~F.rlike(value, F.lit(PLACEHOLDER))


def _matches(text: Column, kind: str, pattern: str, hint: str, base: bool) -> Column:
    """All leftmost non-overlapping matches, with places in code points."""
    rank = KINDS.index(kind)

    def placed(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))

        def step(s: Column, x: Column) -> Column:
            b = s["at"] + x["gap"]
            e = b + F.length(x["txt"])
            value = F.regexp_extract(x["txt"], pattern, 1)
            fits = F.length(value) >= LEAST_VALUE if kind == "assign" else F.lit(True)
            span = let(
                value,
                lambda v: F.struct(
                    b.alias("b"),
                    F.lit(rank).alias("rank"),
                    F.lit(kind).alias("kind"),
                    e.alias("e"),
                    F.lit(base).alias("base"),
                    looks_live(v).alias("live"),
                    F.unhex(F.sha2(v, 256)).alias("digest"),
                ),
            )
            return F.struct(e.alias("at"), F.when(fits, F.concat(s["out"], F.array(span))).otherwise(s["out"]).alias("out"))

        start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))
        pairs = F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("txt"), F.length(g).alias("gap")))
        return F.when(F.size(found) > 0, F.aggregate(pairs, start, step, lambda s: s["out"])).otherwise(F.array().cast(SPAN))

    spans = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
    return F.when(F.rlike(text, F.lit(hint)), spans).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """Array of the spans of the strict patterns, by kind in the order of KINDS, then start."""
    return F.concat(*[_matches(text, k, BASE[k], HINTS[k], True) for k in KINDS])


def candidates(text: Column) -> Column:
    """Base spans, and the loose matches that overlap none of them."""
    loose = F.concat(*[_matches(text, k, LOOSE[k], LOOSE_HINTS[k], False) for k in KINDS])

    def free(base: Column, other: Column) -> Column:
        return F.filter(other, lambda s: ~F.exists(base, lambda t: (s["b"] < t["e"]) & (t["b"] < s["e"])))

    return let(base_spans(text), lambda base: F.concat(base, let(loose, lambda other: F.when(F.size(other) > 0, free(base, other)).otherwise(other))))


def ownership(spans: DataFrame) -> DataFrame:
    """(digest, n_repos, n_owners) of rows of (digest, owner, repo); a null owner or repository
    is one of its own.  Equal rows meet before the shuffle, and a digest with very many
    repositories is first counted per owner."""
    return (
        spans.groupBy("digest", "owner", "repo")
        .agg(F.lit(1).alias("one"))
        .groupBy("digest", "owner")
        .agg(F.sum("one").alias("n_repos"))
        .groupBy("digest")
        .agg(F.sum("n_repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))
    )


def secrets(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repo_cols: tuple[str, ...] = ("source", "lang"),
    wide_owners: int = WIDE_OWNERS,
) -> DataFrame:
    """(doc_id, spans) for every row of ``docs``: spans by start, then kind.

    A span is (kind, b, e, base, digest, n_repos, n_owners, verdict), in code points; base
    spans have every verdict, added ones are ``live`` only:

    * ``example``: ``wide_owners`` or more owners hold the value, or it has no live shape;
    * ``live``: fewer owners hold it, and it has the shape of a credential.

    Null texts are empty.  A repository is one value of ``repo_cols`` of one owner; null
    owners are one owner.  Rows that repeat an id each give their row, and count once if
    owner and repository are equal.  Empty tables give no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(owner_col).cast("string").alias("owner"),
        F.xxhash64(*repo_cols).alias("repo"),
        text.alias("text"),
    )
    # Read twice below, so the patterns run once; row numbers stay as they are written here.
    seen = freeze(rows.select("doc_id", "owner", "repo", F.monotonically_increasing_id().alias("row"), candidates(F.col("text")).alias("spans")))
    each = seen.filter(F.size("spans") > 0).select("row", "owner", "repo", F.explode("spans").alias("s"))
    held = ownership(each.select(F.col("s.digest").alias("digest"), "owner", "repo"))
    # A value may stand in a third of all rows: its count is written once for each salt, and
    # its rows are dealt over the salts.  Values of one owner need no row at all.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    shared = held.filter("n_repos > 1").select("digest", "n_repos", "n_owners", salts)
    dealt = each.select("row", "s", F.col("s.digest").alias("digest"), F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int").alias("salt"))
    one = F.lit(1).cast("long")
    n_repos, n_owners = F.coalesce("n_repos", one), F.coalesce("n_owners", one)
    live = F.col("s.live") & (n_owners < wide_owners)
    told = (
        dealt.join(shared, ["digest", "salt"], "left")
        .filter(F.col("s.base") | live)
        .select(
            "row",
            F.struct(
                F.col("s.b").alias("b"),
                F.col("s.rank").alias("rank"),
                F.col("s.kind").alias("kind"),
                F.col("s.e").alias("e"),
                F.col("s.base").alias("base"),
                F.hex("s.digest").alias("digest"),
                n_repos.alias("n_repos"),
                n_owners.alias("n_owners"),
                F.when(live, F.lit("live")).otherwise(F.lit("example")).alias("verdict"),
            ).alias("span"),
        )
        .groupBy("row")
        .agg(F.array_sort(F.collect_list("span")).alias("found"))
    )
    none = F.array().cast(told.schema["found"].dataType)
    return seen.select("doc_id", "row").join(told, "row", "left").select("doc_id", F.coalesce("found", none).alias("spans"))


def told(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["b"], s["e"])), ",")
