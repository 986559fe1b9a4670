"""Secret scans with corpus-wide ownership frequency.

Patterns propose candidate strings with their places. The hashes of all candidates are aggregated over the
corpus by owner and repository: a string that many owners or very many repositories carry is an example that
was copied around, one that stays with its owner and looks random is a live-looking credential. Strict kinds are always reported;
candidates of the loose kinds become spans only if the corpus shows them as live.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.llm.common import let, matches, overlaps_any, quoted, span_blocks, span_list, stored


@dataclasses.dataclass(frozen=True)
class Kind:
    """A pattern. `probe` is a cheap pattern found in every text that has a match; `value` the part of the
    hit that is the credential; `size` the least length of the value; strict kinds are always reported."""

    name: str
    pattern: str
    probe: str
    value: str
    size: int
    strict: bool


# The strict kinds, in the order in which they are listed. Shorter runs than the least length
# cannot hide a longer one, so for access keys and hex the length is part of the pattern.
STRICT = (
    Kind("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         r"(?i)password|passwd|secret|token|api_?key", r"""[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$""", 6, True),
    Kind("access", r"AKIA[A-Z0-9]{16,}", "AKIA", r"(.+)", 20, True),
    Kind("hex", r"[0-9a-f]{24,}", r"[0-9a-f]{24}", r"(.+)", 24, True),
)
# Loose kinds: formats of well-known issuers and places where credentials stand.
LOOSE = (
    Kind("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]{40,}", "-----BEGIN", r"-----\s*([^-]+)", 40, False),
    Kind("prefixed", r"(?<![A-Za-z0-9])(?:gh[pousr]_|xox[abprs]-|sk_live_|glpat-)[A-Za-z0-9_-]{16,}",
         r"gh[pousr]_|xox[abprs]-|sk_live_|glpat-", r"[_-]([A-Za-z0-9_-]+)$", 16, False),
    Kind("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+", "eyJ", r"(.+)", 32, False),
    Kind("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/-]{16,}", r"(?i)bearer\x20", r"\x20([^\x20]+)$", 16, False),
    Kind("userinfo", r"://[^\s/:@]{1,64}:[^\s/:@]{6,64}@", "://", r":([^:@]+)@$", 6, False),
)
# Any run of letters and digits that no issuer marks: both cases and three separate groups of digits. What it is, an
# example or a credential, only the ownership counts tell. Spans inside those of other kinds are left to these.
UNMARKED = Kind(
    "entropy", r"(?<![A-Za-z0-9])(?=[a-z0-9]*+[A-Z])(?=[A-Z0-9]*+[a-z])(?=(?:[A-Za-z]*+[0-9]++){3})[A-Za-z0-9]{20,}+",
    r"[A-Za-z0-9]{20}", r"(.+)", 20, False)
KINDS = (*STRICT, *LOOSE, UNMARKED)

COPIED_OWNERS = 3  # owners from which on a string counts as a copied example
COPIED_REPOS = 100  # repositories from which on it does so whatever the number of owners
LIVE_SYMBOLS = 8  # different characters that a live-looking value has at least

_SPAN = "array<struct<start:bigint,end:bigint,place:int,kind:string,strict:boolean,key:string,random:boolean>>"


def candidates(text: Column, kinds: Sequence[Kind] = KINDS) -> Column:
    """All candidate spans of a text: leftmost non-overlapping for each kind; the kinds may overlap, but UNMARKED
    ones overlap no other."""
    fields = ("start", "end", "place", "kind", "strict", "key", "random")

    def hits(place: int, kind: Kind) -> Column:
        def span(m: Column) -> Column:
            value = F.regexp_extract(m["hit"], kind.value, 1)
            return F.struct(
                m["start"], m["end"], F.lit(place).alias("place"), F.lit(kind.name).alias("kind"),
                F.lit(kind.strict).alias("strict"), F.sha2(value, 256).alias("key"),
                ((F.size(F.array_distinct(F.split(value, ""))) >= LIVE_SYMBOLS)
                 & value.rlike("[0-9]") & value.rlike("[A-Za-z]")).alias("random"),
                (F.length(value) >= kind.size).alias("long"))

        long = F.filter(F.transform(matches(text, kind.pattern), span), lambda s: s["long"])
        bare = F.transform(long, lambda s: F.struct(*[s[f].alias(f) for f in fields]))
        return F.when(text.rlike(kind.probe), bare.cast(_SPAN)).otherwise(F.array().cast(_SPAN))

    marked = F.concat(*[hits(place, kind) for place, kind in enumerate(kinds) if kind is not UNMARKED])
    if UNMARKED not in kinds:
        return marked
    unmarked = hits(list(kinds).index(UNMARKED), UNMARKED)
    return let(marked, lambda known: let(span_blocks(known), lambda blocks: F.concat(
        known, F.filter(unmarked, lambda s: ~overlaps_any(blocks, s)))))


def ownership(found: DataFrame) -> DataFrame:
    """key, owners, repos and copies of the candidate strings in rows (key, owner, repo). A repository
    belongs to an owner. Each step is combined before its shuffle, so a string found everywhere is no
    hot key."""
    by_repo = found.groupBy("key", "owner", "repo").agg(F.count("*").alias("copies"))
    by_owner = by_repo.groupBy("key", "owner").agg(F.count("*").alias("repos"), F.sum("copies").alias("copies"))
    return by_owner.groupBy("key").agg(
        F.count("*").alias("owners"), F.sum("repos").alias("repos"), F.sum("copies").alias("copies"))


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
    repo_col: str | None = None, kinds: Sequence[Kind] = KINDS, copied_owners: int = COPIED_OWNERS,
    copied_repos: int = COPIED_REPOS,
) -> DataFrame:
    """One row per document: id and `spans`, an array of (start, end, place, kind, strict, owners, repos,
    verdict) in which positions are code points and the end is exclusive. Verdicts are `copied` (at least
    `copied_owners` owners or `copied_repos` repositories), `live` (looks random) and `plain`. Loose candidates are kept if live.

    Each document is a repository unless `repo_col` names one; null owners and repositories count as one
    each. Null and empty texts have no spans. Every row gives a row, repeated ones too.
    """
    text = quoted(text_col).cast("string")
    repo = quoted(repo_col or id_col).cast("string")
    seen = stored(docs.select(
        quoted(id_col).alias("id"), quoted(owner_col).cast("string").alias("owner"), repo.alias("repo"),
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(candidates(text, kinds), F.array().cast(_SPAN)).alias("spans")), "candidates")
    each = seen.where(F.size("spans") > 0).select("row", "owner", "repo", F.explode("spans").alias("s")).select(
        "row", "owner", "repo", "s.*")
    counts = ownership(each.select("key", "owner", "repo"))
    judged = each.drop("owner", "repo").join(counts, "key").withColumn(
        "verdict", F.when((F.col("owners") >= copied_owners) | (F.col("repos") >= copied_repos), "copied")
        .when(F.col("random"), "live").otherwise("plain"))
    spans = judged.where(F.col("strict") | (F.col("verdict") == "live")).groupBy("row").agg(F.sort_array(F.collect_list(
        F.struct("start", "place", "end", "kind", "strict", "owners", "repos", "verdict"))).alias("found"))
    rows = seen.select("row", "id").join(spans, "row", "left")
    none = F.array().cast(dict(spans.dtypes)["found"])
    return rows.select(F.col("id").alias(id_col), F.coalesce("found", none).alias("spans"))


def strict_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["strict"])


def of_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """`kind:start:end`, comma-joined by start, then kind."""
    return span_list(spans, ["start", "place", "end"])
