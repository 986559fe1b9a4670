"""Personal data by gradient-boosted candidates.

Generators with high recall propose spans, which may overlap. Each candidate is described by a few binned
features of its format and context. The spans that a strict check confirms (address syntax, octets, check
digit, number of digits) are always reported. Boosted trees learn what personal data looks like from labels
that they do not see: the checks of the strict candidates, for addresses a closer one than the contract of
that kind asks for, and loose candidates that cannot be what they look like (dates, too few digits, no check
digit, no address when spelled back), as negative ones. A loose candidate that nothing refutes has no label. It is reported if
its score reaches the threshold of its group, the lowest at which held-out candidates of that group are
right to `PRECISION`. A group is a format, so that a kind which is nearly always confirmed vouches for
no other. Loose candidates meet strict ones in a group by a shared form: a spelled address is described as the
address it stands for, a phone number with a prefix as the number behind it. A group that cannot reach
`PRECISION` adds nothing, and a span that failed its own check does not come back under another kind.

The features are discrete, so the whole corpus comes down to counts per combination of features, at most
`MAX_CELLS` rows by construction. The trees are fitted to these counts, and run as one SQL expression.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.llm.common import (
    equals_any, in_context, let, overlaps_any, quoted, span_blocks, span_list, stored,
)

# The strict kinds and their formats, in the order in which they are listed. Where a pattern
# differs from the plain definition it finds the same spans without backtracking over long runs; a repeated group
# is possessive, which the matcher runs as a loop and not as a call for each turn.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
STRICT = ("email", "ip", "card", "phone")

# Loose generators: what may be a number of a person, and a spelled-out address.
NUMBER = r"(?<![0-9A-Za-z_.-])\(?[0-9]{2,4}\)?(?:[\x20.-][0-9]{2,6}){1,5}(?![0-9A-Za-z_-])"
SPELLED = r"(?i)[a-z0-9._-]{1,64}(?:\x20\(at\)\x20|\x20\[at\]\x20)[a-z0-9-]{1,64}(?:\x20(?:\(dot\)|\[dot\]|dot)\x20[a-z]{2,24}){1,3}"
AT, DOT = r"(?i)\x20[(\[]at[)\]]\x20", r"(?i)\x20[(\[]?dot[)\]]?\x20"
PREFIX = r"^\+(?:[0-9]{1,3}[\x20-]+(?=[(0-9]))?"  # what stands before a phone number as it is written at home

# What an address must be to serve as a positive label, and a number that is a date.
ADDRESS_SIZE = 254  # the longest address that mail accepts
ADDRESS = r"^[A-Za-z0-9_+-]+(?:\.[A-Za-z0-9_+-]+)*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}$"
DATE = (r"^(?:(?:19|20)[0-9]{2}([.\x20-])(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12][0-9]|3[01])"
        r"|(?:0?[1-9]|[12][0-9]|3[01])([.\x20-])(?:0?[1-9]|1[0-2])\2(?:19|20)[0-9]{2})(?![0-9])")

CUES = r"(?i)(?:mail|contact|write|phone|call|tel|mobile|fax|card|visa|account|iban|ssn|host|server|addr)[^\n]{0,12}$"

PRECISION = 0.95
LEAST_HELD_OUT = 20  # confirmed held-out candidates below which a group has no threshold
ROUNDS = 24
RATE = 0.4

# Feature: number of values. The number of cells is bounded by their product times folds and labels.
FEATURES = {"shape": 6, "digits": 5, "groups": 4, "paren": 2, "cue": 2, "before": 2, "after": 2}
FORMAT = ("shape", "digits", "groups", "paren")  # the features that make a group
MAX_CELLS = int(np.prod(list(FEATURES.values()))) * 4

_SPAN = ("array<struct<start:bigint,end:bigint,place:int,kind:string,strict:boolean,confirmed:boolean,"
         "label:boolean,"
         + ",".join(f"{f}:int" for f in FEATURES) + ">>")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    places = F.split(F.reverse(digits), "")
    doubled = F.transform(places, lambda d, i: F.when(
        i % 2 == 1, F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int") + 1)
    ).otherwise(d.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda acc, x: acc + x) % 10 == 0


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _confirmed(kind: str, hit: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return hit.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return luhn(_digits(hit))
    return F.length(_digits(hit)).between(9, 15)


def _shared_form(kind: str, hit: Column) -> Column:
    """A hit in the form in which loose and strict kinds can be compared."""
    if kind == "spelled":
        return F.regexp_replace(F.regexp_replace(hit, AT, "@"), DOT, ".")
    return F.regexp_replace(hit, PREFIX, "") if kind == "phone" else hit


def _is_address(form: Column) -> Column:
    return F.when(F.length(form) > ADDRESS_SIZE, False).otherwise(form.rlike(ADDRESS))


def _label(kind: str, form: Column, confirmed: Column) -> Column:
    """Whether a hit is what its kind says, as far as a check can tell; null for loose ones that nothing refutes."""
    if kind == "email":
        return _is_address(form)
    if kind == "spelled":
        return F.when(~_is_address(form), F.lit(False))
    if kind == "number":
        digits = _digits(form)
        n = F.length(digits)
        return F.when((n < 9) | (n > 19) | form.rlike(DATE) | ((n >= 13) & ~luhn(digits)), F.lit(False))
    return confirmed


def _features(form: Column, match: Column) -> dict[str, Column]:
    """Binned format and context of a candidate. The digits of an address are no part of its format."""
    ahead, next_ = match["ahead"], match["next"]
    address = form.contains("@")
    digits = F.length(_digits(form))
    groups = F.size(F.regexp_extract_all(form, F.lit("[0-9]+"), F.lit(0)))
    shape = (
        F.when(address, 0).when(form.rlike("[A-Za-z]"), 1).when(form.rlike(r"^[0-9.]+$") & form.contains("."), 2)
        .when(form.contains("-"), 3).when(form.contains(" "), 4).otherwise(5))
    bins = F.when(digits < 7, 0).when(digits < 9, 1).when(digits < 13, 2).when(digits < 16, 3).otherwise(4)
    return {
        "shape": shape, "digits": F.when(address, 0).otherwise(bins),
        "groups": F.when(address, 0).otherwise(F.least(groups, F.lit(4)) - F.least(groups, F.lit(1))),
        "paren": form.contains("(").cast("int"),
        "cue": ahead.rlike(CUES).cast("int"),
        "before": F.when((match["start"] == 0) | ahead.rlike(r"[\s(\[,;:=\"']$"), 1).otherwise(0),
        "after": F.when((next_ == "") | next_.rlike(r"^[\s)\],;:.!?\"']"), 1).otherwise(0),
    }


def candidates(text: Column) -> Column:
    """All proposed spans of a text. Strict kinds come from their own patterns; a hit that fails its check
    stays as a negative example and is not retried."""
    proposals = [
        ("email", EMAIL, text.contains("@"), True), ("ip", IP, text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"), True),
        ("card", CARD, text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"), True), ("phone", PHONE, text.rlike(r"\+[0-9]"), True),
        ("number", NUMBER, text.rlike(r"[0-9][\x20.)-]{1,2}[0-9]"), False),
        ("spelled", SPELLED, text.rlike(r"(?i)[(\[]at[)\]]"), False),
    ]

    def hits(place: int, kind: str, pattern: str, probe: Column, strict: bool) -> Column:
        def span(m: Column) -> Column:
            form = _shared_form(kind, m["hit"])
            bins = _features(form, m)
            confirmed = _confirmed(kind, m["hit"]) if strict else F.lit(False)
            return F.struct(
                m["start"], m["end"], F.lit(place).alias("place"), F.lit(kind).alias("kind"),
                F.lit(strict).alias("strict"), confirmed.alias("confirmed"), _label(kind, form, confirmed).alias("label"),
                *[c.cast("int").alias(n) for n, c in bins.items()])

        spans = F.transform(in_context(text, pattern, 24), span).cast(_SPAN)
        return F.when(probe, spans).otherwise(F.array().cast(_SPAN))

    return F.concat(*[hits(place, *p) for place, p in enumerate(proposals)])


@dataclasses.dataclass(frozen=True)
class Boosted:
    """Depth-two trees over binned features: (feature, value, then by branch (feature, value, low, high))."""

    start: float
    trees: Sequence[tuple]
    thresholds: dict[int, float]  # of the groups that have one

    @property
    def threshold(self) -> float:
        """The lowest of all groups."""
        return min(self.thresholds.values(), default=float("inf"))

    def threshold_of(self, row: Column) -> Column:
        """The threshold of a candidate's group; infinite if it has none."""
        if not self.thresholds:
            return F.lit(float("inf"))
        known = F.create_map(*[F.lit(v) for pair in sorted(self.thresholds.items()) for v in pair])
        return F.coalesce(F.try_element_at(known, _group({f: row[f] for f in FORMAT})), F.lit(float("inf")))

    def expression(self, row: Column) -> Column:
        total = F.lit(self.start)
        for feature, cut, left, right in self.trees:
            branches = [
                F.when(row[f] <= c, F.lit(low)).otherwise(F.lit(high)) for f, c, low, high in (left, right)]
            total = total + F.when(row[feature] <= cut, branches[0]).otherwise(branches[1])
        return total


def _group(values):
    """Number of a candidate's group, from its features as numbers, arrays or columns."""
    number = values[FORMAT[0]]
    for f in FORMAT[1:]:
        number = number * FEATURES[f] + values[f]
    return number


def fit(cells: list[dict]) -> Boosted:
    """Boosts on counted cells (features, confirmed as the label, held, n); each group's threshold comes from its own
    held-out ones. Without both labels there is nothing to learn, and no group has a threshold."""
    names = list(FEATURES)
    x = np.array([[c[f] for f in names] for c in cells], np.int64).reshape(-1, len(names))
    y = np.array([c["confirmed"] for c in cells], float)
    n = np.array([c["n"] for c in cells], float)
    held = np.array([c["held"] for c in cells], bool)
    train = n * ~held
    yes, no = (train * y).sum(), (train * (1 - y)).sum()
    if not yes or not no:
        return Boosted(0.0, (), {})
    start = float(np.log(yes / no))
    score, trees = np.full(len(y), start), []
    splits = [(j, v) for j, f in enumerate(names) for v in range(FEATURES[f] - 1)]

    def leaf(where: np.ndarray, p: np.ndarray) -> tuple[float, float]:
        g, h = (train * (y - p))[where].sum(), (train * p * (1 - p))[where].sum() + 1.0
        return g / h, g * g / h

    def cut(where: np.ndarray, p: np.ndarray) -> tuple[float, tuple]:
        best = (-1.0, (names[0], 0, 0.0, 0.0))
        for j, v in splits:
            low = where & (x[:, j] <= v)
            (a, gain_a), (b, gain_b) = leaf(low, p), leaf(where & ~low, p)
            if gain_a + gain_b > best[0] + 1e-12:
                best = gain_a + gain_b, (names[j], v, RATE * a, RATE * b)
        return best

    everywhere = np.ones(len(y), bool)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        best = None
        for j, v in splits:
            low = x[:, j] <= v
            left, right = cut(everywhere & low, p), cut(everywhere & ~low, p)
            if best is None or left[0] + right[0] > best[0] + 1e-12:
                best = left[0] + right[0], (names[j], v, left[1], right[1])
        tree = best[1]
        trees.append(tree)
        feature, at, left, right = tree
        low = x[:, names.index(feature)] <= at
        for side, (f, c, a, b) in ((low, left), (~low, right)):
            score = score + np.where(side, np.where(x[:, names.index(f)] <= c, a, b), 0.0)
    group = _group({f: x[:, names.index(f)] for f in FORMAT})
    reached = {
        int(g): _threshold(score[own], y[own], n[own]) for g in np.unique(group[held]) for own in [held & (group == g)]}
    return Boosted(start, tuple(trees), {g: t for g, t in reached.items() if t < float("inf")})


def _threshold(score: np.ndarray, y: np.ndarray, n: np.ndarray) -> float:
    """The lowest score at and above which held-out candidates are confirmed to PRECISION."""
    order = np.argsort(-score, kind="stable")
    values, hits, all_ = score[order], np.cumsum((n * y)[order]), np.cumsum(n[order])
    last = np.flatnonzero(np.append(values[1:] != values[:-1], True)) if len(values) else np.empty(0, int)
    good = [i for i in last if hits[i] >= LEAST_HELD_OUT and hits[i] >= PRECISION * all_[i]]
    return float(values[good[-1]]) - 1e-9 if good else float("inf")


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and `spans`, an array of (start, end, place, kind, strict, score) in code
    points, the end exclusive: all confirmed strict spans, and loose ones that nothing refutes, that reach the
    threshold of their group, overlap no confirmed span and are no span that failed its own check. Null and empty
    texts have none. Every row gives a row, repeated ones too."""
    text = quoted(text_col).cast("string")
    seen = stored(docs.select(
        quoted(id_col).alias("id"), F.pmod(F.xxhash64(text), F.lit(5)).cast("int").alias("fold"),
        F.coalesce(candidates(text), F.array().cast(_SPAN)).alias("spans")), "personal")
    cells = (
        seen.where(F.size("spans") > 0).select("fold", F.explode("spans").alias("s")).where("s.label is not null")
        .groupBy(*[F.col(f"s.{f}").alias(f) for f in FEATURES], F.col("s.label").alias("confirmed"),
                 (F.col("fold") == 0).alias("held"))
        .agg(F.count("*").alias("n")))
    # At most MAX_CELLS rows, whatever the corpus.
    model = fit(sorted((r.asDict() for r in cells.collect()), key=lambda c: sorted(c.items())))
    scored = F.transform("spans", lambda s: F.struct(
        *[s[f] for f in ("start", "end", "place", "kind", "strict", "confirmed", "label")], model.expression(s).alias("score"),
        model.threshold_of(s).alias("least")))

    def reported(every: Column) -> Column:
        sure = F.filter(every, lambda s: s["confirmed"])
        failed = F.filter(every, lambda s: s["strict"] & ~s["confirmed"])
        near = F.struct(span_blocks(sure).alias("sure"), span_blocks(failed).alias("failed"))
        added = let(near, lambda n: F.filter(every, lambda s: ~s["strict"] & s["label"].isNull() & (s["score"] >= s["least"])
                                             & ~overlaps_any(n["sure"], s) & ~equals_any(n["failed"], s)))
        return F.transform(F.concat(sure, added), lambda s: s.dropFields("least", "label"))

    return seen.select(F.col("id").alias(id_col), let(scored, reported).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first is named
    and the others are cut with it."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        shown = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit("["), s["kind"], F.lit("]"))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), shown.alias("out"))

    whole = F.aggregate(order, begin, step)
    return F.concat(whole["out"], F.substring(text, (whole["at"] + 1).cast("int"), F.length(text)))


def listed(spans: Column) -> Column:
    """`kind:start:end`, comma-joined by kind, then start."""
    return span_list(spans, ["place", "start", "end"])
