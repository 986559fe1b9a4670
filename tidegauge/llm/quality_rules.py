"""Quality rules as a bitmask ledger.

Each document is measured once. The ledger keeps the measurements and one bit per rule that it fails. A
policy is a version of which bits reject a document; policies are applied, and rules ablated, by bitwise
operations on the ledger without another look at the texts.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidegauge.llm.common import quoted, small_batches

# Symbols that are counted.
SYMBOLS = b"#*$%&|<>"

MEASURES = T.StructType([
    T.StructField(name, T.LongType(), False)
    for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouted")
])


@dataclasses.dataclass(frozen=True)
class Rule:
    """A named condition on the measurements; true means that the document fails it."""

    name: str
    fails: str


# The bit of a rule is its place in this list; append only.
RULES = (
    Rule("too_few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("too_many_words", "n_words > 2000000"),
    Rule("words_too_short", "word_chars < 2 * n_words"),
    Rule("words_too_long", "word_chars > 15 * n_words"),
    Rule("symbols", "n_symbols > n_words"),
    Rule("repeated_lines", "n_lines >= 4 and 100 * n_dup_lines > 30 * n_lines"),
    Rule("shouting", "100 * n_shouted > 60 * n_words"),
)

BASE = ("too_few_words", "repeated_words")
# Versions of which rules reject.
POLICIES = {
    "base-1": BASE,
    "strict-1": (*BASE, "too_many_words", "words_too_short", "words_too_long", "symbols", "repeated_lines", "shouting"),
}
POLICY = "strict-1"


def _repeated(words: list[bytes]) -> int:
    """Words inside a 3-word window that is found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    k = len(numbers)
    if k < 1 << 20:
        windows = (ids[:-2] * k + ids[1:-1]) * k + ids[2:]
    else:  # pairs are numbered first, so that the product still fits
        pairs = np.unique(ids[:-1] * k + ids[1:], return_inverse=True)[1].astype(np.int64)
        windows = pairs[:-1] * k + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    marked = np.zeros(n, bool)
    marked[:-2] |= twice
    marked[1:-1] |= twice
    marked[2:] |= twice
    return int(marked.sum())


def _measure(text: bytes | None) -> tuple[int, ...]:
    text = text or b""
    words = text.split()
    packed = b"".join(words)
    starts = np.frombuffer(packed, np.uint8)
    word_chars = len(packed) - int(np.count_nonzero((starts & 0xC0) == 0x80))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    shouted = sum(w.isupper() and len(w) > 1 for w in words) if packed != packed.lower() else 0
    return len(words), word_chars, symbols, len(lines) - len(set(lines)), _repeated(words), len(lines), shouted


@F.pandas_udf(MEASURES)
def _measures(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([_measure(t) for t in batch], columns=MEASURES.names)


def measurements(text: Column) -> Column:
    """Struct of all measurements of a text; null counts as empty."""
    return _measures(F.encode(text, "UTF-8"))


def _failure_bits(rules: Sequence[Rule], prefix: str) -> Column:
    bits = F.lit(0).cast("long")
    for place, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(_within(rule.fails, prefix)), F.lit(1 << place)).otherwise(F.lit(0)).cast("long"))
    return bits


def _within(condition: str, prefix: str) -> str:
    words = [f"{prefix}.{w}" if w in MEASURES.names else w for w in condition.split()]
    return " ".join(words)


def ledger(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents with `measures` (a struct) and `failed`, the bits of the rules that they fail. Null
    and empty texts measure zero. No rows are added or removed. Columns of these names are replaced."""
    small_batches(docs.sparkSession)
    measured = docs.withColumn("measures", measurements(quoted(text_col).cast("string")))
    return measured.withColumn("failed", _failure_bits(rules, "measures"))


def policy_mask(policy: str, rules: Sequence[Rule] = RULES) -> int:
    names = [r.name for r in rules]
    return sum(1 << names.index(n) for n in POLICIES[policy])


def rejected(failed: Column, policy: str = POLICY) -> Column:
    """Whether a version of the policy rejects a document with these failure bits."""
    return failed.bitwiseAND(F.lit(policy_mask(policy))) != 0


def ablation(entries: DataFrame, policy: str = POLICY, rules: Sequence[Rule] = RULES) -> DataFrame:
    """For each rule of a policy: documents that fail it, and documents that only it rejects, so that the
    policy would keep them without it. The ledger is counted by its bits first: one row per combination."""
    mask = policy_mask(policy, rules)
    counts = entries.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    each = counts.select("bits", "n", F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
        for i, r in enumerate(rules) if mask >> i & 1])).alias("r"))
    bit = F.col("r.bit")
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("bits").bitwiseAND(bit) != 0, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == bit, F.col("n")).otherwise(0)).alias("only_this"))


def passing(docs: DataFrame, text_col: str = "text", policy: str = POLICY) -> DataFrame:
    """The documents that a policy keeps, with their own columns."""
    failed = _failure_bits(RULES, "measures")
    small_batches(docs.sparkSession)
    measured = docs.select(
        F.struct(*[quoted(c) for c in docs.columns]).alias("doc"),
        measurements(quoted(text_col).cast("string")).alias("measures"))
    return measured.where(~rejected(failed, policy)).select(*[
        F.col("doc").getField(c).alias(c) for c in docs.columns])
