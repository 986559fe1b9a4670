"""Exact deduplication by a heavy-hitter split.

Every text becomes its SHA-256. A frequent-items summary (`approx_top_k`, a Misra-Gries summary that
lowers all counters when it is full) runs map-side with partial merges and names the digests that may be
frequent; an exact count then keeps those that are. These winners, at most `capacity` rows, are broadcast
and settle their rows where they are read. The remaining digests, none of them frequent, are grouped by an
ordinary shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegauge.llm.common import fresh, quoted, stored

CAPACITY = 256
MIN_COPIES = 32


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, min_copies: int = MIN_COPIES,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept and text_sha256.

    Texts are equal when identical; a null text counts as empty. The largest id of a group stays. Null
    ids lose against any other; a group of null ids keeps its rows. Rows that repeat an id and its text
    are reported as they are, all with the same verdict. An empty table gives no rows.
    """
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    digests = stored(docs.select(
        quoted(id_col).alias("id"), F.sha2(text, 256).alias("text_sha256")), "digests")
    winners = _winners(digests, capacity, min_copies)
    marked = digests.join(F.broadcast(winners), "text_sha256", "left")
    heavy = marked.where("group_size is not null")
    light = marked.where("group_size is null").select("id", "text_sha256")
    groups = light.groupBy("text_sha256").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    both = heavy.unionByName(light.join(groups, "text_sha256"))
    return both.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def _winners(digests: DataFrame, capacity: int, min_copies: int) -> DataFrame:
    """Exact size and largest id of the digests found frequent; at most `capacity` rows."""
    tracked = 8 * capacity
    summary = digests.agg(F.expr(f"approx_top_k(text_sha256, {capacity}, {tracked})").alias("top"))
    frequent = summary.select(F.explode("top").alias("t")).select(F.col("t.item").alias("text_sha256"))
    counted = (
        digests.join(F.broadcast(frequent), "text_sha256", "left_semi").groupBy("text_sha256")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        .where(F.col("group_size") >= min_copies)
    )
    return stored(counted, "winners")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that stay, with all their columns; of rows with one id and one text, one stays."""
    sha, other_id, other_sha = (fresh(docs, n) for n in ("text_sha256", "keep_id", "keep_sha"))
    keys = exact_groups(docs, id_col, text_col, **options).where("kept").select(
        F.col(id_col).alias(other_id), F.col("text_sha256").alias(other_sha)).distinct()
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    rows = docs.withColumn(sha, F.sha2(text, 256))
    same = F.col(other_id).eqNullSafe(quoted(id_col)) & (F.col(other_sha) == F.col(sha))
    kept = rows.join(keys, same, "left_semi")
    return kept.dropDuplicates([id_col, sha]).drop(sha)
