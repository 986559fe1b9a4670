"""Mixing sources to target weights by Sainte-Lague apportionment.

Every source gets a target in words. The mix is cut into blocks of equal size; each next block goes to the
source with the highest quotient target / (2 * blocks so far + 1). The blocks of a source are apportioned
the same way to groups of shards and to shards (sets of documents by hash), so that each shard has an
integer quota. In a shard the documents are laid end to end in a seeded order, and the quota is taken from
the start, round after round.

No list of quotients grows with the blocks: the divisor total / blocks gives nearly all of them, and only the
few seats around it are ranked (see `apportion`). Windows see one shard, one group of shards, or one row per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from tidegauge.llm.common import fresh, quoted, stored, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.0
MAX_EPOCHS = 3
BLOCK_WORDS = 64
SHARD_DOCS = 1000
GROUP_SHARDS = 1000
SEED = 20240607


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """source, docs, source_size and target from rows (source, size).

    Sources are ordered by code point, null last, and take the weights in turn. Targets share `share` of
    all words by weight, but none exceeds `max_epochs` times its source; what is cut goes to the others by
    weight, until none is above. One row per source passes through a single window.
    """
    totals = sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    by_name = W.partitionBy().orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (
        totals.withColumn("weight", F.element_at(
            cycle, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("whole", F.sum("source_size").over(W.partitionBy()) * F.lit(float(share)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    # By rising cap per weight, the sources that reach their cap come first. With the caps up to a source
    # taken, the others' level is what is left per weight; a source is capped if its ratio is not above it.
    order = W.partitionBy().orderBy("ratio", F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    leveled = (
        ranked.withColumn("level", (F.col("whole") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                          / F.sum("weight").over(after))
        .withColumn("capped", F.col("ratio") <= F.col("level"))
    )
    everything = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    free = F.first(F.when(~F.col("capped"), F.col("level")), ignorenulls=True).over(everything)
    return leveled.withColumn("free", free).select(
        "source", "docs", "source_size",
        F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * F.col("free")).alias("target"))


def apportion(rows: DataFrame, parent: Sequence[str], key: str, weight: str, seats: str) -> DataFrame:
    """Sainte-Lague: the `seats` of each parent go to its rows by the highest quotients
    weight / (2 * n + 1); equal quotients by key, nulls last. Adds `quota`. Weights of zero get none.

    With the divisor total / seats every row is rounded; the sum is off by half the number of rows at most,
    so the cut lies within 1.5 * rows * share + 1 seats of each row. Only these seats are ranked: some 8 per row.
    """
    group = W.partitionBy(*parent)
    share = F.col(weight) / F.col("_all")
    reach = F.ceil(F.lit(1.5) * F.col("_rows") * share).cast("long") + 2
    near = (
        rows.withColumn("_all", F.sum(weight).over(group)).withColumn("_rows", F.count("*").over(group))
        .withColumn("_near", F.when(F.col("_all") > 0, F.round(F.col(seats) * share).cast("long")).otherwise(F.lit(0).cast("long")))
        .withColumn("_reach", F.when(F.col(weight) > 0, reach).otherwise(F.lit(0).cast("long")))
        .withColumn("_sure", F.greatest(F.col("_near") - F.col("_reach"), F.lit(0).cast("long")))
        .withColumn("_left", F.col(seats) - F.sum("_sure").over(group))
    )
    seat = near.withColumn("_seat", F.explode(F.when(
        F.col(weight) > 0, F.sequence("_sure", F.col("_near") + F.col("_reach") - 1))))
    best = W.partitionBy(*parent).orderBy(
        (F.col(weight) / (2 * F.col("_seat") + 1)).desc(), F.col(key).asc_nulls_last(), "_seat")
    won = seat.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= F.col("_left"))
    keys = [*parent, key]
    extra = won.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.count("*").alias("_won"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = near.join(extra, same, "left")
    return joined.select(*rows.columns, (F.col("_sure") + F.coalesce("_won", F.lit(0))).alias("quota"))


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
    block_words: int = BLOCK_WORDS, shard_docs: int = SHARD_DOCS, seed: int = SEED,
) -> DataFrame:
    """One row per document: id, source, size, source_size, target (of its source) and taken, the words of
    it in the mix, repeats counted; at most `max_epochs` times its size.

    Null and empty texts have size 0 and nothing taken; a null source is a source of its own. The order is a
    seeded hash of the id, then the size, so that reruns agree; rows that repeat an id and size are
    interchangeable. If all texts are empty, all targets are 0. An empty table gives no rows.
    """
    sizes = stored(docs.select(
        quoted(id_col).alias("id"), quoted(source_col).cast("string").alias("source"),
        word_count(quoted(text_col).cast("string")).alias("size")), "sizes")
    sources = source_targets(sizes, weights, share, max_epochs)
    blocks = F.round(F.sum("target").over(W.partitionBy()) / block_words).cast("long")
    sources = apportion(
        sources.withColumn("_seats", blocks).withColumn("_one", F.lit(1)), ["_one"], "source", "target", "_seats",
    ).withColumnRenamed("quota", "source_quota").drop("_seats", "_one")
    sources = stored(sources.withColumn(
        "shards", F.greatest(F.ceil(F.col("docs") / shard_docs), F.lit(1)).cast("int")), "sources")
    named = sources.select(F.col("source").alias("_name"), "shards")
    dealt = sizes.join(named, F.col("source").eqNullSafe(F.col("_name"))).withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.col("shards")).cast("int"))
    dealt = dealt.select("id", "source", "size", "shard")

    shards = dealt.groupBy("source", "shard").agg(F.sum("size").alias("words")).withColumn(
        "part", F.floor(F.col("shard") / GROUP_SHARDS))
    parts = shards.groupBy("source", "part").agg(F.sum("words").alias("part_words")).join(
        sources.select(F.col("source").alias("_name"), "source_quota"), F.col("source").eqNullSafe(F.col("_name"))
    ).drop("_name")
    parts = apportion(parts, ["source"], "part", "part_words", "source_quota").withColumnRenamed("quota", "part_quota")
    parts = parts.select(F.col("source").alias("_name"), F.col("part").alias("_part"), "part_quota")
    shards = shards.join(
        parts, F.col("source").eqNullSafe(F.col("_name")) & (F.col("part") == F.col("_part"))).drop("_name", "_part")
    shards = apportion(shards, ["source", "part"], "shard", "words", "part_quota")
    shards = stored(shards.join(
        sources.select(F.col("source").alias("_name"), "source_size", "target"),
        F.col("source").eqNullSafe(F.col("_name"))).select(
        F.col("source").alias("_name"), F.col("shard").alias("_shard"), "words", "source_size", "target",
        (F.col("quota") * block_words).alias("quota")), "shards")

    line = W.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 1), F.col("id")), "id", "size")
    placed = dealt.join(
        shards, F.col("source").eqNullSafe(F.col("_name")) & (F.col("shard") == F.col("_shard"))).withColumn(
        "before", F.sum("size").over(line.rowsBetween(W.unboundedPreceding, 0)) - F.col("size"))
    rounds = F.when(F.col("words") > 0, F.floor(F.col("quota") / F.col("words"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("quota") - rounds * F.col("words") - F.col("before")
    part = F.greatest(F.least(rest, F.col("size")), F.lit(0).cast("long"))
    taken = F.least(rounds * F.col("size") + part, F.col("size") * max_epochs)
    return placed.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        taken.cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The mix itself: each document of `docs`, as often as the mix uses it, a part taken counting as a
    whole. Documents of which nothing is taken are absent. Ids should be unique: rows that share an id are all
    used as often as the one used most."""
    other, times, copy = (fresh(docs, n) for n in ("mixed_id", "times", "copy"))
    taken = mix_sources(docs, id_col, **options).where("taken > 0").groupBy(F.col(id_col).alias(other)).agg(
        F.max(F.ceil(F.col("taken") / F.col("size"))).cast("int").alias(times))
    rows = docs.join(taken, F.col(other).eqNullSafe(quoted(id_col)))
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*[quoted(c) for c in docs.columns])
