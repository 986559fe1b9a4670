"""Importance resampling towards a target: documents whose words are frequent in a target corpus and rare in their
own are drawn more often.

Features are runs of words, hashed into buckets. A bucket's gain is the logarithm of how much more frequent it is in
the target, a document's weight the mean gain of its features, and Gumbel noise from a hash of the id turns
the highest sums into a weighted draw without replacement that every rerun repeats.

Words and features are made by Arrow kernels: texts are lowered and split, the lists flattened and the words
dictionary-encoded; runs of n words are pairs of a run of n - 1 and the next word, numbered by their distinct pairs,
so that each distinct run in a batch is hashed once (a checksum goes on from that of the shorter run). Gains are
taken by bucket and reduced by document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidegauge.llm.common import fresh, quoted, small_batches, stored

BUCKETS, LONGEST_RUN, MIN_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024
#: Fixed value: what stands between words, once A-Z are lowered.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BLOCK = 256  # scores that are ranked together


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Of every word its text and its place in the dictionary, and the dictionary."""
    lowered = pc.ascii_lower(pc.fill_null(texts, ""))
    lists = pc.split_pattern_regex(lowered, pattern=_BETWEEN)
    words, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(words), 0)
    coded = pc.dictionary_encode(pc.filter(words, full))
    return (
        pc.filter(owner, full).to_numpy(zero_copy_only=False).astype(np.int64),
        coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
        [w.encode() for w in coded.dictionary.to_pylist()])


def features(texts: pa.Array, buckets: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2, ... words: the text (ascending) and the bucket of each run."""
    owner, index, words = _words(texts)
    run = index
    sums = np.array([zlib.crc32(w) for w in words], dtype=np.int64)
    yield owner, sums[run] % buckets
    for n in range(2, longest + 1):
        inside = owner[n - 1 :] == owner[: len(owner) - n + 1]
        pairs, run = np.unique(
            run[: len(inside)][inside] * max(len(words), 1) + index[n - 1 :][inside], return_inverse=True)
        shorter, word = np.divmod(pairs, max(len(words), 1))
        sums = np.array(
            [zlib.crc32(words[w], zlib.crc32(b" ", int(sums[s]))) for s, w in zip(shorter.tolist(), word.tolist())],
            dtype=np.int64)
        yield owner[n - 1 :][inside], sums[run] % buckets
        # Runs are numbered at the place of their first word; places without a run of n words end with this round.
        place = np.zeros(len(owner), dtype=np.int64)
        place[: len(inside)][inside] = run
        run = place


def bucket_counts(docs: DataFrame, text_col: str, buckets: int, longest: int) -> np.ndarray:
    """Features by bucket. Each task sends its sums, the driver gets one number a bucket."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, bucket in features(batch.column(0), buckets, longest):
                seen += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(seen[used], pa.int64())], names=["b", "n"])

    small_batches(docs.sparkSession)
    sums = docs.select(quoted(text_col).cast("string")).mapInArrow(counted, "b bigint, n bigint")
    out = np.zeros(buckets, dtype=np.int64)
    for r in sums.groupBy("b").agg(F.sum("n").alias("n")).collect():
        out[r["b"]] = r["n"]
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of the ratio of smoothed shares, floored."""
    s, t, k = own.astype(np.float64), target.astype(np.float64), len(own)
    ratio = (t + 1) * (s.sum() + k) / ((s + 1) * (t.sum() + k))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(
    docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text", *,
    buckets: int = BUCKETS, longest: int = LONGEST_RUN,
) -> DataFrame:
    """The documents with `n_words`, `n_features` and `weight`, the floored mean gain of their features (0
    without any). Both tables are counted whole; null texts have no words. No row is added or removed. Columns that
    have one of the three names already are replaced."""
    gain = gains(bucket_counts(docs, text_col, buckets, longest), bucket_counts(target, target_col, buckets, longest))

    @F.arrow_udf("struct<n_words: bigint, n_features: bigint, weight: bigint>")
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        by_bucket = pa.array(gain)
        for batch in batches:
            total, count, n_words = (np.zeros(len(batch), dtype=np.int64) for _ in range(3))
            for n, (owner, bucket) in enumerate(features(batch, buckets, longest)):
                if not len(owner):
                    continue
                taken = pc.take(by_bucket, pa.array(bucket)).to_numpy()
                starts = np.flatnonzero(np.diff(owner, prepend=-1))
                total[owner[starts]] += np.add.reduceat(taken, starts)
                count += (sizes := np.bincount(owner, minlength=len(batch)))
                n_words = sizes if n == 0 else n_words
            mean = np.where(count > 0, total // np.maximum(count, 1), 0)
            yield pa.StructArray.from_arrays(
                [pa.array(x, pa.int64()) for x in (n_words, count, mean)], names=["n_words", "n_features", "weight"])

    small_batches(docs.sparkSession)
    made = ("n_words", "n_features", "weight")
    at = fresh(docs, "measured")
    out = docs.withColumn(at, measured(quoted(text_col).cast("string")))
    kept = [quoted(c) for c in docs.columns if c.lower() not in made]
    return out.select(*kept, *[F.col(at)[c].alias(c) for c in made])


def noise(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, floored, from a hash of the seed and the key; null keys count as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def draw(
    scored: DataFrame, id_col: str = "doc_id", *, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """The rows of `weighted` with `score` (weight and noise) and `rank`: of the N rows with `min_words` words, the
    floor(percent * N / 100) highest scores are drawn, ties to the smaller id (null ids last); other rows have no
    rank. Equal ids have equal noise. Columns that have one of the two names already are replaced.

    Ranks come from counts of scores: rows above a score's block of scores, above the score in its block, and then
    in order of ids within the score. Only rows that can be drawn are shuffled, and none of the windows sees more
    than the rows of one score, or the blocks."""
    names = [c for c in scored.columns if c.lower() not in ("score", "rank")]
    rows = stored(scored.select(*[quoted(c) for c in names], (
        F.col("weight") + noise(quoted(id_col), seed)).alias("score")), "scored")
    fit_rows = F.col("n_words") >= min_words
    counts = rows.where(fit_rows).groupBy("score").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "block", F.floor(F.col("score") / _BLOCK))
    blocks = counts.groupBy("block").agg(F.sum("n").alias("n"))
    higher = W.orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy("block").orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    before = blocks.select("block", F.coalesce(F.sum("n").over(higher), zero).alias("before"), F.sum("n").over(
        W.partitionBy()).alias("all"))
    drawn = F.floor(F.col("all") * percent / 100)
    above = counts.join(before, "block").select(
        F.col("score").alias("s"), (F.col("before") + F.coalesce(F.sum("n").over(inside), zero)).alias("above"),
        drawn.alias("drawn")).where(F.col("above") < F.col("drawn"))
    least = above.agg(F.min("s")).first()[0]
    near = fit_rows & (F.col("score") >= F.lit(least).cast("long"))
    order = W.partitionBy("score").orderBy(quoted(id_col).asc_nulls_last(), "weight", "n_features")
    place = F.col("above") + F.row_number().over(order)
    ranked = rows.where(near).join(above, F.col("score") == F.col("s")).withColumn(
        "rank", F.when(place <= F.col("drawn"), place))
    others = rows.where(~F.coalesce(near, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*[quoted(c) for c in names], "score", "rank").unionByName(others)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The drawn documents in full, with their weight, score and rank."""
    return draw(weighted(docs, target, text_col), id_col).where(F.col("rank").isNotNull())
