"""Compression of vectors to codes: each vector is cut into parts, and each part is replaced by the number of the
nearest entry of that part's codebook. Codebooks are fitted by rounds of assignment and averaging over all vectors.

All arithmetic is on whole numbers. Distances are taken after a Walsh-Hadamard transform of the zero-padded parts
and entries: it keeps squared distances up to the factor n, the padded length, and gathers most of a difference in
the coefficients of low sequency (few changes of sign). Coefficients are added in that order; an entry is out as
soon as its sum exceeds the full distance of the entry that led after the first one. No entry that is nearest or
ties can be lost, and the distance that remains is divided by n without rest.

Numbers are 64 bits wide where no sum can overflow, else whole numbers of any size. Each task sends one sum per
entry and component, cut into limbs of 40 bits, so that the totals are exact as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.llm.common import quoted, stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
_LIMB = 40
_SALTS = 16


def _padded(width: int) -> int:
    return 1 << max(width - 1, 0).bit_length()


def walsh(rows: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, zero-padded to a power of two, in sequency order."""
    count, width = rows.shape
    n = _padded(width)
    out = np.zeros((count, n), dtype=rows.dtype)
    out[:, :width] = rows
    step = 1
    while step < n:
        pairs = out.reshape(count, n // (2 * step), 2, step)
        low, high = pairs[:, :, 0], pairs[:, :, 1]
        out = np.stack([low + high, low - high], axis=2).reshape(count, n)
        step *= 2
    bits = n.bit_length() - 1
    gray = [s ^ (s >> 1) for s in range(n)]
    return out[:, [int(format(g, f"0{bits}b")[::-1], 2) if bits else 0 for g in gray]]


def _as_wide_as_needed(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as 64-bit numbers if no scaled squared distance between their rows can overflow, else as
    whole numbers of any size."""
    n = _padded(arrays[0].shape[1])
    most = 1 << ((61 - 3 * (n.bit_length() - 1)) // 2)
    small = all(a.size == 0 or (a.max() < most and a.min() > -most) for a in arrays)
    return [a.astype(np.int64 if small else object) for a in arrays]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each part the lowest index of the entries at least squared distance, and that distance."""
    parts, entries = _as_wide_as_needed(parts, entries)
    if not len(parts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    own, code = walsh(parts), walsh(entries)
    n = own.shape[1]
    sums = (own[:, :1] - code[:, 0]) ** 2
    most = ((own - code[sums.argmin(axis=1)]) ** 2).sum(axis=1)  # of the entry that leads after one coefficient
    row, entry = np.nonzero(sums <= most[:, None])
    sums = sums[row, entry]
    for k in range(1, n):
        sums = sums + (own[row, k] - code[entry, k]) ** 2
        left = np.flatnonzero(sums <= most[row])
        row, entry, sums = row[left], entry[left], sums[left]
    least = np.minimum.reduceat(sums, np.searchsorted(row, np.arange(len(parts))))
    hits = np.flatnonzero(sums == least[row])
    _, first = np.unique(row[hits], return_index=True)  # entries of a row stand in ascending order
    return entry[hits[first]], least // n


def _whole(x: float) -> int:
    """floor(SCALE * x); from 2^53 on a double is a whole number, and its product may be too large for one."""
    return int(x) * SCALE if abs(x) >= 2.0**53 else int(np.floor(x * SCALE))


def integers(vectors: pa.Array, width: int) -> np.ndarray:
    """Scaled and floored components of finite vectors as (row, part, component), zero-padded to PARTS * width."""
    lists = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(lists.offsets.to_numpy())
    values = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    if values.size == 0 or np.abs(values).max() < 2.0**50:
        numbers = np.floor(values * SCALE).astype(np.int64)
    else:
        numbers = np.array([_whole(x) for x in values.tolist()], dtype=object)
    out = np.zeros((len(sizes), PARTS * width), dtype=numbers.dtype)
    out[np.arange(PARTS * width) < sizes[:, None]] = numbers
    return out.reshape(len(sizes), PARTS, width)


def _limbs(number: int) -> Iterator[tuple[int, int]]:
    sign, rest, place = (-1 if number < 0 else 1), abs(number), 0
    while rest:
        low = rest & ((1 << _LIMB) - 1)
        if low:
            yield place, sign * low
        rest, place = rest >> _LIMB, place + 1


class Codebooks:
    """Entries of each part, as whole numbers: `entries[part]` is (entry, component)."""

    def __init__(self, entries: list[np.ndarray], width: int):
        self.entries, self.width = entries, width

    def sha256(self) -> str:
        """Of all components in decimal, by part, entry and place, comma-joined."""
        shown = ",".join(str(int(x)) for book in self.entries for x in book.reshape(-1))
        return hashlib.sha256(shown.encode()).hexdigest()

    def assign(self, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each vector its numbers (row, part, component), nearest entries and distances (row, part)."""
        numbers = integers(vectors, self.width)
        found = [nearest(numbers[:, p], self.entries[p]) for p in range(PARTS)]
        return numbers, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

    def improved(self, kept: DataFrame, vec_col: str) -> Codebooks:
        """One round: assign all vectors, then put the floored mean of its parts in place of each entry. What
        comes to the driver has the size of the codebooks."""
        books = self

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = [np.zeros(book.shape, dtype=object) for book in books.entries]
            count = [np.zeros(len(book), dtype=np.int64) for book in books.entries]
            for batch in batches:
                numbers, entry, _ = books.assign(batch.column(0))
                for p in range(PARTS):
                    count[p] += np.bincount(entry[:, p], minlength=len(count[p]))
                    for e in np.unique(entry[:, p]):
                        total[p][e] += numbers[entry[:, p] == e, p].sum(axis=0)
            rows = [(p, e, -1, 0, int(n)) for p in range(PARTS) for e, n in enumerate(count[p]) if n]
            rows += [
                (p, e, k, place, low) for p in range(PARTS) for e, k in np.ndindex(total[p].shape)
                for place, low in _limbs(int(total[p][e, k]))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.int64()) for i in range(5)],
                names=["part", "entry", "place", "limb", "amount"])

        dealt = kept.select(quoted(vec_col).alias("v")).mapInArrow(
            sums, "part bigint, entry bigint, place bigint, limb bigint, amount bigint")
        means = [book.astype(object) for book in self.entries]
        gathered: dict[tuple[int, int], dict[int, int]] = {}
        for r in dealt.groupBy("part", "entry", "place", "limb").agg(F.sum("amount").alias("amount")).collect():
            own = gathered.setdefault((r["part"], r["entry"]), {})
            own[r["place"]] = own.get(r["place"], 0) + (r["amount"] << (_LIMB * r["limb"]))
        for (part, entry), own in gathered.items():
            means[part][entry] = [own.get(k, 0) // own[-1] for k in range(self.width)]
        return Codebooks(means, self.width)


def _finite(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def fit(kept: DataFrame, id_col: str, vec_col: str, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of finite vectors: they start as the parts of the first ENTRIES rows by id (then by vector; null
    ids last) and are improved `rounds` times over all rows."""
    width = -(-(kept.agg(F.max(F.size(quoted(vec_col)))).first()[0] or 0) // PARTS) or 1
    first = kept.select(quoted(id_col).alias("i"), quoted(vec_col).alias("v")).orderBy(
        F.col("i").asc_nulls_last(), "v").limit(ENTRIES).collect()
    start = integers(pa.array([r["v"] for r in first], pa.list_(pa.float64())), width)
    books = Codebooks([start[:, p].astype(object) for p in range(PARTS)], width)
    for _ in range(rounds if first else 0):
        books = books.improved(kept, vec_col)
    return books


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> tuple[DataFrame, Codebooks]:
    """id, label, `code` (two hex digits a part), `error` (squared distance of the whole vector to its code) and
    `label_error` (its sum over equal labels, nulls together), and the codebooks.

    Rows whose vector is null or has a null or non-finite component are dropped; all others stay, repeated rows
    and null ids too. Components count as doubles. Vectors of different lengths, or of a length that is no multiple
    of PARTS, are padded with zeros behind. An error beyond 64 bits is null and counts for nothing in the sums.
    Other columns are not carried along. A table without any finite vector gives no rows.

    Labels are summed before they are joined, by label and a salt of the row, so that no label is one task's work."""
    kept = vectors.select(
        quoted(id_col).alias("i"), quoted(label_col).alias("l"), quoted(vec_col).cast("array<double>").alias("v")
    ).where(_finite(F.col("v")))
    books = fit(kept, "i", "v")

    @F.arrow_udf("struct<code: string, error: bigint>")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            _, entry, far = books.assign(batch)
            error = [int(x) for x in far.sum(axis=1)]
            yield pa.StructArray.from_arrays(
                [pa.array(["".join(f"{e:02x}" for e in row) for row in entry.tolist()], pa.string()),
                 pa.array([x if x < 2**63 else None for x in error], pa.int64())], names=["code", "error"])

    salt = F.pmod(F.xxhash64("i", "code"), F.lit(_SALTS))
    rows = stored(
        kept.withColumn("c", coded("v")).select("i", "l", "c.code", "c.error").withColumn("salt", salt), "codes")
    sums = rows.groupBy("l").agg(
        F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint").alias("label_error"))
    spread = sums.select(
        F.col("l").alias("l2"), "label_error",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long"))).alias("salt2"))
    joined = rows.join(spread, F.col("l").eqNullSafe(F.col("l2")) & (F.col("salt") == F.col("salt2")), "left")
    return joined.select(
        F.col("i").alias(id_col), F.col("l").alias(label_col), "code", "error", "label_error"), books
