"""Helpers shared by the corpus operators: scratch tables, words, and running offsets of matches."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_BLOCK = 256


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="llm-scratch-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of bounded rows and bytes for the rest of the session, as whole texts go through them:
    the defaults let each Python worker hold some hundreds of megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, for sessions that run from a source
    folder which executors do not have."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="llm-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(
        os.path.join(folder, "package"), "zip", os.path.dirname(package), os.path.basename(package)))
    _shipped.add(context.applicationId)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back, so that its rows are computed once and
    a lost executor loses no finished work. Cleaning the folder is left to the cluster."""
    path = f"{scratch_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name based on `name` that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def quoted(name: str) -> Column:
    """A column by its exact name, also if it has dots or back quotes."""
    return F.col("`" + name.replace("`", "``") + "`")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once. What a lambda refers to from outside is computed anew for each
    element, unless it is the variable of a lambda itself."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _blocks(values: Column) -> Column:
    """An array in blocks of bounded size, in order; one empty block of an empty array."""
    return let(values, lambda v: F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(F.size(v), F.lit(1)) - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(v, b * _BLOCK + 1, _BLOCK)))


def starts_of(lengths: Column) -> Column:
    """Sums of the elements before each element. Works in blocks, so that long arrays are not copied
    once for each element."""

    def running(values: Column) -> Column:
        empty = F.array().cast("array<long>")
        start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("seen"))
        step = F.aggregate(
            values, start,
            lambda acc, x: F.struct(
                (acc["at"] + x).alias("at"), F.concat(acc["seen"], F.array(acc["at"])).alias("seen")),
        )
        return step["seen"]

    def joined(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda acc, x: acc + x))
        return F.flatten(F.transform(
            F.arrays_zip(blocks.alias("block"), running(sums).alias("base")),
            lambda z: F.transform(running(z["block"]), lambda x: x + z["base"])))

    return let(_blocks(F.transform(lengths, lambda x: x.cast("long"))), joined)


def _pieces(text: Column, pattern: str) -> Column:
    return F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.split(text, pattern, -1).alias("between"))


def _placed(p: Column) -> Column:
    """(start, end, hit) of the hits of a text in pieces."""
    hits = p["hits"]
    gaps = F.transform(F.slice(p["between"], 1, F.size(hits)), lambda x: F.length(x).cast("long"))
    sizes = F.transform(hits, lambda x: F.length(x).cast("long"))
    base = starts_of(F.zip_with(gaps, sizes, lambda g, s: g + s))
    return F.transform(
        F.arrays_zip(hits.alias("hit"), gaps.alias("gap"), sizes.alias("size"), base.alias("base")),
        lambda z: F.struct(
            (z["base"] + z["gap"]).alias("start"), (z["base"] + z["gap"] + z["size"]).alias("end"),
            z["hit"].alias("hit")))


def matches(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches of a pattern that never matches the empty text, as an array
    of (start, end, hit); positions are code points, the end is exclusive."""
    return let(_pieces(text, pattern), _placed)


def in_context(text: Column, pattern: str, width: int) -> Column:
    """`matches` with `ahead`, up to `width` characters before the hit as far as the hit before it, and `next`,
    the character after it ('' at the end). Both come from the pieces between hits, so that a text is walked once
    however many hits it has."""

    def placed(p: Column) -> Column:
        hits, none = p["hits"], F.array(F.lit(""))
        n = F.size(hits)
        fewer = F.greatest(n - 1, F.lit(0))
        before = F.slice(F.concat(none, F.slice(hits, 1, fewer)), 1, n)
        after = F.slice(F.concat(F.slice(hits, 2, fewer), none), 1, n)
        zipped = F.arrays_zip(
            _placed(p).alias("m"), F.slice(p["between"], 1, n).alias("gap"), before.alias("before"),
            F.slice(p["between"], 2, n).alias("rest"), after.alias("after"))
        return F.transform(zipped, lambda z: F.struct(
            z["m"]["start"].alias("start"), z["m"]["end"].alias("end"), z["m"]["hit"].alias("hit"),
            F.right(F.concat(F.right(z["before"], F.lit(width)), F.right(z["gap"], F.lit(width))), F.lit(width)).alias("ahead"),
            F.when(z["rest"] != "", F.left(z["rest"], F.lit(1))).otherwise(F.left(z["after"], F.lit(1))).alias("next")))

    return let(_pieces(text, pattern), placed)


def span_blocks(spans: Column) -> Column:
    """Spans in order of their starts, in blocks of bounded size with the least start and the greatest start and end
    of each: a search looks at few blocks more closely."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    return F.transform(F.filter(_blocks(ordered), lambda b: F.size(b) > 0), lambda b: F.struct(
        F.element_at(b, 1)["start"].alias("low"), F.element_at(b, -1)["start"].alias("last"),
        F.array_max(F.transform(b, lambda s: s["end"])).alias("high"), b.alias("items")))


def overlaps_any(blocks: Column, span: Column) -> Column:
    return F.exists(blocks, lambda b: (b["low"] < span["end"]) & (b["high"] > span["start"]) & F.exists(
        b["items"], lambda c: (c["start"] < span["end"]) & (span["start"] < c["end"])))


def equals_any(blocks: Column, span: Column) -> Column:
    return F.exists(blocks, lambda b: (b["low"] <= span["start"]) & (b["last"] >= span["start"]) & F.exists(
        b["items"], lambda c: (c["start"] == span["start"]) & (c["end"] == span["end"])))


def span_list(spans: Column, order: list) -> Column:
    """`kind:start:end` of an array of spans, comma-joined in the given order of fields."""
    keyed = F.transform(spans, lambda s: F.struct(
        *[s[f].alias(f"k{i}") for i, f in enumerate(order)],
        F.concat_ws(":", s["kind"], s["start"], s["end"]).alias("shown")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: s["shown"]), ",")
