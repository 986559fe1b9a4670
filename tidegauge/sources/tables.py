"""Tables in the Spark catalog or in a relational database over JDBC."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tidegauge.schemas import LAYOUTS_BY_GROUP
from tidegauge.session import scratch_folder

DEFAULT_BATCH = 50_000
ROWS = "row_total"
WRITE_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


def write_mode(if_exists: str) -> str:
    if if_exists not in WRITE_MODES:
        raise ValueError(f"if_exists must be one of {sorted(WRITE_MODES)}")
    return WRITE_MODES[if_exists]


def qualified(table: str, schema: str | None = None) -> str:
    return table if schema is None else f"{schema}.{table}"


def create_tables(spark: SparkSession, schema: str | None = None, group: str = "raw") -> None:
    """Replace the typed, empty catalog tables of a group. Spark does not enforce keys; the
    quality report checks them."""
    for name, layout in LAYOUTS_BY_GROUP[group].items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in layout)
        spark.sql(f"DROP TABLE IF EXISTS {qualified(name, schema)}")
        spark.sql(f"CREATE TABLE {qualified(name, schema)} ({columns}) USING parquet")


def save_catalog_table(
    df: DataFrame, table: str, *, schema: str | None = None, if_exists: str = "replace",
    bucket_by: str | None = None, buckets: int = 0, path: str | None = None,
) -> None:
    """Save a table. With `bucket_by`, its rows are dealt out by that column once, here: tables with as many buckets
    of the same key are joined and grouped by it without a shuffle. Rows are dealt before the write, so that each bucket
    is one sorted file."""
    writer = df.write
    if bucket_by is not None:
        if buckets <= 0:
            raise ValueError("bucket_by needs a number of buckets")
        writer = df.repartition(buckets, bucket_by).write.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.mode(write_mode(if_exists)).format("parquet").saveAsTable(qualified(table, schema))


def append_new_rows(df: DataFrame, table: str, key: str, *, schema: str | None = None) -> int:
    """Append the rows whose key the table does not have, so that a load that is repeated adds nothing. Of rows
    with one key, and of those without any, one is kept. The rows are staged first, so that a retry sees the same
    ones; returns how many there were."""
    spark = df.sparkSession
    name = qualified(table, schema)
    stage = f"{scratch_folder(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(stage)
    staged = spark.read.schema(df.schema).parquet(stage)
    once = staged.dropDuplicates([key])
    if not spark.catalog.tableExists(name):
        save_catalog_table(once, table, schema=schema, if_exists="fail")
        return staged.count()
    known = spark.table(name).select(F.col(key).alias("known_key"))
    new = once.join(known, F.col(key).eqNullSafe(F.col("known_key")), "left_anti")
    save_catalog_table(new, table, schema=schema, if_exists="append")
    return staged.count()


def jdbc_options(
    url: str, table: str, *, schema: str | None = None, chunksize: int = DEFAULT_BATCH,
    connections: int = 8, **properties: str,
) -> dict[str, str]:
    """Options of a JDBC write: rows per batch, and a bound on the connections the executors open."""
    return {
        "url": url,
        "dbtable": qualified(table, schema),
        "batchsize": str(chunksize),
        "numPartitions": str(connections),
        **{k: str(v) for k, v in properties.items()},
    }


def jdbc_count_options(
    url: str, table: str, *, schema: str | None = None, chunksize: int = 0, connections: int = 0, **properties: str,
) -> dict[str, str]:
    """Options of a read that lets the database count the rows."""
    query = f"SELECT count(*) AS {ROWS} FROM {qualified(table, schema)}"
    return {"url": url, "query": query, **{k: str(v) for k, v in properties.items()}}


def save_jdbc_table(df: DataFrame, *, if_exists: str = "replace", **options) -> None:
    """Insert a table. Only the insert runs with the bounded number of connections: the rows are
    rebalanced before it, so that what comes before keeps its own parallelism."""
    df.hint("rebalance").write.format("jdbc").options(**jdbc_options(**options)).mode(write_mode(if_exists)).save()


def analyze_table(spark: SparkSession, table: str, schema: str | None = None) -> None:
    """Gather statistics of a catalog table, which the optimizer sizes its joins by."""
    spark.sql(f"ANALYZE TABLE {qualified(table, schema)} COMPUTE STATISTICS")


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame and its number of rows, known once it has been written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias(ROWS)), seen


def loaded_rows(spark: SparkSession, written: Mapping[str, int], loaded: Mapping[str, DataFrame]) -> DataFrame:
    """table, source_rows, loaded_rows, matches. `loaded` has a one-row count per table."""
    before = spark.createDataFrame(list(written.items()), "table string, source_rows bigint")
    after = reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("table"), F.col(ROWS).cast("bigint").alias("loaded_rows"))
        for name, df in loaded.items()
    ])
    return before.join(after, "table", "full").withColumn(
        "matches", F.col("source_rows").eqNullSafe(F.col("loaded_rows"))
    )
