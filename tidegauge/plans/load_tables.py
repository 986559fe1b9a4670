"""Load raw and derived files into the Spark catalog or a database, and compare the row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegauge.schemas import DERIVED_TABLES, PRIMARY_KEYS, RAW_TABLES
from tidegauge.sources.files import LAYOUTS, chosen_tables, read_table, require_paths, table_path
from tidegauge.sources.tables import (
    DEFAULT_BATCH,
    ROWS,
    analyze_table,
    append_new_rows,
    counted,
    jdbc_count_options,
    loaded_rows,
    qualified,
    save_catalog_table,
    save_jdbc_table,
    write_mode,
)


def load_tables(
    spark: SparkSession,
    raw_dir: str = "data",
    derived_dir: str = "data/derived",
    *,
    include_raw: bool = False,
    include_derived: bool = False,
    file_format: str = "csv",
    if_exists: str = "replace",
    schema: str | None = None,
    jdbc_url: str | None = None,
    jdbc_properties: dict[str, str] | None = None,
    chunksize: int = DEFAULT_BATCH,
    analyze: bool = False,
    repeatable: bool = False,
) -> DataFrame:
    """Load the chosen tables; neither switch means raw and derived. Returns the row counts of the
    files, counted while they are written, and of the loaded tables, counted where they are. Statistics
    are gathered for catalog tables only. With `repeatable`, an append to a raw catalog table adds only rows whose
    key it does not have."""
    write_mode(if_exists)
    names = chosen_tables(include_raw, include_derived)
    folders = {**dict.fromkeys(RAW_TABLES, raw_dir), **dict.fromkeys(DERIVED_TABLES, derived_dir)}
    paths = {n: table_path(folders[n], n, file_format) for n in names}
    require_paths(spark, paths, file_format)

    written, loaded = {}, {}
    for name in names:
        rows = read_table(spark, paths[name], file_format, LAYOUTS[name], lenient_dates=True)
        if jdbc_url is None and repeatable and if_exists == "append" and name in PRIMARY_KEYS:
            written[name] = append_new_rows(rows, name, PRIMARY_KEYS[name], schema=schema)
            loaded[name] = spark.table(qualified(name, schema)).agg(F.count(F.lit(1)).alias(ROWS))
            continue
        df, seen = counted(rows)
        if jdbc_url is None:
            save_catalog_table(df, name, schema=schema, if_exists=if_exists)
            if analyze:
                analyze_table(spark, name, schema)
            loaded[name] = spark.table(qualified(name, schema)).agg(F.count(F.lit(1)).alias(ROWS))
        else:
            target = dict(url=jdbc_url, table=name, schema=schema, **(jdbc_properties or {}))
            save_jdbc_table(df, if_exists=if_exists, chunksize=chunksize, **target)
            loaded[name] = spark.read.format("jdbc").options(**jdbc_count_options(**target)).load()
        written[name] = seen.get[ROWS]
    return loaded_rows(spark, written, loaded)
