"""Bucketed tables, repeatable appends and rejected values."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import table
from tidegauge.plans.load_tables import load_tables
from tidegauge.sources import files, tables


@pytest.fixture()
def without_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_tables_join_and_group_without_a_shuffle(spark, without_broadcast, tmp_path):
    rows = spark.range(1000).select((F.col("id") % 50).alias("user_id"), F.col("id").alias("v"))
    for name in ("left_b", "right_b"):
        tables.save_catalog_table(rows, name, bucket_by="user_id", buckets=4, path=str(tmp_path / name))
    left, right = spark.table("left_b"), spark.table("right_b").groupBy("user_id").agg(F.sum("v").alias("total"))
    joined = left.join(right, "user_id")
    assert "Exchange" not in joined._jdf.queryExecution().toString()
    assert joined.count() == 1000
    with pytest.raises(ValueError):
        tables.save_catalog_table(rows, "left_b", bucket_by="user_id")


def test_a_repeated_append_adds_nothing(spark, tmp_path):
    first = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k bigint, v string")
    second = spark.createDataFrame([(2, "other"), (3, "c"), (3, "c"), (None, "m")], "k bigint, v string")
    for df in (first, first, second, second):
        tables.append_new_rows(df, "appended", "k")
    assert table(spark.table("appended")) == {(1, "a"), (2, "b"), (3, "c"), (None, "n")}
    assert spark.table("appended").count() == 4


def test_a_repeated_load_adds_nothing(spark, tmp_path):
    (tmp_path / "users.csv").write_text("user_id,signup_date\n1,2025-01-01\n2,2025-01-02\n")
    for name, columns in (("sessions", "session_id,user_id"), ("events", "event_id,user_id"), ("lessons", "lesson_id,skill")):
        (tmp_path / f"{name}.csv").write_text(f"{columns}\n")
    spark.sql("CREATE DATABASE IF NOT EXISTS again")
    for _ in range(2):
        load_tables(spark, str(tmp_path), include_raw=True, if_exists="append", schema="again", repeatable=True)
    assert table(spark.table("again.users"), "user_id") == {(1,), (2,)} and spark.table("again.users").count() == 2


def test_every_row_is_loaded_or_rejected_with_a_reason(spark, tmp_path):
    lines = ["lesson_id,unit_id,skill,difficulty,extra", "L1,U1,read,3.0,x", "L2,U1,read,hard,", ",U2,read,4,y", "L4,,,,", "L5,U1,read,  ,z"]
    (tmp_path / "lessons.csv").write_text("\n".join(lines) + "\n")
    paths = files.load_checked(spark, str(tmp_path / "lessons.csv"), "lessons", str(tmp_path / "out"))
    loaded, rejects = (spark.read.parquet(paths[n]) for n in ("loaded", "rejects"))
    assert table(loaded, "lesson_id", "difficulty", "extra") == {("L1", 3, "x"), ("L2", None, None), ("L4", None, None), ("L5", None, "z")}
    assert table(rejects, "table", "key", "column", "raw", "reason", "row_dropped") == {
        ("lessons", "L2", "difficulty", "hard", "not a int", False), ("lessons", None, "lesson_id", None, "missing", True)}
    assert loaded.count() + rejects.where("row_dropped").select("key").count() == len(lines) - 1
