import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidegauge.session import spark_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = spark_session(
        "tests", master="local[8]", spark_sql_shuffle_partitions="4", spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false", spark_sql_warehouse_dir=str(base / "warehouse"),
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(base / "checkpoints"))
    yield session
    session.stop()


def day(text):
    return dt.date.fromisoformat(text)


def moment(text):
    return dt.datetime.fromisoformat(text)


class Frames:
    """Small frames in the native layout."""

    def __init__(self, spark):
        self.spark = spark

    def users(self, *rows):
        """(user_id, signup_date, variant[, is_premium_at_signup])"""
        rows = [(u, day(d) if d else None, v, (rest or [False])[0]) for u, d, v, *rest in rows]
        return self.spark.createDataFrame(
            rows, "user_id bigint, signup_date date, variant string, is_premium_at_signup boolean"
        )

    def events(self, *rows):
        """(user_id, time or date, event_name, variant)"""
        rows = [
            (f"e{i:04d}", u, moment(t), moment(t).date(), n, v) for i, (u, t, n, v) in enumerate(rows)
        ]
        return self.spark.createDataFrame(
            rows, "event_id string, user_id bigint, event_time timestamp_ntz, event_date date, "
            "event_name string, variant string"
        )

    def full_events(self, *rows):
        """(event_id, user_id, time, name, xp, hearts, streak, premium, variant)"""
        rows = [(i, u, moment(t), moment(t).date(), n, x, h, s, p, v) for i, u, t, n, x, h, s, p, v in rows]
        return self.spark.createDataFrame(
            rows, "event_id string, user_id bigint, event_time timestamp_ntz, event_date date, "
            "event_name string, xp_delta int, hearts_delta int, streak_length int, is_premium boolean, "
            "variant string"
        )

    def sessions(self, *rows):
        """(session_id, user_id, start, end)"""
        rows = [
            (s, u, moment(a), moment(b), int((moment(b) - moment(a)).total_seconds())) for s, u, a, b in rows
        ]
        return self.spark.createDataFrame(
            rows, "session_id string, user_id bigint, session_start timestamp_ntz, "
            "session_end timestamp_ntz, session_duration_sec int"
        )


@pytest.fixture(scope="session")
def frames(spark):
    return Frames(spark)


def table(df, *columns):
    """Rows of a frame as a set of tuples, for the named columns."""
    return {tuple(r) for r in (df.select(*columns) if columns else df).collect()}
