"""Builds of ranges of days against one build over all of them."""

import datetime as dt
import os

import pytest

from tests.conftest import day, table
from tidegauge.plans import rebuild
from tidegauge.plans.build_tables import build_dashboard_tables
from tidegauge.sources import files


def _raw(frames, spark, folder, extra=()):
    users = frames.users((1, "2025-01-01", "control", True), (2, "2025-01-01", "treatment"), (3, "2025-01-20", "control"),
                         (4, "2025-01-05", "treatment"))
    rows = [
        ("2025-01-01T08:00", 1, "app_open"), ("2025-01-02T08:00", 1, "lesson_completed"), ("2025-01-02T09:00", 2, "app_open"),
        ("2025-01-09T10:00", 2, "lesson_started"), ("2025-01-31T08:00", 1, "app_open"), ("2025-02-01T08:00", 1, "app_open"),
        ("2025-02-20T08:00", 3, "lesson_completed"), ("2025-03-03T08:00", 2, "app_open"), ("2025-01-03T08:00", 9, "app_open"),
        *extra]
    arm = {1: "control", 2: "treatment", 3: "control", 4: "treatment", 9: "control"}
    events = frames.full_events(*[
        (f"e{i:03d}", u, t, n, 5, -1, i, i % 2 == 0, arm[u]) for i, (t, u, n) in enumerate(rows)])
    sessions = frames.sessions(("s1", 1, "2025-01-01T08:00", "2025-01-01T08:10"), ("s2", 2, "2025-02-10T08:00", "2025-02-10T08:05"))
    lessons = spark.createDataFrame([("L1",)], "lesson_id string")
    for name, df in (("users", users), ("events", events), ("sessions", sessions), ("lessons", lessons)):
        files.write_raw_table(df, files.table_path(folder, name, "parquet"), name)
    return users, events, sessions


RANGES = [(None, "2025-01-08"), ("2025-01-09", "2025-02-06"), ("2025-02-07", None)]


@pytest.fixture(scope="module")
def built(spark, frames, tmp_path_factory):
    raw, out = (str(tmp_path_factory.mktemp(n)) for n in ("raw", "out"))
    inputs = _raw(frames, spark, raw)
    for first, last in RANGES:
        rebuild.rebuild_days(spark, raw, out, date_min=first, date_max=last)
    return raw, out, inputs


def _stored(spark, out, name):
    return files.read_table(spark, files.table_path(out, name, "parquet"), "parquet")


@pytest.mark.parametrize("name", list(rebuild.SPLIT))
def test_ranges_equal_the_whole(spark, built, name):
    _, out, (users, events, sessions) = built
    whole = build_dashboard_tables(users, events, sessions)[name]
    got = _stored(spark, out, name)
    assert set(got.columns) == set(whole.columns)
    assert table(got.select(*whole.columns)) == table(whole) and got.count() == whole.count()


def test_state_carries_last_days_and_totals(spark, built):
    state = _stored(spark, built[1], rebuild.STATE)
    ends = {r[0] for r in state.select("as_of").distinct().collect()}
    assert ends == {day("2025-01-08"), day("2025-02-06"), day("2025-03-03")}
    rows = {(r["as_of"], r["user_id"]): r for r in state.collect()}
    assert rows[day("2025-01-08"), 2]["last_active"] == day("2025-01-02")
    last = rows[day("2025-03-03"), 1]
    assert (last["last_active"], last["active_days"], last["sessions_count"], last["xp_earned"]) == (day("2025-02-01"), 4, 1, 20)
    assert (last["last_premium_day"], last["last_premium"]) == (day("2025-02-01"), False)
    assert rows[day("2025-03-03"), 4]["last_active"] is None and (day("2025-01-08"), 3) not in rows
    assert {r["horizon"] for k, r in rows.items() if k[0] == day("2025-02-06")} == {day("2025-02-01")}


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_other_days_keep_their_files_and_a_rerun_changes_nothing(spark, built):
    raw, out, _ = built
    path = files.table_path(out, "fact_user_daily", "parquet")
    before, rows = _files(path), table(_stored(spark, out, "fact_user_daily"))
    rebuild.rebuild_days(spark, raw, out, date_min="2025-01-09", date_max="2025-02-06", tables=["fact_user_daily"])
    after = _files(path)
    inside = {f for f in before if "2025-01-09" <= f.split("date=")[1][:10] <= "2025-02-06"}
    assert inside and inside.isdisjoint(after)
    assert {f: t for f, t in after.items() if f in before} == {f: t for f, t in before.items() if f not in inside}
    assert table(_stored(spark, out, "fact_user_daily")) == rows


def test_a_range_needs_the_state_before_it(spark, built, tmp_path):
    raw, out, _ = built
    with pytest.raises(ValueError, match="2025-01-15.*2025-01-08"):
        rebuild.rebuild_days(spark, raw, out, date_min="2025-01-16")
    with pytest.raises(FileNotFoundError):
        rebuild.rebuild_days(spark, raw, str(tmp_path), date_min="2025-01-16")
    with pytest.raises(ValueError, match="unknown tables"):
        rebuild.rebuild_days(spark, raw, out, tables=["nothing"])


def test_later_activity_reaches_the_days_it_is_in(spark, frames, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    _raw(frames, spark, raw)
    for first, last in ((None, "2025-02-05"), ("2025-02-06", None)):
        rebuild.rebuild_days(spark, raw, out, date_min=first, date_max=last, tables=["fact_user_daily"])
    users, events, sessions = _raw(frames, spark, raw, extra=[("2025-02-06T12:00", 4, "app_open")])
    rebuild.rebuild_days(spark, raw, out, date_min="2025-02-06", tables=["fact_user_daily"])
    whole = build_dashboard_tables(users, events, sessions)["fact_user_daily"]
    assert table(_stored(spark, out, "fact_user_daily").select(*whole.columns)) == table(whole)


def test_text_ranges(spark, frames, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    users, events, sessions = _raw(frames, spark, raw)
    for first, last in RANGES[:2]:
        paths = rebuild.rebuild_days(
            spark, raw, out, date_min=first, date_max=last, file_format="csv", tables=["fact_user_daily"])
    got = files.read_table(spark, paths["fact_user_daily"], "csv", files.LAYOUTS["fact_user_daily"])
    whole = build_dashboard_tables(users, events, sessions, date_max="2025-02-06")["fact_user_daily"]
    assert table(got.select(*whole.columns)) == table(whole)


def test_partition_filters_reach_the_raw_events(spark, built, capsys):
    from tidegauge.operators.fact import busy_spans

    users, sessions, events, _ = files.read_raw_tables(spark, built[0], "parquet")
    busy_spans(users, events, sessions, date_min=dt.date(2025, 2, 6), date_max=dt.date(2025, 2, 6)).explain()
    shown = capsys.readouterr().out
    assert "PartitionFilters: [(isnull(event_date" in shown or "event_date#" in shown.split("PartitionFilters: [")[1][:200]
