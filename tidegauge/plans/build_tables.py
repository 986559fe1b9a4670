"""The derived tables together, as lazy frames and as a batch job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidegauge.functions.checks import validate_minimum_columns
from tidegauge.operators.fact import (
    FACT_COLUMNS,
    busy_spans,
    fact_of_spans,
    last_fact_day,
    spans_by_month,
)
from tidegauge.operators.funnel import build_agg_funnel_daily
from tidegauge.operators.kpis import agg_daily_kpis_of_days
from tidegauge.operators.prepare import group_keys, pick_columns
from tidegauge.operators.retention import build_agg_retention_cohort
from tidegauge.operators.sparse import agg_lifecycle_of_days, daily_sums
from tidegauge.session import has_checkpoint_dir, materialize
from tidegauge.sources.files import (
    PARTITIONED,
    checked_format,
    read_raw_tables,
    table_path,
    write_table,
    write_tables,
)

DEFAULT_RETENTION_DAYS = (1, 7, 30)
DEFAULT_GROUP_COLS = ("variant",)


def _aggregates(
    spans, users, events, sessions, *, active_event_names, retention_days, group_cols, date_min, date_max
):
    """The four aggregates, from busy days and spans of states or from the raw tables. None of them
    builds the users-by-days table."""
    keys = group_keys(group_cols)
    return {
        "agg_daily_kpis": agg_daily_kpis_of_days(
            daily_sums(spans, keys), users, events, group_cols=keys, active_event_names=active_event_names
        ),
        "agg_retention_cohort": build_agg_retention_cohort(
            users, events, n_days=retention_days, active_event_names=active_event_names,
            by_variant="variant" in keys,
        ),
        "agg_funnel_daily": build_agg_funnel_daily(events, group_cols=keys),
        "agg_lifecycle_daily": agg_lifecycle_of_days(
            users, events, group_cols=keys, active_event_names=active_event_names, date_min=date_min,
            date_max=last_fact_day(users, events, sessions, date_min, date_max),
        ),
    }


def build_dashboard_tables(
    users: DataFrame,
    events: DataFrame,
    sessions: DataFrame,
    *,
    active_event_names: Sequence[str] | None = None,
    retention_days: int | Sequence[int] = DEFAULT_RETENTION_DAYS,
    group_cols: Sequence[str] | None = DEFAULT_GROUP_COLS,
    date_min: str | None = None,
    date_max: str | None = None,
    materialize_fact: bool = False,
) -> dict[str, DataFrame]:
    """The five tables by name. They are lazy; two of them come from the busy days of the users. With
    `materialize_fact` these are computed once into the checkpoint folder of the cluster, else once per
    table. Keys that are user attributes are kept beside them, so that no join on the fact is needed."""
    keys = group_keys(group_cols)
    kept = [k for k in keys if k not in FACT_COLUMNS]
    spans = busy_spans(
        users, events, sessions, active_event_names=active_event_names, date_min=date_min,
        date_max=date_max, keep_user_cols=kept,
    )
    if materialize_fact:
        spans = materialize(spans)
    aggregates = _aggregates(
        spans, users, events, sessions, active_event_names=active_event_names,
        retention_days=retention_days, group_cols=keys, date_min=date_min, date_max=date_max,
    )
    return {"fact_user_daily": pick_columns(fact_of_spans(spans), FACT_COLUMNS), **aggregates}


def build_all_derived_tables(
    users: DataFrame,
    sessions: DataFrame,
    events: DataFrame,
    *,
    retention_days: Sequence[int] = DEFAULT_RETENTION_DAYS,
    group_cols: Sequence[str] = DEFAULT_GROUP_COLS,
    date_min: str | None = None,
    date_max: str | None = None,
) -> dict[str, DataFrame]:
    return build_dashboard_tables(
        users, events, sessions, retention_days=retention_days, group_cols=group_cols,
        date_min=date_min, date_max=date_max,
    )


def run_build(
    spark: SparkSession,
    data_dir: str,
    out_dir: str,
    *,
    retention_days: Sequence[int] = DEFAULT_RETENTION_DAYS,
    group_cols: Sequence[str] = DEFAULT_GROUP_COLS,
    date_min: str | None = None,
    date_max: str | None = None,
    file_format: str = "csv",
    raw_format: str = "csv",
) -> dict[str, str]:
    """Read the raw tables, check them, and write the five derived tables; returns their paths.

    The busy days are kept in the checkpoint folder if the cluster names one, so that a lost executor
    costs no more than the tasks it ran. The fact is filled from them month by month as it is written;
    its dense rows are ordered within their tasks but not shuffled.
    """
    name = checked_format(file_format)
    users, sessions, events, _ = read_raw_tables(spark, data_dir, raw_format)
    validate_minimum_columns(users, sessions, events)
    keys = group_keys(group_cols)
    spans = busy_spans(
        users, events, sessions, date_min=date_min, date_max=date_max,
        keep_user_cols=[k for k in keys if k not in FACT_COLUMNS],
    )
    if has_checkpoint_dir(spark):
        spans = materialize(spans)
    fact = fact_of_spans(spans_by_month(spans))
    split = PARTITIONED["fact_user_daily"]
    write_table(fact, table_path(out_dir, "fact_user_daily", name), name, partition_by=split, balanced=True)
    aggregates = _aggregates(
        spans, users, events, sessions, active_event_names=None, retention_days=retention_days,
        group_cols=keys, date_min=date_min, date_max=date_max,
    )
    write_tables(aggregates, out_dir, file_format=name)
    return {
        table: table_path(out_dir, table, name) for table in ["fact_user_daily", *aggregates]
    }
