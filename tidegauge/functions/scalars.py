"""Column expressions shared by the operators. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidegauge.schemas import LIFECYCLE_STATES


def strict_date(column: Column, name: str) -> Column:
    """Calendar day of a date, timestamp or ISO text; a null or unreadable value fails the job."""
    shown = F.coalesce(column.cast("string"), F.lit("NULL"))
    failure = F.raise_error(F.concat(F.lit(f"Not a calendar day in {name}: "), shown))
    return F.coalesce(column.try_cast("date"), failure.cast("date"))


def lenient_date(column: Column) -> Column:
    return column.try_cast("date")


def lenient_timestamp(column: Column) -> Column:
    return column.try_cast("timestamp_ntz")


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Ratio as double, 0.0 where either side is null or the denominator is zero."""
    return F.coalesce(divide_or_null(numerator, denominator), F.lit(0.0))


def divide_or_null(numerator: Column, denominator: Column) -> Column:
    """Ratio as double, null instead of infinite."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def lift(treatment: Column, control: Column) -> Column:
    """Relative difference treatment / control - 1, null unless control is positive."""
    return F.when(control > 0, divide_or_null(treatment, control) - 1)


def symmetric_gap(treatment: Column, control: Column) -> Column:
    """Difference relative to the mean of the two sides."""
    return F.try_divide(treatment - control, F.lit(0.5) * (treatment + control))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, rounded half to even."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return F.bround(micros / F.lit(1_000_000.0), 0).cast("bigint")


def clip_at_zero(column: Column) -> Column:
    return F.greatest(column, F.lit(0))


def is_one_of(column: Column, names) -> Column:
    """Membership flag that is false, not null, for a null value."""
    return F.coalesce(column.isin(list(names)), F.lit(False))


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def text_or_empty(column: Column) -> Column:
    """Null text as the empty string, so that it joins and compares."""
    return F.coalesce(column.cast("string"), F.lit(""))


def blank_to_null(column: Column) -> Column:
    """Empty or blank text counts as absent."""
    return F.nullif(F.trim(column.cast("string")), F.lit(""))


def percent_text(column: Column) -> Column:
    return F.format_string("%.2f%%", column * 100)


def state_label(column: Column) -> Column:
    """Display name of a lifecycle state; unknown states become null."""
    pairs = [F.lit(text) for pair in LIFECYCLE_STATES.items() for text in pair]
    return F.try_element_at(F.create_map(*pairs), column)
