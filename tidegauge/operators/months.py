"""A user-by-day table folded into one row per user and month.

The days of a month are bits of a number, so that a month is folded by a hash aggregation with partial sums, and what
must be known from the months before is carried along those few rows. Rows of single days are counted, or written out
again, inside the task that has the month; none of them is shuffled or ordered. A user and day occur once in the table,
as in every fact table of this package; rows without a date fail.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidegauge.functions.checks import require_columns
from tidegauge.functions.scalars import strict_date
from tidegauge.operators.lifecycle import STATES, state_of_day, transition_shares

_CODE_BITS, _FIRST_DAYS = 3, 16  # a state takes three bits; sixteen days fit into the first number


def fold_months(fact_user_daily: DataFrame) -> DataFrame:
    """user_id, month, signup_date, days, active, quiet and, if the table has states, early and late.

    `days`, `active` and `quiet` have one bit for each day with a row, with activity, and with none; a null `is_active`
    is neither of the last two. `early` and `late` hold the numbers of the states, three bits a day, 0 for none.
    """
    require_columns(fact_user_daily, ["date", "user_id", "is_active"], "fact_user_daily")
    date = strict_date(F.col("date"), "date")
    place = F.dayofmonth("_date") - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    on = F.col("is_active").cast("boolean")
    folded = {
        "days": bit, "active": F.when(on, bit), "quiet": F.when(~on, bit),
    }
    if "lifecycle_state" in fact_user_daily.columns:
        names = F.array(*[F.lit(s) for s in STATES])
        code = F.coalesce(F.array_position(names, F.col("lifecycle_state")), F.lit(0).cast("bigint"))
        early = place < _FIRST_DAYS
        folded["early"] = F.when(early, F.call_function("shiftleft", code, place * _CODE_BITS))
        folded["late"] = F.when(~early, F.call_function("shiftleft", code, (place - _FIRST_DAYS) * _CODE_BITS))
    signup = (
        strict_date(F.col("signup_date"), "signup_date") if "signup_date" in fact_user_daily.columns
        else F.lit(None).cast("date"))
    return (
        fact_user_daily.withColumn("_date", date)
        .groupBy("user_id", F.trunc("_date", "month").alias("month"))
        .agg(
            F.min(signup).alias("signup_date"),
            *[F.coalesce(F.bit_or(bits), F.lit(0).cast("bigint")).alias(name) for name, bits in folded.items()])
    )


def streaks_of_months(months: DataFrame) -> DataFrame:
    """date, user_id, streak_length as `streak_by_day` gives them."""
    so_far = _months().rowsBetween(W.unboundedPreceding, W.currentRow)
    carried = months.select(
        "user_id", "month", "days", "quiet",
        F.last(_last_date("quiet"), ignorenulls=True).over(_before()).alias("last_quiet"),
        F.date_sub(F.first(_first_date("days")).over(so_far), 1).alias("outset"))
    day = F.col("day")
    since = F.coalesce(_latest("quiet", day), F.col("last_quiet"), F.col("outset"))
    return _each_day(carried).select(
        _date_of(day).alias("date"), "user_id", F.datediff(_date_of(day), since).cast("bigint").alias("streak_length"))


def states_of_months(months: DataFrame) -> DataFrame:
    """date, user_id, lifecycle_state as `assign_lifecycle_state` gives them."""
    carried = months.select(
        "user_id", "month", "signup_date", "days", "active",
        F.last(_last_date("active"), ignorenulls=True).over(_before()).alias("last_active"))
    day = F.col("day")
    date = _date_of(day)
    gap = F.datediff(date, F.coalesce(_latest("active", day - 1), F.col("last_active")))
    state = state_of_day(date == F.col("signup_date"), _bit("active", day) == 1, gap)
    return _each_day(carried).select(date.alias("date"), "user_id", state.alias("lifecycle_state"))


def transitions_of_months(months: DataFrame) -> DataFrame:
    """state, next_state, transitions, probability as `lifecycle_transitions` gives them, from stored states.
    Days without a state are passed over."""
    wide = (1 << _CODE_BITS) - 1

    def code(day: Column) -> Column:
        early = F.call_function("shiftright", F.col("early"), (day - 1) * _CODE_BITS)
        late = F.call_function("shiftright", F.col("late"), (day - 1 - _FIRST_DAYS) * _CODE_BITS)
        return F.when(day <= _FIRST_DAYS, early).otherwise(late).bitwiseAND(F.lit(wide)).cast("int")

    codes = F.filter(F.transform(F.sequence(F.lit(1), F.lit(31)), code), lambda c: c > 0)
    held = months.select("user_id", "month", codes.alias("codes")).where(F.size("codes") > 0)
    linked = held.withColumn("following", F.lead(F.element_at("codes", 1)).over(_months()))
    nexts = F.concat(F.slice("codes", 2, F.size("codes")), F.array("following"))
    moves = linked.select(F.explode(F.arrays_zip(F.col("codes").alias("a"), nexts.alias("b"))).alias("m"))
    names = F.array(*[F.lit(s) for s in STATES])
    counts = (
        moves.where(F.col("m.b").isNotNull())
        .groupBy(F.col("m.a").alias("a"), F.col("m.b").alias("b"))
        .agg(F.count(F.lit(1)).alias("transitions"))
    )
    return transition_shares(counts.select(
        F.element_at(names, F.col("a")).alias("state"), F.element_at(names, F.col("b")).alias("next_state"),
        "transitions"))


def _months() -> W:
    return W.partitionBy("user_id").orderBy("month")


def _before() -> W:
    return _months().rowsBetween(W.unboundedPreceding, -1)


def _each_day(months: DataFrame) -> DataFrame:
    """A row per day that the table has, with its number in the month as `day`."""
    days = F.filter(F.sequence(F.lit(1), F.lit(31)), lambda d: _bit("days", d) == 1)
    return months.withColumn("day", F.explode(days))


def _bit(bits: str, day: Column) -> Column:
    return F.call_function("shiftright", F.col(bits), day - 1).bitwiseAND(F.lit(1))


def _date_of(day: Column) -> Column:
    return F.date_add("month", day - 1)


def _highest(bits: Column) -> Column:
    """The date of the highest bit, null if there is none."""
    return F.when(bits > 0, F.date_add("month", F.length(F.bin(bits)) - 1))


def _last_date(bits: str) -> Column:
    return _highest(F.col(bits))


def _first_date(bits: str) -> Column:
    return _highest(F.col(bits).bitwiseAND(-F.col(bits)))


def _latest(bits: str, day: Column) -> Column:
    """The last date with a bit up to a day of the month."""
    upto = F.call_function("shiftleft", F.lit(1).cast("bigint"), day) - 1
    return _highest(F.col(bits).bitwiseAND(upto))
