"""Dated histories (type-2 dimensions) derived from transactions.

``daily_dominant`` -> ``mark_islands`` -> ``collapse_islands`` -> ``validity_intervals``
-> fill of missing values -> ``merge_history``.

Everything before the first key-wise window is pre-aggregated to one row per key and
day, so the largest group a window ever sees is one key's calendar, however many
transactions that key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.joins import overlap_join

# The dates that stand for 'since ever' and 'until further notice'.
OPEN_START = "0001-01-01"
OPEN_END = "2999-12-31"


def _day(text: str) -> Column:
    return F.to_date(F.lit(text))


def daily_counts(events: DataFrame, key: str, day: str, values: Sequence[str], count: str | None = None) -> DataFrame:
    """Occurrences per key, day and value; rows without a key (or without a day) have no place in a history.

    ``count`` names a column of counts where the events are already grouped.
    """
    n = F.count("*") if count is None else F.sum(count)
    return (
        events.filter(F.col(key).isNotNull() & F.col(day).isNotNull())
        .groupBy(key, day, *values)
        .agg(n.alias("orig_occurance_count"))
    )


def daily_dominant(
    events: DataFrame, key: str, day: str, values: Sequence[str], count: str | None = None
) -> DataFrame:
    """The most frequent value combination of each key and day, with the day's total count.

    Ties go to the smaller value, null last. The winner is an aggregate, not a ranked
    window: both steps combine map-side, so no task holds all rows of a busy key.
    """
    rank = F.struct(
        (-F.col("orig_occurance_count")).alias("n"),
        *[f for v in values for f in (F.col(v).isNull().alias(f"{v}_null"), F.col(v))],
    )
    return (
        daily_counts(events, key, day, values, count)
        .groupBy(key, day)
        .agg(F.min(rank).alias("top"), F.sum("orig_occurance_count").alias("occurance_count"))
        .select(key, day, *[F.col(f"top.{v}").alias(v) for v in values], "occurance_count")
    )


def stack_histories(daily: DataFrame, usable: Column) -> DataFrame:
    """Each row as ``null_incld='Y'``, and again as ``'N'`` where ``usable``: one pass, no second read."""
    flags = F.array_compact(F.array(F.lit("Y"), F.when(usable, F.lit("N"))))
    return daily.withColumn("null_incld", F.explode(flags))


def stack_nulls(df: DataFrame, indicator: str = "null_indicator") -> DataFrame:
    """All rows as ``null_incld='Y'`` and those whose indicator is 'N' again as ``'N'``."""
    return stack_histories(df, F.col(indicator) == "N").drop(indicator)


def change_flag(prev_day: Column, prev_value: Column, value: Column) -> Column:
    """1 on a first row or where the value differs from the one before, null counting as ''."""
    differs = F.coalesce(prev_value, F.lit("")) != F.coalesce(value, F.lit(""))
    return F.when(prev_day.isNull() | differs, 1).otherwise(0)


def with_previous(daily: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    by_day = Window.partitionBy(*keys).orderBy(day)
    return daily.withColumns(
        {"lag_order_dt": F.lag(day).over(by_day), "lag_value": F.lag(value).over(by_day)}
    )


def mark_islands(daily: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """Number the runs of equal values of each key in day order."""
    by_day = Window.partitionBy(*keys).orderBy(day)
    flagged = with_previous(daily, keys, day, value).withColumn(
        "change_flag", change_flag(F.col("lag_order_dt"), F.col("lag_value"), F.col(value))
    )
    running = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return flagged.withColumn("islands", F.sum("change_flag").over(running))


def collapse_islands(marked: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """First and last day of each run. Reuses the windows' partitioning: no shuffle."""
    return marked.groupBy(*keys, "islands", value).agg(
        F.min(day).alias("orig_start_dt"), F.max(day).alias("orig_end_dt")
    )


def validity_bounds(start: Column, end: Column, prev_end: Column, next_start: Column) -> tuple[Column, Column]:
    """From-to dates of a run: open before the first, open after the last, else up to the next start.

    The last two branches are only reached by runs that touch or overlap.
    """
    valid_from = F.when(prev_end.isNull(), _day(OPEN_START)).otherwise(start)
    valid_to = (
        F.when(next_start.isNull(), _day(OPEN_END))
        .when(next_start > end, F.date_sub(next_start, 1))
        .when((next_start == end) & (start < end), F.date_sub(end, 1))
        .otherwise(_day(OPEN_START))
    )
    return valid_from, valid_to


def validity_intervals(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    by_start = Window.partitionBy(*keys).orderBy("orig_start_dt")
    around = runs.withColumns(
        {"lead_start": F.lead("orig_start_dt").over(by_start), "lag_end": F.lag("orig_end_dt").over(by_start)}
    )
    start, end = validity_bounds(
        F.col("orig_start_dt"), F.col("orig_end_dt"), F.col("lag_end"), F.col("lead_start")
    )
    return around.withColumns({"start_dt": start, "end_dt": end})


def _by_key(daily: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a key in one place, in as many parts as the session's shuffles have.

    With a number of its own the shuffle is not coalesced: packed, these rows are a small part of what a task holds to sort
    them, window them and group their runs.
    """
    return daily.repartition(int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions")), *[F.col(f"`{k}`") for k in keys])


def history_intervals(daily: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """One row per daily value in, one row per validity interval out."""
    runs = collapse_islands(mark_islands(_by_key(daily, keys), keys, day, value), keys, day, value)
    return validity_intervals(runs, keys)


def build_history(
    daily: DataFrame, key: str, day: str, value: str, usable: str | None = None, payload: Sequence[str] = ()
) -> DataFrame:
    """Intervals of ``value`` per key, with gaps filled.

    ``usable`` names a boolean column telling which rows carry real information
    (default: the value is not null). Each interval gets the last usable value so far,
    or the key's first one where none came before; ``orig_value`` keeps what was seen.
    One shuffle by key serves every window, and none is made if ``daily`` is dealt by key already.
    Columns: key, value, start_dt, orig_start_dt, end_dt, orig_value, and the ``payload``: columns
    that rows of one value share, as a run's first row has them.
    """
    if usable is None:
        daily = daily.withColumn("usable", F.col(value).isNotNull())
    else:
        daily = daily.withColumn("usable", F.col(usable))
    # Equal values of one key are equally usable, so a run has one flag.
    runs = (
        mark_islands(_by_key(daily.select(key, day, value, "usable", *payload), [key]), [key], day, value)
        .groupBy(key, "islands", value)
        .agg(
            F.min(day).alias("orig_start_dt"),
            F.max(day).alias("orig_end_dt"),
            F.max("usable").alias("usable"),
            *[F.first(c).alias(c) for c in payload],
        )
    )
    by_start = Window.partitionBy(key).orderBy("orig_start_dt")
    so_far = by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = by_start.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = F.when(F.col("usable"), F.col(value))
    filled = F.coalesce(F.last(seen, ignorenulls=True).over(so_far), F.first(seen, ignorenulls=True).over(whole))
    return (
        validity_intervals(runs, [key])
        .withColumn("filled", filled)
        .select(
            F.col(key),
            F.col("filled").alias("value"),
            "start_dt",
            "orig_start_dt",
            "end_dt",
            F.col(value).alias("orig_value"),
            *payload,
        )
    )


def merge_null_histories(intervals: DataFrame, key: str, value: str) -> DataFrame:
    """Join the full ('Y') intervals to the overlapping null-skipping ('N') ones.

    The general form of the fill in :func:`build_history`, for stage tables that hold
    both kinds of interval; same columns out.
    """
    full = intervals.filter("null_incld = 'Y'").select(
        key, "start_dt", "orig_start_dt", "end_dt", F.col(value).alias("orig_value")
    )
    known = intervals.filter("null_incld = 'N'").select(
        key,
        F.col(value).alias("value"),
        F.col("start_dt").alias("known_start"),
        F.col("end_dt").alias("known_end"),
    )
    joined = overlap_join(
        full, known, [key], ("start_dt", "end_dt"), ("known_start", "known_end"), left_id=[key, "start_dt"]
    )
    return joined.select(key, "value", "start_dt", "orig_start_dt", "end_dt", "orig_value")


def current_flag(end: Column) -> Column:
    return F.when(end == _day(OPEN_END), "Y").otherwise("N")


def merge_history(existing: DataFrame | None, fresh: DataFrame, key: str, payload: Sequence[str] = ()) -> DataFrame:
    """Apply a batch of intervals (from :func:`build_history`) to a dimension.

    Existing rows that start at or after the batch's first change of their key go; the
    last row left is closed the day before that change; the batch's rows come in, the
    first one starting at its change instead of at the open start. One pass: both sides
    are stacked and every rule is a window over the key, so the only shuffle is by key
    and groups hold intervals, not transactions. Columns: key, value, start_date,
    end_date, orig_value, current_record; and the ``payload`` of fresh rows where there are no others.
    """
    new_rows = fresh.select(
        key,
        "value",
        F.col("start_dt").alias("start_date"),
        F.col("end_dt").alias("end_date"),
        "orig_value",
        "orig_start_dt",
        *(payload if existing is None else ()),
    )
    if existing is None:
        return new_rows.drop("orig_start_dt").withColumn("current_record", current_flag(F.col("end_date")))

    old_rows = existing.select(
        key, "value", "start_date", "end_date", "orig_value", "current_record", F.lit(None).cast("date").alias("orig_start_dt")
    ).withColumn("is_old", F.lit(True))
    stacked = old_rows.unionByName(
        new_rows.withColumns({"current_record": F.lit(None).cast("string"), "is_old": F.lit(False)})
    )
    whole = Window.partitionBy(key)
    is_old = F.col("is_old")
    kept = stacked.withColumn("first_change", F.min("orig_start_dt").over(whole)).filter(
        ~is_old | F.col("first_change").isNull() | (F.col("start_date") < F.col("first_change"))
    )
    last_old = F.max(F.when(is_old, F.col("start_date"))).over(whole)
    closes = is_old & F.col("first_change").isNotNull() & (F.col("start_date") == F.col("last_old"))
    closed = kept.withColumn("last_old", last_old).withColumns(
        {
            "end_date": F.when(closes, F.date_sub("first_change", 1)).otherwise(F.col("end_date")),
            "current_record": F.when(closes, F.lit("N"))
            .when(is_old, F.col("current_record"))
            .otherwise(current_flag(F.col("end_date"))),
        }
    )
    max_old_end = F.max(F.when(is_old, F.col("end_date"))).over(whole)
    stitched = F.when(
        ~is_old & (F.date_add("max_old_end", 1) == F.col("orig_start_dt")), F.col("orig_start_dt")
    ).otherwise(F.col("start_date"))
    return (
        closed.withColumn("max_old_end", max_old_end)
        .withColumn("start_date", stitched)
        .select(key, "value", "start_date", "end_date", "orig_value", "current_record")
    )
