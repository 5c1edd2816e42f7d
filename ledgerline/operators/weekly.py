"""Weekly aggregation, calendar filling and the year-over-year report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import dates as D


def weekly_totals(
    df: DataFrame, group_cols: Sequence[str], day: str, metrics: Mapping[str, str], code: str = "YrWk"
) -> DataFrame:
    """Per group and week: first and last date, the summed metrics, and the row count.

    ``metrics`` maps output name to input column. The week code is made from ``day``
    where the frame does not have it.
    """
    if code not in df.columns:
        df = df.withColumn(code, D.week_code(F.col(day)))
    keys = [*group_cols, *([] if code in group_cols else [code])]
    return df.groupBy(*keys).agg(
        F.min(day).alias("Start_Date"),
        F.max(day).alias("End_Date"),
        *[F.sum(source).alias(name) for name, source in metrics.items()],
        F.count("*").alias("Record_Count"),
    )


def week_by_year(weekly: DataFrame, metrics: Sequence[str], code: str = "YrWk") -> DataFrame:
    """Sum of each metric by week of year and year, one row per metric."""
    wide = (
        weekly.select(D.code_week(F.col(code)).alias("Wk"), D.code_year(F.col(code)).alias("Yr"), *metrics)
        .groupBy("Wk", "Yr")
        .agg(*[F.sum(m).alias(m) for m in metrics])
    )
    return wide.unpivot(["Wk", "Yr"], list(metrics), "Metric", "Value")


def day_spine(spark: SparkSession, first: date, last: date, weekends: bool = True) -> DataFrame:
    """One row per calendar day, with weekday name, week and year."""
    days = (last - first).days + 1
    spine = spark.range(days).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("Date"))
    spine = spine.select(
        "Date",
        F.date_format("Date", "EEEE").alias("wkday"),
        D.week_of_year(F.col("Date")).alias("wk"),
        F.year("Date").alias("yr"),
    )
    return spine if weekends else spine.filter(~F.col("wkday").isin("Saturday", "Sunday"))


def fill_calendar(daily: DataFrame, spine: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Right join of a daily series onto a spine, missing metrics as zero."""
    return daily.join(spine, "Date", "right").withColumns(
        {m: F.coalesce(F.col(m), F.lit(0).cast(daily.schema[m].dataType)) for m in metrics}
    )


def _ratio(part: str, whole: str) -> Column:
    """Quotient as a double (decimal division would cut its digits); null over zero."""
    return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))


def comparison_days(current: date, week_shift: int = -52) -> tuple[date, date]:
    """First and last day a comparison looks at: a filter on the fact's date for the scan."""
    offset = D.plain_offset(week=week_shift)
    earlier = D.plain_week_end(D.plain_shift(current, weeks=offset.week, years=offset.year))
    last = D.plain_week_end(current)
    return date(min(earlier.year, last.year), 1, 1), max(earlier, last)


def year_over_year(
    weekly: DataFrame,
    group_cols: Sequence[str],
    current: date,
    metrics: Sequence[str],
    week_shift: int = -52,
    ytd: bool = True,
    distinct_rows: bool = False,
    abs_change: bool = True,
    per_change: bool = True,
    share: bool = True,
    share_change: bool = True,
    code: str = "YrWk",
) -> DataFrame:
    """Current against earlier totals of each metric, per group.

    ``ytd`` sums from week 1 to the selected week of both years, otherwise only the two
    weeks are compared. The shares are of the total over all but the last group column.
    A zero base gives null. One conditional aggregate does the pivot. ``weekly`` comes
    from :func:`weekly_totals`; for rows that may repeat, ``distinct_rows`` drops the
    copies. Filter the facts by :func:`comparison_days` first, so that the scan skips
    all other years.
    """
    metrics = sorted(metrics)
    offset = D.plain_offset(week=week_shift)
    earlier = D.plain_shift(current, weeks=offset.week, years=offset.year)
    now_code = D.plain_week_code(D.plain_week_end(current))
    lag_code = D.plain_week_code(D.plain_week_end(earlier))
    cur, lag = "Cur", f"L_{abs(week_shift)}"

    at = F.col(code)
    if ytd:
        now_start, lag_start = now_code // 100 * 100 + 1, lag_code // 100 * 100 + 1
        wanted = at.between(now_start, now_code) | at.between(lag_start, lag_code)
        is_now = at >= now_start
    else:
        wanted = at.isin(now_code, lag_code)
        is_now = at == now_code
    kept = weekly.filter(wanted)
    if distinct_rows:
        kept = kept.drop("Wk", "Yr", "Date", "Start_Date", "End_Date").distinct()

    def total(metric: str, when: Column) -> Column:
        zero = F.lit(0).cast(weekly.schema[metric].dataType)
        return F.sum(F.when(when, F.col(metric)).otherwise(zero))

    report = kept.groupBy(*group_cols).agg(
        *[total(m, is_now).alias(f"{cur}_{m}") for m in metrics],
        *[total(m, ~is_now).alias(f"{lag}_{m}") for m in metrics],
    )
    if abs_change:
        report = report.withColumns({f"{m}_Delta": F.col(f"{cur}_{m}") - F.col(f"{lag}_{m}") for m in metrics})
    if per_change:
        report = report.withColumns(
            {f"{m}_PercD": _ratio(f"{cur}_{m}", f"{lag}_{m}") - 1 for m in metrics}
        )
    if share:
        names = {f"{level}_{m}": f"{level}_{m}_MkShare" for level in (cur, lag) for m in metrics}
        report = share_of_parent(report, list(group_cols)[:-1], names)
        if share_change:
            report = report.withColumns(
                {f"{m}_MkShareD": F.col(f"{cur}_{m}_MkShare") - F.col(f"{lag}_{m}_MkShare") for m in metrics}
            )
    return report


def share_of_parent(df: DataFrame, parent_cols: Sequence[str], names: Mapping[str, str]) -> DataFrame:
    """Each value over the total of its parent group; a zero total gives null.

    Totals are aggregated and joined back rather than windowed, so a parent with very
    many children is summed map-side first and never gathered in one task.
    """
    totals = [F.sum(value).alias(f"__{out}") for value, out in names.items()]
    if parent_cols:
        parents = [F.col(c).alias(f"__p_{c}") for c in parent_cols]
        sums = df.groupBy(*parents).agg(*totals)
        same = None
        for c in parent_cols:
            test = F.col(c).eqNullSafe(F.col(f"__p_{c}"))
            same = test if same is None else same & test
        wide = df.join(sums, same, "inner")
    else:
        wide = df.crossJoin(F.broadcast(df.agg(*totals)))  # one row
    shares = {out: _ratio(value, f"__{out}") for value, out in names.items()}
    return wide.withColumns(shares).drop(
        *[f"__{out}" for out in names.values()], *[f"__p_{c}" for c in parent_cols]
    )
