"""Pivots, unpivots, coverage, scaling and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pivot_sum(
    df: DataFrame,
    rows: Sequence[str],
    key: str,
    value: str,
    key_values: Sequence,
    fill: object | None = None,
    prefix: str = "",
) -> DataFrame:
    """One column per key value holding the sum; the values are given, so no extra job finds them."""
    cells = [
        F.sum(F.when(F.col(key) == F.lit(k), F.col(value))).alias(f"{prefix}{k}") for k in key_values
    ]
    wide = df.groupBy(*rows).agg(*cells)
    if fill is None:
        return wide
    names = [f"{prefix}{k}" for k in key_values]
    return wide.withColumns({n: F.coalesce(F.col(f"`{n}`"), F.lit(fill)) for n in names})


def pivot_metrics(
    df: DataFrame, rows: Sequence[str], key: str, metrics: Sequence[str], key_values: Sequence, fill: object = 0
) -> DataFrame:
    """Pivot several metrics at once; columns are ``<key value>_<metric>`` in name order."""
    pairs = sorted((f"{k}_{m}", k, m) for k in key_values for m in metrics)
    return df.groupBy(*rows).agg(
        *[F.coalesce(F.sum(F.when(F.col(key) == F.lit(k), F.col(m))), F.lit(fill)).alias(n) for n, k, m in pairs]
    )


def pivot_values(df: DataFrame, column: str) -> list:
    """The values of a column in order, for use as pivot columns: for columns of few values, such as months."""
    return [r[0] for r in df.select(column).distinct().orderBy(column).collect()]


def unpivot(df: DataFrame, ids: Sequence[str], columns: Sequence[str], key: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(columns), key, value)


def populated_share(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Sum of each column over the number of rows, as one row: the share filled, for 0/1 columns."""
    return df.agg(
        *[F.round(F.coalesce(F.sum(c), F.lit(0)) / F.count("*"), digits).alias(c) for c in columns]
    )


def _bounds(df: DataFrame, column: str) -> Column:
    """Minimum and maximum of a column as one scalar subquery."""
    return df.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high")).alias("b")).scalar()


def scale_minmax(df: DataFrame, column: str, out: str, keep_bounds: bool = False) -> DataFrame:
    """Scale a column to [-1, 1]; a column without variation is an error."""
    b = _bounds(df, column)
    low, high = b["low"], b["high"]
    scaled = F.when(low == high, F.raise_error(F.lit("all values of the column are alike"))).otherwise(
        F.lit(2.0) * (F.col(column) - low) / (high - low) - 1
    )
    df = df.withColumn(out, scaled)
    return df.withColumns({f"{out}_min": low, f"{out}_max": high}) if keep_bounds else df


def unscale_minmax(x: Column, low: Column, high: Column) -> Column:
    """The inverse of :func:`scale_minmax`."""
    return (x + 1) * (high - low) / 2 + low


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Centre columns and divide by their sample deviation; a constant column becomes null."""
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in columns], *[F.stddev_samp(c).alias(f"{c}_sd") for c in columns]
        ).alias("s")
    )
    wide = df.crossJoin(F.broadcast(stats))  # one row
    return wide.withColumns(
        {c: F.try_divide(F.col(c) - F.col(f"s.{c}_mean"), F.col(f"s.{c}_sd")) for c in columns}
    ).drop("s")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in ``bins`` equal widths, closed on the right; the first bin also holds the minimum.

    Every bin is returned, empty ones too. Columns: bin, bin_start, bin_end, n.
    """
    b = _bounds(df, column)
    low, width = b["low"], (b["high"] - b["low"]) / bins
    at = F.ceil((F.col(column) - low) / F.nullif(width, F.lit(0.0)))
    binned = df.filter(F.col(column).isNotNull()).select(
        F.least(F.greatest(F.coalesce(at, F.lit(1)), F.lit(1)), F.lit(bins)).cast("int").alias("bin")
    )
    counts = binned.groupBy("bin").agg(F.count("*").alias("n"))
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (
        every.join(counts, "bin", "left")
        .select(
            "bin",
            (low + width * (F.col("bin") - 1)).alias("bin_start"),
            (low + width * F.col("bin")).alias("bin_end"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Counts of the non-null values, rarest first."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy("n", column)


def head_transposed(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first rows by ``order``, turned: one row per column, one column per row."""
    top = df.orderBy(*order).limit(n)
    rank = F.row_number().over(Window.orderBy(*order))  # over n rows only
    texts = top.select(rank.alias("__row"), *[F.col(c).cast("string").alias(c) for c in df.columns])
    long = texts.unpivot("__row", df.columns, "field", "value")
    return long.groupBy("field").agg(
        *[F.max(F.when(F.col("__row") == i, F.col("value"))).alias(f"row_{i}") for i in range(1, n + 1)]
    )
