"""Models per time series: seasonal decomposition, bands, mean shifts, smoothing.

A series is the weekly totals of one group, so a group handed to Python holds one row
per week whatever the number of sales behind it; Spark aggregates, partitions and
joins, and the numpy code below sees one short array at a time.
"""

from __future__ import annotations

import bisect
import sys
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import write_stage

# The functions below travel with their job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

COMPONENTS = ("actual", "seasonal", "trend", "remainder")


# --- seasonal decomposition (Cleveland et al. 1990, periodic season) --------------------


def local_fit(y: np.ndarray, span: int, degree: int, at: np.ndarray) -> np.ndarray:
    """Tricube-weighted local constant (0) or line (1) through ``y`` at 1..n, evaluated at ``at``."""
    n = len(y)
    width = min(span, n)
    left = np.clip(at - (width + 1) // 2 + 1, 1, n - width + 1).astype(int)
    index = left[:, None] + np.arange(width)
    h = np.maximum(at - left, left + width - 1 - at) + max(span - n, 0) // 2
    distance = np.abs(index - at[:, None])
    weight = np.where(
        distance <= 0.001 * h[:, None], 1.0, (1 - np.minimum(distance / h[:, None], 1) ** 3) ** 3
    )
    weight[distance > 0.999 * h[:, None]] = 0.0
    weight /= weight.sum(axis=1, keepdims=True)
    if degree > 0:
        centre = (weight * index).sum(axis=1)
        spread = (weight * (index - centre[:, None]) ** 2).sum(axis=1)
        wide = np.sqrt(spread) > 0.001 * (n - 1)
        slope = np.where(wide, (at - centre) / np.where(wide, spread, 1.0), 0.0)
        weight = weight * (1 + slope[:, None] * (index - centre[:, None]))
    return (weight * y[index - 1]).sum(axis=1)


def smooth(y: np.ndarray, span: int, degree: int, jump: int) -> np.ndarray:
    """Local fits at every ``jump``-th point and at the last, lines between."""
    n = len(y)
    at = np.unique(np.append(np.arange(1, n + 1, max(min(jump, n - 1), 1)), n)).astype(float)
    return np.interp(np.arange(1, n + 1), at, local_fit(y, span, degree, at))


def _moving_average(y: np.ndarray, width: int) -> np.ndarray:
    total = np.cumsum(np.insert(y, 0, 0.0))
    return (total[width:] - total[:-width]) / width


def _next_odd(x: float) -> int:
    whole = int(np.ceil(x))
    return whole + 1 - whole % 2


def decompose_periodic(y: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seasonal, trend and remainder of ``y``, the season repeating exactly."""
    n = len(y)
    if period < 2 or n <= 2 * period or not np.isfinite(y).all():
        raise ValueError("series is not periodic, too short or has gaps")
    season_span = 10 * n + 1
    trend_span = _next_odd(1.5 * period / (1 - 1.5 / season_span))
    low_span = _next_odd(period)
    trend = np.zeros(n)
    for _ in range(2):
        cycle = np.empty(n + 2 * period)
        for phase in range(period):
            sub = (y - trend)[phase::period]
            k = len(sub)
            ends = local_fit(sub, season_span, 0, np.array([0.0, k + 1.0]))
            inner = smooth(sub, season_span, 0, -(-season_span // 10))
            cycle[phase::period] = np.concatenate([ends[:1], inner, ends[1:]])
        low = _moving_average(_moving_average(_moving_average(cycle, period), period), 3)
        season = cycle[period : period + n] - smooth(low, low_span, 1, -(-low_span // 10))
        trend = smooth(y - season, trend_span, 1, -(-trend_span // 10))
    phase = np.arange(n) % period
    figure = np.bincount(phase, weights=season) / np.bincount(phase)
    season = figure[phase]
    return season, trend, y - season - trend


def _series_frame(df: DataFrame, group: Sequence[str], metric: str, order: str) -> DataFrame:
    return df.select(*group, F.col(order).cast("int").alias("YrWk"), F.col(metric).cast("double").alias("actual"))


def _schema(df: DataFrame, group: Sequence[str], fields: Sequence[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([df.schema[g] for g in group] + [T.StructField(n, t) for n, t in fields])


def decompose_groups(
    weekly: DataFrame, group_cols: Sequence[str], metric: str, freq: int = 52, order: str = "YrWk"
) -> DataFrame:
    """Seasonal decomposition of each series of the first group column.

    Where ``weekly`` has more group columns, its metric is summed up to the first one.
    A series that cannot be decomposed keeps its values, zero components and error 1.
    """
    group = list(group_cols)[:1]
    if len(group_cols) > 1:
        weekly = weekly.groupBy(*group, order).agg(F.sum(metric).alias(metric))
    source = _series_frame(weekly, group, metric, order)

    def decompose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("YrWk", kind="stable").reset_index(drop=True)
        try:
            season, trend, rest = decompose_periodic(pdf["actual"].to_numpy(dtype=float), freq)
            return pdf.assign(seasonal=season, trend=trend, remainder=rest, error=0)
        except ValueError:
            return pdf.assign(seasonal=0.0, trend=0.0, remainder=0.0, error=1)

    double = T.DoubleType()
    fields = [("YrWk", T.IntegerType()), *[(c, double) for c in COMPONENTS], ("error", T.IntegerType())]
    return source.groupBy(*group).applyInPandas(decompose, _schema(source, group, fields))


def relative_to_first(
    decomposed: DataFrame,
    group_cols: Sequence[str],
    remove_errors: bool = True,
    order: str = "YrWk",
    columns: Sequence[str] = COMPONENTS,
) -> DataFrame:
    """Components as multiples of the group's first week; a zero first value gives null."""
    if remove_errors:
        decomposed = decomposed.filter("error = 0")
    from_start = (
        Window.partitionBy(*group_cols).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return decomposed.withColumns(
        {c: F.try_divide(F.col(c), F.first(c).over(from_start)) for c in columns}
    )


def rolling_deviation(
    df: DataFrame, group_cols: Sequence[str], columns: dict[str, str], width: int, order: str = "YrWk"
) -> DataFrame:
    """Centred rolling sample deviation, partial at the edges; an even width looks one row further ahead."""
    around = Window.partitionBy(*group_cols).orderBy(order).rowsBetween(-((width - 1) // 2), width // 2)
    return df.withColumns({out: F.stddev_samp(c).over(around) for out, c in columns.items()})


def trend_bands(
    decomposed: DataFrame, group_cols: Sequence[str], width: int = 52, confidence: float = 0.95, order: str = "YrWk"
) -> DataFrame:
    """Trend plus and minus a normal quantile times the rolling deviation of remainder and series."""
    z = NormalDist().inv_cdf(confidence + (1 - confidence) / 2)
    df = rolling_deviation(
        decomposed, group_cols, {"sd_remainder": "remainder", "sd_x": "actual"}, width, order
    )
    return df.withColumns(
        {
            f"CI_{side}_{name}": F.col("trend") + F.lit(sign * z) * F.col(f"sd_{name}")
            for name in ("remainder", "x")
            for side, sign in (("lower", -1), ("upper", 1))
        }
    )


# --- mean shifts (James, Kejariwal and Matteson 2014: split by medians, penalized) -----


def shift_points(y: np.ndarray, min_size: int, beta: float, degree: int = 1) -> list[int]:
    """Positions (count of points before the shift) where the level of ``y`` changes.

    Best penalized sum, over all segmentations, of the squared difference of
    neighbouring segments' medians on a 0-1 scale, weighted by ``a*b / (a+b)`` of their
    lengths as a share of the series. Each start's right-hand median grows by insertion,
    so the search is quadratic in the series length.
    """
    n = len(y)
    span = y.max() - y.min() if n else 0.0
    if n < 2 * min_size or span == 0:
        return []
    y = (y - y.min()) / span

    def median(ordered: list[float]) -> float:
        half = len(ordered) // 2
        return ordered[half] if len(ordered) % 2 else (ordered[half - 1] + ordered[half]) / 2

    best, previous, count = np.zeros(n + 1), np.zeros(n + 1, dtype=int), np.zeros(n + 1, dtype=int)
    for at in range(min_size, n - min_size + 1):
        start = previous[at]
        if at - start < min_size:
            continue
        left, size = float(np.median(y[start:at])), at - start
        penalty = beta * ((count[at] + 1) ** degree - count[at] ** degree)
        ordered: list[float] = sorted(y[at : at + min_size - 1].tolist())
        for stop in range(at + min_size, n + 1):
            bisect.insort(ordered, float(y[stop - 1]))
            ahead = stop - at
            gain = size * ahead / ((size + ahead) * n) * (left - median(ordered)) ** 2
            value = best[at] + gain - penalty
            if value > best[stop]:
                best[stop], previous[stop], count[stop] = value, at, count[at] + 1
    found, at = [], int(previous[n])
    while at > 0:
        found.append(at)
        at = int(previous[at])
    return found[::-1]


def mean_shifts(
    weekly: DataFrame,
    group_cols: Sequence[str],
    metric: str,
    freq: int = 52,
    beta: float = 0.001,
    degree: int = 1,
    on_differences: bool = False,
    order: str = "YrWk",
) -> DataFrame:
    """The weeks at which each series' level shifts, on values or on first differences."""
    group = list(group_cols)
    source = _series_frame(weekly, group, metric, order)

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna(subset=["actual"]).sort_values("YrWk", kind="stable").reset_index(drop=True)
        values = pdf["actual"].to_numpy(dtype=float)
        offset = 0
        if on_differences:
            values, offset = np.diff(values), 1
        # A shift found after p points is reported at the p-th point, as a 1-based index.
        rows = [p - 1 + offset for p in shift_points(values, freq // 2, beta, degree)]
        return pdf.iloc[rows].assign(shift=range(1, len(rows) + 1))

    fields = [("YrWk", T.IntegerType()), ("actual", T.DoubleType()), ("shift", T.IntegerType())]
    return source.groupBy(*group).applyInPandas(find, _schema(source, group, fields))


# --- Holt-Winters ------------------------------------------------------------------------


@dataclass(frozen=True)
class SmoothingPlan:
    """What kind of Holt-Winters model: season form, season and trend on or off, given start values."""

    period: int = 52
    multiplicative: bool = False
    trend: bool = True
    season: bool = True
    start_periods: int = 2
    level_start: float | None = None
    slope_start: float | None = None
    season_start: tuple[float, ...] | None = None

    def __post_init__(self) -> None:
        if self.season and self.start_periods < 2:
            raise ValueError("a seasonal start takes two periods or more")


def check_rates(alpha: float | None, beta: float | None, gamma: float | None) -> None:
    if alpha == 0:
        raise ValueError("the level needs a rate: alpha is 0")
    if any(r is not None and not 0 <= r <= 1 for r in (alpha, beta, gamma)):
        raise ValueError("rates lie between 0 and 1")


def start_state(y: np.ndarray, plan: SmoothingPlan) -> tuple[float, float, np.ndarray, int]:
    """Level, slope, seasonal figure and the 1-based first fitted time; start values of the plan go first."""
    level, slope, figure, first = _estimated_start(y, plan)
    return (
        level if plan.level_start is None else plan.level_start,
        slope if plan.slope_start is None else plan.slope_start,
        figure if plan.season_start is None or not plan.season else np.array(plan.season_start, dtype=float),
        first,
    )


def _estimated_start(y: np.ndarray, plan: SmoothingPlan) -> tuple[float, float, np.ndarray, int]:
    if not plan.season:
        if len(y) < 2:
            raise ValueError("two values or more are needed")
        return (y[1] if plan.trend else y[0]), y[1] - y[0], np.zeros(1), 3 if plan.trend else 2
    period, window = plan.period, plan.start_periods * plan.period
    if len(y) < window:
        raise ValueError("the series does not reach over the start periods")
    if plan.multiplicative and (y == 0).any():
        raise ValueError("a multiplicative season cannot hold a zero")
    head = y[:window]
    half = period // 2
    kernel = np.ones(period) if period % 2 else np.concatenate([[0.5], np.ones(period - 1), [0.5]])
    trend = np.convolve(head, kernel / period, mode="valid")
    around = head[half : half + len(trend)]
    season = around / trend if plan.multiplicative else around - trend
    phase = (np.arange(len(trend)) + half) % period
    figure = np.bincount(phase, weights=season, minlength=period) / np.bincount(phase, minlength=period)
    figure = figure / figure.mean() if plan.multiplicative else figure - figure.mean()
    slope, level = np.polyfit(np.arange(1, len(trend) + 1), trend, 1)
    return float(level), float(slope), figure, period + 1


def smoothing_errors(y: np.ndarray, plan: SmoothingPlan, rates: np.ndarray) -> np.ndarray:
    """Sum of squared one-step errors for each row (alpha, beta, gamma) of ``rates``, all rows at once."""
    level0, slope0, figure, start = start_state(y, plan)
    alpha, beta, gamma = np.clip(rates, 0, 1).T
    level, slope = np.full(len(alpha), level0), np.full(len(alpha), slope0 if plan.trend else 0.0)
    neutral = 1.0 if plan.multiplicative else 0.0
    seasons = [np.full(len(alpha), s) for s in figure] if plan.season else []
    total = np.zeros(len(alpha))
    for i, x in enumerate(y[start - 1 :]):
        old = seasons[i % plan.period] if plan.season else neutral
        ahead = level + slope
        total += (x - (ahead * old if plan.multiplicative else ahead + old)) ** 2
        new_level = alpha * (x / old if plan.multiplicative else x - old) + (1 - alpha) * ahead
        if plan.trend:
            slope = beta * (new_level - level) + (1 - beta) * slope
        if plan.season:
            fresh = x / new_level if plan.multiplicative else x - new_level
            seasons[i % plan.period] = gamma * fresh + (1 - gamma) * old
        level = new_level
    return total


def smoothing_start(
    weekly: DataFrame,
    group_cols: Sequence[str],
    metric: str,
    plan: SmoothingPlan = SmoothingPlan(),
    alpha: float | None = None,
    beta: float | None = None,
    gamma: float | None = None,
    order: str = "YrWk",
) -> DataFrame:
    """Holt-Winters start state per series; a series that has none says why in ``error``.

    Rates, where given, are checked first: they must be usable for a model.
    """
    check_rates(alpha, beta, gamma)
    group = list(group_cols)
    source = _series_frame(weekly, group, metric, order)

    def start(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values("YrWk", kind="stable")["actual"].to_numpy(dtype=float)
        out = pdf[group].head(1).copy()
        try:
            level, slope, figure, first = start_state(y, plan)
            return out.assign(l_start=level, b_start=slope, start_time=first, s_start=[figure.tolist()], error=None)
        except ValueError as reason:
            return out.assign(l_start=None, b_start=None, start_time=None, s_start=None, error=str(reason))

    fields = [
        ("l_start", T.DoubleType()),
        ("b_start", T.DoubleType()),
        ("start_time", T.IntegerType()),
        ("s_start", T.ArrayType(T.DoubleType())),
        ("error", T.StringType()),
    ]
    return source.groupBy(*group).applyInPandas(start, _schema(source, group, fields))


def smoothing_grid(
    weekly: DataFrame,
    group_cols: Sequence[str],
    metric: str,
    alphas: Sequence[float],
    betas: Sequence[float],
    gammas: Sequence[float],
    plan: SmoothingPlan = SmoothingPlan(),
    order: str = "YrWk",
) -> DataFrame:
    """Squared error of every series under every rate combination.

    The grid travels with the function, so a series is read once for all combinations
    instead of being joined to them. Series without a start state have no rows.
    """
    group = list(group_cols)
    grid = np.array(list(product(alphas, betas, gammas)), dtype=float)
    source = _series_frame(weekly, group, metric, order)

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values("YrWk", kind="stable")["actual"].to_numpy(dtype=float)
        out = pd.DataFrame(grid, columns=["alpha", "beta", "gamma"])
        try:
            out["sse"] = smoothing_errors(y, plan, grid)
        except ValueError:
            out = out.assign(sse=0.0).head(0)
        for i, g in enumerate(group):
            out.insert(i, g, pdf[g].iloc[0])
        return out

    fields = [(n, T.DoubleType()) for n in ("alpha", "beta", "gamma", "sse")]
    return source.groupBy(*group).applyInPandas(score, _schema(source, group, fields))


def best_rates(scores: DataFrame) -> DataFrame:
    """The one rate combination with the least error over all series together."""
    totals = scores.groupBy("alpha", "beta", "gamma").agg(F.sum("sse").alias("sse"), F.count("*").alias("series"))
    best = F.min(F.struct("sse", "alpha", "beta", "gamma", "series")).alias("b")
    return totals.agg(best).select("b.alpha", "b.beta", "b.gamma", "b.sse", "b.series")


def search_rates(
    weekly: DataFrame,
    group_cols: Sequence[str],
    metric: str,
    alphas: Sequence[float],
    betas: Sequence[float],
    gammas: Sequence[float],
    plan: SmoothingPlan = SmoothingPlan(),
    steps: int = 6,
    least: float = 0.01,
    order: str = "YrWk",
) -> DataFrame:
    """One rate combination for all series together, searched from a grid's best one.

    Step 0 scores the grid. Each further step scores the neighbours of the best combination, a width below and above in every
    rate, in one pass over all series; the width, a fifth at first, is halved when none is better. The search
    ends after ``steps`` steps or below the width ``least``. Columns: step and those of ``best_rates``, the last step has the
    result; its error is the grid's at most. No rows if no series has a start state.
    """
    group = list(group_cols)
    weekly = write_stage(weekly.select(*group, order, metric), "series")

    def best(a, b, c):
        return best_rates(smoothing_grid(weekly, group, metric, a, b, c, plan, order)).first()

    spark = weekly.sparkSession
    fields = "step int, alpha double, beta double, gamma double, sse double, series long"
    at = best(alphas, betas, gammas)
    if at.sse is None:
        return spark.createDataFrame([], fields)
    out, width = [(0, *at)], 0.2
    for step in range(1, steps + 1):
        near = [sorted({min(max(r + d, low), 1.0) for d in (-width, 0.0, width)}) for r, low in zip(at[:3], (least, 0.0, 0.0))]
        found = best(*near)
        if found.sse < at.sse:
            at = found
        else:
            width /= 2
        out.append((step, *at))
        if width < least:
            break
    return spark.createDataFrame(out, fields)
