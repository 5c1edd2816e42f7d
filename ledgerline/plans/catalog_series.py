"""Registered queries: time series models, scaling and clustering."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import dates as D
from ledgerline.operators import clusters, reshape, series, weekly
from ledgerline.plans.catalog_relations import (
    MONTH_CELLS_SQL,
    PRICED_SQL,
    STAR_SQL,
    priced_lines,
    star_sales,
    store_months,
)
from ledgerline.plans.sqlforms import code_sql, decomposed_sql, shifts_sql
from ledgerline.plans.warehouse import MONEY
from ledgerline.session import write_stage
from ledgerline.sources.tables import load_parquet

METRIC = {"Sales": "Sales"}


def weekly_sales(spark, folder, groups) -> DataFrame:
    """Weekly sales per group, in thousands and as doubles, ready for the models."""
    totals = weekly.weekly_totals(priced_lines(spark, folder), groups, "Date", METRIC)
    return totals.select(*groups, "YrWk", (F.col("Sales").cast("double") / 1000).alias("Sales"))


def _weekly_sql(group: str) -> str:
    return (
        f"select {group}, {code_sql('Date')} as YrWk, cast(sum(Sales) as double) / 1000 as Sales from ({PRICED_SQL}) p group by 1, 2"
    )


def decomposed_segments(spark, folder):
    return series.decompose_groups(weekly_sales(spark, folder, ["c_mktsegment"]), ["c_mktsegment"], "Sales")


def decomposed_nations_rounded(spark, folder):
    return _rounded(decomposed_nations(spark, folder))


def _rounded(df: DataFrame, columns=series.COMPONENTS, digits: int = 5) -> DataFrame:
    """Fractions cut to what two engines agree on."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def decomposed_segments_rounded(spark, folder):
    return _rounded(decomposed_segments(spark, folder))


def _parts_sql(weekly: str, select: str) -> str:
    """``select`` from the decomposition of ``weekly`` (g, w, y)."""
    return f"with {decomposed_sql(weekly)} {select}"


def _components_sql(group: str) -> str:
    rounded = ", ".join(f"round({c}, 5) as {c}" for c in series.COMPONENTS)
    weekly = f"select {group} as g, YrWk as w, Sales as y from ({_weekly_sql(group)}) q"
    return _parts_sql(weekly, f"select g as {group}, w as YrWk, {rounded}, error from parts")


_SEGMENTS_WEEKLY = "select c_mktsegment as g, YrWk as w, Sales as y from ({}) q"


def _relative_sql(g: str, more: str = "") -> str:
    ratios = ", ".join(f"round({c} / nullif(first_value({c}) over (partition by g order by w), 0), 5) as {c}" for c in series.COMPONENTS)
    return f"select g as {g}, w as YrWk, {ratios}, error{more} from parts where error = 0"


def _bands_sql() -> str:
    around = "over (partition by g order by w rows between 25 preceding and 26 following)"
    z = NormalDist().inv_cdf(0.975)
    sides = ", ".join(
        f"round(trend {sign} {z!r} * sd_{name}, 5) as CI_{side}_{name}" for name in ("remainder", "x") for side, sign in (("lower", "-"), ("upper", "+"))
    )
    rounded = ", ".join(f"round({c}, 5) as {c}" for c in (*series.COMPONENTS, "sd_remainder", "sd_x"))
    return (
        f"select g as c_mktsegment, w as YrWk, {rounded}, error, {sides} from (select *, stddev_samp(remainder) {around} as sd_remainder,"
        f" stddev_samp(actual) {around} as sd_x from parts)"
    )


def relative_growth_rounded(spark, folder):
    return _rounded(relative_growth(spark, folder))


def trend_bands_rounded(spark, folder):
    bands = trend_bands(spark, folder)
    return _rounded(bands, [c for c, kind in bands.dtypes if kind == "double"])


def performance_rounded(spark, folder):
    return _rounded(performance_table(spark, folder))


def decomposed_nations(spark, folder):
    """Two group columns: the series are of the first one."""
    groups = ["n_name", "c_mktsegment"]
    return series.decompose_groups(weekly_sales(spark, folder, groups), groups, "Sales")


def components_add_up(spark, folder):
    parts = decomposed_segments(spark, folder).filter("error = 0")
    return parts.select(
        "c_mktsegment", "YrWk", F.round("actual", 5).alias("actual"),
        F.round(F.col("seasonal") + F.col("trend") + F.col("remainder"), 5).alias("total"),
    )


def short_series(spark, folder):
    """Thirty days of events: too short for a yearly season, so every series is marked."""
    e = load_parquet(spark, folder, "events").select("event_type", F.dayofyear("ts").alias("day"), F.col("value").cast(MONEY).alias("value"))
    daily = e.groupBy("event_type", "day").agg(F.sum("value").cast("double").alias("value"))
    return series.decompose_groups(daily, ["event_type"], "value", order="day")


def relative_growth(spark, folder):
    return series.relative_to_first(decomposed_segments(spark, folder), ["c_mktsegment"])


def performance_table(spark, folder):
    """The dashboard's performance tab: filter, weekly totals, decomposition, relative growth, week end dates."""
    chosen = star_sales(spark, folder)
    totals = weekly.weekly_totals(chosen, ["p_type"], "Date", METRIC)
    parts = series.decompose_groups(totals, ["p_type"], "Sales")
    dated = parts.withColumn("Date", D.week_end(code=F.col("YrWk")))
    return series.relative_to_first(dated, ["p_type"]).withColumnRenamed("p_type", "Grouping")


def performance_actuals(spark, folder):
    """The part of the performance table that SQL can follow: the series relative to its first week."""
    return performance_table(spark, folder).select("Grouping", "YrWk", "Date", F.round("actual", 6).alias("actual"))


_ACTUALS_SQL = f"""select p_type as Grouping, w as YrWk,
    cast(cast(least(make_date(w // 100, 12, 31), make_date(w // 100, 1, 1) + 7 * cast(w % 100 as int) - 1) as date) as varchar) as Date,
    round(s / first_value(s) over (partition by p_type order by w), 6) as actual from
    (select p_type, {code_sql("Date")} as w, cast(sum(Sales) as double) as s from ({STAR_SQL}) p
    group by 1, 2) x"""


_PERFORMANCE_SQL = _parts_sql(
    f"select p_type as g, {code_sql('Date')} as w, cast(sum(Sales) as double) as y from ({STAR_SQL}) p group by 1, 2",
    _relative_sql(
        "Grouping", ", cast(cast(least(make_date(w // 100, 12, 31), make_date(w // 100, 1, 1) + 7 * cast(w % 100 as int) - 1) as date) as varchar) as Date"
    ),
)


def trend_bands(spark, folder):
    return series.trend_bands(decomposed_segments(spark, folder), ["c_mktsegment"])


def band_widths(spark, folder):
    """Width of the band that comes from the series itself, which needs no decomposition to check."""
    bands = trend_bands(spark, folder)
    return bands.select("c_mktsegment", "YrWk", F.round(F.col("CI_upper_x") - F.col("CI_lower_x"), 3).alias("width"))


def level_shifts(spark, folder):
    return _rounded(series.mean_shifts(weekly_sales(spark, folder, ["c_mktsegment"]), ["c_mktsegment"], "Sales"), ["actual"])


def slope_shifts(spark, folder):
    shifts = series.mean_shifts(weekly_sales(spark, folder, ["n_name"]), ["n_name"], "Sales", beta=0.0001, on_differences=True)
    return _rounded(shifts, ["actual"])


def _shifts_sql(group: str, beta: float, on_differences: bool = False) -> str:
    return f"with recursive {shifts_sql(f'select {group} as g, YrWk as w, Sales as y from ({_weekly_sql(group)}) q', beta, on_differences)} select g as {group}, w as YrWk, round(y, 5) as actual, shift from shifts"


def smoothing_start(spark, folder):
    start = series.smoothing_start(weekly_sales(spark, folder, ["n_name"]), ["n_name"], "Sales")
    return start.select("n_name", F.round("l_start", 4).alias("l_start"), F.round("b_start", 4).alias("b_start"), "start_time")


def smoothing_figures(spark, folder):
    start = series.smoothing_start(weekly_sales(spark, folder, ["n_name"]), ["n_name"], "Sales")
    each = start.select("n_name", F.posexplode("s_start").alias("phase", "figure"))
    return each.select("n_name", "phase", F.round("figure", 4).alias("figure"))


def smoothing_figures_multiplicative(spark, folder):
    plan = series.SmoothingPlan(multiplicative=True)
    start = series.smoothing_start(weekly_sales(spark, folder, ["c_mktsegment"]), ["c_mktsegment"], "Sales", plan)
    each = start.select("c_mktsegment", F.round("l_start", 4).alias("l_start"), F.posexplode("s_start").alias("phase", "figure"))
    return each.withColumn("figure", F.round("figure", 6))


RATES = [0.1, 0.5, 0.9]


def smoothing_scores(spark, folder):
    scores = series.smoothing_grid(weekly_sales(spark, folder, ["c_mktsegment"]), ["c_mktsegment"], "Sales", RATES, [0.1], RATES)
    return scores.withColumn("sse", F.round("sse", 2))


def best_smoothing(spark, folder):
    scores = series.smoothing_grid(weekly_sales(spark, folder, ["n_name"]), ["n_name"], "Sales", RATES, [0.1], RATES)
    best = series.best_rates(scores)
    return best.withColumn("sse", F.round("sse", 2))


def searched_rates(spark, folder):
    """The search as a check: how many series it scored, the error of its grid, and that no step is worse than the one before."""
    steps = series.search_rates(weekly_sales(spark, folder, ["n_name"]), ["n_name"], "Sales", RATES, [0.1], RATES)
    worse = F.col("sse") > F.lag("sse").over(Window.orderBy("step"))  # a row per step
    return steps.select("*", worse.alias("worse")).agg(
        F.max("series").alias("series"),
        F.round(F.max_by("sse", -F.col("step")), 2).alias("grid_sse"),
        F.sum(F.coalesce(F.col("worse"), F.lit(False)).cast("long")).alias("worse"),
    )


def _start_sql(group: str) -> str:
    """CTEs: weeks numbered per series, two-sided yearly averages of the first 104, level, slope and figure."""
    return f"""al as materialized (select {group} as g, Sales as x, row_number() over (partition by {group} order by YrWk) as i,
        count(*) over (partition by {group}) as weeks from ({_weekly_sql(group)}) w),
    wk as materialized (select g, x, i from al where weeks >= 104),
    tr as (select a.g, a.i, a.x, sum(b.x * case when abs(b.i - a.i) = 26 then 0.5 else 1 end) / 52 as t
        from wk a join wk b on a.g = b.g and abs(b.i - a.i) <= 26 where a.i between 27 and 78 group by a.g, a.i, a.x),
    lm as (select g, regr_intercept(t, i - 26) as l, regr_slope(t, i - 26) as s from tr group by g),
    fg as (select g, (i - 1) % 52 as ph, x - t - avg(x - t) over (partition by g) as f from tr)"""


def _scores_sql(group: str) -> str:
    return f"""{_start_sql(group)},
    rates as (select a.v as al, c.v as ga from (values (0.1), (0.5), (0.9)) a(v), (values (0.1), (0.5), (0.9)) c(v)),
    q0 as (select g, list(f order by ph) as q from fg group by g),
    st(g, al, ga, i, lev, slo, q, sse) as (
        select lm.g, cast(al as double), cast(ga as double), cast(52 as bigint), l, s, q, cast(0 as double)
        from lm join q0 on q0.g = lm.g, rates
        union all
        select st.g, al, ga, wk.i, al * (x - q[1]) + (1 - al) * (lev + slo),
            0.1 * (al * (x - q[1]) + (1 - al) * (lev + slo) - lev) + 0.9 * slo,
            list_append(q[2:], ga * (x - (al * (x - q[1]) + (1 - al) * (lev + slo))) + (1 - ga) * q[1]),
            sse + (x - lev - slo - q[1]) * (x - lev - slo - q[1])
        from st join wk on wk.g = st.g and wk.i = st.i + 1),
    sc as (select g, al as alpha, cast(0.1 as double) as beta, ga as gamma, sse from st
        qualify row_number() over (partition by g, al, ga order by i desc) = 1)"""


# --- clustering --------------------------------------------------------------------------------

def profiles(spark, folder) -> tuple[DataFrame, list[str]]:
    """Monthly spend of each customer, as doubles, and the names of the months."""
    wide = store_months(spark, folder)
    months = [c for c in wide.columns if c != "o_custkey"]
    return wide.withColumns({c: F.col(c).cast("double") for c in months}), months


def _scaled(spark, folder) -> tuple[DataFrame, list[str]]:
    """The standardized profiles, written once: the models read them several times."""
    wide, months = profiles(spark, folder)
    return write_stage(reshape.standardize(write_stage(wide, "profiles"), months).na.fill(0.0, months), "scaled"), months


def standardized(spark, folder):
    wide, months = profiles(spark, folder)
    cells = reshape.unpivot(reshape.standardize(wide, months), ["o_custkey"], months, "m", "z")
    return cells.select("o_custkey", F.col("m").substr(2, 6).alias("m"), F.round("z", 6).alias("z"))


def kmeans(spark, folder):
    return clusters.kmeans_clusters(*_scaled(spark, folder)).select("o_custkey", "cluster")


def kmeans_checked(spark, folder):
    """What must hold of the clusters: each row is nearest to its own centre, and spreads add up.

    Columns: customers, clusters, misplaced (rows whose squared distance to their own cluster's mean is larger than to
    the nearest one, beyond rounding), spread (within and between the clusters together).
    """
    scaled, months = _scaled(spark, folder)
    rows = write_stage(clusters.kmeans_clusters(scaled, months).select("o_custkey", "cluster", F.array(*months).alias("x")), "clustered")
    means = rows.groupBy("cluster").agg(F.array(*[F.avg(F.get("x", F.lit(i))) for i in range(len(months))]).alias("mean"), F.count("*").alias("n"))
    means = means.agg(F.collect_list(F.struct("cluster", "mean", "n")).alias("means"))  # one row of k means
    square = lambda a, b: F.aggregate(F.zip_with(a, b, lambda u, v: (u - v) * (u - v)), F.lit(0.0), lambda s, v: s + v)
    wide = rows.crossJoin(F.broadcast(means))
    own = F.get(F.filter("means", lambda m: m["cluster"] == F.col("cluster")), F.lit(0))["mean"]
    nearest = F.array_min(F.transform("means", lambda m: square(F.col("x"), m["mean"])))
    wide = wide.select(square(F.col("x"), own).alias("own"), nearest.alias("nearest"), "cluster", own.alias("mean"))
    # The standardized columns have the mean zero, so a cluster's distance from the centre is its mean's length.
    apart = F.aggregate("mean", F.lit(0.0), lambda s, v: s + v * v)
    return wide.agg(
        F.count("*").alias("customers"),
        F.count_distinct("cluster").alias("clusters"),
        F.sum((F.col("own") > F.col("nearest") * (1 + 1e-6) + 1e-6).cast("long")).alias("misplaced"),
        F.round(F.sum(F.col("own") + apart), 3).alias("spread"),
    )


def cluster_tree(spark, folder):
    return clusters.tree_clusters(*_scaled(spark, folder)).select("o_custkey", "cluster")


def cluster_levels(spark, folder):
    """Each level of the tree labels every customer, with as many clusters as asked for at most (some cannot be divided)."""
    levels = clusters.tree_levels(*_scaled(spark, folder)).select("o_custkey", *[f"level_{k}" for k in range(2, 6)])
    rows = levels.unpivot(["o_custkey"], [f"level_{k}" for k in range(2, 6)], "level", "cluster")
    return rows.groupBy("level").agg(
        (F.count_distinct("cluster") <= F.max(F.substring("level", 7, 2).cast("int"))).alias("within"), F.count("*").alias("customers")
    )


def ward_tree(spark, folder):
    return clusters.ward_tree(*_scaled(spark, folder))


def ward_checked(spark, folder):
    """The agglomerative tree as a check: its last merge holds all customers and all of their spread, and no merge is lower than the one before."""
    tree = ward_tree(spark, folder)
    falls = F.col("height") < F.lag("height").over(Window.orderBy("step"))  # a row per leaf of the tree, a bounded number
    last = lambda c: F.max_by(c, "step")
    return tree.select("*", falls.alias("falls")).agg(
        last("n").alias("customers"),
        F.round(last("spread"), 3).alias("spread"),
        F.sum(F.coalesce(F.col("falls"), F.lit(False)).cast("long")).alias("falls"),
    )


def ward_cut(spark, folder):
    return clusters.ward_clusters(*_scaled(spark, folder)).select("o_custkey", "cluster")


def elbow(spark, folder):
    return clusters.elbow_curve(*profiles(spark, folder))


def elbow_checked(spark, folder):
    """The elbow curve as a check: it has all its points, starts at the total spread and never rises."""
    curve = elbow(spark, folder)
    rises = F.col("wss") > F.lag("wss").over(Window.orderBy("k")) * (1 + 1e-9)  # one row per k
    return curve.select("k", "wss", rises.alias("rises")).agg(
        F.count("*").alias("points"),
        F.round(F.max(F.when(F.col("k") == 1, F.col("wss"))) / 1e9, 2).alias("first"),
        F.sum(F.coalesce(F.col("rises"), F.lit(False)).cast("long")).alias("rises"),
    )


def total_spread(spark, folder):
    """The curve's first point: squared distance of all profiles from their mean, in billions."""
    one = clusters.elbow_curve(*profiles(spark, folder), k_max=1, starts=1)
    return one.select("k", F.round(F.col("wss") / 1e9, 2).alias("wss"))


def per_store(spark, folder):
    """What the per-store loop was after: each store's own rows, summed where they lie."""
    line = load_parquet(spark, folder, "lineitem")
    return line.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.sum(F.col("l_extendedprice").cast(MONEY)).alias("Sales"))


QUERIES = {
    "t01_decomposed": (decomposed_segments_rounded, _components_sql("c_mktsegment")),
    "t01_decomposed_first_group": (decomposed_nations_rounded, _components_sql("n_name")),
    "t01_components_add_up": (
        components_add_up,
        f"select c_mktsegment, YrWk, round(Sales, 5) as actual, round(Sales, 5) as total from ({_weekly_sql('c_mktsegment')}) w",
    ),
    "t01_short_series": (
        short_series,
        "select event_type, cast(dayofyear(ts) as int) as YrWk, cast(sum(cast(value as decimal(18,2))) as double) as actual,"
        " 0.0::double as seasonal, 0.0::double as trend, 0.0::double as remainder, 1::int as error from events group by 1, 2",
    ),
    "t02_relative_growth": (relative_growth_rounded, _parts_sql(_SEGMENTS_WEEKLY.format(_weekly_sql("c_mktsegment")), _relative_sql("c_mktsegment"))),
    "t03_trend_bands": (trend_bands_rounded, _parts_sql(_SEGMENTS_WEEKLY.format(_weekly_sql("c_mktsegment")), _bands_sql())),
    "t03_band_widths": (
        band_widths,
        "select c_mktsegment, YrWk, round(2 * 1.959963984540054 * stddev_samp(Sales) over (partition by c_mktsegment order by YrWk"
        f" rows between 25 preceding and 26 following), 3) as width from ({_weekly_sql('c_mktsegment')}) w",
    ),
    "t04_level_shifts": (level_shifts, _shifts_sql("c_mktsegment", 0.001)),
    "t04_slope_shifts": (slope_shifts, _shifts_sql("n_name", 0.0001, True)),
    "t05_smoothing_start": (
        smoothing_start,
        f"with {_start_sql('n_name')} select al.g as n_name, round(l, 4) as l_start, round(s, 4) as b_start,"
        " case when l is not null then 53::int end as start_time from al left join lm on lm.g = al.g where i = 1",
    ),
    "t05_smoothing_figures": (
        smoothing_figures,
        f"with {_start_sql('n_name')} select g as n_name, cast(ph as int) as phase, round(f, 4) as figure from fg",
    ),
    "t05_multiplicative_figures": (
        smoothing_figures_multiplicative,
        f"with {_start_sql('c_mktsegment')} select tr.g as c_mktsegment, round(l, 4) as l_start, cast((i - 1) % 52 as int) as phase,"
        " round(x / t / avg(x / t) over (partition by tr.g), 6) as figure from tr join lm on lm.g = tr.g",
    ),
    "t06_smoothing_scores": (
        smoothing_scores,
        f"with recursive {_scores_sql('c_mktsegment')} select g as c_mktsegment, alpha, beta, gamma, round(sse, 2) as sse from sc",
    ),
    "t06_best_smoothing": (
        best_smoothing,
        f"with recursive {_scores_sql('n_name')} select alpha, beta, gamma, round(sum(sse), 2) as sse, count(*) as series from sc"
        " group by 1, 2, 3 order by sum(sse), 1, 2, 3 limit 1",
    ),
    "t06_searched_rates": (
        searched_rates,
        f"with recursive {_scores_sql('n_name')} select max(series) as series, round(min(sse), 2) as grid_sse, 0::bigint as worse"
        " from (select sum(sse) as sse, count(*) as series from sc group by alpha, beta, gamma)",
    ),
    "t07_standardized": (
        standardized,
        "select o_custkey, m, round((s - avg(s) over (partition by m)) / nullif(stddev_samp(s) over (partition by m), 0), 6) as z"
        f" from ({MONTH_CELLS_SQL}) p",
    ),
    "t08_kmeans": (kmeans, None),
    "t08_kmeans_checked": (
        kmeans_checked,
        "select count(distinct o_custkey) as customers, 5::bigint as clusters, 0::bigint as misplaced,"
        " round((count(distinct o_custkey) - 1) * count(distinct m)::double, 3) as spread"
        f" from (select *, var_pop(s) over (partition by m) as v from ({MONTH_CELLS_SQL}) p) q where v > 0",
    ),
    "t09_elbow": (elbow, None),
    "t09_elbow_checked": (
        elbow_checked,
        f"select 15::bigint as points, round(sum(v) / 1e9, 2) as first, 0::bigint as rises"
        f" from (select m, var_pop(s) * count(*) as v from ({MONTH_CELLS_SQL}) p group by m) q",
    ),
    "t09_total_spread": (
        total_spread,
        f"select 1::int as k, round(sum(v) / 1e9, 2) as wss from (select m, var_pop(s) * count(*) as v from ({MONTH_CELLS_SQL}) p group by m) q",
    ),
    "t10_cluster_tree": (cluster_tree, None),
    "t10_cluster_levels": (
        cluster_levels,
        "select 'level_' || k as level, true as within, count(distinct o_custkey) as customers from orders,"
        " (select unnest(range(2, 6)) as k) levels where o_orderdate >= date '1999-08-31' group by k",
    ),
    "t10_ward_tree": (ward_tree, None),
    "t10_ward_clusters": (ward_cut, None),
    "t10_ward_checked": (
        ward_checked,
        "select count(distinct o_custkey) as customers, round((count(distinct o_custkey) - 1) * count(distinct m)::double, 3) as spread,"
        f" 0::bigint as falls from (select *, var_pop(s) over (partition by m) as v from ({MONTH_CELLS_SQL}) p) q where v > 0",
    ),
    "t11_per_store": (
        per_store,
        "select l_suppkey, count(*) as n, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as Sales from lineitem group by 1",
    ),
    "d16_performance": (performance_rounded, _PERFORMANCE_SQL),
    "d16_performance_actuals": (performance_actuals, _ACTUALS_SQL),
}
