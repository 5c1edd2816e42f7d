"""Registered queries: joins, aggregations, reshaping, windows and set operations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import dates as D
from ledgerline.functions import formats as R
from ledgerline.functions import text as X
from ledgerline.operators import history, reshape, weekly
from ledgerline.operators.filters import all_in, in_years
from ledgerline.operators.joins import add_detail, interval_join, newest, overlap_join, star_filter
from ledgerline.operators.series import relative_to_first, rolling_deviation
from ledgerline.plans.feed import sales_feed, sales_feed_sql
from ledgerline.plans.sqlforms import code_sql, dominant_sql, retyped, title_sql, week_sql
from ledgerline.plans.warehouse import MONEY, number_rows
from ledgerline.session import write_stage
from ledgerline.sources.tables import load_parquet

CURRENT = date(2000, 6, 15)
_DAY = "cast(o_orderdate as date)"
_DEC = "cast({} as decimal(18,2))"


def _t(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return load_parquet(spark, folder, name)


def _day(c: str):
    return F.col(c).cast("date")


# --- joins ---------------------------------------------------------------------------------


def price_bands(spark, folder, key="l_partkey"):
    """Dated rows per part: one from each day its shipped quantity set a new shipping flag."""
    line = _t(spark, folder, "lineitem").select(F.col(key).alias("k"), _day("l_shipdate").alias("d"), F.col("l_returnflag").alias("v"))
    daily = history.daily_dominant(line, "k", "d", ["v"])
    return history.history_intervals(daily, ["k"], "d", "v").select("k", "v", "start_dt", "end_dt")


def _written_bands(spark, folder) -> DataFrame:
    return write_stage(price_bands(spark, folder), "bands")


_BANDS_DAILY = dominant_sql("select l_partkey as k, cast(l_shipdate as date) as d, l_returnflag as v from lineitem", ["v"])
_BANDS_SQL = f"""
    b_day as materialized ({_BANDS_DAILY}),
    b_chg as (select *, lag(d) over (partition by k order by d) as pd, lag(v) over (partition by k order by d) as pv from b_day),
    b_new as (select * from b_chg where pd is null or v <> pv),
    bands as (select k, v, case when pd is null then date '0001-01-01' else d end as start_dt,
        coalesce(lead(d) over (partition by k order by d) - 1, date '2999-12-31') as end_dt from b_new)"""


def flag_in_force(spark, folder):
    line = _t(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", _day("l_shipdate").alias("day"))
    return interval_join(line, _written_bands(spark, folder), {"l_partkey": "k"}, "day", "start_dt", "end_dt").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "day", "v"
    )


def overlapping_bands(spark, folder):
    """Each supplier's flag intervals with its line-status intervals that overlap them."""
    line = _t(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("k"), _day("l_shipdate").alias("d"), "l_returnflag", "l_linestatus"
    )

    def bands(value: str) -> DataFrame:
        daily = history.daily_dominant(line, "k", "d", [value])
        return history.history_intervals(daily, ["k"], "d", value)

    left = write_stage(bands("l_returnflag").select("k", "l_returnflag", "start_dt", "end_dt"), "flags")
    right = bands("l_linestatus").select("k", "l_linestatus", F.col("start_dt").alias("f"), F.col("end_dt").alias("t"))
    joined = overlap_join(left, right, ["k"], ("start_dt", "end_dt"), ("f", "t"), ["k", "start_dt"])
    return joined.select("k", "start_dt", "l_returnflag", "f", "l_linestatus")


def _spans_sql(value: str, name: str) -> str:
    daily = dominant_sql(f"select l_suppkey as k, cast(l_shipdate as date) as d, {value} as v from lineitem", ["v"])
    return f"""{name}_chg as (select *, lag(d) over w as pd, lag(v) over w as pv from ({daily}) x window w as (partition by k order by d)),
    {name} as (select k, v, case when pd is null then date '0001-01-01' else d end as f,
        coalesce(lead(d) over (partition by k order by d) - 1, date '2999-12-31') as t from {name}_chg where pd is null or v <> pv)"""


def county_joined(spark, folder):
    c = _t(spark, folder, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, folder, "nation").filter("n_regionkey <> 4").select("n_nationkey", "n_name")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "n_name")


def current_rows_joined(spark, folder):
    """Every part with the flag of its current band only."""
    current = price_bands(spark, folder).filter(F.col("end_dt") == F.to_date(F.lit("2999-12-31"))).select("k", "v")
    return _t(spark, folder, "part").select("p_partkey").join(current, F.col("p_partkey") == F.col("k"), "left").drop("k")


def numbered_after_max(spark, folder):
    """The names of parts numbered in order, from the number after the largest part key."""
    part = _t(spark, folder, "part")
    after = part.agg((F.max("p_partkey") + 1).alias("n")).scalar()
    return number_rows(part.select("p_name").distinct(), "p_name", after)


_NUMBERED_SQL = """select p_name, cast(row_number() over (order by p_name) + (select max(p_partkey) from part) as int) as number
    from (select distinct p_name from part) p"""


COUNTY_SQL = f"""with f as ({sales_feed_sql(["county_nbr", "county_name"])}),
    a as (select county_nbr, max({title_sql("county_name")}) as county_name from f where county_nbr is not null group by 1),
    b as (select distinct {title_sql("county_name")} as county_name from f where county_nbr is null)
    select * from a union all
    select cast(row_number() over (order by county_name) + (select max(county_nbr) from a) as int), county_name from b"""


def star_filtered(spark, folder):
    items = newest_part_rows(spark, folder).filter(all_in("p_type", ["PROMO", "SMALL"]))
    stores = _t(spark, folder, "supplier").filter(all_in("s_nationkey", [1, 2, 3, 4, 5])).select("s_suppkey", "s_name")
    facts = _t(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"), "l_quantity"
    )
    return star_filter(facts, items.select("p_partkey", "p_name"), stores, "p_partkey", "s_suppkey")


def newest_part_rows(spark, folder):
    """Parts as dated lookup rows (one for each flag they were shipped under), the newest row of each."""
    bands = price_bands(spark, folder).select(F.col("k").alias("p_partkey"), F.col("start_dt").alias("Start_dt"), F.col("end_dt").alias("End_dt"))
    dated = bands.join(_t(spark, folder, "part").select("p_partkey", "p_name", "p_type"), "p_partkey")
    return newest(dated, "p_partkey").drop("Start_dt", "End_dt")


def details_added(spark, folder):
    """Spend per part and supplier with the newest description of both, numbers dropped."""
    line = _t(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("Item_Number"), F.col("l_suppkey").alias("Store_Number")).agg(
        F.sum(F.col("l_extendedprice").cast(MONEY)).alias("Sales")
    )
    bands = price_bands(spark, folder)
    items = bands.select(
        F.col("k").alias("Item_Number"), F.col("v").alias("Item_Description"), F.col("start_dt").alias("Start_dt"),
        F.col("end_dt").alias("End_dt"),
    )
    stores = price_bands(spark, folder, "l_suppkey").select(
        F.col("k").alias("Store_Number"), F.col("v").alias("Store_Name"), F.col("start_dt").alias("Start_dt"),
        F.col("end_dt").alias("End_dt"),
    )
    numbers = ["Item_Number", "Store_Number"]
    named, groups = add_detail(line, {"Item": items, "Store": stores}, numbers, numbers, keep_number=False)
    return named.groupBy(*groups).agg(F.sum("Sales").alias("Sales"), F.count("*").alias("n"))


def vendor_and_category_details(spark, folder):
    """Vendor and category names for customers' spend; the first row of each number is taken."""
    o = _t(spark, folder, "orders")
    spend = o.groupBy(F.col("o_custkey").alias("Vendor_Number")).agg(F.count("*").alias("n"))
    vendors = o.select(F.col("o_custkey").alias("Vendor_Number"), F.col("o_orderpriority").alias("Vendor_Name"))
    df, _ = add_detail(spend, {"Vendor": vendors}, ["Vendor_Number"], ["Vendor_Number"])
    return df


def category_details_dotted(spark, folder):
    """Category names for parts, under the dotted column names that dashboards use."""
    part = _t(spark, folder, "part")
    counts = part.groupBy(F.col("p_size").alias("Category.Number")).agg(F.count("*").alias("n"))
    named = part.select(F.col("p_size").alias("Category.Number"), F.col("p_brand").alias("Category.Name"))
    df, groups = add_detail(
        counts, {"Category": named}, ["Category.Number"], ["Category.Number"], keep_number=False, names={"Category": "Category.Number"}
    )
    return df.select(*[F.col(f"`{c}`").alias(c.replace(".", "_")) for c in [*groups, "n"]])


_CATEGORY_DOTTED_SQL = """select min(p_brand) as Category_Name, count(*) as n from part group by p_size"""


def days_filled(spark, folder):
    o = _t(spark, folder, "orders").join(_t(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    daily = o.filter("c_nationkey = 3").groupBy(_day("o_orderdate").alias("Date")).agg(
        F.count("*").alias("Bottles"), F.sum(F.col("o_totalprice").cast(MONEY)).alias("Total_Sales")
    )
    bounds = _t(spark, folder, "orders").agg(F.min(_day("o_orderdate")), F.max(_day("o_orderdate"))).first()
    spine = weekly.day_spine(spark, *bounds, weekends=False)
    return weekly.fill_calendar(daily, spine, ["Bottles", "Total_Sales"])


def semi_joined(spark, folder):
    red = _t(spark, folder, "part").filter(F.col("p_name").rlike("red|Red|RED")).select("p_partkey")
    line = _t(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return line.join(red, F.col("l_partkey") == F.col("p_partkey"), "left_semi")


def anti_joined(spark, folder):
    late = _t(spark, folder, "orders").filter(F.col("o_orderdate") >= F.lit(date(2001, 1, 1))).select("o_custkey")
    return _t(spark, folder, "customer").select("c_custkey").join(late, F.col("c_custkey") == F.col("o_custkey"), "left_anti")


# --- aggregations and reshaping ----------------------------------------------------------


def daily_occurrences(spark, folder):
    line = _t(spark, folder, "lineitem").select("l_suppkey", _day("l_shipdate").alias("day"), "l_returnflag")
    return history.daily_counts(line, "l_suppkey", "day", ["l_returnflag"])


def islands_collapsed(spark, folder):
    line = _t(spark, folder, "lineitem").select(F.col("l_suppkey").alias("k"), _day("l_shipdate").alias("d"), F.col("l_returnflag").alias("v"))
    marked = history.mark_islands(history.daily_dominant(line, "k", "d", ["v"]), ["k"], "d", "v")
    return history.collapse_islands(marked, ["k"], "d", "v")


_SUPP_DAILY = dominant_sql("select l_suppkey as k, cast(l_shipdate as date) as d, l_returnflag as v from lineitem", ["v"])
_SUPP_ISLANDS = f"""with x as materialized ({_SUPP_DAILY}),
    y as (select *, lag(d) over (partition by k order by d) as lag_order_dt, lag(v) over (partition by k order by d) as lag_value from x),
    z as (select *, case when lag_order_dt is null or lag_value <> v then 1 else 0 end as change_flag from y),
    i as (select *, cast(sum(change_flag) over (partition by k order by d) as bigint) as islands from z)"""


def invoices_rolled(spark, folder):
    line = _t(spark, folder, "lineitem")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"]
    return line.groupBy(*keys, _day("l_shipdate").alias("day")).agg(
        F.sum(F.col("l_quantity").cast("int")).alias("bottles_sold"), F.sum(F.col("l_extendedprice").cast(MONEY)).alias("total_sale")
    )


def county_names(spark, folder):
    feed = sales_feed(spark, folder, ["county_nbr", "county_name"]).filter(F.col("county_nbr").isNotNull())
    return feed.groupBy("county_nbr").agg(F.max(X.title_case(F.col("county_name"))).alias("county_name"))


def bounds_per_key(spark, folder):
    per = price_bands(spark, folder).groupBy("k").agg(F.max("start_dt").alias("max_start"), F.max("end_dt").alias("max_end"))
    top = _t(spark, folder, "part").agg(F.max("p_partkey")).scalar()
    return per.withColumn("max_key", top)


def distinct_days(spark, folder):
    return _t(spark, folder, "orders").select(_day("o_orderdate").alias("Date"), "o_orderstatus").distinct()


def priced_lines(spark, folder):
    """Order lines with market segment and nation: the fact behind the weekly reports."""
    o = _t(spark, folder, "orders").select("o_orderkey", "o_custkey", _day("o_orderdate").alias("Date"))
    c = _t(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    n = _t(spark, folder, "nation").select("n_nationkey", "n_name")
    line = _t(spark, folder, "lineitem").select(
        "l_orderkey", F.col("l_quantity").cast("int").alias("Bottles"), F.col("l_extendedprice").cast(MONEY).alias("Sales"),
        (F.col("l_extendedprice").cast(MONEY) * (1 - F.col("l_discount").cast("decimal(4,2)"))).alias("Cost"),
    )
    return (
        line.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(c, F.col("o_custkey") == F.col("c_custkey"))
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("Date", "c_mktsegment", "n_name", "Bottles", "Sales", "Cost")
    )


PRICED_SQL = """select cast(o_orderdate as date) as Date, c_mktsegment, n_name, cast(l_quantity as int) as Bottles,
    cast(l_extendedprice as decimal(18,2)) as Sales,
    cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2))) as Cost
    from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey"""
METRICS = {"Bottles": "Bottles", "Cost": "Cost", "Sales": "Sales"}


def weekly_by_segment(spark, folder):
    return weekly.weekly_totals(priced_lines(spark, folder), ["c_mktsegment"], "Date", METRICS)


_WEEKLY_SQL = f"""select c_mktsegment, {code_sql("Date")} as YrWk, min(Date) as Start_Date, max(Date) as End_Date,
    cast(sum(Bottles) as bigint) as Bottles, sum(Cost) as Cost, sum(Sales) as Sales, count(*) as Record_Count
    from ({PRICED_SQL}) p group by 1, 2"""


def pair_counts(spark, folder):
    return _t(spark, folder, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))


def sizes_by_frequency(spark, folder):
    return reshape.frequency(_t(spark, folder, "part"), "p_size")


def price_to_quantity(spark, folder):
    line = _t(spark, folder, "lineitem").join(_t(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return line.groupBy("p_size", "p_brand", "p_type").agg(
        F.round(F.sum(F.col("l_extendedprice").cast(MONEY)).cast("double") / F.count("*"), 9).alias("sold")
    )


def sums_by_month(spark, folder):
    p = priced_lines(spark, folder)
    return p.groupBy(F.year("Date").alias("yr"), F.month("Date").alias("mnth"), "n_name").agg(F.sum("Sales").alias("Sales"))


def flag_matrix(spark, folder):
    line = _t(spark, folder, "lineitem").select("l_suppkey", "l_returnflag", F.col("l_quantity").cast("int").alias("q"))
    return reshape.pivot_sum(line, ["l_suppkey"], "l_returnflag", "q", ["A", "N", "R"], fill=0, prefix="flag_")


def flag_metrics(spark, folder):
    line = _t(spark, folder, "lineitem").select(
        "l_suppkey", "l_linestatus", F.col("l_quantity").cast("int").alias("qty"), F.col("l_extendedprice").cast(MONEY).alias("amt")
    )
    return reshape.pivot_metrics(line, ["l_suppkey"], "l_linestatus", ["qty", "amt"], ["F", "O"])


_FLAG_METRICS_SQL = "select l_suppkey, " + ", ".join(
    f"coalesce(sum(case when l_linestatus = '{k}' then {e} end), 0) as {k}_{m}"
    for k in "FO"
    for m, e in (("amt", "cast(l_extendedprice as decimal(18,2))"), ("qty", "cast(l_quantity as int)"))
) + " from lineitem group by 1"


def metrics_unpivoted(spark, folder):
    line = _t(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("int")).alias("qty"), F.count("*").alias("n")
    )
    return reshape.unpivot(line, ["l_suppkey"], ["qty", "n"], "Metric", "Value")


WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def weekday_matrix(spark, folder):
    """Per week, which weekdays have orders of one customer group: 1 or missing."""
    days = (
        _t(spark, folder, "orders").filter("o_orderpriority = '1-URGENT' and o_orderstatus = 'P'")
        .select(_day("o_orderdate").alias("Date")).distinct()
    )
    marked = days.select(F.date_format("Date", "EEEE").alias("dof"), D.week_code(F.col("Date")).alias("wk"), F.lit(1).alias("counter"))
    return reshape.pivot_sum(marked, ["wk"], "dof", "counter", WEEKDAYS, prefix="dof_").filter("wk > 199501")


_WEEKDAY_SQL = f"""select {code_sql("d")} as wk, {", ".join(f"cast(sum(case when dayname(d) = '{w}' then 1 end) as bigint) as dof_{w}" for w in WEEKDAYS)}
    from (select distinct {_DAY} as d from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'P') x
    group by 1 having {code_sql("d")} > 199501"""


def weekday_coverage(spark, folder):
    return reshape.populated_share(weekday_matrix(spark, folder), [f"dof_{w}" for w in WEEKDAYS])


def weeks_by_year(spark, folder):
    w = weekly_by_segment(spark, folder)
    doubles = w.withColumns({m: F.col(m).cast("decimal(28,4)") for m in METRICS})
    return weekly.week_by_year(doubles, list(METRICS))


def date_bounds(spark, folder):
    o = _t(spark, folder, "orders").select(_day("o_orderdate").alias("d"))
    return o.agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"))


def years_present(spark, folder):
    o = _t(spark, folder, "orders").select(F.year(_day("o_orderdate")).alias("Yr"))
    return o.distinct().orderBy(F.desc("Yr"))


def price_histogram(spark, folder):
    h = reshape.histogram(_t(spark, folder, "orders").select("o_totalprice"), "o_totalprice", 30)
    return h.select("bin", F.round("bin_start", 4).alias("bin_start"), F.round("bin_end", 4).alias("bin_end"), "n")


_HISTOGRAM_SQL = """with b as (select min(o_totalprice) as lo, (max(o_totalprice) - min(o_totalprice)) / 30 as w from orders),
    h as (select cast(least(greatest(ceil((o_totalprice - lo) / w), 1), 30) as int) as bin, count(*) as n from orders, b group by 1)
    select cast(i as int) as bin, round(lo + w * (i - 1), 4) as bin_start, round(lo + w * i, 4) as bin_end, coalesce(n, 0) as n
    from range(1, 31) r(i), b left join h on bin = i"""

# --- year over year --------------------------------------------------------------------------


def _yoy(spark, folder, groups, **options):
    first, last = weekly.comparison_days(CURRENT)
    priced = priced_lines(spark, folder).filter(F.col("Date").between(F.lit(first), F.lit(last)))
    totals = weekly.weekly_totals(priced, groups, "Date", METRICS)
    report = weekly.year_over_year(totals, groups, CURRENT, list(METRICS), **options)
    ratios = [c for c in report.columns if c.endswith(("_PercD", "_MkShare", "_MkShareD"))]
    return report.withColumns({c: F.round(F.col(c).cast("double"), 5) for c in ratios})


def yoy_ytd(spark, folder):
    return _yoy(spark, folder, ["n_name", "c_mktsegment"])


def yoy_week(spark, folder):
    return _yoy(spark, folder, ["c_mktsegment"], ytd=False)


def yoy_total(spark, folder):
    return _yoy(spark, folder, [])


def yoy_sql(groups: list[str], where_cur: str, where_lag: str) -> str:
    keys = "".join(f"{g}, " for g in groups)
    sums = ", ".join(
        f"coalesce(sum(case when {w} then {m} end), 0) as {p}_{m}" for p, w in (("Cur", where_cur), ("L_52", where_lag)) for m in METRICS
    )
    parent = "partition by " + ", ".join(groups[:-1]) if len(groups) > 1 else ""
    share = {
        f"{p}_{m}": f"cast({p}_{m} as double) / nullif(sum(cast({p}_{m} as double)) over ({parent}), 0)" for p in ("Cur", "L_52") for m in METRICS
    }
    outs = [f"cast(Cur_{m} - L_52_{m} as {'bigint' if m == 'Bottles' else 'double'}) as {m}_Delta" for m in METRICS]
    outs += [f"round(cast(Cur_{m} as double) / nullif(cast(L_52_{m} as double), 0) - 1, 5) as {m}_PercD" for m in METRICS]
    outs += [f"round({e}, 5) as {n}_MkShare" for n, e in share.items()]
    outs += [f"round({share[f'Cur_{m}']} - {share[f'L_52_{m}']}, 5) as {m}_MkShareD" for m in METRICS]
    plain = ", ".join(f"cast({p}_{m} as {'bigint' if m == 'Bottles' else 'double'}) as {p}_{m}" for p in ("Cur", "L_52") for m in METRICS)
    by = f" group by {', '.join(groups)}" if groups else ""
    return (
        f"with s as (select {keys}{sums} from (select *, {code_sql('Date')} as w from ({PRICED_SQL}) p) q"
        f" where ({where_cur}) or ({where_lag}){by}) select {keys}{plain}, {', '.join(outs)} from s"
    )


_YTD = ("w between 200001 and 200024", "w between 199901 and 199924")
_WEEK = ("w = 200024", "w = 199924")


def star_sales(spark, folder, first: date | None = None, last: date | None = None) -> DataFrame:
    """Dated sales of the chosen items and stores, with the columns reports group by."""
    line = _t(spark, folder, "lineitem").withColumn("Date", _day("l_shipdate"))
    if first is not None:
        line = line.filter(F.col("Date") >= F.lit(first))
    if last is not None:
        line = line.filter(F.col("Date") <= F.lit(last))
    facts = line.select(
        "Date", F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"),
        F.col("l_extendedprice").cast(MONEY).alias("Sales"),
    )
    items = _t(spark, folder, "part").filter(all_in("p_type", ["PROMO", "SMALL", "LARGE"])).select("p_partkey", "p_type")
    stores = _t(spark, folder, "supplier").filter(all_in("s_nationkey", list(range(15)))).select("s_suppkey", "s_nationkey")
    return star_filter(facts, items, stores, "p_partkey", "s_suppkey")


STAR_SQL = """select cast(l_shipdate as date) as Date, p_type, s_nationkey, cast(l_extendedprice as decimal(18,2)) as Sales
    from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
    where p_type in ('PROMO', 'SMALL', 'LARGE') and s_nationkey < 15"""


def overview_table(spark, folder):
    """The dashboard's overview: years, star filter, weekly totals, comparison, chosen columns, wording."""
    facts = star_sales(spark, folder, *weekly.comparison_days(CURRENT))
    totals = weekly.weekly_totals(facts, ["p_type"], "Date", {"Sales": "Sales"})
    kept = totals.filter(in_years("YrWk", [CURRENT.year - 1, CURRENT.year]))
    report = weekly.year_over_year(kept, ["p_type"], CURRENT, ["Sales"])
    shown = R.drop_families(report, ["_Delta", "_PercD", "_MkShare", "_MkShareD"], keep=["_Delta"])
    return R.label_report(R.format_report(shown))


_OVERVIEW_SQL = f"""select p_type, '$ ' || format('{{:,}}', cast(round_even(cast(c as double), 0) as bigint)) as "Current YTD Sales",
    '$ ' || format('{{:,}}', cast(round_even(cast(l as double), 0) as bigint)) as "1 Yr Ago YTD Sales",
    '$ ' || format('{{:,}}', cast(round_even(cast(c - l as double), 0) as bigint)) as "Sales Diffrence" from
    (select p_type, coalesce(sum(case when {_YTD[0]} then Sales end), 0) as c, coalesce(sum(case when {_YTD[1]} then Sales end), 0) as l
    from (select *, {code_sql("Date")} as w from ({STAR_SQL}) p) q where {_YTD[0]} or {_YTD[1]} group by 1) s"""

# --- windows ---------------------------------------------------------------------------------


def dominant_flags(spark, folder):
    line = _t(spark, folder, "lineitem").select("l_partkey", _day("l_shipdate").alias("day"), "l_returnflag", "l_linestatus")
    return history.daily_dominant(line, "l_partkey", "day", ["l_returnflag", "l_linestatus"])


def lagged_flags(spark, folder):
    line = _t(spark, folder, "lineitem").select(F.col("l_suppkey").alias("k"), _day("l_shipdate").alias("d"), F.col("l_returnflag").alias("v"))
    return history.mark_islands(history.daily_dominant(line, "k", "d", ["v"]), ["k"], "d", "v").drop("occurance_count")


def neighbours(spark, folder):
    line = _t(spark, folder, "lineitem").select(F.col("l_suppkey").alias("k"), _day("l_shipdate").alias("d"), F.col("l_returnflag").alias("v"))
    return history.history_intervals(history.daily_dominant(line, "k", "d", ["v"]), ["k"], "d", "v")


def newest_bands(spark, folder):
    bands = price_bands(spark, folder).select("k", "v", F.col("start_dt").alias("Start_dt"), F.col("end_dt").alias("End_dt"))
    return newest(bands, "k")


def first_rows(spark, folder):
    o = _t(spark, folder, "orders").select("o_custkey", "o_orderpriority", "o_orderkey")
    return newest(o, "o_custkey", [F.col("o_custkey")])


def parent_shares(spark, folder):
    sums = priced_lines(spark, folder).groupBy("n_name", "c_mktsegment").agg(F.sum("Sales").alias("Sales"))
    shares = weekly.share_of_parent(sums, ["n_name"], {"Sales": "share"})
    return shares.withColumn("share", F.round(F.col("share").cast("double"), 5))


def relative_weeks(spark, folder):
    w = weekly_by_segment(spark, folder).select("c_mktsegment", "YrWk", F.col("Sales").cast("double").alias("Sales"))
    rel = relative_to_first(w, ["c_mktsegment"], remove_errors=False, columns=["Sales"])
    return rel.withColumn("Sales", F.round("Sales", 6))


def rolling_weeks(spark, folder):
    w = weekly_by_segment(spark, folder).select("c_mktsegment", "YrWk", F.col("Sales").cast("double").alias("Sales"))
    out = rolling_deviation(w, ["c_mktsegment"], {"sd": "Sales", "sd_odd": "Sales"}, 52)
    out = rolling_deviation(out, ["c_mktsegment"], {"sd_odd": "Sales"}, 5)
    return out.select("c_mktsegment", "YrWk", F.round("sd", 2).alias("sd"), F.round("sd_odd", 2).alias("sd_odd"))


# --- set operations --------------------------------------------------------------------------


def stacked_histories(spark, folder):
    o = _t(spark, folder, "orders").select(
        F.col("o_custkey").alias("k"), _day("o_orderdate").alias("d"), F.expr("nullif(o_orderpriority, '4-NOT SPECIFIED')").alias("v")
    )
    return history.stack_histories(history.daily_dominant(o, "k", "d", ["v"]), F.col("v").isNotNull())


_ORDER_DAILY = dominant_sql(f"select o_custkey as k, {_DAY} as d, nullif(o_orderpriority, '4-NOT SPECIFIED') as v from orders", ["v"])
_ORDER_COUNTED = f"""with c as (select o_custkey as k, {_DAY} as d, nullif(o_orderpriority, '4-NOT SPECIFIED') as v, count(*) as n
    from orders group by all), t as (select k, d, sum(n) as occurance_count from c group by all), x as ({_ORDER_DAILY})"""


def stacked_by_indicator(spark, folder):
    o = _t(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id_nbr"), F.md5("o_orderpriority").alias("id_hash"), _day("o_orderdate").alias("order_dt"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Y").otherwise("N").alias("null_indicator"),
    )
    return history.stack_nulls(o)


# --- report plans ------------------------------------------------------------------------------


def promo_by_day(spark, folder):
    line = _t(spark, folder, "lineitem").join(
        _t(spark, folder, "part").filter(F.col("p_name").rlike("red|blue")), F.col("l_partkey") == F.col("p_partkey")
    )
    return line.groupBy(_day("l_shipdate").alias("Date"), F.col("p_name").alias("Item_Description")).agg(
        F.sum(F.col("l_extendedprice").cast(MONEY)).alias("Sales")
    )


MONTHS_FROM = date(1999, 8, 31)


def store_months(spark, folder, since: date = MONTHS_FROM):
    """Sales of each customer per month from a day on, one column for each month that has any."""
    o = _t(spark, folder, "orders").filter(F.col("o_orderdate") >= F.lit(since))
    # The pivot sums, so the sums per month need no aggregation (and shuffle) of their own.
    sales = o.select("o_custkey", F.date_format("o_orderdate", "yyyyMM").alias("Date"), F.col("o_totalprice").cast(MONEY).alias("Sales"))
    return reshape.pivot_sum(sales, ["o_custkey"], "Date", "Sales", reshape.pivot_values(sales, "Date"), fill=0, prefix="m")


def store_month_cells(spark, folder):
    """The pivot's cells, a row for each customer and month."""
    wide = store_months(spark, folder)
    cells = reshape.unpivot(wide, ["o_custkey"], [c for c in wide.columns if c != "o_custkey"], "m", "s")
    return cells.select("o_custkey", F.col("m").substr(2, 6).alias("m"), F.col("s").cast("double").alias("s"))


def store_months_total(spark, folder):
    """The pivot's grand total: what all orders since the day sum up to."""
    wide = store_months(spark, folder)
    months = [c for c in wide.columns if c != "o_custkey"]
    return wide.select(sum((F.col(c) for c in months[1:]), F.col(months[0])).alias("s")).agg(
        F.sum("s").cast("double").alias("total"), F.count("*").alias("customers")
    )


_SINCE = f"from orders where o_orderdate >= date '{MONTHS_FROM}'"
_STORE_MONTHS_TOTAL_SQL = f"""select cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total,
    count(distinct o_custkey) as customers {_SINCE}"""
#: A row per customer and month, zeros included: what the wide table holds, for checks over all its columns.
MONTH_CELLS_SQL = f"""select c.o_custkey, m.m, coalesce(s, 0) as s from (select distinct o_custkey {_SINCE}) c
    cross join (select distinct strftime(o_orderdate, '%Y%m') as m {_SINCE}) m
    left join (select o_custkey, strftime(o_orderdate, '%Y%m') as m, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as s
        {_SINCE} group by 1, 2) x on x.o_custkey = c.o_custkey and x.m = m.m"""


def item_months(spark, folder):
    """Bottles per year and month of a set of items, one column per month of the year."""
    line = _t(spark, folder, "lineitem").filter(F.col("l_partkey").isin(10, 22, 23, 25, 59))
    sold = line.select(F.year("l_shipdate").alias("yr"), F.month("l_shipdate").alias("mnth"), F.col("l_quantity").cast("int").alias("Sold"))
    return reshape.pivot_sum(sold, ["yr"], "mnth", "Sold", list(range(1, 13)), prefix="mnthMnth")


_ITEM_MONTHS_SQL = "select cast(year(l_shipdate) as int) as yr, " + ", ".join(
    f"cast(sum(case when month(l_shipdate) = {m} then cast(l_quantity as int) end) as bigint) as mnthMnth{m}" for m in range(1, 13)
) + " from lineitem where l_partkey in (10, 22, 23, 25, 59) group by 1"


def usable_days(spark, folder):
    """Dominant values that carry information: both parts known, the key not null."""
    line = _t(spark, folder, "lineitem").select(
        F.expr("nullif(l_suppkey, 1)").alias("k"), _day("l_shipdate").alias("d"), F.expr("nullif(l_returnflag, 'N')").alias("a"),
        F.expr("nullif(l_linestatus, 'O')").alias("b"),
    )
    daily = history.daily_dominant(line, "k", "d", ["a", "b"])
    return daily.filter(F.col("a").isNotNull() & F.col("b").isNotNull()).drop("occurance_count")


_USABLE_SQL = "select k, cast(d as varchar) as d, a, b from (" + dominant_sql(
    "select nullif(l_suppkey, 1) as k, cast(l_shipdate as date) as d, nullif(l_returnflag, 'N') as a, nullif(l_linestatus, 'O') as b"
    " from lineitem",
    ["a", "b"],
) + ") x where a is not null and b is not null"


def bands_flagged(spark, folder):
    return price_bands(spark, folder).withColumn("current_record", history.current_flag(F.col("end_dt")))


QUERIES = {
    "p08_p09_usable_days": (usable_days, _USABLE_SQL),
    "p12_current_flag": (
        bands_flagged,
        f"with {_BANDS_SQL} select k, v, cast(start_dt as varchar) as start_dt, cast(end_dt as varchar) as end_dt,"
        " case when end_dt = date '2999-12-31' then 'Y' else 'N' end as current_record from bands",
    ),
    "j01_interval_join": (
        flag_in_force,
        f"with {_BANDS_SQL} select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(cast(l_shipdate as date) as varchar) as day, v"
        " from lineitem left join bands on k = l_partkey and start_dt <= cast(l_shipdate as date) and end_dt >= cast(l_shipdate as date)",
    ),
    "j02_overlap_join": (
        overlapping_bands,
        f"with {_spans_sql('l_returnflag', 'a')}, {_spans_sql('l_linestatus', 'b')}"
        " select a.k, cast(a.f as varchar) as start_dt, a.v as l_returnflag, cast(b.f as varchar) as f, b.v as l_linestatus"
        " from a left join b on a.k = b.k and a.f <= b.t and a.t >= b.f",
    ),
    "j04_current_rows": (
        current_rows_joined,
        f"with {_BANDS_SQL} select p_partkey, v from part left join bands on k = p_partkey and end_dt = date '2999-12-31'",
    ),
    "j05_left_join": (
        county_joined,
        "select c_custkey, n_name from customer left join nation on c_nationkey = n_nationkey and n_regionkey <> 4",
    ),
    "j06_numbered_after_max": (numbered_after_max, _NUMBERED_SQL),
    "j07_star_filter": (
        star_filtered,
        "select l_orderkey, l_linenumber, p_partkey, s_suppkey, l_quantity, p_name, s_name from lineitem"
        " join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey"
        " where p_type in ('PROMO', 'SMALL') and s_nationkey in (1, 2, 3, 4, 5)",
    ),
    "j08_details": (
        details_added,
        retyped(
            f"with {_BANDS_SQL}, {_spans_sql('l_returnflag', 'sb')}, s as (select l_partkey, l_suppkey,"
            f" sum({_DEC.format('l_extendedprice')}) as x from lineitem group by 1, 2)"
            " select bands.v as Item_Description, sb.v as Store_Name, sum(x) as Sales, count(*) as n from s join bands"
            " on bands.k = l_partkey and end_dt = date '2999-12-31' join sb on sb.k = l_suppkey and sb.t = date '2999-12-31'"
            " group by 1, 2",
            double=["Sales"],
        ),
    ),
    "j08_vendor_details": (
        vendor_and_category_details,
        "select o_custkey as Vendor_Number, count(*) as n, min(o_orderpriority) as Vendor_Name from orders group by 1",
    ),
    "j08_category_details_dotted": (category_details_dotted, _CATEGORY_DOTTED_SQL),
    "j09_calendar_join": (
        days_filled,
        retyped(
            f"""with d as (select cast(range as date) as Date from range(
                (select min({_DAY}) from orders), (select max({_DAY}) + interval 1 day from orders), interval 1 day)),
            s as (select {_DAY} as Date, count(*) as b, sum({_DEC.format("o_totalprice")}) as t from orders join customer
                on o_custkey = c_custkey where c_nationkey = 3 group by 1)
            select d.Date, coalesce(b, 0) as Bottles, coalesce(t, 0) as Total_Sales, dayname(d.Date) as wkday,
                {week_sql("d.Date")} as wk, cast(year(d.Date) as int) as yr from d left join s on s.Date = d.Date
            where dayname(d.Date) not in ('Saturday', 'Sunday')""",
            ["Date"], ["Total_Sales"],
        ),
    ),
    "j10_semi_join": (
        semi_joined,
        "select l_orderkey, l_linenumber, l_partkey from lineitem where l_partkey in"
        " (select p_partkey from part where regexp_matches(p_name, 'red|Red|RED'))",
    ),
    "j11_anti_join": (
        anti_joined,
        "select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_orderdate >= date '2001-01-01')",
    ),
    "a01_daily_counts": (
        daily_occurrences,
        "select l_suppkey, cast(cast(l_shipdate as date) as varchar) as day, l_returnflag, count(*) as orig_occurance_count"
        " from lineitem group by 1, 2, 3",
    ),
    "a02_islands_collapsed": (
        islands_collapsed,
        f"{_SUPP_ISLANDS} select k, islands, v, cast(min(d) as varchar) as orig_start_dt, cast(max(d) as varchar) as orig_end_dt"
        " from i group by 1, 2, 3",
    ),
    "a03_invoice_rollup": (
        invoices_rolled,
        "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,"
        " cast(cast(l_shipdate as date) as varchar) as day, cast(sum(cast(l_quantity as int)) as bigint) as bottles_sold,"
        f" cast(sum({_DEC.format('l_extendedprice')}) as double) as total_sale from lineitem group by 1, 2, 3, 4, 5, 6, 7",
    ),
    "a04_county_names": (
        county_names,
        f"select county_nbr, max({title_sql('county_name')}) as county_name from ({sales_feed_sql(['county_nbr', 'county_name'])}) f"
        " where county_nbr is not null group by 1",
    ),
    "a05_bounds_per_key": (
        bounds_per_key,
        f"with {_BANDS_SQL} select k, cast(max(start_dt) as varchar) as max_start, cast(max(end_dt) as varchar) as max_end,"
        " (select max(p_partkey) from part) as max_key from bands group by 1",
    ),
    "a06_distinct_days": (distinct_days, f"select distinct cast({_DAY} as varchar) as Date, o_orderstatus from orders"),
    "a07_weekly_totals": (weekly_by_segment, retyped(_WEEKLY_SQL, ["Start_Date", "End_Date"], ["Cost", "Sales"])),
    "a08_pair_counts": (pair_counts, "select p_brand, p_type, count(*) as n from part group by 1, 2"),
    "a09_frequencies": (sizes_by_frequency, "select p_size, count(*) as n from part group by 1 order by 2, 1"),
    "a10_price_ratio": (
        price_to_quantity,
        f"select p_size, p_brand, p_type, round(cast(sum({_DEC.format('l_extendedprice')}) as double) / count(*), 9) as sold"
        " from lineitem join part on l_partkey = p_partkey group by 1, 2, 3",
    ),
    "a11_month_sums": (
        sums_by_month,
        f"select cast(year(Date) as int) as yr, cast(month(Date) as int) as mnth, n_name, cast(sum(Sales) as double) as Sales"
        f" from ({PRICED_SQL}) p group by 1, 2, 3",
    ),
    "a12_pivot": (
        flag_matrix,
        "select l_suppkey, " + ", ".join(
            f"cast(coalesce(sum(case when l_returnflag = '{k}' then cast(l_quantity as int) end), 0) as bigint) as flag_{k}" for k in "ANR"
        ) + " from lineitem group by 1",
    ),
    "a13_pivot_metrics": (
        flag_metrics, retyped(_FLAG_METRICS_SQL, double=["F_amt", "O_amt"], bigint=["F_qty", "O_qty"])
    ),
    "a14_unpivot": (
        metrics_unpivoted,
        "select l_suppkey, 'qty' as Metric, cast(sum(cast(l_quantity as int)) as bigint) as Value from lineitem group by 1"
        " union all select l_suppkey, 'n', count(*) from lineitem group by 1",
    ),
    "a15_populated_share": (
        weekday_coverage,
        "select " + ", ".join(f"round(coalesce(sum(dof_{w}), 0) / count(*), 2) as dof_{w}" for w in WEEKDAYS) + f" from ({_WEEKDAY_SQL}) m",
    ),
    "a16_week_by_year": (
        weeks_by_year,
        " union all ".join(
            f"select cast(w % 100 as int) as Wk, cast(w // 100 as int) as Yr, '{m}' as Metric, cast(sum({m}) as double) as Value"
            f" from (select *, {code_sql('Date')} as w from ({PRICED_SQL}) p) q group by 1, 2"
            for m in METRICS
        ),
    ),
    "a17_date_bounds": (
        date_bounds, f"select cast(min({_DAY}) as varchar) as first_day, cast(max({_DAY}) as varchar) as last_day from orders"
    ),
    "a17_years": (years_present, "select distinct cast(year(o_orderdate) as int) as Yr from orders order by 1 desc"),
    "a18_yoy_ytd": (yoy_ytd, yoy_sql(["n_name", "c_mktsegment"], *_YTD)),
    "a18_yoy_week": (yoy_week, yoy_sql(["c_mktsegment"], *_WEEK)),
    "a18_yoy_total": (yoy_total, yoy_sql([], *_YTD)),
    "a19_histogram": (price_histogram, _HISTOGRAM_SQL),
    "w01_dominant_value": (
        dominant_flags,
        retyped(
            "select l_partkey, d as day, l_returnflag, l_linestatus, cast(t as bigint) as occurance_count from (select *, sum(n)"
            " over (partition by l_partkey, d) as t, row_number() over (partition by l_partkey, d order by n desc, l_returnflag,"
            " l_linestatus) as r from (select l_partkey, cast(l_shipdate as date) as d, l_returnflag, l_linestatus, count(*) as n"
            " from lineitem group by 1, 2, 3, 4) c) x where r = 1",
            ["day"],
        ),
    ),
    "w03_lag_and_islands": (
        lagged_flags,
        f"{_SUPP_ISLANDS} select k, cast(d as varchar) as d, v, cast(lag_order_dt as varchar) as lag_order_dt, lag_value,"
        " change_flag, islands from i",
    ),
    "w05_lead_and_bounds": (
        neighbours,
        retyped(
            f"{_SUPP_ISLANDS}, g as (select k, islands, v, min(d) as orig_start_dt, max(d) as orig_end_dt from i group by 1, 2, 3),"
            " h as (select *, lead(orig_start_dt) over (partition by k order by orig_start_dt) as lead_start,"
            " lag(orig_end_dt) over (partition by k order by orig_start_dt) as lag_end from g)"
            " select *, case when lag_end is null then date '0001-01-01' else orig_start_dt end as start_dt,"
            " coalesce(lead_start - 1, date '2999-12-31') as end_dt from h",
            ["orig_start_dt", "orig_end_dt", "lead_start", "lag_end", "start_dt", "end_dt"],
        ),
    ),
    "w07_newest_row": (
        newest_bands,
        f"with {_BANDS_SQL} select k, v, cast(start_dt as varchar) as Start_dt, cast(end_dt as varchar) as End_dt from bands"
        " qualify row_number() over (partition by k order by end_dt desc, start_dt desc) = 1",
    ),
    "w08_first_row": (
        first_rows,
        "select o_custkey, o_orderpriority, o_orderkey from orders"
        " qualify row_number() over (partition by o_custkey order by o_orderpriority, o_orderkey) = 1",
    ),
    "w09_parent_share": (
        parent_shares,
        f"select n_name, c_mktsegment, cast(s as double) as Sales, round(cast(s as double) / cast(sum(s) over (partition by n_name) as double), 5)"
        f" as share from (select n_name, c_mktsegment, sum(Sales) as s from ({PRICED_SQL}) p group by 1, 2) x",
    ),
    "w10_relative_to_first": (
        relative_weeks,
        f"select c_mktsegment, YrWk, round(cast(Sales as double) / first_value(cast(Sales as double)) over"
        f" (partition by c_mktsegment order by YrWk), 6) as Sales from ({_WEEKLY_SQL}) w",
    ),
    "w11_rolling_deviation": (
        rolling_weeks,
        "select c_mktsegment, YrWk, round(stddev_samp(x) over (partition by c_mktsegment order by YrWk rows between 25 preceding and"
        " 26 following), 2) as sd, round(stddev_samp(x) over (partition by c_mktsegment order by YrWk rows between 2 preceding and"
        f" 2 following), 2) as sd_odd from (select c_mktsegment, YrWk, cast(Sales as double) as x from ({_WEEKLY_SQL}) w) y",
    ),
    "u01_stacked_histories": (
        stacked_histories,
        retyped(
            f"{_ORDER_COUNTED} select k, d, v, occurance_count, 'Y' as null_incld from x join t using (k, d) union all"
            " select k, d, v, occurance_count, 'N' from x join t using (k, d) where v is not null",
            ["d"], bigint=["occurance_count"],
        ),
    ),
    "u02_stacked_by_indicator": (
        stacked_by_indicator,
        f"with x as (select o_orderkey as id_nbr, md5(o_orderpriority) as id_hash, cast({_DAY} as varchar) as order_dt, o_orderpriority as p"
        " from orders) select id_nbr, id_hash, order_dt, 'Y' as null_incld from x union all"
        " select id_nbr, id_hash, order_dt, 'N' from x where p <> '4-NOT SPECIFIED'",
    ),
    "d10_promo_by_day": (
        promo_by_day,
        f"select cast(cast(l_shipdate as date) as varchar) as Date, p_name as Item_Description,"
        f" cast(sum({_DEC.format('l_extendedprice')}) as double) as Sales from lineitem join part on l_partkey = p_partkey"
        " where regexp_matches(p_name, 'red|blue') group by 1, 2",
    ),
    "d11_weekday_matrix": (weekday_matrix, _WEEKDAY_SQL),
    "d12_store_months": (store_month_cells, MONTH_CELLS_SQL),
    "d12_store_months_total": (store_months_total, _STORE_MONTHS_TOTAL_SQL),
    "d13_item_months": (item_months, _ITEM_MONTHS_SQL),
    "d15_overview": (overview_table, _OVERVIEW_SQL),
}
