"""Registered queries: sources, sinks, projections and filters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import dates as D
from ledgerline.functions import formats as R
from ledgerline.functions import text as X
from ledgerline.operators import reshape
from ledgerline.operators.filters import all_in, in_years, value_list
from ledgerline.plans.feed import FEED_COLUMNS, sales_feed, sales_feed_sql
from ledgerline.plans.sqlforms import code_sql, retyped, title_sql, week_sql
from ledgerline.plans.warehouse import INVOICE_COLUMNS, MONEY, gallons, invoice_rows
from ledgerline.session import scratch_path, write_stage
from ledgerline.sources import sinks
from ledgerline.sources.tables import (
    SALES_FEED,
    key_violations,
    load_csv,
    load_csv_head,
    load_lookups,
    load_parquet,
    non_numeric_keys,
    parse_day,
)

CUTOFF = date(2000, 1, 1)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return load_parquet(spark, folder, name)


def _write_csv(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).option("escape", '"').csv(path)
    return path


# --- sources and sinks ---------------------------------------------------------------------


def csv_load(spark, folder):
    path = _write_csv(sales_feed(spark, folder), "feed-csv")
    return load_csv(spark, path, SALES_FEED)[0]


def csv_rejects(spark, folder):
    """A feed whose dates are unreadable on some lines: good and rejected lines per return flag."""
    lines = _table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_linestatus") == "O", "no date").otherwise(F.col("l_shipdate").cast("date").cast("string")).alias("day"),
        "l_returnflag",
    )
    schema = T.StructType(
        [
            T.StructField("l_orderkey", T.LongType()),
            T.StructField("day", T.DateType()),
            T.StructField("l_returnflag", T.StringType()),
        ]
    )
    good, bad = load_csv(spark, _write_csv(lines, "reject-csv"), schema)
    sides = [
        side.groupBy("l_returnflag").agg(F.count("*").alias("n")).withColumn("side", F.lit(name))
        for side, name in ((good, "good"), (bad, "rejected"))
    ]
    return sides[0].unionByName(sides[1])


def csv_head_typed(spark, folder):
    wanted = ["item_invoice_nbr", "zip_code", "item_nbr", "bottles_sold"]
    schema = T.StructType(
        [
            T.StructField("item_invoice_nbr", T.StringType()),
            T.StructField("zip_code", T.IntegerType()),
            T.StructField("item_nbr", T.IntegerType()),
            T.StructField("bottles_sold", T.IntegerType()),
        ]
    )
    path = _write_csv(sales_feed(spark, folder, wanted), "head-csv")
    return load_csv_head(spark, path, schema, {"zip_code": "string", "item_nbr": "string"}, rows=None)


_LOOKUPS = {"part": "p_partkey", "supplier": "s_suppkey", "customer": "c_custkey", "nation": "n_nationkey"}


def lookup_tables(spark, folder):
    frames = {n: _table(spark, folder, n) for n in _LOOKUPS}
    paths = {n: _write_csv(df, f"{n}-csv") for n, df in frames.items()}
    loaded = load_lookups(spark, paths, {n: df.schema for n, df in frames.items()})
    parts = [
        loaded[n].agg(F.lit(n).alias("name"), F.count("*").alias("n"), F.sum(F.col(k).cast("long")).alias("keys"))
        for n, k in _LOOKUPS.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def day_parsed(spark, folder):
    text = _table(spark, folder, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("Date"))
    return parse_day(text, "Date")


def invoice_key_violations(spark, folder):
    return key_violations(sales_feed(spark, folder, ["item_invoice_nbr"]), ["item_invoice_nbr"])


def order_key_violations(spark, folder):
    return key_violations(_table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"])


def staged_base(spark, folder):
    base = _table(spark, folder, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count("*").alias("n"))
    return write_stage(base, "base").groupBy("l_suppkey").agg(F.max("n").alias("most"), F.sum("n").alias("total"))


def _orders_split(spark, folder):
    o = _table(spark, folder, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    return o.filter(F.col("day") < F.lit(CUTOFF)), o.filter(F.col("day") >= F.lit(CUTOFF))


def appended_orders(spark, folder):
    before, after = _orders_split(spark, folder)
    return sinks.append_rows(before, after)


def details_inserted(spark, folder):
    """Parts already known by their use before the cutoff, then every part used at all inserted if absent."""
    line = _table(spark, folder, "lineitem")
    known = line.filter(F.col("l_shipdate") < F.lit(CUTOFF)).select("l_partkey").distinct().withColumn("origin", F.lit("old"))
    used = line.select("l_partkey").withColumn("origin", F.lit("new"))
    return sinks.insert_absent(known, used, ["l_partkey"])


def orders_upserted(spark, folder):
    feed = sales_feed(spark, folder, INVOICE_COLUMNS)
    old = invoice_rows(feed.filter(F.col("order_dt") < F.lit(CUTOFF)))
    new = invoice_rows(feed.filter(F.col("order_dt") >= F.lit(CUTOFF)))
    return sinks.upsert(old, new, ["item_invoice_nbr"])


def orders_upserted_in_parts(spark, folder):
    """The same over a table written in parts by month, with a batch that moves some invoices to another month."""
    rows = write_stage(invoice_rows(sales_feed(spark, folder, INVOICE_COLUMNS)), "invoices")
    root, key, part = scratch_path(spark, "orders"), ["item_invoice_nbr"], sinks.month_part("order_date")
    parts = sinks.upsert_parts(rows, root, {}, key, part)
    moved = rows.filter((F.month("order_date") == 3) & (F.col("store_nbr") % 5 == 0))
    moved = write_stage(moved.withColumn("order_date", F.date_add("order_date", 31)), "moved")
    return sinks.read_parts(spark, root, sinks.upsert_parts(moved, root, parts, key, part), rows.schema)


def invoice_sql(where: str = "true") -> str:
    return (
        "select item_invoice_nbr, order_dt as order_date, cast(state_bottle_cost as decimal(18,2)) as state_bottle_cost,"
        " cast(state_bottle_retail as decimal(18,2)) as state_bottle_retail, sum(bottles_sold) as bottles_sold,"
        " sum(cast(sale as decimal(18,2))) as total_sale,"
        " try_cast(regexp_replace(item_nbr, '[^0-9]+', '', 'g') as int) as item_nbr, vendor_nbr, store_nbr"
        f" from ({sales_feed_sql(INVOICE_COLUMNS)}) f where {where}"
        " group by item_invoice_nbr, order_dt, f.state_bottle_cost, f.state_bottle_retail,"
        " regexp_replace(item_nbr, '[^0-9]+', '', 'g'), vendor_nbr, store_nbr"
    )


INVOICE_DOUBLES = ["state_bottle_cost", "state_bottle_retail", "total_sale"]


# --- projections and filters -------------------------------------------------------------


def names_title(spark, folder):
    return _table(spark, folder, "supplier").select(
        "s_suppkey", X.title_case(F.concat(F.lit("  o'brien_"), "s_name", F.lit("-x hy-vee 3rd/ "))).alias("title")
    )


def names_proper(spark, folder):
    return _table(spark, folder, "part").select(
        "p_partkey", X.proper_case(F.concat("p_name", F.lit(" o'neil_a 3rd-"), "p_type")).alias("proper")
    )


def item_digits(spark, folder):
    feed = sales_feed(spark, folder, ["item_invoice_nbr", "item_nbr"])
    return feed.select("item_invoice_nbr", X.digits_to_int(F.col("item_nbr")).alias("item_nbr"))


def item_digit_rejects(spark, folder):
    """Texts without a usable number: brand names have one, part types and some names do not."""
    names = _table(spark, folder, "part").select("p_partkey", F.explode(F.array("p_brand", "p_type", "p_name")).alias("raw"))
    return names.filter(X.digits_to_int(F.col("raw")).isNull()).groupBy("raw").agg(F.count("*").alias("n"))


def odd_item_numbers(spark, folder):
    return non_numeric_keys(sales_feed(spark, folder, ["item_nbr", "item_desc"]), "item_nbr", "item_desc", also=["1"])


def store_points(spark, folder):
    feed = sales_feed(spark, folder, ["item_invoice_nbr", "store_location"])
    loc = F.col("store_location")
    return feed.select("item_invoice_nbr", X.point_part(loc, 1).alias("lat"), X.point_part(loc, 2).alias("long"))


_STORE_RAW = ["store_nbr", "store_name", "store_address", "store_city", "zip_code", "county_nbr", "store_location"]


def store_hashes(spark, folder):
    loc = F.col("store_location")
    feed = sales_feed(spark, folder, _STORE_RAW).distinct()
    parts = feed.withColumns(
        {c: X.title_case(F.col(c)) for c in ("store_name", "store_address", "store_city")}
        | {"lat": X.point_part(loc, 1), "long": X.point_part(loc, 2)}
    )
    return parts.select(
        "store_nbr", X.row_hash(X.STORE_HASH_PARTS).alias("store_hash"),
        F.length(X.row_hash(X.STORE_HASH_PARTS, compat=False)).alias("keyed_length"),
    )


STORE_HASH_SQL = (
    "md5(coalesce(substr(cast(store_nbr as varchar), 1, 6), '0') || coalesce(store_name, 'Null') ||"
    " coalesce(store_address, 'Null') || coalesce(store_city, 'Null') || coalesce(zip_code, '-99999') ||"
    " coalesce(substr(cast(county_nbr as varchar), 1, 6), '-99') || coalesce(lat, '-999.0') || coalesce(long, '-999.0'))"
)
ITEM_HASH_SQL = (
    "md5(substr(cast(item_nbr as varchar), 1, 10) || coalesce(item_desc, 'null') ||"
    " coalesce(substr(cast(category_nbr as varchar), 1, 10), '-99') ||"
    " coalesce(substr(cast(items_per_pack as varchar), 1, 6), '-1') ||"
    " coalesce(substr(cast(item_vol as varchar), 1, 7), '-750'))"
)
_POINT_SQL = "split_part(coalesce(regexp_replace(trim(store_location), '(POINT\\s\\()|\\)', '', 'g'), '0.0 0.0'), ' ', {})"


def store_parts_sql(source: str, extra: str = "") -> str:
    """Cleaned store columns of a feed query."""
    return (
        f"select store_nbr, {title_sql('store_name')} as store_name, {title_sql('store_address')} as store_address,"
        f" {title_sql('store_city')} as store_city, zip_code, county_nbr, {_POINT_SQL.format(1)} as lat,"
        f" {_POINT_SQL.format(2)} as long{extra} from ({source}) f"
    )


def item_hashes(spark, folder):
    feed = sales_feed(spark, folder, ["item_nbr", "item_desc", "category_nbr", "pack", "bottle_vol"]).distinct()
    parts = feed.select(
        X.digits_to_int(F.col("item_nbr")).alias("item_nbr"), X.title_case(F.col("item_desc")).alias("item_desc"),
        "category_nbr", F.col("pack").alias("items_per_pack"), F.col("bottle_vol").alias("item_vol"),
    )
    return parts.select("item_nbr", X.row_hash(X.ITEM_HASH_PARTS).alias("item_hash"))


def item_parts_sql(source: str, extra: str = "") -> str:
    return (
        "select try_cast(regexp_replace(item_nbr, '[^0-9]+', '', 'g') as int) as item_nbr,"
        f" {title_sql('item_desc')} as item_desc, category_nbr, pack as items_per_pack, bottle_vol as item_vol{extra}"
        f" from ({source}) f where item_nbr is not null"
    )


def money_amounts(spark, folder):
    line = _table(spark, folder, "lineitem")
    return line.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").cast(MONEY).alias("total_sale"),
        F.col("l_tax").cast(MONEY).alias("tax"),
    )


def unit_profits(spark, folder):
    feed = sales_feed(spark, folder, INVOICE_COLUMNS)
    o = invoice_rows(feed)
    return o.select(
        "item_invoice_nbr", "order_date", "item_nbr", "store_nbr",
        (F.col("state_bottle_retail") - F.col("state_bottle_cost")).alias("state_bottle_profit"),
        (F.col("total_sale") - F.col("state_bottle_cost") * F.col("bottles_sold")).alias("total_profit"),
    )


def volumes(spark, folder):
    feed = sales_feed(spark, folder, ["item_invoice_nbr", "item_nbr", "order_dt", "bottles_sold", "bottle_vol"])
    volume = F.col("bottles_sold").cast("long") * F.coalesce("bottle_vol", F.lit(0))
    return feed.select(
        "item_invoice_nbr", "item_nbr", "order_dt", volume.alias("total_volume"),
        F.round(gallons(volume), 6).alias("total_volume_gallons"),
    )


# Drink names put behind the part type, picked by part size, to have categories to group.
_DRINKS = [
    "Spiced Rums", "Vodka 80 Proof", "Flavored Vodka", "American Dry Gins", "100% Agave Tequila", "Mezcal",
    "Canadian Whiskies", "American Brandies", "Cream & Herb Liqueurs", "Cocktails/RTD", "Peach Schnapps",
    "Neutral Grain Spirits", "Temporary & Specialty Packages", "Straight Bourbon", "Single Malt Scotch", "Triple Sec",
    "Imported Amaretto",
]


def _drink_spark():
    names = F.array(*[F.lit(d) for d in _DRINKS])
    return F.element_at(names, (F.col("p_size") % len(_DRINKS) + 1).cast("int"))


def category_groups(spark, folder):
    name = F.concat(F.initcap(F.lower("p_type")), F.lit(" "), _drink_spark())
    parts = _table(spark, folder, "part").select("p_partkey", _drink_spark().alias("plain"), name.alias("full_name"))
    return parts.select(
        "p_partkey", "full_name", X.category_group(F.col("plain")).alias("cat_group"),
        X.category_group(F.col("full_name")).alias("typed_group"),
        X.category_group(F.col("full_name"), match="search").alias("searched_group"),
    )


def _category_sql(x: str, search: bool = False) -> str:
    test = "regexp_matches" if search else "regexp_full_match"
    whens = " ".join(f"when {test}({x}, '{p}') then '{g}'" for p, g in X.CATEGORY_RULES)
    return f"case {whens} else 'other' end"


_BAD_JSON = ["aaa", "", "{", '{"a":1} x', "1,2", "1],[2", '{"a":}', "[1,]"]


def json_validity(spark, folder):
    """Event properties as they are, and with text added that breaks them in several ways."""
    tails = F.array(*[F.lit(s) for s in ["", " x", ",1", "}", " ", "],[1"]])
    events = _table(spark, folder, "events").select("event_id", F.posexplode(tails).alias("kind", "tail"), "props")
    text = F.concat("props", "tail")
    with X.repeated_json_keys(spark):
        return events.select("event_id", F.col("kind").cast("int").alias("kind"), X.is_valid_json(text).alias("valid"))


def json_valid_counts(spark, folder):
    """Which columns of several tables hold JSON."""
    sources = {"events": "props", "documents": "text", "pages": "html", "conversations": "text"}
    out = None
    for name, c in sources.items():
        with X.repeated_json_keys(spark):
            one = _table(spark, folder, name).agg(
                F.lit(name).alias("name"), F.count("*").alias("n"), F.count_if(X.is_valid_json(F.col(c))).alias("valid")
            )
        out = one if out is None else out.unionByName(one)
    return out


def regex_filtered(spark, folder):
    part = _table(spark, folder, "part")
    return part.filter(X.contains_any(F.col("p_name"), ["red", "Red", "blue"])).select("p_partkey", "p_name")


def list_and_range_filters(spark, folder):
    o = _table(spark, folder, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    return o.filter(
        F.col("o_orderstatus").isin("O", "F")
        & F.col("day").between(F.lit(date(1999, 1, 1)), F.lit(date(2000, 1, 14)))
        & (F.col("o_totalprice") > 1000)
    ).select("o_orderkey", "day", "o_orderstatus")


def dynamic_filter(spark, folder):
    keep = all_in("p_type", ["PROMO", "LARGE"], "p_brand", [], None, ["x"], "p_size", [1], "p_size", [10, 20, 30])
    return _table(spark, folder, "part").filter(keep).select("p_partkey", "p_type", "p_size")


def year_filter(spark, folder):
    o = _table(spark, folder, "orders").select("o_orderkey", D.week_code(F.col("o_orderdate").cast("date")).alias("YrWk"))
    return o.filter(in_years("YrWk", [1998, 2000]))


def calendar_parts(spark, folder):
    o = _table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return o.select("o_orderkey", *[c.alias(n) for n, c in D.date_parts(F.col("d")).items()])


def week_codes(spark, folder):
    o = _table(spark, folder, "orders").select("o_orderkey", D.week_code(F.col("o_orderdate").cast("date")).alias("YrWk"))
    return o.select("o_orderkey", "YrWk", D.code_year(F.col("YrWk")).alias("Yr"), D.code_week(F.col("YrWk")).alias("Wk"))


def week_ends(spark, folder):
    o = _table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return o.select("o_orderkey", D.week_end(day=F.col("d")).alias("last_day"), D.week_end(code=D.week_code(F.col("d"))).alias("from_code"))


def offsets_normalized(spark, folder):
    c = _table(spark, folder, "customer")
    k = F.col("c_custkey").cast("int")
    o = D.normalize_offset(k - 700, (k * 7) % 211 - 100, k % 29 - 14, k % 5)
    return c.select("c_custkey", *[o[f].alias(f) for f in ("day", "week", "month", "year")])


_OFFSET_SQL = """
with a as (select c_custkey, cast(c_custkey as int) - 700 as d0, (cast(c_custkey as int) * 7) % 211 - 100 as w0,
    cast(c_custkey as int) % 29 - 14 as m0, cast(c_custkey as int) % 5 as y0 from customer),
b as (select *, sign(d0) * (abs(d0) % 7) as d1, w0 + sign(d0) * (abs(d0) // 7) as w1 from a),
c as (select *, m0 + sign(w1) * (abs(w1) // 4) as m1 from b)
select c_custkey, cast(d1 as int) as day,
    cast(case when m0 <> 0 then sign(w1) * (abs(w1) % 4) else sign(w1) * (abs(w1) % 52) end as int) as week,
    cast(case when m0 <> 0 then sign(m1) * (abs(m1) % 12) else m0 end as int) as month,
    cast(case when m0 <> 0 then y0 + sign(m1) * (abs(m1) // 12) else y0 + sign(w1) * (abs(w1) // 52) end as int) as year
from c"""


def dates_shifted(spark, folder):
    o = _table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    n = (F.col("o_orderkey") % 25 - 12).cast("int")
    return o.select(
        "o_orderkey", D.shift_date(F.col("d"), days=3, weeks=-2).alias("by_days"),
        D.shift_date(F.col("d"), months=n).alias("by_months"), D.shift_date(F.col("d"), years=-1).alias("by_years"),
        D.shift_date(F.col("d"), 1, 1, 1, 1).alias("by_all"),
    )


def _roll_sql(d: str, months: str) -> str:
    return f"cast(date_trunc('month', {d}) + to_months({months}) as date) + cast(day({d}) - 1 as int)"


def prices_scaled(spark, folder):
    o = _table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    s = reshape.scale_minmax(o, "o_totalprice", "x", keep_bounds=True)
    return s.select("o_orderkey", F.round("x", 9).alias("x"), "x_min", "x_max")


def prices_unscaled(spark, folder):
    o = _table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    s = reshape.scale_minmax(o, "o_totalprice", "x", keep_bounds=True)
    return s.select("o_orderkey", F.round(reshape.unscale_minmax(F.col("x"), F.col("x_min"), F.col("x_max")), 2).alias("back"))


def gaps_zeroed(spark, folder):
    c = _table(spark, folder, "customer").select("c_custkey")
    o = _table(spark, folder, "orders")
    sums = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("spent"))
    return c.join(sums, "c_custkey", "left").withColumn("spent", F.coalesce("spent", F.lit(0).cast(MONEY)))


def _segment_report(spark, folder):
    """A small wide report to format: order counts, spend and shares of each market segment."""
    c = _table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    o = _table(spark, folder, "orders").select("o_custkey", F.col("o_totalprice").cast(MONEY).alias("p"), "o_orderstatus")
    g = o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(
        F.sum("p").alias("Cur_Sales"),
        F.sum(F.when(F.col("o_orderstatus") == "O", F.col("p"))).alias("L_52_Sales"),
        F.count("*").alias("Cur_Bottles.Sold"),
    )
    share = F.col("L_52_Sales").cast("double") / F.col("Cur_Sales").cast("double")
    return g.withColumns({"Sales_PercD": share - 1, "Sales_Delta": F.col("Cur_Sales") - F.col("L_52_Sales")})


_SEGMENT_SQL = """select c_mktsegment, sum(cast(o_totalprice as decimal(18,2))) as a,
    sum(case when o_orderstatus = 'O' then cast(o_totalprice as decimal(18,2)) end) as b, count(*) as n
    from orders join customer on o_custkey = c_custkey group by c_mktsegment"""
_COMMA_SQL = "format('{{:,}}', cast(round_even(cast({0} as double), 0) as bigint))"
_PERCENT_SQL = (
    "regexp_replace(cast(cast(round((cast(b as double) / cast(a as double) - 1) * 100, 2) as decimal(38,2)) as varchar),"
    " '\\.?0+$', '') || ' %'"
)


def report_formatted(spark, folder):
    return R.format_report(_segment_report(spark, folder))


def report_labelled(spark, folder):
    report = _segment_report(spark, folder).select("c_mktsegment", "Cur_Sales", "L_52_Sales", "`Cur_Bottles.Sold`", "Sales_Delta")
    return R.label_report(report)


def families_dropped(spark, folder):
    kept = R.drop_families(_segment_report(spark, folder), ["_Delta", "_PercD", "_MkShare", "_MkShareD"], keep=["_Delta"])
    return kept.withColumnRenamed("Cur_Bottles.Sold", "Cur_Bottles")


def brand_list(spark, folder):
    return value_list(_table(spark, folder, "part"), "p_brand")


def cascading_list(spark, folder):
    return value_list(_table(spark, folder, "part"), "p_size", "p_type", ["PROMO", "SMALL"], "p_brand", ["Brand#1", "Brand#2"])


def orders_sorted(spark, folder):
    o = _table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return o.orderBy(F.asc("o_orderstatus"), F.desc("o_totalprice"), "o_orderkey")


def head_turned(spark, folder):
    o = _table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return reshape.head_transposed(o, ["o_orderkey"])


_HEAD_SQL = " union all ".join(
    f"select '{c}' as field, "
    + ", ".join(f"max(case when r = {i} then cast({c} as varchar) end) as row_{i}" for i in range(1, 6))
    + " from (select *, row_number() over (order by o_orderkey) as r from orders) h where r <= 5"
    for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
)

_DRINK_SQL = "list_extract([" + ", ".join(f"'{d}'" for d in _DRINKS) + f"], p_size % {len(_DRINKS)} + 1)"
_FULL_SQL = f"upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) || ' ' || {_DRINK_SQL}"
_CUT = f"date '{CUTOFF}'"
_DAY = "cast(o_orderdate as date)"

QUERIES = {
    "s01_csv_load": (csv_load, retyped(sales_feed_sql(list(FEED_COLUMNS)), text=["order_dt"])),
    "s01_csv_rejects": (
        csv_rejects,
        "select l_returnflag, count(*) as n, case when l_linestatus = 'O' then 'rejected' else 'good' end as side"
        " from lineitem group by 1, 3",
    ),
    "s02_csv_head_typed": (
        csv_head_typed, sales_feed_sql(["item_invoice_nbr", "zip_code", "item_nbr", "bottles_sold"])
    ),
    "s03_lookup_tables": (
        lookup_tables,
        " union all ".join(
            f"select '{n}' as name, count(*) as n, cast(sum({k}) as bigint) as keys from {n}" for n, k in _LOOKUPS.items()
        ),
    ),
    "s04_day_parsed": (day_parsed, f"select o_orderkey, cast({_DAY} as varchar) as Date from orders"),
    "s05_invoice_key_violations": (
        invoice_key_violations,
        f"select item_invoice_nbr, count(*) as n from ({sales_feed_sql(['item_invoice_nbr'])}) f group by 1 having count(*) > 1",
    ),
    "s05_order_key_violations": (
        order_key_violations, "select o_orderkey, count(*) as n from orders group by 1 having count(*) > 1"
    ),
    "s06_staged_base": (
        staged_base,
        "select l_suppkey, max(n) as most, cast(sum(n) as bigint) as total from"
        " (select l_suppkey, l_returnflag, count(*) as n from lineitem group by 1, 2) b group by 1",
    ),
    "s08_appended_orders": (appended_orders, f"select o_orderkey, o_custkey, cast({_DAY} as varchar) as day from orders"),
    "s09_details_inserted": (
        details_inserted,
        f"select l_partkey, case when min(l_shipdate) < {_CUT} then 'old' else 'new' end as origin from lineitem group by 1",
    ),
    "s10_orders_upserted": (
        orders_upserted,
        retyped(
            f"with o as ({invoice_sql(f'order_dt < {_CUT}')}), n as ({invoice_sql(f'order_dt >= {_CUT}')})"
            " select * from n union all select * from o where item_invoice_nbr not in (select item_invoice_nbr from n)",
            ["order_date"], INVOICE_DOUBLES, ["bottles_sold"],
        ),
    ),
    "s10_orders_upserted_in_parts": (
        orders_upserted_in_parts,
        retyped(
            f"with o as materialized ({invoice_sql()}),"
            " n as (select * replace (order_date + 31 as order_date) from o where month(order_date) = 3 and store_nbr % 5 = 0)"
            " select * from n union all select * from o where item_invoice_nbr not in (select item_invoice_nbr from n)",
            ["order_date"], INVOICE_DOUBLES, ["bottles_sold"],
        ),
    ),
    "p01_title_case": (
        names_title,
        f"""select s_suppkey, {title_sql("'  o''brien_' || s_name || '-x hy-vee 3rd/ '")} as title from supplier""",
    ),
    "p02_proper_case": (
        names_proper,
        "select p_partkey, array_to_string(list_transform(regexp_extract_all(lower(p_name || ' o''neil_a 3rd-' || p_type),"
        " '[a-z0-9_]+|[^a-z0-9_]+'), lambda t: upper(t[1]) || t[2:]), '') as proper from part",
    ),
    "p03_item_digits": (
        item_digits,
        "select item_invoice_nbr, try_cast(regexp_replace(item_nbr, '[^0-9]+', '', 'g') as int) as item_nbr"
        f" from ({sales_feed_sql(['item_invoice_nbr', 'item_nbr'])}) f",
    ),
    "p03_digit_rejects": (
        item_digit_rejects,
        "select raw, count(*) as n from (select p_brand as raw from part union all select p_type from part union all"
        " select p_name from part) t where try_cast(regexp_replace(raw, '[^0-9]+', '', 'g') as int) is null group by 1",
    ),
    "p04_odd_item_numbers": (
        odd_item_numbers,
        f"select item_nbr, item_desc, count(*) as n from ({sales_feed_sql(['item_nbr', 'item_desc'])}) f"
        " where not regexp_matches(item_nbr, '^[0-9\\.]+$') or item_nbr = '1' group by 1, 2",
    ),
    "p05_store_points": (
        store_points,
        f"select item_invoice_nbr, {_POINT_SQL.format(1)} as lat, {_POINT_SQL.format(2)} as long"
        f" from ({sales_feed_sql(['item_invoice_nbr', 'store_location'])}) f",
    ),
    "p06_store_hashes": (
        store_hashes,
        f"select store_nbr, {STORE_HASH_SQL} as store_hash, cast(32 as int) as keyed_length from"
        f" ({store_parts_sql('select distinct * from (' + sales_feed_sql(_STORE_RAW) + ') s')}) p",
    ),
    "p07_item_hashes": (
        item_hashes,
        f"select item_nbr, {ITEM_HASH_SQL} as item_hash from (" + item_parts_sql(
            "select distinct * from (" + sales_feed_sql(["item_nbr", "item_desc", "category_nbr", "pack", "bottle_vol"]) + ") s"
        ) + ") p",
    ),
    "p14_money": (
        money_amounts,
        "select l_orderkey, l_linenumber, l_partkey, cast(cast(l_extendedprice as decimal(18,2)) as double) as total_sale,"
        " cast(cast(l_tax as decimal(18,2)) as double) as tax from lineitem",
    ),
    "p15_profits": (
        unit_profits,
        retyped(
            "select item_invoice_nbr, order_date, item_nbr, store_nbr,"
            " state_bottle_retail - state_bottle_cost as state_bottle_profit,"
            f" total_sale - state_bottle_cost * cast(bottles_sold as int) as total_profit from ({invoice_sql()}) i",
            ["order_date"], ["state_bottle_profit", "total_profit"],
        ),
    ),
    "p16_volumes": (
        volumes,
        retyped(
            "select item_invoice_nbr, item_nbr, order_dt, cast(bottles_sold as bigint) * coalesce(bottle_vol, 0) as total_volume,"
            " round(cast(bottles_sold as bigint) * coalesce(bottle_vol, 0) / 3785.41, 6) as total_volume_gallons from ("
            + sales_feed_sql(["item_invoice_nbr", "item_nbr", "order_dt", "bottles_sold", "bottle_vol"]) + ") f",
            ["order_dt"], ["total_volume_gallons"],
        ),
    ),
    "p17_category_groups": (
        category_groups,
        f"select p_partkey, full_name, {_category_sql('plain')} as cat_group, {_category_sql('full_name')} as typed_group,"
        f" {_category_sql('full_name', True)} as searched_group from"
        f" (select p_partkey, {_DRINK_SQL} as plain, {_FULL_SQL} as full_name from part) p",
    ),
    "p18_json_validity": (
        json_validity,
        "select event_id, kind, json_valid(props || tail) as valid from events, (select unnest([0, 1, 2, 3, 4, 5]) as kind,"
        " unnest(['', ' x', ',1', '}', ' ', '],[1']) as tail) t",
    ),
    "p18_json_counts": (
        json_valid_counts,
        " union all ".join(
            f"select '{n}' as name, count(*) as n, count(*) filter (where json_valid({c})) as valid from {n}"
            for n, c in (("events", "props"), ("documents", "text"), ("pages", "html"), ("conversations", "text"))
        ),
    ),
    "p19_regex_filter": (
        regex_filtered, "select p_partkey, p_name from part where regexp_matches(p_name, 'red|Red|blue')"
    ),
    "p20_list_and_range": (
        list_and_range_filters,
        f"select o_orderkey, cast({_DAY} as varchar) as day, o_orderstatus from orders where o_orderstatus in ('O', 'F')"
        f" and {_DAY} between date '1999-01-01' and date '2000-01-14' and o_totalprice > 1000",
    ),
    "p21_dynamic_filter": (
        dynamic_filter,
        "select p_partkey, p_type, p_size from part where p_type in ('PROMO', 'LARGE') and p_size in (10, 20, 30)",
    ),
    "p22_year_filter": (
        year_filter,
        f"select o_orderkey, {code_sql('o_orderdate')} as YrWk from orders where year(o_orderdate) in (1998, 2000)",
    ),
    "p23_date_parts": (
        calendar_parts,
        f"select o_orderkey, cast(month(d) as int) as mnth, dayname(d) as wkday, {week_sql('d')} as wk, cast(year(d) as int) as yr,"
        f" cast(year(d) * 100 + month(d) as int) as yrmnth, {code_sql('d')} as yrweek"
        f" from (select o_orderkey, {_DAY} as d from orders) o",
    ),
    "p24_week_codes": (
        week_codes,
        f"select o_orderkey, {code_sql('o_orderdate')} as YrWk, cast(year(o_orderdate) as int) as Yr,"
        f" {week_sql('o_orderdate')} as Wk from orders",
    ),
    "p25_week_ends": (
        week_ends,
        "select o_orderkey, e as last_day, e as from_code from (select o_orderkey, cast(least(make_date(year(d), 12, 31),"
        f" make_date(year(d), 1, 1) + 7 * {week_sql('d')} - 1) as varchar) as e from (select o_orderkey, {_DAY} as d from orders) o) w",
    ),
    "p26_offsets": (offsets_normalized, _OFFSET_SQL),
    "p27_shifted_dates": (
        dates_shifted,
        retyped(
            f"select o_orderkey, d - 11 as by_days, {_roll_sql('d', 'cast(o_orderkey % 25 - 12 as int)')} as by_months,"
            f" {_roll_sql('d', '-12')} as by_years, {_roll_sql('(' + _roll_sql('(d + 8)', '1') + ')', '12')} as by_all"
            f" from (select o_orderkey, {_DAY} as d from orders) o",
            ["by_days", "by_months", "by_years", "by_all"],
        ),
    ),
    "p28_scaled": (
        prices_scaled,
        "select o_orderkey, round(2.0 * (o_totalprice - lo) / (hi - lo) - 1, 9) as x, lo as x_min, hi as x_max from orders,"
        " (select min(o_totalprice) as lo, max(o_totalprice) as hi from orders) b",
    ),
    "p29_unscaled": (prices_unscaled, "select o_orderkey, round(o_totalprice, 2) as back from orders"),
    "p30_gaps_zeroed": (
        gaps_zeroed,
        "select c_custkey, cast(coalesce(sum(cast(o_totalprice as decimal(18,2))), 0) as double) as spent from customer"
        " left join orders on o_custkey = c_custkey group by 1",
    ),
    "p31_formatted": (
        report_formatted,
        f"select c_mktsegment, '$ ' || {_COMMA_SQL.format('a')} as Cur_Sales, '$ ' || {_COMMA_SQL.format('b')} as L_52_Sales,"
        f" {_COMMA_SQL.format('n')} as \"Cur_Bottles.Sold\", {_PERCENT_SQL} as Sales_PercD,"
        f" '$ ' || {_COMMA_SQL.format('a - b')} as Sales_Delta from ({_SEGMENT_SQL}) g",
    ),
    "p32_labelled": (
        report_labelled,
        'select c_mktsegment, cast(a as double) as "Current YTD Sales", cast(b as double) as "1 Yr Ago YTD Sales",'
        f' n as "Current YTD Bottles Sold", cast(a - b as double) as "Sales Diffrence" from ({_SEGMENT_SQL}) g',
    ),
    "p33_families_dropped": (
        families_dropped,
        "select c_mktsegment, cast(a as double) as Cur_Sales, cast(b as double) as L_52_Sales, n as Cur_Bottles,"
        f" cast(a - b as double) as Sales_Delta from ({_SEGMENT_SQL}) g",
    ),
    "o01_value_list": (brand_list, "select distinct p_brand from part order by 1"),
    "o02_cascading_list": (
        cascading_list,
        "select distinct p_size from part where p_type in ('PROMO', 'SMALL') and p_brand in ('Brand#1', 'Brand#2') order by 1",
    ),
    "o03_sorted": (
        orders_sorted,
        "select o_orderkey, o_orderstatus, o_totalprice from orders order by o_orderstatus, o_totalprice desc, o_orderkey",
    ),
    "o04_head_transposed": (head_turned, _HEAD_SQL),
}
