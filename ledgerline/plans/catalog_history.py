"""Registered queries: dated dimensions, their refresh, and the star views."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import text as X
from ledgerline.operators import history
from ledgerline.operators.joins import interval_join
from ledgerline.plans import warehouse as W
from ledgerline.plans.catalog_relations import COUNTY_SQL
from ledgerline.plans.catalog_scalars import (
    INVOICE_DOUBLES,
    ITEM_HASH_SQL,
    STORE_HASH_SQL,
    invoice_sql,
    item_parts_sql,
    store_parts_sql,
)
from ledgerline.plans.feed import sales_feed, sales_feed_sql
from ledgerline.plans.sqlforms import dimension_sql, dominant_sql, history_sql, merge_sql, retyped, title_sql
from ledgerline.session import scratch_path, write_stage
from ledgerline.sources import sinks
from ledgerline.sources.tables import load_parquet

CUTOFF = "2000-01-01"
LATE = "1999-03-15"

# --- one key, one attribute: customer and order priority ----------------------------------


def priority_events(spark, folder) -> DataFrame:
    return load_parquet(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("order_dt"),
        X.title_case(F.expr("nullif(o_orderpriority, '4-NOT SPECIFIED')")).alias("priority"),
    )


def priority_history(spark, folder) -> DataFrame:
    daily = history.daily_dominant(priority_events(spark, folder), "o_custkey", "order_dt", ["priority"])
    return history.build_history(daily, "o_custkey", "order_dt", "priority")


def priority_history_by_overlap(spark, folder):
    """The same history the general way: both kinds of interval, joined where they overlap."""
    daily = history.daily_dominant(priority_events(spark, folder), "o_custkey", "order_dt", ["priority"])
    both = history.stack_histories(daily, F.col("priority").isNotNull())
    intervals = write_stage(history.history_intervals(both, ["null_incld", "o_custkey"], "order_dt", "priority"), "intervals")
    return history.merge_null_histories(intervals, "o_custkey", "priority")


def priority_in_force(spark, folder) -> DataFrame:
    """Every order with the customer's priority in force on its date, filled and as seen."""
    dated = write_stage(priority_history(spark, folder), "priority").drop("orig_start_dt")
    orders = priority_events(spark, folder)
    joined = interval_join(orders, dated, {"o_custkey": "o_custkey"}, "order_dt", "start_dt", "end_dt")
    return joined.select("o_orderkey", "o_custkey", "order_dt", "priority", "value", "orig_value")


_EVENTS_SQL = (
    "select o_orderkey, o_custkey as k, cast(o_orderdate as date) as d,"
    f" {title_sql('nullif(o_orderpriority, ' + chr(39) + '4-NOT SPECIFIED' + chr(39) + ')')} as v from orders"
)
_PRIORITY_DAILY = f"select k, d, v, v is not null as u from ({dominant_sql(_EVENTS_SQL, ['v'])}) x"
_PRIORITY_SQL = retyped(
    f"with {history_sql(_PRIORITY_DAILY)} select k as o_custkey, value, start_dt, orig_start_dt, end_dt, orig_value from h",
    ["start_dt", "orig_start_dt", "end_dt"],
)

# --- dimensions --------------------------------------------------------------------------------


def values_sql(name: str, where: str = "true") -> str:
    """Daily dominant values of a dimension: k, d, its columns, v and u."""
    feed = f"select * from ({sales_feed_sql(W.FEED_FOR[name])}) f where {where}"
    if name in ("category", "vendor"):
        column = {"category": "category_desc", "vendor": "vendor_name"}[name]
        raw = {"category": "category_name", "vendor": "vendor_name"}[name]
        cleaned = f"select {name}_nbr as k, order_dt as d, nullif({title_sql(raw)}, '') as {column} from ({feed}) g"
        return f"select *, {column} as v, {column} is not null as u from ({dominant_sql(cleaned, [column])}) x"
    if name == "item":
        columns = ["item_desc", "category_nbr", "items_per_pack", "item_vol"]
        cleaned = item_parts_sql(feed, ", order_dt as d")
        hashed, usable = ITEM_HASH_SQL, "item_desc is not null"
    else:
        columns = ["store_name", "store_address", "store_city", "zip_code", "county_nbr", "lat", "long"]
        cleaned = store_parts_sql(feed, ", order_dt as d")
        hashed, usable = STORE_HASH_SQL, "store_name is not null and store_address is not null"
    key = f"{name}_nbr"
    cleaned = f"select {key} as k, d, {', '.join(columns)} from ({cleaned}) g"
    daily = f"select *, k as {key} from ({dominant_sql(cleaned, columns)}) x"
    return f"select *, {hashed} as v, ({usable}) as u from ({daily}) y"


def _kduv(name: str, where: str = "true") -> str:
    return f"select k, d, v, u from ({values_sql(name, where)}) z"


_VALUE = {"category": "category_desc", "vendor": "vendor_name", "item": "item_hash", "store": "store_hash"}


def _named(name: str, source: str) -> str:
    v = _VALUE[name]
    return (
        f"select k as {name}_nbr, value as {v}, cast(start_date as varchar) as start_date, cast(end_date as varchar) as end_date,"
        f" orig_value as orig_{v}, current_record from ({source}) n"
    )


def _feed_daily(spark, folder, name, condition=None):
    feed = sales_feed(spark, folder, W.FEED_FOR[name])
    dim = W.DIMENSIONS[name]()
    return W.daily_values(feed if condition is None else feed.filter(condition), dim), dim


def _fresh_dimension(name):
    def run(spark, folder):
        daily, dim = _feed_daily(spark, folder, name)
        return W.refresh_dimension(None, daily, dim)

    return run


def _merged_dimension(name, old_where, new_where):
    """A dimension built from one part of the feed and refreshed with another."""

    def run(spark, folder):
        daily, dim = _feed_daily(spark, folder, name, old_where)
        existing = write_stage(W.refresh_dimension(None, daily, dim), f"{name}-before")
        batch, _ = _feed_daily(spark, folder, name, new_where)
        return W.refresh_dimension(existing, batch, dim)

    return run


def _fresh_sql(name):
    return f"with {history_sql(_kduv(name))} {_named(name, dimension_sql('h'))}"


def _before_sql(name, old_where, new_where):
    return (
        f"{history_sql(_kduv(name, old_where), 'a')}, o as ({dimension_sql('a')}),"
        f" {history_sql(_kduv(name, new_where), 'b')}, {merge_sql('o', 'b')}"
    )


def _merged_sql(name, old_where, new_where):
    return f"with {_before_sql(name, old_where, new_where)} {_named(name, 'select * from m')}"


_BEFORE, _AFTER = f"order_dt < date '{CUTOFF}'", f"order_dt >= date '{CUTOFF}'"
_FROM_LATE = f"order_dt >= date '{LATE}'"


def _detail(name):
    def run(spark, folder):
        daily, dim = _feed_daily(spark, folder, name)
        return W.refresh_detail(None, daily, dim)

    return run


def _detail_sql(name):
    columns = (
        "item_desc, category_nbr, items_per_pack, item_vol"
        if name == "item"
        else "store_name, store_address, store_city, zip_code, county_nbr, lat, long"
    )
    return f"select distinct v as {name}_hash, {name}_nbr, {columns} from ({values_sql(name)}) z"


def _category_before_and_batch(spark, folder):
    daily, dim = _feed_daily(spark, folder, "category", _BEFORE)
    before = write_stage(W.refresh_dimension(None, daily, dim), "category-before")
    batch, _ = _feed_daily(spark, folder, "category", _FROM_LATE)
    return before, W.dimension_batch(batch, dim)


def rows_deleted(spark, folder):
    before, batch = _category_before_and_batch(spark, folder)
    return sinks.delete_from(before, batch, "category_nbr")


def rows_closed(spark, folder):
    before, batch = _category_before_and_batch(spark, folder)
    kept = sinks.delete_from(before, batch, "category_nbr")
    return sinks.close_open_rows(kept, batch, "category_nbr")


# --- fact and views -----------------------------------------------------------------------------


def orders_fact(spark, folder):
    return W.refresh_orders(None, sales_feed(spark, folder, W.INVOICE_COLUMNS))


def county(spark, folder):
    return W.county_lookup(sales_feed(spark, folder, ["county_nbr", "county_name"]))


def county_two_batches(spark, folder):
    """The lookup after a batch of the counties up to I, and then one of the others."""
    feed = sales_feed(spark, folder, ["county_nbr", "county_name"])
    first = write_stage(W.county_lookup(feed.filter("county_name < 'j'")), "county")
    return W.county_lookup(feed.filter("county_name >= 'f'"), existing=first)


_COUNTY_BATCHES_SQL = f"""with f as materialized (
        select county_nbr, lower(county_name) as raw, {title_sql("county_name")} as county_name
        from (select distinct county_nbr, county_name from ({sales_feed_sql(["county_nbr", "county_name"])}) x) y),
    a1 as (select county_nbr, max(county_name) as county_name from f where county_nbr is not null and raw < 'j' group by 1),
    b1 as (select distinct county_name from f where county_nbr is null and raw < 'j'),
    one as materialized (select * from a1 union all
        select cast(row_number() over (order by county_name) + (select coalesce(max(county_nbr), 0) from a1) as int), county_name from b1),
    a2 as materialized (select * from one union all select county_nbr, max(county_name) from f
        where county_nbr is not null and raw >= 'f' and county_nbr not in (select county_nbr from one) group by 1),
    b2 as (select distinct county_name from f where county_nbr is null and raw >= 'f' and county_name not in (select county_name from one))
    select * from a2 union all
    select cast(row_number() over (order by county_name) + (select max(county_nbr) from a2) as int), county_name from b2"""


def item_rejects(spark, folder):
    """Item numbers of the feed that no int can hold: here those with a letter more and nine digits put before."""
    odd = F.concat(F.lit("x904631775"), F.col("item_nbr"))
    feed = sales_feed(spark, folder, ["item_nbr"])
    return W.item_rejects(feed.select(F.when(F.col("item_nbr").startswith("x"), odd).otherwise(F.col("item_nbr")).alias("item_nbr")))


_REJECTS_SQL = """select 'x904631775x' || cast(l_partkey as varchar) as item_nbr, count(*) as rows
    from lineitem where l_returnflag = 'R' group by 1"""


def _tables(spark, folder, names):
    return W.build_warehouse(lambda columns: sales_feed(spark, folder, columns), names)


_STAR = ["store", "store_address", "county", "item", "item_detail", "category", "vendor"]


def _view_of(spark, folder, fact, staged=False):
    tables = _tables(spark, folder, _STAR)
    view = W.orders_view(fact, **{n: tables[n] for n in _STAR}, staged=staged)
    return view.withColumn("total_volume_gallons", F.round("total_volume_gallons", 6))


def orders_view(spark, folder):
    """The whole view. The orders are written before and halfway: what one step shuffles is off the disk when the next one shuffles."""
    return _view_of(spark, folder, write_stage(orders_fact(spark, folder), "orders"), staged=True)


def orders_view_in_range(spark, folder):
    """The analyst's query: two weeks of the view. The date filter reaches the feed's scan."""
    return _view_of(spark, folder, orders_fact(spark, folder)).filter(F.col("order_date").between(F.lit(date(2000, 1, 1)), F.lit(date(2000, 1, 14))))


def orders_view_resolved(spark, folder):
    """The same two weeks from orders whose dimension rows were resolved when they were written: joins by equality only."""
    tables = _tables(spark, folder, _STAR)
    known = {n: tables[n] for n in ("store", "item", "item_detail", "category", "vendor")}
    orders = write_stage(orders_fact(spark, folder), "orders")
    fact = write_stage(W.resolve_versions(orders, **known, staged=True), "resolved")
    view = W.orders_view(fact, **{n: tables[n] for n in _STAR}).filter(F.col("order_date").between(F.lit(date(2000, 1, 1)), F.lit(date(2000, 1, 14))))
    return view.withColumn("total_volume_gallons", F.round("total_volume_gallons", 6))


def vendor_in_buckets(spark, folder):
    """The vendor dimension kept in buckets on disk, the later batch rewriting only buckets of its keys."""
    dim, root, parts = W.DIMENSIONS["vendor"](), scratch_path(spark, "vendor"), {}
    for where in (_BEFORE, _AFTER):
        feed = sales_feed(spark, folder, W.FEED_FOR["vendor"]).filter(where)
        daily = write_stage(W.daily_values(feed, dim), "vendor-daily")
        change = lambda old, daily=daily: W.refresh_dimension(old, daily, dim)
        parts, _, _ = sinks.rewrite_buckets(daily.select(dim.key_name), root, parts, 16, dim.key_name, change)
    return sinks.read_parts(spark, root, parts, sinks.part_schema(spark, root, parts))


def item_view(spark, folder):
    t = _tables(spark, folder, ["item", "item_detail", "category"])
    return W.item_view(t["item"], t["item_detail"], t["category"])


def item_view_dated(spark, folder):
    t = _tables(spark, folder, ["item", "item_detail", "category"])
    return W.item_view(t["item"], t["item_detail"], t["category"], as_of=True)


def store_view(spark, folder):
    t = _tables(spark, folder, ["store", "store_address", "county"])
    return W.store_view(t["store"], t["store_address"], t["county"])


def _dim_ctes(*names: str) -> str:
    return ", ".join(
        f"{history_sql(_kduv(n), n[0] + 'h')}, {n}_dim as ({_named(n, dimension_sql(n[0] + 'h'))})" for n in names
    )


def _orders_view_sql(where: str = "true") -> str:
    """The view in two steps: what each dimension shows per interval, then orders with the interval of their day."""

    def shown(name: str, columns: str, joins: str = "") -> str:
        bounds = "cast(dim.start_date as date) as since, cast(dim.end_date as date) as until"
        return f"{name}_shown as materialized (select dim.{name}_nbr as nbr, {bounds}, {columns} from {name}_dim dim {joins})"

    def in_force(name: str, number: str) -> str:
        return f"left join {name}_shown as {name} on {name}.nbr = {number} and fact.order_date between {name}.since and {name}.until"

    steps = [
        _dim_ctes("vendor", "category", "item", "store"),
        f"places as ({_detail_sql('store')})",
        f"goods as ({_detail_sql('item')})",
        f"counties as ({COUNTY_SQL})",
        shown(
            "store",
            "p.store_name, p.store_address, p.store_city, p.lat, p.long, p.county_nbr, n.county_name",
            "left join places p on p.store_hash = dim.orig_store_hash left join counties n using (county_nbr)",
        ),
        shown("item", "g.item_desc, g.items_per_pack, g.item_vol, g.category_nbr", "left join goods g on g.item_hash = dim.orig_item_hash"),
        shown("category", "dim.category_desc"),
        shown("vendor", "dim.orig_vendor_name as vendor_name"),
        f"fact as materialized (select * from ({invoice_sql()}) every where {where})",
    ]
    view = f"""with {", ".join(steps)}
    select fact.*, store.* exclude (nbr, since, until), item.* exclude (nbr, since, until, item_vol), item.item_vol as bottle_vol,
        category.category_desc, vendor.vendor_name,
        state_bottle_retail - state_bottle_cost as state_bottle_profit,
        total_sale - state_bottle_cost * cast(bottles_sold as int) as total_profit,
        bottles_sold * coalesce(item.item_vol, 0) as total_volume,
        round(cast(bottles_sold as double) * coalesce(item.item_vol, 0) / 3785.41, 6) as total_volume_gallons
    from fact {in_force("store", "fact.store_nbr")} {in_force("item", "fact.item_nbr")}
    {in_force("category", "item.category_nbr")} {in_force("vendor", "fact.vendor_nbr")}"""
    doubles = [*INVOICE_DOUBLES, "state_bottle_profit", "total_profit", "total_volume_gallons"]
    return retyped(view, ["order_date"], doubles, ["bottles_sold", "total_volume"])


def _item_view_sql(dated: bool) -> str:
    def category(alias: str, detail: str) -> str:
        test = (
            f"cast({alias}.start_date as date) <= cast(i.start_date as date)"
            f" and cast({alias}.end_date as date) >= cast(i.start_date as date)"
            if dated
            else f"{alias}.current_record = 'Y'"
        )
        return f"left join category_dim {alias} on {alias}.category_nbr = {detail}.category_nbr and {test}"

    return f"""with {_dim_ctes("item", "category")}, detail as ({_detail_sql("item")})
    select i.item_nbr, a.item_desc, a.items_per_pack, a.item_vol, a.category_nbr, c1.category_desc, i.start_date, i.end_date,
        i.current_record, b.item_desc as orig_item_desc, b.items_per_pack as orig_items_per_pack, b.item_vol as orig_item_vol,
        b.category_nbr as orig_category_nbr, c2.category_desc as orig_category_desc, i.item_hash, i.orig_item_hash
    from item_dim i left join detail a on a.item_hash = i.item_hash {category("c1", "a")}
    left join detail b on b.item_hash = i.orig_item_hash {category("c2", "b")}"""


_SHOWN = ["store_name", "store_address", "store_city", "zip_code", "lat", "long"]
_STORE_VIEW_SQL = f"""with {_dim_ctes("store")}, county as ({COUNTY_SQL}), address as ({_detail_sql("store")})
    select s.store_nbr, {", ".join(f"a.{c}" for c in _SHOWN)}, ca.county_name as county, s.start_date, s.end_date, s.current_record,
        {", ".join(f"b.{c} as orig_{c}" for c in _SHOWN)}, cb.county_name as orig_county, s.store_hash, s.orig_store_hash
    from store_dim s left join address a on a.store_hash = s.store_hash left join county ca on ca.county_nbr = a.county_nbr
    left join address b on b.store_hash = s.orig_store_hash left join county cb on cb.county_nbr = b.county_nbr"""

QUERIES = {
    "d00_priority_history": (priority_history, _PRIORITY_SQL),
    "d00_priority_in_force": (
        priority_in_force,
        f"with {history_sql(_PRIORITY_DAILY)}, e as ({_EVENTS_SQL}) select o_orderkey, e.k as o_custkey, cast(d as varchar) as order_dt,"
        " e.v as priority, value, orig_value from e left join h on h.k = e.k and start_dt <= d and end_dt >= d",
    ),
    "j02_history_by_overlap": (priority_history_by_overlap, _PRIORITY_SQL),
    "d01_category_history": (_fresh_dimension("category"), _fresh_sql("category")),
    "d02_vendor_history": (_fresh_dimension("vendor"), _fresh_sql("vendor")),
    "d03_item_history": (_fresh_dimension("item"), _fresh_sql("item")),
    "d04_store_history": (_fresh_dimension("store"), _fresh_sql("store")),
    "d03_item_detail": (_detail("item"), _detail_sql("item")),
    "d04_store_address": (_detail("store"), _detail_sql("store")),
    "d01_category_later_batch": (
        _merged_dimension("category", _BEFORE, _AFTER), _merged_sql("category", _BEFORE, _AFTER)
    ),
    "d01_category_overlapping_batch": (
        _merged_dimension("category", _BEFORE, _FROM_LATE), _merged_sql("category", _BEFORE, _FROM_LATE)
    ),
    "d01_category_repeated_batch": (
        _merged_dimension("category", "true", "true"), _merged_sql("category", "true", "true")
    ),
    "d02_vendor_later_batch": (_merged_dimension("vendor", _BEFORE, _AFTER), _merged_sql("vendor", _BEFORE, _AFTER)),
    "d03_item_later_batch": (_merged_dimension("item", _BEFORE, _AFTER), _merged_sql("item", _BEFORE, _AFTER)),
    "d04_store_overlapping_batch": (
        _merged_dimension("store", _BEFORE, _FROM_LATE), _merged_sql("store", _BEFORE, _FROM_LATE)
    ),
    "s11_rows_deleted": (
        rows_deleted, f"with {_before_sql('category', _BEFORE, _FROM_LATE)} {_named('category', 'select * from m_kept')}"
    ),
    "s12_rows_closed": (
        rows_closed, f"with {_before_sql('category', _BEFORE, _FROM_LATE)} {_named('category', 'select * from m_closed')}"
    ),
    "d05_county_lookup": (county, COUNTY_SQL),
    "d05_county_two_batches": (county_two_batches, _COUNTY_BATCHES_SQL),
    "p03_item_rejects_kept": (item_rejects, _REJECTS_SQL),
    "d06_orders_fact": (orders_fact, retyped(invoice_sql(), ["order_date"], INVOICE_DOUBLES, ["bottles_sold"])),
    "d07_orders_view": (orders_view, _orders_view_sql()),
    "d07_orders_view_in_range": (
        orders_view_in_range, _orders_view_sql("order_date between date '2000-01-01' and date '2000-01-14'")
    ),
    "d07_orders_view_resolved": (
        orders_view_resolved, _orders_view_sql("order_date between date '2000-01-01' and date '2000-01-14'")
    ),
    "d02_vendor_in_buckets": (vendor_in_buckets, _merged_sql("vendor", _BEFORE, _AFTER)),
    "d08_item_view": (item_view, _item_view_sql(False)),
    "d08_item_view_dated": (item_view_dated, _item_view_sql(True)),
    "d09_store_view": (store_view, _STORE_VIEW_SQL),
}
