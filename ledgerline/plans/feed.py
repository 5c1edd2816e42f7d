"""The flat sales feed, derived from the order tables.

The supplied tables hold no sales feed, and no attribute in them changes over time. The
feed is therefore an order line with its order, part, supplier, nation and customer,
and its changing (and sometimes missing) names follow the line's flags. The column
expressions are plain SQL that Spark and other engines read alike.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.tables import load_parquet

FEED_COLUMNS = {
    "item_invoice_nbr": "'INV-' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string)",
    "order_dt": "cast(l_shipdate as date)",
    "store_nbr": "cast(l_suppkey as int)",
    "store_name": "case when l_returnflag = 'N' then null"
    " else '  ' || lower(s_name) || ' o''brien-' || l_linestatus || ' ' end",
    "store_address": "case when l_returnflag = 'A' and l_linestatus = 'O' then null"
    " else cast(100 + s_nationkey as string) || ' main st/' || lower(n_name) || ' ' || l_returnflag end",
    "store_city": "lower(n_name)",
    "zip_code": "cast(50000 + s_nationkey as string)",
    "store_location": "case when l_linestatus = 'F'"
    " then 'POINT (-' || cast(90 + s_nationkey as string) || '.5 41.25)' end",
    "county_nbr": "case when n_regionkey = 4 then null else cast(s_nationkey as int) end",
    "county_name": "lower(n_name)",
    "category_nbr": "cast(p_size as int)",
    "category_name": "case when o_orderpriority = '4-NOT SPECIFIED' then null else lower(o_orderpriority) end",
    "vendor_nbr": "cast(o_custkey as int)",
    "vendor_name": "case when o_orderstatus = 'P' then null else lower(c_name) || ' ' || o_orderstatus end",
    "item_nbr": "case when l_returnflag = 'R' then 'x' else '' end || cast(l_partkey as string)",
    "item_desc": "case when l_returnflag = 'A' then null else p_name || ' ' || l_linestatus end",
    "pack": "case when l_linestatus = 'F' then 6 else 12 end",
    "bottle_vol": "case when l_returnflag = 'N' then null else 750 end",
    "state_bottle_cost": "p_retailprice",
    "state_bottle_retail": "p_retailprice + 100.5",
    "bottles_sold": "cast(l_quantity as int)",
    "sale": "l_extendedprice",
    "volume": "cast(l_quantity * 0.75 as double)",
    "volume_gallons": "cast(l_quantity * 0.75 / 3.78541 as double)",
}

# Tables by column prefix, and how each hangs on the ones before it.
_TABLES = {
    "o": ("orders", "l_orderkey", "o_orderkey", ()),
    "p": ("part", "l_partkey", "p_partkey", ()),
    "s": ("supplier", "l_suppkey", "s_suppkey", ()),
    "n": ("nation", "s_nationkey", "n_nationkey", ("s",)),
    "c": ("customer", "o_custkey", "c_custkey", ("o",)),
}


def _needed(columns: Sequence[str]) -> list[str]:
    text = " ".join(FEED_COLUMNS[c] for c in columns)
    used = {m for m in re.findall(r"\b([opsnc])_\w+", text)}
    for prefix in list(used):
        used.update(_TABLES[prefix][3])
    return [p for p in _TABLES if p in used]


def sales_feed(spark: SparkSession, folder: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The feed, or the wanted columns of it; only the tables those columns need are joined."""
    columns = list(columns or FEED_COLUMNS)
    df = load_parquet(spark, folder, "lineitem")
    for prefix in _needed(columns):
        table, left, right, _ = _TABLES[prefix]
        df = df.join(load_parquet(spark, folder, table), F.col(left) == F.col(right))
    return df.select(*[F.expr(FEED_COLUMNS[c]).alias(c) for c in columns])


def sales_feed_sql(columns: Sequence[str] | None = None) -> str:
    columns = list(columns or FEED_COLUMNS)
    joins = "".join(f" join {t} on {a} = {b}" for t, a, b, _ in (_TABLES[p] for p in _needed(columns)))
    return "select " + ", ".join(f"{FEED_COLUMNS[c]} as {c}" for c in columns) + " from lineitem" + joins
