"""The dated star: dimensions, detail tables, county lookup, orders fact and views."""

from __future__ import annotations

from collections.abc import Callable, Container, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import text as X
from ledgerline.operators.history import build_history, daily_dominant, merge_history
from ledgerline.operators.joins import BROADCAST_BYTES, interval_join
from ledgerline.session import write_stage
from ledgerline.sources.sinks import (
    Manifest,
    bucket_part,
    insert_absent,
    month_part,
    part_schema,
    publish,
    read_manifest,
    read_parts,
    rewrite_buckets,
    upsert,
    upsert_parts,
    write_manifest,
)


@dataclass(frozen=True)
class Dimension:
    """How one dimension comes out of the feed.

    ``columns`` are the cleaned feed columns that make up a value. With ``hash_parts``
    the value is a row hash and the columns go to a detail table; otherwise it is the
    one column itself. ``required`` must be present for a row to carry information.
    """

    name: str
    key: Column
    key_name: str
    source_key: str
    columns: dict[str, Column]
    required: Sequence[str]
    value_name: str
    hash_parts: Sequence[X.HashPart] = ()


def _clean(column: str) -> Column:
    return X.blank_to_null(X.title_case(F.col(column)))


def category_dimension() -> Dimension:
    return Dimension(
        "category", F.col("category_nbr"), "category_nbr", "category_nbr",
        {"category_desc": _clean("category_name")}, ["category_desc"], "category_desc",
    )


def vendor_dimension() -> Dimension:
    return Dimension(
        "vendor", F.col("vendor_nbr"), "vendor_nbr", "vendor_nbr",
        {"vendor_name": _clean("vendor_name")}, ["vendor_name"], "vendor_name",
    )


def item_dimension() -> Dimension:
    return Dimension(
        "item", X.digits_to_int(F.col("item_nbr")), "item_nbr", "item_nbr",
        {
            "item_desc": _clean("item_desc"),
            "category_nbr": F.col("category_nbr"),
            "items_per_pack": F.col("pack"),
            "item_vol": F.col("bottle_vol"),
        },
        ["item_desc"], "item_hash", X.ITEM_HASH_PARTS,
    )


def store_dimension() -> Dimension:
    return Dimension(
        "store", F.col("store_nbr"), "store_nbr", "store_nbr",
        {
            "store_name": _clean("store_name"),
            "store_address": _clean("store_address"),
            "store_city": _clean("store_city"),
            "zip_code": F.col("zip_code"),
            "county_nbr": F.col("county_nbr"),
            "lat": X.point_part(F.col("store_location"), 1),
            "long": X.point_part(F.col("store_location"), 2),
        },
        ["store_name", "store_address"], "store_hash", X.STORE_HASH_PARTS,
    )


DIMENSIONS: dict[str, Callable[[], Dimension]] = {
    "category": category_dimension,
    "vendor": vendor_dimension,
    "item": item_dimension,
    "store": store_dimension,
}

# Feed columns each dimension reads.
FEED_FOR = {
    "category": ["category_nbr", "category_name", "order_dt"],
    "vendor": ["vendor_nbr", "vendor_name", "order_dt"],
    "item": ["item_nbr", "item_desc", "category_nbr", "pack", "bottle_vol", "order_dt"],
    "store": [
        "store_nbr", "store_name", "store_address", "store_city", "zip_code", "store_location", "county_nbr",
        "order_dt",
    ],
}


def daily_values(feed: DataFrame, dim: Dimension, day: str = "order_dt", whole_keys: bool = False) -> DataFrame:
    """One row per key and day: the day's dominant value, its parts, and whether it is usable.

    The raw texts are counted first and cleaned once per group, not once per sale. The groups of a key and day then meet
    once, in one shuffle for the counts of cleaned values and for the winner. With ``whole_keys`` that shuffle brings all days of a key
    together, as a history made of these rows at once needs them: no more than the different texts of each day, however many sales.
    """
    raw = feed.filter(F.col(dim.source_key).isNotNull()).groupBy(*FEED_FOR[dim.name]).agg(F.count("*").alias("n"))
    cleaned = raw.select(dim.key.alias(dim.key_name), *[c.alias(n) for n, c in dim.columns.items()], F.col(day), "n")
    # With a number of its own the shuffle is not coalesced: packed, these rows are a small part of what a task holds to sort them.
    parts = int(feed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    daily = daily_dominant(cleaned.repartition(parts, dim.key_name, *(() if whole_keys else (day,))), dim.key_name, day, list(dim.columns), "n")
    usable = None
    for c in dim.required:
        usable = F.col(c).isNotNull() if usable is None else usable & F.col(c).isNotNull()
    value = X.row_hash(dim.hash_parts) if dim.hash_parts else F.col(dim.value_name)
    return daily.withColumns({"value": value, "usable": usable})


def dimension_batch(daily: DataFrame, dim: Dimension, day: str = "order_dt", payload: Sequence[str] = ()) -> DataFrame:
    return build_history(daily, dim.key_name, day, "value", "usable", payload)


def refresh_dimension(existing: DataFrame | None, daily: DataFrame, dim: Dimension, payload: Sequence[str] = ()) -> DataFrame:
    """Merge a batch of daily values into a dimension (or start one).

    ``existing`` and the result: key, <value>, start_date, end_date, orig_<value>, current_record. A dimension that starts can
    bring a ``payload``, the columns behind its original values.
    """
    if existing is not None:
        existing = existing.withColumnsRenamed({dim.value_name: "value", f"orig_{dim.value_name}": "orig_value"})
    merged = merge_history(existing, dimension_batch(daily, dim, payload=payload), dim.key_name, payload)
    return merged.withColumnsRenamed({"value": dim.value_name, "orig_value": f"orig_{dim.value_name}"})


def detail_columns(dim: Dimension) -> list[str]:
    return [c for c in dim.columns if c != dim.key_name]


def detail_rows(daily: DataFrame, dim: Dimension) -> DataFrame:
    """The distinct value rows behind a hashed dimension, keyed by hash."""
    return daily.select(F.col("value").alias(dim.value_name), dim.key_name, *detail_columns(dim)).dropDuplicates([dim.value_name])


def refresh_detail(existing: DataFrame | None, daily: DataFrame, dim: Dimension) -> DataFrame:
    rows = detail_rows(daily, dim)
    return rows if existing is None else insert_absent(existing, rows, [dim.value_name])


def number_rows(names: DataFrame, column: str, first: Column | int = 1) -> DataFrame:
    """Consecutive numbers in order of ``column``, without one task seeing all rows.

    The rows are range-partitioned and written; each part counts its rows, and a row's
    number is its place in its part plus the sizes of the parts before.
    """
    first = first if isinstance(first, Column) else F.lit(first)
    sliced = write_stage(
        names.select(column).repartitionByRange(F.col(column)).withColumn("part", F.spark_partition_id()), "numbering"
    )
    sizes = sliced.groupBy("part").agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(column))
    return (
        sliced.withColumn("place", place)
        .join(offsets, "part")
        .select(column, (F.col("place") + F.col("offset") - 1 + first).cast("int").alias("number"))
    )


def county_lookup(feed: DataFrame, name: str = "county_name", existing: DataFrame | None = None) -> DataFrame:
    """Number and name of each county; names in rows without a number are numbered on from the largest.

    With an ``existing`` lookup its rows stay as they are: only numbers it lacks, and names it has under
    no number, are added.
    """
    title = X.title_case(F.col(name))
    numbered = (
        feed.filter(F.col("county_nbr").isNotNull()).groupBy("county_nbr").agg(F.max(title).alias("county_name"))
    )
    bare = (
        feed.filter(F.col("county_nbr").isNull() & F.col(name).isNotNull())
        .select(title.alias("county_name"))
        .distinct()
    )
    if existing is not None:
        existing = existing.select("county_nbr", "county_name")
        bare = bare.join(existing, "county_name", "left_anti")
        numbered = existing.unionByName(numbered.join(existing, "county_nbr", "left_anti"))
    next_number = numbered.agg((F.coalesce(F.max("county_nbr"), F.lit(0)) + 1).alias("n")).scalar()
    fresh = number_rows(bare, "county_name", next_number)
    return numbered.unionByName(fresh.withColumnRenamed("number", "county_nbr"))


MONEY = "decimal(18,2)"


def invoice_rows(feed: DataFrame) -> DataFrame:
    """The feed rolled up to invoices, amounts as money and item numbers as int."""
    rolled = (
        feed.withColumn("item_digits", F.regexp_replace("item_nbr", "[^0-9]+", ""))
        .groupBy(
            "item_invoice_nbr",
            F.col("order_dt").alias("order_date"),
            "state_bottle_cost",
            "state_bottle_retail",
            "item_digits",
            "vendor_nbr",
            "store_nbr",
        )
        .agg(
            F.sum("bottles_sold").alias("bottles_sold"),
            # Line amounts are money: summing them as such makes the total exact.
            F.sum(F.col("sale").cast(MONEY)).alias("total_sale"),
        )
    )
    return rolled.select(
        "item_invoice_nbr",
        "order_date",
        F.col("state_bottle_cost").cast(MONEY).alias("state_bottle_cost"),
        F.col("state_bottle_retail").cast(MONEY).alias("state_bottle_retail"),
        "bottles_sold",
        F.col("total_sale").cast(MONEY).alias("total_sale"),
        F.col("item_digits").try_cast("int").alias("item_nbr"),
        "vendor_nbr",
        "store_nbr",
    )


# The orders fact as invoice_rows makes it.
_AMOUNT = T.DecimalType(18, 2)
ORDERS = T.StructType(
    [
        T.StructField("item_invoice_nbr", T.StringType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("state_bottle_cost", _AMOUNT),
        T.StructField("state_bottle_retail", _AMOUNT),
        T.StructField("bottles_sold", T.LongType()),
        T.StructField("total_sale", _AMOUNT),
        T.StructField("item_nbr", T.IntegerType()),
        T.StructField("vendor_nbr", T.IntegerType()),
        T.StructField("store_nbr", T.IntegerType()),
    ]
)


def refresh_orders(existing: DataFrame | None, feed: DataFrame) -> DataFrame:
    rows = invoice_rows(feed)
    return rows if existing is None else upsert(existing, rows, ["item_invoice_nbr"])


def gallons(millilitres: Column) -> Column:
    """Millilitres as US gallons, exact to more places than anything rounds to."""
    return millilitres.cast("decimal(24,10)") / F.lit("3785.41").cast("decimal(6,2)")


# --- the versions in force, resolved into keys of the fact ---------------------------------------

#: What a resolved order has beside its own columns: the start dates of the rows in force on its day, null where there is none,
#: and the category of its item on that day.
VERSION_KEYS = {"store": "store_start", "item": "item_start", "category": "category_start", "vendor": "vendor_start"}
RESOLVED = T.StructType(
    [
        *ORDERS.fields,
        T.StructField("category_nbr", T.IntegerType()),
        *[T.StructField(c, T.DateType()) for c in VERSION_KEYS.values()],
    ]
)


def resolve_versions(
    orders: DataFrame, store: DataFrame, item: DataFrame, item_detail: DataFrame, category: DataFrame, vendor: DataFrame,
    max_broadcast_bytes: int = BROADCAST_BYTES, staged: bool = False,
) -> DataFrame:
    """The orders with :data:`VERSION_KEYS`: each names, with the dimension's number, one row of the dimension.

    The four as-of joins of the view are done here, once when orders are written; reading is by equality then. With ``staged`` the
    orders are written halfway, so that the shuffles of all four are never on disk together.
    """
    items = (
        item.select("item_nbr", "start_date", "end_date", "orig_item_hash")
        .join(item_detail.select("item_hash", "category_nbr"), F.col("orig_item_hash") == F.col("item_hash"), "left")
        .select("item_nbr", "start_date", "end_date", "category_nbr")
    )
    df = orders.drop("category_nbr", *VERSION_KEYS.values())
    for name, dim, key in (("store", store, "store_nbr"), ("item", items, "item_nbr"), ("category", category, "category_nbr"), ("vendor", vendor, "vendor_nbr")):
        wanted = ["start_date", "end_date", *(["category_nbr"] if name == "item" else [])]
        bounds = {"store": store, "item": item, "category": category, "vendor": vendor}[name]
        joined = interval_join(df, dim.select(key, *wanted), {key: key}, "order_date", max_broadcast_bytes=max_broadcast_bytes, bounds=bounds)
        df = joined.withColumnRenamed("start_date", VERSION_KEYS[name]).drop("end_date")
        if staged and name == "item":
            df = write_stage(df, "half-resolved")
    own = [c for c in orders.columns if c not in RESOLVED.names]
    return df.select(*RESOLVED.names, *own)


def version_changes(old: DataFrame | None, new: DataFrame, key: str, payload: Sequence[str] = ()) -> DataFrame:
    """Where the row in force may be another than before: key, low, high (days).

    A row that is only in one of the two states counts from its start to its end; one whose end moved counts from the earlier end
    to the later one. Days that no such range holds have the row they had.
    """
    if old is None:
        return new.select(key, F.col("start_date").alias("low"), F.col("end_date").alias("high"))
    a = old.select(key, "start_date", *payload, F.col("end_date").alias("was"))
    b = new.select(key, "start_date", *payload, F.col("end_date").alias("is"))
    # Null payloads must meet as well, so the payload is one value that is never null.
    a, b = (x.withColumn("payload", F.to_json(F.struct(*payload)) if payload else F.lit("")).drop(*payload) for x in (a, b))
    both = a.join(b, [key, "start_date", "payload"], "full").where("not (was <=> is)")
    moved = F.col("was").isNotNull() & F.col("is").isNotNull()
    return both.select(
        key,
        F.when(moved, F.date_add(F.least("was", "is"), 1)).otherwise(F.col("start_date")).alias("low"),
        F.greatest("was", "is").alias("high"),
    )


def parts_to_resolve(spark: SparkSession, root: str, parts: Mapping[int, int], changes: Mapping[str, DataFrame]) -> set[int]:
    """The parts of resolved orders that hold an order inside a changed range; ``changes`` are ranges by dimension.

    Only parts of months that a range touches are read, and of these only the keys and the date.
    """
    months = sorted(p for p in parts if p)
    if not months:
        return set()
    found: set[int] = set()
    known = spark.createDataFrame([(p,) for p in months], "part int")
    first = F.make_date(F.floor(F.col("part") / 100), F.col("part") % 100, F.lit(1))
    for name, ranges in changes.items():
        key = f"{name}_nbr"
        low, high = (F.greatest(F.least(F.col(c), F.lit(date(x // 100, x % 100, 28))), F.lit(date(y // 100, y % 100, 1))) for c, x, y in (("low", months[-1], months[0]), ("high", months[-1], months[0])))
        spans = ranges.select(F.trunc(low, "month").alias("a"), F.trunc(high, "month").alias("b")).distinct()  # a few for all keys of a batch
        near = known.withColumn("day", first).join(F.broadcast(spans), F.col("day").between(F.col("a"), F.col("b")), "left_semi")
        some = {r["part"]: parts[r["part"]] for r in near.collect() if r["part"] not in found}
        if not some:
            continue
        facts = read_parts(spark, root, some, RESOLVED).select(key, "order_date", month_part("order_date").alias("part"))
        inside = interval_join(facts, ranges, {key: key}, "order_date", "low", "high", how="left_semi")
        found |= {r[0] for r in inside.select("part").distinct().collect()}
    return found


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def orders_view(
    orders: DataFrame,
    store: DataFrame,
    store_address: DataFrame,
    county: DataFrame,
    item: DataFrame,
    item_detail: DataFrame,
    category: DataFrame,
    vendor: DataFrame,
    max_broadcast_bytes: int = BROADCAST_BYTES,
    staged: bool = False,
) -> DataFrame:
    """Every order with the store, item, category and vendor in force on its date.

    Store, item and vendor are shown as seen on the day (the ``orig`` side), the
    category with gaps filled. Orders that carry :data:`VERSION_KEYS` are joined to them by
    equality; for others the rows in force are looked up by date, dimension by dimension. With ``staged`` the
    orders are written before the last of the joins, so that the shuffles of all are never on disk together; a filter on the view
    does not reach the orders then.
    """
    resolved = set(VERSION_KEYS.values()) <= set(orders.columns)
    # The details are joined to the small dated rows, not once more to the large fact.
    stores = (
        store.select("store_nbr", "start_date", "end_date", "orig_store_hash")
        .join(store_address.drop("store_nbr"), F.col("orig_store_hash") == F.col("store_hash"), "left")
        .join(_prefixed(county, "c_"), F.col("county_nbr") == F.col("c_county_nbr"), "left")
        .select(
            "store_nbr", "start_date", "end_date", "store_name", "store_address", "store_city", "lat", "long",
            "county_nbr", F.col("c_county_name").alias("county_name"),
        )
    )
    items = (
        item.select("item_nbr", "start_date", "end_date", "orig_item_hash")
        .join(item_detail.drop("item_nbr"), F.col("orig_item_hash") == F.col("item_hash"), "left")
        .select("item_nbr", "start_date", "end_date", "item_desc", "category_nbr", "items_per_pack", "item_vol")
    )
    categories = category.select("category_nbr", "start_date", "end_date", "category_desc")
    vendors = vendor.select(
        "vendor_nbr", "start_date", "end_date", F.col("orig_vendor_name").alias("vendor_name")
    )
    df = orders
    # The widest texts come last, so that no shuffle of the fact carries them; the category's number comes with the item.
    for name, dim, bounds in (("vendor", vendors, vendor), ("item", items, item), ("category", categories, category), ("store", stores, store)):
        key = f"{name}_nbr"
        if staged and name == "store":
            df = write_stage(df, "half-viewed")
        if resolved:
            dim = dim.drop("category_nbr") if name == "item" else dim
            df = df.join(dim.withColumnRenamed("start_date", VERSION_KEYS[name]).drop("end_date"), [key, VERSION_KEYS[name]], "left")
        else:
            joined = interval_join(df, dim, {key: key}, "order_date", max_broadcast_bytes=max_broadcast_bytes, bounds=bounds)
            df = joined.drop("start_date", "end_date")
    volume = F.col("bottles_sold").cast("long") * F.coalesce("item_vol", F.lit(0))
    return df.select(
        "item_invoice_nbr", "order_date", "store_nbr", "store_name", "store_address", "store_city", "lat", "long",
        "county_nbr", "county_name", "category_nbr", "category_desc", "vendor_nbr", "vendor_name", "item_nbr",
        "item_desc", "items_per_pack", F.col("item_vol").alias("bottle_vol"), "state_bottle_cost",
        "state_bottle_retail",
        (F.col("state_bottle_retail") - F.col("state_bottle_cost")).alias("state_bottle_profit"),
        "bottles_sold", "total_sale",
        (F.col("total_sale") - F.col("state_bottle_cost") * F.col("bottles_sold")).alias("total_profit"),
        volume.alias("total_volume"),
        gallons(volume).alias("total_volume_gallons"),
    )


def item_view(item: DataFrame, item_detail: DataFrame, category: DataFrame, as_of: bool = False) -> DataFrame:
    """Item history with filled and original descriptions and the category's current name.

    ``as_of`` takes the category name in force when the item row starts instead.
    """
    current = category.filter("current_record = 'Y'").select("category_nbr", "category_desc")
    dated = category.select("category_nbr", "category_desc", F.col("start_date").alias("c_from"), F.col("end_date").alias("c_to"))
    df = item
    for prefix, hash_col in (("", "item_hash"), ("orig_", "orig_item_hash")):
        detail = _prefixed(item_detail.drop("item_nbr"), f"{prefix}d_")
        df = df.join(detail, F.col(hash_col) == F.col(f"{prefix}d_item_hash"), "left")
        key = f"{prefix}d_category_nbr"
        if as_of:
            named = _prefixed(dated, f"{prefix}c_")
            df = interval_join(
                df, named, {key: f"{prefix}c_category_nbr"}, "start_date", f"{prefix}c_c_from", f"{prefix}c_c_to"
            )
        else:
            named = _prefixed(current, f"{prefix}c_")
            df = df.join(named, F.col(key) == F.col(f"{prefix}c_category_nbr"), "left")
    return df.select(
        "item_nbr",
        F.col("d_item_desc").alias("item_desc"),
        F.col("d_items_per_pack").alias("items_per_pack"),
        F.col("d_item_vol").alias("item_vol"),
        F.col("d_category_nbr").alias("category_nbr"),
        F.col("c_category_desc").alias("category_desc"),
        "start_date",
        "end_date",
        "current_record",
        F.col("orig_d_item_desc").alias("orig_item_desc"),
        F.col("orig_d_items_per_pack").alias("orig_items_per_pack"),
        F.col("orig_d_item_vol").alias("orig_item_vol"),
        F.col("orig_d_category_nbr").alias("orig_category_nbr"),
        F.col("orig_c_category_desc").alias("orig_category_desc"),
        "item_hash",
        "orig_item_hash",
    )


def store_view(store: DataFrame, store_address: DataFrame, county: DataFrame) -> DataFrame:
    """Store history with filled and original addresses and counties."""
    shown = ["store_name", "store_address", "store_city", "zip_code", "county", "lat", "long"]
    named = (
        store_address.drop("store_nbr")
        .join(_prefixed(county, "c_"), F.col("county_nbr") == F.col("c_county_nbr"), "left")
        .select("store_hash", *[F.col("c_county_name").alias(c) if c == "county" else F.col(c) for c in shown])
    )
    df = store
    for prefix, hash_col in (("a_", "store_hash"), ("orig_", "orig_store_hash")):
        side = named.select(
            F.col("store_hash").alias(f"{prefix}hash"), *[F.col(c).alias(f"{prefix}{c}") for c in shown]
        )
        df = df.join(side, F.col(hash_col) == F.col(f"{prefix}hash"), "left")
    return df.select(
        "store_nbr",
        *[F.col(f"a_{c}").alias(c) for c in shown],
        "start_date",
        "end_date",
        "current_record",
        *[f"orig_{c}" for c in shown],
        "store_hash",
        "orig_store_hash",
    )


Feed = Callable[[Sequence[str]], DataFrame]

# Hashed dimensions and the table their values are kept in.
DETAILS = {"item": "item_detail", "store": "store_address"}


def build_warehouse(feed: Feed, names: Sequence[str]) -> dict[str, DataFrame]:
    """The named dimension and lookup tables, each written once and read back.

    ``feed`` returns the feed with the wanted columns. A hashed dimension is written with the
    columns behind its original values, which are all values that any day has; its detail table is read from there.
    """

    def build(name: str) -> dict[str, DataFrame]:
        if name == "county":
            return {name: write_stage(county_lookup(feed(["county_nbr", "county_name"])), name)}
        dim, detail = DIMENSIONS[name](), DETAILS.get(name)
        daily = daily_values(feed(FEED_FOR[name]), dim, whole_keys=True)
        if detail is None:
            return {name: write_stage(refresh_dimension(None, daily, dim), name)}
        own = detail_columns(dim)
        rows = write_stage(refresh_dimension(None, daily, dim, own), name)
        seen = rows.withColumnRenamed(f"orig_{dim.value_name}", "value")
        return {detail: write_stage(refresh_detail(None, seen.drop(dim.value_name), dim), detail), name: rows.drop(*own)}

    wanted = [n for n in (*DIMENSIONS, "county") if n in names or DETAILS.get(n) in names]
    # The tables do not depend on each other; their jobs share the cluster.
    with ThreadPoolExecutor(len(wanted)) as pool:
        return {k: v for built in pool.map(build, wanted) for k, v in built.items()}


INVOICE_COLUMNS = [
    "item_invoice_nbr", "order_dt", "state_bottle_cost", "state_bottle_retail", "bottles_sold", "sale", "item_nbr",
    "vendor_nbr", "store_nbr",
]


#: Buckets of a dimension or detail table; a warehouse keeps the number it was started with.
BUCKETS = 32


def refresh_warehouse(spark: SparkSession, feed: Feed, root: str, batch: str | None = None, buckets: int = BUCKETS) -> Manifest:
    """Apply a batch to the tables below ``root`` (or start them); returns the new manifest.

    Every table's new state is written beside the old one. One manifest, written last, switches all
    tables, so a refresh that fails before leaves readers on the old state of all of them, and can
    be run again. A ``batch`` id that was applied before changes nothing.

    Dimensions and details are kept in buckets of their key, of which only those with a key of the batch (or, for details, with
    a new value) are rewritten. Orders are kept in parts by month with the dimension rows in force on their day resolved
    (:func:`resolve_versions`): the parts that the batch touches are rewritten, and those with an older order for
    which the batch changed the row in force. Item numbers that are no
    numbers, or too large for one, are kept with their counts in ``item_rejects``.
    """
    before = read_manifest(spark, root)
    if batch is not None and batch in before.batches:
        return before
    sizes = {name: before.buckets.get(name, buckets) for name in [*DIMENSIONS, *DETAILS.values()]}

    def current(name: str) -> DataFrame | None:
        return _at_version(spark, root, name, before)

    def refresh(name: str) -> dict[str, int | dict[int, int]]:
        if name == "county":
            counties = feed(["county_nbr", "county_name"])
            return {name: publish(county_lookup(counties, existing=current(name)), f"{root}/{name}")}
        if name == "item_rejects":
            rejects = item_rejects(feed(["item_nbr"]))
            old = current(name)
            if old is not None:
                rejects = old.unionByName(rejects).groupBy("item_nbr").agg(F.sum("rows").alias("rows"))
            return {name: publish(rejects, f"{root}/{name}")}
        # The batch is rolled up once and written: the upsert reads it several times.
        return {name: write_stage(invoice_rows(feed(INVOICE_COLUMNS)), "invoices")}

    def refresh_dim(name: str) -> tuple[dict[str, dict[int, int]], DataFrame | None]:
        dim, detail, done = DIMENSIONS[name](), DETAILS.get(name), {}
        daily = write_stage(daily_values(feed(FEED_FOR[name]), dim), f"{name}-daily")
        if detail is not None:
            done[detail] = _refresh_detail_buckets(spark, f"{root}/{detail}", before.parts.get(detail, {}), sizes[detail], daily, dim)
        done[name], old, new = rewrite_buckets(
            daily.select(dim.key_name), f"{root}/{name}", before.parts.get(name, {}), sizes[name], dim.key_name,
            lambda rows: refresh_dimension(rows, daily, dim),
        )
        payload = ["orig_item_hash"] if name == "item" else []
        changes = None if new is None else write_stage(version_changes(old, new, dim.key_name, payload), f"{name}-changes")
        return done, changes

    others = ["county", "item_rejects", "orders"]
    with ThreadPoolExecutor(len(DIMENSIONS) + len(others)) as pool:
        plain = [pool.submit(refresh, name) for name in others]
        dims = {name: pool.submit(refresh_dim, name) for name in DIMENSIONS}
        done = {k: v for p in plain for k, v in p.result().items()}
        dims = {name: p.result() for name, p in dims.items()}
    rows = done.pop("orders")
    parts = {k: v for found, _ in dims.values() for k, v in found.items()}
    tables = {n: table for n in ("store", "item", "item_detail", "category", "vendor") if (table := _of_parts(spark, root, n, parts.get(n))) is not None}

    def resolve(orders: DataFrame) -> DataFrame:
        return resolve_versions(orders, **tables)

    old_parts = before.parts.get("orders", {})
    changes = {name: c for name, (_, c) in dims.items() if c is not None}
    stale = _unresolved(spark, f"{root}/orders", old_parts)
    stale |= parts_to_resolve(spark, f"{root}/orders", {p: v for p, v in old_parts.items() if p not in stale}, changes)
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in RESOLVED.fields if f.name not in ORDERS.names]
    rows = rows.select(*ORDERS.names, *empty)
    parts["orders"] = upsert_parts(rows, f"{root}/orders", old_parts, ["item_invoice_nbr"], month_part("order_date"), stale, resolve)
    after = Manifest(done, parts, sorted(before.batches + ([batch] if batch is not None else [])), sizes)
    write_manifest(spark, root, after)
    return after


def _unresolved(spark: SparkSession, root: str, parts: dict[int, int]) -> set[int]:
    """Parts written by a release that did not resolve versions: they are all due."""
    one_each = {v: p for p, v in parts.items()}
    bare = {v for v, p in one_each.items() if "store_start" not in part_schema(spark, root, {p: v}).names}
    return {p for p, v in parts.items() if v in bare}


def _refresh_detail_buckets(spark: SparkSession, root: str, parts: dict[int, int], buckets: int, daily: DataFrame, dim: Dimension) -> dict[int, int]:
    """Add the batch's new values; only buckets that get one are rewritten."""
    rows = write_stage(detail_rows(daily, dim), "detail-rows")
    into = {r[0] for r in rows.select(bucket_part(dim.value_name, buckets)).distinct().collect()}
    held = {p: v for p, v in parts.items() if p in into}
    if held:
        known = read_parts(spark, root, held, rows.schema)
        rows = write_stage(rows.join(known.select(dim.value_name), dim.value_name, "left_anti").select(*rows.columns), "new-details")
    change = lambda old: rows if old is None else old.unionByName(rows)
    return rewrite_buckets(rows, root, parts, buckets, dim.value_name, change)[0]


def _of_parts(spark: SparkSession, root: str, name: str, parts: dict[int, int] | None) -> DataFrame | None:
    return read_parts(spark, f"{root}/{name}", parts, part_schema(spark, f"{root}/{name}", parts)) if parts else None


def _at_version(spark: SparkSession, root: str, name: str, manifest: Manifest) -> DataFrame | None:
    if name in manifest.parts:
        return _of_parts(spark, root, name, manifest.parts[name])
    if name not in manifest.versions:
        return None
    return spark.read.parquet(f"{root}/{name}/version={manifest.versions[name]}")


def item_rejects(feed: DataFrame) -> DataFrame:
    """Item numbers without digits, or with more than an int holds, and in how many rows of the feed they are."""
    digits = F.regexp_replace("item_nbr", "[^0-9]+", "").try_cast("int")
    return feed.filter(F.col("item_nbr").isNotNull() & digits.isNull()).groupBy("item_nbr").agg(F.count("*").alias("rows"))


def read_warehouse(spark: SparkSession, root: str, months: Container[int] | None = None) -> dict[str, DataFrame]:
    """The current tables below ``root``, named as :func:`orders_view` takes them.

    With ``months`` (as yyyymm) only the files of these months' orders are read.
    """
    manifest = read_manifest(spark, root)
    names = [*DIMENSIONS, *DETAILS.values(), "county"]
    found = {n: table for n in names if (table := _at_version(spark, root, n, manifest)) is not None}
    parts = manifest.parts.get("orders")
    if parts is not None:
        wanted = {p: v for p, v in parts.items() if months is None or p in months}
        found["orders"] = read_parts(spark, f"{root}/orders", wanted, RESOLVED)
    return found
