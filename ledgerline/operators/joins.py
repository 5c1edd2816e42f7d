"""Joins on dates and on the newest record of a key.

Catalyst and adaptive execution broadcast a side whose size is under the session's
threshold and sort-merge (with skew splitting) otherwise; a broadcast is asked for only
after counting the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import write_stage


def _day_number(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date"))


#: Intervals of a key beyond which its days are looked up by tiles.
BUSY_INTERVALS = 128
#: Estimated bytes of a dimension up to which it is broadcast.
BROADCAST_BYTES = 64 << 20


def _estimated_bytes(df: DataFrame, rows: int) -> int:
    """Rows times a width per row: 40 bytes for a text, 8 for anything else, 16 for the row itself."""
    return rows * (16 + sum(40 if kind == "string" else 8 for _, kind in df.dtypes))


@dataclass(frozen=True)
class _Busy:
    """The keys with many intervals, bounds for these intervals' days, and the rows of all other intervals.

    A busy key has a ``__grain``: the tile level of its average interval, below which no tile is cut; ``__low`` and ``__high``, the
    bounds of its own days; ``__apart`` tells whether no two of its intervals share a day. ``apart`` and ``crossing`` count the keys of
    either kind, ``apart_rows`` the intervals of the first.
    """

    keys: DataFrame | None
    low: int
    high: int
    rest: int
    apart: int = 0
    crossing: int = 0
    apart_rows: int = 0


def _busy(intervals: DataFrame, keys: Sequence[str], start: str, end: str, limit: int) -> _Busy:
    """One job over the intervals, which brings back five numbers; only if there are busy keys, these are written and counted."""
    first, last = (_day_number(F.col(c)) for c in (start, end))
    # Open ends are no days: they are cut to just outside the others.
    dates = F.array(F.when(F.year(start) > 1, first), F.when(F.year(end) < 2999, last))
    per_key = intervals.groupBy(*keys).agg(
        F.count("*").alias("n"), F.min(F.array_min(dates)).alias("low"), F.max(F.array_max(dates)).alias("high"),
        # Intervals that share no day are no longer in all than from the first start to the last end.
        (F.sum(last - first + 1) <= F.max(last) - F.min(first) + 1).alias("__apart"),
    )
    busy = F.col("n") > limit
    found = per_key.agg(
        F.count(F.when(busy, 1)).alias("keys"), F.sum(F.when(~busy, F.col("n"))).alias("rest"),
        F.min(F.when(busy, F.col("low"))).alias("low"), F.max(F.when(busy, F.col("high"))).alias("high"),
    ).first()
    low, high = (found["low"] or 0) - 1, (found["high"] or 0) + 1
    if not found["keys"]:
        return _Busy(None, low, high, found["rest"] or 0)
    own_low, own_high = F.coalesce("low", F.lit(low)), F.coalesce("high", F.lit(high))
    average = F.greatest((own_high - own_low + 1) / F.col("n"), F.lit(1))
    grain, bounds = F.floor(F.log2(average)).cast("int").alias("__grain"), ((own_low - 1).alias("__low"), (own_high + 1).alias("__high"))
    counted = write_stage(per_key.where(busy).select(*keys, "n", grain, *bounds, "__apart"), "busy_counts")
    # Whether they do share one is asked only of keys that pass, which have no more intervals than the calendar days.
    before = Window.partitionBy(*keys).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    passing = counted.where("__apart").select(*keys)
    if found["keys"] * (16 + 8 * len(keys)) <= BROADCAST_BYTES:
        passing = F.broadcast(passing)
    passed = intervals.select(*keys, start, end).join(passing, list(keys), "left_semi")
    crossed = passed.withColumn("__reach", F.max(end).over(before)).where(F.col("__reach") >= F.col(start)).select(*keys).distinct()
    crossed = crossed.withColumn("__crossed", F.lit(True))
    marked = counted.join(crossed, list(keys), "left").withColumn("__apart", F.col("__apart") & F.col("__crossed").isNull()).drop("__crossed")
    marked = write_stage(marked, "busy_keys")
    apart, many, rows = marked.agg(F.count(F.when(F.col("__apart"), 1)), F.count("*"), F.sum(F.when(F.col("__apart"), F.col("n")))).first()
    return _Busy(marked.drop("n"), low, high, found["rest"] or 0, apart, many - apart, rows or 0)


def _clamped_day(day: Column, busy: _Busy) -> Column:
    """Days from the lowest bound, held to the bounds; null days stay null. Clamping is monotone, so a clamped interval still holds its clamped days."""
    n = _day_number(day)
    return F.when(n.isNotNull(), F.least(F.greatest(n, F.lit(busy.low)), F.lit(busy.high)) - F.lit(busy.low))


def _span(day: Column) -> Column:
    """The span of days of its key that a day lies in: 32 average intervals long, so that cutting there adds few rows; null for null.

    Days outside the key's own bounds, as open ends are, count as the bounds.
    """
    n = _day_number(day)
    held = F.when(n.isNotNull(), F.least(F.greatest(n, F.col("__low")), F.col("__high")) - F.col("__low"))
    return F.call_function("shiftright", held, F.col("__grain") + 5)


def _tile(level: Column, day: Column) -> Column:
    return level.cast("long") * F.lit(1 << 32) + F.floor(day / F.pow(F.lit(2.0), level)).cast("long")


def _tiles(intervals: DataFrame, keys: Sequence[str], busy: _Busy, start: str, end: str) -> DataFrame:
    """Intervals of busy keys, each with the dyadic tiles of its own size that it touches: ``__level``, ``__tile``.

    A tile of level l is 2**l days from a multiple of 2**l on. An interval takes the level of its length (the key's grain at least), so
    that it touches two tiles at most, and a day lies in one tile of each level.
    """
    a, b = _clamped_day(F.col(start), busy), _clamped_day(F.col(end), busy)
    cut = intervals.join(busy.keys.select(*keys, "__grain"), list(keys)).withColumns({"__a": a, "__b": b})
    level = F.greatest(F.col("__grain"), F.ceil(F.log2(F.col("__b") - F.col("__a") + 1)).cast("int"))
    cut = cut.withColumn("__level", level)
    first, last = _tile(F.col("__level"), F.col("__a")), _tile(F.col("__level"), F.col("__b"))
    return cut.withColumn("__tile", F.explode(F.sequence(first, last))).drop("__a", "__b", "__grain")


#: Stands for the day where a key's rows are compared with all its intervals.
_ANY_DAY = "0001-01-01"


def _looked_up(points: DataFrame, day: str, dim: DataFrame, keys: Sequence[str], busy: _Busy, start: str, end: str) -> DataFrame:
    """Points of busy keys with the dimension rows in force on their day: a point looks into one tile of every level that its key uses."""
    tiles = write_stage(_tiles(dim, keys, busy, start, end), "tiles")
    levels = tiles.groupBy(*keys).agg(F.collect_set("__level").alias("__levels"))  # as many as a day count has bits at most
    looked = points.join(levels, list(keys)).withColumn("__level", F.explode("__levels")).drop("__levels")
    looked = looked.withColumn("__tile", _tile(F.col("__level"), _clamped_day(F.col(day), busy)))
    met = looked.drop("__level").join(tiles.drop("__level"), [*keys, "__tile"])
    return met.where((F.col(start) <= F.col(day)) & (F.col(end) >= F.col(day))).drop("__tile")


def _last_started(days: DataFrame, day: str, dim: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Days with the dimension rows in force, for keys whose intervals share no day: the last one to start is the only one that can be.

    Days are distinct per key, so a window holds no more than a calendar of days and one of intervals.
    """
    columns = [c for c in dim.columns if c not in keys]
    told = dim.select(*keys, F.col(start).alias(day), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row"))
    asked = days.select(*keys, day).withColumn("__row", F.lit(None).cast(told.schema["__row"].dataType))
    so_far = Window.partitionBy(*keys).orderBy(F.col(day), F.col("__row").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = told.unionByName(asked).withColumn("__last", F.last("__row", ignorenulls=True).over(so_far)).where("__row is null")
    met = met.where(F.col("__last").isNotNull() & (F.col("__last")[end] >= F.col(day)))
    return met.select(*keys, day, *[F.col("__last")[c].alias(c) for c in columns])


def _on_days(days: DataFrame, day: str, dim: DataFrame, keys: Sequence[str], busy: _Busy, start: str, end: str) -> DataFrame:
    """Distinct days of busy keys with the dimension rows in force: by tiles only where a key's intervals share days."""
    if not busy.apart:
        return _looked_up(days, day, dim, keys, busy, start, end)
    apart = busy.keys.where("__apart").select(*keys)
    own = days.join(apart, list(keys), "left_semi") if busy.crossing else days
    found = _last_started(own, day, dim.join(apart, list(keys), "left_semi"), keys, start, end)
    if not busy.crossing:
        return found
    others = _Busy(busy.keys.where("not __apart"), busy.low, busy.high, busy.rest)
    crossing = days.join(others.keys.select(*keys), list(keys), "left_semi")
    return found.unionByName(_looked_up(crossing, day, dim, keys, others, start, end))


def _starting_inside(points: DataFrame, day: str, dim: DataFrame, keys: Sequence[str], busy: _Busy, start: str, end: str) -> DataFrame:
    """Points with the dimension rows of their key in force on their day; all columns of both, pairs only."""
    inside = (F.col(start) <= F.col(day)) & (F.col(end) >= F.col(day))
    if busy.keys is None:
        return points.join(dim.hint("merge"), list(keys)).where(inside)
    few = dim.join(busy.keys.select(*keys), list(keys), "left_anti")
    plain = points.join(few, list(keys)).where(inside)
    if not busy.apart:
        return _looked_up(points, day, dim, keys, busy, start, end).unionByName(plain)
    days = points.select(*keys, F.col(day).alias("__when")).dropna().distinct().join(busy.keys.select(*keys), list(keys), "left_semi")
    found = _on_days(days, "__when", dim, keys, busy, start, end)
    return points.withColumn("__when", F.col(day)).join(found, [*keys, "__when"]).drop("__when").unionByName(plain)


def interval_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    day: str,
    start: str = "start_date",
    end: str = "end_date",
    how: str = "left",
    busy_intervals: int = BUSY_INTERVALS,
    max_broadcast_bytes: int = BROADCAST_BYTES,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Join each fact to the dimension rows of its key in force on its day.

    ``on`` maps fact key to dimension key. Most keys have few intervals: their facts are
    joined on the key and tested against them. A key whose value changes often has thousands: if its intervals share no day, they and
    its facts meet by key and span of days (:func:`_span`), without a look at the facts before. If some do, its distinct days are
    looked up first, by dyadic tiles (:func:`_tiles`), and its facts are joined on key and day. So no fact is multiplied,
    no interval is spread over many spans or more than two tiles, and no pair is found twice. The dimension's key columns are dropped.

    The intervals are counted per key first, in one job over the dimension (or over ``bounds``, the same keys and days, where a
    dimension takes joins to make); a dimension of up to
    ``max_broadcast_bytes``, as estimated from its rows and columns, is broadcast, a larger one
    sort-merged, where adaptive execution splits busy keys.
    """
    keys = list(on.values())
    valid = F.col(start) <= F.col(end)
    dim = dim.filter(valid)
    busy = _busy(dim if bounds is None else bounds.select(*keys, start, end).filter(valid), keys, start, end, busy_intervals)
    if busy.keys is None:
        left, side, rows = facts.withColumn("__fact_span", F.lit(0)), dim.withColumn("__span", F.lit(0)), busy.rest
    else:
        marks = ["__grain", "__low", "__high", "__apart"]
        few_keys = _estimated_bytes(busy.keys, busy.apart + busy.crossing) <= max_broadcast_bytes
        marked = F.broadcast(busy.keys) if few_keys else busy.keys
        left = facts.join(marked.select(*[F.col(d).alias(f) for f, d in on.items()], *marks), list(on), "left")
        plain = F.col("__apart").isNull()
        of_day = F.when(plain, 0).when(F.col("__apart"), _span(F.col(day))).otherwise(_day_number(F.col(day)))
        side = dim.join(marked.select(*keys, *marks), keys, "left").where(plain | F.col("__apart"))
        spans = F.when(plain, F.array(F.lit(0))).otherwise(F.sequence(_span(F.col(start)), _span(F.col(end))))
        side = side.withColumn("__span", F.explode(spans)).drop(*marks)
        rows = busy.rest + 2 * busy.apart_rows
        if busy.crossing:
            others = _Busy(busy.keys.where("not __apart"), busy.low, busy.high, busy.rest)
            days = left.where("not __apart").select(*[F.col(f).alias(d) for f, d in on.items()], F.col(day).alias("__when")).dropna().distinct()
            # A day is looked up once, however many facts it has.
            found = write_stage(_looked_up(days, "__when", dim, keys, others, start, end), "on_their_days")
            side = side.unionByName(found.withColumn("__span", _day_number(F.col("__when"))).drop("__when"))
            rows += found.count()
        left = left.withColumn("__fact_span", of_day).drop(*marks)
    renamed = {d: f"__{d}" for d in keys}
    estimate = _estimated_bytes(side, rows)
    side = side.withColumnsRenamed(renamed)
    side = F.broadcast(side) if estimate <= max_broadcast_bytes else side.hint("merge")
    same_key = reduce(lambda a, b: a & b, [F.col(f) == F.col(renamed[d]) for f, d in on.items()])
    in_force = (F.col(start) <= F.col(day)) & (F.col(end) >= F.col(day))
    joined = left.join(side, same_key & (F.col("__fact_span") == F.col("__span")) & in_force, how)
    return joined.drop("__fact_span", "__span", *renamed.values())


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_dates: tuple[str, str],
    right_dates: tuple[str, str],
    left_id: Sequence[str],
    how: str = "left",
    busy_intervals: int = BUSY_INTERVALS,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join intervals that overlap, per key; ``left_id`` identifies a left row.

    Where no key has many right intervals, rows meet on the key alone. Otherwise a pair overlaps in one of two ways: the left one
    starts on a day of the right one, or the right one starts later, on a day of the left one. Both are interval
    joins of a start day, so pairs are found once, neither side is spread over its days, and the intervals of a busy
    key are never all compared with each other. Both sides are
    read more than once: give written ones.
    """
    start, end = left_dates
    right = right.filter(F.col(right_dates[0]) <= F.col(right_dates[1]))
    busy = _busy(right, keys, *right_dates, busy_intervals)
    ids = [c for c in left_id if c not in keys]
    right_columns = [c for c in right.columns if c not in keys]
    wanted = [*keys, *ids, *right_columns]
    own = left.filter(F.col(start) <= F.col(end))
    if busy.keys is None:
        side = F.broadcast(right) if _estimated_bytes(right, busy.rest) <= max_broadcast_bytes else right.hint("merge")
        meet = (F.col(start) <= F.col(right_dates[1])) & (F.col(end) >= F.col(right_dates[0]))
        pairs = own.select(*keys, *{*ids, *left_dates}).join(side, list(keys)).filter(meet).select(*wanted)
    else:
        # Both sides are read several times from here on.
        right = write_stage(right, "right_intervals")
        spans = write_stage(own.select(*keys, *ids, F.col(start).alias("__from"), F.col(end).alias("__to")), "left_intervals")
        inside = _starting_inside(spans, "__from", right, keys, busy, *right_dates).select(*wanted)
        later = _starting_inside(right, right_dates[0], spans, keys, _busy(spans, keys, "__from", "__to", busy_intervals), "__from", "__to")
        pairs = inside.unionByName(later.filter(F.col("__from") < F.col(right_dates[0])).select(*wanted))
    return left.join(pairs, [*keys, *ids], how)


def newest(df: DataFrame, key: str, order: Sequence[Column] | None = None) -> DataFrame:
    """The first row of each key by ``order`` (default: latest end, then latest start).

    Other columns break ties, so the result does not depend on row order. The rank
    limit is applied before the shuffle as well, so a busy key sends one row per task.
    """
    if order is None:
        order = [F.desc("End_dt"), F.desc("Start_dt")]
    ties = [F.asc_nulls_last(f"`{c}`") for c in df.columns]
    rank = F.row_number().over(Window.partitionBy(f"`{key}`").orderBy(*order, *ties))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def add_detail(
    df: DataFrame,
    details: Mapping[str, DataFrame],
    wanted: Sequence[str],
    group_cols: Sequence[str] = (),
    keep_number: bool = True,
    names: Mapping[str, str] | None = None,
) -> tuple[DataFrame, list[str]]:
    """Add the newest description of each wanted number column, and follow the grouping along.

    ``details`` maps 'Item', 'Vendor', 'Category', 'Store' to lookup frames; a wanted
    column is '<one of these>_Number' or the name ``names`` gives it. Names of this kind, also with
    dots as in 'Item.Number', give the pattern for the lookups' other columns: what stands before
    'Number' is the kind and a separator, so names end in the same separator. An item row brings
    its own vendor and category, so those lookups are used only without it. A lookup
    column the frame already has (the validity dates of an earlier lookup) stays out.
    Returns the frame and its new group columns.
    """
    number = {k: f"{k}_Number" for k in ("Item", "Vendor", "Category", "Store")}
    describe = {"Item": "Item_Description", **{k: f"{k}_Name" for k in ("Vendor", "Category", "Store")}}
    drop = ["Category_Number", "Category_Name", "Vendor_Number", "Vendor_Name"]
    if names:
        number.update(names)
        separators = {n[len(k) : -len("Number")] for k, n in names.items() if n.startswith(k) and n.endswith("Number")}
        if len(separators) == 1:
            mark = separators.pop()
            number = {k: names.get(k, f"{k}{mark}Number") for k in number}
            describe = {k: d.replace("_", mark) for k, d in describe.items()}
            drop = [d.replace("_", mark) for d in drop]
    has_item = number["Item"] in wanted
    for kind in ("Item", "Vendor", "Category", "Store"):
        key = number[kind]
        if key not in wanted or (kind in ("Vendor", "Category") and has_item):
            continue
        lookup = details[kind]
        if kind == "Item":
            lookup = lookup.drop(*drop)
        order = None if kind in ("Item", "Store") else [F.col(f"`{key}`")]
        row = newest(lookup, key, order)
        df = df.join(row.drop(*[c for c in row.columns if c in df.columns and c != key]), key, "inner")
    groups = list(group_cols)
    if any(w in groups for w in wanted):
        groups += [describe[k] for k, n in number.items() if n in wanted and describe[k] in df.columns]
    if not keep_number:
        groups = [g for g in groups if g not in wanted]
        df = df.drop(*wanted)
    return df, groups


def star_filter(facts: DataFrame, items: DataFrame, stores: DataFrame, item_key: str, store_key: str) -> DataFrame:
    """Facts of the given items and stores with their columns; the rest is dropped."""
    return facts.join(items, item_key, "inner").join(stores, store_key, "inner")
