"""Dated joins against brute force, and the plans they get."""

from collections import Counter
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators.joins import _busy, _tiles, add_detail, interval_join, newest, overlap_join
from ledgerline.operators.weekly import share_of_parent, weekly_totals, year_over_year

START = date(2020, 1, 1)


def intervals(rng, keys):
    rows = []
    for k in range(keys):
        cuts = sorted(rng.choice(400, rng.integers(1, 60), replace=False))
        bounds = [date(1, 1, 1)] + [START + timedelta(days=int(c)) for c in cuts]
        ends = [b - timedelta(days=1) for b in bounds[1:]] + [date(2999, 12, 31)]
        rows += [(k, f"{k}-{i}", a, b) for i, (a, b) in enumerate(zip(bounds, ends)) if i % 5 != 3]
    return rows


def facts(rng, n, keys):
    days = [date(1900, 1, 1), date(2500, 6, 1), None] + [START + timedelta(days=i) for i in range(-30, 430)]
    return [(i, int(rng.integers(0, keys + 2)), days[rng.integers(0, len(days))]) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"busy_intervals": 20}, {"busy_intervals": 20, "max_broadcast_bytes": 0}, {"busy_intervals": 0}])
def test_interval_join(spark, options):
    rng = np.random.default_rng(1)
    dim, fact = intervals(rng, 8), facts(rng, 1500, 8)
    df = interval_join(
        spark.createDataFrame(fact, "i int, k int, day date"),
        spark.createDataFrame(dim, "k int, v string, start_date date, end_date date"),
        {"k": "k"}, "day", **options,
    )
    got = sorted((r["i"], r["v"] or "") for r in df.collect())
    want = []
    for i, k, day in fact:
        hits = [v for kk, v, a, b in dim if day is not None and kk == k and a <= day <= b]
        want += [(i, v) for v in hits] or [(i, "")]
    assert got == sorted(want)


def test_interval_join_inner(spark):
    dim = spark.createDataFrame([(1, "x", date(2020, 1, 1), date(2020, 1, 31))], "k int, v string, start_date date, end_date date")
    fact = spark.createDataFrame([(1, date(2020, 1, 31)), (1, date(2020, 2, 1))], "k int, day date")
    assert interval_join(fact, dim, {"k": "k"}, "day", how="inner").count() == 1


def test_only_busy_keys_have_tiles_and_few(spark):
    rng = np.random.default_rng(4)
    rows = intervals(rng, 8) + [(3, "long", START, START + timedelta(days=399)), (4, "day", START, START)]
    dim = spark.createDataFrame(rows, "k int, v string, start_date date, end_date date")
    sizes = {r["k"]: r["count"] for r in dim.groupBy("k").count().collect()}
    busy = _busy(dim, ["k"], "start_date", "end_date", 20)
    tiles = _tiles(dim, ["k"], busy, "start_date", "end_date").collect()
    assert {r["k"] for r in tiles} == {k for k, n in sizes.items() if n > 20} and busy.rest == sum(n for n in sizes.values() if n <= 20)
    per = Counter((r["k"], r["v"]) for r in tiles)
    assert len(per) == sum(n for n in sizes.values() if n > 20) and max(per.values()) <= 2
    assert _busy(dim, ["k"], "start_date", "end_date", 500).keys is None


@pytest.mark.parametrize("limit, size", [(128, 64 << 20), (128, 0), (10, 64 << 20), (0, 0)])
def test_overlap_join(spark, limit, size):
    rng = np.random.default_rng(2)
    left, right = intervals(rng, 6), intervals(rng, 5)
    df = overlap_join(
        spark.createDataFrame(left, "k int, v string, a date, b date"),
        spark.createDataFrame(right, "k int, w string, c date, d date"),
        ["k"], ("a", "b"), ("c", "d"), ["k", "a"], busy_intervals=limit, max_broadcast_bytes=size,
    )
    got = sorted((r["v"], r["w"] or "") for r in df.collect())
    want = []
    for k, v, a, b in left:
        hits = [w for kk, w, c, e in right if kk == k and a <= e and b >= c]
        want += [(v, w) for w in hits] or [(v, "")]
    assert got == sorted(want)


def test_newest_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 5, 2), (1, 4, 9), (2, 1, 1)], "k int, End_dt int, Start_dt int")
    out = newest(df, "k")
    assert sorted(map(tuple, out.collect())) == [(1, 5, 2), (2, 1, 1)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().toString()


def test_share_of_parent(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), (None, "z", 5), ("c", "q", 0)], "g string, h string, n int")
    shares = {r["h"]: r["s"] for r in share_of_parent(df, ["g"], {"n": "s"}).collect()}
    assert shares == {"x": 0.25, "y": 0.75, "z": 1.0, "q": None}
    whole = {r["h"]: r["s"] for r in share_of_parent(df, [], {"n": "s"}).collect()}
    assert whole == {"x": 1 / 9, "y": 3 / 9, "z": 5 / 9, "q": 0.0}


def test_year_over_year_numbers(spark):
    rows = [("a", date(2020, 1, 3), 10), ("a", date(2020, 3, 3), 99), ("a", date(2019, 1, 5), 4), ("b", date(2020, 1, 9), 6)]
    facts = spark.createDataFrame(rows, "g string, Date date, n int")
    weekly = weekly_totals(facts, ["g"], "Date", {"Sales": "n"})
    report = {r["g"]: r.asDict() for r in year_over_year(weekly, ["g"], date(2020, 1, 10), ["Sales"]).collect()}
    assert (report["a"]["Cur_Sales"], report["a"]["L_52_Sales"], report["a"]["Sales_PercD"]) == (10, 4, 1.5)
    assert report["b"]["Sales_PercD"] is None and report["b"]["Cur_Sales_MkShare"] == 6 / 16
    one = {r["g"]: r["Cur_Sales"] for r in year_over_year(weekly, ["g"], date(2020, 1, 10), ["Sales"], ytd=False).collect()}
    assert one == {"b": 6}
    doubled = weekly.unionAll(weekly)
    again = {r["g"]: r["Cur_Sales"] for r in year_over_year(doubled, ["g"], date(2020, 1, 10), ["Sales"], distinct_rows=True).collect()}
    assert again == {"a": 10, "b": 6}


def test_plans(spark, folder):
    from ledgerline.plans.catalog_history import priority_history
    from ledgerline.plans.catalog_relations import yoy_ytd
    from ledgerline.plans.feed import sales_feed

    plan = priority_history(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3  # value counts, day winners, then one for all windows
    assert "Cartesian" not in plan
    feed = sales_feed(spark, folder, ["category_nbr", "order_dt"]).filter(F.col("order_dt") >= F.lit(date(2000, 1, 1)))
    text = feed._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" not in text and "supplier.parquet" not in text
    assert "ReadSchema: struct<l_partkey:bigint,l_shipdate:timestamp_ntz>" in text
    assert "Cartesian" not in yoy_ytd(spark, folder)._jdf.queryExecution().executedPlan().toString()


def test_add_detail(spark):
    df = spark.createDataFrame([(1, 10, 7, 100), (2, 10, 8, 200), (9, 11, 7, 300)], "Item_Number int, Vendor_Number int, Store_Number int, Sales int")
    item = spark.createDataFrame(
        [(1, "old", "v", "2020", "2019"), (1, "new", "v", "2021", "2020"), (2, "two", "w", "2021", "2019")],
        "Item_Number int, Item_Description string, Vendor_Name string, End_dt string, Start_dt string",
    )
    vendor = spark.createDataFrame([(10, "ten"), (10, "ten b"), (11, "eleven")], "Vendor_Number int, Vendor_Name string")
    store = spark.createDataFrame([(7, "seven", "2021", "2020"), (8, "eight", "2021", "2020")], "Store_Number int, Store_Name string, End_dt string, Start_dt string")
    details = {"Item": item, "Vendor": vendor, "Store": store}
    full, groups = add_detail(df, details, ["Item_Number", "Vendor_Number", "Store_Number"], ["Item_Number"])
    assert groups == ["Item_Number", "Item_Description", "Store_Name"]
    got = {(r["Item_Description"], r["Store_Name"], r["Sales"]) for r in full.collect()}
    assert got == {("new", "seven", 100), ("two", "eight", 200)}
    short, groups = add_detail(df, details, ["Vendor_Number"], ["Vendor_Number", "Store_Number"], keep_number=False)
    assert groups == ["Store_Number", "Vendor_Name"] and "Vendor_Number" not in short.columns
    assert {r["Vendor_Name"] for r in short.collect()} == {"ten", "eleven"}


@pytest.mark.parametrize("crossing", [False, True])
def test_days_of_busy_keys_whose_intervals_share_no_day(spark, crossing):
    """A sorted pass answers for keys with disjoint intervals; keys with intervals that share days keep the tiles."""
    day0 = date(2020, 1, 1)
    dim = [(k, day0 + timedelta(days=3 * i), day0 + timedelta(days=3 * i + i % 3), 100 * k + i) for k in (1, 2) for i in range(20)]
    dim += [(1, date(1, 1, 1), day0 - timedelta(days=5), -1), (3, day0, day0 + timedelta(days=5), 300)]
    if crossing:  # nested, and with gaps, so that the lengths alone do not show it
        dim += [(2, day0 + timedelta(days=3), day0 + timedelta(days=3), 999), (2, date(2999, 1, 1), date(2999, 12, 31), 998)]
    facts = [(k, None if d is None else day0 + timedelta(days=d), n) for k in (1, 2, 3, 4, None) for d in (*range(-8, 66), None) for n in (0, 1)]
    dims = spark.createDataFrame(dim, "k int, start_date date, end_date date, v int")
    busy = _busy(dims, ["k"], "start_date", "end_date", 4)
    assert (busy.apart, busy.crossing) == ((1, 1) if crossing else (2, 0))
    got = interval_join(spark.createDataFrame(facts, "f int, day date, n int"), dims, {"f": "k"}, "day", busy_intervals=4)
    want = Counter()
    for f, d, n in facts:
        found = [r[1:] for r in dim if r[0] == f and d is not None and r[1] <= d <= r[2]]
        want.update((f, d, n, *r) for r in found or [(None, None, None)])
    assert Counter(map(tuple, got.select("f", "day", "n", "start_date", "end_date", "v").collect())) == want


def test_facts_of_busy_keys_are_not_read_before_the_join(spark):
    """Keys whose intervals share no day meet their facts by key and span of days: no job over the facts, and a filter on them reaches their scan."""
    dim = [(k, START + timedelta(days=2 * i), START + timedelta(days=2 * i + 1), 1000 * k + i) for k in (1, 2) for i in range(200)]
    dim += [(1, date(1, 1, 1), START - timedelta(days=9), -1), (2, START + timedelta(days=900), date(2999, 12, 31), -2), (3, START, START, 7), (None, START, START, 8)]
    dims = spark.createDataFrame(dim, "k int, start_date date, end_date date, v int")
    unread = spark.range(3).select(F.raise_error(F.lit("read")).cast("int").alias("k"), F.lit(START).alias("day"))
    interval_join(unread, dims, {"k": "k"}, "day")  # raised when the days of the facts were looked up here
    facts = [(k, None if d is None else START + timedelta(days=d)) for k in (1, 2, 3, 4, None) for d in (-800_00, -9, -5, *range(0, 410, 7), 899, 900, 90_000, None)]
    frame = spark.createDataFrame(facts, "k int, day date")
    want = Counter()
    for k, d in facts:
        want.update([(k, d, r[3]) for r in dim if r[0] == k and k is not None and d is not None and r[1] <= d <= r[2]] or [(k, d, None)])
    for size in (0, 64 << 20):
        joined = interval_join(frame, dims, {"k": "k"}, "day", max_broadcast_bytes=size, bounds=dims.drop("v"))
        assert Counter(map(tuple, joined.select("k", "day", "v").collect())) == want
    semi = interval_join(frame, dims, {"k": "k"}, "day", how="left_semi")
    assert Counter(map(tuple, semi.select("k", "day").collect())) == Counter({(k, d): n for (k, d, v), n in want.items() if v is not None})
