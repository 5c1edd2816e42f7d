"""Histories on hand fixtures and on random data."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import history as H
from ledgerline.sources import sinks


def d(text):
    return date.fromisoformat(f"2020-{text}")


def text_rows(df, *columns):
    return sorted(tuple(str(x) if isinstance(x, date) else x for x in r) for r in df.select(*columns).collect())


def events(spark, rows):
    return spark.createDataFrame(rows, "k int, day date, v string")


def build(spark, rows):
    return H.build_history(H.daily_dominant(events(spark, rows), "k", "day", ["v"]), "k", "day", "v")


COLUMNS = ("start_date", "end_date", "value", "orig_value", "current_record")

CASES = {
    "plain change": (
        [("01-01", "A"), ("01-05", "A"), ("01-10", "B")],
        [("0001-01-01", "2020-01-09", "A", "A", "N"), ("2020-01-10", "2999-12-31", "B", "B", "Y")],
    ),
    "inner null": (
        [("01-01", "A"), ("01-05", None), ("01-10", "B")],
        [
            ("0001-01-01", "2020-01-04", "A", "A", "N"),
            ("2020-01-05", "2020-01-09", "A", None, "N"),
            ("2020-01-10", "2999-12-31", "B", "B", "Y"),
        ],
    ),
    "leading null": (
        [("01-01", None), ("01-05", "A")],
        [("0001-01-01", "2020-01-04", "A", None, "N"), ("2020-01-05", "2999-12-31", "A", "A", "Y")],
    ),
    "only null": ([("01-01", None)], [("0001-01-01", "2999-12-31", None, None, "Y")]),
    "tie": ([("01-01", "B"), ("01-01", "A")], [("0001-01-01", "2999-12-31", "A", "A", "Y")]),
    "majority": ([("01-01", "B"), ("01-01", "A"), ("01-01", "B")], [("0001-01-01", "2999-12-31", "B", "B", "Y")]),
}


@pytest.mark.parametrize("name", CASES)
def test_first_build(spark, name):
    rows, expected = CASES[name]
    dim = H.merge_history(None, build(spark, [(1, d(day), v) for day, v in rows]), "k")
    assert text_rows(dim, *COLUMNS) == sorted(expected, key=str)


@pytest.mark.parametrize(
    "batch, expected",
    [
        (
            [("02-01", "C")],
            [
                ("0001-01-01", "2020-01-09", "A", "A", "N"),
                ("2020-01-10", "2020-01-31", "B", "B", "N"),
                ("2020-02-01", "2999-12-31", "C", "C", "Y"),
            ],
        ),
        (
            [("01-08", "C")],
            [("0001-01-01", "2020-01-07", "A", "A", "N"), ("2020-01-08", "2999-12-31", "C", "C", "Y")],
        ),
        # The same batch again splits the first interval but leaves no gap.
        (
            [("01-01", "A"), ("01-05", "A"), ("01-10", "B")],
            [
                ("0001-01-01", "2019-12-31", "A", "A", "N"),
                ("2020-01-01", "2020-01-09", "A", "A", "N"),
                ("2020-01-10", "2999-12-31", "B", "B", "Y"),
            ],
        ),
    ],
)
def test_merge(spark, batch, expected):
    plain = H.merge_history(None, build(spark, [(1, d(day), v) for day, v in CASES["plain change"][0]]), "k")
    other = H.merge_history(None, build(spark, [(2, d("01-01"), "Z")]), "k")
    existing = plain.unionByName(other)
    fresh = build(spark, [(1, d(day), v) for day, v in batch] + [(3, d("03-01"), "N")])
    merged = H.merge_history(existing, fresh, "k")
    assert text_rows(merged.filter("k = 1"), *COLUMNS) == expected
    assert text_rows(merged.filter("k = 2"), *COLUMNS) == [("0001-01-01", "2999-12-31", "Z", "Z", "Y")]
    assert text_rows(merged.filter("k = 3"), *COLUMNS) == [("0001-01-01", "2999-12-31", "N", "N", "Y")]
    # The same by the separate steps.
    stepwise = sinks.close_open_rows(sinks.delete_from(existing, fresh, "k"), fresh, "k")
    kept = [r for r in text_rows(merged, "k", *COLUMNS) if r in text_rows(stepwise, "k", *COLUMNS)]
    assert kept == text_rows(stepwise, "k", *COLUMNS)


def random_rows(seed, keys=60, days=40):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(keys):
        for day in sorted(rng.choice(days, rng.integers(1, days), replace=False)):
            for _ in range(rng.integers(1, 4)):
                v = [None, "A", "B", "C"][rng.integers(0, 4)]
                rows.append((k, d("01-01") + timedelta(days=int(day)), v))
    return rows


def check_cover(df):
    """Intervals of a key are disjoint and cover all days; exactly one row is current."""
    by_key = {}
    for r in df.collect():
        by_key.setdefault(r["k"], []).append((r["start_date"], r["end_date"], r["current_record"]))
    for spans in by_key.values():
        spans.sort()
        assert spans[0][0] == date(1, 1, 1) and spans[-1][1] == date(2999, 12, 31)
        assert all(b[0] == a[1] + timedelta(days=1) for a, b in zip(spans, spans[1:]))
        assert [s[2] for s in spans] == ["N"] * (len(spans) - 1) + ["Y"]


def test_random_cover_and_twin(spark):
    rows = random_rows(3)
    fresh = build(spark, rows).persist()
    check_cover(H.merge_history(None, fresh, "k"))
    daily = H.daily_dominant(events(spark, rows), "k", "day", ["v"])
    both = H.stack_histories(daily, F.col("v").isNotNull())
    twin = H.merge_null_histories(H.history_intervals(both, ["null_incld", "k"], "day", "v"), "k", "v")
    columns = ("k", "start_dt", "end_dt", "orig_start_dt", "value", "orig_value")
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, fresh.select(*columns).collect())) == sorted(map(key, twin.select(*columns).collect()))


def test_random_batches_stay_gap_free(spark):
    rows = random_rows(5)
    cut = d("01-20")
    early = build(spark, [r for r in rows if r[1] < cut])
    late = build(spark, [r for r in rows if r[1] >= d("01-12")])
    dim = H.merge_history(H.merge_history(None, early, "k"), late, "k")
    check_cover(dim)


def test_busy_key(spark):
    """A key with a third of all rows gives the same history as the same days once each."""
    days = spark.range(0, 300).select(F.date_add(F.lit(d("01-01")), (F.col("id") % 200).cast("int")).alias("day"), "id")
    base = days.select(
        F.lit(1).alias("k"), "day", F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit(None)), (F.dayofmonth("day") % 3 + 1)).alias("v")
    )
    once = H.build_history(H.daily_dominant(base, "k", "day", ["v"]), "k", "day", "v")
    many = base.crossJoin(spark.range(0, 200)).drop("id")
    busy = H.build_history(H.daily_dominant(many, "k", "day", ["v"]), "k", "day", "v")
    assert once.exceptAll(busy).count() == 0 and busy.exceptAll(once).count() == 0


def test_validity_branches(spark):
    rows = [
        (d("01-01"), d("01-05"), None, d("01-10")),
        (d("01-01"), d("01-05"), d("01-01"), d("01-05")),
        (d("01-05"), d("01-05"), d("01-01"), d("01-05")),
        (d("01-01"), d("01-05"), d("01-01"), d("01-03")),
        (d("01-01"), d("01-05"), d("01-01"), None),
    ]
    df = spark.createDataFrame(rows, "s date, e date, p date, n date")
    start, end = H.validity_bounds(F.col("s"), F.col("e"), F.col("p"), F.col("n"))
    got = [(str(a), str(b)) for a, b in df.select(start, end).collect()]
    assert got == [
        ("0001-01-01", "2020-01-09"),
        ("2020-01-01", "2020-01-04"),
        ("2020-01-05", "0001-01-01"),
        ("2020-01-01", "0001-01-01"),
        ("2020-01-01", "2999-12-31"),
    ]


def test_empty_equals_null_in_change_flag(spark):
    df = spark.createDataFrame([(None, None, "A"), ("x", None, ""), ("x", "", None), ("x", "A", "B")], "p string, l string, v string")
    assert [r[0] for r in df.select(H.change_flag(F.col("p"), F.col("l"), F.col("v"))).collect()] == [1, 0, 0, 1]


def test_stack_nulls_fixture(spark):
    rows = [
        (1, "a", "1900-01-01", "N", 1), (1, "a", "1900-01-01", "Y", 1), (2, "b", "1900-01-02", "N", 6),
        (2, "b", "1900-01-02", "Y", 6), (3, "c", "1900-01-04", "N", 14), (4, "c", "1900-01-07", "Y", 19),
    ]
    schema = "id_nbr bigint, id_hash string, order_dt string, null_indicator string, occurance_count int"
    df = spark.createDataFrame(rows, schema).withColumn("id_hash", F.md5("id_hash"))
    out = H.stack_nulls(df)
    counts = {r[0]: r[1] for r in out.groupBy("null_incld").count().collect()}
    assert counts == {"N": 3, "Y": 6}
    assert H.stack_nulls(df.limit(0)).count() == 0


def test_windows_of_a_history_are_spread_over_all_parts(spark):
    """Rows that are sorted and windowed by key are not packed into a few tasks, however few bytes they were sent in."""
    daily = H.daily_dominant(events(spark, [(k, d(f"01-0{day}"), "AB"[day % 2]) for k in range(40) for day in (1, 2, 3)]), "k", "day", ["v"])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for history in (H.build_history(daily, "k", "day", "v"), H.history_intervals(daily, ["k"], "day", "v")):
        assert history.rdd.getNumPartitions() == parts
        assert history.count() == 120 and history.groupBy("k").count().where("count = 3").count() == 40
