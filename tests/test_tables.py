"""Reading, key checks, reshaping and versioned tables."""

from datetime import date, timedelta

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import session
from ledgerline.operators import reshape, weekly
from ledgerline.plans.warehouse import number_rows
from ledgerline.sources import sinks, tables


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_csv_rejects_whatever_is_selected(spark, tmp_path):
    (tmp_path / "f.csv").write_text('id,day,name\n1,2020-01-02,"a, ""b"""\n2,never,c\nx,2020-01-03,d\n')
    schema = T.StructType(
        [T.StructField("id", T.IntegerType()), T.StructField("day", T.DateType()), T.StructField("name", T.StringType())]
    )
    good, bad = tables.load_csv(spark, str(tmp_path), schema)
    assert rows(good) == [(1, date(2020, 1, 2), 'a, "b"')]
    assert rows(good.select("id")) == [(1,)] and bad.count() == 2
    assert sorted(r[0] for r in bad.select(tables.CORRUPT).collect()) == ["2,never,c", "x,2020-01-03,d"]
    head = tables.load_csv_head(spark, str(tmp_path), schema, {"id": "string", "day": "string"}, rows=2)
    assert head.count() == 2 and dict(head.dtypes)["id"] == "string"


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    assert sorted(tables.key_violations(df, ["k"]).collect(), key=str) == [(1, 2), (None, 1)]
    assert tables.key_violations(df, ["k", "v"]).count() == 1
    assert set(tables.PRIMARY_KEYS) >= {"category", "orders", "county"}


def test_insert_absent_and_upsert(spark):
    old = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    new = spark.createDataFrame([(2, "new"), (3, "new"), (3, "new")], "k int, v string")
    assert rows(sinks.insert_absent(old, new, ["k"])) == [(1, "old"), (2, "old"), (3, "new")]
    assert rows(sinks.upsert(old, new, ["k"])) == [(1, "old"), (2, "new"), (3, "new"), (3, "new")]
    assert sinks.append_rows(old, new).count() == 5


def test_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    assert sinks.read_current(spark, root) is None
    first = spark.createDataFrame([(1, "a")], "k int, v string")
    assert sinks.publish(first, root) == 1
    current = sinks.read_current(spark, root)
    # A new state may be computed from the version it replaces.
    assert sinks.publish(sinks.upsert(current, spark.createDataFrame([(2, "b")], "k int, v string"), ["k"]), root) == 2
    assert rows(sinks.read_current(spark, root)) == [(1, "a"), (2, "b")]
    (tmp_path / "t" / "version=3").mkdir()  # a write that never finished
    assert rows(sinks.read_current(spark, root)) == [(1, "a"), (2, "b")]


def test_stages_leave_no_shuffles_on_disk(spark, folder):
    """A stage that is written gives back the disk of its shuffles at once; the setting for it is as before, also with stages in threads."""
    import time
    from concurrent.futures import ThreadPoolExecutor

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {n for n in disk.getAllFiles().mkString("|").split("|") if "/shuffle_" in n}
    before, setting = shuffled(), spark.conf.get(session.SHUFFLE_CLEANUP, None)
    lines = tables.load_parquet(spark, folder, "lineitem")
    counted = [lines.groupBy(c).count() for c in ("l_orderkey", "l_partkey", "l_suppkey")]
    with ThreadPoolExecutor(3) as pool:
        staged = list(pool.map(lambda df: session.write_stage(df, "counted"), counted))
    until = time.time() + 10
    while (left := shuffled() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) == setting
    # What was written and what is asked again from the start are the same.
    assert [sorted(map(tuple, s.collect())) for s in staged] == [sorted(map(tuple, c.collect())) for c in counted]


def test_scratch(spark):
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
    staged = session.write_stage(spark.range(5), "five")
    assert staged.count() == 5 and session.scratch_root(spark) in staged.inputFiles()[0]


def test_numbering(spark):
    names = spark.createDataFrame([(f"n{i:03d}",) for i in range(500)], "name string").repartition(7)
    numbered = number_rows(names, "name", 11).orderBy("name").collect()
    assert [r["number"] for r in numbered] == list(range(11, 511))


def test_minmax(spark):
    df = spark.createDataFrame([(float(i),) for i in (3, 5, 11)], "x double")
    scaled = reshape.scale_minmax(df, "x", "y", keep_bounds=True)
    assert sorted(r["y"] for r in scaled.collect()) == [-1.0, -0.5, 1.0]
    back = scaled.select(reshape.unscale_minmax(F.col("y"), F.col("y_min"), F.col("y_max")))
    assert sorted(r[0] for r in back.collect()) == [3.0, 5.0, 11.0]
    with pytest.raises(SparkRuntimeException, match="alike"):
        reshape.scale_minmax(df.filter("x = 3"), "x", "y").collect()


def test_histogram(spark):
    df = spark.createDataFrame([(float(i),) for i in (0, 1, 2, 2, 10)], "x double")
    got = [(r["bin"], r["n"]) for r in reshape.histogram(df, "x", 5).orderBy("bin").collect()]
    assert got == [(1, 4), (2, 0), (3, 0), (4, 0), (5, 1)]
    flat = reshape.histogram(df.filter("x = 2"), "x", 3).orderBy("bin").collect()
    assert [r["n"] for r in flat] == [2, 0, 0]


def test_pivots(spark):
    df = spark.createDataFrame([(1, "a", 2, 5), (1, "b", 3, 6), (2, "a", 4, 7)], "g int, k string, m int, n int")
    assert rows(reshape.pivot_sum(df, ["g"], "k", "m", ["a", "b"], fill=0, prefix="p_")) == [(1, 2, 3), (2, 4, 0)]
    assert rows(reshape.pivot_sum(df, ["g"], "k", "m", ["a", "b"])) == [(1, 2, 3), (2, 4, None)]
    wide = reshape.pivot_metrics(df, ["g"], "k", ["n", "m"], ["a", "b"])
    assert wide.columns == ["g", "a_m", "a_n", "b_m", "b_n"] and rows(wide) == [(1, 2, 5, 3, 6), (2, 4, 7, 0, 0)]
    assert reshape.pivot_values(df, "k") == ["a", "b"]


def test_spine(spark):
    spine = weekly.day_spine(spark, date(2012, 1, 2), date(2017, 3, 31), weekends=False)
    days = (date(2012, 1, 2) + timedelta(days=i) for i in range((date(2017, 3, 31) - date(2012, 1, 2)).days + 1))
    assert spine.count() == sum(d.weekday() < 5 for d in days) and spine.filter("wkday = 'Sunday'").count() == 0
