"""The warehouse refreshed batch by batch on disk."""

from datetime import date

from pyspark.sql import functions as F

from ledgerline.plans import warehouse as W
from ledgerline.plans.feed import sales_feed
from ledgerline.sources.tables import PRIMARY_KEYS, key_violations


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_two_batches(spark, folder, tmp_path):
    root = str(tmp_path)
    before, after = "order_dt < date '2000-01-01'", "order_dt >= date '2000-01-01'"

    def part(where):
        return lambda columns: sales_feed(spark, folder, [*columns, *({"order_dt"} - set(columns))]).filter(where).select(*columns)

    assert set(W.refresh_warehouse(spark, part(before), root, "one").versions.values()) == {1}
    applied = W.refresh_warehouse(spark, part(after), root, "two")
    assert set(applied.versions.values()) == {2} and applied.batches == ["one", "two"]
    assert {v for p, v in applied.parts["orders"].items() if p >= 200000} == {2}
    some = W.read_warehouse(spark, root, months=range(200001, 200004))["orders"]
    assert {r[0] for r in some.select(F.date_format("order_date", "yyyyMM")).distinct().collect()} == {"200001", "200002", "200003"}
    tables = W.read_warehouse(spark, root)
    for name, make in W.DIMENSIONS.items():
        dim = make()
        first = W.refresh_dimension(None, W.daily_values(part(before)(W.FEED_FOR[name]), dim), dim)
        second = W.refresh_dimension(first, W.daily_values(part(after)(W.FEED_FOR[name]), dim), dim)
        assert same(tables[name], second)
        assert key_violations(tables[name], PRIMARY_KEYS[name]).count() == 0
        current = tables[name].filter("current_record = 'Y'")
        assert current.count() == tables[name].select(dim.key_name).distinct().count() == current.select(dim.key_name).distinct().count()
    for name, key in (("item_detail", "item_hash"), ("store_address", "store_hash"), ("county", "county_nbr")):
        assert key_violations(tables[name], [key]).count() == 0
    missing = tables["item"].join(tables["item_detail"], F.col("orig_item_hash") == tables["item_detail"]["item_hash"], "left_anti")
    assert missing.count() == 0

    orders = tables.pop("orders")
    view = W.orders_view(orders, **tables)
    assert view.count() == orders.count() and view.filter("store_city is null").count() == 0

    # A batch that was applied before changes nothing.
    assert W.refresh_warehouse(spark, part(before), root, "one") == applied
    assert same(W.read_warehouse(spark, root)["vendor"], tables["vendor"])

    # The same rows under another name: nothing is lost, no day is left uncovered.
    W.refresh_warehouse(spark, part(after), root, "three")
    again = W.read_warehouse(spark, root)
    assert again["orders"].count() == orders.count()
    assert again["item_detail"].count() == tables["item_detail"].count()
    assert again["vendor"].filter("current_record = 'Y'").count() == tables["vendor"].filter("current_record = 'Y'").count()


def test_views_keep_every_order_when_dimensions_are_merged_or_broadcast(spark, folder):
    feed = lambda columns: sales_feed(spark, folder, columns)
    names = ["store", "store_address", "county", "item", "item_detail", "category", "vendor"]
    tables = W.build_warehouse(feed, names)
    orders = W.refresh_orders(None, feed(W.INVOICE_COLUMNS))
    broadcast = W.orders_view(orders, **tables)
    merged = W.orders_view(orders, **tables, max_broadcast_bytes=0)
    assert "SortMergeJoin" in merged._jdf.queryExecution().executedPlan().toString()
    assert same(broadcast, merged)


def test_counties_are_added_to_what_is_there(spark):
    feed = lambda *rows: spark.createDataFrame(rows, "county_nbr int, county_name string")
    first = W.county_lookup(feed((1, "adair"), (2, "polk"), (None, "lost"), (None, "lost")))
    assert sorted(map(tuple, first.collect())) == [(1, "Adair"), (2, "Polk"), (3, "Lost")]
    second = W.county_lookup(feed((7, "linn"), (2, "other"), (None, "lost"), (None, "new")), existing=first)
    assert sorted(map(tuple, second.collect())) == [(1, "Adair"), (2, "Polk"), (3, "Lost"), (7, "Linn"), (8, "New")]


def test_failed_refresh_leaves_all_tables_as_they_were(spark, folder, tmp_path, monkeypatch):
    root = str(tmp_path)
    feed = lambda columns: sales_feed(spark, folder, columns)
    W.refresh_warehouse(spark, feed, root, "one")
    before = {n: t.count() for n, t in W.read_warehouse(spark, root).items()}

    def broken(*_):
        raise RuntimeError("lost before the switch")

    monkeypatch.setattr(W, "write_manifest", broken)
    try:
        W.refresh_warehouse(spark, feed, root, "two")
    except RuntimeError:
        pass
    assert {n: t.count() for n, t in W.read_warehouse(spark, root).items()} == before
    monkeypatch.undo()
    assert set(W.refresh_warehouse(spark, feed, root, "two").versions.values()) == {3}


def test_scratch_folder_of_a_cluster_must_be_named(spark):
    import pytest

    from ledgerline.session import scratch_root

    class Session:
        def __init__(self, **settings):
            self.settings, self.conf = settings, self

        def get(self, name, default=None):
            return self.settings.get(name, default)

    with pytest.raises(ValueError):
        scratch_root(Session(**{"spark.master": "spark://host:7077"}))
    assert scratch_root(Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///x/"})) == "hdfs:///x"


def test_upsert_rewrites_touched_parts_only(spark, tmp_path):
    from datetime import date

    from ledgerline.sources.sinks import month_part, read_parts, upsert_parts

    frame = lambda *rows: spark.createDataFrame(rows, "k int, d date, v string")
    old = frame((1, date(2020, 1, 5), "a"), (2, date(2020, 2, 5), "b"), (3, date(2020, 2, 6), "c"), (4, date(2020, 3, 1), "d"), (5, None, "e"))
    root, part = str(tmp_path / "t"), month_part("d")
    first = upsert_parts(old, root, {}, ["k"], part)
    assert first == {202001: 1, 202002: 1, 202003: 1, 0: 1}
    before = sorted((p.name, p.stat().st_mtime_ns) for p in (tmp_path / "t" / "version=1" / "part=202001").iterdir())
    # Key 2 moves to April, key 3 goes with it: nothing is left of February.
    second = upsert_parts(frame((2, date(2020, 4, 1), "moved"), (3, date(2020, 4, 2), "too")), root, first, ["k"], part)
    assert second == {202001: 1, 202003: 1, 0: 1, 202004: 2}
    assert before == sorted((p.name, p.stat().st_mtime_ns) for p in (tmp_path / "t" / "version=1" / "part=202001").iterdir())
    got = sorted((r.k, r.v) for r in read_parts(spark, root, second, old.schema).collect())
    assert got == [(1, "a"), (2, "moved"), (3, "too"), (4, "d"), (5, "e")]
    assert read_parts(spark, root, {}, old.schema).count() == 0


def test_parts_ruled_out_by_their_key_filter_are_not_opened(spark, tmp_path):
    import shutil
    from datetime import date

    from ledgerline.sources.sinks import month_part, read_parts, upsert_parts

    rows = [(f"INV-{m:02d}-{k:05d}" if m != 5 else f"INV-{k % 12 + 1:02d}-x{k:05d}", date(2020, m, 1 + k % 28), m) for m in range(1, 13) for k in range(500)]
    old = spark.createDataFrame(rows, "k string, d date, v int")
    root, part = str(tmp_path / "t"), month_part("d")
    parts = upsert_parts(old, root, {}, ["k"], part)
    # Keys of February move to December; one new key. May holds keys of every month's range, so only its filter rules it out.
    batch = spark.createDataFrame([(f"INV-02-{k:05d}", date(2020, 12, 5), -1) for k in range(20)] + [("INV-04-new", date(2020, 12, 6), -2)], "k string, d date, v int")
    for p in (1, 3, 4, 5, 6, 7, 8, 9, 10, 11):  # whoever opens one of these finds no files
        shutil.move(tmp_path / "t" / "version=1" / f"part={202000 + p}", tmp_path / f"away-{p}")
    after = upsert_parts(batch, root, parts, ["k"], part)
    assert {p for p, v in after.items() if v == 2} == {202002, 202012} and len(after) == 12
    for p in (1, 3, 4, 5, 6, 7, 8, 9, 10, 11):
        shutil.move(tmp_path / f"away-{p}", tmp_path / "t" / "version=1" / f"part={202000 + p}")
    gone = {f"INV-02-{k:05d}" for k in range(20)}
    want = sorted([r for r in rows if r[0] not in gone] + [tuple(r) for r in batch.collect()])
    assert sorted(map(tuple, read_parts(spark, root, after, old.schema).collect())) == want


def test_key_filters_never_miss_and_rarely_admit(spark, tmp_path):
    from ledgerline.sources.keyfilters import parts_to_open, write_key_filters

    root = str(tmp_path)
    rows = spark.range(40_000).selectExpr("cast(id % 7 as int) as part", "cast(id * 3 as string) as k", "id % 11 as n")
    rows = rows.unionByName(spark.createDataFrame([(9, None, 1), (8, "12", None)], "part int, k string, n long"))
    write_key_filters(rows, root, 1, ["k", "n"])
    parts = dict.fromkeys([*range(7), 8, 9], 1)
    for k in (0, 1, 12_345, 39_999):
        one = spark.createDataFrame([(str(k * 3), k % 11)], "k string, n long")
        assert k % 7 in parts_to_open(one, root, parts, ["k", "n"])
    absent = spark.range(300).selectExpr("cast(id * 3 + 1 as string) as k", "id % 11 as n")
    assert len(parts_to_open(absent, root, parts, ["k", "n"])) <= 2  # 300 keys and 7 filters: 0.1 are expected
    assert parts_to_open(absent, root, parts | {77: 5}, ["k", "n"]) >= {77}  # written without filters: always opened
    assert parts_to_open(absent.where("false"), root, parts, ["k", "n"]) == set()
    nulls = spark.createDataFrame([(None, None)], "k string, n long")
    assert parts_to_open(nulls, root, parts, ["k", "n"]) == set()


def test_late_batches_resolve_what_they_change(spark, folder, tmp_path):
    """A batch of older days: the resolved view equals the view by dates, and only parts it changes are rewritten."""
    root = str(tmp_path)

    def part(where):
        return lambda columns: sales_feed(spark, folder, [*columns, *({"order_dt"} - set(columns))]).filter(where).select(*columns)

    def views():
        tables = W.read_warehouse(spark, root)
        orders = tables.pop("orders")
        return W.orders_view(orders, **tables), W.orders_view(orders.select(*W.ORDERS.names), **tables)

    W.refresh_warehouse(spark, part("order_dt < date '1997-01-01' or order_dt >= date '1997-07-01'"), root, "one")
    assert same(*views())
    first = W.read_manifest(spark, root)
    # One store's late days: its keys change the row in force of later orders of the same keys alone.
    late = part("order_dt between date '1997-02-01' and date '1997-02-03'")
    second = W.refresh_warehouse(spark, late, root, "late")
    resolved, dated = views()
    assert same(resolved, dated) and "store_start" in W.read_warehouse(spark, root)["orders"].columns
    assert {v for p, v in second.parts["orders"].items() if 0 < p < 199701} == {1}  # earlier months keep their files
    for name in ("vendor", "item", "store", "item_detail"):
        kept = {p for p, v in second.parts[name].items() if v == first.parts[name].get(p)}
        assert kept or name == "vendor"
        dim = W.DIMENSIONS[name]() if name in W.DIMENSIONS else None
        if dim is not None:
            keys = W.daily_values(late(W.FEED_FOR[name]), dim).select(dim.key_name)
            from ledgerline.sources.sinks import bucket_part

            assert kept == set(second.parts[name]) - {r[0] for r in keys.select(bucket_part(dim.key_name, second.buckets[name])).collect()}
    assert second.buckets["vendor"] == W.BUCKETS
    joins = resolved._jdf.queryExecution().optimizedPlan().toString()
    assert "order_date" not in "".join(line for line in joins.split("\n") if "Join" in line)  # equality on keys only


def test_version_changes_name_the_days_that_differ(spark):
    from datetime import date

    d = lambda m: date(2020, m, 1)
    end, kind = date(2999, 12, 31), "k int, start_date date, end_date date, v string"
    old = spark.createDataFrame([(1, d(1), end, "a"), (2, d(1), d(5), "a"), (2, d(6), end, None), (3, d(1), end, "a")], kind)
    new = spark.createDataFrame([(1, d(1), date(2020, 2, 29), "a"), (1, d(3), end, "b"), (2, d(1), d(5), "a"), (2, d(6), end, None), (3, d(1), end, "z")], kind)
    got = sorted(map(tuple, W.version_changes(old, new, "k", ["v"]).collect()))
    assert got == [(1, d(3), end), (1, d(3), end), (3, d(1), end), (3, d(1), end)]
    assert sorted(map(tuple, W.version_changes(None, new, "k").collect()))[0] == (1, d(1), date(2020, 2, 29))
    assert W.version_changes(old, new, "k").where("k <> 1").count() == 0


def test_daily_values_meet_once_by_key_and_day(spark):
    """One shuffle counts the raw texts, one brings a key's day together for both of its counts, however its texts are cleaned."""
    feed = spark.createDataFrame(
        [(1, "north", date(2020, 1, 1)), (1, "North ", date(2020, 1, 1)), (1, "south", date(2020, 1, 1)), (1, "", date(2020, 1, 2)), (None, "x", date(2020, 1, 1))],
        "vendor_nbr int, vendor_name string, order_dt date",
    )
    daily = W.daily_values(feed, W.vendor_dimension())
    assert sorted(daily.select("vendor_nbr", "order_dt", "value", "usable").collect()) == [(1, date(2020, 1, 1), "North", True), (1, date(2020, 1, 2), None, False)]
    plan = daily._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 2


def test_upsert_computes_its_rows_once(spark, tmp_path):
    """What an upsert writes is made in one pass over the rows and written once; parts and key filters come from the files."""
    import os
    from datetime import date

    from ledgerline.session import scratch_root
    from ledgerline.sources.sinks import month_part, read_parts, upsert_parts

    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def marked(v):
        made.add(1)
        return v.upper()

    frame = lambda *rows: spark.createDataFrame(rows, "k int, d date, v string")
    old = frame((1, date(2020, 1, 5), "a"), (2, date(2020, 2, 5), "b"), (2, date(2020, 3, 5), "c"), (None, None, "e"))
    root, part = str(tmp_path / "t"), month_part("d")
    finish = lambda df: df.withColumn("v", marked("v"))
    staged = set(os.listdir(scratch_root(spark)))
    first = upsert_parts(old, root, {}, ["k"], part, finish=finish)
    assert first == {202001: 1, 202002: 1, 202003: 1, 0: 1} and made.value == 4
    second = upsert_parts(frame((2, date(2020, 1, 1), "moved")), root, first, ["k"], part, finish=finish)
    assert second == {202001: 2, 0: 1} and made.value == 6
    assert sorted((r.k or 0, r.v) for r in read_parts(spark, root, second, old.schema).collect()) == [(0, "E"), (1, "A"), (2, "MOVED")]
    assert set(os.listdir(scratch_root(spark))) == staged


def test_a_dimension_and_its_details_come_from_one_pass(spark, folder):
    """Daily values dealt by whole keys are not shuffled again for their history, and the details are read from the dimension's stage."""
    feed = lambda columns: sales_feed(spark, folder, columns)
    tables = W.build_warehouse(feed, ["store", "store_address", "item", "item_detail", "category", "vendor", "county"])
    for name, make in W.DIMENSIONS.items():
        dim = make()
        daily = W.daily_values(feed(W.FEED_FOR[name]), dim)
        assert same(W.refresh_dimension(None, daily, dim), tables[name])
        if name in W.DETAILS:
            rows = (W.refresh_detail(None, daily, dim), tables[W.DETAILS[name]])
            assert sorted(map(str, rows[0].collect())) == sorted(map(str, rows[1].select(*rows[0].columns).collect()))
    rows = spark.createDataFrame([(1, "north", date(2020, 1, 1)), (1, None, date(2020, 1, 2)), (2, "south", date(2020, 1, 1))], "vendor_nbr int, vendor_name string, order_dt date")
    dim = W.vendor_dimension()
    made = W.refresh_dimension(None, W.daily_values(rows, dim, whole_keys=True), dim)
    plan = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 2  # raw texts, then one for days, winners and history; it was a third before
    assert same(made, W.refresh_dimension(None, W.daily_values(rows, dim), dim))


def test_details_hold_every_value_of_a_day(spark):
    """Values that only unusable days have, or that come back later, are details as well; the payload stays with its own run."""
    d = lambda n: date(2020, 1, n)
    kind = "item_nbr string, item_desc string, category_nbr int, pack int, bottle_vol int, order_dt date"
    rows = [("1", "gin", 5, 6, 750, d(1)), ("x1", "gin", 5, 6, 750, d(2)), ("1", None, 5, 6, None, d(3)), ("1", "gin", 5, 6, 750, d(4)), ("2", " ", None, None, None, d(1)), (None, "rum", 1, 1, 1, d(1)), ("3", "rum", 1, 1, 1, None)]
    made = W.build_warehouse(lambda columns: spark.createDataFrame(rows, kind).select(*columns), ["item", "item_detail"])
    joined = made["item"].join(made["item_detail"].drop("item_nbr"), made["item"]["orig_item_hash"] == made["item_detail"]["item_hash"], "left")
    got = sorted(map(tuple, joined.select("item_nbr", "start_date", "item_desc", "category_nbr", "items_per_pack", "item_vol").collect()))
    assert got == [(1, date(1, 1, 1), "Gin", 5, 6, 750), (1, d(3), None, 5, 6, None), (1, d(4), "Gin", 5, 6, 750), (2, date(1, 1, 1), None, None, None, None)]
    assert made["item_detail"].count() == 3 and "item_desc" not in made["item"].columns


def test_no_shuffle_of_the_view_carries_the_store_texts(spark, folder):
    """The store, which has the widest texts, is joined last: the fact is shuffled before it has them."""
    feed = lambda columns: sales_feed(spark, folder, columns)
    tables = W.build_warehouse(feed, ["store", "store_address", "county", "item", "item_detail", "category", "vendor"])
    view = W.orders_view(W.refresh_orders(None, feed(W.INVOICE_COLUMNS)), **tables, max_broadcast_bytes=0)
    top = view._jdf.queryExecution().optimizedPlan()
    while top.nodeName() != "Join":
        top = top.children().head()
    assert "store_name" in top.right().output().mkString() and "store_name" not in top.left().output().mkString()
    assert "item_desc" in top.left().output().mkString()


def test_views_of_orders_written_halfway_are_the_same(spark, folder):
    feed = lambda columns: sales_feed(spark, folder, columns)
    tables = W.build_warehouse(feed, ["store", "store_address", "county", "item", "item_detail", "category", "vendor"])
    orders = W.refresh_orders(None, feed(W.INVOICE_COLUMNS))
    view = W.orders_view(orders, **tables, staged=True)
    assert same(W.orders_view(orders, **tables), view)
    assert "lineitem.parquet" not in view._jdf.queryExecution().executedPlan().toString()  # the last join reads the half that was written
    known = {n: tables[n] for n in ("store", "item", "item_detail", "category", "vendor")}
    assert same(W.resolve_versions(orders, **known), W.resolve_versions(orders, **known, staged=True))
