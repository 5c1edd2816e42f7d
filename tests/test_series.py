"""Series models and clustering on made series."""

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import clusters, series


def test_decomposition_finds_sine_and_trend():
    t = np.arange(52 * 6)
    wave = 10 * np.sin(2 * np.pi * t / 52)
    season, trend, rest = series.decompose_periodic(100 + wave, 52)
    assert np.allclose(season, wave) and np.allclose(trend, 100) and np.allclose(rest, 0)
    # Two passes leave a small part of the slope (26 a year here) in the season.
    season, trend, rest = series.decompose_periodic(100 + 0.5 * t + wave, 52)
    assert np.abs(season - wave).max() < 2 and np.abs(trend - 100 - 0.5 * t).max() < 2
    assert np.allclose(season + trend + rest, 100 + 0.5 * t + wave)
    assert np.allclose(season[:52], season[52:104])


@pytest.mark.parametrize("y", [np.arange(104.0), np.append(np.arange(200.0), np.nan)])
def test_decomposition_refuses(y):
    with pytest.raises(ValueError):
        series.decompose_periodic(y, 52)


def test_local_fit_reproduces_lines():
    y = 3 + 2 * np.arange(1, 41.0)
    assert np.allclose(series.local_fit(y, 11, 1, np.arange(1, 41.0)), y)
    assert np.allclose(series.local_fit(y, 101, 1, np.array([0.0, 41.0])), [3, 85])
    assert np.allclose(series.smooth(y, 11, 1, 4), y)


def weekly(spark, make, groups=("a", "b"), n=160):
    rows = [(g, 200000 + 100 * (i // 52) + i % 52 + 1, float(make(g, i))) for g in groups for i in range(n)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["g", "YrWk", "x"]).sample(frac=1, random_state=1))


def test_groups_and_errors(spark):
    df = weekly(spark, lambda g, i: 5 + i + (i % 52)).filter("g = 'a' or YrWk < 200101")
    out = series.decompose_groups(df, ["g"], "x")
    marks = {r["g"]: (r["e"], r["n"]) for r in out.groupBy("g").agg(F.max("error").alias("e"), F.count("*").alias("n")).collect()}
    assert marks == {"a": (0, 160), "b": (1, 52)}
    rel = series.relative_to_first(out, ["g"])
    assert rel.filter("YrWk = 200001").select("g", "actual").collect() == [("a", 1.0)]
    bands = series.trend_bands(out.filter("g = 'a'"), ["g"]).filter("sd_x is not null")
    assert bands.filter("CI_lower_x > trend or CI_upper_x < trend").count() == 0


def test_rolling_edges(spark):
    df = spark.createDataFrame([(1, i, float(i * i)) for i in range(6)], "g int, YrWk int, x double")
    got = [r["s"] for r in series.rolling_deviation(df, ["g"], {"s": "x"}, 4).orderBy("YrWk").collect()]
    y = np.arange(6.0) ** 2
    want = [y[max(i - 1, 0) : i + 3].std(ddof=1) if len(y[max(i - 1, 0) : i + 3]) > 1 else None for i in range(6)]
    assert np.allclose(got, want)


def test_shift_points():
    noise = np.random.default_rng(0).normal(0, 0.1, 300)
    y = np.concatenate([np.zeros(100), np.full(100, 5.0), np.full(100, 2.0)]) + noise
    found = series.shift_points(y, 26, 0.001)
    # Medians do not feel a few strayed points, so a place is found to within part of min_size.
    assert len(found) == 2 and abs(found[0] - 100) < 15 and abs(found[1] - 200) < 15
    assert series.shift_points(np.ones(100), 10, 0.001) == []
    assert series.shift_points(y[:30], 26, 0.001) == []


def brute_shifts(y, m, beta):
    """All segmentations by recursion with the same gain, for short series."""
    y = (y - y.min()) / (y.max() - y.min())
    n = len(y)
    best, prev = {0: 0.0}, {0: 0}
    best.update({s: 0.0 for s in range(1, n + 1)})
    prev.update({s: 0 for s in range(1, n + 1)})
    for s in range(2 * m, n + 1):
        for t in range(m, s - m + 1):
            if t - prev[t] < m:
                continue
            a, b = t - prev[t], s - t
            gain = a * b / ((a + b) * n) * (np.median(y[prev[t] : t]) - np.median(y[t:s])) ** 2
            if best[t] + gain - beta > best[s]:
                best[s], prev[s] = best[t] + gain - beta, t
    out, at = [], prev[n]
    while at:
        out.append(at)
        at = prev[at]
    return out[::-1]


@pytest.mark.parametrize("seed", range(5))
def test_shift_points_brute_force(seed):
    rng = np.random.default_rng(seed)
    y = np.repeat(rng.normal(0, 3, 4), 12) + rng.normal(0, 0.5, 48)
    assert series.shift_points(y, 5, 0.002) == brute_shifts(y, 5, 0.002)


def test_shifts_on_differences(spark):
    df = weekly(spark, lambda g, i: (i if i < 80 else 80 + 5 * (i - 80)) if g == "a" else 7.0)
    values = series.mean_shifts(df, ["g"], "x", freq=20)
    steps = series.mean_shifts(df, ["g"], "x", freq=20, on_differences=True).collect()
    assert values.filter("g = 'b'").count() == 0
    assert [r["g"] for r in steps] == ["a"] and abs(steps[0]["YrWk"] - 200129) <= 1


def one_model(y, a, b, c, plan):
    level, slope, figure, start = series.start_state(y, plan)
    season, total = list(figure), 0.0
    for i, x in enumerate(y[start - 1 :]):
        s = season[i % plan.period]
        guess = (level + slope) * s if plan.multiplicative else level + slope + s
        total += (x - guess) ** 2
        old = level
        level = a * (x / s if plan.multiplicative else x - s) + (1 - a) * (level + slope)
        slope = b * (level - old) + (1 - b) * slope
        season[i % plan.period] = c * (x / level if plan.multiplicative else x - level) + (1 - c) * s
    return total


@pytest.mark.parametrize("multiplicative", [False, True])
def test_smoothing_errors(multiplicative):
    plan = series.SmoothingPlan(period=4, multiplicative=multiplicative)
    y = 20 + np.arange(30.0) + np.tile([1, -1, 3, -3.0], 8)[:30]
    rates = np.array([[0.2, 0.1, 0.3], [0.9, 0.5, 0.7], [1.5, -1, 0.5]])
    want = [one_model(y, *np.clip(r, 0, 1), plan) for r in rates]
    assert np.allclose(series.smoothing_errors(y, plan, rates), want)


def test_smoothing_without_season_or_trend():
    y = np.array([1.0, 3.0, 4.0, 8.0])
    flat = series.SmoothingPlan(season=False, trend=False)
    assert series.start_state(y, flat)[:2] == (1.0, 2.0) and series.start_state(y, flat)[3] == 2
    assert np.allclose(series.smoothing_errors(y, flat, np.array([[1.0, 0, 0]])), [(3 - 1) ** 2 + (4 - 3) ** 2 + (8 - 4) ** 2])
    line = series.SmoothingPlan(season=False)
    assert series.start_state(y, line)[3] == 3 and series.start_state(y, line)[0] == 3.0


def test_smoothing_checks():
    with pytest.raises(ValueError):
        series.check_rates(0, None, None)
    with pytest.raises(ValueError):
        series.check_rates(0.5, 2, None)
    with pytest.raises(ValueError):
        series.SmoothingPlan(start_periods=1)
    with pytest.raises(ValueError):
        series.start_state(np.zeros(20), series.SmoothingPlan(period=4, multiplicative=True))


def test_given_start_values():
    y = 20 + np.arange(30.0) + np.tile([1, -1, 3, -3.0], 8)[:30]
    plan = series.SmoothingPlan(period=4, level_start=7.0, season_start=(1, 2, 3, 4))
    level, slope, figure, first = series.start_state(y, plan)
    assert (level, list(figure), first) == (7.0, [1, 2, 3, 4], 5) and np.isclose(slope, 1)


def test_grid_and_best(spark):
    df = weekly(spark, lambda g, i: 50 + i + 10 * np.sin(i / 8) + (g == "b") * 3)
    scores = series.smoothing_grid(df, ["g"], "x", [0.2, 0.8], [0.1], [0.1, 0.4])
    assert scores.count() == 8
    totals = scores.groupBy("alpha", "beta", "gamma").agg(F.sum("sse").alias("s")).orderBy("s").first()
    best = series.best_rates(scores).first()
    assert (best["alpha"], best["gamma"], best["series"]) == (totals["alpha"], totals["gamma"], 2)


def blobs(spark, seed=0):
    rng = np.random.default_rng(seed)
    points = np.concatenate([rng.normal(c, 0.1, (40, 2)) for c in ((0, 0), (5, 5), (0, 9))])
    return points, spark.createDataFrame(pd.DataFrame({"id": range(120), "a": points[:, 0], "b": points[:, 1]})).repartition(4)


def test_elbow(spark):
    points, df = blobs(spark)
    wss = {r["k"]: r["wss"] for r in clusters.elbow_curve(df, ["a", "b"], k_max=5, starts=8).collect()}
    assert np.isclose(wss[1], ((points - points.mean(axis=0)) ** 2).sum())
    groups = np.split(points, 3)
    assert np.isclose(wss[3], sum(((g - g.mean(axis=0)) ** 2).sum() for g in groups))
    assert all(wss[k] >= wss[k + 1] - 1e-9 for k in range(1, 3))
    with pytest.raises(ValueError):
        clusters.elbow_curve(df.limit(3), ["a", "b"], k_max=5)


@pytest.mark.parametrize("fit", [clusters.kmeans_clusters, clusters.tree_clusters])
def test_clusters(spark, fit):
    _, df = blobs(spark)
    rows = fit(df, ["a", "b"], k=3).collect()
    labels = [{r["cluster"] for r in rows if r["id"] // 40 == g} for g in range(3)]
    assert all(len(x) == 1 for x in labels) and len(set.union(*labels)) == 3


def plain_ward(x):
    """Heights of Ward merges, each found among all pairs."""
    groups, heights = [[i] for i in range(len(x))], []
    while len(groups) > 1:
        cost = {
            (i, j): 2 * len(a) * len(b) / (len(a) + len(b)) * ((x[a].mean(axis=0) - x[b].mean(axis=0)) ** 2).sum()
            for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j
        }
        (i, j), least = min(cost.items(), key=lambda c: c[1])
        heights.append(least**0.5)
        groups[i] += groups.pop(j)
    return heights


def scattered(spark, n, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 2)) + 6 * rng.integers(0, 3, (n, 2))
    return x, spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double")


def test_ward_tree_is_the_plain_one(spark):
    x, df = scattered(spark, 40)
    tree = clusters.ward_tree(df, ["a", "b"]).orderBy("step").collect()
    np.testing.assert_allclose([r["height"] for r in tree], plain_ward(x))
    assert tree[-1]["n"] == 40
    np.testing.assert_allclose(tree[-1]["spread"], ((x - x.mean(axis=0)) ** 2).sum())
    # Merges name leaves or earlier merges, each once.
    assert sorted(c for r in tree for c in (r["left"], r["right"])) == list(range(2 * 40 - 2))


def test_ward_tree_of_more_rows_than_leaves(spark):
    x, df = scattered(spark, 900)
    tree = clusters.ward_tree(df.unionByName(df).repartition(7), ["a", "b"], leaves=60).orderBy("step").collect()
    heights = [r["height"] for r in tree]
    assert len(tree) == 59 and heights == sorted(heights) and tree[-1]["n"] == 1800
    np.testing.assert_allclose(tree[-1]["spread"], 2 * ((x - x.mean(axis=0)) ** 2).sum())
    groups = clusters.ward_clusters(df, ["a", "b"], 9, leaves=60).collect()
    middle = {tuple(np.round(np.mean([(r["a"], r["b"]) for r in groups if r["cluster"] == c], axis=0) / 6).astype(int)) for c in range(9)}
    assert len(middle) == 9


def test_ward_tree_of_few_rows(spark):
    _, df = scattered(spark, 3)
    assert clusters.ward_tree(df.limit(0), ["a", "b"]).count() == 0
    assert clusters.ward_tree(df.limit(1).unionByName(df.limit(1)), ["a", "b"]).count() == 0
    with pytest.raises(Exception, match="missing or infinite"):
        clusters.ward_tree(df.withColumn("b", F.when(F.col("id") > 0, F.col("b"))), ["a", "b"])


def test_kmeans_rests(spark):
    x, df = scattered(spark, 600)
    rows = clusters.kmeans_clusters(df, ["a", "b"], 9).orderBy("id").collect()
    label = np.array([r["cluster"] for r in rows])
    means = np.stack([x[label == c].mean(axis=0) for c in range(9)])
    far = ((x[:, None] - means) ** 2).sum(axis=2)
    assert (far[np.arange(len(x)), label] <= far.min(axis=1) + 1e-9).all()


def test_elbow_is_near_the_best_of_many_runs(spark):
    x, df = scattered(spark, 300)
    rng = np.random.default_rng(8)
    wss = {r["k"]: r["wss"] for r in clusters.elbow_curve(df, ["a", "b"], k_max=10, starts=10).collect()}
    for k in (1, 2, 5, 9, 10):
        best = np.inf
        for _ in range(50):
            centres = x[rng.choice(len(x), k, replace=False)]
            for _ in range(60):
                near = ((x[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
                centres = np.stack([x[near == c].mean(axis=0) if (near == c).any() else centres[c] for c in range(k)])
            best = min(best, ((x[:, None] - centres) ** 2).sum(axis=2).min(axis=1).sum())
        assert wss[k] <= 1.02 * best


def weekly_series(spark, weeks=170):
    rng = np.random.default_rng(4)
    rows = []
    for g in ("x", "y", "z"):
        level = 50 + np.cumsum(rng.normal(0, 2, weeks)) + 9 * np.sin(np.arange(weeks) * 2 * np.pi / 52)
        rows += [(g, 199000 + i, float(v)) for i, v in enumerate(level)]
    return spark.createDataFrame(rows, "g string, YrWk int, v double")


def test_searched_rates(spark):
    df, rates = weekly_series(spark), [0.1, 0.5, 0.9]
    steps = series.search_rates(df, ["g"], "v", rates, [0.1], rates, steps=8).orderBy("step").collect()
    grid = series.best_rates(series.smoothing_grid(df, ["g"], "v", rates, [0.1], rates)).first()
    assert (steps[0].alpha, steps[0].gamma, steps[0].sse) == (grid.alpha, grid.gamma, grid.sse)
    errors = [s.sse for s in steps]
    assert errors == sorted(errors, reverse=True) and errors[-1] < grid.sse
    best = steps[-1]
    whole = sum(
        series.smoothing_errors(p["v"].to_numpy(), series.SmoothingPlan(), np.array([[best.alpha, best.beta, best.gamma]]))[0]
        for _, p in df.toPandas().sort_values("YrWk").groupby("g")
    )
    np.testing.assert_allclose(best.sse, whole)
    assert all(0 < s.alpha <= 1 and 0 <= s.beta <= 1 and 0 <= s.gamma <= 1 for s in steps)


def test_searched_rates_of_short_series(spark):
    df = weekly_series(spark, 60)
    assert series.search_rates(df, ["g"], "v", [0.5], [0.1], [0.5]).collect() == []
    assert series.search_rates(df.limit(0), ["g"], "v", [0.5], [0.1], [0.5]).collect() == []


@pytest.mark.parametrize("on_differences", [False, True])
def test_shifts_follow_their_sql(spark, on_differences):
    from ledgerline.plans.sqlforms import shifts_sql

    df = weekly_series(spark, 120).withColumn("v", F.col("v") + F.when(F.col("YrWk") > 199060, 40).otherwise(0))
    short = df.where("g = 'x' and YrWk < 199051").withColumn("g", F.lit("short"))
    flat = df.where("g = 'x'").select(F.lit("flat").alias("g"), "YrWk", F.lit(1.0).alias("v"))
    df = df.unionByName(short).unionByName(flat)
    got = series.mean_shifts(df, ["g"], "v", beta=0.0005, on_differences=on_differences)
    said = df.toPandas()  # noqa: F841 - read by the SQL
    sql = shifts_sql("select g, YrWk as w, v as y from said", 0.0005, on_differences)
    want = duckdb.sql(f"with recursive {sql} select g, w, shift from shifts").fetchall()
    assert sorted((r["g"], r["YrWk"], r["shift"]) for r in got.collect()) == sorted(want)
    assert on_differences or {r[0] for r in want} == {"x", "y", "z"}


def test_elbow_passes_leave_out_starts_that_rest(spark, monkeypatch):
    """A start whose centres no longer move is not measured again; the sums of a pass are those of all pairs."""
    import pandas as pd

    from ledgerline.operators import clusters as C

    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(40, 3)) + 100 * i for i in range(3)])
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b", "c"]))
    passes, plain = [], C._assign

    def counted(shared, width):
        passes.append({k: c.shape[0] for k, c in shared.value.items()})
        return plain(shared, width)

    monkeypatch.setattr(C, "_assign", counted)
    curve = {r["k"]: r["wss"] for r in C.elbow_curve(df, ["a", "b", "c"], k_max=4, starts=10).collect()}
    assert any(1 not in some and sum(some.values()) < 40 for some in passes[1:])
    apart = [((x - x.mean(axis=0)) ** 2).sum(), sum(((p - p.mean(axis=0)) ** 2).sum() for p in (x[:40], x[40:80], x[80:]))]
    assert np.allclose([curve[1], curve[3]], apart)

    class Shared:  # two starts of three centres, two of them the same: rows go to the first
        value = {3: np.stack([x[[0, 0, 50]], x[[3, 60, 100]]])}

    got = pd.concat(plain(Shared, 3, 16)(iter([pd.DataFrame(x[:70]), pd.DataFrame(x[70:])])))
    for s, c in enumerate(Shared.value[3]):
        far = ((x[:, None] - c) ** 2).sum(axis=2)
        mine = got[got["start"] == s].sort_values("j")
        assert np.isclose(mine["cost"].sum(), far.min(axis=1).sum())
        for j in range(3):
            rows = x[far.argmin(axis=1) == j]
            row = mine[mine["j"] == j]
            assert row["n"].sum() == len(rows) and np.allclose(row[["s0", "s1", "s2"]].sum(), rows.sum(axis=0))
