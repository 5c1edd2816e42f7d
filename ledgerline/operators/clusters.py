"""Clustering of profiles (one row per store or customer, one column per month)."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ledgerline.session import write_stage

# The functions below travel with their job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="error").transform(df)


def kmeans_clusters(
    df: DataFrame, columns: Sequence[str], k: int = 5, seed: int = 1, tol: float = 1e-9, max_iterations: int = 500
) -> DataFrame:
    """The frame with a ``cluster`` column.

    Centres are seeded by parallel oversampling and moved until none moves by more than ``tol``; a fit that
    has not come to rest after ``max_iterations`` raises.
    """
    vectors = _vectors(df, columns)
    model = KMeans(k=k, seed=seed, tol=tol, maxIter=max_iterations, featuresCol="features", predictionCol="cluster").fit(vectors)
    if model.summary.numIter >= max_iterations:
        raise ValueError(f"the centres still move after {max_iterations} iterations")
    return model.transform(vectors).drop("features")


def tree_clusters(df: DataFrame, columns: Sequence[str], k: int = 5, seed: int = 1) -> DataFrame:
    """Divisive clusters: stands in for an agglomerative tree, which needs all pairs of rows."""
    vectors = _vectors(df, columns)
    model = BisectingKMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(vectors)
    return model.transform(vectors).drop("features")


def tree_levels(df: DataFrame, columns: Sequence[str], k_max: int = 5, seed: int = 1) -> DataFrame:
    """The divisive tree cut at every size: a column ``level_<k>`` of labels for each k from 2 to ``k_max``."""
    vectors = _vectors(df, columns)
    out = vectors
    for k in range(2, k_max + 1):
        model = BisectingKMeans(k=k, seed=seed, featuresCol="features", predictionCol=f"level_{k}").fit(vectors)
        out = model.transform(out)
    return out.drop("features")


_SUM_FIELDS = "k int, start int, j int, n long, cost double"


def elbow_curve(
    df: DataFrame, columns: Sequence[str], k_max: int = 15, starts: int = 50, iterations: int = 15, seed: int = 1
) -> DataFrame:
    """Least within-cluster sum of squares for k = 1..k_max over several random starts.

    All k and all starts advance together: one pass over the rows per iteration updates
    every model that still moves, instead of one pass per model and iteration. The first centres are drawn from the
    weighted candidates of ``oversampled``, in proportion to weight and squared distance from the centres drawn
    before; a k whose starts all end above the curve goes on from the centres of k - 1. A pass returns one row of sums per centre, so what reaches the driver depends on k_max, starts and
    the number of columns only. Columns: k, wss.
    """
    spark = df.sparkSession
    names = [f"s{i}" for i in range(len(columns))]
    points = df.select(*[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(columns, names)])
    points = write_stage(points, "profiles")
    # Each partition sends one row per centre and iteration, so there are not more than keep the cluster busy.
    parts = min(2 * spark.sparkContext.defaultParallelism, -(-points.count() // 1000))
    points = points.repartition(max(parts, 1)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        pool, weight = oversampled(points, names, 2 * k_max, seed)
        if len(pool) < k_max:
            raise ValueError("more clusters than distinct rows")
        rng = np.random.default_rng(seed)
        centres = {k: np.stack([_drawn(pool, weight, k, rng) for _ in range(starts)]) for k in range(1, k_max + 1)}
        centres, costs = _advanced(points, names, centres, iterations)
        best = {k: int(costs[k].argmin()) for k in centres}
        for k in range(2, k_max + 1):
            below = centres[k - 1][best[k - 1]]
            if costs[k].min() > costs[k - 1].min():
                # No start of k found its way: the centres of one less and the candidate farthest from them are no worse.
                far = ((pool[:, None] - below) ** 2).sum(axis=2).min(axis=1).argmax()
                more, cost = _advanced(points, names, {k: np.concatenate([below, pool[[far]]])[None]}, iterations)
                centres[k], costs[k], best[k] = more[k], cost[k], 0
    finally:
        points.unpersist()
    curve = [(k, float(costs[k].min())) for k in range(1, k_max + 1)]
    return spark.createDataFrame(curve, "k int, wss double")


def _advanced(
    points: DataFrame, names: Sequence[str], centres: dict[int, np.ndarray], iterations: int
) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
    """The centres of all models after some iterations, and each model's squared distances to them."""
    spark = points.sparkSession
    moving = {k: np.arange(len(c)) for k, c in centres.items()}
    costs = {k: np.zeros(len(c)) for k, c in centres.items()}
    for step in range(iterations + 1):
        shared = spark.sparkContext.broadcast({k: centres[k][some] for k, some in moving.items()})
        sums = (
            points.mapInPandas(_assign(shared, len(names)), _SUM_FIELDS + "".join(f", {n} double" for n in names))
            .groupBy("k", "start", "j")
            .agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), *[F.sum(n).alias(n) for n in names])
            .toArrow()
            .to_pandas()
        )
        shared.unpersist()
        fresh = {k: c.copy() for k, c in centres.items()}
        for k, rows in sums.groupby("k"):
            some = moving[k]
            costs[k][some] = np.bincount(rows["start"], weights=rows["cost"], minlength=len(some))
            # A centre that lost all its rows stays where it was.
            rows = rows[rows["n"] > 0]
            at = some[rows["start"].to_numpy()], rows["j"].to_numpy()
            fresh[k][at] = rows[list(names)].to_numpy() / rows["n"].to_numpy()[:, None]
        if step == iterations or all(np.allclose(fresh[k], centres[k]) for k in centres):
            break
        # A start whose centres stay where they are, up to rounding, is done: further passes would not change it.
        rest = {k: np.isclose(fresh[k][some], centres[k][some], rtol=1e-12, atol=0).all(axis=(1, 2)) for k, some in moving.items()}
        moving = {k: some[~rest[k]] for k, some in moving.items() if not rest[k].all()}
        centres = fresh
    return centres, costs


def oversampled(points: DataFrame, names: Sequence[str], each: int, seed: int = 1, rounds: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Candidate centres and how many rows are nearest to each, by parallel oversampling.

    Every round adds ``each`` distinct rows, drawn without replacement in proportion to their squared
    distance from the candidates so far: the rows with the least ``-log(u) / distance`` for a ``u`` that their values'
    hash gives. A round is one pass, and at most ``rounds * each + 1`` rows reach the driver.
    """
    spark = points.sparkSession
    first = points.orderBy(F.xxhash64(F.lit(seed), *names), *names).limit(1).collect()
    pool = np.array([list(r) for r in first], dtype=float).reshape(-1, len(names))
    fields = ", ".join(f"{n} double" for n in names)
    for turn in range(rounds if len(pool) else 0):
        shared = spark.sparkContext.broadcast(pool)
        hashed = points.select(*names, F.xxhash64(F.lit(seed), F.lit(turn), *names).alias("u"))
        drawn = hashed.mapInPandas(_race(shared, names, each), f"{fields}, key double").distinct().orderBy("key", *names).limit(each).collect()
        shared.unpersist()
        if not drawn:
            break
        pool = np.concatenate([pool, np.array([list(r)[:-1] for r in drawn], dtype=float)])
    shared = spark.sparkContext.broadcast({len(pool): pool[None]})
    sums = points.mapInPandas(_assign(shared, len(names)), _SUM_FIELDS + "".join(f", {n} double" for n in names)) if len(pool) else None
    weight = np.zeros(len(pool))
    for r in sums.groupBy("j").agg(F.sum("n").alias("n")).collect() if sums else []:
        weight[r["j"]] = r["n"]
    shared.unpersist()
    return pool, weight


def _race(shared, names: Sequence[str], each: int):
    """A task's ``each`` distinct rows with the least keys; rows that are candidates have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = pd.DataFrame()
        for batch in batches:
            x = batch[list(names)].to_numpy(dtype=float)
            far = np.full(len(x), np.inf)
            for c in shared.value:
                far = np.minimum(far, ((x - c) ** 2).sum(axis=1))
            u = ((batch["u"].to_numpy().astype(np.uint64) >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53
            batch = batch[list(names)].assign(key=-np.log(u) / np.where(far > 0, far, np.nan))[far > 0]
            if len(best) == each:
                # Most rows are out by their key alone.
                batch = batch[batch["key"] <= best["key"].max()]
            best = pd.concat([best, batch]).drop_duplicates().nsmallest(each, "key")
        if len(best):
            yield best

    return run


def _drawn(pool: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` different candidates, each drawn in proportion to weight and squared distance from those before."""
    picked = [int(rng.choice(len(pool), p=weight / weight.sum()))]
    far = ((pool - pool[picked[0]]) ** 2).sum(axis=1)
    while len(picked) < k:
        odds = far * np.maximum(weight, 1)
        picked.append(int(rng.choice(len(pool), p=odds / odds.sum())))
        far = np.minimum(far, ((pool - pool[picked[-1]]) ** 2).sum(axis=1))
    return pool[picked]


def _assign(shared, width: int, chunk: int = 128):
    """Per-task sums of the rows nearest to each centre of each model; a model's cost stands with its first centre.

    Distances are laid out as centre, start, row, in blocks that stay in a processor's cache: a row's nearest centre is a minimum
    of whole blocks, and its sums are one product.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres = shared.value
        flat = {k: c.transpose(1, 0, 2).reshape(-1, width) for k, c in centres.items()}
        flat = {k: np.concatenate([-2 * c, (c**2).sum(axis=1)[:, None]], axis=1) for k, c in flat.items()}
        total = {k: np.zeros((width + 1, len(c))) for k, c in flat.items()}
        cost = {k: np.zeros(len(c)) for k, c in centres.items()}
        # Memory that is taken anew for every block costs more time than the arithmetic.
        room = max(len(c) for c in flat.values()) * chunk
        distances, hits, weights = np.empty(room), np.empty(room, bool), np.empty(room)
        for batch in batches:
            rows = batch.to_numpy(dtype=float)
            for at in range(0, len(rows), chunk):
                x = rows[at : at + chunk]
                n, ones = len(x), np.ones((len(x), 1))
                square, by_column, sums = (x**2).sum(axis=1), np.concatenate([x, ones], axis=1).T.copy(), np.concatenate([ones, x], axis=1).T.copy()
                for k, c in flat.items():
                    size = len(c) * n
                    apart = np.matmul(c, by_column, out=distances[:size].reshape(-1, n)).reshape(k, -1)
                    least = apart.min(axis=0)
                    member = np.equal(apart, least, out=hits[:size].reshape(k, -1))
                    if np.count_nonzero(member) != len(least):
                        # Of centres equally near the first one counts.
                        member = np.arange(k)[:, None] == apart.argmin(axis=0)
                    cost[k] += np.maximum(least.reshape(-1, n) + square, 0).sum(axis=1)
                    weight = weights[:size].reshape(-1, n)
                    np.copyto(weight, member.reshape(-1, n))
                    total[k] += sums @ weight.T
        for k, found in total.items():
            centre, starts = np.arange(found.shape[1]), len(cost[k])
            out = pd.DataFrame({"k": k, "start": centre % starts, "j": centre // starts, "n": found[0].astype("int64")})
            out["cost"] = np.where(centre < starts, cost[k][centre % starts], 0.0)
            parts = pd.DataFrame(found[1:].T, columns=[f"s{i}" for i in range(width)])
            yield pd.concat([out, parts], axis=1)[(out["n"] > 0) | (out["j"] == 0)]

    return run


# --- agglomerative tree by clustering features ---------------------------------------------------

#: Columns of a clustering feature beside the means: rows it stands for, squared distances of these from the means.
_FEATURE = "n long, spread double"


def ward_merges(n: np.ndarray, means: np.ndarray, stop: int = 1) -> list[tuple[int, int, float]]:
    """Ward merges of weighted points, lowest first, until ``stop`` clusters are left: (left, right, height).

    Points count from 0, the cluster of merge i is ``len(n) + i``. A height is the distance at which R's "ward.D2" merges:
    its square, halved, is what the merge adds to the spread within. Chains of nearest neighbours find the merges.
    """
    size = len(n)
    weight, centre, alive = n.astype(float).copy(), means.astype(float).copy(), np.ones(size, bool)
    found: list[tuple[float, int, int]] = []
    chain: list[int] = []
    for _ in range(size - 1):
        while True:
            if not chain:
                chain.append(int(np.flatnonzero(alive)[0]))
            at = chain[-1]
            cost = 2 * weight[at] * weight / (weight[at] + weight) * ((centre - centre[at]) ** 2).sum(axis=1)
            cost[~alive] = np.inf
            cost[at] = np.inf
            near = int(cost.argmin())
            if len(chain) > 1 and cost[chain[-2]] <= cost[near]:
                near = chain[-2]
                break
            chain.append(near)
        del chain[-2:]
        found.append((float(np.sqrt(cost[near])), at, near))
        total = weight[at] + weight[near]
        centre[near] = (weight[at] * centre[at] + weight[near] * centre[near]) / total
        weight[near], alive[at] = total, False
    # The chain finds merges out of order; sorted by height they are those of the plain method.
    found.sort(key=lambda m: m[0])
    root = list(range(size))
    label = list(range(size))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    merges = []
    for i, (height, a, b) in enumerate(found[: max(size - stop, 0)]):
        a, b = top(a), top(b)
        left, right = sorted((label[a], label[b]))
        merges.append((left, right, height))
        root[a] = b
        label[b] = size + i
    return merges


def _cut(size: int, merges: list[tuple[int, int, float]]) -> np.ndarray:
    """The cluster of each point after ``merges``, numbered by the smallest point in it."""
    label = np.arange(size + len(merges))
    for i, (a, b, _) in reversed(list(enumerate(merges))):
        label[[a, b]] = label[size + i]
    return np.unique(label[:size], return_inverse=True)[1]


def _condensed(n: np.ndarray, spread: np.ndarray, means: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """At most ``leaves`` features for the given ones: what Ward merges first is added up."""
    if len(n) <= leaves:
        return n, spread, means
    at = _cut(len(n), ward_merges(n, means, leaves))
    rows = np.bincount(at, weights=n)
    centre = np.stack([np.bincount(at, weights=n * means[:, j]) / rows for j in range(means.shape[1])], axis=1)
    apart = n * ((means - centre[at]) ** 2).sum(axis=1)
    return rows.astype("int64"), np.bincount(at, weights=spread + apart), centre


def _condense(names: Sequence[str], leaves: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, spread, means = np.zeros(0, "int64"), np.zeros(0), np.zeros((0, len(names)))
        for batch in batches:
            for at in range(0, len(batch), leaves):
                some = batch.iloc[at : at + leaves]
                if not np.isfinite(some[list(names)].to_numpy(float)).all():
                    raise ValueError("a profile with a missing or infinite value has no distance")
                n = np.concatenate([n, some["n"].to_numpy("int64")])
                spread = np.concatenate([spread, some["spread"].to_numpy(float)])
                means = np.concatenate([means, some[list(names)].to_numpy(float)])
                n, spread, means = _condensed(n, spread, means, leaves)
        if len(n):
            yield pd.concat([pd.DataFrame({"n": n, "spread": spread}), pd.DataFrame(means, columns=list(names))], axis=1)

    return run


def ward_leaves(df: DataFrame, columns: Sequence[str], leaves: int = 500, fan: int = 8) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """At most ``leaves`` clustering features (rows, spread within, means) that stand for all rows.

    Equal rows are counted first. Each task condenses its rows to ``leaves`` features as it reads them; the features of
    ``fan`` tasks are condensed by one task of the next level, until one is left. A task holds twice that many at most.
    A missing or infinite value raises.
    """
    spark = df.sparkSession
    names = [f"s{i}" for i in range(len(columns))]
    points = df.select(*[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(columns, names)])
    points = points.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(0.0).alias("spread"), *names)
    fields = _FEATURE + "".join(f", {n} double" for n in names)
    features = write_stage(points.mapInPandas(_condense(names, leaves), fields), "features")
    held = features.count()
    while held > leaves:
        parts = max(1, held // (fan * leaves))
        features = write_stage(features.repartition(parts).mapInPandas(_condense(names, leaves), fields), "features")
        held = features.count()
    rows = features.orderBy(*names).toArrow().to_pandas()
    return rows["n"].to_numpy("int64"), rows["spread"].to_numpy(float), rows[names].to_numpy(float)


def ward_tree(df: DataFrame, columns: Sequence[str], leaves: int = 500) -> DataFrame:
    """The agglomerative tree (Ward): a row per merge with its height.

    Columns: step, left, right, height, n (rows in the merged cluster), spread (within all clusters after the merge). Leaves count from 0,
    the cluster of step i (from 1) is the number of leaves plus i - 1. With ``leaves`` or fewer distinct rows each is a
    leaf and the tree is the plain one; of more rows the lowest merges are made inside tasks and are not listed. Equal rows are one leaf.
    """
    n, spread, means = ward_leaves(df, columns, leaves)
    held, within, out = n.tolist(), float(spread.sum()), []
    for i, (a, b, height) in enumerate(ward_merges(n, means)):
        held.append(held[a] + held[b])
        within += height**2 / 2
        out.append((i + 1, a, b, height, held[-1], within))
    return df.sparkSession.createDataFrame(out, "step int, left int, right int, height double, n long, spread double")


def ward_clusters(df: DataFrame, columns: Sequence[str], k: int = 5, leaves: int = 500) -> DataFrame:
    """The frame with the ``cluster`` of each row when the tree is cut at ``k`` clusters: that of its nearest leaf."""
    n, _, means = ward_leaves(df, columns, leaves)
    label = _cut(len(n), ward_merges(n, means, k))
    shared = df.sparkSession.sparkContext.broadcast((means, label))

    @F.pandas_udf("int")
    def nearest(x: pd.Series) -> pd.Series:
        centres, labels = shared.value
        rows = np.stack(x.to_numpy()).astype(float)
        out = np.empty(len(rows), "int32")
        for at in range(0, len(rows), 256):
            out[at : at + 256] = labels[((rows[at : at + 256, None] - centres) ** 2).sum(axis=2).argmin(axis=1)]
        return pd.Series(out)

    return df.withColumn("cluster", nearest(F.array(*[F.col(f"`{c}`").cast("double") for c in columns])))
