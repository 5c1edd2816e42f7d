"""Exact k-means over integer vectors, with distances by subvector dictionaries.

Vectors are kept in chunks. Each chunk cuts the dimensions into blocks and replaces a vector's components in a block by
the number of that subvector among the block's distinct ones: a lossless dictionary encoding. In a round, the squared
distances of a block's distinct subvectors to all centroids are computed once, and a vector's distance is the sum of
its blocks' entries, looked up by its codes. The sums of the new centroids go the same way back: how often
each cluster has each code, times the subvectors. All of it is integer arithmetic.

Blocks begin as single dimensions and neighbours are merged while the merged dictionary stays under a quarter of
the chunk's vectors; so a chunk of copies ends with one block and few entries. Chunks are written once and
read in every round; a task holds one chunk, whatever the number of copies of a vector.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
#: Vectors of a chunk: a few megabytes of codes and dictionaries.
CHUNK = 16_384
#: The largest component (as an integer) for which the squared distances of DIMENSIONS components fit a long.
LARGEST = 1 << 27
CODES = ["widths", "entries", "words", "codes"]


def usable(vector: Column, dimensions: int = DIMENSIONS) -> Column:
    """True for vectors with exactly ``dimensions`` components, none null or non-finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce((F.size(vector) == dimensions) & F.forall(vector.cast("array<double>"), finite), F.lit(False))


def start_vectors(vectors: DataFrame, clusters: int = CLUSTERS, seed: str = "3:") -> list[list[int]]:
    """The vectors with the smallest hashes of their ids, in ascending order; among repeated ids the smaller vector first."""
    hashed = vectors.select(F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")).cast("binary"), 256).alias("h"), "x")
    return [list(r["x"]) for r in hashed.orderBy(F.asc_nulls_last("h"), "x").limit(clusters).collect()]


def _encode(x: np.ndarray) -> tuple[list[int], list[np.ndarray], np.ndarray]:
    """(dimensions of each block, its distinct subvectors, codes of shape (blocks, vectors)) of a chunk."""
    blocks = []
    for d in range(x.shape[1]):
        values, codes = np.unique(x[:, d], return_inverse=True)
        blocks.append((values[:, None], codes))
    most, merged = len(x) // 4, True
    while merged and len(blocks) > 1:
        merged, out, k = False, [], 0
        while k < len(blocks):
            if k + 1 < len(blocks):
                (va, ca), (vb, cb) = blocks[k], blocks[k + 1]
                pairs, codes = np.unique(ca * len(vb) + cb, return_inverse=True)
                if len(pairs) <= max(most, 1):
                    out.append((np.hstack([va[pairs // len(vb)], vb[pairs % len(vb)]]), codes))
                    merged, k = True, k + 2
                    continue
            out.append(blocks[k])
            k += 1
        blocks = out
    return [v.shape[1] for v, _ in blocks], [v for v, _ in blocks], np.stack([c for _, c in blocks]).astype("<u2")


def chunks(vectors: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Dictionary-encoded chunks of the vectors (``id``, ``x``): ids, widths, entries, words, codes.

    ``widths`` are the blocks' dimensions, ``entries`` their numbers of distinct subvectors, ``words`` these subvectors'
    components (64-bit), ``codes`` the vectors' codes block by block (16-bit).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, chunk):
                part = b.slice(at, chunk)
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                widths, words, codes = _encode(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("id")), pa.array([widths], pa.list_(pa.int32())), pa.array([[len(w) for w in words]], pa.list_(pa.int32())),
                     pa.array([b"".join(w.astype("<i8").tobytes() for w in words)], pa.binary()), pa.array([codes.tobytes()], pa.binary())],
                    names=["ids", "widths", "entries", "words", "codes"],
                )

    return vectors.select("id", "x").mapInArrow(run, "ids array<long>, widths array<int>, entries array<int>, words binary, codes binary")


def _decode(row: dict) -> tuple[list[np.ndarray], np.ndarray]:
    words, values, at = [], np.frombuffer(row["words"], "<i8"), 0
    for width, n in zip(row["widths"], row["entries"]):
        words.append(values[at : at + width * n].reshape(n, width))
        at += width * n
    return words, np.frombuffer(row["codes"], "<u2").reshape(len(words), -1)


def _nearest(words: list[np.ndarray], codes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of each vector; of equally near ones the smaller number."""
    total = np.zeros((codes.shape[1], len(centroids)), np.int64)
    at = 0
    for subvectors, code in zip(words, codes):
        some = centroids[:, at : at + subvectors.shape[1]]
        table = np.zeros((len(subvectors), len(centroids)), np.int64)  # of each distinct subvector to each centroid, once
        for d in range(subvectors.shape[1]):
            table += (subvectors[:, d, None] - some[None, :, d]) ** 2
        total += table[code]
        at += subvectors.shape[1]
    found = total.argmin(axis=1)
    return found, total[np.arange(len(found)), found]


def _round(encoded: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Of each cluster that has vectors: how many, and their exact componentwise sums."""
    k, dimensions = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                words, codes = _decode(row)
                cluster, _ = _nearest(words, codes, centroids)
                sums = np.zeros((k, dimensions), np.int64)
                at = 0
                for subvectors, code in zip(words, codes):
                    many = np.bincount(cluster * len(subvectors) + code, minlength=k * len(subvectors)).reshape(k, -1)
                    sums[:, at : at + subvectors.shape[1]] = many @ subvectors
                    at += subvectors.shape[1]
                n = np.bincount(cluster, minlength=k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.arange(k), dimensions)), pa.array(np.tile(np.arange(dimensions), k)), pa.array(np.repeat(n, dimensions)), pa.array(sums.ravel())],
                    names=["cluster", "d", "n", "s"],
                )

    parts = encoded.select(*CODES).mapInArrow(run, "cluster long, d long, n long, s long")
    exact = parts.groupBy("cluster", "d").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(exact.collect()):  # a row per cluster and dimension
        if r["n"]:
            out.setdefault(r["cluster"], (r["n"], []))[1].append(int(r["s"]))
    return out


def _assign(encoded: DataFrame, centroids: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("ids")
            for k, row in enumerate(b.select(CODES).to_pylist()):
                cluster, distance = _nearest(*_decode(row), centroids)
                yield pa.RecordBatch.from_arrays([ids[k].values, pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

    return encoded.mapInArrow(run, "id long, cluster int, distance long")


def cluster(
    embeddings: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: str = "3:",
    chunk: int = CHUNK,
    vec: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """Every usable vector with its cluster after ``rounds`` rounds of exact k-means.

    Columns: vec_id, cluster, distance (squared, to its centroid), cluster_inertia, inertia (distances summed over
    the cluster and over all), centroid (array<long>).

    A component x becomes floor(scale * x). Centroids start as the vectors with the smallest sha256 of ``seed`` and id; a
    null id counts as the largest hash. Each round replaces a centroid by the exact floor of its vectors' mean; one
    without vectors stays. With fewer vectors than clusters there are as many clusters as vectors; an empty table
    gives no rows. Null, short, long and non-finite vectors are left out. Repeated rows count as often as they are there.
    Components beyond ``LARGEST`` raise an error, as their distances are no longs. Other columns are not read.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col(f"`{vec}`").cast("long").alias("id"), F.col(f"`{embedding}`").alias("e")).where(usable(F.col("e"), dimensions))
    whole = lambda x: F.floor(x.cast("double") * F.lit(float(scale)))
    whole_or_error = lambda x: F.when(F.abs(x.cast("double")) * F.lit(float(scale)) <= LARGEST, whole(x)).otherwise(
        F.raise_error(F.lit(f"a component is beyond {LARGEST} / {scale}")).cast("long")
    )
    vectors = rows.select("id", F.transform("e", whole_or_error).alias("x"))
    encoded = stage(chunks(vectors, min(chunk, 1 << 16)), "coded_vectors")
    centroids = np.array(start_vectors(vectors, clusters, seed), np.int64).reshape(-1, dimensions)
    if not len(centroids):
        kinds = "id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
        return spark.createDataFrame([], kinds).withColumnRenamed("id", vec)
    for _ in range(rounds):
        for k, (n, sums) in _round(encoded, centroids).items():
            centroids[k] = [s // n for s in sums]
    found = stage(_assign(encoded, centroids), "assigned_vectors")
    inertia = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    totals = {r["cluster"]: r["cluster_inertia"] for r in inertia.collect()}  # a row per cluster
    facts = [(k, totals[k], sum(totals.values()), centroids[k].tolist()) for k in sorted(totals)]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    out = found.join(F.broadcast(facts), "cluster")
    return out.select(F.col("id").alias(vec), "cluster", "distance", "cluster_inertia", "inertia", "centroid")

