"""Which parts of a table may hold given keys, without opening the parts.

Two kinds of small files stand beside a table in parts, written with each version of a part:

* a zone: the part's rows and the least and greatest value of the key's first column;
* a filter: a Bloom filter of the part's keys as rows (word, bits). A key has two words of a part's filter and
  four bits in each, so a probe is a join on the word, and the filter grows with the part at
  ``BITS_PER_KEY`` bits a row, however large the part.

A filter never misses a key. It admits some 5 in 100,000 keys that are not there, so the parts of the keys
it admits are still to be looked into; all others are left alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS_PER_KEY = 24
LEAST_WORDS = 16


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _probes(key: Sequence[str]) -> Column:
    """The key's two (place, mask): the place names a word in filters of any size, the mask has up to four bits."""

    def probe(seed: int) -> Column:
        h = F.xxhash64(F.lit(seed), *[F.col(k) for k in key])
        one = F.lit(1).cast("long")
        bits = [F.call_function("shiftleft", one, F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(4)]
        mask = bits[0]
        for b in bits[1:]:
            mask = mask.bitwiseOR(b)
        return F.struct(F.shiftrightunsigned(h, 24).alias("place"), mask.alias("mask"))

    return F.array(probe(1), probe(2))


def _words(rows: Column) -> Column:
    """The words of a filter for so many rows: a power of two, so that a place is cut down to it by its low bits."""
    wanted = F.greatest(rows * BITS_PER_KEY / 64, F.lit(LEAST_WORDS))
    return F.pow(F.lit(2.0), F.ceil(F.log2(wanted))).cast("long")


def _keys(df: DataFrame, key: Sequence[str], *more: str) -> tuple[DataFrame, list[str]]:
    """The key's columns under names of their own, without rows that lack one."""
    names = [f"__k{i}" for i in range(len(key))]
    return df.select(*more, *[F.col(f"`{k}`").alias(n) for k, n in zip(key, names)]).dropna(subset=names), names


def write_key_filters(rows: DataFrame, root: str, version: int, key: Sequence[str]) -> None:
    """Zones and filters of the parts written as ``version``; ``rows`` are their rows, with the column ``part``.

    Rows without a key are not in a filter: no incoming key can equal theirs.
    """
    keyed, key = _keys(rows, key, "part")
    zones = keyed.groupBy("part").agg(F.count("*").alias("n"), F.min(key[0]).alias("low"), F.max(key[0]).alias("high"))
    zones = zones.withColumns({"words": _words(F.col("n")), "version": F.lit(version).cast("int")})
    zones.coalesce(1).write.mode("errorifexists").parquet(f"{root}/zones/version={version}")
    sizes = rows.sparkSession.read.parquet(f"{root}/zones/version={version}").select("part", "words")
    bits = keyed.join(F.broadcast(sizes), "part").select("part", "words", F.explode(_probes(key)).alias("p"))
    bits = bits.groupBy("part", F.col("p.place").bitwiseAND(F.col("words") - 1).alias("word")).agg(F.bit_or("p.mask").alias("bits"))
    bits.hint("rebalance", F.col("part")).write.mode("errorifexists").partitionBy("part").parquet(f"{root}/filters/version={version}")


def parts_to_open(keys: DataFrame, root: str, parts: Mapping[int, int], key: Sequence[str]) -> set[int]:
    """The parts (number: version) that may hold one of ``keys``; of all others it is certain that they do not.

    Zones are read first, then the filters of the parts whose zone meets the keys. A part that was written without them
    is always to be opened. What comes to the driver are a row per part and the bounds of the keys.
    """
    spark = keys.sparkSession
    written = lambda v: all(_exists(spark, f"{root}/{kind}/version={v}/_SUCCESS") for kind in ("zones", "filters"))
    versions = sorted(v for v in set(parts.values()) if written(v))
    unknown = {p for p, v in parts.items() if v not in versions}
    if not versions:
        return unknown
    keys, key = _keys(keys, key)
    keys = keys.distinct()
    bounds = keys.agg(F.min(key[0]).alias("low"), F.max(key[0]).alias("high")).first()
    if bounds["low"] is None:
        return unknown
    zones = spark.read.parquet(*[f"{root}/zones/version={v}" for v in versions]).collect()
    near = [z for z in zones if parts.get(z["part"]) == z["version"] and z["low"] <= bounds["high"] and z["high"] >= bounds["low"]]
    if not near:
        return unknown
    kind = dict(keys.dtypes)[key[0]]
    known = spark.createDataFrame([(z["part"], z["words"], z["low"], z["high"]) for z in near], f"part int, words long, low {kind}, high {kind}")
    paths = [f"{root}/filters/version={z['version']}/part={z['part']}" for z in near]
    filters = spark.read.option("basePath", f"{root}/filters").parquet(*paths).select(F.col("part").cast("int").alias("part"), "word", "bits")
    filters = filters.join(F.broadcast(known), "part")
    sizes = F.array(*[F.lit(w).cast("long") for w in sorted({z["words"] for z in near})])
    probes = keys.select(*key, F.explode(_probes(key)).alias("p")).withColumn("words", F.explode(sizes))
    probes = probes.select(*key, "words", F.col("p.place").bitwiseAND(F.col("words") - 1).alias("word"), F.col("p.mask").alias("mask"))
    met = probes.join(filters, ["words", "word"]).where(
        (F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")) & F.col(key[0]).between(F.col("low"), F.col("high"))
    )
    admitted = met.groupBy("part", *key).agg(F.count("*").alias("n")).where("n = 2").select("part").distinct()
    return unknown | {r["part"] for r in admitted.collect()}
