"""Changing a table without mutating it: build the new state, write it aside, switch."""

from __future__ import annotations

from collections.abc import Callable, Container, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import write_stage
from ledgerline.sources.keyfilters import parts_to_open, write_key_filters


def append_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    return target.unionByName(rows.select(*target.columns))


def insert_absent(target: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Add the rows whose key the target lacks; a key repeated in ``rows`` goes in once."""
    fresh = rows.select(*target.columns).dropDuplicates(list(key)).join(target.select(*key), list(key), "left_anti")
    return target.unionByName(fresh)


def upsert(target: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Drop the target's rows whose key comes in, then add all incoming rows."""
    kept = target.join(rows.select(*key), list(key), "left_anti")
    return kept.unionByName(rows.select(*target.columns))


def delete_from(target: DataFrame, firsts: DataFrame, key: str, start: str = "start_date") -> DataFrame:
    """Drop rows that start at or after their key's first change in ``firsts`` (key, orig_start_dt).

    The changes are reduced to one row per key first, so the join cannot multiply rows.
    """
    first = firsts.groupBy(F.col(key).alias("__k")).agg(F.min("orig_start_dt").alias("__first"))
    hit = (F.col(key) == F.col("__k")) & (F.col("__first") <= F.col(start))
    return target.join(first, hit, "left_anti")


def close_open_rows(target: DataFrame, firsts: DataFrame, key: str) -> DataFrame:
    """End each changed key's last row the day before its first change and mark it not current."""
    first = firsts.groupBy(F.col(key).alias("__k")).agg(F.min("orig_start_dt").alias("__first"))
    last = target.groupBy(F.col(key).alias("__l")).agg(F.max("start_date").alias("__last"))
    closing = first.join(last, F.col("__k") == F.col("__l"))
    hit = (F.col(key) == F.col("__k")) & (F.col("start_date") == F.col("__last"))
    closes = F.col("__first").isNotNull()
    return (
        target.join(closing, hit, "left")
        .withColumns(
            {
                "end_date": F.when(closes, F.date_sub("__first", 1)).otherwise(F.col("end_date")),
                "current_record": F.when(closes, F.lit("N")).otherwise(F.col("current_record")),
            }
        )
        .drop("__k", "__l", "__first", "__last")
    )


# --- versions of a table on shared storage ----------------------------------------------


def _versions(spark: SparkSession, root: str, complete: bool = True) -> list[int]:
    """Numbers of the versions below ``root``: the completely written ones, or all that were begun."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        marker = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith("version=") and (not complete or fs.exists(marker)):
            done.append(int(name.split("=")[1]))
    return sorted(done)


def publish(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> int:
    """Write ``df`` as the next version below ``root``; readers switch when it is complete.

    The plan of ``df`` may read the current version: nothing is ever overwritten. Of two
    writers that chose the same number, the later one fails.
    """
    version = max(_versions(df.sparkSession, root, complete=False), default=0) + 1
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(f"{root}/version={version}")
    return version


def read_current(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The newest complete version, or None where there is none yet."""
    versions = _versions(spark, root)
    if not versions:
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{root}/version={versions[-1]}")


# --- a table in parts, each with a version of its own ----------------------------------------


def month_part(day: str):
    """A part number from a date: year and month as yyyymm, 0 without a date."""
    return F.coalesce(F.year(day) * 100 + F.month(day), F.lit(0))


def read_parts(spark: SparkSession, root: str, parts: Mapping[int, int], schema: T.StructType) -> DataFrame:
    """The rows of the given parts (number: version) of a table; pass only some parts to read only their files."""
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/version={v}/part={p}" for p, v in sorted(parts.items())])


def upsert_parts(
    rows: DataFrame,
    root: str,
    parts: Mapping[int, int],
    key: Sequence[str],
    part: Column,
    also: Container[int] = (),
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[int, int]:
    """Drop the table's rows whose key comes in, add all incoming rows, and rewrite only the parts that this touches.

    ``part`` is the part number of a row, ``parts`` the table's present parts. A part is touched if
    rows come into it or if it holds an incoming key (a key may have moved). Parts that cannot hold one by their
    key filters are not opened; of the others the key column alone is read. Parts named by ``also`` are rewritten as well.
    ``finish`` is applied to all rows of the touched parts before they are written; it keeps their columns.
    Returns the parts after the change, the untouched ones with the version
    they had: their files stay as they are. ``rows`` is read several times: give a written one.
    """
    spark = rows.sparkSession
    marked = rows.withColumn("part", part)
    into = {r[0] for r in marked.select("part").distinct().collect()}  # a number per month
    rest = {p: v for p, v in parts.items() if p not in into}
    opened = parts_to_open(rows, root, rest, key)
    whole = read_parts(spark, root, {p: v for p, v in rest.items() if p in opened}, rows.schema)
    found = whole.select(*key, part.alias("part")).join(rows.select(*key), list(key), "left_semi").select("part").distinct()
    moved = {r[0] for r in found.collect()} if opened else set()
    touched = into | moved | {p for p in parts if p in also}
    if not touched:
        return dict(parts)
    new, held = marked, {p: v for p, v in parts.items() if p in touched}
    if held:
        kept = read_parts(spark, root, held, rows.schema).join(rows.select(*key), list(key), "left_anti")
        new = kept.withColumn("part", part).unionByName(marked)
    return {p: v for p, v in parts.items() if p not in touched} | write_parts(finish(new) if finish else new, root, key)


def write_parts(rows: DataFrame, root: str, key: Sequence[str]) -> dict[int, int]:
    """Write the parts named by the column ``part`` as a new version, with their key filters.

    ``rows`` are computed once: parts and filters are made from the files written, where a part's rows lie together.
    """
    # One file set per part: a part is shuffled to as many tasks as its rows need, not to every task.
    version = publish(rows.hint("rebalance", F.col("part")), root, ["part"])
    fresh = rows.sparkSession.read.schema(rows.schema).parquet(f"{root}/version={version}")
    written = [r[0] for r in fresh.select("part").distinct().collect()]
    write_key_filters(fresh, root, version, key)
    return dict.fromkeys(written, version)


# --- a table in buckets of its key ------------------------------------------------------------


def bucket_part(key: str, buckets: int) -> Column:
    """The bucket of a key, whatever its type."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def rewrite_buckets(
    keys: DataFrame, root: str, parts: Mapping[int, int], buckets: int, key: str, change: Callable[[DataFrame | None], DataFrame]
) -> tuple[dict[int, int], DataFrame | None, DataFrame | None]:
    """Rewrite the buckets of ``keys`` as ``change`` makes them from their present rows; all other buckets keep their files.

    ``change`` gets the rows of these buckets (None if there are none) and returns them anew.
    Returns the parts after the change, and the buckets' rows before and after it.
    """
    spark = keys.sparkSession
    touched = [r[0] for r in keys.select(bucket_part(key, buckets).alias("part")).distinct().collect()]  # as many as buckets
    if not touched:
        return dict(parts), None, None
    held = {p: parts[p] for p in touched if p in parts}
    old = read_parts(spark, root, held, part_schema(spark, root, held)) if held else None
    new = write_stage(change(old).withColumn("part", bucket_part(key, buckets)), "buckets")
    version = publish(new.hint("rebalance", F.col("part")), root, ["part"])
    written = [r[0] for r in new.select("part").distinct().collect()]
    return {p: v for p, v in parts.items() if p not in touched} | dict.fromkeys(written, version), old, new.drop("part")


def part_schema(spark: SparkSession, root: str, parts: Mapping[int, int]) -> T.StructType:
    """The columns of a table in parts, as its newest part has them."""
    p, v = max(parts.items(), key=lambda x: x[1])
    return spark.read.parquet(f"{root}/version={v}/part={p}").schema


# --- several tables that switch together ----------------------------------------------------


MANIFEST = "table string, part int, version int, batch string, buckets int"


@dataclass
class Manifest:
    """What is current: a version per table, a version per part of tables in parts (with the number of buckets of those
    in buckets), and the batches applied so far."""

    versions: dict[str, int] = field(default_factory=dict)
    parts: dict[str, dict[int, int]] = field(default_factory=dict)
    batches: list[str] = field(default_factory=list)
    buckets: dict[str, int] = field(default_factory=dict)


def read_manifest(spark: SparkSession, root: str) -> Manifest:
    """The newest manifest below ``root``; an empty one at the start."""
    rows = read_current(spark, f"{root}/manifest", T._parse_datatype_string(MANIFEST))
    out = Manifest()
    for r in [] if rows is None else rows.collect():  # a row per table, part and batch
        if r["batch"] is not None:
            out.batches.append(r["batch"])
        elif r["buckets"] is not None:
            out.buckets[r["table"]] = r["buckets"]
        elif r["part"] is None:
            out.versions[r["table"]] = r["version"]
        else:
            out.parts.setdefault(r["table"], {})[r["part"]] = r["version"]
    out.batches.sort()
    return out


def write_manifest(spark: SparkSession, root: str, manifest: Manifest) -> int:
    """Switch all tables below ``root`` at once: readers take the versions that the newest manifest names."""
    rows = [(t, None, v, None, None) for t, v in manifest.versions.items()]
    rows += [(t, p, v, None, None) for t, parts in manifest.parts.items() for p, v in parts.items()]
    rows += [(None, None, None, b, None) for b in manifest.batches]
    rows += [(t, None, None, None, n) for t, n in manifest.buckets.items()]
    return publish(spark.createDataFrame(rows, MANIFEST).coalesce(1), f"{root}/manifest")
