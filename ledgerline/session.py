"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # PostgreSQL's json type accepts repeated keys; Spark's variant needs this to do so.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerline")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is absent, a local master (tests on one machine) gets a temporary
    folder, remembered on the session; any other raises, as its executors could not
    read what the driver or another executor wrote there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("ledgerline.scratch.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="ledgerline-")
        spark.conf.set("ledgerline.scratch.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the scratch folder that no earlier call has used."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


#: With this setting a query that ends gives back the disk of its shuffles; without it they stay until the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing: Counter[str] = Counter()
_before: dict[str, str | None] = {}
_lock = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that end in this block drop their shuffles. Blocks may overlap in several threads; the last one puts the setting back."""
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        if not _writing[session]:
            _before[session] = spark.conf.get(SHUFFLE_CLEANUP, None)
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        _writing[session] += 1
    try:
        yield
    finally:
        with _lock:
            _writing[session] -= 1
            if not _writing[session]:
                before = _before.pop(session)
                spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage durably (a lost executor rereads files instead of redoing the
    job) and gives the next join exact file sizes to choose its strategy from. The
    shuffles behind it are needed no more and leave the disk.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
