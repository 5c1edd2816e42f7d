"""Line deduplication by the spread of a line over sites.

Spark expressions only. Each line hash gets a HyperLogLog sketch of the sites that carry it; partial
aggregation merges the sketches, so a line on a third of all pages is a few bytes per task. Where the
estimate is near the threshold the sites are counted exactly. Lines spread over enough sites are
boilerplate: one copy stays, where the line stands first, and the others are cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import id_or_last, keeps_others, stage, text_key

MIN_SITES = 10
#: Log2 of a sketch's buckets: a standard error of 1.04 / sqrt(4096), under 2 %.
LG_K = 12
#: Estimates from threshold / NEAR to threshold * NEAR are replaced by exact counts: over thirty standard errors.
NEAR = 2.0
#: The most rows that are broadcast (hashes, or positions of lines); more are joined by a shuffle.
BROADCAST_ROWS = 500_000


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def _small(df: DataFrame, weight: Column | None = None) -> DataFrame:
    """A staged frame, broadcast if it is known to be small."""
    total = df.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0] if weight is not None else df.count()
    return F.broadcast(df) if total <= BROADCAST_ROWS else df


def line_table(docs: DataFrame, doc: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """One row per line with something in it: ``_id``, ``_key``, ``pos`` from 0, ``h`` of the trimmed line, ``site``."""
    rows = docs.select(
        id_or_last(f"`{doc}`").alias("_id"),
        text_key(f"`{text}`").alias("_key"),
        F.coalesce(F.col(f"`{site}`").cast("string"), F.lit("")).alias("site"),
        F.posexplode(F.transform(_lines(F.col(f"`{text}`")), lambda x: F.btrim(x, F.lit(" \t\r\f\u000b")))).alias("pos", "line"),
    )
    return rows.where("line <> ''").select("_id", "_key", "pos", F.xxhash64("line").alias("h"), "site")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The hashes of lines on ``min_sites`` sites or more, with where each stands first: ``h``, ``first``."""
    spread = lines.groupBy("h").agg(
        F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"), F.min(F.struct("_id", "_key", "pos")).alias("first")
    )
    spread = spread.select("h", "first", F.hll_sketch_estimate("sketch").alias("sites"))
    spread = stage(spread.where(F.col("sites") >= min_sites / NEAR), "spread")
    near = spread.where(F.col("sites") < min_sites * NEAR)
    exact = lines.join(_small(near.select("h")), "h", "left_semi").groupBy("h", "site").agg(F.lit(1).alias("one"))
    exact = exact.groupBy("h").agg(F.count("one").alias("sites")).where(F.col("sites") >= min_sites).select("h")
    sure = spread.where(F.col("sites") >= min_sites * NEAR)
    return sure.select("h", "first").unionByName(near.join(exact, "h", "left_semi").select("h", "first"))


@keeps_others("doc", "text", "site")
def spread_dedup(
    docs: DataFrame, min_sites: int = MIN_SITES, doc: str = "doc_id", text: str = "text", site: str = "source"
) -> DataFrame:
    """The documents, all columns kept, with boilerplate lines cut from the text, and ``n_lines``, ``n_removed``.

    A line is what stands between line feeds; it is compared without the blanks around it, and a
    line of blanks alone is never cut. It is boilerplate if it stands in documents of ``min_sites``
    different sites or more; a missing site is a site of its own. Its first place (smallest id, then
    text, then position) is kept, so nothing is lost altogether. A null text stays null and has no
    lines. Rows that repeat an id and a text share what is cut. A result column that clashes with a
    given one takes its place.

    Texts are read twice: once for the lines' hashes, which are written as a table, and once to cut.
    """
    lines = stage(line_table(docs, doc, text, site), "lines")
    plate = stage(boilerplate(lines, min_sites), "boilerplate")
    cut = lines.join(_small(plate), "h").where(F.struct("_id", "_key", "pos") != F.col("first"))
    cut = stage(cut.groupBy("_id", "_key").agg(F.collect_set("pos").alias("_cut")), "cut")
    side = _small(cut, F.size("_cut") + 1)
    keyed = docs.withColumns({"_id": id_or_last(f"`{doc}`"), "_key": text_key(f"`{text}`")})
    joined = keyed.join(side, ["_id", "_key"], "left")
    n_lines = F.when(F.col(f"`{text}`").isNull(), 0).otherwise(F.size(_lines(F.col(f"`{text}`"))))
    kept = F.concat_ws("\n", F.filter(_lines(F.col(f"`{text}`")), lambda _, i: ~F.array_contains("_cut", i)))
    new = {
        text: F.when(F.col("_cut").isNull(), F.col(f"`{text}`")).otherwise(kept),
        "n_lines": n_lines.cast("long"),
        "n_removed": F.coalesce(F.size("_cut"), F.lit(0)).cast("long"),
    }
    new["n_removed"] = F.when(F.col("_cut").isNull(), F.lit(0)).otherwise(F.size("_cut")).cast("long")
    out = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return joined.select(
        *[new[c].alias(c) if c == text else F.col(f"`{c}`") for c in out], *[new[c].alias(c) for c in ("n_lines", "n_removed")]
    )
