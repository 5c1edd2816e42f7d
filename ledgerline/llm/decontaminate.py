"""Benchmark decontamination: a broadcast hash set of test n-grams against every window of the training texts.

Spark expressions only. The windows of a text are never written out: the positions are generated,
the hash of the words at a position is probed against the broadcast set in the same generated code,
and only a hit (verified on the words themselves) leaves the stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import id_or_last, keeps_others, stage, text_key

WINDOW = 13
#: The most n-grams of the benchmark that are broadcast (some 200 bytes each); more are joined by a shuffle.
BROADCAST_GRAMS = 500_000
#: The most document keys that are broadcast to filter the documents; more are joined by a shuffle.
BROADCAST_KEYS = 500_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same before A-Z are lower-cased.
_CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_CASED_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """A-Z lower-cased, then runs of ASCII letters, digits and anything beyond ASCII; a null text has none."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lower, _BETWEEN), "")


def _run(array: str, at: Column, size: int | Column) -> Column:
    return F.slice(array, at + 1, size)


def grams(benchmark: DataFrame, window: int = WINDOW, item: str = "item_id", text: str = "text") -> DataFrame:
    """The distinct windows of all items: ``size``, ``h``, ``gram``, ``items`` (sorted strings).

    An item of fewer words than the window is one window; an item without words has none.
    """
    rows = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), words(F.col(f"`{text}`")).alias("w"))
    rows = rows.where(F.size("w") > 0).withColumn("size", F.least(F.size("w"), F.lit(window)))
    rows = rows.select("item", "w", "size", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("size"))).alias("at"))
    found = rows.select("item", "size", F.concat_ws(" ", _run("w", F.col("at"), F.col("size"))).alias("gram"))
    found = found.groupBy("size", "gram").agg(F.sort_array(F.collect_set("item")).alias("items"))
    # Words hold no blanks, so a window's text cut at blanks gives its words again.
    return found.select("size", F.xxhash64(F.split("gram", " ")).alias("h"), "gram", "items")


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: how much of it occurs in the benchmark.

    Columns: ``_id`` (the document's id, a missing one as the largest), ``_key`` (hash of the text),
    the id column, ``n_words``, ``n_hit`` (words inside any occurrence of a window), ``items`` (sorted
    strings), ``spans`` (sorted array<struct<start, size>> in words), ``contaminated`` (n_hit > 0
    and 20 * n_hit >= n_words).

    Null and empty texts have no words and are clean. Repeated rows give a row each. An empty
    benchmark leaves all clean. Other columns are not read. The benchmark's windows are counted
    before they are broadcast; beyond ``BROADCAST_GRAMS`` both sides meet in a shuffle on the hash, to which a document sends
    its windows.
    """
    known = stage(grams(benchmark, window), "grams")
    counted = known.groupBy("size").count().collect()  # at most ``window`` rows
    few = sum(r["count"] for r in counted) <= BROADCAST_GRAMS
    sizes = sorted((r["size"] for r in counted), reverse=True) or [window]
    base = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(f"`{doc}`").alias("_doc"),
        text_key(f"`{text}`").alias("_key"),
        words(F.col(f"`{text}`")).alias("w"),
    ).withColumn("n", F.size("w"))
    found = None
    for size in sizes:  # one size unless some items are shorter than the window
        side = known.where(F.col("size") == size).select("h", "gram", "items")
        side = F.broadcast(side) if few else side
        at = base.select("*", F.explode(F.sequence(F.lit(0), F.greatest(F.col("n") - size, F.lit(0)))).alias("at"))
        at = at.withColumn("h0", F.when(F.col("n") >= size, F.xxhash64(_run("w", F.col("at"), size))))
        said = F.concat_ws(" ", _run("w", F.col("at"), size))
        if not few:  # what is shuffled is the window itself, never the text around it
            at = at.select("_row", "_doc", "_key", "n", "at", "h0", F.when(F.col("h0").isNotNull(), said).alias("said"))
            said = F.col("said")
        same = (F.col("h0") == F.col("h")) & (said == F.col("gram"))
        got = at.join(side, same, "left").where((F.col("at") == 0) | F.col("items").isNotNull())
        got = got.select(
            "_row", "_doc", "_key", "n",
            F.when(F.col("items").isNotNull(), F.struct(F.col("at").alias("start"), F.lit(size).alias("size"))).alias("span"),
            "items",
        )
        found = got if found is None else found.unionByName(got)
    rows = found.groupBy("_row", "_doc", "_key", "n").agg(
        F.sort_array(F.collect_set("span")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["start"] + s["size"] - F.greatest(s["start"], a["end"]), F.lit(0))).alias("n"),
            F.greatest(a["end"], s["start"] + s["size"]).alias("end"),
        ),
        lambda a: a["n"].cast("long"),
    )
    rows = rows.withColumn("n_hit", covered).withColumn("n_words", F.col("n").cast("long"))
    return rows.select(
        F.coalesce(F.col("_doc").cast("long"), id_or_last("_doc")).alias("_id"), "_key", F.col("_doc").alias(doc),
        "n_words", "n_hit", "items", "spans",
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


@keeps_others("doc", "text")
def decontaminate(
    docs: DataFrame, benchmark: DataFrame, action: str = "documents", window: int = WINDOW, doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents, all columns kept, without the contaminated ones or without their hit words.

    ``action="documents"`` drops contaminated documents and leaves the others as they are.
    ``action="spans"`` keeps every document and cuts the words of every hit out of its text, with
    what stands between them. A document is known by its id and its text, so that repeated rows
    share one verdict.
    """
    if action not in ("documents", "spans"):
        raise ValueError("action is documents or spans")
    found = hits(docs, benchmark, window, doc, text)
    found = found.where(F.col("contaminated") if action == "documents" else F.col("n_hit") > 0)
    marks = stage(found.select("_id", "_key", "spans").dropDuplicates(["_id", "_key"]), "hits")
    side = F.broadcast(marks) if marks.count() <= BROADCAST_KEYS else marks
    keyed = docs.withColumns({"_id": id_or_last(f"`{doc}`"), "_key": text_key(f"`{text}`")})
    if action == "documents":
        return keyed.join(side.select("_id", "_key"), ["_id", "_key"], "left_anti").select(*[f"`{c}`" for c in docs.columns])
    pieces = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"({_CASED_WORD}|{_CASED_BETWEEN})"), 1)
    joined = keyed.join(side, ["_id", "_key"], "left").withColumn("_p", pieces)
    # Words and what is between them take turns; the first piece is a word or not.
    lead = F.when(F.regexp_like(F.get("_p", F.lit(0)), F.lit(f"^{_CASED_BETWEEN}")), 1).otherwise(0)
    joined = joined.withColumn("_lead", lead)

    def hit(word: Column) -> Column:
        return F.exists("spans", lambda s: (word >= s["start"]) & (word < s["start"] + s["size"]))

    def gone(i: Column) -> Column:
        """A hit word, or what stands between two of them; the piece at ``i`` is word number half of its place, or behind that word."""
        place = i - F.col("_lead")
        word = F.floor(place / 2).cast("int")
        return (place >= 0) & hit(word) & ((place % 2 == 0) | hit(word + 1))

    cut = F.concat_ws("", F.filter("_p", lambda _, i: ~gone(i)))
    named = F.when(F.col("spans").isNull(), F.col(f"`{text}`")).otherwise(cut).alias(text)
    return joined.select(*[named if c == text else F.col(f"`{c}`") for c in docs.columns])
