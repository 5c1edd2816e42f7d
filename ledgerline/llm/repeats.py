"""Substring deduplication over words by naming the windows of partitioned suffixes.

A window is 50 words. The suffixes that begin at the windows of all texts are split into groups by a
minimizer in place of a prefix, each group fits into a task's memory, and its equal windows are found
there by names in place of a suffix tree.

*Groups.* Of all runs of eight words inside a suffix's first 50, the one with the least hash names the
group: equal windows have the same one, and neighbouring suffixes mostly share it, so a group has
stretches of text (some 70 words for 22 suffixes) and not a copy of 50 words for each suffix. A group that only one
document reaches has no repeats and is dropped before any text moves.

*Equal stretches* are settled by their hashes: all but those of the smallest id are repeats from end to
end. Words move only for the first one of each, and only where a group has several different ones. A group of
too many stretches whose words would move is split further by all 50 words: such a suffix travels as the hash
of those, and a combining minimum settles it, however many documents share it. Either kind comes out of one pass
over the texts.

*Names.* Suffixes are named level by level, at depths 1, 2, 4, 8, 16, 32 and 50 words: equal names at 50 words
are the suffixes that would be below one internal node of that depth in a tree. Neighbouring
suffixes with shared names chain up to the repeats.

Documents with the same words throughout are settled first: all but the one with the smallest id
are repeats as a whole and take no part.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import Words, id_or_last, keeps_others, mix, range_hashes, ranges, signed, slices, stage, text_key

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 50
PREFIX = 8
#: Stretches of a group, those that move, beyond which its suffixes are told apart by their whole first window (500 bytes each in memory).
LARGE_GROUP = 50_000
#: A key of more rows than this, and of more than one in MOST_HEAVY of all, is joined by a broadcast; so there are at most MOST_HEAVY.
HEAVY = 5_000
MOST_HEAVY = 100_000
#: Bytes of stretches whose subtrees are built together.
TREE_BYTES = 24 << 20
#: Bytes kept of a word's hash: two different words pass for one with probability 2 ** -48.
WORD_BYTES = 6


def _runs(w: Words, window: int, prefix: int) -> tuple[np.ndarray, ...]:
    """The stretches of a batch: (row, first window's word, last window's word, group), words counted in the batch."""
    at, row = w.windows(window)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    n = len(w.hashes)
    value = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    value[: n - prefix + 1] = range_hashes(w.hashes, np.arange(n - prefix + 1), np.arange(prefix, n + 1))
    # The least of window - prefix + 1 neighbours, the leftmost on a tie, by doubling.
    span, size = window - prefix + 1, 1
    least, place = value.copy(), np.arange(n)

    def join(step: int) -> None:
        nonlocal least, place
        other, where = least[step:], place[step:]
        better = other < least[: n - step]
        least = np.concatenate([np.where(better, other, least[: n - step]), least[n - step :]])
        place = np.concatenate([np.where(better, where, place[: n - step]), place[n - step :]])

    while 2 * size <= span:
        join(size)
        size *= 2
    if size < span:
        join(span - size)
    anchor = place[at]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(at)) - 1
    return row[first], at[first], at[last], value[anchor[first]]


def _profile(docs: DataFrame, text: str, window: int, prefix: int) -> DataFrame:
    """Per document with a window or more: ``_id``, ``_key``, a fingerprint of its words, and its stretches' groups, hashes and bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_said"):
            w = Words(b.column("_said"))
            row, low, high, group = _runs(w, window, prefix)
            long = np.flatnonzero(w.counts >= window)
            start, end = w.first[:-1][long], w.first[1:][long]
            other = mix(w.hashes ^ np.uint64(0x5DEECE66D))
            marks = [range_hashes(x, start, end) for x in (w.hashes, other)]
            whole = range_hashes(other, low, high + window)
            bounds = np.searchsorted(row, np.append(long, b.num_rows)).astype(np.int32)
            own = w.first[:-1][row]
            lists = [pa.ListArray.from_arrays(bounds, pa.array(x)) for x in (signed(group), signed(whole), (low - own).astype(np.int32), (high - own).astype(np.int32))]
            take = pa.array(long)
            yield pa.RecordBatch.from_arrays(
                [b.column("_id").take(take), b.column("_key").take(take), pa.array(w.counts[long].astype(np.int64)), *[pa.array(signed(m)) for m in marks], *lists],
                names=["_id", "_key", "n", "f1", "f2", "group", "mark", "low", "high"],
            )

    read = docs.select(id_or_last("_doc").alias("_id"), "_key", "_said")
    return read.mapInArrow(run, "_id long, _key long, n long, f1 long, f2 long, group array<long>, mark array<long>, low array<int>, high array<int>")


def _stretches(texts: DataFrame, window: int) -> DataFrame:
    """The listed stretches: the words of those of small groups, and each window of those of large ones as a hash of 128 bits.

    A row has either ``group`` and ``words`` or ``h1`` and ``h2``.
    """
    schema = pa.schema({"group": pa.int64(), "h1": pa.int64(), "h2": pa.int64(), "_id": pa.int64(), "_key": pa.int64(), "low": pa.int32(), "words": pa.binary()})

    def batch(n: int, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_said", 1 << 20):
            w = Words(b.column("_said"))
            parts = b.column("s").flatten()
            row = np.repeat(np.arange(b.num_rows), np.diff(b.column("s").offsets.to_numpy()))
            low, high = parts.field("low").to_numpy().astype(np.int64), parts.field("high").to_numpy().astype(np.int64)
            own, large = w.first[:-1][row], parts.field("large").to_numpy(zero_copy_only=False)
            if large.any():
                first, last, base, of = low[large], high[large], own[large], row[large]
                count = last - first + 1
                at, base, take = ranges(base + first, count), np.repeat(base, count), pa.array(np.repeat(of, count))
                h1 = range_hashes(w.hashes, at, at + window)
                h2 = range_hashes(mix(w.hashes ^ np.uint64(0x5DEECE66D)), at, at + window)
                ids, keys = b.column("_id").take(take), b.column("_key").take(take)
                yield batch(len(at), h1=pa.array(signed(h1)), h2=pa.array(signed(h2)), _id=ids, _key=keys, low=pa.array((at - base).astype(np.int32)))
            if large.all():
                continue
            row, low, high, own = row[~large], low[~large], high[~large], own[~large]
            group = parts.field("group").filter(pa.array(~large))
            short = np.ascontiguousarray(w.hashes.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES]
            size = high - low + window
            data = np.ascontiguousarray(short[ranges(own + low, size)])
            ends = np.concatenate([[0], np.cumsum(size * WORD_BYTES)]).astype(np.int32)
            blobs = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())])
            take = pa.array(row)
            yield batch(len(row), group=group, _id=b.column("_id").take(take), _key=b.column("_key").take(take), low=pa.array(low.astype(np.int32)), words=blobs)

    return texts.mapInArrow(run, "group long, h1 long, h2 long, _id long, _key long, low int, words binary")


def name_windows(words: np.ndarray, window: int) -> np.ndarray:
    """For each place, a number that is equal for equal runs of ``window`` values and grows in their order.

    Places closer to the end than a window have no meaning.
    """
    name = np.unique(words, return_inverse=True)[1].astype(np.int64)
    size = 1

    def pair(step: int) -> np.ndarray:
        other = np.concatenate([name[step:], np.zeros(min(step, len(name)), np.int64)])
        return np.unique(name * (int(name.max()) + 1) + other, return_inverse=True)[1].astype(np.int64)

    while 2 * size <= window:
        name = pair(size)
        size *= 2
    return pair(window - size) if size < window else name


def _subtrees(window: int):
    """Builds the subtrees of whole groups; yields the stretches' repeated parts as ranges of words."""

    def build(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows).combine_chunks()
        ids, keys, low = (t.column(c).to_numpy() for c in ("_id", "_key", "low"))
        blobs = t.column("words").combine_chunks()
        ends = np.frombuffer(blobs.buffers()[1], np.int32)[blobs.offset : blobs.offset + len(blobs) + 1].astype(np.int64)
        raw = np.frombuffer(blobs.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(-1, WORD_BYTES)
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :WORD_BYTES] = raw
        size = np.diff(ends) // WORD_BYTES
        begin = np.cumsum(size) - size
        count = size - window + 1
        at, of = ranges(begin, count), np.repeat(np.arange(len(size)), count)
        node = name_windows(wide.view("<u8").ravel(), window)[at]
        order = np.argsort(node, kind="stable")
        edge = np.flatnonzero(np.diff(node[order], prepend=-1))
        least = np.minimum.reduceat(ids[of][order], edge)
        smallest = np.empty(len(at), np.int64)
        smallest[order] = np.repeat(least, np.diff(np.append(edge, len(at))))
        hit = np.flatnonzero(ids[of] > smallest)
        fresh = np.ones(len(hit), bool)
        fresh[1:] = (hit[1:] != hit[:-1] + 1) | (of[hit[1:]] != of[hit[:-1]])
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(hit)) - 1 if len(first) else first
        s = of[hit[first]]
        start = low[s] + (at[hit[first]] - begin[s])
        stop = low[s] + (at[hit[last]] - begin[s]) + window
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[s]), pa.array(keys[s]), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))],
            names=["_id", "_key", "start", "stop"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for big in batches:
            for b in (big.slice(k, 4096) for k in range(0, big.num_rows, 4096)):
                group = b.column("group").to_numpy()
                if size >= TREE_BYTES:
                    # The rows come group by group: what belongs to the last group begun is finished first.
                    open_group = held[-1].column("group")[-1].as_py()
                    stay = int(np.searchsorted(group != open_group, True))
                    if stay:
                        held.append(b.slice(0, stay))
                    b, group = b.slice(stay), group[stay:]
                    if len(group):
                        yield build(held)
                        held, size = [], 0
                if b.num_rows:
                    held.append(b)
                    size += b.column("words").nbytes
        if held:
            yield build(held)

    return run


def _meet(rows: DataFrame, one: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``one``, which has a row for a key and, as ``n``, how many of ``rows`` have it.

    Keys of very many rows are broadcast, so that no task gets all rows of one.
    """
    total = one.agg(F.sum("n")).first()[0] or 0
    heavy = F.col("n") > max(HEAVY, total // MOST_HEAVY)
    if one.where(heavy).isEmpty():
        return rows.join(one, keys, how)
    rest = rows.join(F.broadcast(one.where(heavy).select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(one.where(heavy)), keys).unionByName(rest.join(one.where(~heavy), keys, how))


def _firsts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the smallest id, the largest and the number of rows."""
    return rows.groupBy(*keys).agg(F.min("_id").alias("first"), F.max("_id").alias("last"), F.count(F.lit(1)).alias("n"))


def repeat_spans(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, large_group: int = LARGE_GROUP, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Where documents repeat earlier ones: ``_id``, ``_key``, ``spans`` array<struct<start, stop>> in words.

    A document has a row if it has a span; a word is in a span if a window that covers it also starts
    in a document with a smaller id. Spans may touch or overlap.
    """
    read = docs.select(F.col(f"`{doc}`").alias("_doc"), text_key(f"`{text}`").alias("_key"), F.col(f"`{text}`").cast("string").alias("_said"))
    profile = stage(_profile(read, text, window, prefix), "profile")
    alike = ["f1", "f2", "n_words"]
    profile = profile.withColumnRenamed("n", "n_words")
    shared = stage(_firsts(profile, alike).where("first <> last").drop("last"), "alike")
    known = stage(_meet(profile, shared, alike, "left").withColumn("copy", F.expr("coalesce(_id > first, false)")).drop("f1", "f2", "first", "n"), "leaders")
    copies = known.where("copy").select("_id", "_key", F.lit(0).alias("start"), F.col("n_words").cast("int").alias("stop"))

    lists = known.where("not copy").select("_id", "_key", F.explode(F.arrays_zip("group", "mark", "low", "high")).alias("s"))
    parts = lists.select("_id", "_key", "s.*")
    marks = stage(_firsts(parts, ["group", "mark"]), "marks")
    groups = marks.groupBy("group").agg(F.min("first").alias("a"), F.max("last").alias("b"), F.count(F.lit(1)).alias("n"), F.sum("n").alias("size"))
    groups = stage(groups.where("a <> b").select("group", "n", (F.col("n") > 1).alias("several"), (F.col("size") > large_group).alias("large")), "repeated_groups")
    wanted = _meet(marks.withColumnRenamed("n", "rows"), groups, ["group"])
    # A stretch of one document alone in a group of equal ones is no repeat, nor is it needed to find one.
    wanted = stage(wanted.where("several or first <> last").select("group", "mark", "first", F.col("rows").alias("n"), "several", "large"), "wanted")
    met = stage(_meet(parts, wanted, ["group", "mark"]).where("several or _id > first").drop("n", "mark"), "stretches")
    spans = copies.unionByName(met.where("_id > first").select("_id", "_key", F.col("low").alias("start"), (F.col("high") + window).alias("stop")))

    # Only what moves counts, as only that meets in a task: one stretch in very many documents moves once.
    move = met.where("_id = first").select("_id", "_key", "low", "high", "group", "large")
    crowded = stage(move.where("large").groupBy("group").count().where(F.col("count") > large_group).select("group", F.lit(True).alias("large")), "large_groups")
    split = not crowded.isEmpty()
    if split:
        move = move.drop("large").join(F.broadcast(crowded), "group", "left")
    else:
        move = move.withColumn("large", F.lit(False))
    some = move.groupBy("_id", "_key").agg(F.sort_array(F.collect_set(F.struct("low", "high", "group", F.coalesce("large", F.lit(False)).alias("large")))).alias("s"))
    sent = _stretches(read.select(id_or_last("_doc").alias("_id"), "_key", "_said").join(some, ["_id", "_key"]), window)
    if split:
        sent = stage(sent, "sent")
        suffixes = sent.where("h1 is not null").select("h1", "h2", "_id", "_key", "low")
        first = stage(_firsts(suffixes, ["h1", "h2"]).where("first <> last").drop("last"), "windows")
        late = _meet(suffixes, first, ["h1", "h2"]).where("_id > first")
        spans = spans.unionByName(late.select("_id", "_key", F.col("low").alias("start"), (F.col("low") + window).alias("stop")))
    pieces = sent.where("h1 is null").select("group", "_id", "_key", "low", "words").repartition("group").sortWithinPartitions("group")
    spans = spans.unionByName(pieces.mapInArrow(_subtrees(window), "_id long, _key long, start int, stop int"))
    return stage(spans.groupBy("_id", "_key").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans")), "spans")


@keeps_others("doc", "text")
def remove_repeats(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, large_group: int = LARGE_GROUP, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, all columns kept, without words in windows that also start in a document with a smaller id.

    ``text`` becomes the kept words (runs of anything but ASCII white space) joined by one blank; a
    null text stays null. ``n_words`` and ``n_removed`` are added, or replaced if they are there.
    Windows are judged on the input. Texts of fewer words than a window lose nothing. A missing id
    is the largest of all. Rows with the same id never cost each other a word; rows that repeat an
    id and a text share their result. An empty table gives an empty one.
    """
    spans = repeat_spans(docs, window, prefix, large_group, doc, text)
    given = [f for f in docs.schema.fields if f.name not in ("n_words", "n_removed")]
    names = [f.name for f in given]
    schema = T.StructType([*given, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    keyed = docs.select(*[F.col(f"`{n}`") for n in names], id_or_last(f"`{doc}`").alias("_id"), text_key(f"`{text}`").alias("_key"))
    joined = keyed.join(spans, ["_id", "_key"], "left").select(*[F.col(f"`{n}`") for n in names], "spans")

    def clean(said: str | None, spans: list | None) -> tuple[str | None, int, int]:
        if said is None:
            return None, 0, 0
        words = said.encode().split()
        if not spans:
            return b" ".join(words).decode(), len(words), 0
        kept, reached = [], 0
        for s in spans:
            if s["start"] > reached:
                kept += words[reached : s["start"]]
            reached = max(reached, s["stop"])
        kept += words[reached:]
        return b" ".join(kept).decode(), len(words), len(words) - len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            done = [clean(s, p) for s, p in zip(b.column(text).to_pylist(), b.column("spans").to_pylist())]
            new = {text: pa.array([x[0] for x in done], pa.string()), "n_words": pa.array([x[1] for x in done], pa.int64()), "n_removed": pa.array([x[2] for x in done], pa.int64())}
            yield pa.RecordBatch.from_arrays([new[n] if n in new else b.column(n) for n in [*names, "n_words", "n_removed"]], names=[*names, "n_words", "n_removed"])

    return joined.mapInArrow(run, schema)
