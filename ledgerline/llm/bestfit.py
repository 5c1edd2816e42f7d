"""Best-fit packing by length patterns and non-negative least squares.

Documents are cut into pieces of at most one sequence, and all that the packing needs is how many
pieces there are of each length. From this histogram, whose size is the sequence length whatever the corpus, the
driver makes a plan:

1. Lengths are rounded up to ``CLASSES`` classes. All patterns of two or three (``FEW``) pieces whose classes fill a sequence
   exactly are enumerated.
2. Repeat counts of the patterns are fitted to the histogram by non-negative least squares, and rounded down.
3. Each repeat holds real lengths for all pieces of its pattern but the smallest. That one is a residual like all
   pieces that no pattern takes: residuals are placed by exact length, longest first, each in the fullest
   sequence that still has room for it, so that the smallest piece of a pattern fits to the token.

The plan is a list of (sequences alike, length, how many of it in each), so it depends on the lengths there are and not on
how many pieces share them. Pieces of one length are alike to it: a piece's number among those of its
length, from sums over tasks, names its sequence and its place there. No piece waits for another, and nothing is
gathered by key, so a length that a third of all pieces share is no hot spot.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import tokens
from ledgerline.llm.common import slices, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEQUENCE = 4096
#: Classes of lengths in the fit; patterns have at most this many pieces.
CLASSES = 128
FEW = 3
TEXT_SLICE = 4 << 20
#: The most bytes of per-task counts that are broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 64 << 20
#: Tasks whose counts are summed together first when numbers are carried over tasks.
TASKS_TOGETHER = 1024


# --- the plan ---------------------------------------------------------------------------------


def length_patterns(total: int, few: int = FEW) -> np.ndarray:
    """All ways to write ``total`` as a sum of two to ``few`` classes: a row of class counts for each, columns 1 to total."""
    found: list[list[int]] = []

    def extend(parts: list[int], left: int, largest: int) -> None:
        if not left:
            if len(parts) > 1:
                found.append(parts)
            return
        if len(parts) < few:
            for part in range(min(left, largest), 0, -1):
                if part * (few - len(parts)) < left:
                    break
                extend([*parts, part], left - part, part)

    extend([], total, total)
    out = np.zeros((len(found), total), np.float64)
    for k, parts in enumerate(found):
        np.add.at(out[k], np.array(parts) - 1, 1)
    return out


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, steps: int = 2000) -> np.ndarray:
    """The x >= 0 that brings ``a @ x`` nearest to ``b``, by an active set.

    The column with the steepest descent joins the set, the set is solved without bounds, and columns that
    would turn negative leave it; at the end no column outside the set could lower the error.
    """
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    scale = max(float(np.abs(a.T @ b).max(initial=0.0)), 1.0)
    for _ in range(steps):
        gain = a.T @ (b - a @ x)
        gain[active] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= 1e-9 * scale:
            break
        active[best] = True
        while True:
            at = np.flatnonzero(active)
            free = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (free > 0).all():
                x[:] = 0
                x[at] = free
                break
            falling = free <= 0
            ratio = x[at][falling] / np.maximum(x[at][falling] - free[falling], 1e-300)
            x[at] += ratio.min() * (free - x[at])
            gone = at[falling][ratio <= ratio.min()]
            x[gone] = 0
            active[gone] = False
            if not active.any():
                break
        if not active[best]:  # rounding let no progress
            break
    return x


@dataclass
class _Alike:
    """``count`` sequences of the same lengths; ``holds`` are (length, how many of it) and what they were before that."""

    count: int
    holds: tuple | None

    def lengths(self) -> list[tuple[int, int]]:
        out, at = [], self.holds
        while at is not None:
            (length, many), at = at
            out.append((length, many))
        return out[::-1]


class _Open:
    """Sequences by the room that is left in them."""

    def __init__(self):
        self.by_room: dict[int, list[_Alike]] = {}
        self.rooms: list[int] = []

    def put(self, room: int, group: _Alike) -> None:
        if room not in self.by_room:
            self.by_room[room] = []
            insort(self.rooms, room)
        self.by_room[room].append(group)

    def tightest(self, length: int) -> tuple[int, _Alike] | None:
        """The group with the least room of ``length`` or more, taken out."""
        at = bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        group = self.by_room[room].pop()
        if not self.by_room[room]:
            del self.by_room[room], self.rooms[at]
        return room, group

    def groups(self) -> list[_Alike]:
        return [g for room in self.rooms for g in self.by_room[room]]


def _fit_patterns(left: np.ndarray, sequence: int, classes: int, few: int) -> _Open:
    """Sequences that hold their patterns' pieces but the smallest; these pieces are taken off ``left``."""
    out = _Open()
    grain = -(-sequence // classes)
    if sequence % grain or sequence // grain < 2:
        return out  # no pattern fills a sequence: all pieces are residuals
    classes = sequence // grain
    of_class = [np.arange((c - 1) * grain + 1, c * grain + 1) for c in range(1, classes + 1)]
    target = np.array([left[x].sum() for x in of_class], np.float64)
    if not target.any():
        return out
    patterns = length_patterns(classes, few)
    # An error in a class counts by the tokens it stands for.
    weight = np.arange(1, classes + 1) / classes
    repeats = np.floor(nonnegative_least_squares((patterns * weight).T, target * weight) + 1e-6).astype(np.int64)
    have = target.astype(np.int64)
    for k in np.argsort(-repeats, kind="stable"):
        used = patterns[k].astype(np.int64)
        used[np.flatnonzero(used)[0]] -= 1  # the smallest piece is placed by its exact length
        some = np.flatnonzero(used)
        r = int(min(repeats[k], (have[some] // used[some]).min()))
        if r <= 0:
            continue
        have -= r * used
        _hold(out, left, [of_class[c] for c in some for _ in range(used[c])], r, sequence)
    return out


def _hold(out: _Open, left: np.ndarray, slots: list[np.ndarray], repeats: int, sequence: int) -> None:
    """``repeats`` sequences with a piece of each slot's lengths; the longest of a class go first."""
    while repeats:
        picked = []
        for lengths in slots:
            there = lengths[left[lengths] > 0]
            picked.append(int(there[-1]))
            left[there[-1]] -= 1  # set aside, so that a slot of the same class sees one less
        many = 1 + min([repeats - 1, *(int(left[x]) // picked.count(x) for x in set(picked))])
        for x in picked:
            left[x] -= many - 1
        holds = None
        for x in picked:
            holds = ((x, 1), holds)
        out.put(sequence - sum(picked), _Alike(many, holds))
        repeats -= many


def _fill(out: _Open, left: np.ndarray, sequence: int) -> None:
    """Residual pieces, longest first, each in the fullest sequence that has room, or in a new one."""
    for length in range(sequence, 0, -1):
        n = int(left[length])
        while n:
            found = out.tightest(length)
            room, group = found if found else (sequence, _Alike(-(-n // (sequence // length)), None))
            fit = room // length
            whole = min(group.count, n // fit)
            if whole:
                out.put(room - fit * length, _Alike(whole, ((length, fit), group.holds)))
                n -= whole * fit
            rest = group.count - whole
            if rest and 0 < n < fit:
                out.put(room - n * length, _Alike(1, ((length, n), group.holds)))
                n, rest = 0, rest - 1
            if rest:
                out.put(room, _Alike(rest, group.holds))
        left[length] = 0


@dataclass
class Plan:
    """Where the pieces of each length go.

    The pieces of all lengths are numbered through, shorter ones first; ``base[length]`` is the first number of a length.
    Entry k holds the numbers from ``start[k]`` on: ``each[k]`` of them to a sequence, from sequence ``first[k]`` and place ``offset[k]`` on.
    """

    base: np.ndarray
    start: np.ndarray
    each: np.ndarray
    first: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        number = self.base[length] + rank
        k = np.searchsorted(self.start, number, "right") - 1
        nth = number - self.start[k]
        return self.first[k] + nth // self.each[k], self.offset[k] + nth % self.each[k] * length


def plan(histogram: np.ndarray, sequence: int = SEQUENCE, classes: int = CLASSES, few: int = FEW) -> Plan:
    """The packing of ``histogram[length]`` pieces of each length from 1 to ``sequence``."""
    left = np.array(histogram, np.int64)
    base = np.cumsum(left) - left
    open_ = _fit_patterns(left, sequence, classes, few)
    _fill(open_, left, sequence)
    rows, at, done = [], base.copy(), 0
    for group in open_.groups():
        offset = 0
        for length, each in group.lengths():
            rows.append((int(at[length]), each, done, offset))
            at[length] += group.count * each
            offset += length * each
        done += group.count
    start, each, first, offset = np.array(sorted(rows), np.int64).reshape(-1, 4).T.copy()
    return Plan(base, start, each, first, offset, done)


# --- the pieces -------------------------------------------------------------------------------


def tokenize(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of at most ``sequence`` ids: doc_id, piece, start, length, ids (as ``tokens.id_kind`` says), task, rank.

    ``rank`` numbers the pieces of a length within the task: written out, task and rank order them.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    read = docs.select(F.col(f"`{doc}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(sequence + 1, np.int64)
        for b in slices(batches, limit=TEXT_SLICE):
            ids, offsets = tokens.encode(b.column("text"), spec.value)
            row, nth, start, length = tokens.pieces(offsets, sequence)
            order = np.argsort(length, kind="stable")
            count = np.bincount(length, minlength=sequence + 1)
            rank = np.empty(len(row), np.int64)
            rank[order] = np.arange(len(row)) - (np.cumsum(count) - count)[length[order]] + seen[length[order]]
            seen += count
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(row)), pa.array(nth.astype(np.int32)), pa.array(start), pa.array(length.astype(np.int32)),
                 tokens.as_binary(ids, length).cast(pa.binary()), pa.array(np.full(len(row), task, np.int32)), pa.array(rank)],
                names=["doc_id", "piece", "start", "length", "ids", "task", "rank"],
            )

    return read.mapInArrow(run, "doc_id long, piece int, start long, length int, ids binary, task int, rank long")


def _carried(counts: DataFrame, together: int = TASKS_TOGETHER) -> DataFrame:
    """For each task and length, how many pieces of the length the tasks before hold.

    Sums go over groups of tasks first, then over the tasks of a group: no window sees more rows than the larger of the two numbers.
    """
    grouped = counts.withColumn("some", F.floor(F.col("task") / together).cast("int"))
    groups = grouped.groupBy("length", "some").agg(F.sum("n").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("some")) - F.col("n")
    groups = groups.select("length", "some", earlier.alias("earlier"))
    inside = F.sum("n").over(Window.partitionBy("length", "some").orderBy("task")) - F.col("n")
    rows = grouped.withColumn("inside", inside).join(groups, ["length", "some"])
    return rows.select("task", "length", (F.col("earlier") + F.col("inside")).alias("before"))


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    sequence: int = SEQUENCE,
    classes: int = CLASSES,
    few: int = FEW,
    doc: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every document in as few sequences as the plan can make, whole unless it is longer than a sequence.

    Columns: doc_id, piece (from 0), start (ids of the document before the piece), length, ids (binary, unsigned 32-bit
    little-endian), sequence_id (from 0, without gaps), offset (gapless from 0 in each sequence).

    A document of more ids than ``sequence`` is cut after every ``sequence`` of them; its last piece is packed like
    a document. A null or empty text is its end id alone. Rows that repeat a document are packed as often. An empty
    table gives no pieces. Other columns are not read.

    The ids are written once and read once; beside them only counts by task and length move.
    """
    spark = docs.sparkSession
    pieces = stage(tokenize(docs, tokenizer_path, sequence, doc, text), "whole_pieces")
    counts = stage(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "piece_counts")
    histogram = np.zeros(sequence + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row per length at most
        histogram[r["length"]] = r["n"]
    made = spark.sparkContext.broadcast(plan(histogram, sequence, classes, few).__dict__)
    carried = stage(_carried(counts), "pieces_before")
    side = F.broadcast(carried) if 32 * carried.count() <= BROADCAST_BYTES else carried
    placed = pieces.join(side, ["task", "length"])

    with open(tokenizer_path, encoding="utf-8") as f:
        kind = np.dtype(tokens.id_kind(f.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Plan(**made.value)
        for b in batches:
            if not b.num_rows:
                continue
            length = b.column("length").to_numpy().astype(np.int64)
            number, offset = found.place(length, b.column("before").to_numpy() + b.column("rank").to_numpy())
            ids = tokens.binary_values(b.column("ids"), kind).astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("piece"), b.column("start"), pa.array(length), tokens.as_binary(ids, length).cast(pa.binary()),
                 pa.array(number), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"],
            )

    kinds = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"
    return placed.mapInArrow(run, kinds)
