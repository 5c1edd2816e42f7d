"""Token packing under a mixture: deficit round-robin over one queue per source.

Each round grants every source its quantum, the source's target share of one sequence; a source
sends the pieces that its credit covers and carries what is left, its deficit, into the next round.
While a queue holds pieces its credit after round r is r quanta less what it has sent, so the round
of a piece is known from the tokens up to its end alone: the least r with r * quantum >= end. That
makes the scheduler a formula over running sums, and deficits carry over windows, tasks and machines
without a task waiting for another one. Pieces in the order (round, source, place in the queue) fill
the sequences one after the other, cut where a sequence is full; so at every point of the output
each source has had its share to within one quantum and one piece, and only the very last sequence
is not full. When a queue runs dry, the others fill its place.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import tokens
from ledgerline.llm.common import slices, small_batches, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEQUENCE = 2048
#: Tokens of a piece at most: a smaller one follows the mixture more closely, a larger one cuts fewer texts.
PIECE = 256
#: Rounds whose pieces are laid out by one task: some eight million tokens.
ROUNDS = 4096
#: Bytes of text that are tokenized at once: a larger slice repeats more of its words.
TEXT_SLICE = 2 << 20
#: The most rows of block or round totals that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 500_000

def tokenize(docs: DataFrame, tokenizer_path: str, piece: int = PIECE, doc: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Pieces of at most ``piece`` ids: doc_id, source, start, length, doc_tokens, ids, block, upto.

    ``ids`` are packed as ``tokens.id_kind`` says; the text's ids are followed by the end id, so a null or
    empty text is one piece of one id. ``block`` is the task, ``upto`` the tokens of the source in
    that task up to the piece's end: written out, they are the order of the queues.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    read = docs.select(
        F.col(f"`{doc}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("source"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()
        done: dict[str, int] = {}
        for b in slices(batches, limit=TEXT_SLICE):
            ids, offsets = tokens.encode(b.column("text"), spec.value)
            row, _, start, length = tokens.pieces(offsets, piece)
            names = b.column("source").dictionary_encode()
            upto = _running(names.indices.to_numpy()[row], length, names.dictionary.to_pylist(), done)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(at), b.column("source").take(at), pa.array(start), pa.array(length), pa.array(np.diff(offsets)[row]),
                 tokens.as_binary(ids, length).cast(pa.binary()), pa.array(np.full(len(row), block, np.int32)), pa.array(upto)],
                names=["doc_id", "source", "start", "length", "doc_tokens", "ids", "block", "upto"],
            )

    kinds = "doc_id long, source string, start long, length long, doc_tokens long, ids binary, block int, upto long"
    return read.mapInArrow(run, kinds)


def _running(group: np.ndarray, value: np.ndarray, names: list, done: dict[str, int]) -> np.ndarray:
    """The sum of its group's values up to each row, carried on in ``done`` from slice to slice."""
    order = np.argsort(group, kind="stable")
    sums = np.cumsum(value[order])
    firsts = np.flatnonzero(np.diff(group[order], prepend=-1))
    before = np.concatenate([[0], sums])[firsts]
    had = np.array([done.get(names[g], 0) for g in group[order][firsts]], np.int64)
    sums += np.repeat(had - before, np.diff(firsts, append=len(group)))
    for g, s in zip(group[order][firsts], sums[np.append(firsts[1:], len(group)) - 1]):
        done[names[g]] = int(s)
    out = np.empty(len(group), np.int64)
    out[order] = sums
    return out


def _side(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    weights: Mapping[str, float] | None = None,
    sequence: int = SEQUENCE,
    piece: int = PIECE,
    doc: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Every id of every document in exactly one piece of one sequence.

    Columns: doc_id, source, start (ids of the document before the piece), length, doc_tokens, ids
    (binary, unsigned 32-bit little-endian), sequence_id, offset (gapless from 0 in each sequence).

    ``weights`` are the target proportions by source; a source that is not named has its own share
    of all tokens as its weight, so without weights the targets are the corpus's proportions and all
    queues end together. A weight of 0 or less is refused, as every token must be packed. A missing source is the source "". A null or empty text is its end id alone.
    Rows that repeat a document are packed as often. An empty table gives no pieces. Other columns are not read.

    The ids are written once, moved by one shuffle, and laid out in tasks of ``ROUNDS`` rounds each; a
    source with a third of all rows is spread over all rounds like any other.
    """
    if weights and min(weights.values()) <= 0:
        raise ValueError("weights are above 0: a source without a share could not be packed")
    spark = docs.sparkSession
    with small_batches(spark):
        pieces = stage(tokenize(docs, tokenizer_path, piece, doc, text, source), "pieces")
    blocks = stage(pieces.groupBy("source", "block").agg(F.sum("length").alias("n")), "blocks")
    queue = Window.partitionBy("source").orderBy("block")
    blocks = blocks.withColumn("before", F.sum("n").over(queue) - F.col("n"))
    shares = blocks.groupBy("source").agg(F.sum("n").alias("n"))
    total = shares.agg(F.sum("n")).first()[0] or 1
    share = F.col("n") / F.lit(float(total))
    if weights:
        given = spark.createDataFrame([(s, float(w)) for s, w in weights.items()], "source string, w double")
        shares = shares.join(F.broadcast(given), "source", "left").withColumn("w", F.coalesce("w", share))
    else:
        shares = shares.withColumn("w", share)
    shares = stage(shares.select("source", "w"), "shares")
    sum_w = shares.agg(F.sum("w")).first()[0] or 1.0
    shares = shares.select("source", (F.col("w") / sum_w * sequence).alias("quantum"))
    queues = stage(blocks.select("source", "block", "before").join(_side(shares), "source"), "queues")
    end = F.col("before") + F.col("upto")
    rounds = pieces.join(_side(queues), ["source", "block"]).withColumn("end", end)
    rounds = rounds.withColumn("round", F.ceil(F.col("end") / F.col("quantum")).cast("long"))
    rounds = rounds.withColumn("part", F.floor(F.col("round") / ROUNDS).cast("long"))
    parts = stage(rounds.groupBy("part").agg(F.sum("length").alias("n")), "parts")  # one row per ROUNDS sequences
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    laid = rounds.join(_side(stage(parts, "bases")), "part")
    laid = laid.repartition("part").sortWithinPartitions("part", "round", "source", "end")
    laid = laid.select("doc_id", "source", "start", "length", "doc_tokens", "ids", "part", "base")

    with open(tokenizer_path, encoding="utf-8") as f:
        kind = np.dtype(tokens.id_kind(f.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, reached = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            length = b.column("length").to_numpy()
            own, base = b.column("part").to_numpy(), b.column("base").to_numpy()
            # The first token's place in the whole output: the part's base and what the part has had so far.
            before = np.cumsum(length) - length
            fresh = np.ones(len(own), bool)
            fresh[1:] = own[1:] != own[:-1]
            fresh[0] = own[0] != part
            begin = np.where(fresh, base - before, 0)
            group = np.cumsum(fresh) - 1
            firsts = np.flatnonzero(fresh)
            place = before + np.where(group >= 0, begin[firsts[np.maximum(group, 0)]] if len(firsts) else 0, reached)
            part, reached = own[-1], place[-1] + length[-1]
            count = (place + length - 1) // sequence - place // sequence + 1
            row = np.repeat(np.arange(len(length)), count)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            number = place[row] // sequence + nth
            first = np.maximum(number * sequence, place[row])
            size = np.minimum((number + 1) * sequence, place[row] + length[row]) - first
            inside = first - place[row]
            ids = tokens.binary_values(b.column("ids"), kind).astype("<u4")  # the cuts of a piece lie side by side
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(at), b.column("source").take(at), pa.array(b.column("start").to_numpy()[row] + inside), pa.array(size),
                 b.column("doc_tokens").take(at), tokens.as_binary(ids, size).cast(pa.binary()), pa.array(number), pa.array(first - number * sequence)],
                names=["doc_id", "source", "start", "length", "doc_tokens", "ids", "sequence_id", "offset"],
            )

    kinds = "doc_id long, source string, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long"
    return laid.mapInArrow(run, kinds)


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence: ``sequence_id``, ``ids`` (binary, as in the pieces) and ``n_tokens``."""
    rows = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("n_tokens"))
    joined = F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return rows.select("sequence_id", joined.alias("ids"), "n_tokens")
