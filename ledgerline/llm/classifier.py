"""Quality classifier: a vote of the nearest labelled documents in a latent semantic space.

Documents become hashed term vectors (byte trigrams, and the levels of a few text statistics as
terms of their own), weighted by inverse document frequency and projected on the main singular
vectors of a bounded labelled sample. The projected sample is broadcast; every document is compared
with all of it by blocked matrix products, exactly, and its nearest ones vote by similarity. One
pass over the texts, no shuffle.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import held_out, id_or_last, keeps_others, slices, text_bytes
from ledgerline.llm.outliers import count_texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The most labelled documents, about, that are learned from (picked by a hash of the id).
SAMPLE = 4_000
#: Fixes what is broadcast: (SAMPLE + terms) * RANK numbers of four bytes, about 2 MB.
RANK = 64
GRAM_TERMS = 4096
LEVELS = 8
NEIGHBOURS = 15
#: A neighbour's weight is its cosine to this power.
SHARPNESS = 8
THRESHOLD = 0.7
BLOCK_ROWS = 1024
# Upper ends of the levels of each statistic: shares of words, lines or characters, a mean length, a log length.
STATISTICS = {
    "repeated": (0.001, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7),
    "dup_lines": (0.001, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7),
    "symbols": (0.005, 0.02, 0.05, 0.15, 0.4, 0.8, 1.5),
    "upper": (0.005, 0.02, 0.04, 0.07, 0.12, 0.3, 0.6),
    "punctuation": (0.005, 0.015, 0.03, 0.05, 0.08, 0.15, 0.3),
    "word_length": (2.5, 3.5, 4.2, 5.0, 5.8, 7.0, 9.0),
    "length": (2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.5),
}
#: How many times a statistic's level counts as a term.
STATISTIC_COUNT = 3.0
TERMS = GRAM_TERMS + LEVELS * len(STATISTICS)


def term_counts(column: pa.Array) -> np.ndarray:
    """Damped term frequencies of every text, one row of ``TERMS`` each; a null or empty text is all zero."""
    data, offsets = text_bytes(column)
    rows = len(column)
    out = np.zeros((rows, TERMS), np.float32)
    wide = data.astype(np.uint32)
    wide[(wide >= 48) & (wide <= 57)] = 48
    if len(wide) >= 3:
        code = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
        bucket = (code * np.uint32(2654435761)) >> np.uint32(20)  # multiplicative hashing to 12 bits
        size = np.diff(offsets)
        row = np.repeat(np.arange(rows), size)
        whole = row[:-2] == row[2:]
        counts = np.bincount(row[:-2][whole] * GRAM_TERMS + bucket[whole], minlength=rows * GRAM_TERMS)
        out[:, :GRAM_TERMS] = np.log1p(counts.reshape(rows, GRAM_TERMS))
    found = {k: v.astype(np.float64) for k, v in count_texts(column).items()}
    words, chars = np.maximum(found["n_words"], 1), np.maximum(found["word_chars"], 1)
    levels = {
        "repeated": found["n_repeat_words"] / words,
        "dup_lines": found["n_dup_lines"] / np.maximum(found["n_lines"], 1),
        "symbols": found["n_symbols"] / words,
        "upper": found["n_upper"] / chars,
        "punctuation": found["n_punctuation"] / chars,
        "word_length": found["word_chars"] / words,
        "length": np.log1p(found["n_words"]),
    }
    said = np.flatnonzero(found["n_words"] > 0)
    for k, (name, ends) in enumerate(STATISTICS.items()):
        out[said, GRAM_TERMS + k * LEVELS + np.searchsorted(ends, levels[name][said])] = STATISTIC_COUNT
    return out


@dataclass
class Model:
    idf: np.ndarray
    basis: np.ndarray  # terms by rank
    vectors: np.ndarray  # labelled documents by rank, of length one
    labels: np.ndarray


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def _project(counts: np.ndarray, model: Model) -> np.ndarray:
    return _unit(_unit(counts * model.idf) @ model.basis)


def fit(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, doc: str = "doc_id", text: str = "text", label: str = "quality"
) -> Model:
    """A model from the labelled documents that are not held out, about ``sample`` of them at most.

    The terms are counted in Spark; the sample's sparse counts, a few kilobytes a document, come to
    the driver, where the singular vectors are found. A document that is labelled twice counts with
    its larger label; labels of no document, null labels and empty documents teach nothing.
    """
    known = labels.where(F.col(f"`{label}`").isNotNull() & ~held_out(f"`{doc}`"))
    known = known.groupBy(F.col(f"`{doc}`").cast("long").alias("_id")).agg(F.max(F.col(f"`{label}`").cast("int")).alias("_label"))
    total = known.count()
    if total > sample:
        known = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int((1 << 20) * sample / total) + 1)
    texts = docs.select(id_or_last(f"`{doc}`").alias("_id"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = texts.join(F.broadcast(known), "_id").where(F.col("text") != "").select("_id", "_label", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, rows=BLOCK_ROWS):
            counts = term_counts(b.column("text"))
            row, term = np.nonzero(counts)
            ends = np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (term.astype(np.int16), counts[row, term])]
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_label"), *lists], names=["_id", "_label", "t", "n"])

    found = rows.mapInArrow(count, "_id long, _label int, t array<short>, n array<float>").toArrow()
    order = np.argsort(found.column("_id").to_numpy(), kind="stable")
    counts = np.zeros((len(order), TERMS), np.float32)
    for k, (t, n) in enumerate(zip(found.column("t").combine_chunks(), found.column("n").combine_chunks())):
        counts[k, t.values.to_numpy()] = n.values.to_numpy()
    counts, said = counts[order], found.column("_label").to_numpy()[order].astype(np.float32)
    idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 0.1).astype(np.float32)
    weighted = _unit(counts * idf)
    # Randomized range finder with three power steps: enough for the leading singular vectors.
    probe = np.random.Generator(np.random.PCG64(1)).standard_normal((TERMS, RANK + 16)).astype(np.float32)
    for _ in range(4):
        q, _ = np.linalg.qr(weighted @ probe) if len(counts) else (np.zeros((0, RANK + 16), np.float32), None)
        probe = weighted.T @ q
    u, s, _ = np.linalg.svd(probe, full_matrices=False)
    model = Model(idf, np.ascontiguousarray(u[:, :RANK]).astype(np.float32), np.zeros((0, RANK), np.float32), said)
    model.vectors = _project(counts, model)
    return model


def score_counts(counts: np.ndarray, model: Model, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """The vote of the nearest labelled documents; ties at the last place all vote."""
    if not len(model.labels):
        return np.full(len(counts), 0.5)
    near = _project(counts, model) @ model.vectors.T
    k = min(neighbours, near.shape[1])
    last = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
    weight = np.where(near >= last[:, None], np.maximum(near, 1e-3) ** SHARPNESS, 0)
    return np.clip((weight @ model.labels) / weight.sum(axis=1), 0, 1)


@keeps_others("text")
def classify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents without their text, with ``score`` (0 to 1) and ``predicted`` (1 from ``THRESHOLD`` on).

    A null or empty text, or one of blanks alone, has score 0. Without anything to learn from every
    other score is 0.5. Repeated texts get equal scores; clashing columns are replaced.
    """
    given = [f for f in docs.schema.fields if f.name not in ("score", "predicted", text)]
    schema = T.StructType([*given, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    names = [f.name for f in given]
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # arrays: executors need no copy of the class

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_said", rows=BLOCK_ROWS):
            counts = term_counts(b.column("_said"))
            blank = ~(counts[:, GRAM_TERMS:] > 0).any(axis=1)
            score = np.where(blank, 0.0, score_counts(counts, Model(**shared.value))).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(n) for n in names], pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                names=[*names, "score", "predicted"],
            )

    read = docs.select(*[F.col(f"`{n}`") for n in names], F.col(f"`{text}`").cast("string").alias("_said"))
    return read.mapInArrow(run, schema)
