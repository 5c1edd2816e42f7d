"""From raw documents to packed training pieces: the training-data operators in a row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, jaccard, language, lines, packing
from ledgerline.llm.common import stage, table
from ledgerline.llm.queries import tokenizer_file

#: The share of a text's characters that its main language needs at least; a text half in another language stays.
MIN_LANGUAGE_SHARE = 0.25


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that are in no language: null texts, texts without a letter, or mostly in scripts that nothing was learned of."""
    found = language.identify(docs, language.fit(docs), spans=False)
    return found.where((F.col("lang_pred") != language.UND) & (F.col("score") >= MIN_LANGUAGE_SHARE)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines cut out of the texts; every document stays."""
    out = lines.spread_dedup(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles by links."""
    return jaccard.keep_one(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the benchmark has contaminated; the others stay as they are."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 2048, mixed in the corpus's own proportions."""
    return packing.pack(docs, tokenizer_file())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("jaccard_join", near_duplicates),
    ("decontamination", benchmark_free),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Language models of words and token packing have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": (run, ORACLE_SQL)}
