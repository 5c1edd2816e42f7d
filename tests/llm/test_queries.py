"""The registered queries: contracts, SQL on DuckDB, and the pipeline."""

import pytest

import corpus_pipeline
from ledgerline.llm import queries
from ledgerline.llm.common import stage, table
from tests.compare import connect, difference

SQL = {name: sql for name, (_, sql) in queries.QUERIES.items() if sql}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, folder, name):
    assert difference(queries.QUERIES[name][0](spark, folder), connect(folder), SQL[name]) is None


CONTRACTS = {
    "op1_outliers": ("documents", "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean"),
    "op3_mixture_packing": (None, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"),
    "op5_quality": ("documents", "doc_id bigint, held_out boolean, score double, predicted int"),
    "op7_html_text": ("pages", "page_id bigint, url string, text string, n_chars bigint"),
    "op8_jaccard": ("documents", "doc_id bigint, n_shingles bigint, component_id bigint"),
    "op10_language": ("documents", "doc_id bigint, held_out boolean, lang_pred string, score double"),
    "op11_pattern_packing": (None, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"),
    "op13_whitening": (None, "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"),
}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_query_contract(spark, folder, name):
    source, columns = CONTRACTS[name]
    got = queries.QUERIES[name][0](spark, folder)
    assert {tuple(c.split()) for c in columns.split(", ")} <= set(got.dtypes)
    assert got.count() == (table(spark, folder, source).count() if source else got.count())


def test_pipeline_stages(spark, folder):
    docs = table(spark, folder, "documents")
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for name, fn in corpus_pipeline.STAGES[:-1]:
        out = stage(fn(spark, docs, folder), name)
        assert out.columns == columns
        kept = {r.doc_id for r in out.select("doc_id").collect()}
        assert kept <= ids and len(kept) >= 0.8 * len(ids)
        docs, ids = out, kept
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {p.doc_id for p in pieces} == ids
    run = corpus_pipeline.run(spark, folder).collect()
    key = lambda p: (p.doc_id, p.start, p.length, bytes(p.ids), p.sequence_id, p.offset)
    assert sorted(map(key, run)) == sorted(map(key, pieces))
