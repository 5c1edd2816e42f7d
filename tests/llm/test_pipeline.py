"""The stages of the pipeline against brute force on a small table."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm.common import stage, table
from tests.llm.test_operators import DOCS, LOWER, brute_components

RUSSIAN = "старый рыбак жил на берегу реки и каждый день выходил на лодке проверить сети"


def asked(text, n=13):
    w = [x for x in "".join(c if c.isalnum() and c.isascii() or not c.isascii() else " " for c in text.translate(LOWER)).split()]
    return w, {tuple(w[k : k + min(n, len(w))]) for k in range(len(w) - min(n, len(w)) + 1)} if w else set()


@pytest.fixture(scope="module")
def given(spark, folder):
    docs = table(spark, folder, "documents")
    item = max((r.text for r in table(spark, folder, "benchmark").collect()), key=len)
    clean = [r for r in docs.where("length(text) > 300 and text is not null").orderBy("doc_id").limit(25).collect()]
    rows = [(r.doc_id, f"All rights reserved here\n{r.text}", r.lang, f"s{k % 12}", 0) for k, r in enumerate(clean)]
    rows += [(10_000 + r.doc_id, f"{r.text} one", r.lang, "s1", 0) for r in clean[:5]]
    rows += [(20_000, None, "en", "s1", 0), (20_001, "123 456 !!", "en", "s1", 0), (20_002, RUSSIAN, None, "s2", 0)]
    half = clean[0].text[:60]
    rows += [(20_003, f"{RUSSIAN * 12} {half}", None, "s2", 0), (20_004, f"{RUSSIAN[:40]} {clean[1].text[:200]}", None, "s3", 0)]
    rows += [(20_005, item, "en", "s4", 0), (20_006, f"before that {item} after it", "en", "s4", 0)]
    return spark.createDataFrame(rows, DOCS).withColumn("n_chars", F.length("text").cast("long"))


def texts(frame):
    got = {r.doc_id: r.text for r in frame.collect()}
    assert len(got) == frame.count()
    return got


def test_stages_against_brute_force(spark, folder, given):
    stages = dict(corpus_pipeline.STAGES)
    before = texts(given)

    # Languages: texts of null, without letters, or with under a quarter of their word characters in Latin, go.
    out = stage(stages["language_id"](spark, given, folder), "language_id")
    gone = {20_000, 20_001, 20_002, 20_003}
    assert texts(out) == {k: t for k, t in before.items() if k not in gone}
    docs, before = out, texts(out)

    # Lines: one that stands in enough sites is cut but for its first place.
    out = stage(stages["line_dedup"](spark, docs, folder), "line_dedup")
    sites, first = {}, {}
    source = {r.doc_id: r.source for r in docs.collect()}
    for k in sorted(before):
        for p, x in enumerate(before[k].split("\n")):
            if x := x.strip(" \t\r\f\x0b"):
                sites.setdefault(x, set()).add(source[k])
                first.setdefault(x, (k, p))
    least = corpus_pipeline.lines.MIN_SITES
    want = {}
    for k, t in before.items():
        kept = [x for p, x in enumerate(t.split("\n")) if not (s := x.strip(" \t\r\f\x0b")) or len(sites[s]) < least or first[s] == (k, p)]
        want[k] = "\n".join(kept)
    assert texts(out) == want
    assert all(r.n_chars == len(r.text) for r in out.collect())
    docs, before = out, want

    # Near copies: the smallest id of each component stays.
    out = stage(stages["jaccard_join"](spark, docs, folder), "jaccard_join")
    component = {d: c for d, n, c in brute_components(docs.collect()) if n}
    want = {k: t for k, t in before.items() if component.get(k, k) == k}
    assert texts(out) == want and len(want) < len(before)
    docs, before = out, want

    # Contamination: a twentieth of the words in runs that an item has.
    out = stage(stages["decontamination"](spark, docs, folder), "decontamination")
    grams = set().union(*[asked(r.text or "")[1] for r in table(spark, folder, "benchmark").collect()])
    sizes = {len(g) for g in grams}
    want = {}
    for k, t in before.items():
        w = asked(t)[0]
        hit = {p for n in sizes for a in range(len(w) - n + 1) if tuple(w[a : a + n]) in grams for p in range(a, a + n)}
        if not hit or 20 * len(hit) < len(w):
            want[k] = t
    assert texts(out) == want and len(want) < len(before)

    pieces = stage(stages["packing"](spark, out, folder), "packing").collect()
    assert {p.doc_id for p in pieces} == {k for k, t in want.items() if t}
