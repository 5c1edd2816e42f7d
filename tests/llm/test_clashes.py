"""Columns of the caller's, whatever their names, come back as they were; models travel to workers that know nothing of the package."""

import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import classifier, decontaminate, html, jaccard, language, lines, outliers, packing, queries, repeats

NAMES = [
    "_id", "_key", "_cut", "spans", "_said", "_html", "_p", "_lead", "l", "s", "start", "rows", "g_lang", "g_source", "x0", "m0", "det", "h", "first",
    "w", "n", "f1", "f2", "_row", "_doc", "items", "component", "centre", "group", "low", "high", "__other0",
]
PROSE = "the man and the dog of the town is in the house by the river and it was not for us to say that all is well with them "


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(k, PROSE * (1 + k % 3) + str(k // 2), "en" if k % 4 else None, ("", None, "b")[k % 3]) for k in range(12)] + [(12, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return docs.select("*", *[F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")).alias(n) for n in NAMES])


def operators(spark, docs):
    bench = spark.createDataFrame([(1, PROSE)], "item_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    return {
        "lines": lambda d: lines.spread_dedup(d, 2),
        "documents": lambda d: decontaminate.decontaminate(d, bench),
        "cut": lambda d: decontaminate.decontaminate(d, bench, action="spans"),
        "keep_one": jaccard.keep_one,
        "repeats": repeats.remove_repeats,
        "statistics": outliers.statistics,
        "judge": lambda d: outliers.judge(outliers.statistics(d)),
        "classify": lambda d: classifier.classify(d, classifier.fit(docs.select("doc_id", "text"), labels)),
        "identify": lambda d: language.identify(d, language.fit(docs), spans=False),
        "html": lambda d: html.extract_text(d.withColumnRenamed("text", "html")),
    }


@pytest.mark.parametrize("name", ["lines", "documents", "cut", "keep_one", "repeats", "statistics", "judge", "classify", "identify", "html"])
def test_other_columns_come_back(spark, clashing, name):
    run = operators(spark, clashing)[name]
    got = run(clashing)
    plain = run(clashing.select("doc_id", "text", "lang", "source"))
    assert {n for n in NAMES} <= set(got.columns)
    for r in got.collect():
        assert all(r[n] == f"{n}:{r.doc_id}" for n in NAMES)
    results = [c for c in plain.columns]
    assert sorted(map(repr, got.select(*results).collect())) == sorted(map(repr, plain.collect()))


def test_hit_words_go_and_their_surroundings_stay(spark):
    bench = spark.createDataFrame([(1, PROSE)], "item_id long, text string")
    text = f"Before it. {PROSE.strip()}.\n\nNext paragraph"
    docs = spark.createDataFrame([(1, text), (2, PROSE.strip().replace(" ", ", ")), (3, "(" + PROSE.upper() + ")")], "doc_id long, text string")
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, bench, action="spans").collect()}
    assert cut == {1: "Before it. .\n\nNext paragraph", 2: "", 3: "( )"}


def test_many_windows_meet_in_a_shuffle(spark, clashing, monkeypatch):
    bench = spark.createDataFrame([(1, PROSE), (2, "the dog"), (3, "not there at all")], "item_id long, text string")
    docs = clashing.select("doc_id", "text")
    few = sorted(map(repr, decontaminate.hits(docs, bench).drop("spans").collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_GRAMS", 0)
    many = decontaminate.hits(docs, bench)
    assert sorted(map(repr, many.drop("spans").collect())) == few
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    join = plan[: plan.rindex("Generate")]
    assert "said" in join and "Join LeftOuter" in join


def test_null_and_empty_groups_are_apart(spark):
    rows = [("en", None), ("en", ""), (None, ""), ("", "")] * 60
    groups = outliers._groups(spark.createDataFrame(rows, "lang string, source string"), "lang", "source", 50)
    assert groups.select("g_lang", "g_source").distinct().count() == 4


def test_weights_must_be_positive(clashing):
    with pytest.raises(ValueError, match="above 0"):
        packing.pack(clashing, queries.tokenizer_file(), {"a": 0.0, "b": 1.0})


def test_main_elements_in_a_named_wrapper_are_text():
    page = f'<div class="sidebar"><main><p>{PROSE * 4}</p></main></div><div><p>{PROSE * 9} other</p></div>'
    assert html.main_text(page).startswith(PROSE.strip())
    assert PROSE.strip() in html.main_text(page).split("\n")[0] and len(html.main_text(page).split("\n")) == 2


APART = """
import sys
sys.path.insert(0, {repo!r})
import os
os.chdir({cwd!r})
os.environ["PYTHONPATH"] = ""
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local-cluster[1,1,1024]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {cwd!r}).config("spark.driver.host", "127.0.0.1").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
from ledgerline.llm import classifier, language
rows = [(k, "the man and the dog of the town " * 9, "en") for k in range(20)] + [(k, "der Hund und die Katze von der Stadt " * 9, "de") for k in range(20, 40)]
docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))

def absent(batches):
    import importlib.util
    import pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("ledgerline") is not None])], names=["x"])

seen = spark.range(1, numPartitions=1).mapInArrow(absent, "x boolean").first()[0]
found = language.identify(docs, language.fit(docs), spans=False).where("lang = lang_pred").count()
print("RESULT", seen, found, classifier.classify(docs, classifier.fit(docs, labels)).count())
"""


def test_models_reach_workers_without_the_package(tmp_path):
    from pathlib import Path

    script = tmp_path / "apart.py"
    script.write_text(APART.format(repo=str(Path(__file__).resolve().parents[2]), cwd=str(tmp_path)))
    done = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=240, cwd=tmp_path)
    assert "RESULT False 40 40" in done.stdout, done.stdout + done.stderr[-2000:]
