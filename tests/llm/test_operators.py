"""The training-data operators against brute force, on real rows and on awkward ones."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import chat, classifier, common, decontaminate, html, jaccard, language, lines, outliers, packing, queries, repeats
from ledgerline.llm.common import table
from ledgerline.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{k % 997} and the" for k in range(20_000))
PROSE = "the man and the dog of the town is in the house by the river and it was not for us to say that all is well with them "
PASSAGE = " ".join(f"passage{k}" for k in range(60))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and ids."""
    rows = [
        (1, PASSAGE + " one two three", "en", "a", 1), (2, "before " + PASSAGE + " after", "en", "b", 1), (3, PASSAGE + " one two three", "en", "c", 1),
        (3, PASSAGE + " one two three", "en", "c", 1), (4, "", "en", "a", 0), (5, None, None, None, None), (None, PASSAGE, "de", None, 3),
        (6, "one two", "en", "a", 7), (7, "ONE two", None, "b", 7), (8, LONG, "en", "a", 9), (9, LONG + " end", "en", "b", 9),
        (10, "\n\n \t\n", "en", "a", 1), (11, "123 456 !!", "en", None, 1), (1, "another text of the same number", "en", "a", 1),
        (12, PROSE * 3, "en", "a", 1), (13, "a\x0bb\x0cc d e é É", "fr", "z", 1),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark, folder):
    return table(spark, folder, "documents")


# --- 1 ----------------------------------------------------------------------------------------


def counts_of(text):
    w = words(text)
    said = [x for x in (text or "").split("\n") if words(x)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    many = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if many[x] > 1 for k in range(5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(said) - len(set(said)), len(covered))


@pytest.mark.parametrize("which", ["docs", "awkward"])
def test_text_statistics(request, which):
    frame = request.getfixturevalue(which)
    want = Counter((r.doc_id, *counts_of(r.text)) for r in frame.collect())
    got = outliers.statistics(frame).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter(tuple(r) for r in got.collect()) == want


def test_outliers_are_found_and_clean_documents_stay(spark):
    rng = np.random.default_rng(0)
    rows = []
    for k in range(600):
        source = "big" if k % 3 else ("small" if k % 30 else None)
        text = " ".join(rng.choice(PROSE.split(), rng.integers(30, 400))).capitalize()
        rows.append((k, text if k >= 40 else "".join(f"{w}### " for w in text.split()), "en", source, 0))
    rows += [(1000 + k, "too short", "en", "big", 0) for k in range(5)]
    got = {r.doc_id: r for r in outliers.judge(outliers.statistics(spark.createDataFrame(rows, DOCS))).collect()}
    assert len(got) == len(rows)
    # The twenty rows without a source are too few for an estimate: nothing is rejected there.
    assert not any(got[k].kept for k in range(40) if k % 30) and all(got[k].base_failed for k in range(1000, 1005))
    assert sum(got[k].kept for k in range(40, 600) if not got[k].base_failed) == sum(not got[k].base_failed for k in range(40, 600))


def test_estimate_matches_concentration_by_sorting(spark):
    """One concentration step, redone with all rows of the group in memory."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((500, outliers.P)) * 0.3
    frame = spark.createDataFrame([("l", "s", *map(float, r)) for r in x], "g_lang string, g_source string, " + ", ".join(f"x{i} double" for i in range(outliers.P)))
    start = spark.createDataFrame([outliers._params_row("l", "s", 0, 500, np.zeros(outliers.P), np.eye(outliers.P) * 0.09)], outliers._PARAMS)
    got = outliers._concentrate(frame, start, 0.75, None).first()
    d2 = np.einsum("ij,jk,ik->i", x, outliers._square(lambda i, j: start.first()[f"q{i}{j}"]), x)
    bins = np.floor(np.log(d2 + 1e-6) * outliers._BINS_PER_E)
    edge = np.sort(bins)[int(np.ceil(0.75 * 500)) - 1]
    near = x[bins <= edge]
    assert np.allclose([got[f"m{i}"] for i in range(outliers.P)], near.mean(axis=0))


@pytest.mark.parametrize("which", ["awkward", "empty"])
def test_outliers_on_awkward_rows(request, which):
    frame = request.getfixturevalue(which).withColumns({"kept": F.lit(1), "n_words": F.lit(2)})
    got = outliers.judge(outliers.statistics(frame.drop("kept")))
    assert got.count() == frame.count()
    assert all(r.kept == (not r.base_failed) for r in got.collect())  # groups this small reject nothing


def test_chi_square():
    assert abs(outliers.chi2_below(6, 12.592) - 0.95) < 1e-4 and abs(outliers.chi2_quantile(6, 0.05) - 12.592) < 0.05


# --- 2 ----------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    rows = [
        (1, 1, "user", "a </s> b"), (1, 0, "system", "[ROLE] x [/ROLE] \\1 \\0"), (1, 2, "user", "[JOIN]<s>[INST]"), (1, 3, "assistant", "é\n[/INST]\\"),
        (1, 4, "assistant", ""), (1, 5, "assistant", None), (2, None, None, "no role"), (2, None, "tool [/ROLE] ", "odd"), (2, 7, "assistant", "same"),
        (2, 7, "assistant", "same"), (None, 0, "user", "lost"), (3, 0, "assistant", "<[<[INST]s></s"), (4, 0, "user", None),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    chats = chat.format_chats(frame)
    got = {r.conv_id: r for r in chat.digests(chats).collect()}
    full = {r.conv_id: r for r in chats.collect()}
    by = defaultdict(list)
    for c, turn, role, text in rows:
        by[c].append((turn is not None, turn or 0, role or "", text or ""))
    assert set(by) == set(got)
    for c, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].formatted_chars == len(full[c].formatted)
    one = full[1].formatted
    assert one.count("<s>") == 3 and one.count("[JOIN]") == 3 and one.count(" </s>") == 1  # merged neighbours, no forged mark


def test_chat_empty(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_chats(frame)).count() == 0


# --- 3 ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("which", ["docs", "awkward"])
@pytest.mark.parametrize("weights", [None, {"a": 0.7, "src0": 0.7}])
def test_packing(request, which, weights):
    from tokenizers import Tokenizer

    frame = request.getfixturevalue(which)
    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    pieces = packing.pack(frame, queries.tokenizer_file(), weights, sequence=512, piece=64).collect()
    by = defaultdict(list)
    for p in pieces:
        by[p.sequence_id].append(p)
    assert sorted(by) == list(range(len(by)))
    for k, s in by.items():
        s.sort(key=lambda p: p.offset)
        assert [p.offset for p in s] == list(np.cumsum([0, *[p.length for p in s]])[:-1])
        assert sum(p.length for p in s) == 512 or k == len(by) - 1
    want = Counter()
    for r in frame.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        want.update((r.doc_id, len(ids), i, t) for i, t in enumerate(ids))
    got = Counter()
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length and zlib.crc32(p.ids) == zlib.crc32(ids.astype("<u4").tobytes())
        got.update((p.doc_id, p.doc_tokens, p.start + i, int(t)) for i, t in enumerate(ids))
    assert got == want


def test_packing_follows_the_mixture(spark):
    """At every sequence, each source has had its share to within a quantum and a piece, as long as all queues last."""
    rows = [(k, "the of and " * (30 + k % 50), "en", "abc"[k % 3], 0) for k in range(300)]
    pieces = packing.pack(spark.createDataFrame(rows, DOCS), queries.tokenizer_file(), {"a": 2, "b": 1, "c": 1}, sequence=512, piece=64).collect()
    total, sent = Counter(), Counter()
    for p in pieces:
        total[p.source] += p.length
    pieces.sort(key=lambda p: (p.sequence_id, p.offset))
    dry = False
    for p in pieces:
        sent[p.source] += p.length
        dry |= sent[p.source] == total[p.source]
        if not dry:
            done = sum(sent.values())
            for s, w in (("a", 0.5), ("b", 0.25), ("c", 0.25)):
                assert abs(sent[s] - w * done) <= 512 + 64
    assert sum(sent.values()) == sum(total.values())


def test_packing_is_handed_small_batches(spark, monkeypatch):
    """Tokenizing tasks get a few megabytes of text at once, however many rows fit a batch; the setting is put back."""
    plain, most, had = packing.slices, common.BATCH_BYTES + (1 << 20), spark.conf.get(common._BATCH_SETTING)

    def watched(batches, **options):
        for b in batches:
            assert b.nbytes <= most
            yield from plain(iter([b]), **options)

    monkeypatch.setattr(packing, "slices", watched)
    rows = spark.range(0, 2000, numPartitions=1).select(F.col("id").alias("doc_id"), F.expr("repeat('word ', 2000)").alias("text"), F.lit("a").alias("source"))
    got = packing.pack(rows, queries.tokenizer_file()).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    assert got.count() == 2000 and got.where("n <> all or n < 2001").count() == 0
    assert spark.conf.get(common._BATCH_SETTING) == had


def test_language_workers_give_the_tokenizer_back(spark, monkeypatch):
    """A worker that packed before holds no vocabulary and no word ids while it identifies languages."""
    plain = language.slices

    def watched(batches, *rest, **options):
        import sys

        assert getattr(sys.modules.get("tokenizers"), "_ledgerline_parts", None) is None
        yield from plain(batches, *rest, **options)

    rows = [(k, PROSE, "en", "a", 1) for k in range(64)]
    docs = spark.createDataFrame(rows, DOCS).repartition(16)
    assert packing.pack(docs, queries.tokenizer_file()).count() > 0
    monkeypatch.setattr(language, "slices", watched)
    assert language.identify(docs, language.fit(docs)).where("lang_pred = 'en'").count() == 64


def test_packing_empty(empty):
    assert packing.pack(empty, queries.tokenizer_file()).count() == 0


def test_sequences_hold_the_pieces(docs):
    pieces = packing.pack(docs.limit(20), queries.tokenizer_file())
    assert packing.sequences(pieces).agg(F.sum(F.length("ids"))).first()[0] == 4 * pieces.agg(F.sum("length")).first()[0]


# --- 4 ----------------------------------------------------------------------------------------


def brute_repeats(rows, window):
    last = (1 << 63) - 1
    first = {}
    for r in rows:
        w = words(r.text)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, last), last if r.doc_id is None else r.doc_id)
    out = Counter()
    for r in rows:
        w = words(r.text)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (last if r.doc_id is None else r.doc_id):
                gone.update(range(i, i + window))
        kept = None if r.text is None else " ".join(x for i, x in enumerate(w) if i not in gone)
        out[(r.doc_id, kept, len(w), len(gone))] += 1
    return out


@pytest.mark.parametrize("which", ["docs", "awkward", "empty"])
@pytest.mark.parametrize("large", [repeats.LARGE_GROUP, 2])
def test_repeats(request, which, large):
    frame = request.getfixturevalue(which).withColumn("n_words", F.lit("clash"))
    got = repeats.remove_repeats(frame, large_group=large).select("doc_id", "text", "n_words", "n_removed")
    assert Counter(tuple(r) for r in got.collect()) == brute_repeats(frame.collect(), 50)


def test_repeats_of_busy_keys(docs, awkward, monkeypatch):
    monkeypatch.setattr(repeats, "HEAVY", 1)  # every shared key takes the way of those with very many rows
    for frame in (docs, awkward):
        got = repeats.remove_repeats(frame, large_group=2).select("doc_id", "text", "n_words", "n_removed")
        assert Counter(tuple(r) for r in got.collect()) == brute_repeats(frame.collect(), 50)


@pytest.mark.parametrize("split", [False, True])
def test_repeats_read_texts_once(spark, monkeypatch, split):
    """A group is split if many of its stretches move, not if texts have the same one often; small and large groups share a pass over the texts."""
    said = [f"own{i} {PASSAGE} other{i}" if split else f"{PASSAGE} " * (i + 2) for i in range(10)]
    rows = [(i, x, "en", "a", 1) for i, x in enumerate([*said, PROSE * 3, PROSE * 3 + "end"])]
    frame = spark.createDataFrame(rows, DOCS)
    stages, passes, stage, stretches = [], [], repeats.stage, repeats._stretches
    monkeypatch.setattr(repeats, "stage", lambda df, name: stages.append(name) or stage(df, name))
    monkeypatch.setattr(repeats, "_stretches", lambda *a: passes.append(a) or stretches(*a))
    got = repeats.remove_repeats(frame, large_group=7).select("doc_id", "text", "n_words", "n_removed")
    assert Counter(tuple(r) for r in got.collect()) == brute_repeats(frame.collect(), 50)
    assert (len(passes), "windows" in stages) == (1, split)


def test_window_names():
    x = np.array([5, 1, 2, 5, 1, 2, 9], np.uint64)
    for size in (1, 2, 3):
        name = repeats.name_windows(x, size)
        for i in range(len(x) - size + 1):
            for j in range(len(x) - size + 1):
                assert (name[i] == name[j]) == (tuple(x[i : i + size]) == tuple(x[j : j + size]))


# --- 5, 10 ------------------------------------------------------------------------------------


def test_quality_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op5_quality(spark, folder).join(table(spark, folder, "labels"), "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in got)
    assert len(got) > 50 and right >= 0.9 * len(got)


@pytest.mark.parametrize("which", ["awkward", "empty"])
def test_quality_on_awkward_rows(request, spark, folder, which):
    frame = request.getfixturevalue(which).withColumn("score", F.lit("clash"))
    model = classifier.fit(table(spark, folder, "documents"), table(spark, folder, "labels"))
    got = classifier.classify(frame, model).collect()
    assert len(got) == frame.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.score == 0 for r in got if r.doc_id in (4, 5, 10))
    nothing = classifier.fit(table(spark, folder, "documents"), table(spark, folder, "labels").limit(0))
    assert {r.score for r in classifier.classify(frame, nothing).collect()} <= {0.0, 0.5}


def test_language_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op10_language(spark, folder).join(table(spark, folder, "documents"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.97 * len(got)


def test_language_spans_of_mixed_text(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = language.fit(docs)
    by = {r.lang: r.text for r in docs.where("length(text) between 400 and 900 and n_chars > 0").collect()}
    mixed = by["en"] + " " + by["de"] + " " + by["fr"] + " Привет мир и все люди"
    got = language.identify(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).first()
    assert [s.lang for s in got.spans] == ["en", "de", "fr", "und"]
    for s in got.spans:
        assert mixed[s.start : s.start + s.length].strip() == mixed[s.start : s.start + s.length]


def test_paths_match_a_plain_search():
    rng = np.random.default_rng(3)
    first = np.array([0, 7, 7, 8, 20])
    scores = rng.standard_normal((20, 3)).astype(np.float32) * 3
    got = language.paths(scores, first, 2.0)
    for a, b in zip(first[:-1], first[1:]):
        value = lambda p: sum(scores[a + i, k] for i, k in enumerate(p)) - 2.0 * sum(x != y for x, y in zip(p, p[1:]))
        best = [(0.0, [])]
        for i in range(b - a):
            ends = {}
            for _, p in best:
                for k in range(3):
                    q = [*p, k]
                    if k not in ends or value(q) > ends[k][0]:
                        ends[k] = (value(q), q)
            best = list(ends.values())
        if b > a:
            assert abs(value(list(got[a:b])) - max(v for v, _ in best)) < 1e-3


@pytest.mark.parametrize("which", ["awkward", "empty"])
def test_language_on_awkward_rows(request, docs, which):
    frame = request.getfixturevalue(which).withColumn("lang_pred", F.lit(1))
    got = language.identify(frame, language.fit(docs)).collect()
    assert len(got) == frame.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (4, 5, 10, 11))
    assert all(0 <= r.score <= 1 for r in got)
    untaught = language.identify(frame, language.fit(frame.limit(0)))
    assert {r.lang_pred for r in untaught.collect()} <= {"und"}


# --- 6 ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("sites", [2, 3])
def test_lines(spark, awkward, docs, sites):
    extra = spark.createDataFrame([(100 + k, f"shared line\nown {k}\n shared line ", "en", f"s{k % 4}" if k else None, 0) for k in range(9)], DOCS)
    frame = awkward.unionByName(extra).unionByName(docs)
    rows = frame.collect()
    last = (1 << 63) - 1
    spread, first = defaultdict(set), {}
    key = {(r.doc_id, r.text): k for r, k in zip(rows, [None] * len(rows))}
    keys = {(r.doc_id, r.text): r.k for r in frame.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("k")).collect()}
    for r in rows:
        for p, x in enumerate((r.text or "").split("\n")):
            if x := x.strip(" \t\r\f\x0b"):
                spread[x].add(r.source or "")
                at = (last if r.doc_id is None else r.doc_id, keys[(r.doc_id, r.text)], p)
                first[x] = min(first.get(x, at), at)
    want = Counter()
    for r in rows:
        at = (last if r.doc_id is None else r.doc_id, keys[(r.doc_id, r.text)])
        kept, cut = [], 0
        for p, x in enumerate((r.text or "").split("\n")):
            s = x.strip(" \t\r\f\x0b")
            if s and len(spread[s]) >= sites and first[s] != (*at, p):
                cut += 1
            else:
                kept.append(x)
        want[(r.doc_id, None if r.text is None else "\n".join(kept), cut)] += 1
    got = lines.spread_dedup(frame.withColumn("n_lines", F.lit("clash")), min_sites=sites).select("doc_id", "text", "n_removed")
    assert Counter(tuple(r) for r in got.collect()) == want and len(key) > 1


def test_lines_empty(empty):
    assert lines.spread_dedup(empty).count() == 0


# --- 7 ----------------------------------------------------------------------------------------


def test_html_rules():
    prose = "The man and the dog of the town is in the house by the river. " * 6
    page = f"""<!DOCTYPE html><html><head><title>Not this</title><style>p{{}}</style></head><body>
    <header class="site-header"><h1>Site</h1><p>{prose}</p></header><div id="cookie-notice">We use <b>cookies</b> and you accept.</div>
    <nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav><div class="sidebar"><p>{prose}</p></div>
    <div class="content"><h2>A&nbsp;title &amp; more</h2><p>{prose}<p>Short   one,<br>in two lines.<p>{prose}<script>var a = "<p>no</p>";</script></div>
    <div class="ad-box">Buy it now</div><form><p>{prose}</p><input value="x"></form><section class="comments"><p>{prose}</p></section>
    <footer>&copy; 2020</footer></body>"""
    said = " ".join(prose.split())
    assert html.main_text(page) == "\n".join(["A title & more", said, "Short one, in two lines.", said])
    assert html.main_text(None) == html.main_text("") == html.main_text("<p>") == html.main_text("<script>x") == ""
    assert html.main_text("<article><p>x &lt;b&gt; | y</p><p>1 < 2 &#233;</p></article>") == "x <b> | y\n1 < 2 é"


def test_html_of_all_pages(spark, folder):
    """The article element of the given pages, with its tags taken out, is the brute-force answer."""
    import html as entities

    pages = table(spark, folder, "pages")
    got = {r.page_id: r for r in html.extract_text(pages.withColumn("text", F.lit("clash"))).collect()}
    for r in pages.collect():
        inner = re.sub("<br>", " ", r.html[r.html.index("<article>") : r.html.index("</article>")])
        parts = [" ".join(entities.unescape(re.sub("<[^>]+>", "", x)).split()) for x in re.split("</?p>|</?h1>", inner)]
        want = "\n".join(x for x in parts if x)
        assert (got[r.page_id].text, got[r.page_id].n_chars) == (want, len(want))


def test_html_awkward(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<p>" + "the and of " * 50_000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert [r.n_chars for r in html.extract_text(frame).orderBy("page_id").collect()] == [549_999, 0, 0]
    assert html.extract_text(frame.limit(0)).count() == 0


# --- 8 ----------------------------------------------------------------------------------------


def brute_components(rows):
    last = (1 << 63) - 1
    ids = [last if r.doc_id is None else r.doc_id for r in rows]
    sets = []
    for r in rows:
        w = words((r.text or "").translate(LOWER))
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    parent = {d: d for d in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for k, s in enumerate(sets):
        common = Counter(j for t in s for j in holders[t])
        for j, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(ids[k]), find(ids[j])))
                parent[b] = a
        for t in s:
            holders[t].append(k)
    return Counter((d, len(s), find(d)) for d, s in zip(ids, sets))


@pytest.fixture(scope="module")
def families(spark, awkward, docs):
    """Near copies in chains and a large family, an unrelated crowd with a common line."""
    rng = np.random.default_rng(5)
    base = [f"x{k}" for k in range(120)]
    rows = []
    for k in range(60):
        w = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 4)):
            w[at] = f"y{k}_{at}"
        rows.append((2000 + k, " ".join(w), "en", "a", 0))
    chain = [f"c{k}" for k in range(100)]
    for k in range(12):
        rows.append((3000 - k, " ".join(chain[4 * k :] + [f"d{j}" for j in range(4 * k)]), "en", "a", 0))
    rows += [(4000 + k, PASSAGE + " " + " ".join(f"z{k}_{j}" for j in range(30 + k)), "en", "a", 0) for k in range(40)]
    return awkward.unionByName(docs).unionByName(spark.createDataFrame(rows, DOCS))


@pytest.mark.parametrize("options", [{}, {"block_shingles": 400, "frequent": 5}])
def test_jaccard_components(families, options):
    got = jaccard.similar_components(families, **options).select("_id", "n_shingles", "component")
    assert Counter(tuple(r) for r in got.collect()) == brute_components(families.collect())


def test_jaccard_keeps_one(families, empty):
    want = brute_components(families.collect())
    kept = jaccard.keep_one(families).collect()
    assert len(kept) == len({c for _, n, c in want if n}) + sum(k for (_, n, _), k in want.items() if not n)
    assert jaccard.keep_one(empty).count() == 0


def test_boxes_never_lose_a_point():
    rng = np.random.default_rng(7)
    sizes = np.sort(rng.integers(5, 300, 3000))
    points = np.stack([np.bincount(rng.integers(0, jaccard.GROUPS, n), minlength=jaccard.GROUPS) for n in sizes]).astype(np.uint16)
    tree = jaccard.Boxes(points, sizes)
    for k in (0, 17, 1500, 2999):
        bound = np.minimum(points, points[k]).sum(axis=1)
        fits = (100 * sizes >= 80 * sizes[k]) & (80 * sizes <= 100 * sizes[k]) & (bound >= jaccard.needed(sizes, sizes[k]))
        assert sorted(tree.near(points[k], int(sizes[k]), np.ones(3000, bool), 80)) == np.flatnonzero(fits).tolist()


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 200)] + [(500, 400), (400, 450), (7, 7), (300, 299)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 201), 1), **dict.fromkeys((400, 450, 500), 400), 299: 299, 300: 299}


# --- 9 ----------------------------------------------------------------------------------------


def test_decontamination(spark, awkward, empty, folder):
    items = [(1, " ".join(f"Passage{k}" for k in range(20))), (2, "one, two"), (3, None), (4, "!!"), (None, "three passage5")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    said = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    grams = [(str(i) if i is not None else None, tuple(w[k : k + min(13, len(w))])) for i, t in items if (w := said(t)) for k in range(len(w) - min(13, len(w)) + 1)]
    want = Counter()
    for r in awkward.collect():
        w = said(r.text)
        hit, found = set(), set()
        for i, g in grams:
            for p in range(len(w) - len(g) + 1):
                if tuple(w[p : p + len(g)]) == g:
                    hit.update(range(p, p + len(g)))
                    found.add(i)
        want[(r.doc_id, len(w), len(hit), tuple(sorted(x for x in found if x is not None)), bool(hit) and 20 * len(hit) >= len(w))] += 1
    got = decontaminate.hits(awkward.withColumn("items", F.lit("clash")), bench).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got) == want
    clean = decontaminate.decontaminate(awkward, bench)
    assert clean.count() == sum(k for x, k in want.items() if not x[-1]) and clean.columns == awkward.columns
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(awkward, bench, action="spans").collect()}
    assert cut[7] == "" and cut[5] is None and cut[4] == "" and cut[12] == PROSE * 3
    assert decontaminate.hits(empty, bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.hits(awkward, bench.limit(0)).collect())


def test_language_of_unknown_script(docs):
    frame = docs.limit(1).select("doc_id", F.lit("Привет мир и все люди").alias("text"))
    got = language.identify(frame, language.fit(docs)).first()
    assert got.lang_pred != "und" and got.score == 0 and [s.lang for s in got.spans] == ["und"]
