"""Whole-number clustering, whitening and pattern packing against plain versions."""

import hashlib
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import bestfit, centroids, queries, tokens, whitening
from ledgerline.llm.common import table

VECTORS = "vec_id long, embedding array<double>, label int"


def vector(k, size=64):
    return [float(x) for x in np.random.default_rng(k).normal(0, 0.2, size).round(3)]


@pytest.fixture(scope="module")
def awkward(spark):
    """Null ids, vectors and entries, other lengths, repeated rows and ids, far and equal vectors."""
    rows = [(k, vector(k), k) for k in range(60)]
    rows += [(3, vector(3), 3)] * 40 + [(3, vector(99), 0), (None, vector(100), None), (200, None, 1), (201, [], 1), (202, vector(5)[:63], 1)]
    rows += [(203, [*vector(6), 1.0], 1), (204, [None, *vector(7)[1:]], 1), (205, [float("nan"), *vector(8)[1:]], 1)]
    rows += [(206, [float("inf"), *vector(9)[1:]], 1), (207, [-900.0, *vector(9)[1:]], 1), (208, [0.0] * 64, 1), (209, [0.0] * 64, 1)]
    return spark.createDataFrame(rows, VECTORS).withColumns({"id": F.lit("clash"), "x": F.lit(1), "cluster": F.lit(2), "whitened": F.lit(0)})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], VECTORS)


# --- 12 ---------------------------------------------------------------------------------------


def plain_clusters(rows, clusters=8, rounds=10):
    kept = [(r.vec_id, [int(np.floor(1024 * x)) for x in r.embedding]) for r in rows if r.embedding and len(r.embedding) == 64 and all(x is not None and np.isfinite(x) for x in r.embedding)]
    name = lambda v: "~" if v is None else hashlib.sha256(f"3:{v}".encode()).hexdigest()
    centers = [x for _, x in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:clusters]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(centers))
    for _ in range(rounds):
        members = defaultdict(list)
        for _, x in kept:
            members[near(x)[1]].append(x)
        for k, xs in members.items():
            centers[k] = [sum(col) // len(xs) for col in zip(*xs)]
    found = [(v, *near(x)) for v, x in kept]
    per = Counter()
    for _, d, k in found:
        per[k] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return Counter((v, k, d, per[k], sum(per.values()), digest[k]) for v, d, k in found)


def digests(found):
    text = lambda r: hashlib.sha256(",".join(map(str, r.centroid)).encode()).hexdigest()
    return Counter((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, text(r)) for r in found.collect())


@pytest.mark.parametrize("chunk", [16_384, 7])
def test_clusters_on_awkward_rows(awkward, chunk):
    assert digests(centroids.cluster(awkward, chunk=chunk)) == plain_clusters(awkward.collect())


def test_clusters_of_all_embeddings(spark, folder):
    rows = table(spark, folder, "embeddings")
    assert digests(centroids.cluster(rows)) == plain_clusters(rows.collect())


def test_clusters_of_few_and_no_vectors(spark, empty):
    assert centroids.cluster(empty).count() == 0
    few = spark.createDataFrame([(1, vector(1), 0), (2, vector(2), 0), (2, vector(2), 0)], VECTORS)
    assert digests(centroids.cluster(few)) == plain_clusters(few.collect())
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(spark.createDataFrame([(1, [1e9] * 64, 0)], VECTORS)).collect()


def test_dictionaries_are_lossless():
    rng = np.random.default_rng(0)
    for x in (rng.integers(-300, 300, (500, 64)), np.repeat(rng.integers(-9, 9, (3, 64)), 200, axis=0), rng.integers(0, 2, (1, 64))):
        widths, words, codes = centroids._encode(x)
        assert (np.hstack([w[c] for w, c in zip(words, codes)]) == x).all() and sum(widths) == 64
        assert all(len(np.unique(w, axis=0)) == len(w) for w in words)
    assert len(centroids._encode(np.repeat(rng.integers(-9, 9, (3, 64)), 200, axis=0))[0]) == 1  # copies end in one block


# --- 13 ---------------------------------------------------------------------------------------


def check_whitening(found, rows, width):
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in r.embedding] for r in rows if r.embedding and len(r.embedding) == width and all(c is not None and np.isfinite(c) for c in r.embedding)]
    n, s = len(x), [sum(col) for col in zip(*x)]
    v = np.array([[float(Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n**3)) for j in range(width)] for i in range(width)])
    values = np.linalg.eigvalsh(v)[::-1]
    many = min(32, width)
    assert found.count() == n * many
    got = defaultdict(list)
    for r in found.collect():
        assert r.n == n and abs(r.explained - values[r.component - 1] / np.trace(v)) <= 1e-9 and r.identity_error < 1e-6
        got[r.vec_id, int(r.deviation)].append((r.component, r.whitened))
    ids = [r.vec_id for r in rows if r.embedding and len(r.embedding) == width and all(c is not None and np.isfinite(c) for c in r.embedding)]
    want = Counter((i, sum((n * a - b) ** 2 for a, b in zip(r, s))) for i, r in zip(ids, x))
    assert Counter({k: len(c) // many for k, c in got.items()}) == want
    w = np.array([[w for _, w in sorted(c)] for k, c in got.items() for _ in range(1) if len(c) == many])
    assert w.shape[1] == many
    # Distances in the whitened space do not depend on signs or bases of equal eigenvalues.
    first = {k: np.array([w for _, w in sorted(set(c))]) for k, c in got.items()}
    y = np.array([[float(a - Fraction(b, n)) for a, b in zip(r, s)] for r in x])
    axes = np.linalg.eigh(v)[1][:, ::-1][:, :many] / np.sqrt(values[:many])
    plain = {(i, sum((n * a - b) ** 2 for a, b in zip(r, s))): p for i, r, p in zip(ids, x, y @ axes)}
    for k in first:
        assert np.isclose(np.linalg.norm(first[k]), np.linalg.norm(plain[k]), rtol=1e-6, atol=1e-6)
        assert np.allclose(np.abs(first[k][:3]), np.abs(plain[k][:3]), rtol=1e-5, atol=1e-5)


def test_whitening_of_all_embeddings(spark, folder):
    rows = table(spark, folder, "embeddings").limit(80)
    check_whitening(whitening.whiten(rows), rows.collect(), 64)


def test_whitening_on_awkward_rows(spark, awkward):
    rows = spark.createDataFrame([(k, vector(k, 5), 0) for k in range(50)] + [(7, vector(7, 5), 0)] * 20 + [(60, vector(1, 4), 0), (None, vector(3, 5), 1)], VECTORS)
    rows = rows.unionByName(awkward.where("vec_id between 200 and 206").select("vec_id", "embedding", "label"))
    check_whitening(whitening.whiten(rows), rows.collect(), 5)
    got = whitening.whiten(awkward)
    assert got.select("vec_id", "component").count() == 32 * awkward.where(centroids.usable(F.col("embedding"))).count()


def test_whitening_without_spread(spark, empty):
    assert whitening.whiten(empty).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0)], VECTORS)).collect()
    assert [(r.component, r.n, int(r.deviation), r.whitened, r.explained) for r in one] == [(1, 1, 0, None, None), (2, 1, 0, None, None)]
    flat = whitening.whiten(spark.createDataFrame([(k, [float(k), 5.0], 0) for k in range(6)], VECTORS)).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in flat) and abs(flat[0].identity_error) < 1e-9


# --- 11 ---------------------------------------------------------------------------------------


def check_packing(pieces, docs, sequence):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    want = Counter()
    total = 0
    for r in docs:
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        total += len(ids)
        want.update((r.doc_id, k, at, len(ids[at : at + sequence]), zlib.crc32(ids[at : at + sequence].tobytes())) for k, at in enumerate(range(0, len(ids), sequence)))
    assert Counter((p.doc_id, p.piece, p.start, p.length, zlib.crc32(p.ids)) for p in pieces) == want
    by = defaultdict(list)
    for p in pieces:
        by[p.sequence_id].append((p.offset, p.length))
    for s in by.values():
        s.sort()
        assert [at for at, _ in s] == list(np.cumsum([0, *[n for _, n in s]])[:-1]) and sum(n for _, n in s) <= sequence
    return len(by), -(-total // sequence)


@pytest.mark.parametrize("sequence", [4096, 512, 100])
def test_pattern_packing(spark, folder, sequence):
    docs = table(spark, folder, "documents")
    used, least = check_packing(bestfit.pack(docs, queries.tokenizer_file(), sequence).collect(), docs.collect(), sequence)
    assert used <= 1.02 * least + 1


def test_pattern_packing_of_awkward_rows(spark):
    rows = [(1, None), (2, ""), (None, "one two"), (3, "é " * 3000), (3, "é " * 3000), (4, "a" * 5000), (5, "x\ty\n\nz. <|endoftext|> 'll"), (6, " "), (7, "word " * 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"length": F.lit("clash"), "task": F.lit(0), "rank": F.lit(0), "ids": F.lit("")})
    check_packing(bestfit.pack(docs, queries.tokenizer_file()).collect(), docs.collect(), 4096)
    assert bestfit.pack(docs.limit(0), queries.tokenizer_file()).count() == 0


def test_numbers_carried_over_groups_of_tasks(spark, folder):
    docs = table(spark, folder, "documents").repartition(7)
    counts = bestfit.tokenize(docs, queries.tokenizer_file()).groupBy("task", "length").agg(F.count("*").alias("n"))
    rows = sorted((r["length"], r["task"], r["n"]) for r in counts.collect())
    seen = Counter()
    want = {}
    for length, task, n in rows:
        want[task, length] = seen[length]
        seen[length] += n
    frame = spark.createDataFrame([(t, n, k) for n, t, k in rows], "task int, length int, n long")
    for together in (2, 1024):
        assert {(r.task, r.length): r.before for r in bestfit._carried(frame, together).collect()} == want


def test_plans_waste_little():
    rng = np.random.default_rng(0)
    for lengths in (rng.integers(1, 4097, 50_000), rng.geometric(1 / 700, 50_000).clip(1, 4096), np.full(1000, 2048), np.full(999, 1366), rng.integers(2049, 4097, 1000)):
        histogram = np.bincount(lengths, minlength=4097)
        plan = bestfit.plan(histogram)
        rank = np.concatenate([np.arange(n) for n in histogram])
        number, offset = plan.place(np.repeat(np.arange(4097), histogram), rank)
        sizes = np.repeat(np.arange(4097), histogram)
        order = np.lexsort((offset, number))
        ends = offset[order] + sizes[order]
        same = number[order][1:] == number[order][:-1]
        assert (offset[order][1:][same] == ends[:-1][same]).all() and (offset[order][1:][~same] == 0).all() and ends.max() <= 4096
        assert number.max() + 1 == plan.sequences == len(np.unique(number))
        least = max(-(-lengths.sum() // 4096), (lengths > 2048).sum(), -(-len(lengths) // (4096 // lengths.min())))
        assert plan.sequences <= 1.01 * least + 1


def test_least_squares_matches_a_plain_search():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.normal(size=(6, 3)), rng.normal(size=6)
        best = min(
            (np.sum((a[:, s] @ x - b) ** 2) if s else np.sum(b**2))
            for k in range(8) if (s := [i for i in range(3) if k >> i & 1]) is not None
            for x in [np.linalg.lstsq(a[:, s], b, rcond=None)[0] if s else np.zeros(0)] if (x >= 0).all()
        )
        x = bestfit.nonnegative_least_squares(a, b)
        assert (x >= 0).all() and abs(np.sum((a @ x - b) ** 2) - best) < 1e-9
    patterns = bestfit.length_patterns(7, 3)
    assert len(patterns) == 7 and (patterns @ np.arange(1, 8) == 7).all()


# --- token ids --------------------------------------------------------------------------------


def test_token_ids_match_the_tokenizer(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = queries.tokenizer_file()
    tokenizer, spec = Tokenizer.from_file(path), open(path, encoding="utf-8").read()
    texts = ["", None, "  ", "a b\n\nc", "Don't stop. it's!? ...", "İstanbul ÉCOLE, straße; Ǆ naïve", "ª º µ ſ ŉ 'll x<|endoftext|>. y", "<|startoftext|>", "tab\tsep á é.",
             "日本語 text. 12 3a4 a1.", "x.,;:!?|$#*%& |||", "é|è \x0b \r\n end", "ΣΑΣ. Σ", "A" * 100 + "...", "it's. a's 's 't",
             "".join(map(chr, range(33, 0x250))), " ".join(chr(c) + "x." for c in range(33, 0x250)), " ".join("X" + chr(c) + ";" for c in range(33, 0x250)), "word.. ́x. x ́"]
    for limit in (1 << 23, 5):
        monkeypatch.setattr(tokens, "LONG_TEXT", limit)
        ids, offsets = tokens.encode(pa.array(texts, pa.string()), spec)
        for i, text in enumerate(texts):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
