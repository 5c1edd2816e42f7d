"""Quality rules by robust multivariate outliers.

Every document gets a vector of transformed text statistics. For each language and source the
minimum-covariance-determinant estimate of centre and spread is found, and documents whose
Mahalanobis distance from it is too large are rejected.

The estimate is built from sums only. A concentration step needs the covariance of the nearest
three quarters of a group; here each pass sums the moments of a group's rows by distance bin, and
the bins nearest to the centre are added up until they hold enough rows. So a group is never
collected: a source with a third of all documents costs a task what any slice of rows costs, and
what is shuffled is one row of sums per task, group and bin.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import WHITE, Words, keeps_others, mix, range_hashes, slices, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Base rule.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Rows from which a group has an estimate of its own; smaller ones share one per language, then one for all; too few of these have one of all rows.
MIN_ROWS = 100
#: Share of a group's rows that the estimate is concentrated on.
COVERAGE = 0.75
STEPS = 4
#: Share of regular documents that the cut may reject.
TAIL = 1e-5
#: Words of average text that every share is mixed with, so that short documents do not stray.
PRIOR_WORDS = 50.0
#: Spread that each statistic is granted at least; a share that never varies in a group cannot reject on a trace.
FLOORS = (0.5, 0.05, 0.06, 0.12, 0.05, 0.05)
#: The most groups whose estimates are broadcast (under 1 kB each); more are joined by a shuffle.
BROADCAST_GROUPS = 50_000
_BINS_PER_E = 12
NAMES = ("length", "word_length", "symbols", "dup_lines", "upper", "punctuation")
P = len(NAMES)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]

_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_UPPER = np.zeros(256, np.uint8)
_UPPER[65:91] = 1
_PUNCTUATION = np.zeros(256, np.uint8)
_PUNCTUATION[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "#*$%&|<>"]] = 1
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_punctuation")


# --- statistics -------------------------------------------------------------------------------


def _per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def count_texts(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of every text of a column; a null counts as empty."""
    w = Words(column)
    rows, data, offsets = len(column), w.data, w.offsets
    out = {"n_words": w.counts.astype(np.int64)}
    solid = ~WHITE[data]
    out["word_chars"] = _per_row(solid & ((data & 0xC0) != 0x80), offsets)
    out["n_symbols"] = _per_row(_SYMBOL[data], offsets)
    # Upper case: A-Z, and the upper half of the two-byte Latin range.
    upper = _UPPER[data]
    if len(data) > 1:
        upper[1:] |= ((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)).astype(np.uint8)
    out["n_upper"] = _per_row(upper, offsets)
    out["n_punctuation"] = _per_row(_PUNCTUATION[data], offsets)
    # Lines.
    feeds = np.flatnonzero(data == 10)
    begins = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
    line_row = np.searchsorted(offsets[:-1], begins, "right") - 1
    # Empty texts share their offset with the next one: give each row its own first line.
    n_feeds = _per_row(data == 10, offsets)
    per = n_feeds + 1
    line_row = np.repeat(np.arange(rows), per)
    first = np.cumsum(per) - per
    begins = np.empty(int(per.sum()), np.int64)
    is_first = np.zeros(len(begins), bool)
    is_first[first] = True
    begins[first] = offsets[:-1]
    begins[~is_first] = feeds + 1
    ends = np.empty_like(begins)
    ends[:-1] = begins[1:] - 1
    ends[first[1:] - 1] = offsets[1:-1]
    if len(ends):
        ends[-1] = offsets[-1]
    solids = np.concatenate([[0], np.cumsum(solid)])
    said = solids[ends] > solids[begins]
    codes = range_hashes(data.astype(np.uint64) + np.uint64(1), begins, ends) if len(data) else np.zeros(len(begins), np.uint64)
    key = mix(codes ^ mix(line_row.astype(np.uint64) + np.uint64(1)))[said]
    kept_row = line_row[said]
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    out["n_lines"] = np.bincount(kept_row, minlength=rows).astype(np.int64)
    out["n_dup_lines"] = np.bincount(kept_row[again], minlength=rows).astype(np.int64)
    # Words in windows of five that are found twice or more in their text.
    at, row = w.windows(5)
    covered = np.zeros(len(w.hashes) + 1, np.int64)
    if len(at):
        key = mix(range_hashes(w.hashes, at, at + 5) ^ mix(row.astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(at), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        np.add.at(covered, at[twice], 1)
        np.add.at(covered, at[twice] + 5, -1)
    out["n_repeat_words"] = _per_row(np.cumsum(covered)[:-1] > 0, w.first)
    return out


@keeps_others("text")
def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents without their text, with the counts of ``COUNTS`` (long); clashing columns are replaced."""
    given = [f for f in docs.schema.fields if f.name not in (*COUNTS, text)]
    schema = T.StructType([*given, *[T.StructField(n, T.LongType()) for n in COUNTS]])
    names = [f.name for f in given]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_said"):
            found = count_texts(b.column("_said"))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(n) for n in names], *[pa.array(found[n], pa.int64()) for n in COUNTS]], names=[*names, *COUNTS]
            )

    read = docs.select(*[F.col(f"`{n}`") for n in names], F.col(f"`{text}`").cast("string").alias("_said"))
    return read.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _vector(totals) -> list[Column]:
    """The transformed statistics; shares are mixed with the corpus-wide ones and then square-rooted."""
    words, k = F.col("n_words").cast("double"), PRIOR_WORDS
    of = lambda a, b: (totals[a] or 0) / max(totals[b] or 0, 1)
    chars, per_word = of("word_chars", "n_words"), F.col("word_chars").cast("double")

    def share(name: str, base: Column, prior: float, weight: float) -> Column:
        return F.sqrt((F.col(name) + F.lit(prior * weight)) / (base + F.lit(weight)))

    lines = F.col("n_lines").cast("double")
    return [
        F.log(words + F.lit(1.0)),
        F.log((per_word + F.lit(chars * k + 1e-9)) / (words + F.lit(k))),
        share("n_symbols", words, of("n_symbols", "n_words"), k),
        share("n_dup_lines", lines, of("n_dup_lines", "n_lines"), 5.0),
        share("n_upper", per_word, of("n_upper", "word_chars"), k * max(chars, 1.0)),
        share("n_punctuation", per_word, of("n_punctuation", "word_chars"), k * max(chars, 1.0)),
    ]


# --- estimates --------------------------------------------------------------------------------


def chi2_quantile(p: int, upper: float) -> float:
    """The point that a chi-square variable passes with probability ``upper`` (Wilson and Hilferty)."""
    z = -NormalDist().inv_cdf(upper)
    return p * (1 - 2 / (9 * p) + z * math.sqrt(2 / (9 * p))) ** 3


def chi2_below(p: int, x: float) -> float:
    """Probability of a chi-square variable below x, by the series of the incomplete gamma function."""
    a, half = p / 2, x / 2
    term = total = 1 / a
    for n in range(1, 500):
        term *= half / (a + n)
        total += term
    return total * math.exp(-half + a * math.log(half) - math.lgamma(a))


_PARAMS = (
    "g_lang string, g_source string, start int, rows long, det double, "
    + ", ".join(f"m{i} double" for i in range(P))
    + ", "
    + ", ".join(f"q{i}{j} double" for i, j in PAIRS)
)


def _params_row(lang, source, start, rows, mean, cov, factor=1.0) -> dict:
    cov = np.asarray(cov) * factor + np.diag(np.square(FLOORS))
    inverse = np.linalg.inv(cov)
    out = {"g_lang": lang, "g_source": source, "start": start, "rows": int(rows), "det": float(np.linalg.slogdet(cov)[1])}
    out |= {f"m{i}": float(mean[i]) for i in range(P)}
    return out | {f"q{i}{j}": float(inverse[i, j]) for i, j in PAIRS}


def _square(of, pairs=PAIRS) -> np.ndarray:
    out = np.zeros((P, P))
    for i, j in pairs:
        out[i, j] = out[j, i] = of(i, j)
    return out


def _distance() -> Column:
    """Squared Mahalanobis distance from the columns x, m and q."""
    total = F.lit(0.0)
    for i, j in PAIRS:
        term = (F.col(f"x{i}") - F.col(f"m{i}")) * (F.col(f"x{j}") - F.col(f"m{j}")) * F.col(f"q{i}{j}")
        total = total + (term if i == j else 2 * term)
    return F.greatest(total, F.lit(0.0))


def _moments(prefix: str = "x", name: str = "s") -> list[Column]:
    return [
        F.count(F.lit(1)).alias(f"{name}_n"),
        *[F.sum(f"{prefix}{i}").alias(f"{name}{i}") for i in range(P)],
        *[F.sum(F.col(f"{prefix}{i}") * F.col(f"{prefix}{j}")).alias(f"{name}{i}{j}") for i, j in PAIRS],
    ]


def _mean_cov(r, name: str = "s") -> tuple[np.ndarray, np.ndarray]:
    n = max(float(r[f"{name}_n"]), 1.0)
    mean = np.array([float(r[f"{name}{i}"]) for i in range(P)]) / n
    return mean, _square(lambda i, j: float(r[f"{name}{i}{j}"]) / n - mean[i] * mean[j])


def _sized(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_GROUPS else df


def _starts(vectors: DataFrame) -> DataFrame:
    """Three first estimates per group: medians with their deviations, all rows, and correlations of squashed values."""
    keys = ["g_lang", "g_source"]
    medians = vectors.groupBy(*keys).agg(*[F.percentile_approx(f"x{i}", 0.5, 1000).alias(f"c{i}") for i in range(P)])
    medians = stage(medians, "medians")
    near = vectors.join(_sized(medians), keys)
    spread = near.groupBy(*keys).agg(
        *[F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"c{i}")), 0.5, 1000).alias(f"d{i}") for i in range(P)]
    )
    centres = stage(medians.join(spread, keys), "centres")
    rows = vectors.join(_sized(centres), keys)
    rows = rows.withColumns(
        {f"t{i}": F.tanh((F.col(f"x{i}") - F.col(f"c{i}")) / (1.4826 * F.col(f"d{i}") + F.lit(FLOORS[i]))) for i in range(P)}
    )
    first = [F.first(f"{a}{i}").alias(f"{a}{i}") for a in "cd" for i in range(P)]
    sums = rows.groupBy(*keys).agg(*first, *_moments("x", "s"), *_moments("t", "u"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.to_dict("records"):
                who = (r["g_lang"], r["g_source"])
                centre = np.array([r[f"c{i}"] for i in range(P)])
                scale = 1.4826 * np.array([r[f"d{i}"] for i in range(P)]) + np.array(FLOORS)
                mean, cov = _mean_cov(r, "s")
                _, squashed = _mean_cov(r, "u")
                unit = np.sqrt(np.maximum(np.diag(squashed), 1e-12))
                out.append(_params_row(*who, 0, r["s_n"], centre, np.diag(scale**2)))
                out.append(_params_row(*who, 1, r["s_n"], mean, cov))
                out.append(_params_row(*who, 2, r["s_n"], centre, squashed / np.outer(unit, unit) * np.outer(scale, scale)))
            if out:
                yield pd.DataFrame(out)

    return stage(sums.mapInPandas(run, _PARAMS), "starts")


def _concentrate(vectors: DataFrame, params: DataFrame, coverage: float, limit: float | None) -> DataFrame:
    """New estimates from the rows nearest to the old ones.

    Without a limit the nearest ``coverage`` of a group's rows are taken, to the edge of a distance
    bin; with one, all rows up to that squared distance.
    """
    keys = ["g_lang", "g_source", "start"]
    rows = vectors.join(_sized(params), ["g_lang", "g_source"]).withColumn("d2", _distance())
    if limit is not None:
        rows = rows.where(F.col("d2") <= limit)
    rows = rows.withColumn("bin", F.floor(F.log(F.col("d2") + F.lit(1e-6)) * _BINS_PER_E).cast("int"))
    sums = rows.groupBy(*keys, "bin").agg(*_moments(), F.first("rows").alias("rows"))
    used = chi2_below(P + 2, chi2_quantile(P, 1 - coverage)) if limit is None else chi2_below(P + 2, limit)
    factor = (coverage if limit is None else chi2_below(P, limit)) / used

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("bin")
        if limit is None:
            done = frame["s_n"].cumsum()
            frame = frame[(done - frame["s_n"]) < coverage * frame["rows"].iloc[0]]
        total = frame.drop(columns=["g_lang", "g_source", "start", "bin"]).sum()
        mean, cov = _mean_cov(total)
        return pd.DataFrame([_params_row(*key, int(frame["rows"].iloc[0]), mean, cov, factor)])

    return stage(sums.groupBy(*keys).applyInPandas(run, _PARAMS), "estimates")


def _groups(stats: DataFrame, lang: str, source: str, min_rows: int) -> DataFrame:
    """The group of each (language, source): its own, its language's small sources together, or all small ones."""
    sizes = stats.groupBy(F.col(lang).alias("l"), F.col(source).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    sizes = stage(sizes, "groups")
    small = sizes.where(F.col("n") < min_rows)
    per_lang = small.groupBy("l").agg(F.sum("n").alias("pooled"))
    joined = sizes.join(_sized(per_lang), sizes["l"].eqNullSafe(per_lang["l"]), "left").select(sizes["*"], "pooled")
    own, pooled = F.col("n") >= min_rows, F.col("pooled") >= min_rows
    name = lambda c, tag: F.coalesce(F.concat(F.lit(tag), F.col(c)), F.lit("none"))
    return joined.select(
        "l",
        "s",
        F.when(own | pooled, name("l", "=")).otherwise("all").alias("g_lang"),
        F.when(own, name("s", "=")).otherwise("pooled").alias("g_source"),
        "n",
    )


@keeps_others("lang", "source", fixed=COUNTS)
def judge(stats: DataFrame, lang: str = "lang", source: str = "source", min_rows: int = MIN_ROWS, tail: float = TAIL) -> DataFrame:
    """The rows of ``statistics`` with ``distance2``, ``base_failed`` and ``kept``.

    The base rule fails a document of under ten words, or with more than a fifth of its words in
    repeated five-word windows. The others are kept unless the squared distance from their group's
    estimate passes the chi-square point of ``tail``. A null language or source is one of its own.
    Groups under ``min_rows`` are pooled by language, then altogether; a pool that is still smaller is
    judged by an estimate over all rows. Only a table under ``min_rows`` rejects nothing (``distance2`` is null). Identical rows get identical verdicts; an empty table
    gives an empty one.
    """
    spark = stats.sparkSession
    stats = stage(stats, "statistics")
    totals = stats.agg(*[F.sum(c).alias(c) for c in COUNTS]).first()
    groups = stage(_groups(stats, f"`{lang}`", f"`{source}`", min_rows), "group_names")
    rest = groups.where("g_lang = 'all'").agg(F.sum("n")).first()[0] or 0
    side = _sized(groups.drop("n"))
    named = stats.join(side, stats[f"`{lang}`"].eqNullSafe(side["l"]) & stats[f"`{source}`"].eqNullSafe(side["s"]), "left").drop("l", "s")
    named = named.withColumns({f"x{i}": c for i, c in enumerate(_vector(totals))})
    vectors = stage(named.select("g_lang", "g_source", *[f"x{i}" for i in range(P)]), "vectors")
    if 0 < rest < min_rows:  # too few for an estimate of their own: all rows stand for them
        every = vectors.withColumns({"g_lang": F.lit("all"), "g_source": F.lit("pooled")})
        vectors = vectors.where("g_lang <> 'all'").unionByName(every)
    params = _starts(vectors)
    for _ in range(STEPS):
        params = _concentrate(vectors, params, COVERAGE, None)
    best = params.groupBy("g_lang", "g_source").agg(F.min_by(F.struct(*params.columns), F.struct("det", "start")).alias("b")).select("b.*")
    best = _concentrate(vectors, stage(best, "best"), COVERAGE, chi2_quantile(P, 0.025))
    judged = named.join(_sized(best.where(F.col("rows") >= min_rows)), ["g_lang", "g_source"], "left")
    judged = judged.withColumn("distance2", F.when(F.col("m0").isNotNull(), _distance()))
    far = F.coalesce(F.col("distance2") > chi2_quantile(P, tail), F.lit(False))
    return judged.select(
        *[F.col(f"`{c}`") for c in stats.columns],
        *[F.col(f"x{i}").alias(f"x_{n}") for i, n in enumerate(NAMES)],
        "distance2",
        base_failed().alias("base_failed"),
        (~base_failed() & ~far).alias("kept"),
    )
