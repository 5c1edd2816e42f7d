"""Language identification by spans: script ranges, per-word scores, and a Viterbi path over the words.

A word's script leaves only the languages that use it; byte n-grams score the word for each of
them; a path with a penalty for each change of language labels the words of a text, so a text of
several languages falls into spans. The model is a table of fixed size (languages times n-gram
buckets), summed over a bounded sample of labelled documents; the labelling is one pass over the
texts without a shuffle.
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

from ledgerline.llm import tokens
from ledgerline.llm.common import held_out, keeps_others, mix, ranges, slices, small_batches, text_bytes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The most labelled documents, about, that the model is fitted on (picked by a hash of the id).
SAMPLE = 20_000
ORDERS = (2, 3, 4)
BUCKETS = 1 << 16
#: What a change of language costs, in nats.
SWITCH = 10.0
#: A script that makes up less of a language's words does not make the language a candidate.
LEAST_SHARE = 0.001
_NEVER = -40.0
UND = "und"
#: Words whose scores are held before their paths are searched together.
PATH_WORDS = 750_000

# Code point ranges of scripts.
SCRIPTS = [
    ("Latin", 0x41, 0x24F), ("Greek", 0x370, 0x3FF), ("Cyrillic", 0x400, 0x52F), ("Armenian", 0x530, 0x58F),
    ("Hebrew", 0x590, 0x5FF), ("Arabic", 0x600, 0x77F), ("Devanagari", 0x900, 0x97F), ("Bengali", 0x980, 0x9FF),
    ("Tamil", 0xB80, 0xBFF), ("Thai", 0xE00, 0xE7F), ("Georgian", 0x10A0, 0x10FF), ("Latin", 0x1E00, 0x1EFF),
    ("Greek", 0x1F00, 0x1FFF), ("Kana", 0x3040, 0x30FF), ("Han", 0x3400, 0x9FFF), ("Hangul", 0xAC00, 0xD7AF),
]
_NAMES = list(dict.fromkeys(n for n, _, _ in SCRIPTS))


def _script_table() -> np.ndarray:
    """Script number by a character's first two UTF-8 bytes; 0 is none of the known."""
    table = np.zeros(1 << 16, np.uint8)
    for name, low, high in SCRIPTS:
        for c in range(low, high + 1, 1 if low < 0x800 else 64):
            raw = chr(c).encode("utf-8", "surrogatepass")
            if len(raw) == 1:
                table[raw[0] << 8 : (raw[0] + 1) << 8] = _NAMES.index(name) + 1
            else:
                table[(raw[0] << 8) | raw[1]] = _NAMES.index(name) + 1
    return table


_SCRIPT = _script_table()
_LETTER = np.zeros(256, bool)  # bytes that words are made of: ASCII letters and all beyond ASCII
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


class _Letters:
    """The words of a batch: runs of letters, lower-cased in the Latin ranges of one and two bytes."""

    def __init__(self, column: pa.Array):
        raw, self.offsets = text_bytes(column)
        data = raw.copy()
        data[(data >= 65) & (data <= 90)] += 32
        if len(data) > 1:
            second = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
            data[second] += 32
        n = len(data)
        inside = np.zeros(n + 2, bool)
        inside[1 : n + 1] = _LETTER[data]
        edge = np.zeros(n + 2, bool)
        edge[self.offsets + 1] = True
        self.starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge[1:]))
        self.ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge[1:]))
        self.first = np.searchsorted(self.starts, self.offsets)
        self.data = data
        # Code points before each byte, to give spans in characters.
        self.points = np.concatenate([np.zeros(1, np.int32), np.cumsum((raw & 0xC0) != 0x80, dtype=np.int32)])

    def scripts(self) -> np.ndarray:
        lead = self.data[self.starts].astype(np.int64)
        following = self.data[np.minimum(self.starts + 1, len(self.data) - 1)] if len(self.data) else lead
        return _SCRIPT[(lead << 8) | following]

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """(an index of each distinct word, for each word the place of its like)."""
        length = self.ends - self.starts
        buffer = self.data[ranges(self.starts, length)].astype(np.uint64)
        at = np.cumsum(length) - length
        place = np.arange(len(buffer)) - np.repeat(at, length)
        spread = mix(buffer + (place.astype(np.uint64) << np.uint64(8)))
        code = np.add.reduceat(spread, at) if len(at) else np.zeros(0, np.uint64)
        _, first, like = np.unique(code, return_index=True, return_inverse=True)
        return first, like


def _grams(letters: _Letters, which: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each order: buckets of the n-grams of the given words, blanks around them, and the word of each n-gram."""
    length = letters.ends[which] - letters.starts[which] + 2
    at = np.cumsum(length) - length
    text = np.full(int(length.sum()), 32, np.uint8)
    text[ranges(at + 1, length - 2)] = letters.data[ranges(letters.starts[which], length - 2)]
    wide = text.astype(np.uint64)
    for order in ORDERS:
        per = np.maximum(length - order + 1, 0)
        begin = ranges(at, per)
        code = np.full(len(begin), order, np.uint64)
        for k in range(order):
            code = (code << np.uint64(8)) | wide[begin + k]
        yield order, (mix(code) % np.uint64(BUCKETS)).astype(np.int64), np.repeat(np.arange(len(which)), per)


@dataclass
class Model:
    """``langs`` and, last, ``und``; ``scores`` by order, bucket and language; ``allowed`` by script and language."""

    langs: list[str]
    scores: np.ndarray
    allowed: np.ndarray


def fit(docs: DataFrame, sample: int = SAMPLE, doc: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model from the labelled documents that are not held out, about ``sample`` of them at most.

    Counts are summed by language and bucket in Spark; what reaches the driver is at most
    languages * (orders * 65,536 + scripts) rows, whatever the number of documents.
    """
    ident = F.col(f"`{doc}`")
    known = docs.where(F.col(f"`{text}`").isNotNull() & F.col(f"`{lang}`").isNotNull() & ~held_out(f"`{doc}`"))
    total = known.count()
    if total > sample:
        known = known.where(F.pmod(F.xxhash64(ident), F.lit(1 << 20)) < int((1 << 20) * sample / total) + 1)
    read = known.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        sums: dict[tuple[str, int], np.ndarray] = {}
        for b in slices(batches):
            letters = _Letters(b.column("text"))
            owner = np.repeat(np.arange(b.num_rows), np.diff(letters.first))
            names = np.array(b.column("lang").to_pylist(), object)
            for name in set(names):
                which = np.flatnonzero((names == name)[owner])
                for order, bucket, _ in _grams(letters, which):
                    got = sums.setdefault((name, order), np.zeros(BUCKETS, np.int64))
                    got += np.bincount(bucket, minlength=BUCKETS)
                got = sums.setdefault((name, 0), np.zeros(len(_NAMES) + 1, np.int64))
                got += np.bincount(letters.scripts()[which], minlength=len(_NAMES) + 1)
        for (name, order), got in sums.items():
            at = np.flatnonzero(got)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(np.full(len(at), order), pa.int32()), pa.array(at, pa.int32()), pa.array(got[at], pa.int64())],
                names=["lang", "ord", "bucket", "n"],
            )

    rows = read.mapInArrow(count, "lang string, ord int, bucket int, n long")
    with small_batches(docs.sparkSession):
        rows = rows.groupBy("lang", "ord", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(rows["lang"].unique())
    scores = np.zeros((len(ORDERS), BUCKETS, len(langs) + 1), np.float32)
    allowed = np.zeros((len(_NAMES) + 1, len(langs) + 1), bool)
    for (name, order), part in rows.groupby(["lang", "ord"]):
        k = langs.index(name)
        full = np.zeros(len(_NAMES) + 1 if order == 0 else BUCKETS)
        full[part["bucket"]] = part["n"]
        if order == 0:
            allowed[:, k] = full >= max(LEAST_SHARE * full.sum(), 1)
        else:
            scores[ORDERS.index(order), :, k] = np.log((full + 0.5) / (full.sum() + 0.5 * BUCKETS))
    allowed[:, len(langs)] = ~allowed[:, : len(langs)].any(axis=1)
    return Model([*langs, UND], scores, allowed)


def word_scores(letters: _Letters, model: Model) -> np.ndarray:
    """Log scores of every word by language, averaged over the orders; others than the script's are ruled out."""
    n, width = len(letters.starts), len(model.langs)
    if not n:
        return np.zeros((0, width), np.float32)
    which, like = letters.distinct()
    out = np.zeros((len(which), width), np.float32)
    for k, (_, bucket, word) in enumerate(_grams(letters, which)):
        if len(bucket):
            begins = np.flatnonzero(np.diff(word, prepend=-1))
            out[word[begins]] += np.add.reduceat(model.scores[k][bucket], begins, axis=0)
    out /= len(ORDERS)
    out -= out[:, :-1].max(axis=1, keepdims=True) if width > 1 else 0
    out[:, -1] = 0
    return np.where(model.allowed[letters.scripts()[which]], np.maximum(out, _NEVER), np.float32(_NEVER))[like]


def paths(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of every word, for texts ``first[i]:first[i + 1]``, all texts a step at a time."""
    n, width = scores.shape
    label = np.zeros(n, np.int16)
    if not n:
        return label
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    length, begin = length[order], first[:-1][order]
    active = np.searchsorted(-length, -np.arange(length[0]), "left")  # texts longer than t
    stay = np.zeros((n, width), bool)
    best = np.zeros(n, np.int16)  # where a change at this word comes from
    value = scores[begin[: active[0]]].copy()
    for t in range(1, length[0]):
        a = active[t]
        value = value[:a]
        at = begin[:a] + t
        source = value.argmax(axis=1)
        top = value[np.arange(a), source]
        value = value - top[:, None]
        kept = value >= -switch
        stay[at], best[at] = kept, source
        value = np.where(kept, value, np.float32(-switch)) + scores[at]
        if a < active[t - 1]:
            pass
        label[at] = value.argmax(axis=1)  # right for the last word of each text, replaced for the others below
    label[begin[: active[0]][length[: active[0]] == 1]] = scores[begin[: active[0]][length[: active[0]] == 1]].argmax(axis=1)
    for t in range(length[0] - 1, 0, -1):
        at = begin[: active[t]] + t
        now = label[at]
        label[at - 1] = np.where(stay[at, now], now, best[at])
    return label


@keeps_others("text")
def identify(docs: DataFrame, model: Model, switch: float = SWITCH, text: str = "text", spans: bool = True) -> DataFrame:
    """The documents with ``lang_pred``, ``score`` and, if wanted, ``spans``.

    ``spans`` array<struct<lang, start, length>>: runs of words of one language, in code points.
    ``lang_pred`` is the learned language with the most characters in its spans, the earlier in the
    alphabet on a tie; ``score`` its share, 0 to 1. A word in a script that no learned language uses
    is in an ``und`` span, so a text of such words alone has score 0. A text that is null or has no
    letter is ``und`` with score 0; so is every text if there was nothing to learn from. Repeated rows give equal rows, an empty table none;
    columns that clash with the result's are replaced.
    """
    new = ["lang_pred", "score", *(["spans"] if spans else [])]
    given = [f for f in docs.schema.fields if f.name not in new]
    span_type = T.ArrayType(
        T.StructType([T.StructField("lang", T.StringType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])
    )
    kinds = {"lang_pred": T.StringType(), "score": T.DoubleType(), "spans": span_type}
    schema = T.StructType([*given, *[T.StructField(n, kinds[n]) for n in new]])
    names = [f.name for f in given]
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # arrays: executors need no copy of the class
    # A string column that is passed on anyway is read from there, not sent twice.
    source = text if text in names and docs.schema[text].dataType == T.StringType() else "_said"

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        offsets = np.cumsum([0, *[len(s) for _, _, s in held]])
        first = np.concatenate([x.first[:-1] + o for (_, x, _), o in zip(held, offsets)] + [offsets[-1:]])
        label = paths(np.concatenate([s for _, _, s in held]), first, switch)
        for (b, letters, s), o in zip(held, offsets):
            yield result(b, letters, label[o : o + len(s)], model)

    def result(b: pa.RecordBatch, x: _Letters, label: np.ndarray, model: Model) -> pa.RecordBatch:
        rows, width = b.num_rows, len(model.langs)
        owner = np.repeat(np.arange(rows), np.diff(x.first))
        chars = x.points[x.ends] - x.points[x.starts]
        share = np.bincount(owner * width + label, weights=chars, minlength=rows * width).reshape(rows, width)
        # A text with letters gets a learned language, even if none of its words is in one: then with score 0.
        top, total = share[:, : max(width - 1, 1)].argmax(axis=1), share.sum(axis=1)
        # Words may be of signs beyond ASCII alone: only for texts without an ASCII letter a closer look is due.
        ascii_letter = np.zeros(rows, bool)
        ascii_letter[owner[(x.data[x.starts] < 128)]] = True
        said = b.column(source)
        letter = [bool(a) or any(c.isalpha() for c in (said[k].as_py() or "")) for k, a in enumerate(ascii_letter)]
        good = (total > 0) & np.array(letter, bool)
        pred = [model.langs[k] if g else UND for k, g in zip(top, good)]
        score = np.where(good & (np.array(pred, object) != UND), share[np.arange(rows), top] / np.maximum(total, 1), 0.0)
        out = [*[b.column(n) for n in names], pa.array(pred, pa.string()), pa.array(score, pa.float64())]
        if spans:
            new_run = np.ones(len(label), bool)
            new_run[1:] = (label[1:] != label[:-1]) | (owner[1:] != owner[:-1])
            begins = np.flatnonzero(new_run)
            last = np.append(begins[1:], len(label)) - 1 if len(begins) else begins
            text_start = x.points[x.offsets[:-1]][owner[begins]]
            start = x.points[x.starts[begins]] - text_start
            runs = pa.StructArray.from_arrays(
                [pa.array(np.array(model.langs, object)[label[begins]], pa.string()), pa.array(start, pa.int64()), pa.array(x.points[x.ends[last]] - text_start - start, pa.int64())],
                names=["lang", "start", "length"],
            )
            out.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(owner[begins], np.arange(rows + 1)), pa.int32()), runs))
        return pa.RecordBatch.from_arrays(out, names=[*names, *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        held, words = [], 0
        for b in slices(batches, source):
            letters = _Letters(b.column(source))
            held.append((b, letters, word_scores(letters, Model(**shared.value))))
            words += len(letters.starts)
            if words >= PATH_WORDS:
                yield from flush(held)
                held, words = [], 0
        if held:
            yield from flush(held)

    extra = [F.col(f"`{text}`").cast("string").alias("_said")] if source == "_said" else []
    return docs.select(*[F.col(f"`{n}`") for n in names], *extra).mapInArrow(run, schema)
