"""Token ids of whole columns of texts, with the vocabulary looked up once for each distinct word of a slice.

A slice of texts is cut at blanks by Arrow, its words are dictionary-encoded, and only words that
a worker has not met before are given to the vocabulary. The ids of all texts then come from one gather
over arrays; Python sees distinct words only.
"""

from __future__ import annotations

import json
import sys
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from ledgerline.llm.common import give_back, ranges, text_bytes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

END_ID = 1
#: Distinct word parts whose ids a worker remembers; beyond it starts anew. No result depends on it.
REMEMBERED = 300_000
#: Bytes of one text that are split at once; a longer text is cut at a blank first.
LONG_TEXT = 1 << 23

_TAIL = ".,;:!?|$#*%&"
#: Runs of letters whose lower case is one letter each and that no normal form changes: ASCII and Latin without the dotted capital I.
_LETTERS = "^[A-Za-zÀ-ÖØ-öø-įı-ž]+$"


def id_kind(spec: str) -> str:
    """Two bytes an id where the vocabulary allows it, else four, while ids are written and moved."""
    parsed = json.loads(spec)
    known = [*parsed["model"]["vocab"].values(), *(x["id"] for x in parsed.get("added_tokens", ()))]
    return "<u2" if max(known, default=0) < 1 << 16 else "<u4"


def _is_word_bpe(spec: str) -> bool:
    """True for a lower-casing byte-level BPE that marks word ends, whose letter runs stand alone."""
    parsed = json.loads(spec)
    steps = (parsed.get("normalizer") or {}).get("normalizers", [])
    return parsed["model"].get("end_of_word_suffix") == "</w>" and any(x["type"] == "Lowercase" for x in steps)


def _spelling() -> dict[int, str]:
    """How byte-level tokenizers spell letters: printable bytes as they are, the others from code point 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spelled = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}
    return {c: "".join(spelled[b] for b in chr(c).encode()) for c in range(128, 0x180)}


class _Parts(dict):
    """The ids of a part of a word, as bytes: of lower-case letters by the model alone, of anything else by the whole tokenizer.

    Parts that are for the whole tokenizer are kept under a name that begins with a blank.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.model = self.tokenizer.model
        self.spelling = _spelling()
        self.plain = _is_word_bpe(spec)
        self.kind = np.dtype(id_kind(spec))
        self.code = "H" if self.kind.itemsize == 2 else "I"

    def __missing__(self, part: str) -> bytes:
        if part[:1] == " ":
            ids = self.tokenizer.encode(part[1:], add_special_tokens=False).ids
        else:
            spelled = part if part.isascii() else part.translate(self.spelling)
            ids = [t.id for t in self.model.tokenize(spelled)]
        self[part] = found = array(self.code, ids).tobytes()
        return found


def _parts(spec: str) -> _Parts:
    """The worker's own table, kept between its tasks."""
    import tokenizers

    kept = getattr(tokenizers, "_ledgerline_parts", None)
    if kept is None or kept[0] != hash(spec) or len(kept[1]) > REMEMBERED:
        kept = tokenizers._ledgerline_parts = (hash(spec), _Parts(spec))
    return kept[1]


def forget() -> None:
    """A worker that tokenized before gives its table back, for tasks of other kinds; the next tokenizing task loads it again."""
    kept = sys.modules.get("tokenizers")
    if kept is not None and getattr(kept, "_ledgerline_parts", None) is not None:
        kept._ledgerline_parts = None
        give_back()


def _ids_of(texts: pa.Array, known: _Parts) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in a row, how many each text has).

    A text's ids are those of its words between blanks and line feeds in turn, as this kind of tokenizer
    drops white space before it looks for tokens. A word of plain letters with punctuation behind it or not is two
    parts, which the tokenizer would separate as well; any other word is one part.
    """
    lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
    per_text = np.diff(lists.offsets.to_numpy())
    words = lists.flatten().dictionary_encode()
    codes, words = words.indices.to_numpy(), words.dictionary
    core = pc.utf8_rtrim(words, _TAIL)
    plain = pc.and_(pc.match_substring_regex(core, _LETTERS), known.plain)
    first = pc.if_else(plain, pc.utf8_lower(core), pc.binary_join_element_wise(" ", words, ""))
    size = pc.binary_length(core).to_numpy()
    left = pc.binary_length(words).to_numpy() - size
    tailed = np.flatnonzero(plain.to_numpy(zero_copy_only=False) & (left > 0))
    second = _tails(words.take(pa.array(tailed)), left[tailed])
    both = pa.concat_arrays([first, second]).dictionary_encode()
    got = [known[x] for x in both.dictionary.to_pylist()]
    table = np.frombuffer(b"".join(got), known.kind)
    n = np.array([len(x) for x in got], np.int64) // known.kind.itemsize
    at = np.cumsum(n) - n
    unit = np.full((len(words), 2), -1, np.int64)
    unit[:, 0] = both.indices.to_numpy()[: len(words)]
    unit[tailed, 1] = both.indices.to_numpy()[len(words) :]
    starts, lengths = np.append(at, 0)[unit], np.append(n, 0)[unit]
    table = table[ranges(starts.ravel(), lengths.ravel())]  # the ids of each distinct word together
    count = lengths.sum(axis=1)
    begin = np.cumsum(count) - count
    said = count[codes]
    ids = table[ranges(begin[codes], said)]
    sums = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(said, out=sums[1:])
    ends = np.cumsum(per_text)
    return ids, sums[ends] - sums[ends - per_text]


def _tails(words: pa.Array, size: np.ndarray) -> pa.Array:
    """A blank and the last ``size`` bytes of each word, which are ASCII."""
    data, offsets = text_bytes(words)
    raw = np.full((size + 1).sum(), 32, np.uint8)
    ends = np.cumsum(size + 1)
    raw[ranges(ends - size, size)] = data[ranges(offsets[1:] - size, size)]
    bounds = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(bounds), pa.py_buffer(raw)])


def _cut(text: str) -> list[str]:
    """A very long text in pieces that end before a blank or line feed; a piece without any stays whole."""
    out, at = [], 0
    while len(text) - at > LONG_TEXT:
        to = max(text.rfind(" ", at + 1, at + LONG_TEXT), text.rfind("\n", at + 1, at + LONG_TEXT))
        if to < 0:
            after = [x for x in (text.find(" ", at + LONG_TEXT), text.find("\n", at + LONG_TEXT)) if x >= 0]
            if not after:
                break
            to = min(after)
        out.append(text[at:to])
        at = to
    return [*out, text[at:]]


def encode(texts: pa.Array, spec: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets): the ids of text i, each text's followed by the end id, are ``ids[offsets[i]:offsets[i + 1]]``.

    A null or empty text is its end id alone.
    """
    known = _parts(spec)
    texts = texts.fill_null("")
    long = pc.any(pc.greater(pc.binary_length(texts), LONG_TEXT)).as_py()
    if long:  # one piece after the other
        found = [[_ids_of(pa.array([piece]), known)[0] for piece in _cut(text)] for text in texts.to_pylist()]
        count = np.array([sum(map(len, x)) for x in found], np.int64)
        flat = np.concatenate([piece for x in found for piece in x])
    else:
        flat, count = _ids_of(texts, known)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(count + 1, out=offsets[1:])
    ids = np.empty(offsets[-1], known.kind)
    ends = offsets[1:] - 1
    inside = np.ones(len(ids), bool)
    inside[ends] = False
    ids[inside] = flat
    ids[ends] = END_ID
    return ids, offsets


def pieces(offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents cut after every ``size`` ids: (row, number in the row, start in the row, length) of each piece."""
    count = np.diff(offsets)
    per = -(-count // size)
    row = np.repeat(np.arange(len(per)), per)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    start = nth * size
    return row, nth, start, np.minimum(size, count[row] - start)


def as_binary(ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A column of the bytes of consecutive runs of ids, without a copy of each."""
    ends = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths * ids.itemsize, out=ends[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(ids))])


def binary_values(column: pa.Array, kind: np.dtype) -> np.ndarray:
    """All values of a binary column in a row."""
    wide = pa.types.is_large_binary(column.type)
    ends = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(kind) if data is not None and len(column) else np.zeros(0, kind)

