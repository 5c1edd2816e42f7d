"""Text cleaning, hashing and classification as Column expressions."""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


# A character no feed holds, put before a space to mark where a word was split.
_MARK = "\u0001 "


def title_case(text: Column) -> Column:
    """Trim, lower, then capitalize after every character that is not a letter or digit.

    initcap knows only spaces, so one is put behind each such character and taken out again.
    """
    split = F.regexp_replace(F.lower(F.trim(text)), r"(?<=[^\p{L}\p{N}])", _MARK)
    return F.replace(F.initcap(split), F.lit(_MARK), F.lit(""))


def proper_case(text: Column) -> Column:
    """Lower, then capitalize a-z after a regex word boundary (so not after ``_``)."""
    words = F.split(F.lower(text), r"(?<=\b)(?=[a-z])")

    def capitalize(w: Column) -> Column:
        first = F.translate(F.substring(w, 1, 1), string.ascii_lowercase, string.ascii_uppercase)
        return F.concat(first, F.substring(w, 2, 2**31 - 1))

    return F.array_join(F.transform(words, capitalize), "")


def blank_to_null(text: Column) -> Column:
    """Null for empty text, so that 'no value' has one form in the histories."""
    return F.nullif(text, F.lit(""))


def digits_to_int(text: Column) -> Column:
    """Drop everything but digits and read the rest as an int; null where that fails."""
    return F.regexp_replace(text, "[^0-9]+", "").try_cast("int")


def is_plain_number(text: Column) -> Column:
    """True for text made of digits and dots only."""
    return text.rlike(r"^[0-9\.]+$")


def point_text(wkt: Column) -> Column:
    """``POINT (x y)`` to ``x y``; a missing point becomes ``0.0 0.0``."""
    return F.coalesce(F.regexp_replace(F.trim(wkt), r"(POINT\s\()|\)", ""), F.lit("0.0 0.0"))


def point_part(wkt: Column, part: int) -> Column:
    """First or second number of a WKT point as text, '' when it is missing.

    Part 1 is what the store tables call ``lat``, although WKT puts x (longitude) first.
    """
    return F.split_part(point_text(wkt), F.lit(" "), F.lit(part))


@dataclass(frozen=True)
class HashPart:
    """One column of a row hash: its text for null, and the width its text is cut to."""

    column: str
    null_text: str | None = None
    width: int | None = None


def row_hash(parts: Sequence[HashPart], compat: bool = True) -> Column:
    """md5 over the parts.

    ``compat`` concatenates without a delimiter, which is what existing hashes were
    made with, and so can collide; otherwise the parts are kept apart and null is
    told from its sentinel.
    """
    texts = []
    for part in parts:
        text = F.col(part.column).cast("string")
        if part.width is not None:
            text = F.substring(text, 1, part.width)
        if not compat:
            text = F.coalesce(F.concat(F.lit("v"), text), F.lit("n"))
        elif part.null_text is not None:
            text = F.coalesce(text, F.lit(part.null_text))
        texts.append(text)
    return F.md5(F.concat(*texts) if compat else F.concat_ws("\x1f", *texts))


# Columns, null sentinels and widths of the store row hash.
STORE_HASH_PARTS = [
    HashPart("store_nbr", "0", 6),
    HashPart("store_name", "Null"),
    HashPart("store_address", "Null"),
    HashPart("store_city", "Null"),
    HashPart("zip_code", "-99999"),
    HashPart("county_nbr", "-99", 6),
    HashPart("lat", "-999.0"),
    HashPart("long", "-999.0"),
]

# Columns, null sentinels and widths of the item row hash.
ITEM_HASH_PARTS = [
    HashPart("item_nbr", None, 10),
    HashPart("item_desc", "null"),
    HashPart("category_nbr", "-99", 10),
    HashPart("items_per_pack", "-1", 6),
    HashPart("item_vol", "-750", 7),
]

# Ordered (pattern, group) rules for drink categories; the first match wins.
CATEGORY_RULES = [
    (r"[a-zA-Z\s]*Rum+[a-zA-Z\s]*", "Rum"),
    (r"[a-zA-Z\s]*Vodka+[a-zA-Z\s]*", "Vodka"),
    (r"[a-zA-Z\s]*Gin+[a-zA-Z\s]*", "Gin"),
    (r"[a-zA-Z0-9_\%\s]*(Tequila)|(Mezcal)+[a-zA-Z\s]*", "Tequila"),
    (r"[a-zA-Z\s]*Whisk+[a-zA-Z\s]*", "Whiskies"),
    (r"[a-zA-Z\s]*Brand+[a-zA-Z\s]*", "Brandies"),
    (r"[a-zA-Z\s\&]*Liqueur+[a-zA-Z\s]*", "Liqueurs"),
    (r"Cocktails+[a-zA-Z\s\/]*", "Liqueurs"),
    (r"[a-zA-Z\s]*Schnapps+[a-zA-Z\s]*", "Schnapps"),
    (r"[\w\s]*Spirit+[\w\s]*", "Spirit"),
    (r".*Special+.*", "Speciality"),
    (r"[a-zA-Z\s]*Bourbon+[a-zA-Z\s]*", "Bourbon"),
    (r"[a-zA-Z\s]*Scotch+[a-zA-Z\s]*", "Scotch"),
    (r"[a-zA-Z\s]*Triple+[a-zA-Z\s]*", "Triple Sec"),
]


def category_group(
    text: Column,
    rules: Sequence[tuple[str, str]] = tuple(CATEGORY_RULES),
    default: str = "other",
    match: str = "full",
) -> Column:
    """First rule that matches ``text``, as one CASE expression; ``match`` is 'full' or 'search'."""
    if match not in ("full", "search"):
        raise ValueError("match must be 'full' or 'search'")
    result = None
    for pattern, group in rules:
        test = text.rlike(f"^(?:{pattern})$" if match == "full" else pattern)
        result = F.when(test, group) if result is None else result.when(test, group)
    return F.lit(default) if result is None else result.otherwise(default)


_REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"


@contextmanager
def repeated_json_keys(spark: SparkSession) -> Iterator[None]:
    """Frames made inside accept repeated keys in JSON objects; the session's own setting is as before afterwards."""
    before = spark.conf.get(_REPEATED_KEYS, None)
    spark.conf.set(_REPEATED_KEYS, "true")
    try:
        yield
    finally:
        spark.conf.unset(_REPEATED_KEYS) if before is None else spark.conf.set(_REPEATED_KEYS, before)


def is_valid_json(text: Column) -> Column:
    """True where the whole text is one JSON value; null is not valid.

    The parser stops after the first value, so the text is tried inside an array and
    inside an object: trailing text breaks one of the two. Repeated keys are valid in frames
    made inside :func:`repeated_json_keys`.
    """
    in_array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    return F.coalesce(in_array.isNotNull() & in_object.isNotNull(), F.lit(False))


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """True where ``text`` contains one of ``words`` as a regex alternative, case kept."""
    return text.rlike("|".join(words))
