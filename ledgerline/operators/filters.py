"""Dynamic filters and value lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import code_year


def all_in(*pairs: object) -> Column:
    """AND of ``field IN values`` over (field, values, field, values, ...).

    Pairs with no field or no values are skipped, a repeated field takes its last
    values, and no pair at all is true.
    """
    chosen: dict[str, list] = {}
    for field, values in zip(pairs[0::2], pairs[1::2]):
        values = [] if values is None else list(values) if isinstance(values, (list, tuple, set)) else [values]
        if field and values:
            chosen[field] = values
    return reduce(lambda a, b: a & b, [F.col(f).isin(v) for f, v in chosen.items()], F.lit(True))


def in_years(code: str, years: Sequence[int]) -> Column:
    """Week codes of the given years."""
    return code_year(F.col(code)).isin(list(years))


def value_list(df: DataFrame, column: str, *prior: object) -> DataFrame:
    """Sorted distinct values of a column, after the AND-IN of earlier choices."""
    return df.filter(all_in(*prior)).select(column).distinct().orderBy(column)
