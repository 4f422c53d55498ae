"""Row selection operators with the reference's null semantics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.functions.expressions import if_all, predicate


def exclude_where(df: DataFrame, cond: Column | Sequence) -> DataFrame:
    """Drop rows where ``cond`` is true; a null condition keeps the row.

    ``cond`` is a Column or a predicate rule (see ``expressions.predicate``).
    """
    c = cond if isinstance(cond, Column) else predicate(cond)
    return df.filter(~F.coalesce(c, F.lit(False)))


def apply_exclusions(df: DataFrame, rules: Iterable) -> DataFrame:
    """Apply several exclusion rules; Catalyst combines them into one filter."""
    for r in rules:
        df = exclude_where(df, r)
    return df


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nulls by 0 in the given (numeric) columns."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType))
                           for c in present})


def drop_all_zero(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Drop every row of a key that has a row whose measures are all exactly 0.

    A key may have several rows (a corrected name differs by mechanism): one
    all-zero row removes all of them.  The keys are found by a filter and
    applied by an anti-join; no list of keys is collected.  A null key is
    removed by its own all-zero rows only.
    """
    zero = F.coalesce(if_all(columns, lambda c: c == 0), F.lit(False))
    gone = df.filter(zero).select(key).distinct()
    return df.filter(~zero).join(gone, key, "left_anti")

