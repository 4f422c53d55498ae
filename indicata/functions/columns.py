"""Schema-level helpers: column selection, relocation, schema difference.

These inspect ``df.schema`` on the driver (metadata only) and return
column-name lists or reordered projections; no data moves.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def cols(df: DataFrame, *, starts: str | Sequence[str] | None = None,
         ends: str | Sequence[str] | None = None,
         contains: str | Sequence[str] | None = None,
         numeric: bool = False, names: Iterable[str] | None = None,
         span: tuple[str, str] | None = None,
         exclude: Iterable[str] | None = None) -> list[str]:
    """Column names matching every given selector, in schema order.

    Name matching ignores case, as the tidyselect helpers do.  ``span`` is
    an inclusive ``a:b`` range by position, ``exclude`` a complement.
    """
    def as_list(x):
        return [x] if isinstance(x, str) else list(x or [])

    fields = df.schema.fields
    out = [f.name for f in fields]
    if span is not None:
        pos = [f.name for f in fields]
        i, j = pos.index(span[0]), pos.index(span[1])
        keep = set(pos[min(i, j):max(i, j) + 1])
        out = [c for c in out if c in keep]
    if starts is not None:
        ps = [p.lower() for p in as_list(starts)]
        out = [c for c in out if any(c.lower().startswith(p) for p in ps)]
    if ends is not None:
        ps = [p.lower() for p in as_list(ends)]
        out = [c for c in out if any(c.lower().endswith(p) for p in ps)]
    if contains is not None:
        ps = [p.lower() for p in as_list(contains)]
        out = [c for c in out if any(p in c.lower() for p in ps)]
    if numeric:
        num = {f.name for f in fields if isinstance(f.dataType, _NUMERIC)}
        out = [c for c in out if c in num]
    if names is not None:
        wanted = set(names)
        out = [c for c in out if c in wanted]
    if exclude is not None:
        drop = set(exclude)
        out = [c for c in out if c not in drop]
    return out


def ordered(df: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """The columns that ``patterns`` name, in their order.

    A star at one end of a pattern stands for any rest of a name; a plain name
    that ``df`` does not have is an error.
    """
    out: list[str] = []
    for p in patterns:
        found = (cols(df, ends=p[1:]) if p.startswith("*")
                 else cols(df, starts=p[:-1]) if p.endswith("*") else [p])
        out += [c for c in found if c not in out]
    return df.select(*out)


def with_null_measures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add each absent column as a null double, for callers that declare them so."""
    absent = [c for c in columns if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("double") for c in absent}) if absent else df


def relocate(df: DataFrame, columns: Sequence[str], *, after: str | None = None,
             before: str | None = None) -> DataFrame:
    """Move ``columns`` after/before an anchor column, or to the end."""
    moving = [c for c in columns if c in df.columns]
    rest = [c for c in df.columns if c not in moving]
    if after is None and before is None:
        order = rest + moving
    else:
        anchor = after if after is not None else before
        i = rest.index(anchor)
        order = rest[: i + 1] + moving + rest[i + 1:] if after is not None else \
            rest[:i] + moving + rest[i:]
    return df.select(*order)


def lower_names(df: DataFrame) -> DataFrame:
    """Rename every column to lower case."""
    return df.toDF(*[c.lower() for c in df.columns])


def schema_diff(spark: SparkSession, a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns of ``a`` that ``b`` lacks, with their types, as a DataFrame."""
    b_names = set(b.columns)
    rows = [(f.name, f.dataType.simpleString()) for f in a.schema.fields
            if f.name not in b_names]
    return spark.createDataFrame(rows, "column string, type string")
