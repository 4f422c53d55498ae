"""Column builders with the reference's null, NaN and infinity semantics.

All return plain ``Column`` expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_in(c: ColumnOrName, values: Iterable) -> Column:
    """Non-membership that keeps nulls (``!x %in% S`` in R).

    Spark's ``~isin`` is null for a null input and thereby drops the row in a
    filter; here a null is "not in" the set.
    """
    return ~F.coalesce(col(c).isin(list(values)), F.lit(False))


def is_in(c: ColumnOrName, values: Iterable) -> Column:
    """Membership that is false (not null) for a null input."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Guarded division.

    * null if either side is null, and for 0/0 (R gives NaN, which falls
      through every band; null does the same and never compares true),
    * +/-Infinity for a non-zero numerator over a zero denominator (as R),
    * the quotient otherwise.
    """
    n, d = col(num), col(den)
    zero = d == 0
    return (F.when(d != 0, F.try_divide(n, d))
            .when(zero & (n > 0), F.lit(float("inf")))
            .when(zero & (n < 0), F.lit(float("-inf"))))


def nz(c: ColumnOrName) -> Column:
    """Null to zero (``replace_na(x, 0)``)."""
    return F.coalesce(col(c), F.lit(0))


def row_sum(cols: Sequence[ColumnOrName]) -> Column:
    """Row-wise sum over columns, nulls counted as 0 (``rowSums(na.rm)``)."""
    if not cols:
        return F.lit(0)
    return reduce(lambda a, b: a + b, [nz(c) for c in cols])


def if_all(cols: Sequence[ColumnOrName], pred) -> Column:
    """True when ``pred`` holds for every column (``if_all``)."""
    return reduce(lambda a, b: a & b, [pred(col(c)) for c in cols])


def recode(c: ColumnOrName, mapping: Mapping, default: ColumnOrName | None = None) -> Column:
    """Dictionary recode; unmatched values (and nulls) pass through.

    Builds one literal map and looks the value up, so a 40-entry dictionary is
    one expression rather than a 40-branch ``CASE``.
    """
    if not mapping:
        return col(c) if default is None else col(default)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    fallback = col(c) if default is None else col(default)
    return F.coalesce(F.try_element_at(m, col(c)), fallback)


def lookup(c: ColumnOrName, mapping: Mapping) -> Column:
    """Dictionary lookup; unmatched values become null (no pass-through)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.try_element_at(m, col(c))


def case_match(c: ColumnOrName, cases: Sequence[tuple[Iterable, object]],
               default: object = None) -> Column:
    """``case_match``: first list containing the value wins, else ``default``.

    ``default`` may be a literal, a Column, or ``None`` (null).
    """
    expr = None
    for values, out in cases:
        out_c = out if isinstance(out, Column) else F.lit(out)
        cond = col(c).isin(list(values))
        expr = F.when(cond, out_c) if expr is None else expr.when(cond, out_c)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if expr is None else expr.otherwise(d)


def signed_coalesce(terms: Sequence[tuple[str, int]]) -> Column:
    """``coalesce(a, -b, c)``: first non-null term, each with its sign."""
    return F.coalesce(*[col(n) * F.lit(s) if s != 1 else col(n) for n, s in terms])


# -- band scores ---------------------------------------------------------------

def _band_condition(v: Column, band: Sequence) -> Column:
    op = band[1]
    if op == ">":
        return v > F.lit(band[2])
    if op == ">=":
        return v >= F.lit(band[2])
    if op == "<":
        return v < F.lit(band[2])
    if op == "<=":
        return v <= F.lit(band[2])
    if op == "between":
        return v.between(F.lit(band[2]), F.lit(band[3]))
    raise ValueError(f"unknown band operator {op!r}")


def band_score(value: ColumnOrName, bands: Sequence[Sequence], default=0) -> Column:
    """Map a value to a score (or label) by an ordered band table.

    ``bands`` is a list of ``(score, op, a[, b])`` with ``op`` one of
    ``> >= < <= between``; the first matching band wins (overlaps allowed),
    and values in no band, including null, get ``default``.
    """
    v = col(value)
    expr = None
    for band in bands:
        cond = _band_condition(v, band)
        out = F.lit(band[0])
        expr = F.when(cond, out) if expr is None else expr.when(cond, out)
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


# -- predicate rules as data -------------------------------------------------------

def predicate(spec) -> Column:
    """Build a Column predicate from a small rule structure.

    ``spec`` is a list of alternatives (OR); each alternative is a list of
    terms (AND); a term is ``(column, op, value)`` with ``op`` one of
    ``== != < <= > >= in not_in is_null not_null contains``.  Null handling
    follows SQL three-valued logic, as ``case_when`` does in R (a null
    condition is not true).
    """
    alts = []
    for alt in spec:
        terms = []
        for term in alt:
            c, op = F.col(term[0]), term[1]
            arg = term[2] if len(term) > 2 else None
            if op == "==":
                terms.append(c == F.lit(arg))
            elif op == "!=":
                terms.append(c != F.lit(arg))
            elif op == "<":
                terms.append(c < F.lit(arg))
            elif op == "<=":
                terms.append(c <= F.lit(arg))
            elif op == ">":
                terms.append(c > F.lit(arg))
            elif op == ">=":
                terms.append(c >= F.lit(arg))
            elif op == "in":
                terms.append(c.isin(list(arg)))
            elif op == "not_in":
                terms.append(not_in(c, arg))
            elif op == "is_null":
                terms.append(c.isNull())
            elif op == "not_null":
                terms.append(c.isNotNull())
            elif op == "contains":
                terms.append(c.contains(arg))
            else:
                raise ValueError(f"unknown predicate operator {op!r}")
        alts.append(reduce(lambda a, b: a & b, terms))
    return reduce(lambda a, b: a | b, alts)


def predicate_columns(spec) -> set[str]:
    return {term[0] for alt in spec for term in alt}
