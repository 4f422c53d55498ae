"""Query registry shared by the catalog modules, and SQL text helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from indicata.plans.proxy import ORACLE_CTE, PROXY_MECH_PARTNER

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = ORACLE_CTE + sql
        return fn
    return deco


# Scoring period of the proxy queries (the last complete fiscal year's Q4).
PERIOD = "2000 Q4"

# Proxy partner names for the mechanism (market segment) column.
PROXY_PARTNER = PROXY_MECH_PARTNER


def _sql_lit(x) -> str:
    return f"'{x}'" if isinstance(x, str) else str(x)


def _sql_band(v: str, bands, default=0) -> str:
    parts = []
    for b in bands:
        if b[1] == "between":
            parts.append(f"WHEN {v} BETWEEN {b[2]} AND {b[3]} THEN {_sql_lit(b[0])}")
        else:
            parts.append(f"WHEN {v} {b[1]} {b[2]} THEN {_sql_lit(b[0])}")
    return "CASE " + " ".join(parts) + f" ELSE {_sql_lit(default)} END"


def _sql_ratio(n: str, d: str) -> str:
    n, d = f"({n})", f"({d})"
    return (f"CASE WHEN {d} <> 0 THEN {n} / {d} "
            f"WHEN {d} = 0 AND {n} > 0 THEN CAST('Infinity' AS DOUBLE) "
            f"WHEN {d} = 0 AND {n} < 0 THEN CAST('-Infinity' AS DOUBLE) END")


def _sql_value(x) -> str:
    return "NULL" if x is None else _sql_lit(x)


def _sql_predicate(spec) -> str:
    """A predicate rule (alternatives of terms) in SQL."""
    def term(c, op, arg=None):
        if op in ("==", "!=", "<", ">"):
            return f"{c} {dict(zip(('==', '!='), ('=', '<>'))).get(op, op)} {_sql_lit(arg)}"
        if op == "in":
            return f"{c} IN ({_sql_in(arg)})"
        if op == "not_in":
            return f"NOT coalesce({c} IN ({_sql_in(arg)}), false)"
        if op == "is_null":
            return f"{c} IS NULL"
        raise ValueError(op)
    return " OR ".join("(" + " AND ".join(term(*t) for t in alt) + ")" for alt in spec)


def label_pool(specs, column) -> list:
    """Every value that the rules compare ``column`` with, one other value, and null."""
    found = []
    for spec in specs:
        for alt in spec or ():
            for c, op, *arg in alt:
                if c == column and arg:
                    found += arg[0] if isinstance(arg[0], (list, tuple)) else [arg[0]]
    return [*dict.fromkeys(found), "another", None]


def pick(values, a: int, b: int) -> tuple[str, str]:
    """A value per line of the proxy fact, dealt by its order and part keys: an expression for
    Spark, and one for the oracle."""
    at = f"CAST((order_key * {a} + part_key * {b}) % {len(values)} AS INT) + 1"
    items = ", ".join(map(_sql_value, values))
    return f"element_at(array({items}), {at})", f"([{items}])[{at}]"


def _sql_lookup(c: str, mapping) -> str:
    """Dictionary lookup in SQL; unmatched values become NULL (no pass-through)."""
    return "CASE " + " ".join(f"WHEN {c} = '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def _sql_recode(c: str, mapping) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {c} {whens} ELSE {c} END"




def _sql_values(rows) -> str:
    def lit(v):
        if v is None:
            return "CAST(NULL AS VARCHAR)"
        return f"'{v}'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def _sql_in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)
