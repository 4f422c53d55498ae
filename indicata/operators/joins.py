"""Joins: enrichment from dimensions, indicator mapping, key restriction,
orphan detection and attribute refresh.

Broadcast policy: a side is hinted for broadcast only when its size is
bounded by construction (``bounded=True``: anchor lists, fixed-size
geographies; the indicator map).  Any other dimension is joined plainly and AQE
(``spark.sql.adaptive.autoBroadcastJoinThreshold``) turns the join into a
broadcast at run time only if the measured side is small, keeping a
sort-merge join otherwise.  A join of two tables that both grow with the
data carries an explicit shuffle hint instead (see ``proxy.fact``), so that
neither side is ever broadcast from the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _side(dim: DataFrame, bounded: bool) -> DataFrame:
    return F.broadcast(dim) if bounded else dim


def enrich(df: DataFrame, dim: DataFrame, on: str | Sequence[str], *,
           left_on: str | Sequence[str] | None = None, how: str = "left",
           bounded: bool = False) -> DataFrame:
    """Left-join dimension attributes onto a fact.

    ``left_on`` names the fact's key columns when they differ from the
    dimension's (e.g. ``orgunituid`` vs ``datim_uid``); the fact keeps its
    own names.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if left_on is None:
        return df.join(_side(dim, bounded), keys, how)
    lkeys = [left_on] if isinstance(left_on, str) else list(left_on)
    d = dim.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                   *[c for c in dim.columns if c not in keys])
    cond = reduce(lambda a, b: a & b,
                  [df[lk] == d[f"__k{i}"] for i, lk in enumerate(lkeys)])
    out = df.join(_side(d, bounded), cond, how)
    return out.drop(*[f"__k{i}" for i in range(len(keys))])


def map_indicator(df: DataFrame, mapping: DataFrame, *, new: str = "indicator_new",
                  target: str = "indicator") -> DataFrame:
    """Natural, null-safe join on the columns the fact shares with the map.

    A null key matches a null key (as in R's joins).  A key may map to several
    new indicators (deliberate fan-out).  Rows without a mapped indicator are
    dropped, the old ``target`` column is replaced by the new one.  The map is
    a rule table and broadcast: its few keys would be the only partitions of a
    shuffled join, however large the fact is.
    """
    shared = [c for c in mapping.columns if c in df.columns and c != new]
    m = mapping.select(*[F.col(c).alias(f"__m_{c}") for c in shared], F.col(new))
    cond = reduce(lambda a, b: a & b, [df[c].eqNullSafe(m[f"__m_{c}"]) for c in shared])
    out = df.join(_side(m, True), cond, "inner").filter(F.col(new).isNotNull())
    out = out.drop(*[f"__m_{c}" for c in shared])
    if target in out.columns:
        out = out.drop(target)
    return out.withColumnRenamed(new, target)


def restrict_to(df: DataFrame, keys: DataFrame, on: str | Sequence[str], *,
                bounded: bool = False) -> DataFrame:
    """Keep rows whose key exists in ``keys`` (semi-join; no fan-out)."""
    return df.join(_side(keys, bounded), on if isinstance(on, str) else list(on), "left_semi")


def keep_with_any(df: DataFrame, key: str, measure: str) -> DataFrame:
    """Keep rows whose ``key`` has a non-null ``measure`` on any row.

    Distinct keys are found with a partial aggregation and applied with a
    semi-join, so no key list reaches the driver.
    """
    having = df.filter(F.col(measure).isNotNull()).select(key).distinct()
    return df.join(having, key, "left_semi")


def orphans(df: DataFrame, master: DataFrame, on: str | Sequence[str], *,
            left_on: str | None = None) -> DataFrame:
    """Rows whose key is missing from the master list (anti-join)."""
    if left_on is None:
        return df.join(master, on if isinstance(on, str) else list(on), "left_anti")
    m = master.select(F.col(on).alias("__k")).distinct()
    return df.join(m, df[left_on] == m["__k"], "left_anti")


def refresh_attrs(df: DataFrame, master: DataFrame, on: str, attrs: Sequence[str], *,
                  overrides: Mapping[str, Mapping[str, str]] | None = None,
                  bounded: bool = False) -> DataFrame:
    """Replace stale attributes by the master list's, then apply overrides.

    ``overrides`` is ``{key_value: {attr: value}}`` for sites that must carry
    a fixed label whatever the master says.
    """
    cols = [on] + [a for a in attrs if a in master.columns]
    out = df.drop(*[a for a in attrs if a in df.columns]).join(
        _side(master.select(*cols), bounded), on, "left")
    for key_value, sets in (overrides or {}).items():
        out = out.withColumns({a: F.when(F.col(on) == key_value, F.lit(v)).otherwise(F.col(a))
                               for a, v in sets.items()})
    return out


def qa_missing_key(df: DataFrame, key: str) -> DataFrame:
    """Rows with a null key (uncoded sites)."""
    return df.filter(F.col(key).isNull())


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (dimension uniqueness check)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))

