"""Schema alignment and union by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Contract:
    """How one source layout maps to the canonical schema.

    ``drop``: columns to remove; ``rename``: old -> new names; ``schema``:
    the canonical typed columns the result is projected onto (missing ones
    become typed nulls, extra ones are dropped).
    """
    schema: T.StructType
    drop: Sequence[str] = field(default_factory=list)
    rename: Mapping[str, str] = field(default_factory=dict)


def align(df: DataFrame, contract: Contract) -> DataFrame:
    """Bring one source to the canonical schema (drop, rename, typed select).

    Casts use ``try_cast`` so an unparsable value becomes null, as R's
    ``as.numeric`` gives NA, instead of failing the job under ANSI mode.
    """
    out = df.drop(*[c for c in contract.drop if c in df.columns])
    ren = {k: v for k, v in contract.rename.items() if k in out.columns}
    if ren:
        out = out.withColumnsRenamed(ren)
    cols = []
    for f in contract.schema.fields:
        if f.name in out.columns:
            src = out.schema[f.name].dataType
            c = F.col(f.name) if src == f.dataType else F.col(f.name).try_cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return out.select(*cols)


def union_all(dfs: Sequence[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """Union by name, filling missing columns with nulls (``bind_rows``).

    With ``schema`` every input is first cast to it, so a type drift (string
    in one year, number in another) is resolved explicitly rather than by
    Spark's silent widening.
    """
    if schema is not None:
        dfs = [align(d, Contract(schema=schema)) for d in dfs]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
