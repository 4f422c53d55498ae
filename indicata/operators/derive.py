"""Rule-driven derivations: ordered corrections, derived indicator columns
and long-form derived indicators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.functions.expressions import (predicate, predicate_columns, recode,
                                            signed_coalesce)


Rules = Sequence[tuple[Mapping[str, str], Mapping[str, str]]]
#: Any value of a matched column that no rule names; null in the table of states.
OTHER = None
#: Greatest number of states that are compiled into a table.
MAX_STATES = 200_000


def compile_corrections(rules: Rules) -> tuple[list[str], list[str], list[tuple]]:
    """The ordered rules as one table: matched columns, set columns, and rows.

    A state has a value per matched column: one that a rule names, or OTHER.  A
    row holds a state in which some rule applies, and per set column whether it
    is set and its final value, as the rules one after another leave it.
    """
    matched = list(dict.fromkeys(c for match, _ in rules for c in match))
    assigned = list(dict.fromkeys(c for _, sets in rules for c in sets))
    named = {c: list(dict.fromkeys(v for r in rules for part in r for k, v in part.items()
                                   if k == c and v is not None)) for c in matched}
    if prod(len(v) + 1 for v in named.values()) > MAX_STATES:
        raise ValueError(f"the rules name more than {MAX_STATES} combinations")
    rows = []
    for state in product(*[[*named[c], OTHER] for c in matched]):
        now, out = dict(zip(matched, state)), {}
        for match, sets in rules:
            if all(now[c] is not OTHER and now[c] == v for c, v in match.items()):
                out |= sets
                now |= {c: v for c, v in sets.items() if c in now}
        if out:
            rows.append((*state, *[x for c in assigned for x in (c in out, out.get(c))]))
    return matched, assigned, rows


def apply_corrections(df: DataFrame, rules: Rules) -> DataFrame:
    """Ordered conditional overwrites.

    Each rule is ``(match, set)``: where every ``match`` column equals its
    value, the ``set`` columns take their new values.  Rules apply in order,
    each seeing the previous rules' output (so a later rule can match a uid
    an earlier rule assigned); inside one rule every assignment reads the
    row as it was before the rule.  The rules are folded before the query into a
    table of final values, as large as the rules make it, which one broadcast
    join looks up; the plan does not grow with the rules.
    """
    matched, assigned, rows = compile_corrections(rules)
    if not rows:
        return df
    keys = [f"__m{i}" for i in range(len(matched))]
    fields = [f"{k} string" for k in keys] + [f for i in range(len(assigned))
                                              for f in (f"__on{i} boolean", f"__to{i} string")]
    states = F.broadcast(df.sparkSession.createDataFrame(rows, ", ".join(fields)))
    on = None
    for i, (key, c) in enumerate(zip(keys, matched)):
        named = sorted({r[i] for r in rows if r[i] is not OTHER})
        value = F.col(c).cast("string")
        here = F.when(value.isin(named), value).eqNullSafe(F.col(key))
        on = here if on is None else on & here
    found = df.join(states, on, "left")
    return found.withColumns({
        c: F.when(F.col(f"__on{i}"), F.col(f"__to{i}").cast(df.schema[c].dataType))
        .otherwise(F.col(c)) for i, c in enumerate(assigned)}).select(*df.columns)


def _rule_expr(rule: Mapping) -> tuple[Column, set[str]]:
    if "recode" in rule:
        return recode(F.col(rule["col"]), rule["recode"]), {rule["col"]}
    if "coalesce" in rule:
        return signed_coalesce(rule["coalesce"]), {c for c, _ in rule["coalesce"]}
    src = F.col(rule["src"])
    if rule.get("when") is None:
        return src, {rule["src"]}
    return F.when(predicate(rule["when"]), src), {rule["src"]} | predicate_columns(rule["when"])


def derive_indicators(df: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    """Add derived indicator columns with sequential ``mutate`` semantics.

    Rules apply in order and each reads the columns as left by the rules
    before it (an overwritten column is seen with its new value by later
    rules).  Independent consecutive rules are batched into one
    ``withColumns`` layer; a rule that reads or rewrites a column written in
    the current layer starts a new one.  Source columns absent from the
    input (an indicator with no rows) are treated as all-null.
    """
    missing, written, measures = set(), set(), set()
    for r in rules:
        missing |= {c for c in _rule_expr(r)[1] if c not in df.columns and c not in written}
        measures |= ({r["src"]} if "src" in r else set()) | {c for c, _ in r.get("coalesce", [])}
        written.add(r["out"])
    if missing:
        # an absent indicator is an all-null measure; an absent label is an all-null string
        df = df.withColumns({c: F.lit(None).cast("double" if c in measures else "string")
                             for c in sorted(missing)})
    layer: dict[str, Column] = {}
    for r in rules:
        expr, reads = _rule_expr(r)
        if (reads & layer.keys()) or r["out"] in layer:
            df = df.withColumns(layer)
            layer = {}
            expr, reads = _rule_expr(r)
        layer[r["out"]] = expr
    if layer:
        df = df.withColumns(layer)
    return df


def derive_long(df: DataFrame, rules: Sequence[Mapping], *,
                temp_col: str = "indicator_temp") -> DataFrame:
    """Append relabelled copies of rows that match long-form rules, in one scan.

    Each rule is ``{"label", "src", "match_col", "when"}``: a row with
    ``match_col == src`` and the predicate true gets a copy whose
    ``temp_col`` is relabelled ``src -> label`` (a row whose ``temp_col`` is
    not ``src`` keeps its label).  All copies come from one ``explode`` over
    the row's original label plus one candidate per rule.
    """
    labels = [F.col(temp_col)]
    for r in rules:
        hit = (F.col(r["match_col"]) == F.lit(r["src"])) & predicate(r["when"])
        relabel = F.when(F.col(temp_col) == F.lit(r["src"]), F.lit(r["label"])) \
                   .otherwise(F.col(temp_col))
        labels.append(F.when(F.coalesce(hit, F.lit(False)), relabel))
    return df.withColumn(temp_col, F.explode(F.array_compact(F.array(*labels))))
