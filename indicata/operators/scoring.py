"""Banded site scores computed in one aggregation, and composite scores.

The reference computes each score as its own filter/pivot/aggregate
pipeline and joins the results to the site list (13 aggregations and 13
joins).  ``score_sites`` computes every score's numerator and denominator as
conditional sums in a single ``groupBy(site)`` (one shuffle, map-side
partial sums), then bands them in a projection and joins the site list once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.functions.columns import cols
from indicata.functions.expressions import band_score, nz, ratio, row_sum
from indicata.operators.measures import fetch_scalars
from indicata.session import materialize


def score_rows(spec: Mapping, *, period: str, max_date: Column, window_max: Column,
               window_months: int, period_col: str = "period", date_col: str = "date",
               ped_col: str = "agecoarse", ped_value: str = "<15") -> Column:
    """Row condition of one score (period, trailing window or TB date)."""
    rows = spec.get("rows", "period")
    if rows == "period":
        cond = F.col(period_col) == F.lit(period)
    elif rows == "window":
        cond = F.col(date_col).between(F.add_months(window_max, -window_months), window_max)
    elif rows == "txtb":
        q = int(period.split("Q")[-1])
        anchor = max_date if q in (2, 4) else F.add_months(max_date, -3)
        cond = F.col(date_col) == anchor
    else:
        raise ValueError(f"unknown rows selector {rows!r}")
    if spec.get("ped"):
        cond = cond & (F.col(ped_col) == F.lit(ped_value))
    return cond


def score_sites(base: DataFrame, *, site: str, period: str, scores: Sequence[Mapping],
                window_months: int = 9, indicator: str = "indicator", value: str = "value",
                period_col: str = "period", date_col: str = "date",
                ped_col: str = "agecoarse", ped_value: str = "<15") -> DataFrame:
    """All fact-based scores per site in one aggregation (one pass over the fact).

    ``base`` is the long base (site, indicator, value, period, date, ...)
    with null values already removed.  Returns one row per site having rows
    in any score, with ``value_<name>`` and ``score_<name>`` columns.

    Missing-side semantics per score (see the rule set): ``fill0`` treats a
    missing numerator/denominator as 0 (pivot then sum); otherwise it stays
    null (sum then pivot).  0/0 and null ratios fall to the default band 0.
    """
    # One pass over the fact: pre-aggregate to the scoring grain (site x
    # indicator x period x date x age band), written once to the shared
    # folder.  The bounds and the conditional sums then read that small table,
    # instead of each re-reading the fact.
    keys = [site, indicator, period_col, date_col] + ([ped_col] if ped_col in base.columns else [])
    grain = materialize(base.groupBy(*keys).agg(F.sum(value).alias(value)))
    b = fetch_scalars(grain.agg(
        F.max(F.when(F.col(period_col) == F.lit(period), F.col(date_col))).alias("p"),
        F.max(date_col).alias("w")))
    max_date, window_max = b["p"], b["w"]
    base = grain
    aggs, any_rows = [], []
    for s in scores:
        cond = score_rows(s, period=period, max_date=max_date, window_max=window_max,
                          window_months=window_months, period_col=period_col,
                          date_col=date_col, ped_col=ped_col, ped_value=ped_value)
        n = s["name"]
        aggs.append(F.sum(F.when(cond & (F.col(indicator) == s["num"]), F.col(value)))
                    .alias(f"__n_{n}"))
        sides = [s["num"]]
        if s["kind"] == "ratio":
            aggs.append(F.sum(F.when(cond & (F.col(indicator) == s["den"]), F.col(value)))
                        .alias(f"__d_{n}"))
            sides.append(s["den"])
        any_rows.append(cond & F.col(indicator).isin(sides))
    relevant = base.filter(_any(any_rows))
    agg = relevant.groupBy(site).agg(*aggs)
    out_cols = [F.col(site)]
    for s in scores:
        n = s["name"]
        if s["kind"] == "sum":
            v = F.col(f"__n_{n}")
        elif s.get("fill0", True):
            v = ratio(nz(f"__n_{n}"), nz(f"__d_{n}"))
        else:
            num = nz(f"__n_{n}") if s.get("num_fill0") else F.col(f"__n_{n}")
            v = ratio(num, F.col(f"__d_{n}"))
        out_cols += [v.alias(f"value_{n}"), band_score(v, s["bands"]).alias(f"score_{n}")]
    return agg.select(*out_cols)


def _any(conds: Sequence[Column]) -> Column:
    out = F.coalesce(conds[0], F.lit(False))
    for c in conds[1:]:
        out = out | F.coalesce(c, F.lit(False))
    return out


def composite(df: DataFrame, *, total: str = "score_clin", subset: str = "score_clin_wo_volume",
              subset_patterns: Sequence[str] = (), prefix: str = "score") -> DataFrame:
    """Null scores -> 0, then the total of all scores and of a name-matched subset.

    The subset is every score column whose name *contains* one of
    ``subset_patterns`` (patterns that match nothing add nothing).
    """
    score_cols = cols(df, starts=prefix)
    df = df.withColumns({c: nz(c) for c in score_cols})
    sub = [c for c in score_cols if any(p.lower() in c.lower() for p in subset_patterns)]
    return df.withColumns({total: row_sum(score_cols), subset: row_sum(sub)})


def site_volume(df: DataFrame, *, site: str, value: str, bands: Sequence[Sequence],
                default: str) -> DataFrame:
    """Site volume class (label bands) from a summed measure per site."""
    summed = df.groupBy(site).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias("__v"))
    return summed.select(site, band_score("__v", bands, default).alias("site_volume"))
