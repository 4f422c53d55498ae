"""Domain recodes as Column expressions (age bands, population type, ...).

The literal labels come from :mod:`indicata.plans.rules`; each builder takes
them as parameters so another rule set can be swapped in.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from indicata.functions.expressions import ColumnOrName, col, is_in
from indicata.plans import rules as R


def age_band_50plus(age: ColumnOrName, *, period: ColumnOrName | None = None,
                    only_periods: Iterable[str] | None = None,
                    bands: Iterable[str] = R.AGES_50_PLUS, label: str = "50+") -> Column:
    """Collapse the 50-54 ... 65+ bands into "50+" (optionally in some periods only)."""
    cond = is_in(age, bands)
    if only_periods is not None:
        cond = cond & is_in(period, only_periods)
    return F.when(cond, F.lit(label)).otherwise(col(age))


def age_coarse(age: ColumnOrName, *, under15: Iterable[str] = R.AGES_UNDER_15,
               unknown: str = "Unknown", unknown_label: str = "Unknown Age") -> Column:
    """"<15" for the child bands, ``unknown_label`` for "Unknown", else "15+".

    As in the original ``case_when``, a null age falls to the default "15+".
    """
    a = col(age)
    return (F.when(is_in(a, under15), F.lit("<15"))
             .when(a == unknown, F.lit(unknown_label))
             .otherwise(F.lit("15+")))


def unknown_label(c: ColumnOrName, label: str, *, all_to_null: bool = False) -> Column:
    """"Unknown" -> ``label`` (e.g. "Unknown Age"); optionally "All" -> null."""
    x = col(c)
    out = F.when(x == "Unknown", F.lit(label))
    if all_to_null:
        out = out.when(x == "All", F.lit(None).cast("string"))
    return out.otherwise(x)


def pop_type(disaggregate: ColumnOrName) -> Column:
    """"LW" for breastfeeding, "PW" for pregnant, else "Age/Sex" (first match wins)."""
    d = col(disaggregate)
    return (F.when(d.contains("Breastfeeding"), F.lit("LW"))
             .when(d.contains("Pregnant"), F.lit("PW"))
             .otherwise(F.lit("Age/Sex")))


def null_for_pregnancy(c: ColumnOrName, pop: ColumnOrName) -> Column:
    """Age and sex are not reported for PW/LW rows."""
    return F.when(is_in(pop, ["PW", "LW"]), F.lit(None).cast("string")).otherwise(col(c))


def funding_agency(partner: ColumnOrName,
                   mapping: Mapping[str, str] = R.FUNDING_AGENCY,
                   default: str = R.FUNDING_AGENCY_DEFAULT) -> Column:
    """Funding agency from the partner name, with a default agency."""
    p = col(partner)
    expr = None
    for k, v in mapping.items():
        expr = F.when(p == k, F.lit(v)) if expr is None else expr.when(p == k, F.lit(v))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def site_type(partner: ColumnOrName, *, variant: int = 1,
              clinical: Iterable[str] = R.CLINICAL_PARTNERS_SITE_TYPE) -> Column:
    """Site support type: clinical partner, sustainability, or non-clinical.

    Variant 1: clinical -> "99-AJUDA", "MISAU" -> "01-Sustainability",
    else "non-clinical".  Variant 2: everything not clinical is
    "01-Sustainability".
    """
    p = col(partner)
    expr = F.when(is_in(p, clinical), F.lit("99-AJUDA"))
    if variant == 1:
        return expr.when(p == "MISAU", F.lit("01-Sustainability")).otherwise(F.lit("non-clinical"))
    return expr.otherwise(F.lit("01-Sustainability"))


def support_class(clinical_partner: ColumnOrName, nonclinical_partner: ColumnOrName,
                  clinical: Iterable[str] = R.CLINICAL_PARTNERS_SUPPORT) -> Column:
    """Site support classification from two nullable partner columns."""
    a, b = col(clinical_partner), col(nonclinical_partner)
    return (F.when(a.isNull() & b.isNull(), F.lit("No Support"))
             .when(a.isNull() & b.isNotNull(), F.lit("Other Donor Support"))
             .when(is_in(a, clinical), F.lit("AJUDA")))
