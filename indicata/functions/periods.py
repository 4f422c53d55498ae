"""Fiscal-period arithmetic.

The fiscal year starts in October: October-December is Q1 of the next
year, January-March Q2, April-June Q3, July-September Q4.  A period is the
string ``"<fy> Q<n>"`` (the year first, so its string max is the latest
period) and its reporting date is the 20th of the quarter's last month.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from indicata.functions.expressions import ColumnOrName, col

# Reporting day of month, and the month that closes each quarter.
REPORTING_DAY = 20
QUARTER_END_MONTH = {1: 12, 2: 3, 3: 6, 4: 9}


def fiscal_year(date: ColumnOrName) -> Column:
    """Fiscal year of a calendar date (int)."""
    return F.year(F.add_months(F.to_date(col(date)), 3)).cast("int")


def fiscal_quarter(date: ColumnOrName) -> Column:
    """Fiscal quarter 1-4 of a calendar date (int)."""
    return F.quarter(F.add_months(F.to_date(col(date)), 3)).cast("int")


def period_label(fy: ColumnOrName, q: ColumnOrName) -> Column:
    """``"2024 Q4"``; null if either part is null (``str_c`` semantics)."""
    return F.concat(col(fy).cast("int").cast("string"), F.lit(" Q"),
                    col(q).cast("int").cast("string"))


def quarter_number(period: ColumnOrName) -> Column:
    """The quarter 1-4 named in a period string, or null if it names none.

    Accepts "2024 Q4", "FY24Q4" or "Q4" (the first ``Q<digit>`` counts).
    """
    digit = F.regexp_extract(col(period), r"Q([1-4])", 1)
    return F.when(digit != "", digit.cast("int"))


def period_date(fy: ColumnOrName, q: ColumnOrName) -> Column:
    """Reporting date of (fiscal year, quarter): Q1 -> Dec 20 of fy-1, ..."""
    q_c = col(q).cast("int")
    first = F.make_date(col(fy).cast("int"), F.lit(1), F.lit(REPORTING_DAY))
    # each argument is named once or twice: filters on the date repeat it wherever they are moved to
    return F.when(q_c.isin(*QUARTER_END_MONTH), F.add_months(first, q_c * 3 - 4))


def shifted(fy: ColumnOrName, q: ColumnOrName, k: ColumnOrName) -> tuple[Column, Column]:
    """(fy, q) moved by ``k`` quarters; integer arithmetic, no string recodes."""
    idx = col(fy).cast("int") * 4 + col(q).cast("int") - 1 + col(k).cast("int")
    return F.shiftright(idx, 2), idx.bitwiseAND(F.lit(3)) + 1


def with_fiscal_period(df, date_col: str, fy: str = "fy", q: str = "q",
                       period: str = "period", date: str = "date"):
    """Add fy, q, period and the reporting date from a calendar date."""
    return (df.withColumns({fy: fiscal_year(date_col), q: fiscal_quarter(date_col)})
              .withColumns({period: period_label(fy, q), date: period_date(fy, q)}))


def split_period(df, period: str = "period", fy: str = "fy", quarter: str = "quarter"):
    """Split "2024 Q4" into fy (int) and quarter ("Q4"), keeping the original."""
    return df.withColumns({
        fy: F.split_part(F.col(period), F.lit(" "), F.lit(1)).try_cast("int"),
        quarter: F.split_part(F.col(period), F.lit(" "), F.lit(2)),
    })


def fiscal_period_columns(df, column: str, *, from_date: bool = False) -> tuple[Column, Column]:
    """(fy, q) columns from a period string ("2024 Q4") or from a calendar date."""
    if from_date:
        return fiscal_year(column), fiscal_quarter(column)
    return (F.split_part(F.col(column), F.lit(" "), F.lit(1)).try_cast("int"),
            quarter_number(column))


def period_range(period: str) -> tuple[str, str]:
    """Calendar [start, end) of a fiscal period string, for source pushdown."""
    fy_s, q_s = period.split(" Q")
    fy, q = int(fy_s), int(q_s)
    start_month = {1: 10, 2: 1, 3: 4, 4: 7}[q]
    start_year = fy - 1 if q == 1 else fy
    end_month, end_year = start_month + 3, start_year
    if end_month > 12:
        end_month, end_year = end_month - 12, end_year + 1
    return f"{start_year:04d}-{start_month:02d}-01", f"{end_year:04d}-{end_month:02d}-01"


def suffix_denominator(indicator: ColumnOrName, numeratordenom: ColumnOrName) -> Column:
    """``indicator`` + "_D" for denominator rows."""
    return F.concat(col(indicator),
                    F.when(F.coalesce(col(numeratordenom) == "D", F.lit(False)), F.lit("_D"))
                     .otherwise(F.lit("")))
