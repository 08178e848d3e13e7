"""Salary amounts and pay periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobweft.functions.text import strip

# Pay periods in the order in which they are looked for.
SALARY_PERIODS = ["hour", "day", "week", "month", "year", "project"]


def salary_period(text: Column) -> Column:
    """First period word contained anywhere in the text; "annual" means year."""
    text = F.lower(F.coalesce(text, F.lit("")))
    period = F.when(F.contains(text, F.lit(SALARY_PERIODS[0])), SALARY_PERIODS[0])
    for word in SALARY_PERIODS[1:]:
        period = period.when(F.contains(text, F.lit(word)), word)
    return period.when(F.contains(text, F.lit("annual")), "year")


def amount(text: Column) -> Column:
    """Amount in hundredths, rounded once; NULL when absent or not a number."""
    return strip(text).try_cast("decimal(38,2)")


def amount_is_bad(text: Column) -> Column:
    """True for a value that is given but is not a number."""
    return F.coalesce((text != "") & amount(text).isNull(), F.lit(False))
