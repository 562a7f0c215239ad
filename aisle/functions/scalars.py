"""Column helpers for the dialect rules the suite depends on.

Output typing (shared with the DuckDB oracle): money sums are
``decimal(38,2)``; averages, ratios and deviations are doubles rounded
to 4 places; counts are ``bigint``.  ANSI mode is on, so every division
by a value that can be zero goes through ``safe_div``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_sum(c) -> Column:
    """Exact decimal sum, typed ``decimal(38,2)``."""
    return F.sum(col(c)).cast("decimal(38,2)")


def r4(c) -> Column:
    """Double rounded half away from zero to 4 places, by the same steps on
    doubles as DuckDB's ``round(x, 4)``: for deviations and the like, which
    have no exact decimal value.  Averages and ratios of sums go through
    ``quotient4``."""
    return F.round(col(c).cast("double") * 10000) / 10000


def quotient4(n, d, places: int = 2) -> Column:
    """``n / d`` rounded half away from zero to 4 places, exactly; NULL where
    ``d`` is 0.  Both have at most ``places`` decimal places.  They are scaled
    to whole numbers, so the one division of doubles is correctly rounded and
    ends in one half if and only if the true quotient does (whole numbers up
    to 2^53)."""
    exact = f"decimal(38,{places})"
    whole = (col(n).cast(exact) * F.lit(10 ** (4 + places))).cast("double")
    return F.when(col(d) != 0, F.round(whole / (col(d).cast(exact) * F.lit(10 ** places)).cast("double")) / 10000)


def mean(c) -> Column:
    """Average as sum / count.  On decimals this keeps the division's full
    scale (``avg`` would round to the input scale + 4 first, and rounding
    that again to 4 places can differ from rounding the exact mean); on
    integers and doubles it is the same double as ``avg``.  NULL when there
    is nothing to average."""
    n = F.count(col(c))
    return F.when(n > 0, F.sum(col(c)) / n)


def mean_over(c, w) -> Column:
    """Mean over the window ``w`` as a double: the exact sum divided once."""
    n = F.count(col(c)).over(w)
    return F.when(n > 0, F.sum(col(c)).over(w).cast("double") / n)


def avg4(c) -> Column:
    return quotient4(F.sum(col(c)), F.count(col(c)))


def avg4_over(c, w) -> Column:
    return quotient4(F.sum(col(c)).over(w), F.count(col(c)).over(w))


def stddev4(c) -> Column:
    return r4(F.stddev_samp(col(c)))


def safe_div(n, d) -> Column:
    """``n / d`` when ``d`` > 0, else NULL (the CASE guard of the suite)."""
    return F.when(col(d) > 0, col(n) / col(d))


def int_div(n, d) -> Column:
    """Integer division that truncates, as the suite's dialect does for int / int."""
    n, d = col(n).cast("long"), col(d).cast("long")
    return ((n - n % d) / d).cast("long")  # exact: n - n % d is a multiple of d


def round_to_int(c) -> Column:
    """Decimal to int with rounding (the suite's dialect rounds, Spark's cast truncates)."""
    return F.round(col(c)).cast("int")


def days_key(d) -> Column:
    """Day number of a date (2450815 = 1998-01-01), the ``*_date_sk`` domain."""
    return F.lit(2450815) + F.datediff(col(d), F.lit("1998-01-01").cast("date"))
