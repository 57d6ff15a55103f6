"""Column-expression helpers shared by every operator.

All of these are plain Spark Column expressions (codegen-friendly, no UDFs).
They pin down the semantic choices that make Spark agree with a
PostgreSQL-style reference and with the DuckDB oracle:

* rounding goes through an exact decimal, half away from zero;
* ratios are computed as double / double with a NULL (not an error) for a
  zero denominator, so ANSI mode never raises;
* month buckets are ``date`` values (first of month) built without session
  time-zone dependence (``trunc`` on a ``date``);
* tenure in the SQL queries is whole days / 30 (a 30-day month) counted up to
  an ``as_of`` date for subscriptions that are not churned with an end date.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

DateLike = str | _dt.date


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _date_lit(d: DateLike) -> Column:
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def pg_round(c: Column | str, digits: int, scale: int = 12) -> Column:
    """ROUND(x::numeric, digits) as a double: exact decimal, half away from zero.

    ``scale`` is the scale of the intermediate decimal; use a smaller one (6)
    for values that can exceed ~1e6 so double noise never reaches it.
    """
    return F.round(_col(c).cast(DecimalType(38, scale)), digits).cast("double")


def to_money(c: Column | str) -> Column:
    """Exact money type used for sums (wide enough for any total)."""
    return _col(c).cast(DecimalType(38, 2))


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / NULLIF(den, 0) evaluated in double precision (NULL on zero)."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def dax_divide(num: Column | str, den: Column | str, alternate: float = 0.0) -> Column:
    """DAX DIVIDE(a, b, alt): alt when b is 0 or blank."""
    return F.coalesce(ratio(num, den), F.lit(float(alternate)))


def month_start(c: Column | str) -> Column:
    """First day of the month as a ``date`` (works for date and timestamp_ntz)."""
    return F.trunc(F.to_date(_col(c)), "month")


def month_index(c: Column | str) -> Column:
    d = F.to_date(_col(c))
    return F.year(d) * 12 + F.month(d)


def month_diff(later: Column | str, earlier: Column | str) -> Column:
    """Whole calendar months between the months of two dates (age() year*12+month)."""
    return month_index(later) - month_index(earlier)


def subscription_end(status: Column | str, start: Column | str, end: Column | str,
                     as_of: DateLike) -> Column:
    """End of a subscription's life for tenure: its end_date when it churned with
    an end date, otherwise the as-of date (Active, Paused, churned without end)."""
    s, e = _col(status), _col(end)
    return F.when((s == "Churned") & e.isNotNull(), e).otherwise(_date_lit(as_of))


def tenure_days(status: Column | str, start: Column | str, end: Column | str,
                as_of: DateLike) -> Column:
    return F.datediff(subscription_end(status, start, end, as_of), _col(start))


def notebook_tenure_months(start: Column | str, end: Column | str, baseline: DateLike) -> Column:
    """Feature-matrix tenure: days / 30.4368 rounded to 1 decimal, at least 0.1;
    end_date when present (any status) else the baseline date."""
    days = F.datediff(F.coalesce(_col(end), _date_lit(baseline)), _col(start))
    return F.greatest(F.lit(0.1), pg_round(days.cast("double") / F.lit(30.4368), 1))
