"""Dashboard measures (DAX-style) as aggregate expressions usable under any grouping.

DAX rules kept: DIVIDE(a, b, 0) -> 0 when b is 0/blank; blank acts as 0 in +/-.
Calendar context: one calendar month; payments by payment_date, churn by
churn_date, subscriptions by start_date (the measures' relationships are not
defined in the reference; this is the documented choice).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recurra.functions import dax_divide, month_start, to_money
from recurra.operators.kpis import calendar_months

def _is(status: str) -> Column:
    return F.col("status") == status


def _by(df: DataFrame, by: Sequence[str | Column], *aggs: Column) -> DataFrame:
    """Evaluate measure aggregates under a grouping (``[]`` = the whole table)."""
    return df.groupBy(*by).agg(*aggs)


def _default(by, default):
    return default if by is None else by


def _mrr() -> Column:
    """Blank (NULL) when the context has no Active subscription, as in DAX."""
    return F.sum(F.when(_is("Active"), to_money("monthly_price")))


def _churn_rate() -> Column:
    churned = F.count(F.when(_is("Churned"), 1))
    active = F.count(F.when(_is("Active"), 1))
    return dax_divide(churned, active + churned)


def _arpu() -> Column:
    return dax_divide(_mrr(), F.countDistinct(F.when(_is("Active"), F.col("user_id"))))


def start_month() -> Column:
    return month_start("start_date").alias("month")


def d01_mrr(s: DataFrame, by=None) -> DataFrame:
    return _by(s, _default(by, [start_month()]), _mrr().cast("double").alias("mrr"))


def d02_arr(s: DataFrame, by=None) -> DataFrame:
    return _by(s, _default(by, [start_month()]), (_mrr() * 12).cast("double").alias("arr"))


def d03_arpu(s: DataFrame, by=None) -> DataFrame:
    return _by(s, _default(by, [start_month()]), _arpu().alias("arpu"))


def d05_churn_rate(s: DataFrame, by=None) -> DataFrame:
    return _by(s, _default(by, [start_month()]), _churn_rate().alias("churn_rate"))


def d08_ltv(s: DataFrame, by=None) -> DataFrame:
    return _by(s, _default(by, [start_month()]), dax_divide(_arpu(), _churn_rate()).alias("ltv"))


def d10_retention(s: DataFrame, by=None) -> DataFrame:
    return _by(s, _default(by, [start_month()]), (F.lit(1.0) - _churn_rate()).alias("retention_rate"))


def d09_trial_conv(m: DataFrame, by=None) -> DataFrame:
    return _by(m, _default(by, ["channel"]),
               dax_divide(F.sum("paid_conversions"), F.sum("trial_signups"))
               .alias("trial_conversion_rate"))


def d11_expansion(p: DataFrame, by=None) -> DataFrame:
    keep = (F.col("amount") > 0) & (F.col("payment_status") == "Paid")
    return _by(p, _default(by, [month_start("payment_date").alias("month")]),
               F.sum(F.when(keep, to_money("amount"))).cast("double").alias("expansion_revenue"))


def subscription_cards(s: DataFrame, by=()) -> DataFrame:
    """The subscription measures together under one filter context (``()``: grand total)."""
    return _by(s, list(by), _mrr().cast("double").alias("mrr"), (_mrr() * 12).cast("double").alias("arr"),
               _arpu().alias("arpu"), _churn_rate().alias("churn_rate"),
               dax_divide(_arpu(), _churn_rate()).alias("ltv"), (F.lit(1.0) - _churn_rate()).alias("retention_rate"))


def d04_mrr_growth(s: DataFrame) -> DataFrame:
    """MRR of each calendar month vs the month before (blank months count as 0)."""
    by_month = s.groupBy(start_month()).agg(_mrr().alias("mrr"))
    bounds = by_month.agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    cal = calendar_months(bounds)
    full = cal.join(by_month, "month", "left")
    prev = F.coalesce(F.lag("mrr").over(W.orderBy("month")), F.lit(0))   # one row per month
    # blank months act as 0 in the arithmetic
    cur = F.coalesce(F.col("mrr"), F.lit(0))
    return full.select("month", F.col("mrr").cast("double").alias("mrr"),
                       dax_divide(cur - prev, prev).alias("mrr_growth"))


def _retention_inputs(p: DataFrame, c: DataFrame, months: int) -> DataFrame:
    """Per calendar month: paid now, paid ``months`` back, churned MRR in the trailing
    window [last day - months, last day] (day exact).

    Churn is summed per day and run through a RANGE window over the day axis, so
    no month x churn-event range join is needed; every table here is per-month or
    per-day sized.
    """
    paid = (p.where(F.col("payment_status") == "Paid")
            .groupBy(month_start("payment_date").alias("month"))
            .agg(F.sum(to_money("amount")).alias("paid")))
    bounds = paid.agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    cal = calendar_months(bounds)
    back = paid.select(F.add_months("month", months).alias("month"), F.col("paid").alias("paid_back"))
    daily = c.groupBy(F.col("churn_date").alias("day")).agg(F.sum(to_money("mrr")).alias("lost"))
    ends = cal.select(F.last_day("month").alias("day"), F.lit(None).cast("decimal(38,2)").alias("lost"))
    days = daily.unionByName(ends).groupBy("day").agg(F.sum("lost").alias("lost"))
    days = days.withColumn(
        "lost_window",
        F.expr(f"sum(lost) over (order by day range between interval {months} months preceding "
               f"and current row)"))
    lost = days.select(F.trunc("day", "month").alias("month"), "day", "lost_window") \
        .where(F.col("day") == F.last_day("day")).drop("day")
    return (cal.join(paid, "month", "left").join(back, "month", "left")
            .join(lost, "month", "left"))


def d06_nrr_12m(p: DataFrame, c: DataFrame, *, months: int = 12) -> DataFrame:
    """(paid this month - churned MRR over the trailing window) / paid ``months`` back."""
    x = _retention_inputs(p, c, months)
    z = F.lit(0)
    start = F.coalesce(F.col("paid_back"), z)
    now = F.coalesce(F.col("paid"), z)
    lost = F.coalesce(F.col("lost_window"), z)
    return x.select("month", dax_divide(start + (now - start) - lost, start).alias("nrr"))


def d07_grr_12m(p: DataFrame, c: DataFrame, *, months: int = 12) -> DataFrame:
    """(paid ``months`` back - churned MRR over the trailing window) / paid back."""
    x = _retention_inputs(p, c, months)
    z = F.lit(0)
    start = F.coalesce(F.col("paid_back"), z)
    lost = F.coalesce(F.col("lost_window"), z)
    return x.select("month", dax_divide(start - lost, start).alias("grr"))


# ---- time intelligence under any grouping --------------------------------------------------

def _group_calendar(monthly: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., month): every calendar month from a group's first to its last."""
    bounds = monthly.groupBy(*by).agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    return bounds.select(*by, F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month"))


def _months_back(value: str, by: Sequence[str], months: int) -> Column:
    """The value of the calendar month ``months`` earlier in the same group, found by a RANGE
    frame of that one month (a blank month has no row there)."""
    over = f"partition by {', '.join(f'`{c}`' for c in by)} " if by else ""
    return F.expr(f"sum({value}) over ({over}order by month range between interval {months} months preceding "
                  f"and interval {months} months preceding)")


def mrr_growth(s: DataFrame, by: Sequence[str]) -> DataFrame:
    """``d04_mrr_growth`` of every group: (by..., month, mrr, mrr_growth). A group's calendar
    runs from its first to its last start month; blank months count as 0."""
    monthly = s.groupBy(*by, start_month()).agg(_mrr().alias("mrr"))
    full = _group_calendar(monthly, by).join(monthly, [*by, "month"], "left")
    prev = F.coalesce(_months_back("mrr", by, 1), F.lit(0))
    cur = F.coalesce(F.col("mrr"), F.lit(0))
    return (full.withColumn("prev", prev)
            .select(*by, "month", F.col("mrr").cast("double").alias("mrr"),
                    dax_divide(cur - F.col("prev"), F.col("prev")).alias("mrr_growth")))


def retention_12m(p: DataFrame, c: DataFrame, by: Sequence[str], *, months: int = 12) -> DataFrame:
    """``d06`` and ``d07`` of every group: (by..., month, nrr, grr).

    ``p`` and ``c`` both have the columns ``by``. Payments reduce to one row per group and month,
    churn to one per group and day; the two look-backs are RANGE frames inside a group, over its
    calendar from the first to the last paid month, so no range join is built.
    """
    paid = (p.where(F.col("payment_status") == "Paid").groupBy(*by, month_start("payment_date").alias("month"))
            .agg(F.sum(to_money("amount")).alias("paid")))
    full = (_group_calendar(paid, by).join(paid, [*by, "month"], "left")
            .withColumn("paid_back", _months_back("paid", by, months)))
    daily = c.groupBy(*by, F.col("churn_date").alias("day")).agg(F.sum(to_money("mrr")).alias("lost"))
    ends = full.select(*by, F.last_day("month").alias("day"), F.lit(None).cast("decimal(38,2)").alias("lost"))
    days = daily.unionByName(ends).groupBy(*by, "day").agg(F.sum("lost").alias("lost"))
    over = f"partition by {', '.join(f'`{x}`' for x in by)} " if by else ""
    trailing = F.expr(f"sum(lost) over ({over}order by day range between interval {months} months preceding and current row)")
    lost = (days.withColumn("lost_window", trailing).where(F.col("day") == F.last_day("day"))
            .select(*by, F.trunc("day", "month").alias("month"), "lost_window"))
    z = F.lit(0)
    now, back, gone = (F.coalesce(F.col(x), z) for x in ("paid", "paid_back", "lost_window"))
    return full.join(lost, [*by, "month"], "left").select(
        *by, "month", dax_divide(back + (now - back) - gone, back).alias("nrr"), dax_divide(back - gone, back).alias("grr"))


# ---- many filter contexts in one scan ------------------------------------------------------

def cards_by_context(s: DataFrame, by: Sequence[str]) -> DataFrame:
    """The subscription cards under every combination of the columns ``by``, from one scan:
    (by..., all_<column>..., mrr, arr, arpu, churn_rate, ltv, retention_rate).

    ``all_<column>`` is 1 where the context does not filter that column (its value is NULL
    there). Rows are first reduced to one per user and finest context; GROUPING SETS then run
    over those, once per user and once more over the users, so the distinct count of active
    users is a plain count and stays exact.
    """
    per_user = s.groupBy(*by, "user_id").agg(
        _mrr().alias("m"), F.count(F.when(_is("Active"), 1)).alias("active"),
        F.count(F.when(_is("Churned"), 1)).alias("churned"))
    sets = [[c for i, c in enumerate(by) if bits >> i & 1] for bits in range(1 << len(by))]
    per_context = per_user.groupingSets([["user_id", *some] for some in sets], "user_id", *by).agg(
        *[F.grouping(c).cast("int").alias(f"all_{c}") for c in by],
        F.sum("m").alias("m"), F.sum("active").alias("active"), F.sum("churned").alias("churned"))
    flags = [f"all_{c}" for c in by]
    sums = per_context.groupBy(*by, *flags).agg(
        F.sum("m").alias("m"), F.sum("active").alias("active"), F.sum("churned").alias("churned"),
        F.count(F.when(F.col("active") > 0, F.col("user_id"))).alias("users"))
    arpu = dax_divide("m", "users")
    rate = dax_divide("churned", F.col("active") + F.col("churned"))
    return sums.select(*by, *flags, F.col("m").cast("double").alias("mrr"), (F.col("m") * 12).cast("double").alias("arr"),
                       arpu.alias("arpu"), rate.alias("churn_rate"), dax_divide(arpu, rate).alias("ltv"),
                       (F.lit(1.0) - rate).alias("retention_rate"))
