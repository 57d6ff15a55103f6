"""Hand-made fixtures for KPI tables, report strings and extensions."""

from decimal import Decimal

from helpers import D, d, pay, rows, sub, table
from recurra.operators import extensions, kpis, report


def test_snapshot_with_explicit_months(spark):
    s = table(spark, "subscriptions", [
        sub(1, start="2024-12-15", price=10),                                  # active from Dec
        sub(2, status="Churned", start="2025-01-10", end="2025-02-20", price=5),  # Jan..Feb
        sub(3, status="Churned", start="2025-01-10", end=None, price=7),       # never counted
        sub(4, status="Paused", start="2025-03-01", price=2)])
    got = rows(kpis.kpi_monthly_snapshot(s, from_month="2025-01-01", to_month="2025-04-01"),
               "month", "active_logos", "mrr", "arr")
    assert got == [(d("2025-01-01"), 2, 15.0, 180.0), (d("2025-02-01"), 2, 15.0, 180.0),
                   (d("2025-03-01"), 2, 12.0, 144.0), (d("2025-04-01"), 2, 12.0, 144.0)]


def test_billing_schedule_and_months_active(spark):
    s = table(spark, "subscriptions", [
        sub(1, status="Churned", start="2025-01-01", end="2025-03-02", price=10),  # 60 days
        sub(2, status="Active", start="2025-12-20", price=20),                    # 12 days
        sub(3, status="Active", start="2025-10-01", price=30)])                   # 92 days
    months = dict(rows(kpis.gen_months_active(s, as_of="2026-01-01"),
                       "subscription_id", "months_active"))
    assert months == {1: 2, 2: 1, 3: 3}                                  # floor 1
    sched = rows(kpis.gen_billing_schedule(s, as_of="2026-01-01").orderBy(
        "subscription_id", "billing_seq"), "subscription_id", "billing_date", "amount")
    assert sched[:2] == [(1, d("2025-01-01"), 10.0), (1, d("2025-01-31"), 10.0)]
    assert len(sched) == 6 and sched[-1] == (3, d("2025-11-30"), 30.0)


def test_report_strings(spark):
    months = spark.createDataFrame(
        [(d("2025-03-01"), 1234567.5, -2000.25, -0.16), (d("2025-02-01"), 5.0, 0.0, None),
         (d("2025-01-01"), 5.0, None, None)],
        "month date, mrr double, mom_variance double, mom_growth_percent double")
    got = {r.month: r for r in report.r5_format_months(months).collect()}
    m = got["2025-03-01"]
    assert (m.mrr_text, m.variance_text, m.growth_text, m.trend) == (
        "$1,234,567.50", "$-2,000.25", "-0.16%", "down")
    f = got["2025-02-01"]
    assert (f.variance_text, f.growth_text, f.trend) == ("+$0.00", "0.0%", "up")
    assert got["2025-01-01"].variance_text == "$nan"
    plans = spark.createDataFrame([("Pro", 1200, 98429.0, 119.6)],
                                  "plan string, active_logos long, mrr double, arpu double")
    p = report.r5_format_plans(plans).first()
    assert (p.active_logos_text, p.mrr_text, p.arpu_text) == ("1,200", "$98,429.00", "$119.60")


def test_engagement_target_and_forecast(spark):
    s = table(spark, "subscriptions", [sub(1, uid=1, plan=1, price=499), sub(2, uid=2, plan=1, price=499),
                                       sub(3, uid=3, plan=1, price=15)])
    pl = table(spark, "plans", [{"plan_id": 1, "plan_name": "Top", "monthly_price": D(499),
                                 "target_segment": "Enterprise", "max_seats": 9}])
    pu = table(spark, "product_usage", [
        {"log_id": 1, "user_id": 1, "event_date": d("2025-12-05"), "feature": "a",
         "active_minutes": 100, "events": 1},
        {"log_id": 2, "user_id": 2, "event_date": d("2025-11-05"), "feature": "a",
         "active_minutes": 100, "events": 1}])                     # outside the window
    got = rows(extensions.x_engagement_target(s, pl, pu, window_start="2025-12-01"),
               "subscription_id", "minutes_in_window")
    assert got == [(2, 0)]                                          # 3 is below the price floor
    monthly = spark.createDataFrame([(d("2025-01-01"), Decimal("100")), (d("2025-02-01"), Decimal("110")),
                                     (d("2025-03-01"), Decimal("120"))], "month date, mrr decimal(12,2)")
    fc = rows(extensions.x_trend_forecast(monthly, horizon=2), "month", "forecast")
    assert fc == [(d("2025-04-01"), 130.0), (d("2025-05-01"), 140.0)]
    _ = pay
