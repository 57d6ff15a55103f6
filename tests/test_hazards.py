"""Hand-made fixtures for the semantic hazards and FIXTURES 6."""

from decimal import Decimal

from helpers import D, d, pay, rows, sub, table
from recurra.operators import (
    billing,
    churn,
    cohort,
    economics,
    measures,
    quality,
    revenue,
    support,
)


def test_q02_gap_zero_previous_and_failures_only_month(spark):
    p = table(spark, "payments", [
        pay(1, when="2025-01-05 00:00:00", amount=0),
        pay(2, when="2025-02-05 00:00:00", amount=50),
        pay(3, when="2025-03-05 00:00:00", amount=70, status="Failed"),   # only failures
        pay(4, when="2025-05-05 00:00:00", amount=20),                    # April missing
    ])
    got = rows(revenue.q02_mrr_mom(p), "record_month", "net_monthly_mrr", "mom_variance",
               "mom_growth_percent")
    assert got == [
        (d("2025-01-01"), 0.0, None, None),
        (d("2025-02-01"), 50.0, 50.0, None),        # previous month is 0 -> NULL growth
        (d("2025-03-01"), 0.0, -50.0, -100.0),      # month with only failures is 0
        (d("2025-05-01"), 20.0, 20.0, None),        # LAG is the previous row, not calendar
    ]


def test_q10_nrr_month_gap_and_31st(spark):
    p = table(spark, "payments", [
        pay(1, sid=1, when="2025-01-31 00:00:00", amount=100),
        pay(2, sid=1, when="2025-02-28 00:00:00", amount=120),  # the month after the 31st
        pay(3, sid=1, when="2025-04-15 00:00:00", amount=90),   # March missing -> prev 0
        pay(4, sid=2, when="2025-02-01 00:00:00", amount=10),   # new subscription
    ])
    got = {r.payment_month: (r.starting_mrr, r.ending_mrr, r.net_revenue_retention_percent)
           for r in revenue.q10_nrr(p).collect()}
    assert got[d("2025-01-01")] == (0.0, 100.0, None)
    assert got[d("2025-02-01")] == (100.0, 130.0, 130.0)
    assert got[d("2025-04-01")] == (0.0, 90.0, None)


def test_q04_ties_broken_by_amount_then_id(spark):
    p = table(spark, "payments", [
        pay(3, sid=1, when="2025-01-01 00:00:00", amount=30),
        pay(1, sid=1, when="2025-01-01 00:00:00", amount=10),
        pay(2, sid=1, when="2025-02-01 00:00:00", amount=5),
        pay(4, sid=1, when="2025-02-01 00:00:00", amount=25, status="Failed"),
    ])
    got = rows(revenue.q04_expansion(p), "payment_month", "expansion_mrr", "contraction_mrr",
               "net_expansion_mrr")
    # order: (01-01,10), (01-01,30), (02-01,5): +20 in January, -25 in February
    assert got == [(d("2025-01-01"), 20.0, 0.0, 20.0), (d("2025-02-01"), 0.0, 25.0, -25.0)]


def test_q06_ntile_uneven_with_ties(spark):
    s = table(spark, "subscriptions", [
        sub(i, uid=i, status="Churned", start="2025-01-01", end="2025-01-31", price=p)
        for i, p in enumerate([5, 5, 5, 4, 3, 3, 2, 1, 1, 1, 1, 1, 1], start=1)])
    got = rows(economics.q06_ltv_deciles(s, as_of="2026-01-01"), "spend_decile",
               "subscriber_count", "decile_combined_revenue")
    # 13 users -> the first 3 tiles hold 2 users, the other 7 hold 1
    assert [c for _, c, _ in got] == [2, 2, 2, 1, 1, 1, 1, 1, 1, 1]
    assert sum(r for _, _, r in got) == 33.0


def test_q12_zero_sd_gives_no_outliers(spark):
    s = table(spark, "subscriptions", [sub(i, price=10) for i in range(1, 5)])
    pl = table(spark, "plans", [{"plan_id": 1, "plan_name": "Basic", "monthly_price": D(10),
                                 "target_segment": "SMB", "max_seats": 5}])
    assert economics.q12_outliers(s, pl).count() == 0


def test_q17_null_resolution_in_denominator_only(spark):
    t = table(spark, "support_tickets", [
        {"ticket_id": 1, "user_id": 1, "priority": "High", "category": "Billing",
         "first_response_hours": D(1), "resolution_hours": D(10)},
        {"ticket_id": 2, "user_id": 1, "priority": "High", "category": "Billing",
         "first_response_hours": D(3), "resolution_hours": None},
        {"ticket_id": 3, "user_id": 1, "priority": "Low", "category": "Billing",
         "first_response_hours": D(2), "resolution_hours": D(30)},
        {"ticket_id": 4, "user_id": 1, "priority": "Medium", "category": "Billing",
         "first_response_hours": D(2), "resolution_hours": D(24)},
    ])
    got = rows(support.q17_sla(t), "priority", "total_tickets", "avg_resolution_hours",
               "resolved_within_24h", "sla_resolution_rate_percent")
    # H20 and H21: text order of priority descending is Medium, Low, High
    assert got == [("Medium", 1, 24.0, 1, 100.0), ("Low", 1, 30.0, 0, 0.0),
                   ("High", 2, 10.0, 1, 50.0)]


def test_cohort_matrix_month0_missing_is_null(spark):
    u = table(spark, "users", [
        {"user_id": 1, "region": "APAC", "acquisition_channel": "Ads", "company_size": "1-10",
         "signup_date": d("2025-01-10")},
        {"user_id": 2, "region": "APAC", "acquisition_channel": "Ads", "company_size": "1-10",
         "signup_date": d("2025-02-10")}])
    p = table(spark, "payments", [
        pay(1, uid=1, when="2025-01-15 00:00:00"), pay(2, uid=1, when="2025-03-15 00:00:00"),
        pay(3, uid=2, when="2025-03-15 00:00:00", status="Failed")])   # cohort Feb: no month 0
    m = {r.cohort_month: r for r in cohort.n5_cohort_matrix(p, u).collect()}
    assert m[d("2025-01-01")].m0 == 100.0 and m[d("2025-01-01")].m2 == 100.0
    assert m[d("2025-02-01")].m1 is None
    counts = rows(cohort.q07_cohort_counts(p, u), "cohort_month", "month_index",
                  "active_subscribers")
    assert counts == [(d("2025-01-01"), 0, 1), (d("2025-01-01"), 2, 1)]   # Paid only


def test_dax_measures_divide_by_zero_and_blank(spark):
    s = table(spark, "subscriptions", [sub(1, status="Paused", start="2025-01-01"),
                                       sub(2, status="Active", start="2025-03-01", price=40),
                                       sub(3, status="Churned", start="2025-03-05",
                                           end="2025-04-01")])
    arpu = {r.month: r.arpu for r in measures.d03_arpu(s).collect()}
    assert arpu[d("2025-01-01")] == 0.0                       # no active user -> 0
    growth = {r.month: (r.mrr, r.mrr_growth) for r in measures.d04_mrr_growth(s).collect()}
    assert growth[d("2025-01-01")] == (None, 0.0)              # blank MRR
    assert growth[d("2025-02-01")] == (None, 0.0)              # calendar gap filled
    assert growth[d("2025-03-01")] == (40.0, 0.0)              # previous blank -> 0
    rate = {r.month: r.churn_rate for r in measures.d05_churn_rate(s).collect()}
    assert rate[d("2025-01-01")] == 0.0 and rate[d("2025-03-01")] == 0.5


def test_d06_churn_exactly_twelve_months_back_is_included(spark):
    p = table(spark, "payments", [pay(1, when="2024-02-10 00:00:00", amount=100),
                                  pay(2, when="2025-02-10 00:00:00", amount=100)])
    c = spark.createDataFrame(
        [(1, 1, d("2024-02-28"), "Price", Decimal("10.00")),   # = last day - 12 months
         (2, 1, d("2024-02-27"), "Price", Decimal("7.00"))],   # one day earlier: outside
        "subscription_id long, user_id long, churn_date date, churn_reason string, "
        "mrr decimal(10,2)")
    got = {r.month: r.nrr for r in measures.d06_nrr_12m(p, c).collect()}
    # Feb 2025: window [2024-02-28, 2025-02-28], both ends inclusive
    assert got[d("2025-02-01")] == (100 - 10) / 100
    grr = {r.month: r.grr for r in measures.d07_grr_12m(p, c).collect()}
    assert grr[d("2025-02-01")] == (100 - 10) / 100
    assert got[d("2024-02-01")] == 0.0                          # nothing 12 months back


def test_duplicate_rows_and_orphans(spark):
    p = table(spark, "payments", [pay(1), pay(1), pay(2, sid=9)])
    s = table(spark, "subscriptions", [sub(1)])
    v = {r.table_name: r.duplicate_full_rows for r in quality.val_tables({"payments": p}).collect()}
    assert v == {"payments": 1}
    fk = {(r.child_table, r.column_name): r.orphans
          for r in quality.aud_fk({"payments": p, "subscriptions": s}).collect()}
    assert fk[("payments", "subscription_id")] == 1
    assert billing.q14_dup_payments(p).count() == 1
    assert quality.aud_dup_key(p).collect()[0].occurrences == 2


def test_audit_rules_null_passes_checks(spark):
    from recurra.sources.schema import SUBSCRIPTIONS
    s = table(spark, "subscriptions", [sub(1, status="Gone", price=-1),
                                       sub(2, status="Churned", start="2025-02-01", end="2025-01-01"),
                                       {**sub(3), "status": None}])
    got = {(r.rule, r.column_name): r.violations for r in quality.audit(s, SUBSCRIPTIONS).collect()}
    assert got[("domain", "status")] == 1          # NULL status is not a domain violation
    assert got[("not_null", "status")] == 1
    assert got[("range>=0", "monthly_price")] == 1
    assert got[("end_after_start", "end_date")] == 1
    assert got[("unique", "subscription_id")] == 0


def test_channel_join_is_case_insensitive(spark):
    m = table(spark, "marketing_campaigns", [
        {"campaign_id": 1, "campaign_month": d("2025-01-01"), "channel": "ads",
         "spend": D(100), "trial_signups": 10, "paid_conversions": 4}])
    u = table(spark, "users", [{"user_id": 1, "region": "APAC", "acquisition_channel": "ADS",
                                "company_size": "1-10", "signup_date": d("2025-01-01")}])
    s = table(spark, "subscriptions", [sub(1, status="Churned", start="2025-01-01",
                                           end="2025-03-02", price=10)])
    r = economics.q05_ltv_cac(m, u, s).first()
    assert (r.acquisition_channel, r.average_cac) == ("ads", 25.0)
    assert r.estimated_customer_ltv == 20.0 and r.ltv_to_cac_ratio == 0.8


def test_churn_reasons_and_logo_churn(spark):
    s = table(spark, "subscriptions", [sub(1, start="2025-01-05"), sub(2, start="2025-01-20"),
                                       sub(3, start="2025-03-01")])
    c = spark.createDataFrame([(1, 1, d("2025-01-30"), "Price", Decimal("10.00"))],
                              "subscription_id long, user_id long, churn_date date, "
                              "churn_reason string, mrr decimal(10,2)")
    got = rows(churn.q03_logo_churn(s, c), "active_month", "new_signups", "churned_subscribers",
               "monthly_logo_churn_rate_percent")
    assert got == [(d("2025-01-01"), 2, 1, 50.0), (d("2025-03-01"), 1, 0, 0.0)]
    assert rows(churn.q16_churn_reasons(c), "churn_reason", "churn_percentage") == [("Price", 100.0)]


def test_rolling_seven_rows_not_days(spark):
    p = table(spark, "payments", [pay(i, when=f"2025-01-{2 * i:02d} 00:00:00", amount=i)
                                  for i in range(1, 10)])
    got = rows(revenue.q11_rolling7(p), "rolling_7day_average_inflow")
    assert got[6] == (4.0,) and got[8] == (6.0,)      # mean of the last 7 sales days


def test_measures_under_any_grouping(spark):
    s = table(spark, "subscriptions", [
        sub(1, uid=1, plan=1, status="Active", price=10), sub(2, uid=1, plan=1, status="Active", price=30),
        sub(3, uid=2, plan=2, status="Churned", end="2025-02-01", price=50),
        sub(4, uid=3, plan=2, status="Active", price=20), sub(5, uid=4, plan=3, status="Paused")])
    by_plan = {r.plan_id: (r.mrr, ) for r in measures.d01_mrr(s, by=["plan_id"]).collect()}
    assert by_plan == {1: (40.0,), 2: (20.0,), 3: (None,)}          # blank without Active
    arpu = {r.plan_id: r.arpu for r in measures.d03_arpu(s, by=["plan_id"]).collect()}
    assert arpu == {1: 40.0, 2: 20.0, 3: 0.0}                      # per distinct active user
    overall = measures.d05_churn_rate(s, by=[]).first()
    assert overall.churn_rate == 1 / 4                             # Paused excluded
    ltv = measures.d08_ltv(s, by=[]).first().ltv
    assert abs(ltv - (60 / 2) / 0.25) < 1e-9
