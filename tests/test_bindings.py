"""The bound test tables against the row counts stated in FIXTURES.md (section 4 and 5)."""

import pytest
from pyspark.sql import functions as F

from recurra.operators import cleaning
from helpers import D, pay, table
from recurra.sources.bindings import BoundModel, dirty_payments

EXPECTED = {  # sf -> table -> rows (FIXTURES.md section 4)
    "0.001": {"plans": 5, "users": 150, "subscriptions": 1500, "payments": 6015,
              "churn_events": 485, "product_usage": 1000, "support_tickets": 201,
              "marketing_campaigns": 200},
    "0.01": {"plans": 5, "users": 1500, "subscriptions": 15000, "payments": 60130,
             "churn_events": 4878, "product_usage": 10000, "support_tickets": 2014,
             "marketing_campaigns": 2000},
}


@pytest.mark.parametrize("sf", sorted(EXPECTED))
def test_bound_row_counts(spark, sf):
    m = BoundModel(spark, f"/root/testdata/sf{sf}")
    got = {name: df.count() for name, df in m.tables().items()}
    assert got == EXPECTED[sf]
    assert m.payments.select("payment_id").distinct().count() == EXPECTED[sf]["payments"]


def test_dirty_fixture_cleaning_counts(spark):
    m = BoundModel(spark, "/root/testdata/sf0.01")
    raw = m.dirty_payments
    assert raw.count() == 74873
    clean = cleaning.cln_generic(raw)
    assert clean.count() == 58573
    assert clean.where(F.col("ingest_seq") != 0).count() == 0
    assert clean.select("payment_id").distinct().count() == 58573


def test_fixture_features_present(spark):
    m = BoundModel(spark, "/root/testdata/sf0.01")
    s = m.subscriptions
    assert s.where((F.col("status") == "Churned") & F.col("end_date").isNull()).count() == 55
    dup = m.payments.groupBy("subscription_id", "payment_date", "amount").count()
    assert dup.where("count > 1").count() == 130


def test_dirty_payments_derive_payments_once(spark):
    rows = [pay(101, sid=40, amount=5), pay(102, sid=41), pay(201, sid=1, amount=7), dict(pay(301, sid=2), amount=None), dict(pay(1), payment_id=None)]
    dirty = dirty_payments(table(spark, "payments", rows))
    got = sorted((r.payment_id or 0, r.ingest_seq, r.amount, r.quality_issue) for r in dirty.where("amount is not null").collect())
    assert got == [(0, 0, D(10), None), (101, 0, D(5), "Missing amount"), (101, 1, D(6), "Missing amount"),
                   (102, 0, D(10), "outlier"), (201, 0, D(7), None), (201, 1, D(8), None)]
    assert dirty.where("payment_id = 301").count() == 2
    plan = dirty_payments(BoundModel(spark, "/root/testdata/sf0.001").payments)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
