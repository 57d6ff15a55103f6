"""Distributed operators vs their single-task definitions, and model invariants."""

import hashlib
import math
import random

import pytest

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helpers import d, rows, sub, table
from recurra.operators import cleaning, economics, kpis, profile, revenue
from recurra.operators.ranking import exact_ntile, global_row_number
from recurra.operators.sequence import lag_within


def hot_key_frame(spark, n=3000):
    """One key holds a third of all rows (the skew the operators must survive)."""
    rnd = random.Random(7)
    data = [(0 if i % 3 == 0 else rnd.randint(1, 200), rnd.randint(0, 50), i, rnd.random())
            for i in range(n)]
    return spark.createDataFrame(data, "k long, t long, id long, v double")


def test_lag_within_matches_window_on_hot_key(spark):
    df = hot_key_frame(spark)
    fast = lag_within(df, "k", ["t", "id"], "v", out="prev", num_partitions=7)
    ref = df.withColumn("prev", F.lag("v").over(W.partitionBy("k").orderBy("t", "id")))
    assert sorted(rows(fast, "id", "prev")) == sorted(rows(ref, "id", "prev"))


def test_global_row_number_and_ntile_match_window(spark):
    df = hot_key_frame(spark)
    order = [F.desc("v"), F.asc("id")]
    got = global_row_number(df, order, num_partitions=5, out="rn").select("id", "rn")
    ref = df.select("id", F.row_number().over(W.orderBy(*order)).alias("rn"))
    assert sorted(rows(got)) == sorted(rows(ref))
    for n in (3, 10, 7):
        t = exact_ntile(df, n, order, out="tile", num_partitions=6).select("id", "tile")
        r = df.select("id", F.ntile(n).over(W.orderBy(*order)).alias("tile"))
        assert sorted(rows(t)) == sorted(rows(r))


def test_lag_with_nulls_in_a_hot_key(spark):
    """NULLs of the leading order column come first for hot and other keys alike."""
    data = [(0 if i < 600 else i % 50 + 1, None if i % 50 == 0 else i % 37, i, float(i)) for i in range(900)]
    df = spark.createDataFrame(data, "k long, t long, id long, v double")
    got = lag_within(df, "k", ["t", "id"], "v", num_partitions=8)
    ref = df.withColumn("prev", F.lag("v").over(W.partitionBy("k").orderBy("t", "id")))
    assert sorted(map(repr, rows(got))) == sorted(map(repr, rows(ref)))


def test_lag_splits_a_hot_key_of_one_date(spark, monkeypatch):
    """Half of the rows share one key and one date: no window group holds much more than a
    partition's share of them, and the values are those of the plain window."""
    data = [(0 if i % 2 else None if i % 14 == 0 else i % 50 + 1, 5, i, float(i)) for i in range(4000)]
    df = spark.createDataFrame(data, "k long, t long, id long, v double")
    groups = []
    partition_by = W.partitionBy
    monkeypatch.setattr(W, "partitionBy", lambda *cols: groups.append(cols) or partition_by(*cols))
    kept = []
    drop = type(df).drop
    monkeypatch.setattr(type(df), "drop", lambda self, *cols: kept.append(self) or drop(self, *cols))
    got = lag_within(df, "k", ["t", "id"], "v", num_partitions=8)
    monkeypatch.undo()
    ref = df.withColumn("prev", F.lag("v").over(W.partitionBy("k").orderBy("t", "id")))
    assert sorted(map(repr, rows(got))) == sorted(map(repr, rows(ref)))
    assert kept[-1].groupBy(*groups[0]).count().agg(F.max("count")).first()[0] < 1000


def test_keep_first_matches_row_number_dedupe(spark):
    df = hot_key_frame(spark).withColumnRenamed("k", "x_id")
    got = cleaning.keep_first(df, "x_id", ["t", "id"])
    w = W.partitionBy("x_id").orderBy("t", "id")
    ref = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert sorted(rows(got)) == sorted(rows(ref))


@pytest.mark.parametrize("accuracy,refined", [(10_000, 1_000_000), (50, 1_000_000), (50, 20)])
def test_exact_quantiles_match_percentile(spark, monkeypatch, accuracy, refined):
    monkeypatch.setattr(profile, "REFINED_VALUES", refined)      # 20: brackets are narrowed again
    df = hot_key_frame(spark)
    got = {(r.column_name, r.q): r.value
           for r in profile.exact_quantiles(df, ["v", "t"], (0.1, 0.25, 0.5, 0.9),
                                            accuracy=accuracy).collect()}
    for c in ("v", "t"):
        ref = df.agg(F.percentile(F.col(c).cast("double"),
                                  F.array(*[F.lit(q) for q in (0.1, 0.25, 0.5, 0.9)])).alias("p")
                     ).first().p
        for q, val in zip((0.1, 0.25, 0.5, 0.9), ref):
            assert abs(got[(c, q)] - val) < 1e-9


def test_snapshot_running_sum_equals_range_join(spark):
    rnd = random.Random(3)
    subs = []
    for i in range(1, 120):
        start = f"2024-{rnd.randint(1, 12):02d}-{rnd.randint(1, 28):02d}"
        status = rnd.choice(["Active", "Churned", "Paused", "Churned"])
        end = None
        if status == "Churned" and i % 9:
            end = f"2025-{rnd.randint(1, 12):02d}-{rnd.randint(1, 28):02d}"
        if i % 17 == 0 and end:
            end = "2023-06-01"                        # end before start: never active
        subs.append(sub(i, uid=i, status=status, start=start, end=end, price=rnd.randint(1, 99)))
    s = table(spark, "subscriptions", subs)
    got = rows(kpis.kpi_monthly_snapshot(s), "month", "active_logos", "mrr")
    months = spark.createDataFrame([(m,) for m, _, _ in got], "month date")
    sm, em = F.trunc("start_date", "month"), F.trunc("end_date", "month")
    cond = (sm <= F.col("month")) & ((F.col("status") != "Churned") | (em >= F.col("month")))
    brute = (months.join(s, cond, "left").groupBy("month")
             .agg(F.count("subscription_id").alias("n"),
                  F.coalesce(F.sum("monthly_price"), F.lit(0)).cast("double").alias("m")))
    assert sorted(got) == sorted(rows(brute, "month", "n", "m"))


def test_deciles_and_expansion_invariants(spark):
    rnd = random.Random(11)
    s = table(spark, "subscriptions", [
        sub(i, uid=i % 37, status=rnd.choice(["Active", "Churned"]), start="2024-03-01",
            end="2024-09-15" if i % 2 else None, price=rnd.randint(1, 500)) for i in range(1, 200)])
    dec = rows(economics.q06_ltv_deciles(s, as_of="2025-01-01"), "subscriber_count",
               "decile_combined_revenue", "revenue_contribution_percent")
    sizes = [c for c, _, _ in dec]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 37
    total = economics.user_lifetime_spend(s, "2025-01-01").agg(F.sum("ltv")).first()[0]
    assert abs(sum(r for _, r, _ in dec) - float(total)) < 0.05
    assert abs(sum(p for _, _, p in dec) - 100.0) < 0.1
    from helpers import pay
    p = table(spark, "payments", [pay(i, sid=i % 5, when=f"2025-0{1 + i % 6}-0{1 + i % 8} 00:00:00",
                                      amount=rnd.randint(1, 99)) for i in range(60)])
    for r in revenue.q04_expansion(p).collect():
        assert abs(r.expansion_mrr - r.contraction_mrr - r.net_expansion_mrr) < 1e-9
    _ = d


def test_retry_recovery_matches_brute_force(spark):
    from helpers import pay
    from recurra.operators import extensions
    rnd = random.Random(5)
    ps = [
        pay(1, sid=1, when="2025-01-01 23:00:00", status="Failed"),
        pay(2, sid=1, when="2025-01-02 22:00:00"),                   # within 1 day: recovered
        pay(3, sid=2, when="2025-01-01 23:00:00", status="Failed"),
        pay(4, sid=2, when="2025-01-03 00:00:00"),                   # 25 h later: not
        pay(5, sid=3, when="2025-01-05 10:00:00", status="Failed"),
        pay(6, sid=3, when="2025-01-05 10:00:00"),                   # same instant: not
        pay(7, sid=4, when="2025-01-06 00:00:00", status="Failed"),
        pay(8, sid=4, when="2025-01-07 00:00:00"),                   # exactly 1 day: recovered
    ]
    for i in range(9, 400):
        ps.append(pay(i, sid=rnd.randint(1, 12),
                      when=f"2025-0{rnd.randint(1, 3)}-{rnd.randint(1, 28):02d} "
                           f"{rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:00",
                      status=rnd.choice(["Paid", "Failed"])))
    p = table(spark, "payments", ps)
    for days in (1, 3):
        got = rows(extensions.x_retry_recovery(p, days=days), "month", "failed_payments",
                   "recovered_payments", "recovered_amount")
        f = p.where("payment_status = 'Failed'").alias("f")
        q = p.where("payment_status = 'Paid'").alias("q")
        cond = ((F.col("f.subscription_id") == F.col("q.subscription_id"))
                & (F.col("q.payment_date") > F.col("f.payment_date"))
                & (F.col("q.payment_date") <= F.col("f.payment_date")
                   + F.make_dt_interval(F.lit(days))))
        ok = f.join(q, cond, "left_semi").select("payment_id").withColumn("hit", F.lit(1))
        brute = (f.join(ok, "payment_id", "left")
                 .groupBy(F.trunc(F.to_date("payment_date"), "month").alias("month"))
                 .agg(F.count(F.lit(1)).alias("a"), F.count("hit").alias("b"),
                      F.coalesce(F.sum(F.when(F.col("hit") == 1, F.col("amount"))), F.lit(0))
                      .cast("double").alias("c")))
        assert sorted(got) == sorted(rows(brute, "month", "a", "b", "c"))
        if days == 1:
            jan = [g for g in got if g[0] == d("2025-01-01")][0]
            assert jan[2] >= 2


def test_split_matches_per_class_rank_definition(spark):
    from recurra.operators import ml
    rnd = random.Random(9)
    df = spark.createDataFrame([(i, int(rnd.random() < 0.3), rnd.random()) for i in range(997)],
                               "subscription_id long, is_churned int, x double")
    got = dict(rows(ml.n5_split(df, test=0.3, seed=42).select("subscription_id", "split")))
    classes = {}
    for r in df.collect():
        classes.setdefault(r.is_churned, []).append(r.subscription_id)
    total = math.ceil(997 * 0.3)
    take = {c: int(len(ids) * 0.3) for c, ids in classes.items()}
    spare = sorted(classes, key=lambda c: (-(len(classes[c]) * 0.3 % 1), c))[:total - sum(take.values())]
    for c, ids in classes.items():
        ordered = sorted(ids, key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))
        n = take[c] + (c in spare)
        assert {got[i] for i in ordered[:n]} == {"test"} and {got[i] for i in ordered[n:]} == {"train"}
    assert sum(v == "test" for v in got.values()) == total


def test_feature_join_splits_a_hot_user(spark):
    """70 % of the subscriptions on one user: the one join of the matrix is skew-split."""
    from helpers import table
    from recurra.operators import features
    n = 60_000
    s = (spark.range(n).select(
        F.when(F.col("id") % 10 < 7, 1).otherwise(F.col("id")).alias("user_id"), F.col("id").alias("subscription_id"),
        F.lit(1).alias("plan_id"), F.lit(10).cast("decimal(10,2)").alias("monthly_price"),
        F.lit("Active").alias("status"), F.lit("2025-01-01").cast("date").alias("start_date"),
        F.lit(None).cast("date").alias("end_date")))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        empty = {t: table(spark, t, []) for t in ("users", "product_usage", "support_tickets", "payments")}
        users = spark.range(n).select(F.col("id").alias("user_id"), F.lit("S").alias("company_size"),
                                      F.lit("EU").alias("region"), F.lit("x").alias("acquisition_channel"))
        m = features.n3_feature_matrix(s, users, empty["product_usage"], empty["support_tickets"], empty["payments"])
        spread = m.repartition(4, "subscription_id")
        assert spread.count() == n
        spread.collect()
        assert "skew=true" in spread._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_xtab_counts_unlisted_priorities(spark):
    from helpers import table, ts
    t = table(spark, "support_tickets", [
        {"ticket_id": i, "user_id": 1, "created_date": ts("2025-01-01 00:00:00"), "category": "Billing",
         "priority": p} for i, p in enumerate(["High", "High", "Urgent", None])])
    assert profile.n4_ticket_xtab(t).first().asDict() == {
        "category": "Billing", "High": 2, "Low": 0, "Medium": 0, "other": 2}


def test_describe_exact_and_approximate_agree(spark):
    df = hot_key_frame(spark)
    a = {r.column_name: r for r in profile.n3_describe(df, ["v", "t"]).collect()}
    b = {r.column_name: r for r in profile.n3_describe(df, ["v", "t"], exact=False).collect()}
    for c in ("v", "t"):
        assert a[c]["count"] == b[c]["count"] == 3000
        assert abs(a[c]["mean"] - b[c]["mean"]) < 1e-9 and a[c]["max"] == b[c]["max"]
        assert abs(a[c]["p50"] - b[c]["p50"]) <= (0.01 if c == "v" else 1.0)


def test_keep_first_sends_one_row_of_a_key_per_task_without_sort_aggregates(spark):
    df = hot_key_frame(spark).withColumnRenamed("k", "x_id")
    got = cleaning.keep_first(df, "x_id", ["t", "id"])
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_rows_set_aside_pass_the_cleaner_as_they_are(spark):
    rows = [(1, 0, 5, None, None), (1, 1, 6, None, None), (1, 0, 7, "missing x", "bad"), (1, 0, 7, "missing x", "bad"),
            (2, 0, 8, "Missing", None), (None, 1, 9, None, None), (None, 0, 10, None, None), (3, 0, None, None, "bad")]
    df = spark.createDataFrame(rows, "a_id int, ingest_seq int, v int, quality_issue string, raw string")
    got = cleaning.cln_generic(df, aside_col="raw")
    assert got.columns == df.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [rows[0], rows[2], rows[3], rows[6], rows[7]]))
    assert sorted(r.v for r in cleaning.cln_generic(df.where("raw is null")).collect()) == [5, 10]
