"""Distinct-count states, interval joins, grouped measures, exact AUC, running sums."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import D, d, pay, sub, table
from recurra.operators import distinct, intervals, measures, ml, quality, ranking, revenue
from recurra.sources.colocated import Colocated, store_colocated


def listed(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_states_merge_and_roll_up_exactly(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice("abc"), rnd.choice([1, 2, None]), rnd.choice([None, 0, -5, -32768, -32769, 1, 32768, 32769, 10**12,
             rnd.randrange(10**5)])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, h int, id long")
    state = distinct.distinct_state(df, ["g", "h"], "id")
    for by in (["g", "h"], ["g"], ["h"], []):
        want = df.where("id is not null").groupBy(*by).agg(F.countDistinct("id").alias("n"))
        assert listed(distinct.distinct_counts(state, by)) == listed(want)
    halves = [distinct.distinct_state(df.where(F.col("id").isNull() | (F.col("id") % 2 == k)), ["g", "h"], "id") for k in (0, 1, -1)]
    merged = distinct.merge_state(halves[0].unionByName(halves[1]).unionByName(halves[2]).unionByName(halves[0]), ["g", "h"])
    assert listed(distinct.distinct_counts(merged, ["g"])) == listed(distinct.distinct_counts(state, ["g"]))


def test_states_of_nothing(spark):
    empty = distinct.distinct_state(spark.createDataFrame([], "g string, id long"), ["g"], "id")
    assert distinct.distinct_counts(empty, ["g"]).count() == 0
    assert distinct.distinct_counts(empty, []).first().n == 0
    rows = distinct.paying_rollup(distinct.paying_state(table(spark, "payments", [pay(1, uid=7), pay(2, uid=7, plan=2)]))).collect()
    assert sorted((str(r.month), r.plan_id or 0, r.paying_customers) for r in rows) == [
        ("2025-01-01", 0, 1), ("2025-01-01", 1, 1), ("2025-01-01", 2, 1), ("None", 0, 1), ("None", 1, 1), ("None", 2, 1)]


def test_overlap_join_matches_brute_force(spark):
    rnd = random.Random(8)

    def make(n, keys):
        out = []
        for i in range(n):
            a = rnd.randrange(700)
            out.append((rnd.choice(keys), i, f"2024-{1 + a % 12:02d}-{1 + a % 28:02d}",
                        rnd.choice([None, f"{2024 + rnd.randrange(2)}-{rnd.randint(1, 12):02d}-{rnd.randint(1, 28):02d}"])))
        return out
    a, b = make(150, [1, 2, None]), make(150, [1, 2, 3, None])
    left = spark.createDataFrame(a, "k int, i int, s string, e string").select("k", "i", F.to_date("s").alias("s"), F.to_date("e").alias("e"))
    right = spark.createDataFrame(b, "k int, j int, x string, y string").select("k", "j", F.to_date("x").alias("x"), F.to_date("y").alias("y"))
    got = intervals.overlap_join(left, right, "k", ("s", "e"), ("x", "y"))
    want = sorted((i, j) for k, i, s, e in a for q, j, x, y in b
                  if k is not None and k == q and e and y and s <= e and x <= y and s <= y and x <= e)
    assert sorted((r.i, r.j) for r in got.collect()) == want and len(want) > 100
    points = right.select("k", "j", "x")
    got = intervals.overlap_join(left, points, "k", ("s", "e"), ("x", "x"))
    want = sorted((i, j) for k, i, s, e in a for q, j, x, _ in b if k is not None and k == q and e and s <= x <= e)
    assert sorted((r.i, r.j) for r in got.collect()) == want
    with pytest.raises(ValueError):
        intervals.overlap_join(left, left, "k", ("s", "e"), ("s", "e"))


def test_hot_user_is_split_and_no_range_join_is_built(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        user = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
        day = F.date_add(F.lit(d("2025-01-01")), (F.col("id") % 25).cast("int"))
        events = spark.range(0, 20_000, 1, 8).select(user.alias("user_id"), day.alias("day"), F.col("id").alias("e"))
        runs = spark.range(0, 2_000, 1, 4).select(F.col("id").alias("user_id"), F.lit(d("2025-01-03")).alias("a"),
                                                  F.lit(d("2025-01-20")).alias("b"), F.col("id").alias("r"))
        joined = intervals.overlap_join(runs, events, "user_id", ("a", "b"), ("day", "day"))
        n = joined.count()
        frame = joined.groupBy().count()
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan and "skew=true" in plan
        hit = (F.dayofmonth("day") >= 3) & (F.dayofmonth("day") <= 20)
        assert n == events.where(hit & (F.col("user_id") < 2000)).count()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_growth_by_group_counts_blank_months_as_zero(spark):
    rows = [dict(sub(1, plan=1, start="2025-01-10", price=10), region="x"), dict(sub(2, plan=1, start="2025-03-01", price=30), region="x"),
            dict(sub(3, plan=2, start="2025-03-05", price=5, status="Churned"), region="x"), dict(sub(4, plan=2, start="2025-04-05", price=8), region="x")]
    got = measures.mrr_growth(table(spark, "subscriptions", rows), ["plan_id"]).orderBy("plan_id", "month").collect()
    assert [(r.plan_id, str(r.month)[:7], r.mrr, r.mrr_growth) for r in got] == [
        (1, "2025-01", 10.0, 0.0), (1, "2025-02", None, -1.0), (1, "2025-03", 30.0, 0.0), (2, "2025-03", None, 0.0), (2, "2025-04", 8.0, 0.0)]
    whole = measures.mrr_growth(table(spark, "subscriptions", rows), [])
    assert listed(whole) == listed(measures.d04_mrr_growth(table(spark, "subscriptions", rows)))


def test_retention_without_groups_equals_the_measures(spark):
    p = table(spark, "payments", [pay(i, when=f"2024-{i:02d}-03 00:00:00", amount=i * 10) for i in (1, 2, 5)]
              + [pay(9, when="2025-01-31 00:00:00", amount=70), pay(10, when="2025-02-01 00:00:00", amount=9)])
    c = table(spark, "churn_events", [
        {"subscription_id": i, "user_id": 1, "churn_date": d(day), "churn_reason": "x", "mrr": D(5)}
        for i, day in enumerate(("2024-01-31", "2024-02-01", "2024-12-24", "2026-01-01"))])
    both = measures.retention_12m(p, c, [])
    assert listed(both.select("month", "nrr")) == listed(measures.d06_nrr_12m(p, c))
    assert listed(both.select("month", "grr")) == listed(measures.d07_grr_12m(p, c))


def test_cards_scan_once_and_equal_single_contexts(spark, tmp_path):
    rows = [sub(i, uid=i % 4, plan=1 + i % 3, status=("Active", "Churned", "Paused", "Active")[i % 4], price=i) for i in range(40)]
    table(spark, "subscriptions", rows).write.parquet(str(tmp_path / "s"))
    s = spark.read.parquet(str(tmp_path / "s"))
    cards = measures.cards_by_context(s, ["plan_id", "status"])
    assert cards._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    values = ["mrr", "arr", "arpu", "churn_rate", "ltv", "retention_rate"]
    for by in ([], ["plan_id"], ["status"], ["plan_id", "status"]):
        flags = " and ".join(f"all_{c} = {int(c not in by)}" for c in ("plan_id", "status"))
        assert listed(cards.where(flags).select(*by, *values)) == listed(measures.subscription_cards(s, by))


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1 and s is not None]
    neg = [s for s, y in rows if y == 0 and s is not None]
    if not pos or not neg:
        return None
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("rows", [
    [(float(random.Random(i).randrange(12)), i % 3 == 0) for i in range(300)], [(1.0, 1), (1.0, 0)], [(2.0, 1), (1.0, 0)],
    [(1.0, 1), (2.0, 0), (None, 1)], [(1.0, 1)], []])
def test_exact_auc(spark, rows):
    df = spark.createDataFrame([(s, int(y)) for s, y in rows], "score double, label int")
    got = ml.exact_auc(df, "score", "label").first()
    assert got.auc == pytest.approx(brute_auc([(s, int(y)) for s, y in rows]), abs=1e-12)
    assert got.positives == sum(1 for s, y in rows if y and s is not None)


def test_running_sums_cross_partitions(spark):
    rnd = random.Random(3)
    rows = [(k, rnd.randrange(10)) for k in rnd.sample(range(10_000), 500)]
    got = ranking.running_sums(spark.createDataFrame(rows, "k int, v int").repartition(7), ["k"], ["v"], 5).collect()
    before, total = {}, 0
    for k, v in sorted(rows):
        before[k] = total
        total += v
    assert {r.k: r.before_v for r in got} == before


def test_payments_in_buckets_need_no_shuffle_and_hot_subscriptions_stand_apart(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, 7, 7, 7, *range(100, 400)]), dt.date(2024, rng.randint(1, 12), rng.randint(1, 28)),
             rng.choice(["Paid", "Paid", "Failed"]), Decimal(rng.randint(1, 900))) for i in range(6000)]
    rows += [(6000 + i, 7, dt.date(2024, rng.randint(1, 12), 3), "Paid", Decimal(2)) for i in range(3000)]
    p = spark.createDataFrame(rows, "payment_id long, subscription_id long, payment_date date, "
                                    "payment_status string, amount decimal(10,2)")
    stored = store_colocated(p, "bucketed_payments", "subscription_id", ["payment_date", "payment_id"], buckets=12,
                             root=str(tmp_path))
    assert {r.subscription_id for r in stored.hot.select("subscription_id").distinct().collect()} == {7}
    assert stored.bucketed.unionByName(stored.hot).exceptAll(p).count() == 0
    assert stored.bucketed.count() + stored.hot.count() == len(rows)
    assert len(list((tmp_path / "bucketed_payments").glob("*.parquet"))) <= 12
    alone = revenue.q10_nrr_colocated(Colocated(stored.bucketed, stored.hot))
    plan = alone._jdf.queryExecution().executedPlan().toString().split("Union")[1].split("\n")
    scan = next(i for i, x in enumerate(plan) if "FileScan" in x)
    at = next(i for i, x in enumerate(plan) if "Window" in x)
    assert at < scan and "Bucketed: true" in plan[scan]
    assert not any("Exchange" in x for x in plan[at:scan])
    assert revenue.q10_nrr_colocated(stored).collect() == revenue.q10_nrr(p).collect()
    empty = store_colocated(p.limit(0), "bucketed_nothing", "subscription_id", ["payment_id"], buckets=4,
                            root=str(tmp_path))
    assert revenue.q10_nrr_colocated(empty).count() == 0


def test_duplicate_rows_are_counted_by_fingerprint(spark):
    rows = [(1, None, "a"), (1, None, "a"), (1, None, None), (None, 1.0, "a"), (2, 0.0, ""), (2, -0.0, ""),
            (2, float("nan"), ""), (2, float("nan"), "")] + [(9, 9.0, "hot")] * 500
    df = spark.createDataFrame(rows, "a int, `b.c` double, _fp string")
    tables = {"some": df, "none": df.limit(0), "one": df.limit(1), "all": spark.range(1000).toDF("id")}
    got = {r.table_name: (r.row_count, r.is_empty, r.duplicate_full_rows) for r in quality.val_tables(tables).collect()}
    assert got == {"some": (508, False, 1 + 1 + 1 + 499), "none": (0, True, 0), "one": (1, False, 0),
                   "all": (1000, False, 0)}


def test_equal_fingerprints_of_different_rows_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(quality, "_fingerprints", lambda df: (F.lit(1).cast("long").alias("_fp_1"),
                                                              (F.col("id") % 3).alias("_fp_2")))
    df = spark.range(50).union(spark.range(10))
    assert quality.val_tables({"t": df}).collect()[0].duplicate_full_rows == 10


def test_overlap_join_broadcasts_no_side_and_long_intervals_add_few_rows(spark):
    rows = spark.createDataFrame([(1, i, f"{1950 + i}-03-31", f"{2020 + i}-02-29") for i in (0, 4)]
                                 + [(1, 9, "2024-12-31", "2025-01-01"), (1, 10, "2025-01-01", "2025-01-01")], "k int, i int, s string, e string")
    left = rows.select("k", "i", F.to_date("s").alias("s"), F.to_date("e").alias("e"))
    right = left.select("k", F.col("i").alias("j"), F.col("s").alias("x"), F.col("e").alias("y"))
    joined = intervals.overlap_join(left, right, "k", ("s", "e"), ("x", "y"))
    assert sorted((r.i, r.j) for r in joined.collect()) == [(0, 0), (0, 4), (4, 0), (4, 4), (9, 9), (9, 10), (10, 9), (10, 10)]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") >= 2
    assert intervals._spans(left, ("s", "e")).where("i in (0, 4)").groupBy("i").count().agg({"count": "max"}).first()[0] < 30


def test_plan_overlaps_do_not_depend_on_how_long_subscriptions_run(spark):
    """Pairs counted by hand: bins of one, six and 36 months meet in all combinations."""
    runs = [(1, "2020-01-31", "2020-01-31"), (2, "2019-12-31", "2020-02-01"), (3, "2020-01-31", "2021-12-31"),
            (4, "2001-01-01", "2031-12-31"), (5, "2020-02-01", "2020-02-01"), (6, "2022-01-01", "2022-01-01")]
    subs = table(spark, "subscriptions", [dict(sub(i, uid=1, plan=1 + i % 2, start=a, status="Churned"), end_date=d(b)) for i, a, b in runs])
    plans = spark.createDataFrame([(1, "odd"), (2, "even")], "plan_id int, plan_name string")
    got = intervals.plan_overlaps(subs, plans, as_of="2030-01-01").agg({"pairs": "sum", "overlap_days": "sum"}).first()
    want = [(max(a, x), min(b, y)) for i, a, b in runs for j, x, y in runs if i < j and max(a, x) <= min(b, y)]
    days = sum((d(b) - d(a)).days + 1 for a, b in want)
    assert (got["sum(pairs)"], got["sum(overlap_days)"]) == (len(want), days)
