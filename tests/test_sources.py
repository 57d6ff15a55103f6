"""Source/sink round trips (own rows, canonical schemas) and SQL text access."""

import datetime as dt
import os

from pyspark.sql import functions as F

from helpers import D, d, pay, rows, table
from recurra.sources import readers, sinks
from recurra.sources.schema import MARKETING_CAMPAIGNS, PLANS


def plans_df(spark):
    return table(spark, "plans", [
        {"plan_id": 1, "plan_name": "Basic", "monthly_price": D("15.00"), "target_segment": "SMB",
         "max_seats": 5},
        {"plan_id": 2, "plan_name": "Pro", "monthly_price": D("99.00"), "target_segment": "Mid",
         "max_seats": 25}])


def test_csv_round_trip_with_schema(spark, tmp_path):
    src = plans_df(spark)
    sinks.snk_csv(src, str(tmp_path / "plans.csv"))
    back = readers.src_csv(spark, str(tmp_path / "plans.csv"), PLANS)
    assert back.schema.simpleString() == src.schema.simpleString()
    assert sorted(rows(back)) == sorted(rows(src))


def test_csv_text_dates_are_coerced(spark, tmp_path):
    path = tmp_path / "marketing_campaigns.csv"
    path.write_text("campaign_id,campaign_month,channel,spend,trial_signups,paid_conversions\n"
                    "1,2025-01-01,ads,100.50,10,2\n2,2025-02-01,seo,oops,5,1\n")
    df = readers.src_csv(spark, str(path), MARKETING_CAMPAIGNS)
    got = rows(df.orderBy("campaign_id"), "campaign_month", "spend")
    assert got == [(d("2025-01-01"), D("100.50")), (d("2025-02-01"), None)]   # bad -> NULL


def test_src_dir_and_model_skip_missing(spark, tmp_path):
    sinks.snk_csv(plans_df(spark), str(tmp_path / "plans.csv"))
    (tmp_path / "payments.csv").write_text(
        "payment_id,subscription_id,user_id,plan_id,payment_date,amount,payment_status\n"
        "1,1,1,1,2025-01-05 10:00:00,15.00,Paid\n")
    layer = readers.src_dir(spark, str(tmp_path))
    assert sorted(layer) == ["payments", "plans"]
    model = readers.src_model(spark, str(tmp_path))
    assert sorted(model) == ["payments", "plans"]           # the other six are skipped
    p = model["payments"].first()
    assert p.payment_date == dt.datetime(2025, 1, 5, 10, 0) and p.amount == D("15.00")


def test_defaults_and_row_numbers(spark):
    df = spark.createDataFrame([(None, 5, None, None), (None, 3, "Reports", 7), (9, 4, None, 1)],
                               "log_id long, user_id long, feature string, events int")
    out = readers.src_defaults(df, {"feature": "Dashboard", "events": 0}, id_col="log_id",
                               order=["user_id"])
    got = sorted(rows(out, "user_id", "log_id", "feature", "events"))
    assert got == [(3, 1, "Reports", 7), (4, 9, "Dashboard", 1), (5, 3, "Dashboard", 0)]
    uniq = readers.src_defaults(df, {}, id_col="log_id")
    assert uniq.select("log_id").distinct().count() == 3


def test_sql_text_sources(spark):
    readers.register_views({"plans": plans_df(spark)})
    assert readers.src_sql_df(spark, "SELECT plan_name FROM plans ORDER BY plan_id").count() == 2
    row = readers.src_sql_row(spark, "SELECT COUNT(*) AS n, SUM(monthly_price) AS m FROM plans")
    assert row.n == 2 and row.m == D("114.00")


def test_append_report_and_partitioned_model(spark, tmp_path):
    p = table(spark, "payments", [pay(1, when="2025-01-05 00:00:00"),
                                  pay(2, when="2025-02-05 00:00:00")])
    target = str(tmp_path / "payments_app")
    sinks.snk_append(p, "payments", path=target)
    sinks.snk_append(p, "payments", path=target)
    assert spark.read.parquet(target).count() == 4
    out = sinks.materialize_model({"payments": p, "plans": plans_df(spark)}, str(tmp_path / "m"))
    parts = sorted(x for x in os.listdir(out["payments"]) if x.startswith("payment_month="))
    assert parts == ["payment_month=2025-01-01", "payment_month=2025-02-01"]
    back = spark.read.parquet(out["payments"]).where(F.col("payment_month") == "2025-02-01")
    assert back.count() == 1
    blocks = sinks.snk_report({"plans": plans_df(spark)}, str(tmp_path / "report"))
    assert spark.read.json(blocks["plans"]).count() == 2


def test_catalog_tables_in_analytics_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS analytics")
    p = table(spark, "payments", [pay(1), pay(2, amount=5)])
    sinks.snk_append(p, "analytics.payments")
    sinks.snk_append(p, "analytics.payments")
    back = readers.src_table(spark, "payments", database="analytics")
    assert back.count() == 4 and back.schema.simpleString() == p.schema.simpleString()
    row = readers.src_sql_row(spark, "SELECT SUM(amount) AS s FROM analytics.payments")
    assert row.s == D("30.00")


def test_corrupt_csv_records_are_kept_and_counted(spark, tmp_path):
    from recurra.sources.readers import corrupt_rows, src_csv
    from recurra.sources.schema import TABLES
    names = TABLES["subscriptions"].schema.fieldNames()
    good = {"subscription_id": "1", "user_id": "1", "plan_id": "1", "status": "Active", "start_date": "2025-01-01",
            "end_date": "", "monthly_price": "10.00", "mrr": "10.00"}
    bad = {**good, "subscription_id": "2", "end_date": "not a date"}
    text = "\n".join([",".join(names), *[",".join(r[n] for n in names) for r in (good, bad)]])
    (tmp_path / "subscriptions.csv").write_text(text + "\n")
    df = src_csv(spark, str(tmp_path / "subscriptions.csv"), TABLES["subscriptions"], corrupt_col="_corrupt_record")
    got = corrupt_rows({"subscriptions": df}).first()
    assert (got.corrupt_rows, got.rows) == (1, 2)
    rows = {r.subscription_id: r for r in df.collect()}
    assert rows[1]._corrupt_record is None and "not a date" in rows[2]._corrupt_record


def test_month_partitioned_writes_make_few_files(spark, tmp_path):
    """One file per month where months are small, several where one is large; nothing is lost."""
    rows = [pay(i, when=f"2025-{1 + i % 6:02d}-05 00:00:00") for i in range(600)]
    scattered = table(spark, "payments", rows).repartition(16)
    sinks.snk_parquet(scattered, str(tmp_path / "payments"), "payments")
    sinks.snk_append(scattered.withColumn("status", F.col("payment_status")), "x", path=str(tmp_path / "appended"),
                     partition_by=["status", "plan_id"])
    files = [f for _, _, names in os.walk(tmp_path / "payments") for f in names if f.endswith(".parquet")]
    assert 6 <= len(files) <= 12                      # 16 tasks x 6 months without clustering
    appended = [f for _, _, names in os.walk(tmp_path / "appended") for f in names if f.endswith(".parquet")]
    assert len(appended) <= 2
    back = spark.read.parquet(str(tmp_path / "payments"))
    assert sorted(r.payment_id for r in back.collect()) == list(range(600))

    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        hot = table(spark, "payments", [pay(i, when="2025-01-05 00:00:00") for i in range(5000)]).repartition(16)
        sinks.snk_parquet(hot, str(tmp_path / "hot"), "payments")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    split = [f for _, _, names in os.walk(tmp_path / "hot") for f in names if f.endswith(".parquet")]
    assert len(split) > 1                             # a hot month is not one task
