"""Streaming variants must equal the batch operators on the same input."""

from pyspark.sql import functions as F

from recurra.operators import extensions
from recurra.sources.bindings import BoundModel
from recurra.streaming import kpis as stream

SF = "/root/testdata/sf0.001"


def test_stream_daily_paid_equals_batch(spark, tmp_path):
    m = BoundModel(spark, SF)
    src = str(tmp_path / "in")
    m.payments.repartition(4).write.parquet(src)
    q = stream.start_daily_paid(spark, src, str(tmp_path / "out"), str(tmp_path / "ck"),
                                lateness="0 seconds")
    q.awaitTermination(300)
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = (m.payments.where(F.col("payment_status") == "Paid")
             .groupBy(F.to_date("payment_date").alias("sale_day"))
             .agg(F.sum(F.col("amount").cast("decimal(38,2)")).alias("inflow")))
    # the watermark holds back the newest day until later data arrives
    last = batch.agg(F.max("sale_day")).first()[0]
    a = sorted((r.sale_day, r.inflow) for r in got.collect())
    b = sorted((r.sale_day, r.inflow) for r in batch.where(F.col("sale_day") < last).collect())
    assert a == b and len(a) > 100


def test_daily_totals_equal_batch_whatever_the_files(spark, tmp_path):
    m = BoundModel(spark, SF)
    src = str(tmp_path / "in")
    m.payments.repartition(70).write.parquet(src)          # unordered days in every file
    batch = sorted((r.sale_day, r.inflow, r.payments) for r in (
        m.payments.where(F.col("payment_status") == "Paid")
        .groupBy(F.to_date("payment_date").alias("sale_day"))
        .agg(F.sum(F.col("amount").cast("decimal(38,2)")).alias("inflow"),
             F.count(F.lit(1)).alias("payments"))).collect())
    for max_files in (None, 16):
        got = stream.run_daily_totals(spark, src, max_files=max_files)
        assert sorted((r.sale_day, r.inflow, r.payments) for r in got.collect()) == batch


def test_stream_ticket_alerts_equal_batch(spark, tmp_path):
    m = BoundModel(spark, SF)
    src = str(tmp_path / "tickets")
    m.support_tickets.write.parquet(src)
    q = stream.start_ticket_alerts(spark, src, m.subscriptions, m.plans, str(tmp_path / "out"),
                                   str(tmp_path / "ck"))
    q.awaitTermination(300)
    got = sorted(r.ticket_id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    ref = sorted(r.ticket_id for r in extensions.x_ticket_alert(
        m.support_tickets, m.subscriptions, m.plans).collect())
    assert got == ref and len(got) > 0
