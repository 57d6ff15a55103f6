import datetime as dt

from pyspark.sql import functions as F

from helpers import d
from recurra.functions import (
    dax_divide,
    month_diff,
    month_start,
    notebook_tenure_months,
    pg_round,
    ratio,
    tenure_days,
)


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


def test_pg_round_is_half_away_from_zero_on_decimal_value(spark):
    # H1: plain round(double) would see 1.00499999...; the decimal path sees 1.005
    assert one(spark, pg_round(F.lit(1.005), 2)) == 1.01
    assert one(spark, pg_round(F.lit(-2.5), 0)) == -3.0
    assert one(spark, pg_round(F.lit(2.675), 2)) == 2.68


def test_ratio_null_on_zero_and_dax_divide_alternate(spark):
    # H5: ANSI mode must not raise; NULLIF semantics vs DAX DIVIDE(...,0)
    assert one(spark, ratio(F.lit(5), F.lit(0))) is None
    assert one(spark, dax_divide(F.lit(5), F.lit(0))) == 0.0
    assert one(spark, dax_divide(F.lit(None).cast("double"), F.lit(2))) == 0.0
    assert one(spark, ratio(F.lit(1), F.lit(4))) == 0.25


def test_month_helpers(spark):
    assert one(spark, month_start(F.lit(dt.datetime(2025, 3, 31, 23, 59)))) == d("2025-03-01")
    # H12: whole calendar months between month starts
    assert one(spark, month_diff(F.lit(d("2026-02-01")), F.lit(d("2025-11-01")))) == 3
    assert one(spark, month_diff(F.lit(d("2025-01-01")), F.lit(d("2025-03-01")))) == -2
    # H13: + 1 month clamps at month end
    assert one(spark, F.add_months(F.lit(d("2024-01-31")), 1)) == d("2024-02-29")


def test_tenure_end_rules(spark):
    df = spark.createDataFrame(
        [("Churned", d("2025-01-01"), d("2025-01-31")),
         ("Churned", d("2025-01-01"), None),       # H10: churned without end -> as_of
         ("Paused", d("2025-01-01"), d("2025-01-10")),  # not churned -> as_of
         ("Active", d("2025-12-31"), None)],
        "status string, start_date date, end_date date")
    got = [r.t for r in df.select(tenure_days("status", "start_date", "end_date",
                                              "2026-01-01").alias("t")).collect()]
    assert got == [30, 365, 365, 1]


def test_notebook_tenure_floor_and_rounding(spark):
    df = spark.createDataFrame([(d("2025-01-01"), d("2025-01-01")), (d("2025-01-01"), None)],
                               "start_date date, end_date date")
    got = [r.t for r in df.select(notebook_tenure_months("start_date", "end_date",
                                                          "2026-01-01").alias("t")).collect()]
    assert got[0] == 0.1            # H8: 0 days -> floor 0.1
    assert got[1] == round(365 / 30.4368, 1)


def test_cluster_conf_sizes_partitions():
    from recurra.session import cluster_conf
    tb = 1024 ** 4
    conf = cluster_conf(100 * tb, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * tb // (256 * 1024 ** 2)   # 256 MB each
    assert conf["spark.sql.files.maxPartitionBytes"] == "256m"
    small = cluster_conf(50 * 1024 * 1024, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24               # 3 waves of cores
