"""Rows set aside at load: whole, named, and together with the loaded ones equal to the input."""

from pyspark.sql import functions as F

from helpers import D, sub, table
from recurra.operators import etl, rejects
from recurra.sources import readers
from recurra.session import apply_sql_conf
from recurra.sources.schema import PAYMENTS, SUBSCRIPTIONS

HEAD = "payment_id,subscription_id,user_id,plan_id,payment_date,amount,payment_status\n"


def write_layer(path):
    (path / "payments.csv").write_text(
        HEAD + "1,1,1,1,2025-01-05 10:00:00,15.00,Paid\n" + "2,1,1,1,not a date,15.00,Paid\n"
        + "3,1,1,1,2025-01-06 10:00:00,oops,Paid\n" + "4,1,1,1,2025-01-07 10:00:00,-3.00,Maybe\n"
        + "5,1,,1,2025-01-08 10:00:00,1.00,Failed\n" + "6,1,1,1,2025-01-09 10:00:00,2.50,Paid\n"
        + "6,1,1,1,2025-01-09 10:00:00,2.50,Paid\n")
    (path / "subscriptions.csv").write_text(
        "subscription_id,user_id,plan_id,status,start_date,end_date,monthly_price,mrr\n"
        "1,1,1,Active,2025-01-01,,10.00,10.00\n2,1,1,Churned,2025-02-01,2025-01-01,10.00,10.00\n"
        "3,1,1,Churned,2025-02-01,someday,10.00,10.00\n")


def test_loaders_keep_bad_records_and_lose_none(spark, tmp_path):
    write_layer(tmp_path)
    for load in (readers.src_model, readers.src_dir):
        out = str(tmp_path / load.__name__)
        model = load(spark, str(tmp_path), rejects_dir=out)
        assert sorted(r.payment_id for r in model["payments"].collect()) == [1, 6, 6]
        assert model["payments"].columns == PAYMENTS.schema.names
        assert [r.subscription_id for r in model["subscriptions"].collect()] == [1]
        bad = spark.read.parquet(f"{out}/payments").where("rejected = 'true'")
        assert bad.count() + model["payments"].count() == 7
        broken = {r.payment_id: r for r in bad.collect()}
        assert "readable:record" in broken[2].broken_rules and "not a date" in broken[2]._corrupt_record
        assert "readable:record" in broken[3].broken_rules
        assert sorted(broken[4].broken_rules) == ["domain:payment_status", "range>=0:amount"]
        assert broken[5].broken_rules == ["not_null:user_id"]
        late = spark.read.parquet(f"{out}/subscriptions").where("rejected = 'true'").collect()
        assert {r.subscription_id: r.broken_rules for r in late}[2] == ["end_after_start:end_date"]
        # an unreadable end date is not "still running"
        assert "readable:record" in {r.subscription_id: r.broken_rules for r in late}[3]


def test_layer_chain_reports_every_table(spark, tmp_path):
    write_layer(tmp_path)
    good, bad = etl.load_layer(spark, str(tmp_path), str(tmp_path / "out"))
    status = {r.table_name: r for r in etl.layer_status(good, bad).collect()}
    p = status["payments"]
    assert (p.loaded_rows, p.duplicate_full_rows, p.rejected_rows, p.unreadable_rows, p.passed) == (3, 1, 4, 2, False)
    s = status["subscriptions"]
    assert (s.loaded_rows, s.rejected_rows, s.unreadable_rows, s.passed) == (1, 2, 1, True)
    counts = {(r.table_name, r.broken_rule): r.rows for r in rejects.reject_counts(bad).collect()}
    assert counts["payments", "readable:record"] == 2 and counts["payments", "domain:payment_status"] == 1


def test_offending_rows_and_overrides(spark):
    s = table(spark, "subscriptions", [sub(1), sub(2, status="Gone"), sub(3, price=-1), sub(4, status="Churned", end="2024-01-01"),
                                       dict(sub(5), user_id=None)])
    got = {r.subscription_id: sorted(r.broken_rules) for r in rejects.offending_rows(s, SUBSCRIPTIONS).collect()}
    assert got == {2: ["domain:status"], 3: ["range>=0:monthly_price", "range>=0:mrr"], 4: ["end_after_start:end_date"],
                   5: ["not_null:user_id"]}
    loose = rejects.offending_rows(s, SUBSCRIPTIONS, domains={"status": None}, ranges={"monthly_price": None, "mrr": (">=", -5)})
    assert sorted(r.subscription_id for r in loose.collect()) == [4, 5]


def test_split_is_one_pass_and_empty_tables_work(spark, tmp_path):
    p = table(spark, "payments", [])
    good, bad = rejects.split_write(p, PAYMENTS, str(tmp_path / "p"))
    assert good.count() == 0 and bad.count() == 0 and good.columns == PAYMENTS.schema.names
    extra = table(spark, "payments", [{"payment_id": 1, "amount": D("1.00")}]).withColumn("note", F.lit("kept"))
    good, bad = rejects.split_write(extra, PAYMENTS, str(tmp_path / "q"))
    assert good.count() == 0 and bad.first().note == "kept"


def test_layer_reads_a_table_once_and_keeps_unreadable_records_as_they_are(spark, tmp_path, monkeypatch):
    write_layer(tmp_path)
    seen = []
    split = etl.split_write
    monkeypatch.setattr(etl, "split_write", lambda df, *a, **k: seen.append(df) or split(df, *a, **k))
    _, bad = etl.load_layer(spark, str(tmp_path), str(tmp_path / "out"))
    assert [df._jdf.queryExecution().executedPlan().toString().count("FileScan") for df in seen] == [1, 1]
    late = {r.subscription_id: r for r in bad["subscriptions"].collect()}[3]
    assert (late.monthly_price, late.mrr, late._corrupt_record) == (D("10.00"), D("10.00"), "3,1,1,Churned,2025-02-01,someday,10.00,10.00")


def test_unset_sessions_get_small_reduce_tasks_and_set_ones_keep_theirs(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(name, None)
    try:
        spark.conf.unset(name)
        apply_sql_conf(spark)
        assert spark.conf.get(name) == "16m"
        spark.conf.set(name, "3m")
        apply_sql_conf(spark)
        assert spark.conf.get(name) == "3m"
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)
