"""The keyed monthly sink: equal to the batch tables, also after crashes and replays."""

import pytest

from recurra.operators import kpis, support
from recurra.sources.bindings import BoundModel
from recurra.streaming import upsert

SF = "/root/testdata/sf0.001"


def listed(df):
    return sorted(map(tuple, df.collect()))


def source(spark, tmp_path, name, files=6):
    df = getattr(BoundModel(spark, SF), name)
    path = str(tmp_path / name)
    df.repartition(files).write.parquet(path)                 # months in no order
    return spark.read.parquet(path), path


@pytest.mark.parametrize("name,kpi,batch", [
    ("payments", upsert.PAID, kpis.kpi_monthly_paid), ("support_tickets", upsert.sla(), support.q18_sla_trend)])
def test_killed_and_restarted_stream_equals_batch(spark, tmp_path, monkeypatch, name, kpi, batch):
    rows, path = source(spark, tmp_path, name)
    folder, ck = str(tmp_path / "kpi"), str(tmp_path / "ck")
    commit, seen = upsert._commit, []

    def crash_before_second_commit(spark_, folder_, batch_id):
        seen.append(batch_id)
        if seen == [0, 1]:
            raise RuntimeError("killed between the write and its commit")
        commit(spark_, folder_, batch_id)

    monkeypatch.setattr(upsert, "_commit", crash_before_second_commit)
    q = upsert.start_monthly(spark, path, folder, ck, kpi, max_files=2)
    with pytest.raises(Exception, match="killed"):
        q.awaitTermination()
    assert upsert.last_commit(spark, folder) == 0
    q = upsert.start_monthly(spark, path, folder, ck, kpi, max_files=2)      # the same folders
    q.awaitTermination()
    assert seen == [0, 1, 1, 2]
    assert listed(upsert.monthly_table(spark, folder, kpi)) == listed(batch(rows))


def test_replayed_batch_changes_nothing(spark, tmp_path):
    rows, _ = source(spark, tmp_path, "payments", 2)
    folder = str(tmp_path / "kpi")
    half = rows.where("payment_id % 2 = 0")
    for batch_id, part in ((0, half), (1, rows.where("payment_id % 2 = 1")), (1, rows), (0, half)):
        upsert.upsert(part, batch_id, folder, upsert.PAID)
    assert listed(upsert.monthly_table(spark, folder, upsert.PAID)) == listed(kpis.kpi_monthly_paid(rows))


def test_a_batch_rewrites_only_its_months(spark, tmp_path):
    rows, _ = source(spark, tmp_path, "payments", 2)
    folder = str(tmp_path / "kpi")
    upsert.upsert(rows, 0, folder, upsert.PAID)
    june = rows.where("payment_date >= '1996-06-01' and payment_date < '1996-07-01'")
    upsert.upsert(june, 1, folder, upsert.PAID)
    written = spark.read.parquet(f"{folder}/state").where("version = 1").select("month").distinct().collect()
    assert [str(r.month) for r in written] == ["1996-06-01"]
    twice = listed(upsert.monthly_table(spark, folder, upsert.PAID))
    assert twice == listed(kpis.kpi_monthly_paid(rows.unionByName(june)))
    upsert.compact(spark, folder, str(tmp_path / "compacted"), upsert.PAID)
    assert listed(upsert.monthly_table(spark, str(tmp_path / "compacted"), upsert.PAID)) == twice
    upsert.upsert(june, 2, str(tmp_path / "compacted"), upsert.PAID)
    assert upsert.last_commit(spark, str(tmp_path / "compacted")) == 2


def test_nothing_committed_and_empty_batches(spark, tmp_path):
    folder = str(tmp_path / "kpi")
    assert upsert.monthly_table(spark, folder, upsert.PAID).count() == 0
    rows, _ = source(spark, tmp_path, "payments", 1)
    upsert.upsert(rows.limit(0), 0, folder, upsert.PAID)
    assert upsert.monthly_table(spark, folder, upsert.PAID).count() == 0
    upsert.upsert(rows, 1, folder, upsert.PAID)
    assert listed(upsert.monthly_table(spark, folder, upsert.PAID)) == listed(kpis.kpi_monthly_paid(rows))
