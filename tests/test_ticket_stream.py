"""Ticket alerts as a stream-stream join: deadlines, disorder, restarts."""

from decimal import Decimal

from helpers import sub, table, ts
from recurra.operators import extensions
from recurra.sources.bindings import BoundModel
from recurra.streaming import tickets as stream

SF = "/root/testdata/sf0.001"


def accounts(spark):
    s = table(spark, "subscriptions", [sub(1, uid=1, plan=1), sub(2, uid=2, plan=2)])
    pl = table(spark, "plans", [
        {"plan_id": 1, "plan_name": "Top", "monthly_price": Decimal("499.00"),
         "target_segment": "Enterprise", "max_seats": 9},
        {"plan_id": 2, "plan_name": "Low", "monthly_price": Decimal("15.00"),
         "target_segment": "SMB", "max_seats": 1}])
    return s, pl


def ticket(i, created, hours, user=1):
    return {"ticket_id": i, "user_id": user, "created_date": ts(created), "category": "Billing", "priority": "High",
            "resolution_hours": None if hours is None else Decimal(hours)}


def drain(spark, tmp_path, opened, resolved, **params):
    s, pl = accounts(spark)
    q = stream.start_unresolved(spark, opened, resolved, s, pl, str(tmp_path / "out"), str(tmp_path / "ck"), **params)
    q.awaitTermination()
    return sorted(r.ticket_id for r in spark.read.schema("ticket_id long").parquet(str(tmp_path / "out")).collect())


def test_deadline_is_exact_and_waits_for_the_watermark(spark, tmp_path):
    rows = [ticket(1, "2025-01-01 00:00:00", "12.00"), ticket(2, "2025-01-01 00:00:00", "12.01"),
            ticket(3, "2025-01-01 00:00:00", None), ticket(4, "2025-01-03 00:00:00", "0.00"),
            ticket(5, "2025-01-02 20:00:00", None), ticket(6, "2025-01-01 00:00:00", None, user=2)]
    opened, resolved = stream.write_feeds(table(spark, "support_tickets", rows), str(tmp_path / "feeds"))
    # the clock of both feeds stands at 2025-01-03 00:00: ticket 5 still has time
    assert drain(spark, tmp_path, opened, resolved, lateness="0 seconds") == [2, 3]
    stream.write_clock(spark, opened, resolved, "2025-01-05 00:00:00")
    assert drain(spark, tmp_path, opened, resolved, lateness="0 seconds") == [2, 3, 5]     # restarted


def test_three_batches_in_mixed_order_equal_the_batch_filter(spark, tmp_path):
    m = BoundModel(spark, SF)
    tickets = m.support_tickets.cache()
    feeds = str(tmp_path / "feeds")
    s, pl = m.subscriptions, m.plans
    for part in (2, 0, 1):                                    # files are not in time order
        stream.write_feeds(tickets.where(f"ticket_id % 3 = {part}").coalesce(1), feeds)
    stream.write_clock(spark, f"{feeds}/opened", f"{feeds}/resolved", "2030-01-01 00:00:00")
    q = stream.start_unresolved(spark, f"{feeds}/opened", f"{feeds}/resolved", s, pl, str(tmp_path / "out"),
                                str(tmp_path / "ck"), lateness="2000 days", max_files=1)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"]]) >= 3
    got = sorted((r.ticket_id, r.alert_at) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    want = sorted((r.ticket_id, r.alert_at) for r in extensions.x_ticket_alert(tickets, s, pl).collect())
    assert got == want and len(got) > 0


def test_late_resolution_and_unknown_tickets(spark, tmp_path):
    rows = [ticket(1, "2025-01-01 00:00:00", "100.00"), ticket(2, "2025-01-01 00:00:00", "3.00")]
    opened, resolved = stream.write_feeds(table(spark, "support_tickets", rows), str(tmp_path / "feeds"))
    spark.createDataFrame([(77, ts("2025-01-01 01:00:00")), (2, ts("2025-01-01 05:00:00"))],
                          stream.RESOLVED).write.mode("append").parquet(resolved)
    stream.write_clock(spark, opened, resolved, "2025-02-01 00:00:00")
    assert drain(spark, tmp_path, opened, resolved) == [1]
