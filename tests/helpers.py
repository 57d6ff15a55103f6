"""Fixture builders for the canonical tables (hand-made rows, canonical types)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql.types import StructField, StructType

from recurra.sources.schema import TABLES


def D(x) -> Decimal:
    return Decimal(str(x))


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def table(spark, name: str, rows: list[dict]):
    """Rows as dicts (missing keys -> NULL) with the canonical schema of ``name``."""
    schema = StructType([StructField(f.name, f.dataType, True) for f in TABLES[name].schema.fields])
    data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema)


def sub(sid, uid=1, plan=1, status="Active", start="2025-01-01", end=None, price=10):
    return {"subscription_id": sid, "user_id": uid, "plan_id": plan, "status": status,
            "start_date": d(start), "end_date": d(end) if end else None,
            "monthly_price": D(price), "mrr": D(price)}


def pay(pid, sid=1, uid=1, plan=1, when="2025-01-01 00:00:00", amount=10, status="Paid"):
    return {"payment_id": pid, "subscription_id": sid, "user_id": uid, "plan_id": plan,
            "payment_date": ts(when), "amount": D(amount), "payment_status": status}


def rows(df, *cols):
    return [tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect()]
