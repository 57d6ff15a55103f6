"""Canonical table contracts: Spark schemas plus key/constraint metadata.

The metadata drives the rule-based audits in ``recurra.operators.quality``
(not-null, unique, domain, range, length, foreign keys).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MONEY = DecimalType(10, 2)
HOURS = DecimalType(7, 2)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


@dataclass(frozen=True)
class Range:
    column: str
    op: str            # one of >=, >
    bound: object      # number or ISO date string


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: StructType
    primary_key: tuple[str, ...]
    unique: tuple[str, ...] = ()
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    ranges: tuple[Range, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()
    end_after_start: tuple[str, str] | None = None

    @property
    def not_null(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.schema.fields if not f.nullable)


# --- fixed values: the declared domains of the reference schema ---------------
REGIONS = ("North America", "Europe", "APAC", "LATAM")
SUBSCRIPTION_STATUSES = ("Active", "Paused", "Churned")
PAYMENT_STATUSES = ("Paid", "Failed")
TICKET_PRIORITIES = ("Low", "Medium", "High")
SIGNUP_FLOOR = "2020-01-01"
DEFAULT_FEATURE = "Dashboard"
# -------------------------------------------------------------------------------

PLANS = TableSpec(
    "plans",
    _s(("plan_id", IntegerType(), False), ("plan_name", StringType(), False),
       ("monthly_price", MONEY, False), ("target_segment", StringType(), False),
       ("max_seats", IntegerType(), False)),
    primary_key=("plan_id",), unique=("plan_name",),
    ranges=(Range("monthly_price", ">=", 0), Range("max_seats", ">", 0)),
    lengths={"plan_name": 50, "target_segment": 50},
)

USERS = TableSpec(
    "users",
    _s(("user_id", LongType(), False), ("region", StringType(), False),
       ("acquisition_channel", StringType(), False), ("company_size", StringType(), False),
       ("signup_date", DateType(), False)),
    primary_key=("user_id",),
    domains={"region": REGIONS},
    ranges=(Range("signup_date", ">=", SIGNUP_FLOOR),),
    lengths={"region": 50, "acquisition_channel": 50, "company_size": 20},
)

SUBSCRIPTIONS = TableSpec(
    "subscriptions",
    _s(("subscription_id", LongType(), False), ("user_id", LongType(), False),
       ("plan_id", IntegerType(), False), ("status", StringType(), False),
       ("start_date", DateType(), False), ("end_date", DateType(), True),
       ("monthly_price", MONEY, False), ("mrr", MONEY, False)),
    primary_key=("subscription_id",),
    domains={"status": SUBSCRIPTION_STATUSES},
    ranges=(Range("monthly_price", ">=", 0), Range("mrr", ">=", 0)),
    lengths={"status": 20},
    foreign_keys=(ForeignKey("user_id", "users", "user_id"),
                  ForeignKey("plan_id", "plans", "plan_id")),
    end_after_start=("start_date", "end_date"),
)

PAYMENTS = TableSpec(
    "payments",
    _s(("payment_id", LongType(), False), ("subscription_id", LongType(), False),
       ("user_id", LongType(), False), ("plan_id", IntegerType(), False),
       ("payment_date", TimestampNTZType(), False), ("amount", MONEY, False),
       ("payment_status", StringType(), False)),
    primary_key=("payment_id",),
    domains={"payment_status": PAYMENT_STATUSES},
    ranges=(Range("amount", ">=", 0),),
    lengths={"payment_status": 20},
    foreign_keys=(ForeignKey("subscription_id", "subscriptions", "subscription_id"),
                  ForeignKey("user_id", "users", "user_id"),
                  ForeignKey("plan_id", "plans", "plan_id")),
)

CHURN_EVENTS = TableSpec(
    "churn_events",
    _s(("subscription_id", LongType(), False), ("user_id", LongType(), False),
       ("churn_date", DateType(), False), ("churn_reason", StringType(), False),
       ("mrr", MONEY, False)),
    primary_key=("subscription_id",),
    ranges=(Range("mrr", ">=", 0),),
    lengths={"churn_reason": 255},
    foreign_keys=(ForeignKey("subscription_id", "subscriptions", "subscription_id"),
                  ForeignKey("user_id", "users", "user_id")),
)

PRODUCT_USAGE = TableSpec(
    "product_usage",
    _s(("log_id", LongType(), False), ("user_id", LongType(), False),
       ("event_date", DateType(), False), ("feature", StringType(), False),
       ("active_minutes", IntegerType(), False), ("events", IntegerType(), False)),
    primary_key=("log_id",),
    ranges=(Range("active_minutes", ">=", 0), Range("events", ">=", 0)),
    lengths={"feature": 50},
    foreign_keys=(ForeignKey("user_id", "users", "user_id"),),
)

SUPPORT_TICKETS = TableSpec(
    "support_tickets",
    _s(("ticket_id", LongType(), False), ("user_id", LongType(), False),
       ("created_date", TimestampNTZType(), False), ("category", StringType(), False),
       ("priority", StringType(), False), ("first_response_hours", HOURS, True),
       ("resolution_hours", HOURS, True)),
    primary_key=("ticket_id",),
    domains={"priority": TICKET_PRIORITIES},
    ranges=(Range("first_response_hours", ">=", 0), Range("resolution_hours", ">=", 0)),
    lengths={"category": 100, "priority": 10},
    foreign_keys=(ForeignKey("user_id", "users", "user_id"),),
)

MARKETING_CAMPAIGNS = TableSpec(
    "marketing_campaigns",
    _s(("campaign_id", LongType(), False), ("campaign_month", DateType(), False),
       ("channel", StringType(), False), ("spend", MONEY, False),
       ("trial_signups", IntegerType(), False), ("paid_conversions", IntegerType(), False)),
    primary_key=("campaign_id",),
    ranges=(Range("spend", ">=", 0), Range("trial_signups", ">=", 0),
            Range("paid_conversions", ">=", 0)),
    lengths={"channel": 50},
)

# Dependency (load) order: parents before children.
TABLES: dict[str, TableSpec] = {
    t.name: t for t in (PLANS, USERS, SUBSCRIPTIONS, PAYMENTS, CHURN_EVENTS,
                        PRODUCT_USAGE, SUPPORT_TICKETS, MARKETING_CAMPAIGNS)
}
