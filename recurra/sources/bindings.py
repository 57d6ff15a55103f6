"""Bind the driver's TPC-H-shaped test tables to the eight canonical tables.

Every canonical table is a lazy DataFrame derived from the parquet inputs,
so a query's work grows with them and Catalyst prunes the columns each query
does not read. The rules are fixed so that the DuckDB oracle
(``recurra.plans.oracle``) derives byte-identical tables.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from recurra.sources.schema import HOURS, MONEY

# --- fixed values of the binding rules ------------------------------------------
TEST_AS_OF = "2001-09-01"            # as-of date that fits the test data
TEST_WINDOW_START = "2001-08-01"     # usage window start for the churn warning
PLAN_PRICES = {1: 499, 2: 249, 3: 99, 4: 49, 5: 15}
PLAN_SEGMENTS = {1: "Enterprise", 2: "Mid-Market", 3: "Mid-Market", 4: "SMB", 5: "SMB"}
PLAN_SEATS = {1: 250, 2: 50, 3: 25, 4: 10, 5: 5}
ORDER_STATUS = {"O": "Active", "F": "Churned", "P": "Paused"}
CHURN_REASONS = ["Price", "Competitor", "Missing features", "Support backlog", "Underutilization"]
TICKET_CATEGORIES = ["Technical", "Billing", "Feature", "Onboarding"]
TICKET_PRIORITIES = ["Low", "Medium", "High"]
CAMPAIGN_CHANNELS = ["automobile", "building", "furniture", "household", "machinery"]
USAGE_DAY_SHIFT = -8188              # moves 2024 event days back to 2001
# ---------------------------------------------------------------------------------

TPCH_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events")


def _case(key: Column, mapping: dict) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == k, F.lit(v)) if expr is None else expr.when(key == k, F.lit(v))
    return expr


def _pick(idx: Column, values: list) -> Column:
    return _case(idx, dict(enumerate(values)))


def _plan_id(priority: Column) -> Column:
    return F.substring(priority, 1, 1).cast("int")


class BoundModel:
    """The eight canonical tables derived lazily from one test-data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = TEST_AS_OF):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.as_of = _dt.date.fromisoformat(as_of)

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ---- dimensions ---------------------------------------------------------------
    @cached_property
    def plans(self) -> DataFrame:
        pid = _plan_id(F.col("o_orderpriority"))
        return (
            self.raw("orders").select("o_orderpriority").distinct()
            .select(
                pid.alias("plan_id"),
                F.expr("substring(o_orderpriority, 3)").alias("plan_name"),
                _case(pid, PLAN_PRICES).cast(MONEY).alias("monthly_price"),
                _case(pid, PLAN_SEGMENTS).alias("target_segment"),
                _case(pid, PLAN_SEATS).cast("int").alias("max_seats"),
            )
        )

    @cached_property
    def users(self) -> DataFrame:
        first_order = (self.raw("orders").groupBy("o_custkey")
                       .agg(F.min("o_orderdate").alias("first_order")))
        c, n, r = self.raw("customer"), self.raw("nation"), self.raw("region")
        bal = F.col("c_acctbal")
        size = (F.when(bal < 0, "1-10").when(bal < 3000, "11-50").when(bal < 6000, "51-200")
                .when(bal < 9000, "201-500").otherwise("501+"))
        return (
            c.join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .join(first_order, c.c_custkey == first_order.o_custkey)
            .select(
                F.col("c_custkey").alias("user_id"),
                F.col("r_name").alias("region"),
                F.col("c_mktsegment").alias("acquisition_channel"),
                size.alias("company_size"),
                F.to_date("first_order").alias("signup_date"),
            )
        )

    # ---- facts --------------------------------------------------------------------
    @cached_property
    def subscriptions(self) -> DataFrame:
        o = self.raw("orders")
        key = F.col("o_orderkey")
        start = F.to_date("o_orderdate")
        churned_end = F.least(F.date_add(start, ((key % 24 + 1) * 30).cast("int")),
                              F.lit(self.as_of))
        end = F.when((F.col("o_orderstatus") == "F") & (key % 97 != 0), churned_end)
        price = (F.col("o_totalprice").cast(MONEY)
                 * F.when(key % 50 == 0, F.lit(10)).otherwise(F.lit(1))).cast(MONEY)
        return o.select(
            key.alias("subscription_id"),
            F.col("o_custkey").alias("user_id"),
            _plan_id(F.col("o_orderpriority")).alias("plan_id"),
            _case(F.col("o_orderstatus"), ORDER_STATUS).alias("status"),
            start.alias("start_date"),
            end.alias("end_date"),
            price.alias("monthly_price"),
            price.alias("mrr"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        li = self.raw("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
            "l_returnflag", "l_shipdate")
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
        w = W.partitionBy("l_orderkey").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
        copies = F.when(F.col("l_orderkey") % 500 == 0, F.array(F.lit(0), F.lit(1))) \
            .otherwise(F.array(F.lit(0)))
        j = (li.join(o, li.l_orderkey == o.o_orderkey)
             .withColumn("rn", F.row_number().over(w))
             .withColumn("k", F.explode(copies)))
        return j.select(
            (F.col("l_orderkey") * 100 + F.col("rn") + F.col("k") * 50).alias("payment_id"),
            F.col("l_orderkey").alias("subscription_id"),
            F.col("o_custkey").alias("user_id"),
            _plan_id(F.col("o_orderpriority")).alias("plan_id"),
            F.date_add(F.to_date("o_orderdate"), (F.col("l_linenumber") - 1) * 30)
            .cast("timestamp_ntz").alias("payment_date"),
            F.col("l_extendedprice").cast(MONEY).alias("amount"),
            F.when(F.col("l_returnflag") == "R", "Failed").otherwise("Paid").alias("payment_status"),
        )

    @cached_property
    def churn_events(self) -> DataFrame:
        s = self.subscriptions
        return s.where((F.col("status") == "Churned") & F.col("end_date").isNotNull()).select(
            "subscription_id", "user_id",
            F.col("end_date").alias("churn_date"),
            _pick(F.col("subscription_id") % 5, CHURN_REASONS).alias("churn_reason"),
            "mrr",
        )

    @cached_property
    def product_usage(self) -> DataFrame:
        e = self.raw("events")
        shift = (F.lit(USAGE_DAY_SHIFT) - (F.col("event_id") % 3) * 30).cast("int")
        return e.select(
            F.col("event_id").alias("log_id"),
            "user_id",
            F.date_add(F.to_date("ts"), shift).alias("event_date"),
            F.col("event_type").alias("feature"),
            F.floor("value").cast("int").alias("active_minutes"),
            F.lit(1).cast("int").alias("events"),
        )

    @cached_property
    def support_tickets(self) -> DataFrame:
        e = self.raw("events").where(F.col("event_type") == "error")
        shift = (F.lit(USAGE_DAY_SHIFT) - (F.col("user_id") % 24) * 30).cast("int")
        return e.select(
            F.col("event_id").alias("ticket_id"),
            "user_id",
            F.date_add(F.to_date("ts"), shift).cast("timestamp_ntz").alias("created_date"),
            _pick(F.col("event_id") % 4, TICKET_CATEGORIES).alias("category"),
            _pick(F.col("event_id") % 3, TICKET_PRIORITIES).alias("priority"),
            F.least(F.col("value"), F.lit(12.0)).cast(HOURS).alias("first_response_hours"),
            F.when(F.col("event_id") % 50 != 0, F.col("value").cast(HOURS))
            .alias("resolution_hours"),
        )

    @cached_property
    def marketing_campaigns(self) -> DataFrame:
        p = self.raw("part")
        key = F.col("p_partkey")
        year = (F.lit(1995) + F.floor((key % 80) / F.lit(12.0))).cast("int")
        return p.select(
            key.alias("campaign_id"),
            F.make_date(year, (key % 12 + 1).cast("int"), F.lit(1)).alias("campaign_month"),
            _pick(key % 5, CAMPAIGN_CHANNELS).alias("channel"),
            F.col("p_retailprice").cast(MONEY).alias("spend"),
            (F.col("p_size") * 6).cast("int").alias("trial_signups"),
            F.col("p_size").cast("int").alias("paid_conversions"),
        )

    # ---- dirty fixtures for the cleaners (derived from the bound tables) -------------
    @cached_property
    def dirty_payments(self) -> DataFrame:
        return dirty_payments(self.payments)

    @cached_property
    def dirty_subscriptions(self) -> DataFrame:
        return dirty_subscriptions(self.subscriptions)

    def tables(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in (
            "plans", "users", "subscriptions", "payments", "churn_events",
            "product_usage", "support_tickets", "marketing_campaigns")}



MODEL_TABLES = ("plans", "users", "subscriptions", "payments", "churn_events", "product_usage",
                "support_tickets", "marketing_campaigns")


def dirty_payments(p: DataFrame) -> DataFrame:
    """Payments with an ingest order and quality issues, plus a later second copy
    (amount + 1) of every payment whose id ends in 01, so keep-first matters."""
    sub, seq = F.col("subscription_id"), F.col("ingest_seq")
    issue = F.when(sub % 40 == 0, "Missing amount").when(sub % 41 == 0, "outlier")
    copies = F.when(F.col("payment_id") % 100 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (p.select("*", F.explode(copies).alias("ingest_seq"))       # payments are derived once, not per copy
            .withColumn("amount", F.when(seq == 1, (F.col("amount") + 1).cast(MONEY)).otherwise(F.col("amount")))
            .withColumn("quality_issue", issue))


def dirty_subscriptions(s: DataFrame) -> DataFrame:
    issue = F.when(F.col("subscription_id") % 40 == 0, "Missing price")
    return s.select("*", issue.alias("quality_issue"))


class StoredModel:
    """The canonical tables as loaded (Parquet) -- what queries run against, like the
    reference's queries run against its loaded database tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _t(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    plans = property(lambda self: self._t("plans"))
    users = property(lambda self: self._t("users"))
    subscriptions = property(lambda self: self._t("subscriptions"))
    payments = property(lambda self: self._t("payments"))
    churn_events = property(lambda self: self._t("churn_events"))
    product_usage = property(lambda self: self._t("product_usage"))
    support_tickets = property(lambda self: self._t("support_tickets"))
    marketing_campaigns = property(lambda self: self._t("marketing_campaigns"))

    @cached_property
    def dirty_payments(self) -> DataFrame:
        return dirty_payments(self.payments)

    @cached_property
    def dirty_subscriptions(self) -> DataFrame:
        return dirty_subscriptions(self.subscriptions)

    def tables(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in MODEL_TABLES}

