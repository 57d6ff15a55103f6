"""DuckDB SQL for the test-table bindings (mirror of ``recurra.sources.bindings``)."""

from __future__ import annotations

from recurra.plans.sqltext import case, pick, with_ctes
from recurra.sources.bindings import (
    CAMPAIGN_CHANNELS,
    CHURN_REASONS,
    ORDER_STATUS,
    PLAN_PRICES,
    PLAN_SEATS,
    PLAN_SEGMENTS,
    TEST_AS_OF,
    TICKET_CATEGORIES,
    TICKET_PRIORITIES,
    USAGE_DAY_SHIFT,
)

PID = "CAST(substr(o_orderpriority, 1, 1) AS INTEGER)"
PRICE = ("CAST(CAST(o_totalprice AS DECIMAL(10,2)) * "
         "(CASE WHEN o_orderkey % 50 = 0 THEN 10 ELSE 1 END) AS DECIMAL(10,2))")


def _date_add(d: str, n: str) -> str:
    return f"CAST({d} + CAST({n} AS INTEGER) AS DATE)"


def binding_sql(as_of: str = TEST_AS_OF) -> dict[str, str]:
    plans = f"""SELECT DISTINCT {PID} AS plan_id, substr(o_orderpriority, 3) AS plan_name,
  CAST({case(PID, PLAN_PRICES)} AS DECIMAL(10,2)) AS monthly_price,
  {case(PID, PLAN_SEGMENTS)} AS target_segment,
  CAST({case(PID, PLAN_SEATS)} AS INTEGER) AS max_seats
FROM orders"""
    users = """SELECT c.c_custkey AS user_id, r.r_name AS region, c.c_mktsegment AS acquisition_channel,
  CASE WHEN c.c_acctbal < 0 THEN '1-10' WHEN c.c_acctbal < 3000 THEN '11-50'
       WHEN c.c_acctbal < 6000 THEN '51-200' WHEN c.c_acctbal < 9000 THEN '201-500'
       ELSE '501+' END AS company_size,
  CAST(f.first_order AS DATE) AS signup_date
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN (SELECT o_custkey, MIN(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) f
  ON c.c_custkey = f.o_custkey"""
    start = "CAST(o_orderdate AS DATE)"
    subs = f"""SELECT o_orderkey AS subscription_id, o_custkey AS user_id, {PID} AS plan_id,
  {case('o_orderstatus', ORDER_STATUS)} AS status,
  {start} AS start_date,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 97 <> 0
       THEN least({_date_add(start, '(o_orderkey % 24 + 1) * 30')}, DATE '{as_of}') END AS end_date,
  {PRICE} AS monthly_price, {PRICE} AS mrr
FROM orders"""
    pays = f"""SELECT l_orderkey * 100 + rn + 50 * k AS payment_id, l_orderkey AS subscription_id,
  o_custkey AS user_id, {PID} AS plan_id,
  CAST({_date_add('CAST(o_orderdate AS DATE)', '(l_linenumber - 1) * 30')} AS TIMESTAMP) AS payment_date,
  CAST(l_extendedprice AS DECIMAL(10,2)) AS amount,
  CASE WHEN l_returnflag = 'R' THEN 'Failed' ELSE 'Paid' END AS payment_status
FROM (
  SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, l.l_returnflag,
         o.o_custkey, o.o_orderpriority, o.o_orderdate,
         row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey,
                            l.l_suppkey, l.l_extendedprice, l.l_shipdate) AS rn
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
) x JOIN (VALUES (0), (1)) copies(k) ON copies.k = 0 OR x.l_orderkey % 500 = 0"""
    churn = f"""SELECT subscription_id, user_id, end_date AS churn_date,
  {pick('subscription_id % 5', CHURN_REASONS)} AS churn_reason, mrr
FROM subscriptions WHERE status = 'Churned' AND end_date IS NOT NULL"""
    usage = f"""SELECT event_id AS log_id, user_id,
  {_date_add('CAST(ts AS DATE)', f'{USAGE_DAY_SHIFT} - (event_id % 3) * 30')} AS event_date,
  event_type AS feature, CAST(floor(value) AS INTEGER) AS active_minutes, CAST(1 AS INTEGER) AS events
FROM events"""
    tickets = f"""SELECT event_id AS ticket_id, user_id,
  CAST({_date_add('CAST(ts AS DATE)', f'{USAGE_DAY_SHIFT} - (user_id % 24) * 30')} AS TIMESTAMP) AS created_date,
  {pick('event_id % 4', TICKET_CATEGORIES)} AS category,
  {pick('event_id % 3', TICKET_PRIORITIES)} AS priority,
  CAST(least(value, 12.0) AS DECIMAL(7,2)) AS first_response_hours,
  CASE WHEN event_id % 50 <> 0 THEN CAST(value AS DECIMAL(7,2)) END AS resolution_hours
FROM events WHERE event_type = 'error'"""
    camps = f"""SELECT p_partkey AS campaign_id,
  make_date(CAST(1995 + floor((p_partkey % 80) / 12.0) AS BIGINT), CAST(p_partkey % 12 + 1 AS BIGINT), 1) AS campaign_month,
  {pick('p_partkey % 5', CAMPAIGN_CHANNELS)} AS channel,
  CAST(p_retailprice AS DECIMAL(10,2)) AS spend,
  CAST(p_size * 6 AS INTEGER) AS trial_signups, CAST(p_size AS INTEGER) AS paid_conversions
FROM part"""
    issue = ("CASE WHEN subscription_id % 40 = 0 THEN 'Missing amount' "
             "WHEN subscription_id % 41 = 0 THEN 'outlier' END")
    dirty_p = f"""SELECT *, 0 AS ingest_seq, {issue} AS quality_issue FROM payments
UNION ALL
SELECT payment_id, subscription_id, user_id, plan_id, payment_date,
  CAST(amount + 1 AS DECIMAL(10,2)) AS amount, payment_status, 1 AS ingest_seq, {issue} AS quality_issue
FROM payments WHERE payment_id % 100 = 1"""
    dirty_s = """SELECT *, CASE WHEN subscription_id % 40 = 0 THEN 'Missing price' END AS quality_issue
FROM subscriptions"""
    return {"plans": plans, "users": users, "subscriptions": subs, "payments": pays,
            "churn_events": churn, "product_usage": usage, "support_tickets": tickets,
            "marketing_campaigns": camps, "dirty_payments": dirty_p,
            "dirty_subscriptions": dirty_s}


_ORDER = ("plans", "users", "subscriptions", "payments", "churn_events", "product_usage",
          "support_tickets", "marketing_campaigns", "dirty_payments", "dirty_subscriptions")
_NEEDS = {"churn_events": ("subscriptions",), "dirty_payments": ("payments",),
          "dirty_subscriptions": ("subscriptions",)}


def on_model(body: str, tables: tuple[str, ...] | None = None, as_of: str = TEST_AS_OF) -> str:
    """Wrap a query over canonical table names with the binding CTEs it uses."""
    sql = binding_sql(as_of)
    if tables is None:
        lowered = body.lower()
        tables = tuple(t for t in _ORDER if t in lowered)
    need = set(tables)
    for t in list(need):
        need.update(_NEEDS.get(t, ()))
    return with_ctes([(t, sql[t]) for t in _ORDER if t in need], body)
