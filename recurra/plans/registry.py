"""Query registry: key -> callable(spark, sf_dir) -> DataFrame over the canonical tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from recurra.operators import (
    billing,
    churn,
    cleaning,
    cohort,
    distinct,
    economics,
    etl,
    extensions,
    features,
    intervals,
    kpis,
    measures,
    ml,
    profile,
    quality,
    rejects,
    report,
    revenue,
    support,
)
from recurra.session import apply_sql_conf, ensure_checkpoint_dir
from recurra.sources.bindings import TEST_AS_OF, TEST_WINDOW_START, BoundModel
from recurra.sources import colocated, readers, sinks
from recurra.sources.load import stored_folder
from recurra.sources.schema import TABLES
from recurra.streaming import kpis as stream_kpis
from recurra.streaming import tickets as stream_tickets
from recurra.streaming import upsert as stream_upsert

Query = Callable[[SparkSession, str], DataFrame]
A = TEST_AS_OF


def model(spark: SparkSession, sf_dir: str) -> BoundModel:
    """The canonical tables for ``sf_dir``, derived lazily: a query reads and computes only
    the tables and columns it uses, and writes nothing. ``sources.load`` stores them."""
    apply_sql_conf(spark)
    ensure_checkpoint_dir(spark)
    return BoundModel(spark, sf_dir)


def as_output(df: DataFrame) -> DataFrame:
    """Result boundary: exact decimals leave as doubles."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def _o(fn: Callable[[BoundModel], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return as_output(fn(model(spark, sf_dir)))
    run.__doc__ = fn.__doc__
    return run



def business_queries() -> dict[str, Query]:
    return {
        "q01_scorecard": _o(lambda m: revenue.q01_scorecard(m.subscriptions)),
        "q02_mrr_mom": _o(lambda m: revenue.q02_mrr_mom(m.payments)),
        "q03_logo_churn": _o(lambda m: churn.q03_logo_churn(m.subscriptions, m.churn_events)),
        "q04_expansion": _o(lambda m: revenue.q04_expansion(m.payments)),
        "q05_ltv_cac": _o(lambda m: economics.q05_ltv_cac(
            m.marketing_campaigns, m.users, m.subscriptions, as_of=A)),
        "q06_ltv_deciles": _o(lambda m: economics.q06_ltv_deciles(m.subscriptions, as_of=A)),
        "q07_cohort_counts": _o(lambda m: cohort.q07_cohort_counts(m.payments, m.users)),
        "q08_tier_metrics": _o(lambda m: economics.q08_tier_metrics(
            m.subscriptions, m.plans, as_of=A)),
        "q09_churn_warning": _o(lambda m: churn.q09_churn_warning(
            m.subscriptions, m.plans, m.product_usage, as_of=A, window_start=TEST_WINDOW_START)),
        "q10_nrr": _o(lambda m: revenue.q10_nrr(m.payments)),
        "q11_rolling7": _o(lambda m: revenue.q11_rolling7(m.payments)),
        "q12_outliers": _o(lambda m: economics.q12_outliers(m.subscriptions, m.plans)),
        "q13_nulls": _o(lambda m: quality.q13_nulls(m.subscriptions)),
        "q14_dup_payments": _o(lambda m: billing.q14_dup_payments(m.payments)),
        "q15_segment_ltv": _o(lambda m: economics.q15_segment_ltv(
            m.subscriptions, m.plans, as_of=A)),
        "q16_churn_reasons": _o(lambda m: churn.q16_churn_reasons(m.churn_events)),
        "q17_sla": _o(lambda m: support.q17_sla(m.support_tickets)),
        "q18_sla_trend": _o(lambda m: support.q18_sla_trend(m.support_tickets)),
        "q19_arr_forecast": _o(lambda m: revenue.q19_arr_forecast(m.subscriptions, m.users)),
        "q20_size_tenure": _o(lambda m: economics.q20_size_tenure(
            m.subscriptions, m.users, as_of=A)),
        "q21_decline_rate": _o(lambda m: billing.q21_decline_rate(m.payments)),
        "q22_region_matrix": _o(lambda m: economics.q22_region_matrix(m.subscriptions, m.users)),
        "k1_monthly_records": _o(lambda m: revenue.k1_monthly_records(m.payments)),
        "k2_quality_profile": _o(lambda m: billing.k2_quality_profile(m.payments)),
        "k3_mom_growth": _o(lambda m: revenue.k3_mom_growth(m.payments)),
    }


RULE_KEYS = {"aud_not_null": "not_null", "aud_unique": "unique", "aud_domain": "domain",
             "aud_range": "range", "aud_length": "length"}


def _rules(m: BoundModel, kind: str) -> DataFrame:
    return quality.audit_model(m.tables(), kinds=(kind,))


def _split(m: BoundModel) -> DataFrame:
    return ml.n5_split(features.n5_model_matrix(m.subscriptions, m.product_usage,
                                                m.support_tickets))


def _fit(m: BoundModel):
    data = _split(m)
    train = data.where(F.col("split") == "train")
    test = data.where(F.col("split") == "test")
    return ml.n5_random_forest(train), test


def _pred(m: BoundModel) -> DataFrame:
    model_, test = _fit(m)
    return ml.predictions(model_, test)


def _fixed_score(m: BoundModel) -> DataFrame:
    return ml.fixed_score(features.n5_model_matrix(m.subscriptions, m.product_usage, m.support_tickets))


def _matrix(m: BoundModel) -> DataFrame:
    return features.n3_feature_matrix(m.subscriptions, m.users, m.product_usage,
                                      m.support_tickets, m.payments, baseline=A)


def quality_queries() -> dict[str, Query]:
    q = {
        "cln_generic": _o(lambda m: cleaning.cln_generic(m.dirty_payments)),
        "cln_subs": _o(lambda m: cleaning.cln_subs(m.dirty_subscriptions)),
        "val_empty": _o(lambda m: quality.val_empty(m.tables())),
        "val_dup_rows": _o(lambda m: quality.val_tables(m.tables())
                           .select("table_name", "duplicate_full_rows")),
        "val_status": _o(lambda m: quality.val_status(m.tables())),
        "aud_null_profile": _o(lambda m: quality.aud_null_profile(
            {"subscriptions": m.subscriptions, "payments": m.payments, "users": m.users})),
        "aud_dup_key": _o(lambda m: quality.aud_dup_key(m.payments, "payment_id")),
        "aud_dup_count": _o(lambda m: quality.aud_dup_count(
            {"subscriptions": (m.subscriptions, "subscription_id"),
             "users": (m.users, "user_id"), "payments": (m.payments, "payment_id")})),
        "aud_missing_dates": _o(lambda m: quality.aud_missing_dates(m.payments)),
        "aud_start_before_signup": _o(lambda m: quality.aud_start_before_signup(
            m.subscriptions, m.users)),
        "aud_end_before_start": _o(lambda m: quality.aud_end_before_start(m.subscriptions)),
        "aud_payment_before_start": _o(lambda m: quality.aud_payment_before_start(
            m.payments, m.subscriptions)),
        "aud_fk": _o(lambda m: quality.aud_fk(m.tables())),
        "cat_rowcounts": _o(lambda m: profile.cat_rowcounts(m.tables())),
        "prof_shape": _o(lambda m: profile.prof_shape(m.tables())),
    }
    for key, prefix in RULE_KEYS.items():
        q[key] = _o(lambda m, prefix=prefix: _rules(m, prefix))
    return q


def _folder(m: BoundModel) -> str:
    """A new folder of the shared checkpoint storage for a round trip."""
    return f"{ensure_checkpoint_dir(m.spark).rstrip('/')}/recurra-layer/{uuid.uuid4().hex}"


def _csv_round_trip(m: BoundModel) -> DataFrame:
    path = f"{_folder(m)}/support_tickets.csv"
    sinks.snk_csv(m.support_tickets, path)
    return readers.src_csv(m.spark, path, TABLES["support_tickets"])


def _append_twice(m: BoundModel) -> DataFrame:
    path = f"{_folder(m)}/subscriptions"
    for _ in range(2):
        sinks.snk_append(m.subscriptions, "subscriptions", path=path)
    return m.spark.read.parquet(path)


def _stored_payments(m: BoundModel) -> colocated.Colocated:
    """Payments written as a new table in buckets by subscription, sorted by date."""
    buckets = max(8, int(m.spark.conf.get("spark.sql.shuffle.partitions")))
    return colocated.store_colocated(m.payments, f"recurra_payments_{uuid.uuid4().hex}", "subscription_id",
                                     ["payment_date", "payment_id"], buckets=buckets, root=_folder(m))


def _csv_layer(m: BoundModel) -> str:
    """Every canonical table but the campaigns, whose file is missing, as a CSV layer."""
    base = _folder(m)
    for name, df in m.tables().items():
        if name != "marketing_campaigns":
            sinks.snk_csv(df, f"{base}/{name}.csv")
    return base


def _loaded(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, loaded_rows, id_sum, filled) of loaded tables: ``filled`` is the number of
    values that are not NULL in any column, less by one for each value a load cannot read."""
    out = None
    for name, df in tables.items():
        filled = sum((F.count(F.col(c)) for c in df.columns), F.lit(0))
        one = df.agg(F.count(F.lit(1)).alias("loaded_rows"),
                     F.sum(F.col(TABLES[name].primary_key[0]).cast("decimal(38,0)")).cast("double").alias("id_sum"),
                     filled.cast("long").alias("filled")).select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def _coerced_tickets(m: BoundModel) -> DataFrame:
    """Tickets whose columns all came as text, typed at load."""
    text = m.support_tickets.select(*[
        (F.date_format(f.name, readers.TIMESTAMP_FORMAT) if f.name == "created_date" else F.col(f.name).cast("string"))
        .alias(f.name) for f in TABLES["support_tickets"].schema.fields])
    types = {f.name: f.dataType.simpleString() for f in TABLES["support_tickets"].schema.fields}
    return readers.src_coerce(text, types)


def _usage_with_defaults(m: BoundModel) -> DataFrame:
    """Usage whose log ids are lost and some of whose values are missing: defaults filled in,
    rows numbered anew in the order of user, day and old id."""
    def some(column: str, k: int) -> F.Column:
        return F.when(F.col("log_id") % 5 != k, F.col(column)).alias(column)
    gaps = m.product_usage.select(F.col("log_id").alias("old_id"), "user_id", "event_date", some("feature", 0),
                                  some("active_minutes", 1), some("events", 2))
    return readers.src_defaults(gaps, readers.PRODUCT_USAGE_DEFAULTS, id_col="log_id",
                                order=["user_id", "event_date", "old_id"])


def _report_blocks(m: BoundModel) -> DataFrame:
    """The report's blocks written as JSON and read again: (block, item, measure, value)."""
    blocks = report.report_blocks(m.subscriptions, m.support_tickets, m.plans, m.payments)
    out = None
    for name, path in sinks.snk_report(blocks, _folder(m)).items():
        df = m.spark.read.schema(blocks[name].schema).json(path)
        item = next((c for c in ("plan", "month") if c in df.columns), None)
        key = F.col(item).cast("string") if item else F.lit("all")
        values = [c for c in df.columns if c != item]
        one = df.select(key.alias("item"), *[F.col(c).cast("double").alias(c) for c in values]) \
            .unpivot("item", values, "measure", "value").select(F.lit(name).alias("block"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def _clean_layer(m: BoundModel) -> DataFrame:
    """Payments after the whole chain: CSV layer, clean, write, read back."""
    base = _folder(m)
    tables = {"payments": m.dirty_payments, "subscriptions": m.dirty_subscriptions}
    for name, df in tables.items():
        sinks.snk_csv(df, f"{base}/raw/{name}.csv")
    return etl.clean_layer(m.spark, f"{base}/raw", f"{base}/clean",
                           {name: df.schema for name, df in tables.items()})["payments"]


#: The bound tables do not follow the declared region list and date floor: the rules that the
#: checked load of the test tables applies instead, one of them stricter than declared.
LOAD_RULES = {"users": {"domains": {"region": ("AFRICA", "AMERICA", "ASIA", "EUROPE")},
                        "ranges": {"signup_date": (">=", "1995-06-01")}},
              "payments": {"ranges": {"amount": (">=", 1000)}}}


def _checked_layer(m: BoundModel) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """All eight tables through the chain: CSV layer, clean, check, store good and rejected rows."""
    base = _folder(m)
    tables = {**m.tables(), "payments": m.dirty_payments, "subscriptions": m.dirty_subscriptions}
    for name, df in tables.items():
        sinks.snk_csv(df, f"{base}/raw/{name}.csv")
    return etl.load_layer(m.spark, f"{base}/raw", f"{base}/loaded",
                          {name: df.schema for name, df in tables.items()}, LOAD_RULES)


def source_queries() -> dict[str, Query]:
    return {
        "etl_status": _o(lambda m: etl.layer_status(*_checked_layer(m))),
        "etl_rejects": _o(lambda m: rejects.reject_counts(_checked_layer(m)[1])),
        "src_csv": _o(_csv_round_trip),
        "snk_append": _o(_append_twice),
        "src_dir": _o(lambda m: _loaded(readers.src_dir(m.spark, _csv_layer(m)))),
        "src_model": _o(lambda m: _loaded(readers.src_model(m.spark, _csv_layer(m)))),
        "src_coerce": _o(_coerced_tickets),
        "src_defaults": _o(_usage_with_defaults),
        "snk_report": _o(_report_blocks),
        "src_table": _o(lambda m: revenue.q10_nrr_colocated(_stored_payments(m))),
        "etl_layer": _o(_clean_layer),
    }


def report_queries() -> dict[str, Query]:
    return {
        "r1_scorecard": _o(lambda m: report.r1_scorecard(m.subscriptions)),
        "r2_sla_overall": _o(lambda m: report.r2_sla_overall(m.support_tickets)),
        "r3_plan_table": _o(lambda m: report.r3_plan_table(m.subscriptions, m.plans)),
        "r4_last6": _o(lambda m: report.r4_last_months(m.payments)),
        "r5_format_plans": _o(lambda m: report.r5_format_plans(
            report.r3_plan_table(m.subscriptions, m.plans))),
        "r5_format_months": _o(lambda m: report.r5_format_months(
            report.r4_last_months(m.payments))),
    }


def _with_group(m: BoundModel, column: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(subscriptions, payments, churn events) with the plan's name or the user's region."""
    if column == "plan_name":
        names = m.plans.select("plan_id", "plan_name")
        subs = m.subscriptions.join(names, "plan_id")
        return subs, m.payments.join(names, "plan_id"), m.churn_events.join(
            subs.select("subscription_id", "plan_name"), "subscription_id")
    names = m.users.select("user_id", "region")
    return (m.subscriptions.join(names, "user_id"), m.payments.join(names, "user_id"),
            m.churn_events.join(names, "user_id"))


def _cards_by_context(m: BoundModel) -> DataFrame:
    s = (m.subscriptions.join(m.plans.select("plan_id", "plan_name"), "plan_id")
         .join(m.users.select("user_id", "region"), "user_id"))
    return measures.cards_by_context(s, ["plan_name", "region"])


def measure_queries() -> dict[str, Query]:
    return {
        "d_cards_contexts": _o(_cards_by_context),
        "d04_mrr_growth_by_plan": _o(lambda m: measures.mrr_growth(_with_group(m, "plan_name")[0], ["plan_name"])),
        "d04_mrr_growth_by_region": _o(lambda m: measures.mrr_growth(_with_group(m, "region")[0], ["region"])),
        "d06_d07_by_plan": _o(lambda m: measures.retention_12m(*_with_group(m, "plan_name")[1:], ["plan_name"])),
        "d06_d07_by_region": _o(lambda m: measures.retention_12m(*_with_group(m, "region")[1:], ["region"])),
        "d01_mrr": _o(lambda m: measures.d01_mrr(m.subscriptions)),
        "d02_arr": _o(lambda m: measures.d02_arr(m.subscriptions)),
        "d03_arpu": _o(lambda m: measures.d03_arpu(m.subscriptions)),
        "d_cards_total": _o(lambda m: measures.subscription_cards(m.subscriptions)),
        "d_cards_by_plan": _o(lambda m: measures.subscription_cards(
            m.subscriptions.join(m.plans.select("plan_id", "plan_name"), "plan_id"), ["plan_name"])),
        "d_cards_by_region": _o(lambda m: measures.subscription_cards(
            m.subscriptions.join(m.users.select("user_id", "region"), "user_id"), ["region"])),
        "d04_mrr_growth": _o(lambda m: measures.d04_mrr_growth(m.subscriptions)),
        "d05_churn_rate": _o(lambda m: measures.d05_churn_rate(m.subscriptions)),
        "d06_nrr_12m": _o(lambda m: measures.d06_nrr_12m(m.payments, m.churn_events)),
        "d07_grr_12m": _o(lambda m: measures.d07_grr_12m(m.payments, m.churn_events)),
        "d08_ltv": _o(lambda m: measures.d08_ltv(m.subscriptions)),
        "d09_trial_conv": _o(lambda m: measures.d09_trial_conv(m.marketing_campaigns)),
        "d10_retention": _o(lambda m: measures.d10_retention(m.subscriptions)),
        "d11_expansion": _o(lambda m: measures.d11_expansion(m.payments)),
    }


def _paying_rollup(m: BoundModel) -> DataFrame:
    """The state is stored once; every level is merged from it."""
    path = f"{_folder(m)}/paying_state"
    distinct.paying_state(m.payments).write.parquet(path)
    return distinct.paying_rollup(m.spark.read.parquet(path))


def kpi_queries() -> dict[str, Query]:
    return {
        "kpi_monthly_snapshot": _o(lambda m: kpis.kpi_monthly_snapshot(m.subscriptions, to_month=A)),
        "kpi_monthly_paid": _o(lambda m: kpis.kpi_monthly_paid(m.payments)),
        "kpi_plan": _o(lambda m: kpis.kpi_plan(m.payments, m.plans)),
        "kpi_usage": _o(lambda m: kpis.kpi_usage(m.product_usage)),
        "kpi_distinct_rollup": _o(_paying_rollup),
        "iv_activity_within": _o(lambda m: intervals.activity_within(
            m.subscriptions, m.product_usage, m.support_tickets, as_of=A)),
        "iv_plan_overlaps": _o(lambda m: intervals.plan_overlaps(m.subscriptions, m.plans, as_of=A)),
        "gen_billing_schedule": _o(lambda m: kpis.gen_billing_schedule(m.subscriptions, as_of=A)),
        "gen_months_active": _o(lambda m: kpis.gen_months_active(m.subscriptions, as_of=A)),
    }


def notebook_queries() -> dict[str, Query]:
    return {
        "n1_value_counts": _o(lambda m: profile.n1_value_counts(m.users)),
        "n1_plan_profile": _o(lambda m: profile.n1_plan_profile(m.subscriptions, m.plans)),
        "n1_kpi_trend": _o(lambda m: kpis.kpi_monthly_snapshot(m.subscriptions, to_month=A)
                           .orderBy("month").limit(5)),
        "n3_tenure": _o(lambda m: features.n3_tenure(m.subscriptions, baseline=A)),
        "n3_usage_feat": _o(lambda m: features.n3_usage_feat(m.product_usage)),
        "n3_ticket_feat": _o(lambda m: features.n3_ticket_feat(m.support_tickets)),
        "n3_payment_feat": _o(lambda m: features.n3_payment_feat(m.payments)),
        "n3_feature_matrix": _o(_matrix),
        "n3_describe": _o(lambda m: profile.n3_describe(
            _matrix(m), features.FEATURE_MATRIX_NUMERIC)),
        "n4_tier_stats": _o(lambda m: profile.n4_tier_stats(m.subscriptions, m.plans)),
        "n4_ticket_xtab": _o(lambda m: profile.n4_ticket_xtab(m.support_tickets)),
        "n4_channel_churn": _o(lambda m: churn.n4_channel_churn(m.subscriptions, m.users)),
        "n5_cohort_matrix": _o(lambda m: cohort.n5_cohort_matrix(m.payments, m.users)),
        "n5_cohort_head": _o(lambda m: cohort.n5_cohort_head(m.payments, m.users)),
        "n5_model_matrix": _o(lambda m: features.n5_model_matrix(
            m.subscriptions, m.product_usage, m.support_tickets)),
        "n5_split": _o(_split),
        "n5_random_forest": _o(_pred),
        "n5_class_report": _o(lambda m: ml.n5_class_report(_pred(m))),
        "n5_importances": _o(lambda m: ml.n5_importances(_fit(m)[0])),
        "n5_auc": _o(lambda m: ml.n5_auc(_pred(m))),
        "n5_auc_exact": _o(lambda m: ml.exact_auc(_fixed_score(m), "score", "label")),
        "n5_class_report_fixed": _o(lambda m: ml.n5_class_report(_fixed_score(m))),
    }



def extension_queries() -> dict[str, Query]:
    return {
        "x_ticket_alert": _o(lambda m: extensions.x_ticket_alert(
            m.support_tickets, m.subscriptions, m.plans)),
        # the bound payments recur every 30 days, so the retry window is one cycle
        "x_retry_recovery": _o(lambda m: extensions.x_retry_recovery(m.payments, days=30)),
        "x_engagement_target": _o(lambda m: extensions.x_engagement_target(
            m.subscriptions, m.plans, m.product_usage, window_start=TEST_WINDOW_START)),
        "x_trend_forecast": _o(lambda m: extensions.x_trend_forecast(
            kpis.kpi_monthly_paid(m.payments))),
        # Structured Streaming over the stored tables' Parquet folders (availableNow)
        "x_stream_kpis": _o(lambda m: stream_kpis.run_daily_totals(
            m.spark, stored_folder(m, "payments"))),
        "x_stream_ticket_alert": _o(lambda m: stream_kpis.run_available_now(
            m.spark, stream_kpis.start_ticket_alerts, stored_folder(m, "support_tickets"),
            m.subscriptions, m.plans)),
        "x_stream_ticket_state": _o(lambda m: stream_tickets.run_unresolved(
            m.spark, m.support_tickets, m.subscriptions, m.plans, close_at=f"{A} 00:00:00")),
        "x_stream_monthly_paid": _o(lambda m: stream_upsert.run_monthly(
            m.spark, stored_folder(m, "payments"), stream_upsert.PAID)),
        "x_stream_monthly_sla": _o(lambda m: stream_upsert.run_monthly(
            m.spark, stored_folder(m, "support_tickets"), stream_upsert.sla())),
    }


def all_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    q.update(business_queries())
    q.update(quality_queries())
    q.update(source_queries())
    q.update(report_queries())
    q.update(measure_queries())
    q.update(kpi_queries())
    q.update(notebook_queries())
    q.update(extension_queries())
    for alias, key in ALIASES.items():
        q[alias] = q[key]
    return q


# SURVEY key names that are the same operator as another registered key
ALIASES = {"aud_nulls_q13": "q13_nulls", "aud_dup_payments_q14": "q14_dup_payments",
           "aud_rowcount_distinct": "k2_quality_profile", "r5_format": "r5_format_months"}
