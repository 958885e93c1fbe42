"""The numbers behind the dashboards: lists, counts, drill-downs and headline figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import labels
from tidewatch.operators.rings import member_links
from tidewatch.plans.alerts import mule_alerts, v_dash_alert_summary, v_dash_mule, v_dash_rings, with_tier

PATH_ALERTS = ("round_trip", "layering_chain")


def rings_by_tier(alerts: DataFrame) -> DataFrame:
    summary = v_dash_alert_summary(alerts)
    return summary.filter(F.col("alert_type").isin(*PATH_ALERTS)).orderBy("alert_type", "tier")


def ring_list(alerts: DataFrame) -> DataFrame:
    return v_dash_rings(alerts).orderBy("tier", F.desc("hops"))


def ring_length(alerts: DataFrame) -> DataFrame:
    """Detections per number of hops and type."""
    kind = labels.detection_type(F.col("closed_by")).alias("type")
    return v_dash_rings(alerts).groupBy("hops", kind).agg(F.count(F.lit(1)).alias("n")).orderBy("hops")


def identity_links(link_counts: DataFrame) -> DataFrame:
    return link_counts.orderBy(F.desc("pairs"))


def mule_list(alerts: DataFrame, lists: DataFrame) -> DataFrame:
    return v_dash_mule(alerts, lists).orderBy(F.desc("n_customers"), "device_id", "part")


def mule_size(alerts: DataFrame) -> DataFrame:
    found = mule_alerts(alerts)
    return found.groupBy("n_customers").agg(F.count(F.lit(1)).alias("rings")).orderBy("n_customers")


def open_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.filter("status = 'open'").agg(F.count(F.lit(1)).alias("open_alerts"))


def alerts_by_type(alerts: DataFrame) -> DataFrame:
    return v_dash_alert_summary(alerts).orderBy("alert_type", "tier")


def alert_queue(alerts: DataFrame, types: list[str] | None = None) -> DataFrame:
    """Alerts, highest score first, optionally of some types only."""
    if types is not None:
        alerts = alerts.filter(F.col("alert_type").isin(*types))
    return (
        with_tier(alerts)
        .withColumn("closed_by", F.variant_get("trigger_detail", "$.closed_by", "string"))
        .select(
            "alert_id", "alert_type", "fraud_score", "account_id", "tier", "closed_by", "status",
            "raised_at",
        )
        .orderBy(F.desc("fraud_score"), "alert_id")
    )


def structuring_list(found: DataFrame) -> DataFrame:
    return found.select(
        "account_id", "n_days", "n_deposits", "total_amount", "n_branches", "first_day", "last_day"
    ).orderBy(F.desc("total_amount"))


def benchmark_list(benchmark: DataFrame) -> DataFrame:
    return benchmark.orderBy("pattern_label")


def ring_edges(alerts: DataFrame, edges: DataFrame) -> DataFrame:
    """The transfers of every ring and chain alert, in order of time. Filter by alert id for one
    picture."""
    txn_ids = F.variant_get("trigger_detail", "$.txn_ids", "array<string>")
    parts = alerts.filter(F.col("alert_type").isin(*PATH_ALERTS)).select(
        "alert_id", F.explode(txn_ids).alias("transaction_id")
    )
    return edges.join(parts, "transaction_id").select(
        "alert_id", "src", "dst", "amount", F.date_format("txn_time", "dd MMM HH:mm").alias("ts"),
        "txn_time", "transaction_id",
    ).orderBy("alert_id", "txn_time", "transaction_id")


def ring_identity_links(alerts: DataFrame, shared: DataFrame) -> DataFrame:
    """Linked members of every ring and chain alert, each pair once per kind."""
    path = F.variant_get("trigger_detail", "$.path", "array<string>")
    members = alerts.filter(F.col("alert_type").isin(*PATH_ALERTS)).select(
        F.col("alert_id").alias("path_key"), path.alias("path")
    )
    found = member_links(members, shared)
    return found.select(F.col("path_key").alias("alert_id"), "a", "b", "via").distinct()


def mule_members(alerts: DataFrame, mule_found: DataFrame, account: DataFrame) -> DataFrame:
    """Members of every mule alert with the day their account was opened."""
    by_device = mule_alerts(alerts).select("alert_id", "device_id")
    opened = account.select("account_id", F.date_format("open_date", "dd MMM yyyy").alias("opened"))
    return (
        mule_found.join(by_device, "device_id")
        .join(opened, "account_id")
        .select("alert_id", "account_id", "customer_id", "opened", "device_id")
    )


def _count_if(condition: str):
    return F.sum(F.when(F.expr(condition), 1).otherwise(0)).cast("bigint")


def kpi_rings(alerts: DataFrame) -> DataFrame:
    paths = with_tier(alerts)
    return paths.agg(
        F.coalesce(_count_if("alert_type = 'round_trip'"), F.lit(0)).alias("round_trips"),
        F.coalesce(_count_if("alert_type = 'round_trip' and tier = 'high'"), F.lit(0)).alias("high"),
        F.coalesce(_count_if("alert_type = 'round_trip' and tier <> 'high'"), F.lit(0)).alias("medium"),
        F.coalesce(_count_if("alert_type = 'layering_chain'"), F.lit(0)).alias("layering_chains"),
    )


def kpi_mule(mules: DataFrame, link_counts: DataFrame) -> DataFrame:
    return mules.agg(
        F.count(F.lit(1)).alias("mule_rings"),
        F.coalesce(F.sum("n_customers"), F.lit(0)).alias("customers"),
        F.coalesce(F.sum("n_accounts"), F.lit(0)).alias("accounts"),
    ).withColumn("identity_links", link_counts.agg(F.coalesce(F.sum("pairs"), F.lit(0))).scalar())


def kpi_alerts(alerts: DataFrame) -> DataFrame:
    return with_tier(alerts).agg(
        F.coalesce(_count_if("status = 'open'"), F.lit(0)).alias("open_alerts"),
        F.coalesce(_count_if("tier = 'high'"), F.lit(0)).alias("high"),
        F.coalesce(_count_if("tier = 'medium'"), F.lit(0)).alias("medium"),
        F.countDistinct("alert_type").alias("alert_types"),
    )


def kpi_quality(benchmark: DataFrame) -> DataFrame:
    return benchmark.agg(
        F.sum("found_full").alias("found"),
        F.sum("chains").alias("injected"),
        F.sum("found_partial").alias("partial"),
        F.sum("missed").alias("missed"),
        F.sum("false_positives").alias("false_positives"),
    ).withColumn("recall_pct", F.round(F.lit(100.0) * F.col("found") / F.col("injected"), 0))


def recall_table(benchmark: DataFrame) -> DataFrame:
    """Recall per pattern in percent, in the fixed order of patterns."""
    return (
        benchmark.filter("chains is not null")
        .select(
            labels.pattern_rank(F.col("pattern_label")).alias("rank"),
            labels.pattern_name(F.col("pattern_label")).alias("pattern"),
            F.col("chains").alias("injected"),
            F.col("found_full").alias("found"),
            F.col("found_partial").alias("partial"),
            "missed",
            (F.lit(100.0) * F.col("found_full") / F.col("chains")).alias("recall"),
            labels.tier_list(F.col("tiers")).alias("tier"),
        )
        .orderBy("rank")
    )


def outcome_unpivot(benchmark: DataFrame) -> DataFrame:
    """Found, partial and missed cases as rows; outcomes without cases are left out."""
    names = list(labels.OUTCOMES)
    return (
        benchmark.filter("chains is not null")
        .withColumn("pattern", labels.pattern_name(F.col("pattern_label")))
        .unpivot("pattern", names, "_code", "cases")
        .filter("cases > 0")
        .select(
            "pattern",
            labels.lookup(labels.OUTCOMES, F.col("_code")).alias("outcome"),
            "cases",
            labels.lookup({n: i for i, n in enumerate(names)}, F.col("_code")).alias("rank"),
        )
    )


def fp_by_detector(benchmark: DataFrame, alerts: DataFrame) -> DataFrame:
    """False positives next to the number of alerts of each detector."""
    totals = alerts.groupBy("alert_type").agg(F.count(F.lit(1)).alias("_alerts"))
    rows = benchmark.filter("false_positives is not null").select(
        F.coalesce(labels.lookup(labels.DETECTORS, F.col("pattern_label")), "pattern_label").alias(
            "alert_type"
        ),
        "false_positives",
    )
    return rows.join(totals, "alert_type", "left").select(
        labels.pattern_name(F.col("alert_type")).alias("detector"),
        F.coalesce("_alerts", F.lit(0)).alias("alerts"),
        "false_positives",
    )


def display_labels(alerts: DataFrame, types: list[str] | None = None) -> DataFrame:
    """The alert queue as shown: names instead of codes."""
    return alert_queue(alerts, types).select(
        "alert_id",
        labels.pattern_name(F.col("alert_type")).alias("type"),
        F.col("fraud_score").cast("int").alias("score"),
        labels.tier_name(F.col("tier")).alias("tier"),
        labels.closed_by_name(F.col("closed_by")).alias("closed_by"),
        F.col("account_id").alias("account"),
        labels.capitalized(F.col("status")).alias("status"),
        F.date_format("raised_at", "dd MMM yyyy HH:mm").alias("raised"),
    )
