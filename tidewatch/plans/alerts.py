"""One alert per detection, with its evidence as a document.

The document of a device or account names it and counts its accounts or deposits; their ids are
in the detection's lists, under the same device or account id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import padded_id
from tidewatch.staging import number_rows

HIGH_SCORE, MEDIUM_SCORE = 90, 60


def _alert(
    detections: DataFrame, kind: str, account: str, txn: Column, key: str, fields: list[str],
    score: Column | None = None,
) -> DataFrame:
    return detections.select(
        F.col(account).alias("account_id"),
        txn.cast("string").alias("transaction_id"),
        F.lit(kind).alias("alert_type"),
        (F.lit(MEDIUM_SCORE) if score is None else score).cast("decimal(5,2)").alias("fraud_score"),
        F.to_json(F.struct(*fields)).alias("_detail"),
        F.col(key).alias("_key"),
    )


def alert_round_trip(rings: DataFrame) -> DataFrame:
    return _alert(
        rings, "round_trip", "origin", F.element_at("txn_ids", 1), "path_key",
        ["tier", "closed_by", "closed_on", "hops", "path", "txn_ids", "first_amount",
         "last_amount", "decay_pct", "shared_via"],
        F.when(F.col("tier") == "high", HIGH_SCORE).otherwise(MEDIUM_SCORE),
    )


def alert_layering(chains: DataFrame) -> DataFrame:
    return _alert(
        chains, "layering_chain", "origin", F.element_at("txn_ids", 1), "path_key",
        ["tier", "hops", "path", "txn_ids", "first_amount", "last_amount", "decay_pct"],
    )


def alert_mule(mules: DataFrame) -> DataFrame:
    return _alert(
        mules, "mule_network", "first_account", F.lit(None), "device_id",
        ["tier", "device_id", "n_customers", "n_accounts"],
    )


def alert_structuring(accounts: DataFrame) -> DataFrame:
    return _alert(
        accounts, "structuring", "account_id", F.col("first_txn"), "account_id",
        ["tier", "n_days", "n_deposits", "total_amount", "n_branches", "first_day", "last_day"],
    )


def fraud_alert(
    rings: DataFrame,
    chains: DataFrame,
    mules: DataFrame,
    accounts: DataFrame,
    raised_at: Column | None = None,
) -> DataFrame:
    """All alerts, numbered by type, account, first transaction (none last) and evidence key."""
    found = (
        alert_round_trip(rings)
        .unionByName(alert_layering(chains))
        .unionByName(alert_mule(mules))
        .unionByName(alert_structuring(accounts))
    )
    order = [
        F.col("alert_type"), F.col("account_id").asc_nulls_last(),
        F.col("transaction_id").asc_nulls_last(), F.col("_key"),
    ]
    return number_rows(found, order, "_number").select(
        padded_id("ALT-", F.col("_number"), 6).alias("alert_id"),
        "account_id",
        "transaction_id",
        "alert_type",
        "fraud_score",
        F.parse_json("_detail").alias("trigger_detail"),
        F.lit("open").alias("status"),
        F.lit(None).cast("string").alias("disposition"),
        (F.localtimestamp() if raised_at is None else raised_at).alias("raised_at"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        F.lit(None).cast("string").alias("investigator"),
    )


def _detail(path: str, kind: str) -> Column:
    return F.variant_get("trigger_detail", f"$.{path}", kind)


def v_dash_rings(alerts: DataFrame) -> DataFrame:
    """Ring and chain alerts with the fields of their documents; the path reads a -> b -> c."""
    return alerts.filter(F.col("alert_type").isin("round_trip", "layering_chain")).select(
        "alert_id",
        _detail("tier", "string").alias("tier"),
        _detail("closed_by", "string").alias("closed_by"),
        _detail("hops", "int").alias("hops"),
        F.array_join(_detail("path", "array<string>"), " -> ").alias("path"),
        _detail("first_amount", "decimal(18,2)").alias("first_amount"),
        _detail("last_amount", "decimal(18,2)").alias("last_amount"),
        _detail("decay_pct", "decimal(5,1)").alias("decay_pct"),
    )


def mule_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.filter("alert_type = 'mule_network'").select(
        "alert_id",
        _detail("device_id", "string").alias("device_id"),
        _detail("n_customers", "int").alias("n_customers"),
    )


def v_dash_mule(alerts: DataFrame, lists: DataFrame) -> DataFrame:
    """Mule alerts with the accounts of their devices, one row for each part of a list."""
    found = mule_alerts(alerts).join(lists, "device_id")
    return found.select(
        "alert_id", "device_id", "n_customers", "part", "parts", F.array_join("accounts", ", ").alias("accounts")
    )


def with_tier(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("tier", _detail("tier", "string"))


def v_dash_alert_summary(alerts: DataFrame) -> DataFrame:
    return with_tier(alerts).groupBy("alert_type", "tier").agg(F.count(F.lit(1)).alias("alerts"))
