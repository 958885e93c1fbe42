"""Mule rings: one device, several customers, new accounts that pass money straight on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import days, decimal
from tidewatch.operators.evidence import PART, in_parts, listed
from tidewatch.operators.intervals import follow_on_pairs


def pass_through(
    transaction: DataFrame,
    min_amount: str = "1000",
    keep: str = "0.90",
    within_hours: int = 24,
) -> DataFrame:
    """Accounts that receive at least ``min_amount`` and pay 90 to 100 % out within a day."""
    done = transaction.filter("status = 'completed'")
    received = done.filter(F.col("amount") >= decimal(min_amount)).select(
        F.col("counterparty_account_id").alias("at"), F.col("txn_time").alias("time"), "amount"
    )
    paid = done.filter(F.col("amount") >= decimal(min_amount) * decimal(keep)).select(
        F.col("account_id").alias("then_at"),
        F.col("txn_time").alias("then_time"),
        F.col("amount").alias("then_amount"),
    )
    # a cell's payments are few, and hashing those spares a sort of everything that was received
    kept = follow_on_pairs(
        received.filter("at is not null"),
        paid.filter("then_at is not null").hint("shuffle_hash"),
        within_hours=within_hours,
        keep=keep,
        how="left_semi",
    )
    return kept.select(F.col("at").alias("account_id")).distinct()


def mule_members(
    session: DataFrame,
    account: DataFrame,
    transaction: DataFrame,
    passing: DataFrame,
    opened_within_days: int = 150,
) -> DataFrame:
    """Distinct ``(device_id, account_id, customer_id)`` of new pass-through accounts.

    New means opened no earlier than so many days before the first transaction on record.
    """
    first_day = transaction.agg(F.min("txn_time").cast("date")).scalar()
    recent = (
        account.select("account_id", "customer_id", "open_date")
        .join(passing, "account_id", "left_semi")
        .filter(F.col("open_date") >= first_day - days(opened_within_days))
        .select("account_id", "customer_id")
    )
    logins = session.select("device_id", "account_id").distinct()
    return logins.join(recent, "account_id").select("device_id", "account_id", "customer_id")


def mule_ring(members: DataFrame, min_customers: int = 3) -> DataFrame:
    """Devices shared by ``min_customers`` or more distinct customers among the members."""
    return (
        members.groupBy("device_id")
        .agg(
            F.countDistinct("customer_id").alias("n_customers"),
            F.count(F.lit(1)).alias("n_accounts"),
            F.min("account_id").alias("first_account"),
        )
        .filter(F.col("n_customers") >= min_customers)
        .withColumn("tier", F.lit("medium"))
    )


def mule_accounts(members: DataFrame, rings: DataFrame, part: int = PART) -> DataFrame:
    """``(device_id, part, parts, accounts)``: the accounts of each ring, in parts."""
    found = in_parts(ring_members(members, rings), rings, "device_id", "n_accounts", "account_id", part)
    return found.groupBy("device_id", "part", "parts").agg(listed([], "account_id").alias("accounts"))


def ring_members(members: DataFrame, rings: DataFrame) -> DataFrame:
    """The members of the detected rings, one row each; the full evidence at any size."""
    return members.join(rings.select("device_id"), "device_id", "left_semi")
