"""Checks on the curated tables. Each returns the offending rows or the counts to compare."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CASH_CHANNELS = ("branch", "atm")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _references(child: DataFrame, rules: dict[str, tuple[str, str]], *keep: Column, nullable: bool = False) -> DataFrame:
    """``rule, parent, missing_key`` for each reference of a row, all from one reading of the table; ``rules``
    names the column and the parent of each."""
    each = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(parent).alias("parent"), F.col(key).alias("missing_key"))
        for rule, (key, parent) in rules.items()
    ])
    found = child.select(*keep, F.inline(each))
    return found.filter(F.col("missing_key").isNotNull()) if nullable else found


def _parents(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    return _union([
        table.select(F.lit(name).alias("parent"), F.col(key).alias("missing_key")) for name, (table, key) in tables.items()
    ])


def orphan_check(
    customer: DataFrame, account: DataFrame, session: DataFrame, transaction: DataFrame
) -> DataFrame:
    """Four counts in one row; every one should be 0. A null owner or account is an orphan too,
    but a transaction may lack either side. References are counted by key before they are looked up."""
    asked = _union([
        _references(account, {"orphan_accounts": ("customer_id", "customer")}),
        _references(session, {"orphan_sessions": ("account_id", "account")}),
        _references(transaction, {
            "orphan_txn_src": ("account_id", "account"), "orphan_txn_dst": ("counterparty_account_id", "account"),
        }, nullable=True),
    ])
    found = (
        asked.groupBy("rule", "parent", "missing_key").agg(F.count(F.lit(1)).alias("n"))
        .join(_parents({"customer": (customer, "customer_id"), "account": (account, "account_id")}),
              ["parent", "missing_key"], "left_anti")
    )
    names = ("orphan_accounts", "orphan_sessions", "orphan_txn_src", "orphan_txn_dst")
    return found.agg(*[F.coalesce(F.sum(F.when(F.col("rule") == x, F.col("n"))), F.lit(0)).alias(x) for x in names])


def null_landing_check(transaction: DataFrame) -> DataFrame:
    return transaction.groupBy("txn_type").agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.count("account_id").alias("has_src"),
        F.count("counterparty_account_id").alias("has_dst"),
        F.count("branch_code").alias("has_branch"),
    )


def variant_shape_check(customer: DataFrame) -> DataFrame:
    """How many documents of each customer type have a key; a JSON null counts as having it."""

    def has(key: str) -> Column:
        return F.count(F.variant_get("kyc_payload", f"$.{key}", "variant"))

    return customer.groupBy("customer_type").agg(
        F.count(F.lit(1)).alias("customers"),
        has("abn").alias("have_abn"),
        has("identity_documents").alias("have_id_docs"),
        has("directors").alias("have_directors"),
    )


def structuring_band_check(transaction: DataFrame) -> DataFrame:
    in_band = F.expr("amount between 7000 and 9999.99")
    return transaction.filter("txn_type = 'cash_deposit'").agg(
        F.count(F.lit(1)).alias("cash_deposits"),
        F.sum(F.when(in_band, 1).otherwise(0)).alias("in_structuring_band"),
        F.max("amount").alias("largest"),
    )


def fk_violations(
    customer: DataFrame,
    account: DataFrame,
    device: DataFrame,
    ip_address: DataFrame,
    session: DataFrame,
    transaction: DataFrame,
) -> DataFrame:
    """``(rule, row_id, missing_key)`` for every reference that leads nowhere. Transactions may
    leave theirs null; accounts and sessions may not."""

    asked = _union([
        _references(account, {"account -> customer": ("customer_id", "customer")}, F.col("account_id").alias("row_id")),
        _references(session, {
            "session -> account": ("account_id", "account"), "session -> device": ("device_id", "device"),
            "session -> ip": ("ip_id", "ip"),
        }, F.col("session_id").alias("row_id")),
        _references(transaction, {
            "transaction -> account": ("account_id", "account"),
            "transaction -> counterparty": ("counterparty_account_id", "account"),
            "transaction -> session": ("session_id", "session"),
        }, F.col("transaction_id").alias("row_id"), nullable=True),
    ])
    parents = _parents({
        "customer": (customer, "customer_id"), "account": (account, "account_id"), "device": (device, "device_id"),
        "ip": (ip_address, "ip_id"), "session": (session, "session_id"),
    })
    return asked.join(parents, ["parent", "missing_key"], "left_anti").select("rule", "row_id", "missing_key")


def session_owner_violations(transaction: DataFrame, session: DataFrame) -> DataFrame:
    """Transactions whose session belongs to another account than the payer's."""
    owner = session.select("session_id", F.col("account_id").alias("session_account"))
    return (
        transaction.select("transaction_id", "session_id", "account_id")
        .join(owner, "session_id")
        .filter("not (session_account <=> account_id)")
        .select("transaction_id", "session_id", "session_account", "account_id")
    )


def null_rule_violations(transaction: DataFrame) -> DataFrame:
    """``(rule, transaction_id)``, one row per broken rule, over all transactions."""
    cash = F.coalesce(F.col("channel").isin(*CASH_CHANNELS), F.lit(False))
    broken = {
        "cash_deposit has a payer": (F.col("txn_type") == "cash_deposit")
        & F.col("account_id").isNotNull(),
        "cash_withdrawal has a receiver": (F.col("txn_type") == "cash_withdrawal")
        & F.col("counterparty_account_id").isNotNull(),
        "cash channel without branch": cash & F.col("branch_code").isNull(),
        "digital channel with branch": ~cash & F.col("branch_code").isNotNull(),
    }
    rules = F.array(*[F.when(test, F.lit(rule)) for rule, test in broken.items()])
    return transaction.select(F.explode(F.array_compact(rules)).alias("rule"), "transaction_id")


def ground_truth_coverage(transaction: DataFrame, ground_truth: DataFrame) -> DataFrame:
    """Transactions without a label and labels without a transaction."""
    ids = (
        transaction.select("transaction_id", F.lit(1).alias("t"), F.lit(0).alias("g"))
        .unionByName(ground_truth.select("transaction_id", F.lit(0).alias("t"), F.lit(1).alias("g")))
        .groupBy("transaction_id")
        .agg(F.max("t").alias("t"), F.max("g").alias("g"))
    )
    return ids.agg(F.sum(F.expr("t * (1 - g)")).alias("unlabelled"), F.sum(F.expr("g * (1 - t)")).alias("orphaned"))


def payload_shape_diff(customer: DataFrame) -> DataFrame:
    """Keys of the customer documents and which customer types have them."""
    keys = (
        customer.select("customer_type", F.json_object_keys(F.to_json("kyc_payload")).alias("keys"))
        .select("customer_type", F.explode("keys").alias("key"))
        .distinct()
    )

    def used_by(kind: str) -> Column:
        return F.max((F.col("customer_type") == kind).cast("int")) == 1

    return keys.groupBy("key").agg(
        used_by("business").alias("in_business"), used_by("retail").alias("in_retail")
    )


def label_histogram(ground_truth: DataFrame) -> DataFrame:
    """Rows, share in percent and distinct chains per label."""
    total = ground_truth.agg(F.count(F.lit(1))).scalar()
    return ground_truth.groupBy("pattern_label").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("chain_id").alias("chains")
    ).withColumn("pct", F.round(F.lit(100.0) * F.col("n") / total, 2))
