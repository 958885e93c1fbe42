"""Structuring: cash deposits kept just under the reporting threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.functions.columns import days, decimal
from tidewatch.operators.evidence import PART, in_parts, listed
from tidewatch.staging import ranged, stage

REPORTING_THRESHOLD = "10000"
MEASURES = ("n", "amount", "branches")


def band_deposits(transaction: DataFrame, low: str = "7000", high: str = "9999.99") -> DataFrame:
    """Completed cash deposits in the band under the threshold."""
    return transaction.filter(
        (F.col("txn_type") == "cash_deposit")
        & (F.col("status") == "completed")
        & F.col("amount").between(decimal(low), decimal(high))
    ).select(
        "transaction_id",
        F.col("counterparty_account_id").alias("account_id"),
        F.col("txn_time").cast("date").alias("day"),
        "txn_time",
        "amount",
        "branch_code",
    )


def flagged_deposits(
    transaction: DataFrame, min_deposits: int = 2, min_total: str = REPORTING_THRESHOLD
) -> DataFrame:
    """Deposits on account-days with several of them that add up to the threshold."""
    deposits = band_deposits(transaction)
    flagged = (
        deposits.groupBy("account_id", "day")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_sum"))
        .filter((F.col("_n") >= min_deposits) & (F.col("_sum") >= decimal(min_total)))
        .select("account_id", "day")
    )
    return deposits.join(flagged, ["account_id", "day"], "left_semi")


def structuring_daily(deposits: DataFrame) -> DataFrame:
    """One row per account with flagged days, from its flagged deposits."""
    return deposits.groupBy("account_id").agg(
        F.countDistinct("day").alias("n_days"),
        F.count(F.lit(1)).alias("n_deposits"),
        F.sum("amount").cast("decimal(28,2)").alias("total_amount"),
        F.countDistinct("branch_code").alias("n_branches"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.min(F.struct("txn_time", "transaction_id")).getField("transaction_id").alias("first_txn"),
        F.lit("medium").alias("tier"),
    )


def deposit_lists(deposits: DataFrame, totals: DataFrame, part: int = PART) -> DataFrame:
    """``(account_id, part, parts, branches, txn_ids)``: the deposits of each account in parts, and
    the branches of each part's deposits."""
    found = in_parts(deposits, totals, "account_id", "n_deposits", "transaction_id", part)
    return found.groupBy("account_id", "part", "parts").agg(
        F.array_sort(F.collect_set("branch_code")).alias("branches"),
        listed(["txn_time"], "transaction_id").alias("txn_ids"),
    )


def branch_deposits(transaction: DataFrame, below: str = REPORTING_THRESHOLD) -> DataFrame:
    """Completed cash deposits under the threshold with a known account and branch."""
    return transaction.filter(
        (F.col("txn_type") == "cash_deposit")
        & (F.col("status") == "completed")
        & (F.col("amount") < decimal(below))
        & F.col("counterparty_account_id").isNotNull()
        & F.col("branch_code").isNotNull()
    ).select(
        "transaction_id",
        F.col("counterparty_account_id").alias("account_id"),
        "txn_time",
        "amount",
        "branch_code",
    )


def _branch_presence(deposits: DataFrame, window_days: int) -> DataFrame:
    """+1 when a branch enters an account's window, -1 when it leaves it.

    A deposit keeps its branch in the window until ``window_days`` later or until the next
    deposit at that branch takes over. The next one is looked up within a range of the times;
    the last of a range looks at the first of the range that follows.
    """
    pair = ["account_id", "branch_code"]
    times = ranged(deposits.select(*pair, "txn_time").distinct(), *pair, "txn_time")
    key = [*pair, "_slot"]
    following = times.groupBy(*key).agg(F.min("txn_time").alias("_first")).select(
        *key, F.lead("_first").over(Window.partitionBy(*pair).orderBy("_slot")).alias("_next_first")
    )
    in_range = F.lead("txn_time").over(Window.partitionBy(*key).orderBy("txn_time"))
    spans = (
        times.withColumn("_next", in_range)
        .join(following, key)
        .select(
            "account_id",
            F.col("txn_time").alias("_from"),
            F.least(
                F.col("txn_time") + days(window_days), F.coalesce("_next", "_next_first")
            ).alias("_to"),
        )
    )
    moves = F.array(
        F.struct(F.col("_from").alias("at"), F.lit(1).alias("branches")),
        F.struct(F.col("_to").alias("at"), F.lit(-1).alias("branches")),
    )
    return spans.select("account_id", F.explode(moves).alias("m")).select("account_id", "m.*")


def window_steps(deposits: DataFrame, window_days: int = 10) -> DataFrame:
    """How count, sum and number of branches in an account's window change, per moment: every
    deposit enters the window at its time and leaves it ``window_days`` later."""
    moves = F.array(
        F.struct(
            F.col("txn_time").alias("at"), F.lit(1).alias("n"), F.col("amount"),
            F.lit(1).alias("arrivals"),
        ),
        F.struct(
            (F.col("txn_time") + days(window_days)).alias("at"), F.lit(-1).alias("n"),
            (-F.col("amount")).alias("amount"), F.lit(0).alias("arrivals"),
        ),
    )
    moving = deposits.select("account_id", F.explode(moves).alias("m")).select(
        "account_id", "m.at", "m.n", "m.amount", F.lit(0).alias("branches"), "m.arrivals"
    )
    presence = _branch_presence(deposits, window_days).select(
        "account_id", "at", F.lit(0).alias("n"), F.lit(0).cast("decimal(18,2)").alias("amount"),
        "branches", F.lit(0).alias("arrivals"),
    )
    return (
        moving.unionByName(presence)
        .groupBy("account_id", "at")
        .agg(*[F.sum(c).alias(c) for c in [*MEASURES, "arrivals"]])
    )


def window_totals(steps: DataFrame) -> DataFrame:
    """Count, sum and number of branches of the window that ends at each deposit time.

    All three are running sums over the steps. The steps are ranged by account and time; sums run
    within a range, and start from the account's totals in the ranges before it. However busy an
    account is, a task holds one range.
    """
    steps = ranged(steps, "account_id", "at")
    earlier = (
        Window.partitionBy("account_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        steps.groupBy("account_id", "_slot")
        .agg(*[F.sum(c).alias(c) for c in MEASURES])
        .select(
            "account_id",
            "_slot",
            *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in MEASURES],
        )
    )
    so_far = (
        Window.partitionBy("account_id", "_slot")
        .orderBy("at")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        steps.select(
            "account_id", "_slot", "at", "arrivals",
            *[F.sum(c).over(so_far).alias(f"in_{c}") for c in MEASURES],
        )
        .filter("arrivals > 0")
        .join(carried, ["account_id", "_slot"])
        .select(
            "account_id",
            F.col("at").alias("window_end"),
            (F.col("in_n") + F.col("_n")).cast("bigint").alias("n_deposits"),
            (F.col("in_branches") + F.col("_branches")).cast("bigint").alias("n_branches"),
            (F.col("in_amount") + F.col("_amount")).cast("decimal(28,2)").alias("total_amount"),
        )
    )


def densest_windows(totals: DataFrame, min_deposits: int = 5, min_branches: int = 2) -> DataFrame:
    """Per account the window with most deposits, then the largest sum, then the earliest end."""
    windows = totals.filter(
        (F.col("n_deposits") >= min_deposits) & (F.col("n_branches") >= min_branches)
    )
    rank = F.struct(-F.col("n_deposits"), -F.col("total_amount"), F.col("window_end"))
    return windows.groupBy("account_id").agg(F.min(rank).getField("window_end").alias("window_end"))


def window_deposits(
    transaction: DataFrame, window_days: int = 10, min_deposits: int = 5, min_branches: int = 2
) -> DataFrame:
    """The deposits inside each account's densest window."""
    deposits = stage(branch_deposits(transaction), "branch-deposits")
    totals = window_totals(window_steps(deposits, window_days))
    windows = densest_windows(totals, min_deposits, min_branches)
    return (
        deposits.join(windows, "account_id")
        .filter(F.col("txn_time") <= F.col("window_end"))
        .filter(F.col("txn_time") > F.col("window_end") - days(window_days))
    )


def structuring_rolling(inside: DataFrame) -> DataFrame:
    """One row per account: its densest window of deposits spread over several branches."""
    totals = inside.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("n_deposits"),
        F.countDistinct("branch_code").alias("n_branches"),
        F.sum("amount").cast("decimal(28,2)").alias("total_amount"),
        F.max("amount").alias("max_single"),
        F.min("txn_time").cast("date").alias("first_day"),
        F.max("txn_time").cast("date").alias("last_day"),
    )
    return totals.withColumns(
        {
            "n_days": F.datediff("last_day", "first_day") + 1,
            "tier": F.when(F.col("n_branches") >= 3, "high").otherwise("medium"),
        }
    )


def structuring_summary(rolling: DataFrame) -> DataFrame:
    return rolling.groupBy("tier").agg(
        F.count(F.lit(1)).alias("accounts"),
        F.sum("n_deposits").alias("deposits"),
        F.round(F.avg("n_days"), 1).alias("avg_days"),
        F.round(F.avg("total_amount")).alias("avg_total"),
    )
