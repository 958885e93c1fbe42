"""Nearest row in time, on either side, within the same account."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.staging import ranged


def nearest_session_join(transaction: DataFrame, session: DataFrame) -> DataFrame:
    """For each transaction with a payer, the payer's session closest in time.

    Of a session before and one at or after, the nearer wins; at an equal gap the earlier one.
    Transactions of accounts without sessions get null. Transactions and sessions are merged
    and ranged by account and time, and each looks back (and ahead) within its range; what lies
    beyond comes from one row per account and range, the last (first) session of the nearest
    range that has any. However busy an account is, a task holds one range.
    """
    point = "struct<time:timestamp_ntz,id:string>"
    txns = transaction.filter("account_id is not null").select(
        "account_id", F.col("txn_time").alias("time"), "transaction_id",
        F.lit(None).cast(point).alias("s"),
    )
    sessions = session.select(
        "account_id", F.col("session_time").alias("time"),
        F.lit(None).cast("string").alias("transaction_id"),
        F.struct(F.col("session_time").alias("time"), F.col("session_id").alias("id")).alias("s"),
    )
    # at the same time a transaction sorts before sessions: those count as "at or after"
    merged = txns.unionByName(sessions).withColumn("_kind", F.when(F.col("s").isNull(), 0).otherwise(1))
    merged = ranged(merged, "account_id", "time", "_kind", "s.id")
    key = ["account_id", "_slot"]
    ahead = Window.partitionBy(*key).orderBy(F.desc("time"), F.desc("_kind"), F.desc("s.id"))
    behind = Window.partitionBy(*key).orderBy("time", "_kind", "s.id")

    def nearest_so_far(window):
        return F.last("s", ignorenulls=True).over(
            window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )

    in_range = (
        merged.withColumn("_before", nearest_so_far(behind))
        .withColumn("_after", nearest_so_far(ahead))
        .filter("_kind = 0")
        .select(*key, "transaction_id", "time", "_before", "_after")
    )
    ranges = merged.groupBy(*key).agg(F.min("s").alias("_first"), F.max("s").alias("_last"))
    upwards = Window.partitionBy("account_id").orderBy("_slot")
    downwards = Window.partitionBy("account_id").orderBy(F.desc("_slot"))
    beyond = ranges.select(
        *key,
        F.last("_last", ignorenulls=True)
        .over(upwards.rowsBetween(Window.unboundedPreceding, -1))
        .alias("_earlier"),
        F.last("_first", ignorenulls=True)
        .over(downwards.rowsBetween(Window.unboundedPreceding, -1))
        .alias("_later"),
    )
    before = F.coalesce("_before", "_earlier")
    after = F.coalesce("_after", "_later")
    take_before = (F.col("a").isNull()) | (
        F.col("b").isNotNull() & (F.col("time") - F.col("b.time") <= F.col("a.time") - F.col("time"))
    )
    return (
        in_range.join(beyond, key)
        .withColumn("b", before)
        .withColumn("a", after)
        .select(
            "transaction_id",
            "account_id",
            F.col("time").alias("txn_time"),
            F.when(take_before, F.col("b")).otherwise(F.col("a")).getField("id").alias("session_id"),
        )
    )
