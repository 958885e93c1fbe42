"""Money paths: time-ordered chains of transfers in which the amount decays slowly.

The only expensive question is "which transfer may follow which": same account, strictly
later within the window, amount in the band. It is answered once (`successors`). A path of n
transfers is then two shorter paths that overlap in one transfer, so longer paths come from
plain equi-joins on a transaction id, and the length almost doubles with each round (2, 3, 5,
8) instead of growing by one. A part of a valid path is itself a valid path, hence nothing is
lost; the joined path only has to be checked for revisited accounts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import path_key
from tidewatch.operators.intervals import follow_on_pairs
from tidewatch.staging import read_stage, write_stage

WALK_COLUMNS = (
    "origin", "cur", "last_time", "last_amount", "first_amount", "hops", "path", "txn_ids",
    "path_key",
)


@dataclass(frozen=True)
class HopRule:
    """When one transfer may follow another, and how long a path may get."""

    within_hours: int = 48
    keep: str = "0.80"
    max_hops: int = 8
    revisit: bool = False  # graph patterns may pass an account twice, detectors may not
    hub_pairs: int = 10_000  # an account with more pairs of a transfer in and one out is a hub


def money_edge(transaction: DataFrame, account: DataFrame) -> DataFrame:
    """Completed transfers between accounts of different owners, one row per transaction."""
    owner = account.select("account_id", "customer_id")
    sender = owner.select(F.col("account_id").alias("src"), F.col("customer_id").alias("_payer"))
    receiver = owner.select(F.col("account_id").alias("dst"), F.col("customer_id").alias("_payee"))
    return (
        transaction.filter("txn_type = 'transfer' and status = 'completed'")
        .select(
            "transaction_id",
            F.col("account_id").alias("src"),
            F.col("counterparty_account_id").alias("dst"),
            "amount",
            "txn_time",
        )
        .join(sender, "src")
        .join(receiver, "dst")
        .filter("_payer <> _payee")
        .select("transaction_id", "src", "dst", "amount", "txn_time")
    )


def successors(edge: DataFrame, rule: HopRule = HopRule(), onward: DataFrame | None = None) -> DataFrame:
    """All pairs of transfers in which the second, out of ``onward`` if given, may follow the first, as
    2-hop paths."""
    first = edge.select(
        F.col("transaction_id").alias("id"),
        "src",
        F.col("dst").alias("at"),
        F.col("txn_time").alias("time"),
        "amount",
    )
    then = (edge if onward is None else onward).select(
        F.col("transaction_id").alias("then_id"),
        F.col("src").alias("then_at"),
        F.col("dst").alias("then_dst"),
        F.col("txn_time").alias("then_time"),
        F.col("amount").alias("then_amount"),
    )
    pairs = follow_on_pairs(first, then, within_hours=rule.within_hours, keep=rule.keep)
    if not rule.revisit:
        pairs = pairs.filter("src <> at and then_dst <> at")
    return pairs.select(
        F.col("src").alias("origin"),
        F.col("then_dst").alias("cur"),
        F.col("time").alias("first_time"),
        F.col("then_time").alias("last_time"),
        F.col("then_amount").alias("last_amount"),
        F.col("amount").alias("first_amount"),
        F.lit(2).alias("hops"),
        F.array("src", "at", "then_dst").alias("path"),
        F.array("id", "then_id").alias("txn_ids"),
    )


def halves(walks: DataFrame, reach: int, top: int, rule: HopRule) -> tuple[DataFrame, DataFrame]:
    """Front and back halves of all paths of ``reach`` + 1 to ``top`` hops, given those of 2 to ``reach``.

    A path of n hops is taken apart in one way only: a front half and a back half that share
    one transfer, ``_shared``, the front as long as the back or one hop longer.
    """
    whole = walks
    if not rule.revisit:
        # a closed path ends there, so it can be neither continued nor the tail of another
        whole = whole.filter("cur <> origin")
    # only these lengths make up paths of reach + 1 to top hops, and only they are shuffled
    front = whole.filter(F.col("hops").between((reach + 3) // 2, (top + 2) // 2)).select(
        F.element_at("txn_ids", -1).alias("_shared"),
        *[F.col(c).alias(f"f_{c}") for c in ("origin", "first_time", "first_amount", "hops", "path", "txn_ids")],
    )
    back = whole.filter(F.col("hops").between((reach + 2) // 2, (top + 1) // 2)).select(
        F.element_at("txn_ids", 1).alias("_shared"),
        *[
            F.col(c).alias(f"b_{c}")
            for c in ("cur", "last_time", "last_amount", "hops", "path", "txn_ids")
        ],
    )
    return front, back


def put_together(joined: DataFrame, reach: int, top: int, rule: HopRule, *keep: str) -> DataFrame:
    """The paths of halves joined on their shared transfer; the columns ``keep`` are handed on."""
    joined = joined.filter(
        f"f_hops - b_hops in (0, 1) and f_hops + b_hops - 1 between {reach + 1} and {top}"
    )
    if not rule.revisit:
        # f_path ends with the two accounts of the shared transfer, b_path starts with them
        joined = joined.filter(
            "not arrays_overlap(f_path, slice(b_path, 3, b_hops - 2))"
            " and (b_cur = f_origin or not array_contains(f_path, b_cur))"
        )
    return joined.selectExpr(
        "f_origin as origin",
        "b_cur as cur",
        "f_first_time as first_time",
        "b_last_time as last_time",
        "b_last_amount as last_amount",
        "f_first_amount as first_amount",
        "f_hops + b_hops - 1 as hops",
        "concat(f_path, slice(b_path, 3, b_hops - 1)) as path",
        "concat(f_txn_ids, slice(b_txn_ids, 2, b_hops - 1)) as txn_ids",
        *keep,
    )


def staged_walks(pairs: DataFrame, most: int, rule: HopRule) -> DataFrame:
    """All paths of two to ``most`` hops made of ``pairs``, each round staged in a folder of its own. A
    file holds few different lengths, so a filter on ``hops`` skips the files of shorter paths."""
    spark = pairs.sparkSession
    folders = [write_stage(pairs, "walk-2")]
    walks = read_stage(spark, pairs.schema, *folders)
    reach = 2
    while reach < most:
        top = min(2 * reach - 1, most)
        front, back = halves(walks, reach, top, rule)
        longer = put_together(front.join(back, "_shared"), reach, top, rule)
        folders.append(write_stage(longer, f"walk-{top}"))
        walks = read_stage(spark, pairs.schema, *folders)
        reach = top
    return walks


def long_walks(edge: DataFrame, rule: HopRule = HopRule()) -> DataFrame:
    """All paths of two or more hops, staged."""
    walks = staged_walks(successors(edge, rule), rule.max_hops, rule)
    return walks.withColumn("path_key", path_key(F.col("txn_ids"))).select(*WALK_COLUMNS)


def single_hops(edge: DataFrame) -> DataFrame:
    """Every transfer as a path of one hop."""
    return edge.select(
        F.col("src").alias("origin"),
        F.col("dst").alias("cur"),
        F.col("txn_time").alias("last_time"),
        F.col("amount").alias("last_amount"),
        F.col("amount").alias("first_amount"),
        F.lit(1).alias("hops"),
        F.array("src", "dst").alias("path"),
        F.array("transaction_id").alias("txn_ids"),
        F.col("transaction_id").alias("path_key"),
    )


def money_walk(edge: DataFrame, rule: HopRule = HopRule()) -> DataFrame:
    """All paths of one to ``max_hops`` transfers."""
    return single_hops(edge).unionByName(long_walks(edge, rule))
