"""Detections against injected labels. No detector module imports this one or reads labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.staging import stage


def detection_txns(rings: DataFrame, chains: DataFrame) -> DataFrame:
    """One row per ring or chain and transaction; the id tells the two apart."""

    def spread(found: DataFrame, prefix: str) -> DataFrame:
        return found.select(
            F.concat(F.lit(prefix), "path_key").alias("det_id"),
            "tier",
            F.explode("txn_ids").alias("transaction_id"),
        )

    return spread(rings, "R:").unionByName(spread(chains, "L:"))


def _labelled_receivers(labels: DataFrame, transaction: DataFrame) -> DataFrame:
    receiver = transaction.select(
        "transaction_id", F.col("counterparty_account_id").alias("account_id")
    )
    return labels.join(receiver, "transaction_id").select("pattern_label", "chain_id", "account_id").distinct()


_MULE = "pattern_label = 'mule_network'"
_STRUCTURING = "pattern_label = 'structuring'"


def mule_ground_truth(ground_truth: DataFrame, transaction: DataFrame) -> DataFrame:
    injected = ground_truth.filter(f"{_MULE} and hop_index = 0")
    return _labelled_receivers(injected, transaction).select("chain_id", "account_id")


def structuring_ground_truth(ground_truth: DataFrame, transaction: DataFrame) -> DataFrame:
    return _labelled_receivers(ground_truth.filter(_STRUCTURING), transaction).select("chain_id", "account_id")


def injected_receivers(ground_truth: DataFrame, transaction: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The mule and the structuring ground truth, staged, from one join with all transactions."""
    injected = ground_truth.filter(f"{_MULE} and hop_index = 0 or {_STRUCTURING}")
    receivers = stage(_labelled_receivers(injected, transaction), "injected-receivers")
    return tuple(receivers.filter(p).select("chain_id", "account_id") for p in (_MULE, _STRUCTURING))


def path_labels(ground_truth: DataFrame) -> DataFrame:
    return ground_truth.filter(
        "pattern_label like 'round_trip%' or pattern_label = 'layering_chain'"
    ).select("pattern_label", "chain_id", "transaction_id")


def best_detection(labels: DataFrame, det_txns: DataFrame) -> DataFrame:
    """Per injected chain the one detection that covers most of it (then tier, then id)."""
    hits = (
        labels.select("chain_id", "transaction_id")
        .join(det_txns, "transaction_id")
        .groupBy("chain_id", "det_id", "tier")
        .agg(F.count(F.lit(1)).alias("hit_txn"))
    )
    best = F.min(F.struct((-F.col("hit_txn")).alias("h"), F.col("tier"), F.col("det_id"))).alias("_b")
    return (
        hits.groupBy("chain_id")
        .agg(best)
        .select("chain_id", (-F.col("_b.h")).alias("hit_txn"), "_b.tier", "_b.det_id")
    )


def _path_chains(labels: DataFrame, det_txns: DataFrame) -> DataFrame:
    sizes = labels.groupBy("pattern_label", "chain_id").agg(F.count(F.lit(1)).alias("n_txn"))
    return sizes.join(best_detection(labels, det_txns), "chain_id", "left").select(
        "pattern_label",
        "chain_id",
        "n_txn",
        F.coalesce("hit_txn", F.lit(0)).alias("hit_txn"),
        "tier",
    )


def _mule_chains(injected: DataFrame, mule_found: DataFrame) -> DataFrame:
    """An account in several rings counts once for each ring, in both numbers."""
    times = mule_found.groupBy("account_id").agg(F.count(F.lit(1)).alias("_rings"))
    return (
        injected.join(times, "account_id", "left")
        .groupBy("chain_id")
        .agg(
            F.sum(F.coalesce("_rings", F.lit(1))).alias("n_txn"),
            F.sum(F.coalesce("_rings", F.lit(0))).alias("hit_txn"),
        )
        .select(
            F.lit("mule_network").alias("pattern_label"), "chain_id", "n_txn", "hit_txn",
            F.lit(None).cast("string").alias("tier"),
        )
    )


def _structuring_chains(injected: DataFrame, flagged: DataFrame) -> DataFrame:
    found = flagged.select("account_id", F.lit(1).alias("_hit"))
    return (
        injected.join(found, "account_id", "left")
        .groupBy("chain_id")
        .agg(F.max(F.coalesce("_hit", F.lit(0))).cast("bigint").alias("hit_txn"))
        .select(
            F.lit("structuring").alias("pattern_label"), "chain_id",
            F.lit(1).cast("bigint").alias("n_txn"), "hit_txn",
            F.lit(None).cast("string").alias("tier"),
        )
    )


def chain_recall(
    ground_truth: DataFrame,
    transaction: DataFrame,
    rings: DataFrame,
    chains: DataFrame,
    mule_found: DataFrame,
    flagged: DataFrame,
) -> DataFrame:
    """Per injected chain: its size and how much of it one detection covers."""
    injected = mule_ground_truth(ground_truth, transaction), structuring_ground_truth(ground_truth, transaction)
    return _chain_recall(ground_truth, injected, rings, chains, mule_found, flagged)


def _chain_recall(
    ground_truth: DataFrame,
    injected: tuple[DataFrame, DataFrame],
    rings: DataFrame,
    chains: DataFrame,
    mule_found: DataFrame,
    flagged: DataFrame,
) -> DataFrame:
    by_path = _path_chains(path_labels(ground_truth), detection_txns(rings, chains))
    by_mule = _mule_chains(injected[0], mule_found)
    by_account = _structuring_chains(injected[1], flagged)
    return by_path.unionByName(by_mule).unionByName(by_account)


def pattern_recall(recall: DataFrame) -> DataFrame:
    """Chains found in full, in part and not at all, per pattern."""

    def number(condition: str):
        return F.sum(F.when(F.expr(condition), 1).otherwise(0)).cast("bigint")

    tiers = F.array_join(F.array_sort(F.collect_set("tier")), ",")
    return recall.groupBy("pattern_label").agg(
        F.count(F.lit(1)).alias("chains"),
        number("hit_txn = n_txn").alias("found_full"),
        number("hit_txn > 0 and hit_txn < n_txn").alias("found_partial"),
        number("hit_txn = 0").alias("missed"),
        tiers.alias("tiers"),
    )


def false_positives(
    ground_truth: DataFrame,
    transaction: DataFrame,
    rings: DataFrame,
    chains: DataFrame,
    mule_found: DataFrame,
    flagged: DataFrame,
) -> DataFrame:
    """Per detector, the detections that touch nothing injected."""
    receivers = mule_ground_truth(ground_truth, transaction), structuring_ground_truth(ground_truth, transaction)
    return _false_positives(ground_truth, receivers, rings, chains, mule_found, flagged)


def _false_positives(
    ground_truth: DataFrame,
    receivers: tuple[DataFrame, DataFrame],
    rings: DataFrame,
    chains: DataFrame,
    mule_found: DataFrame,
    flagged: DataFrame,
) -> DataFrame:
    injected = ground_truth.filter("pattern_label <> 'normal'").select("transaction_id")

    def count(found: DataFrame, label: str) -> DataFrame:
        return found.agg(F.count(F.lit(1)).alias("false_positives")).select(
            F.lit(label).alias("pattern_label"), "false_positives"
        )

    def paths_off(found: DataFrame) -> DataFrame:
        hit = (
            found.select("path_key", F.explode("txn_ids").alias("transaction_id"))
            .join(injected, "transaction_id", "left_semi")
            .select("path_key")
            .distinct()
        )
        return found.select("path_key").join(hit, "path_key", "left_anti")

    mule_accounts, labelled = (found.select("account_id") for found in receivers)
    mule_hit = mule_found.join(mule_accounts, "account_id", "left_semi").select("device_id").distinct()
    mules_off = mule_found.select("device_id").distinct().join(mule_hit, "device_id", "left_anti")
    accounts_off = flagged.select("account_id").join(labelled, "account_id", "left_anti")
    return (
        count(paths_off(rings), "round_trip (detector)")
        .unionByName(count(paths_off(chains), "layering (detector)"))
        .unionByName(count(mules_off, "mule (detector)"))
        .unionByName(count(accounts_off, "structuring (detector)"))
    )


def benchmark(
    ground_truth: DataFrame,
    transaction: DataFrame,
    rings: DataFrame,
    chains: DataFrame,
    mule_found: DataFrame,
    flagged: DataFrame,
) -> DataFrame:
    """The recall of all patterns and the false positives of all detectors. Both ask who received what is injected, so
    transactions are joined with labels once."""
    inputs = (ground_truth, injected_receivers(ground_truth, transaction), rings, chains, mule_found, flagged)
    return pattern_recall(_chain_recall(*inputs)).unionByName(
        _false_positives(*inputs), allowMissingColumns=True
    )
