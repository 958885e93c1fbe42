"""Round trips and layering chains, told apart from the money paths.

"Drop what is contained in something larger" is a set comparison of every path with every other one. Rings
are compared only with the longer ones that hold their rarest transfer. An open path without revisits
is contained in a longer one only if one more transfer fits before or after it, which is asked of its
ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import decay_pct
from tidewatch.operators.walks import HopRule

MIN_RING_HOPS = 3
MIN_CHAIN_HOPS = 4


def drop_contained(paths: DataFrame, containers: DataFrame, shortest: int) -> DataFrame:
    """``paths`` without those whose transfers are all part of a longer path in ``containers``.

    An index lists the longer paths by each of their transfers. A path is looked up by its rarest transfer
    only, the one that the fewest of them hold, and compared with those; one that holds a transfer
    of no longer path is compared with none.
    """
    longer = containers.filter(F.col("hops") > shortest).select(
        F.explode("txn_ids").alias("_txn"), F.col("hops").alias("_hops"), F.col("txn_ids").alias("_whole")
    )
    held = longer.groupBy("_txn").agg(F.count(F.lit(1)).alias("_n"))
    rarest = (
        paths.select("path_key", F.explode("txn_ids").alias("_txn"))
        .join(held, "_txn", "left")
        .groupBy("path_key")
        .agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("_n"), "_txn")).getField("_txn").alias("_rarest"))
    )
    inside = (
        (F.col("_rarest") == F.col("_txn"))
        & (F.col("hops") < F.col("_hops"))
        & (F.size(F.array_intersect("txn_ids", "_whole")) == F.col("hops"))
    )
    return paths.join(rarest, "path_key").join(longer, inside, "left_anti").drop("_rarest")


def closing_links(open_walks: DataFrame, shared: DataFrame) -> DataFrame:
    """For each (origin, end) pair that shares an identity: the first kind, by name.

    A pair is multiplied by the values of whichever account has fewer, so an account with very
    many devices costs its partners no more than their own.
    """
    held = shared.groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
    ends = (
        open_walks.select("origin", "cur").distinct()
        .join(held.toDF("origin", "_n_origin"), "origin")
        .join(held.toDF("cur", "_n_cur"), "cur")
    )
    found = None
    for few, many, fewer in (
        ("origin", "cur", "_n_origin <= _n_cur"), ("cur", "origin", "_n_origin > _n_cur"),
    ):
        values = shared.toDF(few, "_owner", "via", "value")
        others = shared.toDF(many, "_other", "via", "value")
        part = (
            ends.filter(fewer).select("origin", "cur").join(values, few)
            .join(others, [many, "via", "value"]).filter("_owner <> _other").select("origin", "cur", "via")
        )
        found = part if found is None else found.unionByName(part)
    return found.groupBy("origin", "cur").agg(F.min("via").alias("via"))


def round_trip_candidates(walks: DataFrame, shared: DataFrame) -> DataFrame:
    """Paths of three or more hops back to the origin, or to an account linked to it.

    ``shared`` is the identity table cut down to shared values. One row per path; of several
    links the alphabetically first kind is named.
    """
    walks = walks.filter(F.col("hops") >= MIN_RING_HOPS)
    closed = walks.filter("cur = origin").withColumn("closed_by", F.lit("same_account"))
    still_open = walks.filter("cur <> origin")
    linked = (
        still_open.join(closing_links(still_open, shared), ["origin", "cur"])
        .withColumn("closed_by", F.concat(F.lit("linked_"), "via"))
        .drop("via")
    )
    return closed.unionByName(linked)


def maximal_rings(candidates: DataFrame) -> DataFrame:
    return drop_contained(candidates, candidates, MIN_RING_HOPS)


def member_links(rings: DataFrame, shared: DataFrame) -> DataFrame:
    """``(path_key, a, b, via, value)`` for members of different owners sharing a value, a < b.

    Members are brought together only within one ring and value, so the array that holds them
    is never longer than a path.
    """
    members = rings.select("path_key", F.explode(F.array_distinct("path")).alias("account_id"))
    held = (
        members.join(shared, "account_id")
        .groupBy("path_key", "via", "value")
        .agg(F.collect_set(F.struct("account_id", "customer_id")).alias("_held_by"))
        .filter(F.size("_held_by") > 1)
    )
    linked = F.flatten(
        F.transform(
            "_held_by",
            lambda x: F.transform(
                F.filter(
                    "_held_by",
                    lambda y: (x["account_id"] < y["account_id"])
                    & (x["customer_id"] != y["customer_id"]),
                ),
                lambda y: F.struct(x["account_id"].alias("a"), y["account_id"].alias("b")),
            ),
        )
    )
    return held.select("path_key", "via", "value", F.explode(linked).alias("_p")).select(
        "path_key", "_p.a", "_p.b", "via", "value"
    )


def ring_shared_pairs(rings: DataFrame, shared: DataFrame) -> DataFrame:
    """Per ring with any: linked member pairs, counted in both directions and per kind, and the
    kinds."""
    return (
        member_links(rings, shared)
        .select("path_key", "a", "b", "via")
        .distinct()
        .groupBy("path_key")
        .agg(
            (F.count(F.lit(1)) * 2).alias("shared_pairs"),
            F.array_sort(F.collect_set("via")).alias("shared_via"),
        )
    )


def with_shared_pairs(rings: DataFrame, shared: DataFrame) -> DataFrame:
    """All rings; those without a linked pair get 0 and no kinds."""
    none = F.array().cast("array<string>")
    return (
        rings.join(ring_shared_pairs(rings, shared), "path_key", "left")
        .withColumn("shared_pairs", F.coalesce("shared_pairs", F.lit(0)).cast("bigint"))
        .withColumn("shared_via", F.coalesce("shared_via", none))
    )


def round_trip(candidates: DataFrame, shared: DataFrame) -> DataFrame:
    """Maximal rings with their tier: high if an identity is shared, else medium."""
    rings = maximal_rings(candidates)
    high = (F.col("closed_by") != "same_account") | (F.col("shared_pairs") > 0)
    return with_shared_pairs(rings, shared).select(
        "path_key",
        "origin",
        F.col("cur").alias("closed_on"),
        "closed_by",
        "hops",
        "path",
        "txn_ids",
        "first_amount",
        "last_amount",
        decay_pct(F.col("first_amount"), F.col("last_amount")).alias("decay_pct"),
        "shared_pairs",
        "shared_via",
        F.when(high, "high").otherwise("medium").alias("tier"),
    )


def drop_overlapping(paths: DataFrame, others: DataFrame) -> DataFrame:
    """``paths`` without those that have a transfer in common with any of ``others``."""
    taken = others.select(F.explode("txn_ids").alias("_txn")).distinct()
    touching = (
        paths.select("path_key", F.explode("txn_ids").alias("_txn"))
        .join(taken, "_txn", "left_semi")
        .select("path_key")
        .distinct()
    )
    return paths.join(touching, "path_key", "left_anti")


def without_extension(paths: DataFrame, walks: DataFrame, max_hops: int) -> DataFrame:
    """Open ``paths`` that no transfer can be put before or after, out of all ``walks`` without revisits.

    A longer path that contains a path also has a part that is exactly one hop longer and contains it. So
    it is enough to look for one transfer that may precede the first or follow the last, and whose other
    account is new to the path, or closes it. Paths of ``max_hops`` cannot grow.
    """
    pairs = walks.filter("hops = 2")
    after = pairs.select(F.element_at("txn_ids", 1).alias("_last"), F.col("cur").alias("_next")).distinct()
    before = pairs.select(F.element_at("txn_ids", 2).alias("_first"), F.col("origin").alias("_previous")).distinct()
    ends = paths.withColumn("_first", F.get("txn_ids", F.lit(0))).withColumn("_last", F.element_at("txn_ids", -1))
    grows = ends["hops"] < max_hops
    onward = (ends["_last"] == after["_last"]) & grows & (
        (after["_next"] == ends["origin"]) | ~F.array_contains(ends["path"], after["_next"])
    )
    back = (ends["_first"] == before["_first"]) & grows & (
        (before["_previous"] == ends["cur"]) | ~F.array_contains(ends["path"], before["_previous"])
    )
    return ends.join(after, onward, "left_anti").join(before, back, "left_anti").drop("_first", "_last")


def layering(walks: DataFrame, rings: DataFrame, max_hops: int = HopRule.max_hops) -> DataFrame:
    """Open paths of four or more hops, maximal, with no transfer in a round trip."""
    still_open = walks.filter(F.col("hops") >= MIN_CHAIN_HOPS).filter("cur <> origin")
    return drop_overlapping(without_extension(still_open, walks, max_hops), rings).select(
        "path_key",
        "origin",
        F.col("cur").alias("ends_on"),
        "hops",
        "path",
        "txn_ids",
        "first_amount",
        "last_amount",
        decay_pct(F.col("first_amount"), F.col("last_amount")).alias("decay_pct"),
        F.lit("medium").alias("tier"),
    )
