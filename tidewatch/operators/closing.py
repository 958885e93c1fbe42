"""Round trips found from their halves, without listing the open paths between.

A path that closes returns to its origin, or ends on an account that shares an identity with it. Two halves
are therefore joined on the transfer that they share *and* on what closes the path: the origin of the
front half is the end of the back half, or both hold the same identity value. Only halves are listed (five hops
for rings of eight), and no open path beyond them comes into being.

An account with many transfers in and many out, a hub, would still make in x out pairs. No half
passes through a hub: a ring that does is cut there. What remains are a head that runs from the ring's origin
into the first hub, a tail from the last hub to the ring's end, and parts between two hubs. Head and
tail are joined on the hub and on what closes them, so of a hub's in x out pairs only those come into being
that have a way back. Each ring is cut in one way, at all hubs that it passes through. Parts from hub to hub are
added to heads one by one; that is the only step without a closing key, and it sees the transfers
between hubs only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import decimal, hours, path_key
from tidewatch.operators.rings import MIN_RING_HOPS, round_trip_candidates
from tidewatch.operators.walks import (
    WALK_COLUMNS, HopRule, halves, put_together, single_hops, staged_walks, successors,
)
from tidewatch.staging import stage

_RING = [c for c in WALK_COLUMNS if c != "path_key"]


def hubs(edge: DataFrame, rule: HopRule = HopRule()) -> DataFrame:
    """Accounts through which more pairs of transfers could pass than the rule lists."""
    count_in = edge.groupBy(F.col("dst").alias("hub")).agg(F.count(F.lit(1)).alias("_in"))
    count_out = edge.groupBy(F.col("src").alias("hub")).agg(F.count(F.lit(1)).alias("_out"))
    return count_in.join(count_out, "hub").filter(F.col("_in") * F.col("_out") > rule.hub_pairs).select("hub")


def _linked(front: DataFrame, back: DataFrame, keys: list[str], start: str, end: str, shared: DataFrame) -> DataFrame:
    """Join two parts on ``keys`` where the ``start`` of the front shares an identity value with the ``end``
    of the back and belongs to someone else; a pair comes once for each kind of value."""
    ours = front.join(shared.toDF(start, "_owner", "via", "value"), start)
    theirs = back.join(shared.toDF(end, "_other", "via", "value"), end)
    return ours.join(theirs, [*keys, "via", "value"]).filter(f"_owner <> _other and {start} <> {end}")


def _named(same: DataFrame, linked: DataFrame) -> DataFrame:
    """Rings with how they close; of several kinds of link the alphabetically first."""
    first = linked.groupBy("txn_ids").agg(
        F.min(F.struct("via", *[c for c in _RING if c != "txn_ids"])).alias("_ring")
    ).select(*[F.col("txn_ids" if c == "txn_ids" else f"_ring.{c}") for c in (*_RING, "via")])
    return same.select(*_RING, F.lit("same_account").alias("closed_by")).unionByName(
        first.select(*_RING, F.concat(F.lit("linked_"), "via").alias("closed_by"))
    )


def _light_rings(walks: DataFrame, reach: int, shared: DataFrame, rule: HopRule) -> DataFrame:
    """Rings of halves: those as short as a half, and longer ones put together."""
    short = walks.withColumn("path_key", path_key(F.col("txn_ids"))).select(*WALK_COLUMNS)
    found = round_trip_candidates(short, shared).select(*_RING, "closed_by")
    if reach >= rule.max_hops:
        return found
    front, back = halves(walks, reach, rule.max_hops, rule)
    same = front.join(back.withColumn("f_origin", F.col("b_cur")), ["_shared", "f_origin"])
    linked = _linked(front, back, ["_shared"], "f_origin", "b_cur", shared)
    return found.unionByName(
        _named(
            put_together(same, reach, rule.max_hops, rule),
            put_together(linked, reach, rule.max_hops, rule, "via"),
        )
    )


def _at_hubs(edge: DataFrame, walks: DataFrame, reach: int, top: DataFrame, rule: HopRule) -> tuple[DataFrame, DataFrame]:
    """Heads and tails: paths of all lengths that end on a hub, and that begin on one."""
    most = rule.max_hops - 1
    single = single_hops(edge).drop("path_key").withColumn("first_time", F.col("last_time"))
    short = single.unionByName(walks)
    if not rule.revisit:
        short = short.filter("cur <> origin")
    ending, beginning = top.withColumnRenamed("hub", "cur"), top.withColumnRenamed("hub", "origin")
    heads, tails = short.join(ending, "cur", "left_semi"), short.join(beginning, "origin", "left_semi")
    if most > reach:
        front, back = halves(walks, reach, most, rule)
        into = back.join(top.withColumnRenamed("hub", "b_cur"), "b_cur", "left_semi")
        out_of = front.join(top.withColumnRenamed("hub", "f_origin"), "f_origin", "left_semi")
        longer_heads = put_together(front.join(into, "_shared"), reach, most, rule)
        longer_tails = put_together(out_of.join(back, "_shared"), reach, most, rule)
        if not rule.revisit:
            longer_heads, longer_tails = (x.filter("cur <> origin") for x in (longer_heads, longer_tails))
        heads, tails = heads.unionByName(longer_heads), tails.unionByName(longer_tails)
    return stage(heads, "heads"), stage(tails, "tails")


def _follows(rule: HopRule, closes: bool) -> Column:
    """Whether part ``b`` may follow part ``f`` at the account where ``f`` ends."""
    follows = (
        (F.col("b_first_time") > F.col("f_last_time"))
        & (F.col("b_first_time") <= F.col("f_last_time") + hours(rule.within_hours))
        & (F.col("b_first_amount") >= F.col("f_last_amount") * decimal(rule.keep))
        & (F.col("b_first_amount") <= F.col("f_last_amount"))
        & (F.col("f_hops") + F.col("b_hops") <= rule.max_hops - (0 if closes else 1))
    )
    if rule.revisit:
        return follows
    end = "b_cur = f_origin or " if closes else ""
    return follows & F.expr(
        "not arrays_overlap(f_path, slice(b_path, 2, b_hops - 1))"
        f" and ({end}not array_contains(f_path, b_cur))"
    )


def _joined(parts: DataFrame, *keep: str) -> DataFrame:
    return parts.selectExpr(
        "f_origin as origin",
        "b_cur as cur",
        "f_first_time as first_time",
        "b_last_time as last_time",
        "b_last_amount as last_amount",
        "f_first_amount as first_amount",
        "f_hops + b_hops as hops",
        "concat(f_path, slice(b_path, 2, b_hops)) as path",
        "concat(f_txn_ids, b_txn_ids) as txn_ids",
        *keep,
    )


def _hub_rings(heads: DataFrame, tails: DataFrame, top: DataFrame, shared: DataFrame, rule: HopRule) -> DataFrame:
    """Rings that pass through one hub or more."""
    def side(parts: DataFrame, letter: str, at: str) -> DataFrame:
        return parts.select(*[F.col(c).alias(f"{letter}_{c}") for c in parts.columns], F.col(at).alias("_hub"))

    between = heads.join(top.withColumnRenamed("hub", "origin"), "origin", "left_semi").select(*heads.columns)
    found, begun = None, heads
    for _ in range(rule.max_hops - 1):
        front, back = side(begun, "f", "cur"), side(tails, "b", "origin")
        enough = _follows(rule, closes=True) & (F.col("f_hops") + F.col("b_hops") >= MIN_RING_HOPS)
        same = front.join(back.withColumn("f_origin", F.col("b_cur")), ["_hub", "f_origin"]).filter(enough)
        linked = _linked(front, back, ["_hub"], "f_origin", "b_cur", shared).filter(enough)
        rings = _named(_joined(same), _joined(linked, "via"))
        found = rings if found is None else found.unionByName(rings)
        onward = front.join(side(between, "b", "origin"), "_hub").filter(_follows(rule, closes=False))
        begun = stage(_joined(onward).select(*heads.columns), "heads-on")
        if begun.isEmpty():
            break
    return found


def closing_paths(edge: DataFrame, shared: DataFrame, rule: HopRule = HopRule()) -> DataFrame:
    """Paths of three or more hops back to the origin, or to an account linked to it, one row per path.

    The rows that `rings.round_trip_candidates` finds among all paths. ``shared`` is the identity table
    cut down to shared values.
    """
    reach = min((rule.max_hops + 2) // 2, rule.max_hops)
    top = stage(hubs(edge, rule), "hubs")
    any_hub = not top.isEmpty()
    into, out_of = edge, edge
    if any_hub:
        into = edge.join(top.withColumnRenamed("hub", "dst"), "dst", "left_anti")
        out_of = edge.join(top.withColumnRenamed("hub", "src"), "src", "left_anti")
    walks = staged_walks(successors(into, rule, out_of), reach, rule)
    found = _light_rings(walks, reach, shared, rule)
    if any_hub:
        heads, tails = _at_hubs(edge, walks, reach, top, rule)
        found = found.unionByName(_hub_rings(heads, tails, top, shared, rule))
    return found.withColumn("path_key", path_key(F.col("txn_ids"))).select(*WALK_COLUMNS, "closed_by")
