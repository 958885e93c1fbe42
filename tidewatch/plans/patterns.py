"""Graph-pattern queries over the node and edge tables, as joins.

These follow the graph copy's own rules, which differ from the detectors': times are whole
seconds, own-account transfers are edges, a path may pass an account twice, and identity is a
trimmed phone or email contact or a device.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import rings
from tidewatch.operators.closing import closing_paths
from tidewatch.operators.links import shared_identity
from tidewatch.operators.walks import HopRule, long_walks
from tidewatch.staging import Staged, stage, step, together

GRAPH_RULE = HopRule(revisit=True)
STRONG_CONTACTS = ("phone", "email")


class Graph(Staged):
    """One graph copy: its tables, and the paths and rings found in it."""

    def __init__(self, tables: dict[str, DataFrame]):
        super().__init__()
        self.tables = tables

    @step
    def transfers(self) -> DataFrame:
        edges = self.tables["edge_sent_to"].select(
            "transaction_id",
            F.col("src_account_id").alias("src"),
            F.col("dst_account_id").alias("dst"),
            "amount",
            F.col("txn_time").cast("timestamp_ntz").alias("txn_time"),
        )
        return stage(edges, "graph-edges")

    @step
    def paths(self) -> DataFrame:
        """All paths of three to eight hops."""
        return long_walks(self.transfers, GRAPH_RULE).filter("hops >= 3")

    @step
    def shared(self) -> DataFrame:
        """Accounts with the contacts and devices that more than one customer uses."""
        owns = self.tables["edge_owns"]
        strong = self.tables["edge_has_contact"].filter(
            F.split_part("contact_key", F.lit("|"), F.lit(1)).isin(*STRONG_CONTACTS)
        )
        contact = owns.join(strong, "customer_id").select(
            "account_id", "customer_id", F.lit("contact").alias("via"),
            F.col("contact_key").alias("value"),
        )
        device = self.tables["edge_used_device"].join(owns, "account_id").select(
            "account_id", "customer_id", F.lit("device").alias("via"), F.col("device_id").alias("value")
        )
        return stage(shared_identity(contact.unionByName(device)), "graph-identity")

    @step
    def closing(self) -> DataFrame:
        """Paths that end on their origin or on an account that shares an identity with it."""
        if "paths" in self.__dict__:
            found = rings.round_trip_candidates(self.paths, self.shared)
        else:
            together(lambda: self.transfers, lambda: self.shared)
            found = closing_paths(self.transfers, self.shared, GRAPH_RULE)
        return stage(found, "graph-closing")

    @step
    def rings(self) -> DataFrame:
        return stage(rings.round_trip(self.closing, self.shared), "graph-rings")


def cycles(graph: Graph, shortest: int = 3, longest: int = 8) -> DataFrame:
    found = graph.closing.filter("closed_by = 'same_account'").drop("closed_by")
    return found.filter(F.col("hops").between(shortest, longest))


def cycles_3_6(graph: Graph) -> DataFrame:
    return cycles(graph, 3, 6).agg(F.count(F.lit(1)).alias("cycles"))


def cycles_pruned(graph: Graph) -> DataFrame:
    """Number of cycles and the hop counts of the first 20 by path key."""
    found = cycles(graph)
    first = found.orderBy("path_key").limit(20)
    listed = first.agg(
        F.array_sort(F.collect_list(F.struct("path_key", "hops"))).getField("hops").alias("h")
    )
    return found.agg(F.count(F.lit(1)).alias("cycles")).withColumn("hop_counts", listed.scalar())


def rings_tiers_graph(graph: Graph) -> DataFrame:
    how = F.when(F.col("closed_by") == "same_account", "same_account").otherwise("linked")
    return graph.rings.groupBy(how.alias("closed_by"), "tier").agg(F.count(F.lit(1)).alias("rings"))


def ring_evidence(graph: Graph) -> DataFrame:
    """One row per piece of identity evidence of a maximal ring: the contact that closes it,
    and each device or contact that two members of different customers share."""
    found = graph.rings.select("path_key", "origin", "closed_on", "path")
    contact = graph.shared.filter("via = 'contact'")
    of_origin = contact.select(
        F.col("account_id").alias("origin"), F.col("customer_id").alias("_a"), "value"
    )
    of_end = contact.select(
        F.col("account_id").alias("closed_on"), F.col("customer_id").alias("_b"), "value"
    )
    closing = (
        found.filter("origin <> closed_on")
        .join(of_origin, "origin")
        .join(of_end, ["closed_on", "value"])
        .filter("_a <> _b")
        .select(
            "path_key", F.lit("closing").alias("kind"), F.col("origin").alias("a"),
            F.col("closed_on").alias("b"), "value",
        )
    )
    inside = rings.member_links(found, graph.shared).select(
        "path_key", F.col("via").alias("kind"), "a", "b", "value"
    )
    return closing.unionByName(inside)


def high_ring_evidence(graph: Graph) -> DataFrame:
    """The evidence of all rings that have any."""
    return graph.rings.select("path_key", "origin", "closed_on").join(ring_evidence(graph), "path_key")


def all_ring_evidence(graph: Graph) -> DataFrame:
    """Every maximal ring with its evidence; one row with nulls if it has none."""
    return graph.rings.select("path_key", "origin", "closed_on").join(
        ring_evidence(graph), "path_key", "left"
    )


def open_chains(graph: Graph) -> DataFrame:
    """Paths of four or more hops that do not close, are not part of a longer path, and have no
    transfer in common with any closing path."""
    long_paths = graph.paths.filter(F.col("hops") >= rings.MIN_CHAIN_HOPS)
    still_open = long_paths.join(graph.closing.select("path_key"), "path_key", "left_anti")
    maximal = rings.drop_contained(still_open, long_paths, rings.MIN_CHAIN_HOPS)
    return rings.drop_overlapping(maximal, graph.closing)


def layering_graph(graph: Graph) -> DataFrame:
    """Number of open chains of each length."""
    return open_chains(graph).groupBy("hops").agg(F.count(F.lit(1)).alias("layering_chains"))


def recent_device_users(graph: Graph, since: str) -> DataFrame:
    """``(device_id, account_id, customer_id)`` for customers onboarded 150 days before ``since``
    or later, on devices with three or more of them."""
    recent = graph.tables["node_customer"].filter(
        F.col("onboard_dt").cast("date") >= F.date_sub(F.lit(since).cast("date"), 150)
    )
    owners = graph.tables["edge_owns"].join(recent.select("customer_id"), "customer_id", "left_semi")
    users = graph.tables["edge_used_device"].select("device_id", "account_id").join(owners, "account_id")
    shared = (
        users.groupBy("device_id")
        .agg(F.countDistinct("customer_id").alias("_n"))
        .filter("_n >= 3")
        .select("device_id")
    )
    return users.join(shared, "device_id", "left_semi").select("device_id", "account_id", "customer_id")


def mule_onboarding(graph: Graph, since: str = "2026-01-01") -> DataFrame:
    """Number of mule rings and of their accounts; an account in two rings counts twice."""
    return recent_device_users(graph, since).agg(
        F.countDistinct("device_id").alias("mule_rings"), F.count(F.lit(1)).alias("accounts_flagged")
    )


def example_phone_ring(graph: Graph) -> DataFrame:
    """The first path, by key, that ends on another account whose owner shares a phone."""
    phones = graph.shared.filter("via = 'contact' and value like 'phone|%'")
    ends = graph.paths.filter("cur <> origin")
    links = rings.closing_links(ends, phones).select("origin", "cur")
    return (
        ends.join(links, ["origin", "cur"], "left_semi")
        .select("path_key", "origin", "cur", "hops", "path")
        .orderBy("path_key")
        .limit(1)
    )


def example_mule(graph: Graph, since: str = "2026-01-01") -> DataFrame:
    """All recent customers and accounts of the first mule device, by id."""
    users = recent_device_users(graph, since)
    first = users.agg(F.min("device_id")).scalar()
    return users.filter(F.col("device_id") == first)


def example_plain_cycle(graph: Graph) -> DataFrame:
    """The first cycle, by key, in which no two members of different customers share anything."""
    found = cycles(graph)
    linked = rings.member_links(found, graph.shared).select("path_key").distinct()
    return (
        found.join(linked, "path_key", "left_anti")
        .select("path_key", "origin", "hops", "path")
        .orderBy("path_key")
        .limit(1)
    )
