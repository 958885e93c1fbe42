"""Shared-identity links between accounts and between customers.

Two forms of the same fact. The *identity table* has one row per account and identity value
it uses; it grows with the input, and the detectors join on it directly. The *link tables*
list the pairs that share a value; they are quadratic in the size of a group by definition,
so they are built only where the pairs themselves are the answer, and in blocks (`pairs`), so
that a value shared by very many members is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.staging import stage

BLOCK = 2000


def identity(account: DataFrame, customer: DataFrame, session: DataFrame) -> DataFrame:
    """Distinct ``(account_id, customer_id, via, value)`` for phone, email and device."""
    contact = (
        customer.select("customer_id", "phone", "email")
        .unpivot("customer_id", ["phone", "email"], "via", "value")
        .filter("value is not null")
    )
    owner = account.select("account_id", "customer_id")
    by_contact = owner.join(contact, "customer_id")
    device = (
        session.filter("device_id is not null")
        .select("account_id", F.lit("device").alias("via"), F.col("device_id").alias("value"))
        .distinct()
    )
    by_device = device.join(owner, "account_id")
    return by_contact.select("account_id", "customer_id", "via", "value").unionByName(
        by_device.select("account_id", "customer_id", "via", "value")
    )


def shared_identity(identities: DataFrame) -> DataFrame:
    """Only the values that accounts of two or more owners use; no other can link anything."""
    shared = (
        identities.groupBy("via", "value")
        .agg(F.min("customer_id").alias("_lo"), F.max("customer_id").alias("_hi"))
        .filter("_lo <> _hi")
        .select("via", "value")
    )
    return identities.join(shared, ["via", "value"], "left_semi").select(
        "account_id", "customer_id", "via", "value"
    )


def pairs(members: DataFrame, group: list[str], member: str, block: int = BLOCK) -> DataFrame:
    """Each pair of different members of a group once, ``<member>_a < <member>_b``.

    Other columns come back with suffixes ``_a`` and ``_b``. ``members`` holds a member at
    most once per group. A group larger than ``block`` is cut into blocks by a hash of the
    member, and each pair of blocks is joined under its own key, so no task ever has more
    than two blocks of a group, whatever the size of the group. Only groups of several blocks
    are looked up; they are at most one for ``block`` members.
    """
    carried = [c for c in members.columns if c not in group]
    large = (
        members.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > block)
        .select(*group, F.ceil(F.col("_n") / F.lit(block)).cast("int").alias("_cuts"))
    )
    blocks = F.coalesce("_cuts", F.lit(1))
    cells = (
        members.join(large, group, "left")
        .withColumn("_block", F.pmod(F.xxhash64(member), blocks).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("_low", F.least("_block", "_other"))
        .withColumn("_high", F.greatest("_block", "_other"))
    )
    key = [*group, "_low", "_high"]
    a = cells.select(*key, F.col("_block").alias("_block_a"), *[F.col(c).alias(f"{c}_a") for c in carried])
    b = cells.select(*key, F.col("_block").alias("_block_b"), *[F.col(c).alias(f"{c}_b") for c in carried])
    return (
        a.join(b, key)
        .filter(F.col(f"{member}_a") < F.col(f"{member}_b"))
        .filter(F.least("_block_a", "_block_b") == F.col("_low"))
        .filter(F.greatest("_block_a", "_block_b") == F.col("_high"))
        .select(*group, *[f"{c}_{side}" for side in "ab" for c in carried])
    )


class PairBlocks:
    """The pairs of members of groups as pairs of blocks of members, not listed.

    A group of n members has about (n / block)² / 2 pairs of blocks, so the table grows with the members,
    not with their pairs. It tells how many pairs there are; the pairs of given members are listed
    out of the blocks of their groups, when they are asked for. ``members`` is as for `pairs`.
    """

    def __init__(self, members: DataFrame, group: list[str], member: str, block: int = BLOCK):
        self.group, self.member = group, member
        self.carried = [c for c in members.columns if c not in group]
        large = (
            members.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > block)
            .select(*group, F.ceil(F.col("_n") / F.lit(block)).cast("int").alias("_cuts"))
        )
        cuts = F.coalesce("_cuts", F.lit(1))
        self.members = stage(
            members.join(large, group, "left").withColumn("_cuts", cuts)
            .withColumn("_block", F.pmod(F.xxhash64(member), F.col("_cuts")).cast("int")),
            "pair-members",
        )

    def blocks(self) -> DataFrame:
        """``(group, low, high, pairs)``: which blocks of a group meet, and how many pairs they make."""
        size = self.members.groupBy(*self.group, "_block").agg(F.count(F.lit(1)).alias("_n"))
        low = size.select(*self.group, F.col("_block").alias("low"), F.col("_n").alias("_n_low"))
        high = size.select(*self.group, F.col("_block").alias("high"), F.col("_n").alias("_n_high"))
        made = F.when(F.col("low") == F.col("high"), F.expr("_n_low * (_n_low - 1) div 2")).otherwise(
            F.col("_n_low") * F.col("_n_high")
        )
        return (
            low.join(high, self.group).filter("low <= high")
            .select(*self.group, "low", "high", made.alias("pairs")).filter("pairs > 0")
        )

    def of(self, wanted: DataFrame) -> DataFrame:
        """The pairs, as `pairs` lists them, of which one member or both are ``wanted``, a table of members.

        A wanted member goes to each block of its groups, so a large group is spread over its blocks.
        """
        asked = wanted.select(F.col(wanted.columns[0]).alias(self.member)).distinct().withColumn("_asked", F.lit(True))
        marked = self.members.join(asked, self.member, "left").withColumn("_asked", F.coalesce("_asked", F.lit(False)))
        ours = marked.filter("_asked").select(
            *self.group, F.struct(*self.carried).alias("_ours"),
            F.explode(F.sequence(F.lit(0), F.col("_cuts") - 1)).alias("_block"),
        )
        theirs = marked.select(*self.group, "_block", F.struct(*self.carried).alias("_theirs"), "_asked")
        mine, other = F.col(f"_ours.{self.member}"), F.col(f"_theirs.{self.member}")
        # two wanted members meet twice
        met = ours.join(theirs, [*self.group, "_block"]).filter((mine != other) & (~F.col("_asked") | (mine < other)))
        side = {"a": F.when(mine < other, F.col("_ours")).otherwise(F.col("_theirs")),
                "b": F.when(mine < other, F.col("_theirs")).otherwise(F.col("_ours"))}
        return met.select(*self.group, *[x.alias(f"_{n}") for n, x in side.items()]).select(
            *self.group, *[F.col(f"_{n}.{c}").alias(f"{c}_{n}") for n in side for c in self.carried]
        )


def linked_account_pairs(shared: DataFrame) -> DataFrame:
    """Distinct ``(a, b, via)`` with a < b: accounts of different owners sharing a value."""
    return (
        pairs(shared, ["via", "value"], "account_id")
        .filter("customer_id_a <> customer_id_b")
        .select(F.col("account_id_a").alias("a"), F.col("account_id_b").alias("b"), "via")
        .distinct()
    )


def acc_link(shared: DataFrame) -> DataFrame:
    """The symmetric link table: both directions of every linked pair."""
    once = linked_account_pairs(shared)
    both = F.explode(
        F.array(
            F.struct(F.col("a"), F.col("b")),
            F.struct(F.col("b").alias("a"), F.col("a").alias("b")),
        )
    )
    return once.select(both.alias("_p"), "via").select("_p.a", "_p.b", "via")


def _classes(shared: DataFrame, scope: list[str]) -> DataFrame:
    """``(scope, account_id, cls)``: accounts with the same shared values are of one class, named by
    the number of its values and two 64-bit hashes over them."""
    named = shared.groupBy(*scope, "account_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.bit_xor(F.xxhash64("value")).alias("_x"),
        F.bit_xor(F.xxhash64(F.lit("second"), "value")).alias("_y"),
    )
    return named.select(*scope, "account_id", F.concat_ws(":", "_n", "_x", "_y").alias("cls"))


def repeated_pairs(shared: DataFrame, scope: list[str]) -> DataFrame:
    """``(scope, cls_a, cls_b, values)``: pairs of classes that share two or more values.

    They meet on pairs of values, so a value that very many accounts share brings no two of them
    together unless they share another one.
    """
    classes = _classes(shared, scope)
    held = shared.join(classes, [*scope, "account_id"]).select(*scope, "value", "cls").distinct()
    twice = held.withColumnRenamed("value", "other").join(held, [*scope, "cls"]).filter("value < other")
    met = pairs(twice, [*scope, "value", "other"], "cls").groupBy(*scope, "cls_a", "cls_b").agg(
        F.count(F.lit(1)).alias("_met")
    )
    # c values make c (c - 1) / 2 pairs of values
    values = F.round((1 + F.sqrt(1 + 8 * F.col("_met"))) / 2).cast("bigint")
    return met.select(*scope, "cls_a", "cls_b", values.alias("values"))


def _linked(shared: DataFrame, scope: list[str]) -> DataFrame:
    """``(via, links)`` whose sum is the number of pairs of accounts, within a scope, with a value
    in common."""
    classes = _classes(shared, scope)
    size = classes.groupBy(*scope, "cls").agg(F.count(F.lit(1)).alias("size"))
    inside = size.select("via", F.expr("size * (size - 1) div 2").alias("links"))
    # between classes: each value counts all its pairs of classes, so a pair counts once for each
    # of its values
    by_class = shared.join(classes, [*scope, "account_id"]).groupBy(*scope, "value", "cls").agg(
        F.count(F.lit(1)).alias("n")
    )
    between = by_class.groupBy(*scope, "value").agg(
        F.expr("(sum(n) * sum(n) - sum(n * n)) div 2").alias("links")
    )
    again = (
        repeated_pairs(shared, scope)
        .join(size.toDF(*scope, "cls_a", "size_a"), [*scope, "cls_a"])
        .join(size.toDF(*scope, "cls_b", "size_b"), [*scope, "cls_b"])
        .select("via", ((1 - F.col("values")) * F.col("size_a") * F.col("size_b")).alias("links"))
    )
    return inside.unionByName(between.select("via", "links")).unionByName(again)


def link_counts(shared: DataFrame) -> DataFrame:
    """Number of linked account pairs per kind of identity, without listing the pairs.

    All pairs with a value in common, less those of one owner, counted the same way within each
    owner. Pairs are listed only between classes of accounts that share two or more values.
    """
    own = _linked(shared, ["via", "customer_id"]).select("via", (-F.col("links")).alias("links"))
    return (
        _linked(shared, ["via"]).unionByName(own)
        .groupBy("via")
        .agg(F.sum("links").cast("bigint").alias("pairs"))
        .filter("pairs > 0")
    )


def value_groups(shared: DataFrame) -> DataFrame:
    """``(via, value, account_id, customer_id, members, linked)``: each account with the values it
    shares, the number of accounts that use a value, and how many of them another owner has.

    This is the linear form of the link tables, and the one to build on: summed up, it tells what
    the pairs tell, and it grows with the accounts instead of with their square.
    """
    by_owner = stage(shared.groupBy("via", "value", "customer_id").agg(F.count(F.lit(1)).alias("own")), "own")
    members = stage(by_owner.groupBy("via", "value").agg(F.sum("own").alias("members")), "members")
    return (
        shared.join(members, ["via", "value"]).join(by_owner, ["via", "value", "customer_id"])
        .select("via", "value", "account_id", "customer_id", "members", (F.col("members") - F.col("own")).alias("linked"))
    )


def seen_at(session: DataFrame, account: DataFrame, place: str) -> DataFrame:
    """``(place, customer_id, n, first, last)``: the sessions of each customer on each device or address."""
    return (
        session.filter(F.col(place).isNotNull())
        .groupBy(place, "account_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("session_time").alias("first"),
            F.max("session_time").alias("last"),
        )
        .join(account.select("account_id", "customer_id"), "account_id")
        .groupBy(place, "customer_id")
        .agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))
    )


def _place_links(found: DataFrame, place: str) -> DataFrame:
    return found.select(
        F.col("customer_id_a").alias("customer_a"),
        F.col("customer_id_b").alias("customer_b"),
        place,
        (F.col("n_a") * F.col("n_b")).alias("session_count"),
        F.least("first_a", "first_b").alias("first_seen"),
        F.greatest("last_a", "last_b").alias("last_seen"),
    )


def _shared_place(session: DataFrame, account: DataFrame, place: str) -> DataFrame:
    """Customer pairs seen on one device or address. Sessions are first summed up per customer
    and place: the number of session pairs is the product of the two counts."""
    return _place_links(pairs(seen_at(session, account, place), [place], "customer_id"), place)


def open_ip_sessions(session: DataFrame, ip_address: DataFrame) -> DataFrame:
    """Sessions from known addresses that are not marked as VPN; unknown counts as not."""
    not_vpn = ip_address.filter("coalesce(is_vpn, false) = false").select("ip_id")
    return session.join(not_vpn, "ip_id", "left_semi")


def shared_device_link(session: DataFrame, account: DataFrame) -> DataFrame:
    return _shared_place(session, account, "device_id")


def shared_ip_link(session: DataFrame, account: DataFrame, ip_address: DataFrame) -> DataFrame:
    return _shared_place(open_ip_sessions(session, ip_address), account, "ip_id")


def contacts(customer: DataFrame) -> DataFrame:
    """``(customer_id, match_type, match_value)`` of each contact that a customer gives."""
    return (
        customer.select("customer_id", "email", "phone", "address")
        .unpivot("customer_id", ["email", "phone", "address"], "match_type", "match_value")
        .filter("match_value is not null")
    )


def shared_contact_link(customer: DataFrame) -> DataFrame:
    return pairs(contacts(customer), ["match_type", "match_value"], "customer_id").select(
        F.col("customer_id_a").alias("customer_a"),
        F.col("customer_id_b").alias("customer_b"),
        "match_type",
        "match_value",
    )


def links_of(
    wanted: DataFrame, session: DataFrame, account: DataFrame, ip_address: DataFrame, customer: DataFrame
) -> DataFrame:
    """``(kind, value, customer_a, customer_b)``: what the three link tables say of the ``wanted`` customers,
    without listing those tables."""
    open_sessions = open_ip_sessions(session, ip_address)
    members = (
        seen_at(session, account, "device_id").select(F.lit("device").alias("kind"), F.col("device_id").alias("value"), "customer_id")
        .unionByName(seen_at(open_sessions, account, "ip_id").select(F.lit("ip").alias("kind"), F.col("ip_id").alias("value"), "customer_id"))
        .unionByName(contacts(customer).select(F.col("match_type").alias("kind"), F.col("match_value").alias("value"), "customer_id"))
    )
    found = PairBlocks(members, ["kind", "value"], "customer_id").of(wanted)
    return found.select("kind", "value", F.col("customer_id_a").alias("customer_a"), F.col("customer_id_b").alias("customer_b"))


def place_pair_count(session: DataFrame, account: DataFrame, place: str) -> DataFrame:
    """How many rows `_shared_place` has: n(n-1)/2 for a place with n customers."""
    customers = (
        session.filter(F.col(place).isNotNull())
        .select(place, "account_id")
        .distinct()
        .join(account.select("account_id", "customer_id"), "account_id")
        .groupBy(place)
        .agg(F.countDistinct("customer_id").alias("n"))
    )
    total = F.sum(F.expr("n * (n - 1) div 2"))
    return customers.agg(F.coalesce(total, F.lit(0)).cast("bigint").alias("n"))


def link_view_counts(session: DataFrame, account: DataFrame, ip_address: DataFrame) -> DataFrame:
    by_device = place_pair_count(session, account, "device_id")
    by_ip = place_pair_count(open_ip_sessions(session, ip_address), account, "ip_id")
    return by_device.select(F.lit("shared_device_pairs").alias("view"), "n").unionByName(
        by_ip.select(F.lit("shared_ip_pairs").alias("view"), "n")
    )
