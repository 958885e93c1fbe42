import random
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from fixtures import START, accounts, at, edges, shared, transactions, txn
from tidewatch.operators import rings
from tidewatch.operators.walks import HopRule, long_walks, money_edge, money_walk


def keys(df):
    return sorted(r.path_key for r in df.select("path_key").collect())


def test_hop_bounds(spark):
    cases = [
        ("90.00", at(48), True),
        ("90.00", at(48, 1), False),
        ("90.00", at(0), False),
        ("90.00", at(0, 1), True),
        ("80.00", at(1), True),
        ("79.99", at(1), False),
        ("100.00", at(1), True),
        ("100.01", at(1), False),
    ]
    rows = []
    for n, (amount, time, _) in enumerate(cases):
        rows.append((f"{n}a", f"A{n}", f"B{n}", "100.00", START))
        rows.append((f"{n}b", f"B{n}", f"C{n}", amount, time))
    found = keys(money_walk(edges(spark, rows)).filter("hops = 2"))
    assert found == [f"{n}a,{n}b" for n, case in enumerate(cases) if case[2]]


def test_eight_hops_and_no_more(spark):
    rows = [(f"t{i}", f"A{i}", f"A{i + 1}", "100.00", at(i)) for i in range(9)]
    walks = money_walk(edges(spark, rows))
    by_hops = {r.hops: r["count"] for r in walks.groupBy("hops").count().collect()}
    assert by_hops == {n: 10 - n for n in range(1, 9)}


def test_revisit_is_dropped_and_closing_ends_the_path(spark):
    rows = [
        ("t1", "A", "B", 100, at(0)), ("t2", "B", "C", 100, at(1)), ("t3", "C", "B", 100, at(2)),
        ("t4", "C", "A", 100, at(3)), ("t5", "A", "D", 100, at(4)),
    ]
    found = keys(money_walk(edges(spark, rows)))
    assert "t1,t2,t4" in found and "t2,t4,t5" in found
    assert "t1,t2,t3" not in found and "t1,t2,t4,t5" not in found
    assert "t2,t3" in found  # back to B, where this path began


def test_edges_are_completed_transfers_between_owners(spark):
    owners = accounts(spark, [("A", "c1", None), ("B", "c2", None), ("A2", "c1", None)])
    rows = [
        txn("ok", "A", "B"), txn("own", "A", "A2"), txn("rev", "A", "B", status="reversed"),
        txn("blk", "A", "B", status="blocked"), txn("cash", None, "B", kind="cash_deposit"),
        txn("gone", "A", "X"),
    ]
    assert [r[0] for r in money_edge(transactions(spark, rows), owners).collect()] == ["ok"]


def brute_walks(rows, revisit):
    walks, level = [], [([s, d], [i], a, t) for i, s, d, a, t in rows]
    while level:
        walks += level
        level = [
            (path + [d], ids + [i], a, t)
            for path, ids, amount, time in level
            if len(ids) < 8 and (revisit or path[-1] != path[0])
            for i, s, d, a, t in rows
            if s == path[-1] and time < t <= time + timedelta(hours=48)
            and amount * Decimal("0.80") <= a <= amount
            and (revisit or d == path[0] or d not in path)
        ]
    return walks


def random_edges(seed, n=60, accounts=8, own=False):
    """Transfers whose amounts fall with time, so that long paths occur."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hour = rng.randint(0, 200)
        src, dst = rng.sample(range(accounts), 2)
        if own and i % 15 == 0:
            dst = src
        cents = 10000 - 15 * hour + rng.randint(0, 400)
        rows.append((f"t{i:03d}", f"A{src}", f"A{dst}", Decimal(cents) / 100, at(hour)))
    return rows


@pytest.mark.parametrize("revisit", [False, True])
def test_walks_equal_brute_force(spark, revisit):
    rows = random_edges(3, own=revisit)
    want = sorted((",".join(ids), ",".join(path)) for path, ids, _, _ in brute_walks(rows, revisit))
    walks = money_walk(edges(spark, rows), HopRule(revisit=revisit))
    got = sorted((r.path_key, ",".join(r.path)) for r in walks.select("path_key", "path").collect())
    assert got == want
    assert max(len(w[0].split(",")) for w in want) >= 6


@pytest.mark.parametrize("revisit", [False, True])
def test_maximal_rings_equal_subset_test(spark, revisit):
    rows = random_edges(5, own=revisit)
    walks = long_walks(edges(spark, rows), HopRule(revisit=revisit))
    sharing = shared(spark, [("A0", "c0", "device", "d"), ("A1", "c1", "device", "d"),
                             ("A2", "c2", "phone", "p"), ("A4", "c4", "phone", "p")])
    candidates = rings.round_trip_candidates(walks, sharing)
    sets = {r.path_key: set(r.txn_ids) for r in candidates.collect()}
    want = sorted(k for k, s in sets.items() if not any(s < other for other in sets.values()))
    assert keys(rings.maximal_rings(candidates)) == want
    assert 0 < len(want) < len(sets)


def test_layering_equals_subset_and_overlap_test(spark):
    rows = random_edges(19, n=60, accounts=16)
    walks = long_walks(edges(spark, rows))
    nothing = shared(spark, [])
    found = rings.round_trip(rings.round_trip_candidates(walks, nothing), nothing)
    ring_txns = {t for r in found.collect() for t in r.txn_ids}
    long_paths = [r for r in walks.collect() if r.hops >= 4]
    want = sorted(
        w.path_key for w in long_paths
        if w.cur != w.origin
        and not any(set(w.txn_ids) < set(b.txn_ids) for b in long_paths)
        and not set(w.txn_ids) & ring_txns
    )
    chains = rings.layering(walks, found)
    assert keys(chains) == want and want
    assert not any(set(r.txn_ids) & ring_txns for r in chains.collect())


RING = [("t1", "A", "B", 100, at(0)), ("t2", "B", "C", 95, at(1)), ("t3", "C", "A", 90, at(2))]


def find_rings(spark, rows, sharing):
    walks = long_walks(edges(spark, rows))
    identities = shared(spark, sharing)
    return rings.round_trip(rings.round_trip_candidates(walks, identities), identities).collect()


def test_plain_ring_is_medium(spark):
    (ring,) = find_rings(spark, RING, [])
    assert (ring.closed_by, ring.tier, ring.shared_pairs, ring.shared_via) == ("same_account", "medium", 0, [])
    assert ring.decay_pct == Decimal("10.0")


def test_ring_with_sharing_members_is_high(spark):
    (ring,) = find_rings(spark, RING, [("B", "cb", "phone", "1"), ("C", "cc", "phone", "1")])
    assert (ring.closed_by, ring.tier, ring.shared_pairs, ring.shared_via) == (
        "same_account", "high", 2, ["phone"])


def test_two_hop_return_is_no_ring(spark):
    assert find_rings(spark, [RING[0], ("t2", "B", "A", 95, at(1))], []) == []


def test_path_closing_through_several_links_is_named_once(spark):
    rows = RING[:2] + [("t3", "C", "D", 90, at(2))]
    sharing = [(a, c, via, "x") for a, c in (("A", "ca"), ("D", "cd")) for via in ("phone", "email", "device")]
    (ring,) = find_rings(spark, rows, sharing)
    assert (ring.closed_by, ring.closed_on, ring.tier) == ("linked_device", "D", "high")
    assert ring.shared_pairs == 6


def test_only_the_larger_of_nested_rings_stays(spark):
    rows = RING[:2] + [("t3", "C", "D", 90, at(2)), ("t4", "D", "A", 85, at(3))]
    sharing = [("A", "ca", "device", "x"), ("D", "cd", "device", "x")]
    (ring,) = find_rings(spark, rows, sharing)
    assert ring.path_key == "t1,t2,t3,t4"


def test_open_part_of_a_closed_path_is_no_layering(spark):
    rows = RING[:2] + [("t3", "C", "D", 90, at(2)), ("t4", "D", "E", 90, at(3)), ("t5", "E", "A", 90, at(4))]
    walks = long_walks(edges(spark, rows))
    nothing = shared(spark, [])
    found = rings.round_trip(rings.round_trip_candidates(walks, nothing), nothing)
    assert rings.layering(walks, found).count() == 0
    chain = long_walks(edges(spark, rows[:4]))
    assert keys(rings.layering(chain, found.limit(0))) == ["t1,t2,t3,t4"]


def test_a_path_is_compared_by_its_rarest_transfer(spark):
    """Neighbouring transfers and others, a loop left out, equal sets, a transfer that no longer path holds."""
    def paths(*rows):
        made = [(",".join(ids), len(ids), list(ids)) for ids in rows]
        return spark.createDataFrame(made, "path_key string, hops int, txn_ids array<string>")

    longer = paths("abcdefgh", "abcxy", "bcd", "abq")
    short = paths("abc", "aef", "bcd", "abq", "hgf", "axy", "abz", "cxd", "abcxy")
    kept = keys(rings.drop_contained(short, longer, 3))
    assert kept == sorted([",".join(x) for x in ("abq", "abz", "cxd", "abcxy")])
    plan = rings.drop_contained(short, longer, 3)._jdf.queryExecution().toString()
    assert "transform" not in plan and "LeftAnti" in plan


def test_a_hub_transfer_is_not_looked_up(spark):
    """All paths hold t0; each is compared only with what holds its own other transfers."""
    rows = [(f"t0,a{i},b{i},c{i}", 4, ["t0", f"a{i}", f"b{i}", f"c{i}"]) for i in range(200)]
    rows += [(f"t0,a{i},b{i}", 3, ["t0", f"a{i}", f"b{i}"]) for i in range(0, 200, 2)] + [("t0,q,r", 3, ["t0", "q", "r"])]
    found = spark.createDataFrame(rows, "path_key string, hops int, txn_ids array<string>")
    assert keys(rings.drop_contained(found, found, 3)) == sorted([r[0] for r in rows[:200]] + ["t0,q,r"])


def test_an_end_is_multiplied_by_the_fewer_values(spark):
    """The origin has 40 devices, each end one: one pair for each end, whatever the origin has."""
    ends = spark.createDataFrame([("HUB", f"E{i}") for i in range(30)] + [("E0", "HUB"), ("E1", "E2")], "origin string, cur string")
    rows = [("HUB", "c", "device", f"d{i}") for i in range(40)] + [(f"E{i}", f"o{i}", "device", f"d{i}") for i in range(30)]
    rows += [("E3", "o3", "phone", "p"), ("HUB", "c", "phone", "p")]
    found = {(r.origin, r.cur): r.via for r in rings.closing_links(ends, shared(spark, rows)).collect()}
    assert found == {("HUB", f"E{i}"): "device" for i in range(30)} | {("E0", "HUB"): "device"}
