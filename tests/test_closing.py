"""Rings from halves against all paths, and what a hub costs."""

import random
from decimal import Decimal

import pytest
from fixtures import at, edges, shared
from test_walks import random_edges
from tidewatch import registry
from tidewatch.operators import closing, rings
from tidewatch.operators.closing import closing_paths, hubs
from tidewatch.operators.walks import HopRule, long_walks
from tidewatch.plans.pipeline import Run
from tidewatch.staging import noting

LINKS = [
    ("A0", "c0", "device", "d"), ("A1", "c1", "device", "d"), ("A2", "c2", "phone", "p"), ("A4", "c4", "phone", "p"),
    ("A0", "c0", "email", "e"), ("A1", "c1", "email", "e"), ("A5", "c5", "device", "d"), ("A3", "c0", "device", "d"),
]


def rows_of(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


@pytest.mark.parametrize("revisit", [False, True])
@pytest.mark.parametrize("hub_pairs", [10_000, 60, 3])
def test_closing_paths_equal_those_among_all_paths(spark, revisit, hub_pairs):
    """Without a hub, with some, and with every account a hub."""
    rows = random_edges(5, own=revisit) + [
        (f"x{i}", f"A{i % 8}", "A0", Decimal("70.00") - i, at(201 + i)) for i in range(1, 8)
    ]
    edge, sharing = edges(spark, rows), shared(spark, LINKS)
    want = rings.round_trip_candidates(long_walks(edge, HopRule(revisit=revisit)), sharing)
    rule = HopRule(revisit=revisit, hub_pairs=hub_pairs)
    found = rows_of(closing_paths(edge, sharing, rule).select(*want.columns))
    assert found == rows_of(want) and len(found) > 10
    assert {10_000: 0, 60: 1, 3: 8}[hub_pairs] <= hubs(edge, rule).count()


@pytest.mark.parametrize("seed", range(3))
def test_rings_through_several_hubs(spark, seed):
    draw = random.Random(seed)
    hop = [("H0", "H1"), ("H1", "H2"), ("H2", "H0"), ("H1", "B"), ("B", "H2"), ("H2", "A"), ("A", "H0"), ("A", "H1"), ("H0", "C"), ("C", "A")]
    rows = []
    for i in range(45):
        hour = draw.randint(0, 160)
        rows.append((f"t{i:02d}", *draw.choice(hop), Decimal(10000 - 15 * hour + draw.randint(0, 300)) / 100, at(hour)))
    edge, sharing = edges(spark, rows), shared(spark, [("A", "ca", "phone", "1"), ("H1", "ch", "phone", "1"), ("C", "cc", "phone", "1")])
    want = rings.round_trip_candidates(long_walks(edge), sharing)
    found = closing_paths(edge, sharing, HopRule(hub_pairs=20))
    assert rows_of(found.select(*want.columns)) == rows_of(want)


def staged_rows(spark, folders):
    return sum(spark.read.parquet(f).count() for f in folders)


@pytest.mark.parametrize("n", [150, 300])
def test_a_hub_stages_no_pairs(spark, n):
    """n transfers in, n out, all of which could follow, and one ring through the hub: O(n) rows."""
    rows = [(f"i{i}", f"A{i}", "HUB", "100.00", at(0, i)) for i in range(n)]
    rows += [(f"o{i}", "HUB", f"B{i}", "95.00", at(5, i)) for i in range(n)]
    rows.append(("back", "B7", "A3", "90.00", at(6)))
    folders = []
    with noting(folders):
        found = closing_paths(edges(spark, rows), shared(spark, []))
        assert [r.path_key for r in found.collect()] == ["i3,o7,back"]
    assert hubs(edges(spark, rows)).count() == 1
    assert staged_rows(spark, folders) <= 3 * len(rows)


def test_a_hub_ring_may_close_by_identity(spark):
    """Head and tail meet on the identity of their ends; kinds are named once, the first by name."""
    rows = [(f"i{i}", f"A{i}", "HUB", "100.00", at(0, i)) for i in range(120)]
    rows += [(f"o{i}", "HUB", f"B{i}", "95.00", at(5, i)) for i in range(120)]
    rows.append(("on", "B7", "C", "90.00", at(6)))
    sharing = [(a, c, via, "x") for a, c in (("A3", "ca"), ("C", "cc")) for via in ("phone", "device")]
    (ring,) = closing_paths(edges(spark, rows), shared(spark, sharing)).collect()
    assert (ring.path_key, ring.closed_by, ring.cur) == ("i3,o7,on", "linked_device", "C")
    assert ring.path == ["A3", "HUB", "B7", "C"]


def test_detected_transfers_list_paths_once(spark, monkeypatch):
    """Layering needs all paths, so round trips are picked out of those and not put together once more."""
    ours = ["A", "B", "C", "D", "E", "F", "A", "G"]
    rows = [(f"t{i}", a, b, Decimal("100.00") - i, at(i)) for i, (a, b) in enumerate(zip(ours, ours[1:], strict=False))]
    rows += [(f"u{i}", f"L{i}", f"L{i + 1}", Decimal("90.00") - i, at(i)) for i in range(5)]
    tables = {"ground_truth": spark.createDataFrame(
        [("t0", "round_trip", "x", 0), ("t1", "round_trip", "x", 1), ("u2", "layering_chain", "y", 0), ("t0", None, None, 0)],
        "transaction_id string, pattern_label string, chain_id string, hop_index int")}

    def run():
        made = Run(tables.__getitem__)
        made.__dict__.update(edges=edges(spark, rows), shared=shared(spark, LINKS))
        return made

    with run() as apart:
        apart.round_trip  # noqa: B018 - before any path is listed, so from halves
        want = rows_of(registry.evaluate.detection_txns(apart.round_trip, apart.layering))
    listed = []
    monkeypatch.setattr(closing, "staged_walks", lambda *_: listed.append(1))
    with run() as made:
        assert rows_of(registry.detection_txns(made)) == want and len(want) >= 11
    with run() as made:
        assert [(r.chain_id, r.hit_txn) for r in registry.best_detection(made).orderBy("chain_id").collect()] == [("x", 2), ("y", 1)]
    assert not listed
