import random
from collections import Counter
from datetime import timedelta
from decimal import Decimal

import pytest
from fixtures import START, accounts, at, deposit, sessions, transactions, txn
from tidewatch.operators import mule, nearest, structuring
from tidewatch.staging import ranged


def test_pass_through_bounds(spark):
    cases = {
        "in24h": ("1000.00", "950.00", at(24), True),
        "late": ("1000.00", "950.00", at(24, 1), False),
        "same_time": ("1000.00", "950.00", at(0), False),
        "at90": ("1000.00", "900.00", at(1), True),
        "below90": ("1000.00", "899.99", at(1), False),
        "all": ("1000.00", "1000.00", at(1), True),
        "more": ("1000.00", "1000.01", at(1), False),
        "small": ("999.99", "950.00", at(1), False),
    }
    rows = []
    for name, (received, paid, time, _) in cases.items():
        rows.append(txn(f"i-{name}", None, name, received))
        rows.append(txn(f"o-{name}", name, None, paid, time))
    rows += [txn("x", None, "undone", "1000.00"), txn("y", "undone", None, "950.00", at(1), status="reversed")]
    found = sorted(r[0] for r in mule.pass_through(transactions(spark, rows)).collect())
    assert found == sorted(n for n, c in cases.items() if c[3])


def test_mule_ring_needs_three_customers_with_new_accounts(spark):
    first = START.date()
    opened = first - timedelta(days=150)
    owners = [(f"A{i}", f"C{i}", opened) for i in range(5)]
    owners += [("B1", "C1", opened), ("OLD", "C9", opened - timedelta(days=1))]
    logins = [("d3", a) for a in ("A0", "A1", "A2")] + [("d2", a) for a in ("A3", "A4")]
    logins += [("same", a) for a in ("A1", "B1", "A2")] + [("old", a) for a in ("A0", "A1", "OLD")]
    found = sessions(spark, [(f"s{i}", a, d, None, START) for i, (d, a) in enumerate(logins * 2)])
    moving = transactions(
        spark,
        [txn(f"i{a}", None, a, "1000.00") for a, _, _ in owners]
        + [txn(f"o{a}", a, None, "950.00", at(1)) for a, _, _ in owners],
    )
    members = mule.mule_members(found, accounts(spark, owners), moving, mule.pass_through(moving))
    rings = mule.mule_ring(members)
    (ring,) = rings.join(mule.mule_accounts(members, rings), "device_id").collect()
    assert (ring.device_id, ring.n_customers, ring.accounts) == ("d3", 3, ["A0", "A1", "A2"])
    assert (ring.n_accounts, ring.first_account, ring.part, ring.parts) == (3, "A0", 0, 1)
    assert mule.ring_members(members, rings).count() == 3


def test_lists_in_parts_hold_every_id(spark):
    """Whatever its size, a detection's parts together hold all of its ids, and no list is missing."""
    rows = [(d, f"A{i:03d}", f"C{i}") for d, n in (("big", 83), ("small", 3), ("full", 5), ("over", 6)) for i in range(n)]
    members = spark.createDataFrame(rows, "device_id string, account_id string, customer_id string")
    rings = mule.mule_ring(members)
    lists = mule.mule_accounts(members, rings, part=5).collect()
    for device in ("big", "small", "full", "over"):
        mine = [r for r in lists if r.device_id == device]
        want = [a for d, a, _ in rows if d == device]
        assert sorted(a for r in mine for a in r.accounts) == want
        assert all(r.accounts == sorted(r.accounts) and r.accounts for r in mine)
        assert {r.parts for r in mine} == {-(-len(want) // 5)} and all(0 <= r.part < r.parts for r in mine)
        assert len(mine) == len({r.part for r in mine})
    deposits = [deposit(f"d{i:02d}", "X", "9000.00", at(i % 24), f"B{i % 7}") for i in range(40)]
    flagged = structuring.flagged_deposits(transactions(spark, deposits))
    parts = structuring.deposit_lists(flagged, structuring.structuring_daily(flagged), part=5).collect()
    assert sorted(t for r in parts for t in r.txn_ids) == [f"d{i:02d}" for i in range(40)]
    assert {b for r in parts for b in r.branches} == {f"B{i}" for i in range(7)} and len(parts) > 4


def test_structuring_daily_bounds(spark):
    rows = [
        deposit("1", "two", "7000.00", at(0)), deposit("2", "two", "9999.99", at(2), "B2"),
        deposit("3", "under", "6999.99", at(0)), deposit("4", "under", "9000.00", at(1)),
        deposit("5", "over", "10000.00", at(0)), deposit("6", "over", "9000.00", at(1)),
        deposit("7", "days", "9000.00", at(0)), deposit("8", "days", "9000.00", at(24)),
        deposit("9", "undone", "9000.00", at(0)), deposit("a", "undone", "9000.00", at(1), status="reversed"),
    ]
    flagged = structuring.flagged_deposits(transactions(spark, rows))
    totals = structuring.structuring_daily(flagged)
    found = totals.join(structuring.deposit_lists(flagged, totals), "account_id").collect()
    assert [r.account_id for r in found] == ["two"]
    (r,) = found
    assert (r.n_days, r.n_deposits, r.n_branches, r.total_amount) == (1, 2, 2, Decimal("16999.99"))
    assert (r.first_txn, r.txn_ids, r.first_day) == ("1", ["1", "2"], START.date())


def rolling(spark, rows, **rule):
    inside = structuring.window_deposits(transactions(spark, rows), **rule)
    totals = structuring.structuring_rolling(inside)
    lists = structuring.deposit_lists(inside, totals)
    return {r.account_id: r for r in totals.join(lists, "account_id").collect()}


@pytest.fixture
def many_ranges(spark):
    """Ranges are not put together again, so that one account lies in several."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")


def test_one_account_lies_in_several_ranges(spark, many_ranges):
    rows = spark.range(200).selectExpr("'A' as account_id", "id")
    assert ranged(rows, "account_id", "id").select("_slot").distinct().count() > 1


def test_structuring_rolling_bounds(spark):
    def run(account, times, branches, amount="500.00"):
        return [
            deposit(f"{account}{i}", account, amount, t, b) for i, (t, b) in enumerate(zip(times, branches))
        ]

    five = [at(24 * i) for i in range(5)]
    rows = run("hit", five, "XYXYX") + run("one", five, "XXXXX") + run("many", five, "XYZXX")
    rows += run("edge", five[:4] + [at(240)], "XYXYX")  # the first deposit is ten days old
    rows += run("inside", five[:4] + [at(239, 3599)], "XYXYX")
    rows += run("big", five, "XYXYX", "10000.00")
    found = rolling(spark, rows)
    assert sorted(found) == ["hit", "inside", "many"]
    assert found["hit"].tier == "medium" and found["many"].tier == "high"
    assert found["hit"].n_days == 5 and found["hit"].branches == ["X", "Y"]
    assert found["inside"].txn_ids == [f"inside{i}" for i in range(5)]


def test_structuring_rolling_equals_brute_force(spark, many_ranges):
    rng = random.Random(7)
    rows = [
        deposit(f"d{i:03d}", f"A{rng.randint(0, 2)}", f"{rng.randint(1, 99)}00.00",
                at(rng.randint(0, 24 * 90)), rng.choice("XYZ"))
        for i in range(150)
    ]
    want = {}
    for account in ("A0", "A1", "A2"):
        mine = [(r[4], r[5], r[9], r[0]) for r in rows if r[2] == account and r[5] < 10000]
        for end in {m[0] for m in mine}:
            inside = sorted(m for m in mine if end - timedelta(days=10) < m[0] <= end)
            if len(inside) >= 4 and len({m[2] for m in inside}) >= 2:
                rank = (-len(inside), -sum(m[1] for m in inside), end)
                if account not in want or rank < want[account][0]:
                    ids = [m[3] for m in sorted(inside, key=lambda m: (m[0], m[3]))]
                    want[account] = (rank, ids, len({m[2] for m in inside}))
    found = rolling(spark, rows, min_deposits=4)
    assert {a: (r.txn_ids, r.n_branches) for a, r in found.items()} == {
        a: (ids, n) for a, (_, ids, n) in want.items()
    }
    assert len(want) == 3


def test_nearest_session(spark):
    txns = transactions(spark, [
        txn("between", "A", None, time=at(1)), txn("tie", "A", None, time=at(5)),
        txn("exact", "A", None, time=at(10)), txn("before_all", "A", None, time=at(-100)),
        txn("after_all", "A", None, time=at(500)), txn("none", "B", None, time=at(0)),
        txn("cash", None, "A", kind="cash_deposit"),
    ])
    logins = sessions(spark, [
        ("s1", "A", None, None, at(0)), ("s2", "A", None, None, at(10)), ("s2b", "A", None, None, at(10)),
        ("s3", "A", None, None, at(48)),
    ])
    got = {r.transaction_id: r.session_id for r in nearest.nearest_session_join(txns, logins).collect()}
    assert got == {"between": "s1", "tie": "s1", "exact": "s2", "before_all": "s1", "after_all": "s3",
                   "none": None}


def test_nearest_session_equals_brute_force(spark, many_ranges):
    rng = random.Random(1)
    logins = [(f"s{i:02d}", f"A{rng.randint(0, 3)}", None, None, at(rng.randint(0, 300))) for i in range(40)]
    txns = [txn(f"t{i}", f"A{rng.randint(0, 4)}", None, time=at(rng.randint(-20, 320))) for i in range(80)]
    want = {}
    for row in txns:
        mine = sorted((s[4], s[0]) for s in logins if s[1] == row[1])
        before = [s for s in mine if s[0] < row[4]][-1:]
        after = [s for s in mine if s[0] >= row[4]][:1]
        near = sorted(before + after, key=lambda s: (abs(s[0] - row[4]), s[0]))
        want[row[0]] = near[0][1] if near else None
    found = nearest.nearest_session_join(transactions(spark, txns), sessions(spark, logins))
    assert {r.transaction_id: r.session_id for r in found.collect()} == want
    assert Counter(v is None for v in want.values())[False] > 50


