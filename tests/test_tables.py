import json
import random
from decimal import Decimal
from pathlib import Path
from threading import Barrier

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from fixtures import START, accounts, at, deposit, sessions, shared, transactions, txn
from pyspark.sql import functions as F

from tidewatch import registry, staging
from tidewatch.functions import labels
from tidewatch.functions.columns import padded_id
from tidewatch.operators import links, mule
from tidewatch.plans import alerts, evaluate, governance, graph_tables, quality
from tidewatch.sources import landing
from tidewatch.sources.snapshots import Snapshots
from tidewatch.staging import number_rows, together


def test_pairs_are_whole_whatever_the_block(spark):
    rows = [("g", f"m{i:02d}") for i in range(23)] + [("h", "x"), ("h", "y"), ("i", "z")]
    members = spark.createDataFrame(rows, "grp string, member string")
    want = sorted((g, a, b) for g, a in rows for h, b in rows if g == h and a < b)
    for block in (1, 4, 100):
        found = links.pairs(members, ["grp"], "member", block)
        assert sorted(map(tuple, found.collect())) == want


def test_pair_blocks_list_what_is_asked_and_grow_with_the_members(spark):
    rows = [("g", f"m{i:03d}", i) for i in range(120)] + [("h", "m001", 1), ("h", "y", 2), ("i", "z", 3)]
    members = spark.createDataFrame(rows, "grp string, member string, n int")
    listed = {tuple(r) for r in links.pairs(members, ["grp"], "member", 1000).collect()}
    wanted = spark.createDataFrame([("m001",), ("m077",), ("z",), ("nobody",), ("m001",)], "customer string")
    for block in (7, 1000):
        compressed = links.PairBlocks(members, ["grp"], "member", block)
        found = compressed.of(wanted).collect()
        assert sorted(map(tuple, found)) == sorted(r for r in listed if {r[1], r[3]} & {"m001", "m077", "z"})
        blocks = compressed.blocks().collect()
        assert sum(r.pairs for r in blocks) == len(listed) == 120 * 119 // 2 + 1
    assert len(blocks) == 2


def test_link_counts_equal_listed_pairs(spark):
    rng = random.Random(2)
    rows = {(f"A{i}", f"C{i // 2}", rng.choice(["phone", "device"]), f"v{rng.randint(0, 9)}")
            for i in range(30) for _ in range(4)}
    identities = links.shared_identity(shared(spark, sorted(rows)))
    listed = links.acc_link(identities)
    want = {r.via: r["count"] // 2 for r in listed.groupBy("via").count().collect()}
    assert {r.via: r.pairs for r in links.link_counts(identities).collect()} == want
    flipped = listed.select(F.col("b").alias("a"), F.col("a").alias("b"), "via")
    assert listed.exceptAll(flipped).count() == 0
    groups = links.value_groups(identities).collect()
    pairs = {(r.via, r.value, r.account_id): r.linked for r in groups}
    for (via, value, account), n in pairs.items():
        owner = next(c for a, c, v, x in rows if (a, v, x) == (account, via, value))
        assert n == sum(v == via and x == value and c != owner for _, c, v, x in rows)


@pytest.mark.parametrize("n", [50, 200])
def test_a_hot_value_lists_no_pairs(spark, n):
    """n accounts on one device, each with a second one that it shares with one more account."""
    rows = [(f"A{i}", f"C{i}", "device", "hot") for i in range(n)]
    rows += [(a, c, "device", f"d{i}") for i in range(n) for a, c in ((f"A{i}", f"C{i}"), (f"B{i}", f"D{i}"))]
    identities = links.shared_identity(shared(spark, rows))
    assert links.repeated_pairs(identities, ["via"]).count() == 0
    assert [tuple(r) for r in links.link_counts(identities).collect()] == [("device", n * (n - 1) // 2 + n)]


def test_shared_ip_counts_unknown_as_not_vpn(spark):
    owners = accounts(spark, [("A", "c1", None), ("B", "c2", None)])
    places = spark.createDataFrame([("v", True), ("n", False), ("u", None)], "ip_id string, is_vpn boolean")
    logins = sessions(spark, [
        (f"{a}{ip}{i}", a, None, ip, at(i)) for a in "AB" for ip in "vnu" for i in range(2)
    ])
    found = links.shared_ip_link(logins, owners, places).collect()
    assert sorted((r.ip_id, r.session_count, r.first_seen, r.last_seen) for r in found) == [
        ("n", 4, at(0), at(1)), ("u", 4, at(0), at(1))]
    counts = {r.view: r.n for r in links.link_view_counts(logins, owners, places).collect()}
    assert counts == {"shared_device_pairs": 0, "shared_ip_pairs": 2}


def test_contacts_are_trimmed_and_blank_ones_dropped(spark):
    rows = [("1", None, "a@x", "s"), ("2", " ", "b@x", "s"), ("3", "04 ", "c@x", "t"), ("4", "04", "d@x", "t")]
    customer = spark.createDataFrame(rows, "customer_id string, phone string, email string, address string")
    nodes = {r.contact_key for r in graph_tables.node_contact(customer).collect()}
    assert nodes == {"phone|04", "email|a@x", "email|b@x", "email|c@x", "email|d@x", "address|s", "address|t"}
    raw = {(r.customer_a, r.customer_b, r.match_type) for r in links.shared_contact_link(customer).collect()}
    assert raw == {("1", "2", "address"), ("3", "4", "address")}


def test_rows_are_numbered_in_order_across_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    numbered = number_rows(df, [F.col("v")], "n").collect()
    assert sorted((r.v, r.n) for r in numbered) == [(i, i + 1) for i in range(1000)]


def test_ids_are_padded_but_never_cut(spark):
    df = spark.createDataFrame([(7,), (1234567,)], "n long").select(padded_id("ALT-", F.col("n"), 6))
    assert [r[0] for r in df.collect()] == ["ALT-000007", "ALT-1234567"]


def test_landing_nulls_and_bad_lines(spark, tmp_path):
    good = [
        {"account_id": "A1", "customer_id": "C1", "balance": 12.3, "open_date": "2026-01-02", "status": None},
        {"account_id": "A2", "customer_id": "null", "balance": None},
    ]
    path = tmp_path / "accounts.jsonl"
    path.write_text("\n".join(json.dumps(r) for r in good) + "\n\n")
    rows = landing.curate(landing.land_raw_json(spark, str(path)), "account").orderBy("account_id").collect()
    assert (rows[0].balance, rows[0].status, str(rows[0].open_date)) == (Decimal("12.30"), None, "2026-01-02")
    assert (rows[1].balance, rows[1].customer_id, rows[1].open_date) == (None, "null", None)
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"account_id": "A1"}\n{"account_id": \n')
    with pytest.raises(Exception, match="MALFORMED|parse"):
        landing.land_raw_json(spark, str(bad)).collect()


def test_raw_tables_are_loaded_once_and_whole(spark, tmp_path):
    """What is loaded is stamped once; a load with one bad line leaves all tables as they were."""
    def lines(name, *texts):
        path = tmp_path / f"{name}.jsonl"
        path.write_text("\n".join(texts))
        return str(path)

    store = str(tmp_path / "raw")
    good = {
        "account": lines("a1", '{"account_id": "A", "balance": 1.5, "extra": [1]}', "", '{"account_id": null}'),
        "device": lines("d1", '{"device_id": "D"}'),
    }
    raw = landing.load_raw(spark, store, good)
    first = sorted(map(str, raw["account"].select("src_file", "loaded_ts").collect()))
    assert len(first) == 2 and sorted(map(str, raw["account"].select("src_file", "loaded_ts").collect())) == first
    assert sorted(r.account_id or "" for r in landing.curate(raw["account"], "account").collect()) == ["", "A"]
    plan = landing.curate(raw["account"], "account").select("account_id")._jdf.queryExecution().toString()
    assert "parse_json" not in plan and "ReadSchema: struct<payload:struct<0:string>>" in plan
    bad = {"account": lines("a2", '{"account_id": "B"}'), "device": lines("d2", '{"device_id": "E"}', "{broken")}
    with pytest.raises(Exception):
        landing.load_raw(spark, store, bad)
    again = landing.open_raw(spark, store, ["account", "device"])
    assert sorted(map(str, again["account"].select("src_file", "loaded_ts").collect())) == first
    assert [r.device_id for r in landing.curate(again["device"], "device").collect()] == ["D"]


def test_gzip_and_time_survive_landing(spark, tmp_path):
    table = sessions(spark, [("s1", "A", "D", None, at(0, 5))]).withColumn("channel", F.lit("web")).withColumn(
        "auth_method", F.lit(None).cast("string"))
    path = landing.write_jsonl(table, str(tmp_path), "session")
    raw = landing.land_raw_json(spark, path)
    assert raw.select("src_file").first()[0].endswith(".json.gz")
    row = landing.curate(raw, "session").first()
    assert (row.session_time, row.ip_id, row.auth_method) == (at(0, 5), None, None)


def test_a_large_table_lands_in_many_files(spark, tmp_path, monkeypatch):
    """One task reads a gzip file, so a large table must not land in as few files as its rows came in."""
    monkeypatch.setattr(landing, "LINES", 10)
    table = spark.range(25).coalesce(1).select(F.col("id").cast("string").alias("device_id"))
    path = landing.write_jsonl(table, str(tmp_path), "device")
    assert len(list(Path(path).glob("*.json.gz"))) == 3
    raw = landing.land_raw_json(spark, path)
    assert sorted(int(r.device_id) for r in landing.curate(raw, "device").collect()) == list(range(25))


def test_what_accounts_receive_is_not_sorted_to_find_what_they_pay_on(spark):
    rows = [("t1", "A", "B", at(0), "1000"), ("t2", "B", "C", at(0, 5), "950"), ("t3", "C", "D", at(5), "900")]
    table = spark.createDataFrame(rows, "transaction_id string, account_id string, counterparty_account_id string, txn_time timestamp_ntz, amount string")
    table = table.withColumns({"amount": F.col("amount").cast("decimal(18,2)"), "status": F.lit("completed")})
    found = mule.pass_through(table)
    assert [r.account_id for r in found.collect()] == ["B"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_documents_can_be_stored_whole(spark, tmp_path):
    """Tables that are only listed or counted need not pay for splitting their documents; the rows are the same."""
    table = spark.range(25).select(F.col("id").cast("string").alias("device_id"), F.lit(None).cast("string").alias("os"))
    paths = {"device": landing.write_jsonl(table, str(tmp_path), "device")}
    before = spark.conf.get("spark.sql.variant.writeShredding.enabled")
    whole = landing.load_raw(spark, str(tmp_path / "whole"), paths, shredded=False)["device"]
    assert spark.conf.get("spark.sql.variant.writeShredding.enabled") == before
    split = landing.load_raw(spark, str(tmp_path / "split"), paths)["device"]
    shown = [sorted(str(r) for r in t.select("src_file", F.to_json("payload")).collect()) for t in (whole, split)]
    assert shown[0] == shown[1] and len(shown[0]) == 25
    stored = [pq.read_schema(next(Path(t.inputFiles()[0].removeprefix("file:")).parent.glob("*.parquet"))) for t in (whole, split)]
    assert ["typed_value" in str(s.field("payload").type) for s in stored] == [False, True]


def test_landed_files_can_go_as_they_are_loaded(spark, tmp_path):
    """The disk need not hold all files and all RAW tables; a load with a bad line leaves the tables as they were."""
    def land(*ids):
        table = spark.createDataFrame([(i,) for i in ids], "device_id string")
        return {"device": landing.write_jsonl(table, str(tmp_path / "landed"), "device")}

    store = str(tmp_path / "raw")
    paths = land("a", "b", None)
    landing.load_raw(spark, store, paths)
    assert Path(paths["device"]).exists()
    raw = landing.load_raw(spark, store, paths, once=True)["device"]
    assert not Path(paths["device"]).exists()
    assert sorted(r.device_id or "" for r in landing.curate(raw, "device").collect()) == ["", "a", "b"]
    bad = tmp_path / "bad.jsonl"
    bad.write_text("{broken")
    with pytest.raises(Exception):
        landing.load_raw(spark, store, {**land("c"), "account": str(bad)}, once=True)
    assert landing.open_raw(spark, store, ["device"])["device"].count() == 3 and bad.exists()


def test_transactions_are_clustered_in_turns(spark, tmp_path, monkeypatch):
    """The disk must not hold the shuffle of the whole table; files are ranges of time, and all rows are there."""
    rows = [txn(f"t{k}", f"A{k % 3}", "B", time=at(k * 7 % 40)) for k in range(40)]
    rows += [rows[0], txn("none", "A", "B", time=None), txn("early", None, None, time=at(-20)), txn(None, "A", time=None)]
    table, left, drop = transactions(spark, rows), [], landing.drop_folder

    def dropping(spark, folder):
        left.append((Path(folder).name, sum(pq.read_metadata(f).num_rows for f in (tmp_path / "_transaction").glob("*.parquet"))))
        drop(spark, folder)
        assert not Path(folder.removeprefix("file:")).exists()

    monkeypatch.setattr(landing, "drop_folder", dropping)
    for again in (table.limit(3), table):  # the second table replaces the first
        left.clear()
        landing.write_curated(again, str(tmp_path), "transaction")
    assert [name for name, _ in left[:-1]] == [f"_turn={k}" for k in range(landing.TURNS)]
    assert left[0][1] < left[1][1] < left[2][1] < left[3][1] == len(rows)
    path = tmp_path / "transaction"
    written = spark.read.parquet(str(path))
    assert written.schema == table.schema
    assert sorted(map(str, written.collect())) == sorted(map(str, table.collect()))
    assert not (tmp_path / "_transaction").exists()
    times = [[r["txn_time"] for r in pq.read_table(f).to_pylist()] for f in path.glob("*.parquet")]
    ranges = sorted((min(t), max(t)) for t in ([x for x in t if x] for t in times) if t)
    assert len(ranges) > 3 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


@pytest.mark.parametrize("times", [[], [None, None, None], [START] * 30])
def test_clustering_copes_with_few_times(spark, tmp_path, times):
    table = transactions(spark, [txn(f"t{k}", "A", "B", time=t) for k, t in enumerate(times)])
    landing.write_curated(table, str(tmp_path), "transaction")
    written = spark.read.parquet(str(tmp_path / "transaction"))
    assert written.schema == table.schema and sorted(written.collect()) == sorted(table.collect())


def test_reset_leaves_only_the_curated_tables(spark, tmp_path, monkeypatch):
    """What both runs land and load must not stay on disk beside the curated tables."""
    tables = {
        "customer": [{"c_custkey": k, "c_name": f"c{k}", "c_nationkey": 0, "c_acctbal": 1.5, "c_mktsegment": "BUILDING"} for k in range(4)],
        "nation": [{"n_nationkey": 0, "n_name": "X", "n_regionkey": 0}],
        "events": [{"event_id": k, "ts": at(k), "user_id": k % 5, "event_type": "view", "value": 2.5} for k in range(20)],
        "orders": [{"o_orderkey": k, "o_custkey": k, "o_totalprice": 9.0, "o_orderdate": at(k), "o_orderpriority": "1"} for k in range(1, 9)],
        "lineitem": [
            {"l_orderkey": k, "l_partkey": k, "l_suppkey": 1, "l_linenumber": 1, "l_quantity": 7.0, "l_extendedprice": 3.0,
             "l_returnflag": "N", "l_linestatus": "F", "l_shipdate": at(k)} for k in range(1, 7)
        ],
    }
    for name, rows in tables.items():
        pq.write_table(pa.Table.from_pylist(rows), tmp_path / f"{name}.parquet")
    monkeypatch.setattr(staging, "shared_folder", lambda spark: str(tmp_path / "shared"))
    counts = {r.tbl: r.n for r in registry.reset_curated(spark, str(tmp_path)).collect()}
    assert (counts["CUSTOMER"], counts["SESSION"], counts["ACCOUNT"], counts["GROUND_TRUTH"]) == (4, 20, 5, 34)
    assert counts["TRANSACTION"] == 20 + 6 + 8 + 5  # transfers, deposits, withdrawals, one ring
    folder, = (tmp_path / "shared").iterdir()
    assert sorted(p.name for p in folder.iterdir()) == sorted(landing.FILES)


def test_steps_together_do_not_share_local_properties(spark):
    """Spark keeps the number of a running query there; a step that ends must not clear another one's."""
    context, both = spark.sparkContext, Barrier(2, timeout=60)

    def named(name):
        context.setLocalProperty("tidewatch.step", name)
        both.wait()
        assert context.getLocalProperty("tidewatch.step") == name

    together(lambda: named("a"), lambda: named("b"))


def test_tables_of_a_snapshot_are_written_at_the_same_time(spark, tmp_path):
    """A small table does not wait until a large one before it is written, and both are of one version."""
    both = Barrier(2, timeout=60)

    class Slow:
        def __init__(self, table):
            self.table = table

        @property
        def write(self):
            return self

        def mode(self, mode):
            self.how = mode
            return self

        def parquet(self, path):
            both.wait()
            self.table.write.mode(self.how).parquet(path)

    store = Snapshots(spark, str(tmp_path / "set"))
    store.write({"a": Slow(spark.range(3)), "b": Slow(spark.range(4))})
    assert {n: t.count() for n, t in store.read(["a", "b"]).items()} == {"a": 3, "b": 4}


def test_roles(spark):
    customer = spark.createDataFrame(
        [("1", "Ann", START.date(), "a@x", "04", "s", "doc")],
        "customer_id string, full_name string, date_of_birth date, email string, phone string, "
        "address string, kyc_payload string")
    assert governance.customer_secure(customer, "AML_ANALYST").first().full_name == "Ann"
    hidden = governance.customer_secure(customer, "AML_DATA_ENGINEER").first()
    assert (hidden.full_name, hidden.date_of_birth, hidden.kyc_payload) == ("****MASKED****", None, "doc")
    txns = transactions(spark, [txn("1", branch="B1"), txn("2", branch="B2"), txn("3")])
    allowed = spark.createDataFrame(
        [("AML_BRANCH_STAFF", "B1"), ("OTHER", "B2")], "role_name string, branch_code string")

    def seen(role):
        return sorted(r.transaction_id for r in governance.transaction_secure(txns, allowed, role).collect())

    assert seen("AML_DATA_ENGINEER") == ["1", "2", "3"]
    assert seen("AML_BRANCH_STAFF") == ["1"] and seen("NOBODY") == []


def test_null_rules_look_at_every_row(spark):
    rows = [
        txn("1", "A", "B", kind="cash_deposit", channel="branch", branch="B1"),
        txn("2", "A", "B", kind="cash_withdrawal", channel="atm"),
        txn("3", "A", "B", channel=None, branch="B1"), txn("4", "A", "B"),
    ]
    found = quality.null_rule_violations(transactions(spark, rows)).collect()
    assert sorted((r.transaction_id, r.rule) for r in found) == [
        ("1", "cash_deposit has a payer"), ("2", "cash channel without branch"),
        ("2", "cash_withdrawal has a receiver"), ("3", "digital channel with branch")]


def test_recall_counts_a_chain_only_by_one_detection(spark):
    labels_ = spark.createDataFrame(
        [("t1", "round_trip", "full", 0), ("t2", "round_trip", "full", 1),
         ("t3", "round_trip", "split", 0), ("t4", "round_trip", "split", 1),
         ("t5", "layering_chain", "lost", 0),
         ("m1", "mule_network", "mule", 0), ("m2", "mule_network", "mule", 0), ("m3", "mule_network", "mule", 1),
         ("d1", "structuring", "cash", 0), ("n1", "normal", None, None)],
        "transaction_id string, pattern_label string, chain_id string, hop_index int")
    txns = transactions(spark, [txn("m1", "X", "A1"), txn("m2", "X", "A2"), txn("m3", "A1", "X"),
                                deposit("d1", "S", "9000.00", START)])
    path = "path_key string, tier string, txn_ids array<string>"
    rings = spark.createDataFrame(
        [("a", "high", ["t1", "t2", "z"]), ("b", "medium", ["t3"]), ("c", "high", ["t4"]), ("fp", "medium", ["n1"])],
        path)
    chains = spark.createDataFrame([], path)
    mules = spark.createDataFrame([("d", "A1"), ("e", "A1"), ("f", "Q")], "device_id string, account_id string")
    flagged = spark.createDataFrame([("S",), ("T",)], "account_id string")
    rows = evaluate.benchmark(labels_, txns, rings, chains, mules, flagged).collect()
    got = {r.pattern_label: tuple(r)[1:] for r in rows}
    assert got["round_trip"] == (2, 1, 1, 0, "high", None)
    assert got["layering_chain"] == (1, 0, 0, 1, "", None)
    assert got["mule_network"] == (1, 0, 1, 0, "", None)
    assert got["structuring"] == (1, 1, 0, 0, "", None)
    assert got["round_trip (detector)"][-1] == 1 and got["layering (detector)"][-1] == 0
    assert got["mule (detector)"][-1] == 1 and got["structuring (detector)"][-1] == 1


def test_benchmark_joins_transactions_once(spark):
    """Recall and false positives ask the same of all transactions; labels and ids may be null or repeated."""
    labels_ = spark.createDataFrame(
        [("m1", "mule_network", "mule", 0), ("m1", "mule_network", "mule", 0), ("m2", "mule_network", "mule", 1),
         ("d1", "structuring", "cash", None), (None, "structuring", "cash", 0), ("d1", "mule_network", "mule", 0),
         ("n1", None, None, None)],
        "transaction_id string, pattern_label string, chain_id string, hop_index int")
    txns = transactions(spark, [txn("m1", "X", "A1"), txn("m2", "X", "A2"), deposit("d1", "S", "9000.00", START),
                                deposit("d1", "S", "9000.00", START)])
    paths = spark.createDataFrame([], "path_key string, tier string, txn_ids array<string>")
    mules = spark.createDataFrame([("d", "A1"), ("e", "S"), ("f", "Q")], "device_id string, account_id string")
    flagged = spark.createDataFrame([("S",), ("T",)], "account_id string")
    inputs = (labels_, txns, paths, paths, mules, flagged)
    found = evaluate.benchmark(*inputs)
    assert "counterparty_account_id" not in found._jdf.queryExecution().optimizedPlan().toString()
    apart = evaluate.pattern_recall(evaluate.chain_recall(*inputs)).unionByName(
        evaluate.false_positives(*inputs), allowMissingColumns=True)
    assert sorted(map(str, found.collect())) == sorted(map(str, apart.collect()))
    got = {r.pattern_label: tuple(r)[1:] for r in found.collect()}
    assert got["mule_network"] == (1, 1, 0, 0, "", None) and got["structuring"] == (1, 1, 0, 0, "", None)
    assert got["mule (detector)"][-1] == 1 and got["structuring (detector)"][-1] == 1


def test_alert_documents_leave_out_missing_fields(spark):
    path = ("path_key string, origin string, closed_on string, closed_by string, hops int, path array<string>, "
            "txn_ids array<string>, first_amount decimal(18,2), last_amount decimal(18,2), "
            "decay_pct decimal(5,1), shared_via array<string>, tier string")
    ring = spark.createDataFrame(
        [("t1,t2,t3", "A", "A", "same_account", 3, list("ABCA"), ["t1", "t2", "t3"], Decimal("100.00"),
          Decimal("90.00"), Decimal("10.0"), [], "high")], path)
    chain = ring.drop("closed_on", "closed_by", "shared_via")
    mules = spark.createDataFrame(
        [("D", 3, 3, "A1", "medium")],
        "device_id string, n_customers long, n_accounts long, first_account string, tier string")
    lists = spark.createDataFrame(
        [("D", 0, 2, ["A1", "A3"]), ("D", 1, 2, ["A2"])], "device_id string, part int, parts int, accounts array<string>")
    cash = spark.createDataFrame(
        [("S", 1, 2, Decimal("15000.00"), 1, START.date(), START.date(), "d1", "medium")],
        "account_id string, n_days long, n_deposits long, total_amount decimal(28,2), n_branches long, "
        "first_day date, last_day date, first_txn string, tier string")
    made = alerts.fraud_alert(ring, chain, mules, cash, F.lit(START))
    found = {r.alert_type: r for r in made.withColumn("doc", F.to_json("trigger_detail")).collect()}
    assert [found[k].alert_id for k in ("layering_chain", "mule_network", "round_trip", "structuring")] == [
        f"ALT-00000{i}" for i in range(1, 5)]
    assert found["round_trip"].fraud_score == 90 and found["layering_chain"].fraud_score == 60
    assert "closed_by" not in json.loads(found["layering_chain"].doc)
    assert found["mule_network"].transaction_id is None and found["structuring"].transaction_id == "d1"
    shown = {r.closed_by: r.path for r in alerts.v_dash_rings(made).collect()}
    assert shown == {"same_account": "A -> B -> C -> A", None: "A -> B -> C -> A"}
    shown = {r.part: r.accounts for r in alerts.v_dash_mule(made, lists).collect()}
    assert shown == {0: "A1, A3", 1: "A2"}
    assert json.loads(found["mule_network"].doc)["n_accounts"] == 3


def test_display_names(spark):
    df = spark.createDataFrame([("mule_network", "high,medium"), ("some_new_code", "")], "c string, t string")
    rows = df.select(labels.pattern_name(F.col("c")), labels.tier_list(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [("Mule network", "High, Medium"), ("Some new code", "—")]


def test_csv_copy_takes_any_text(spark, tmp_path):
    texts = [
        "1 Long\nStreet", "a\r\nb", 'says "hi", twice', "back\\slash", "\\n is no break", "\\\\n", "end\\", " blank ", "",
        None, '"', "a,b", "\t", "#x", "\\\n", "NULL", "\\e", "e", "é\u2028日",
    ]
    rows = [("address", t, f"address|{i}") for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, graph_tables.CSV_SCHEMAS["node_contact"])
    graph_tables.write_csv({"node_contact": table}, str(tmp_path))
    back = graph_tables.read_csv(spark, str(tmp_path), ("node_contact",))["node_contact"]
    assert sorted(map(str, back.collect())) == sorted(map(str, table.collect()))
    lines = sum(len(p.read_bytes().splitlines()) for p in (tmp_path / "node_contact").glob("*.csv"))
    assert lines - len(list((tmp_path / "node_contact").glob("*.csv"))) == len(rows), "each row is one line"


def test_references_read_transactions_once(spark, tmp_path):
    rows = [txn("t1", "A", "B"), txn("t2", "A", "X", session="S9"), txn("t3", None, "B")]
    transactions(spark, rows).write.parquet(str(tmp_path / "transaction"))
    transaction = spark.read.parquet(str(tmp_path / "transaction"))
    account = accounts(spark, [("A", "c1", None), ("B", None, None)])
    keyed = lambda name, *values: spark.createDataFrame([(v,) for v in values], f"{name} string")
    customer, device, ip = keyed("customer_id", "c1"), keyed("device_id", "d"), keyed("ip_id", "i")
    session = sessions(spark, [("S1", "A", "d", "i", None), ("S2", "Z", None, "i", None)])
    found = quality.fk_violations(customer, account, device, ip, session, transaction)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, [
        ("account -> customer", "B", None), ("session -> account", "S2", "Z"), ("session -> device", "S2", None),
        ("transaction -> counterparty", "t2", "X"), ("transaction -> session", "t2", "S9"),
    ]))
    counts = quality.orphan_check(customer, account, session, transaction)
    assert tuple(counts.first()) == (1, 1, 0, 1)
    for df in (found, counts):
        assert df._jdf.queryExecution().sparkPlan().toString().count("FileScan parquet") == 1


def test_csv_copy_keeps_types_and_drops_loose_edges(spark, tmp_path):
    tables = {
        "node_account": spark.createDataFrame(
            [("A", "c", "s", None, "x"), ("B", "c", "s", "b", "x"), ("B", "c", "s", "b", "x")],
            graph_tables.CSV_SCHEMAS["node_account"]),
        "node_ip": spark.createDataFrame(
            [("1", "a", "AU", True), ("2", "a", "AU", None)], "ip_id string, ip_address string, country string, is_vpn boolean"),
        "edge_sent_to": spark.createDataFrame(
            [("t1", "A", "B", Decimal("1.10"), "2026-03-01T09:00:00", "web", None, None),
             ("t2", "A", "Z", Decimal("1.10"), "2026-03-01T09:00:00", "web", None, None)],
            "transaction_id string, src_account_id string, dst_account_id string, amount decimal(18,2), "
            "txn_time string, channel string, device_id string, ip_id string"),
    }
    graph_tables.write_csv(tables, str(tmp_path))
    back = graph_tables.read_csv(spark, str(tmp_path), tuple(tables))
    (edge,) = graph_tables.attached_edges(back, "edge_sent_to").collect()
    assert (edge.transaction_id, edge.amount, edge.txn_time, edge.device_id) == ("t1", Decimal("1.10"), START, None)
    assert {r.ip_id: r.is_vpn for r in back["node_ip"].collect()} == {"1": True, "2": None}
    twice = back["node_account"].groupBy("account_id").count().filter("count > 1").collect()
    assert [r.account_id for r in twice] == ["B"]
