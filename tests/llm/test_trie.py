"""The conversation trie against a trie of Python dictionaries."""

import hashlib
import random
import re
import zlib

import pytest

from tidewatch.llm import conversation_trie as ct

CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


def brute_paths(rows):
    """Turns of each conversation; rows of one turn in the order of their hash."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0), key, (role, text)))
    return {c: [x[2] for x in sorted(ts)] for c, ts in own.items()}


def brute_graft(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        head = own.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])
        out[c] = head[:h] + turns[h:]
    return out


def brute_trie(of):
    members = {}
    for c, turns in of.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def words(node):
        return len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0

    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children.get(node, [])
        leaves[node] = sum(leaves[k] for k in kids) or 1
        saved[node] = (len(members[node]) - 1) * words(node) + sum(saved[k] for k in kids)
    rows = []
    for node, ids in members.items():
        ends = ",".join(map(str, sorted(c for c in ids if len(of[c]) == len(node))))
        rows.append((
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children.get(node, [])),
            leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return ordered(rows)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


@pytest.fixture(scope="module")
def chatter():
    """Common first turns, copies, conversations that begin as others, gaps in the ids."""
    draw = random.Random(4)
    say = [("user", f"hello  there {i}") for i in range(3)] + [("assistant", "yes"), ("system", ""), (None, None)]
    rows = []
    for c in range(-30, 700):
        if c % 7 == 3:
            continue
        n = draw.choice([1, 1, 2, 3, 4, 6])
        turns = [draw.choice(say) for _ in range(n)]
        if c % 3 == 0:
            turns = [("user", "the same"), ("assistant", "old story")]
        rows += [(c, t if t else None, *x) for t, x in enumerate(turns)]
    draw.shuffle(rows)
    return rows


def made(spark, rows, extra=""):
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(5)
    for name in extra.split():
        df = df.withColumn(name, df["conv_id"])
    return df


@pytest.fixture
def small_shards(spark, monkeypatch):
    """Several shards with few rows each, and pieces of ids of a few each."""
    monkeypatch.setattr(ct, "SHARD_TURNS", 120)
    monkeypatch.setattr(ct, "PIECE", 8 * 5)


def test_plain_and_grafted(spark, chatter, small_shards):
    own = ct.paths(made(spark, chatter, "path words node shard below"))
    assert ordered(ct.trie(own).collect()) == brute_trie(brute_paths(chatter))
    found = ordered(ct.trie(ct.grafted(own)).collect())
    assert found == brute_trie(brute_graft(brute_paths(chatter)))


def test_splitters_do_not_change_the_trie(spark, chatter, monkeypatch):
    """No splitter, very short splitters, and a skeleton that must be thinned."""
    rows = ct.paths(made(spark, chatter))
    want = brute_trie(brute_paths(chatter))
    monkeypatch.setattr(ct, "SHARD_TURNS", 50)
    for name, value in (("SPLITTER_TURNS", 1), ("SKELETON_BYTES", 200), ("SKELETON_BYTES", 0), ("SAMPLE", 40)):
        with monkeypatch.context() as m:
            m.setattr(ct, name, value)
            assert ordered(ct.trie(rows).collect()) == want


def test_skeleton_is_the_prefixes_of_the_splitters():
    a, b = b"a" * 16, b"b" * 16
    skeleton = ct.Skeleton([(a, 5), (a + b, 2)])
    assert skeleton.nodes() == {b"", a, a + b}
    assert [skeleton.shard(*x) for x in ((a, 4), (a, 5), (a + a, 9), (a + b, 2), (b, 0))] == [0, 1, 1, 2, 2]


def test_a_conversation_that_most_have_is_cut(spark, small_shards):
    rows = [(c, t, "user", f"turn {t}") for c in range(600) for t in range(2)] + [(1000, 0, "user", "other")]
    paths = ct.paths(made(spark, rows)).cache()
    skeleton = ct.skeleton_of(paths)
    sizes = [r["count"] for r in ct._dealt(paths, skeleton).groupBy("shard").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 200
    assert ordered(ct.trie(paths).collect()) == brute_trie(brute_paths(rows))
    paths.unpersist()


def test_odd_rows(spark):
    """Null ids, turns, roles and texts, repeated rows, equal turns, a very long text, a long conversation."""
    long = "word " * 200_000
    rows = [
        (None, 0, "user", "lost"), (1, None, None, None), (1, None, "a", "b"), (1, 3, "a", "b"), (1, 3, "a", "b"),
        (2, 0, "user", long), (3, 0, "user", long), (4, 0, "use", "r" + long), (5, 0, "", "\x00\x01 \x0b x"),
        (20, None, "", ""), (21, 5, None, ""),
    ] + [(40 + i, t, "user", str(t % 7)) for i in range(2) for t in range(900)]
    assert ordered(ct.conversation_trie(made(spark, rows)).collect()) == brute_trie(brute_paths(rows))
    own = ct.paths(made(spark, rows))
    assert ordered(ct.trie(ct.grafted(own)).collect()) == brute_trie(brute_graft(brute_paths(rows)))


def test_a_conversation_may_lose_all_turns(spark):
    """Its head has no turns to give, or is missing: it ends at the root."""
    lost = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(lost, 0, "user", "a"), (lost, 1, "user", "b")]
    own = ct.paths(made(spark, rows))
    found = [tuple(r) for r in ct.trie(ct.grafted(own)).collect()]
    assert found == [(lost, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lost).encode()).hexdigest())]


def test_empty_table(spark):
    assert ct.conversation_trie(made(spark, [])).collect() == []
