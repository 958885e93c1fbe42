"""Near-duplicate documents and vectors, and components, against all pairs."""

import itertools
import random

import numpy as np
import pytest

from tidewatch.llm import embedding_dedup, minhash_dedup
from tidewatch.llm.components import components, forest
from cases import odd_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def shingle_set(text, k):
    w = [x.decode() for x in (text or "").translate(LOWER).encode().split()]
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def brute(rows, k, percent):
    sets = [shingle_set(r[1], k) for r in rows]
    links = [
        (rows[i][0], rows[j][0])
        for i, j in itertools.combinations(range(len(rows)), 2)
        if rows[i][0] is not None and rows[j][0] is not None and sets[i] and sets[j]
        and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    root = roots({r[0] for r in rows if r[0] is not None}, links)
    return sorted(
        ((r[0], len(s), root.get(r[0]), r[0] is None or root[r[0]] == r[0]) for r, s in zip(rows, sets, strict=True)),
        key=str,
    )


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_documents_equal_all_pairs(docs_of, k, percent):
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdeABCDE") for _ in range(4))
    rows, base = [], None
    for i in range(150):
        if i % 5 == 0 or base is None:
            base = [word() for _ in range(draw.choice([1, 2, 8, 60, 300]))]
        text = list(base)
        for _ in range(draw.randint(0, max(1, len(text) // 60))):
            text[draw.randrange(len(text))] = word()
        rows.append((i * 13 % 150, draw.choice([" ", "\n\t "]).join(text).translate(LOWER if i % 3 else {})))
    rows += [(200, rows[0][1]), (201, rows[0][1].upper())]
    found = minhash_dedup.near_duplicates(docs_of(rows, "rep component votes"), k, percent).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows, k, percent)


def test_a_large_group_of_near_copies_is_one(docs_of):
    draw = random.Random(7)
    base = [f"w{draw.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(400):
        text = list(base)
        text[draw.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(text)))
    found = minhash_dedup.near_duplicates(docs_of(rows)).collect()
    assert {r.component_id for r in found} == {0} and sum(r.kept for r in found) == 1


@pytest.mark.parametrize("common", [165, 173])
def test_pairs_among_documents_that_share_a_template(docs_of, common):
    # 200 shingles, of which all documents share 165 (70 %) or 173 (76 %), and pairs 180 (82 %)
    draw = random.Random(13)
    word = lambda: f"w{draw.randrange(10**9)}"
    template, rows = [word() for _ in range(common + 4)], []
    for i in range(1600):
        text = template + [word() for _ in range(200 - common)]
        rows.append((i, " ".join(text)))
        if i < 400:
            rows.append((10_000 + i, " ".join(text[:-20] + [word() for _ in range(20)])))
    found = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(docs_of(rows)).collect()}
    assert found == {i: i % 10_000 for i, _ in rows}


def two_words_changed(n, seed=21):
    """Texts of 60 words, each with two of a template's words changed."""
    draw = random.Random(seed)
    template, rows = [f"w{draw.randrange(10**9)}" for _ in range(60)], []
    for i in range(n):
        text = list(template)
        for place in draw.sample(range(60), 2):
            text[place] = f"x{draw.randrange(10**9)}"
        rows.append((i, " ".join(text)))
    return rows


def test_copies_below_the_threshold_do_not_meet(docs_of, spark):
    """They share nearly all shingles, but the pairs that could link are few, and all are found."""
    met = {}
    for n in (500, 1000):
        rows = two_words_changed(n)
        texts = docs_of(rows).selectExpr("doc_id as id", "text", "doc_id as component")
        pairs = {tuple(r) for r in minhash_dedup.crowded_pairs(texts, 3, 85, 1).collect()}
        sets = [shingle_set(t, 3) for _, t in rows]
        links = {
            (a, b) for a, b in itertools.combinations(range(n), 2) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
        }
        assert links <= pairs and links
        met[n] = len(pairs)
    assert met[1000] < 4000, "a tenth of the pairs that share a prefix"


def test_odd_documents(docs_of):
    rows = odd_rows()
    found = minhash_dedup.near_duplicates(docs_of(rows), 3, 85).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows, 3, 85)
    assert minhash_dedup.near_duplicates(docs_of([])).count() == 0


def test_components_equal_union_find(spark):
    draw = random.Random(11)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)]
    links += [(i, i + 1) for i in range(1000, 1200)] + [(5000, i) for i in range(5001, 5300)] + [(9, 9)]
    draw.shuffle(links)
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert found == roots(nodes, links) | {}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest():
    a, b = forest(np.array([5, 3, 8, 7]), np.array([3, 1, 9, 7]))
    assert dict(zip(a.tolist(), b.tolist(), strict=True)) == {3: 1, 5: 1, 9: 8}


VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute_vectors(rows, cosine=0.98):
    def usable(r):
        return r[0] is not None and r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])

    n, links = [0] * len(rows), []
    for i, j in itertools.combinations(range(len(rows)), 2):
        p, q = rows[i], rows[j]
        if usable(p) and usable(q) and p[2] == q[2] and len(p[1]) == len(q[1]):
            x, y = (np.array(v, np.float32).astype(float) for v in (p[1], q[1]))
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                n[i] += 1
                n[j] += 1
                links.append((p[0], q[0]))
    root = roots({r[0] for r in rows if r[0] is not None}, links)
    return sorted(((r[0], k, root.get(r[0]), r[0] is None or root[r[0]] == r[0]) for r, k in zip(rows, n, strict=True)), key=str)


def test_vectors_equal_all_pairs(spark):
    draw = np.random.default_rng(2)
    rows, id = [], 0
    for label in (0, 1, None):
        for _ in range(12):
            centre = draw.normal(size=64)
            for _ in range(draw.integers(1, 9)):
                id += 7
                noise = draw.normal(size=64) * draw.choice([0, 0.1, 0.14, 0.2])
                rows.append((id % 1009, [float(x) for x in centre + noise], label))
    rows += [(2000, rows[0][1], 0), (2001, [2 * x for x in rows[0][1]], 0), (2002, None, 0), (2003, [0.0] * 64, 0),
             (2004, [float("nan")] * 64, 0), (2005, [None] * 64, 0), (2006, [float("inf")] + [1.0] * 63, 0),
             (None, rows[0][1], 0), (2007, [], 0), (2008, [1.0, 0.0], 1), (2009, [1.0, 0.01], 1), (2010, [3.0], 1), (2011, [5.0], 1)]
    made = spark.createDataFrame(rows, VECTORS).repartition(3).withColumn("filter", __import__("pyspark").sql.functions.lit(1))
    found = embedding_dedup.near_duplicates(made).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute_vectors(rows)


def test_large_buckets_are_cut(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "ROWS", 8)
    draw = np.random.default_rng(4)
    centre = draw.normal(size=64)
    rows = [(i, [float(x) for x in centre + 0.05 * draw.normal(size=64)], 1) for i in range(60)]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute_vectors(rows)
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_recall_at_the_threshold():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    off = draw.normal(size=x.shape)
    off -= (off * x).sum(axis=1)[:, None] * x
    off /= np.linalg.norm(off, axis=1)[:, None]
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * off
    sets = []
    for v in (x, y):
        row, name = embedding_dedup.decode(v)
        sets.append([set(name[row == i].tolist()) for i in range(len(v))])
    assert np.mean([bool(p & q) for p, q in zip(*sets, strict=True)]) >= 0.99


@pytest.mark.parametrize("spread", ["k^-0.5", "k^-1", "half empty"])
def test_recall_of_uneven_coordinates(spread):
    draw = np.random.default_rng(6)
    k = np.arange(1, 65)
    scale = {"k^-0.5": k**-0.5, "k^-1": 1 / k, "half empty": np.where(k <= 32, 1, 1e-6)}[spread]
    x, off = draw.normal(size=(2, 2000, 64)) * scale
    x /= np.linalg.norm(x, axis=1)[:, None]
    off -= (off * x).sum(axis=1)[:, None] * x
    off /= np.linalg.norm(off, axis=1)[:, None]
    sets = []
    for v in (x, 0.98 * x + np.sqrt(1 - 0.98**2) * off):
        row, name = embedding_dedup.decode(v)
        sets.append([set(name[a:b].tolist()) for a, b in zip(*[np.searchsorted(row, np.arange(2000) + i) for i in (0, 1)], strict=True)])
    assert np.mean([bool(p & q) for p, q in zip(*sets, strict=True)]) >= 0.998
