"""Phrases against a count of every run, and the summary's guarantee."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tidewatch.llm import collocations
from cases import odd_rows


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_runs(rows, longest):
    """``rows`` are (text, language)."""
    counts, words = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        words[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text or "")):
            ws = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(ws)
            for k in range(1, longest + 1):
                counts.update((lang, *ws[i : i + k]) for i in range(len(ws) - k + 1))
    return counts, words


def brute(rows, longest=3, least=10, share=50, top=2000):
    counts, total = brute_runs(rows, longest)
    found = {}
    for (lang, *ws), a in counts.items():
        if len(ws) < 2 or a < least:
            continue
        cuts = []
        for k in range(1, len(ws)):
            l, r = counts[lang, *ws[:k]], counts[lang, *ws[k:]]
            cuts.append((1000000 * a * a // (l * r), k, l, r))
        found[lang, *ws] = (a, min(cuts))
    longer = Counter()
    for (lang, *us), (b, _) in found.items():
        for k in range(2, len(us)):
            for i in range(len(us) - k + 1):
                longer[lang, *us[i : i + k]] = max(longer[lang, *us[i : i + k]], b)
    out = []
    for (lang, *ws), (a, (score, _, l, r)) in found.items():
        if 100 * longer[lang, *ws] < share * a:
            out.append((lang, -score, -a, " ".join(ws).encode(), l, r))
    out.sort()
    ranked, seen = [], Counter()
    for lang, score, a, phrase, l, r in out:
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], phrase.decode(), -a, l, r, total[lang], -score))
    return ranked


def docs_with(spark, rows, parts=4):
    full = [(i, text, lang) for i, (text, lang) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id bigint, text string, lang string").repartition(parts)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def talk():
    draw = random.Random(5)
    vocabulary = ["the", "The", "of", "new", "york", "état", "Änd", "a%b", "c_d", "x'y", "\\q", "日本", "zz"]
    joins = [" ", "  ", "\t", " ", " ", ", ", ".", "\n", "; ", "\x0b", "\x1f", " "]
    rows = []
    for _ in range(400):
        n = draw.randint(0, 60)
        text = "".join(draw.choice(vocabulary) + draw.choice(joins) for _ in range(n))
        rows.append((text if n else None, draw.choice(["en", "en", "de", None, "und"])))
    rows += [("New York City, new york city", "en")] * 30
    return rows


@pytest.mark.parametrize("options", [{}, {"longest": 4, "least": 3, "share": 80, "top": 25}])
def test_equals_brute_force(spark, talk, options):
    found = got(collocations.collocations(docs_with(spark, talk), **options))
    assert found == sorted(brute(talk, **options)) and len(found) > 20


def test_every_frequent_run_is_counted_exactly(spark, talk):
    counts, words = brute_runs(talk, 3)
    found = {tuple(r) for r in collocations.frequent(docs_with(spark, talk), least=7).collect()}
    want = {(k[0], len(k) - 1, " ".join(k[1:]), n) for k, n in counts.items() if n >= 7}
    assert found == want | {(lang, 0, "", n) for lang, n in words.items()}


@pytest.mark.parametrize("least", [2, 10, 300])
def test_summary_loses_no_frequent_key(least):
    """Merged in any order and with far more keys than counters."""
    draw = np.random.default_rng(least)
    keys = np.concatenate((np.repeat(np.arange(40), least), draw.integers(1000, 40_000, 40 * least * 6))).astype(np.uint64)
    draw.shuffle(keys)
    parts = [np.unique(x, return_counts=True) for x in np.array_split(keys, 17)]
    halves = []
    for some in (parts[:9], parts[9:]):
        half = collocations.Summary(len(keys) // least + 1, least)
        for k, n in some:
            half.merge(k, n)
            assert len(half.keys) <= half.capacity
        halves.append(half)
    whole = halves[0]
    whole.lost += halves[1].lost
    whole.merge(halves[1].keys, halves[1].counts)
    exact, often = np.unique(keys, return_counts=True)
    assert set(exact[often >= least].tolist()) <= set(whole.survivors().tolist())
    assert whole.lost * (whole.capacity + 1) <= len(keys)


def test_capacity_binds_and_answers_are_whole(spark, monkeypatch):
    """Nearly all runs occur once, so that counters are taken off; the frequent ones are still exact."""
    draw = random.Random(8)
    rows = [(" ".join(f"w{draw.randrange(10**6)}" for _ in range(300)) + ". rare pair here", "en") for _ in range(12)]
    taken = []
    merge = collocations.Summary.merge

    def watched(self, keys, counts):
        merge(self, keys, counts)
        taken.append(self.lost)

    monkeypatch.setattr(collocations.Summary, "merge", watched)
    counts = np.unique(np.random.default_rng(1).integers(0, 10**9, 5000).astype(np.uint64), return_counts=True)
    summary = collocations.Summary(5000 // 10 + 1, 10)
    summary.merge(*counts)
    assert taken[-1] > 0 and len(summary.keys) <= summary.capacity
    monkeypatch.undo()
    found = got(collocations.collocations(docs_with(spark, rows)))
    assert found == sorted(brute(rows)) and [r[2] for r in found] == ["rare pair here"]


def test_large_counts_are_exact(spark):
    """The products of counts of 10^13 pass 64 bits."""
    a, l, r = 9_999_999_999_989, 10_000_000_000_037, 9_999_999_999_991
    score = spark.sql(
        f"select cast({a}l as decimal(15,0)) * cast({a}l as decimal(15,0)) * 1000000"
        f" div (cast({l}l as decimal(15,0)) * cast({r}l as decimal(15,0))) as s"
    ).head()[0]
    assert score == 1000000 * a * a // (l * r)


def test_odd_rows(spark, docs_of):
    rows = odd_rows()
    found = got(collocations.collocations(docs_of(rows, "rank phrase words part"), least=2))
    assert found == sorted(brute([(r[1], "en") for r in rows], least=2))


def test_empty_table(spark, docs_of):
    assert collocations.collocations(docs_of([])).collect() == []
