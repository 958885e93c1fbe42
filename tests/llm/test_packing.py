"""Packing: the search against the best packing of small cases, the encoder against the library, round trips."""

import random
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidewatch.llm import bin_completion as bins
from tidewatch.llm import byte_bpe, packing
from cases import odd_rows

MODEL = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(MODEL)


# --- the search -------------------------------------------------------------------------


def fewest(sizes, capacity):
    """By trying the first item with every subset of the others."""

    @lru_cache(None)
    def need(left):
        if not left:
            return 0
        first, rest = left[0], left[1:]
        best = len(left)
        for mask in range(1 << len(rest)):
            chosen = [x for i, x in enumerate(rest) if mask >> i & 1]
            if first + sum(chosen) <= capacity:
                best = min(best, 1 + need(tuple(x for i, x in enumerate(rest) if not mask >> i & 1)))
        return best

    return need(tuple(sorted(sizes, reverse=True)))


def holds_all(packing_, counts, capacity):
    used = Counter()
    for filling, n in packing_:
        assert 0 < sum(filling) <= capacity and n > 0
        for x in filling:
            used[x] += n
    return used == Counter({k: v for k, v in counts.items() if v})


def test_the_search_finds_the_fewest_bins():
    draw = random.Random(1)
    better = 0
    for _ in range(250):
        capacity = draw.choice([7, 10, 23, 50])
        sizes = [draw.randint(1, capacity) if draw.random() < 0.6 else draw.randint(1, capacity // 3 + 1) for _ in range(draw.randint(0, 9))]
        counts = Counter(sizes)
        found = bins.complete(counts, capacity, steps=100_000)
        assert holds_all(found, counts, capacity)
        assert bins.bins_of(found) == fewest(sizes, capacity) >= bins.least_bins(counts, capacity)
        fit = bins.best_fit(counts, capacity)
        assert holds_all(fit, counts, capacity)
        better += bins.bins_of(found) < bins.bins_of(fit)
    assert better > 0


def test_the_search_beats_best_fit_where_it_can():
    """Triples that fill a bin exactly, drawn so that best-fit decreasing misses them."""
    draw = random.Random(2)
    counts = Counter()
    for _ in range(40):
        a = draw.randint(380, 490)
        b = draw.randint(260, 1000 - a - 250)
        counts.update([a, b, 1000 - a - b])
    found = bins.complete(counts, 1000)
    assert holds_all(found, counts, 1000)
    assert 40 <= bins.bins_of(found) <= bins.bins_of(bins.best_fit(counts, 1000))


def test_work_does_not_follow_the_number_of_items():
    draw = random.Random(3)
    small = {x: draw.randint(1, 5) for x in draw.sample(range(1, 2048), 700)}
    large = {x: n * 10**9 for x, n in small.items()}
    found = bins.complete(large, 2048, steps=300)
    assert holds_all(found, large, 2048)
    assert bins.bins_of(found) <= bins.least_bins(large, 2048) * 1.01


def test_dominance():
    assert bins.dominates((5,), (3, 2)) and bins.dominates((5, 3), (4, 3)) and bins.dominates((6, 4), (3, 3, 4))
    assert not bins.dominates((3, 2), (5,)) and not bins.dominates((5, 5), (4, 4, 2))


def test_undominated_fillings():
    """All fillings around the largest size that no other dominates, and only those."""
    draw = random.Random(6)
    for _ in range(60):
        counts = Counter(draw.choices(range(1, 20), k=6))
        search = bins.Search(counts, 20)
        rest = sorted(counts.elements())
        largest = rest.pop()
        every = set()
        for mask in range(1 << len(rest)):
            chosen = tuple(sorted((x for i, x in enumerate(rest) if mask >> i & 1), reverse=True))
            if largest + sum(chosen) <= 20:
                every.add((largest, *chosen))
        want = {f for f in every if not any(g != f and bins.dominates(g, f) for g in every)}
        assert set(search.fillings()) == want


def test_sizes_must_fit():
    with pytest.raises(ValueError):
        bins.complete({11: 1}, 10)


# --- the encoder ------------------------------------------------------------------------

STRANGE = [
    "", " ", "  ", "\n", "a", " a", "a ", "  a  b", "a\n\nb", "a \n b", "\t\tx\r\n y", "don't, I'll.'s 'tis", "x.'s", "'s's",
    "a,b;c", "a ,b", "1,000.5kg", "é,à", "naïve—café…", "日本語。テスト", "한국어 글자", "a b", "a　b", "\x0b x", "\x1c\x1dy",
    "<|endoftext|>", "a<|endoftext|> b", "<|endoftext", "﻿x", "😀 😀😀", "ꟺ͸ ﷐", "\x00\x01 \x00", "a" * 3000, "¡hola!¿qué?",
    "line\n", "\nline", " \n", "x  ", "it's\n'quoted'", "ǅ ǆ", "²³ ¼", "a​b", " ", "A.B", "(a)", "--a--", "_a_", "a_b",
]


def test_encoder_equals_the_library(tokenizer):
    draw = random.Random(9)
    bits = STRANGE + ["the", " of", ",", ".", "\n", "'", "’", " ", "é", "日", "9", "\t", "Z", "\r"]
    texts = STRANGE + ["".join(draw.choice(bits) for _ in range(draw.randint(1, 30))) for _ in range(1500)] + [None]
    want = [x.ids for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    got = byte_bpe.Encoder(MODEL).documents(pa.array(texts, pa.string()))
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want


def test_encoder_may_forget(tokenizer, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KNOWN", 5)
    monkeypatch.setattr(byte_bpe, "CHUNK", 40)
    texts = [f"some words {i} and, more words {i * 7}" for i in range(40)]
    got = byte_bpe.Encoder(MODEL).documents(pa.array(texts))
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [tokenizer.encode(t).ids for t in texts]


# --- the operator -----------------------------------------------------------------------


def check_packing(rows, found, tokenizer, capacity, separator=0):
    """``found`` are rows of the packing of ``rows``, (doc_id, text): ids must be unique or null texts alike."""
    ids = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [separator] for d, t in rows}
    by_doc, by_sequence = {}, {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(ids)
    for d, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert len(pieces) == -(-len(ids[d]) // capacity) and all(r.length == capacity for r in pieces[1:])
        at = 0
        for r in pieces:
            own = np.array(ids[d][at : at + r.length], "<u4").tobytes()
            assert (r.start, r.ids_crc32) == (at, zlib.crc32(own))
            at += r.length
        assert at == len(ids[d])
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence), -(-sum(map(len, ids.values())) // capacity)


def test_round_trip(spark, docs_of, tokenizer):
    draw = random.Random(7)
    rows = [(i, " ".join(f"w{draw.randrange(500)}" for _ in range(draw.choice([0, 3, 9, 30, 200])))) for i in range(300)]
    rows += [(1000 + i, "the same text") for i in range(200)] + [(5000, None)]
    packed = packing.pack(docs_of(rows, "piece length number task ids"), MODEL, capacity=64, separator=7, keep_ids=True).cache()
    n, least = check_packing(rows, packed.collect(), tokenizer, 64, 7)
    rooms = []
    for size in sorted((r.length for r in packed.collect()), reverse=True):
        fit = min((i for i, room in enumerate(rooms) if room >= size), key=lambda i: rooms[i], default=None)
        if fit is None:
            rooms.append(64 - size)
        else:
            rooms[fit] -= size
    assert least <= n <= len(rooms)
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.sequences(packed).collect()}
    ids = {d: tokenizer.encode(t or "").ids + [7] for d, t in rows}
    for r in packed.collect():
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == ids[r.doc_id][r.start : r.start + r.length]
    packed.unpersist()


def test_sequences_are_few_at_production_size(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    n, least = check_packing(rows, packing.pack(docs, MODEL).collect(), tokenizer, 2048)
    assert n <= least + 2


def test_odd_rows(spark, docs_of, tokenizer):
    rows = odd_rows()
    found = packing.pack(docs_of(rows), MODEL, capacity=50).collect()
    lengths = sorted(len(tokenizer.encode(r[1] or "").ids) + 1 for r in rows)
    wholes = Counter()
    for r in found:
        wholes[r.doc_id] += r.length
    assert sum(wholes.values()) == sum(lengths)
    assert len([r for r in found if r.piece == 0]) == len(rows)
    places = [(r.sequence_id, r.offset) for r in found]
    assert len(set(places)) == len(places)


def test_empty_table(spark, docs_of):
    assert packing.pack(docs_of([]), MODEL).collect() == []
