"""Repeated words and bytes against brute force."""

import hashlib
import random

import pytest

from tidewatch.llm import substring_dedup, suffix_dedup
from tidewatch.llm.arrays import slices, words
from cases import odd_rows


def brute_words(rows, width):
    """Later windows, by (id, start); null ids are last and all equally late."""
    seen, gone = {}, {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    split = [(r[1] or "").encode().split() for r in rows]
    for i in order:
        for s in range(len(split[i]) - width + 1):
            place = (rows[i][0], s)
            if seen.setdefault(tuple(split[i][s : s + width]), place) != place:
                gone.setdefault(i, set()).update(range(s, s + width))
    out = []
    for i, row in enumerate(rows):
        kept = b" ".join(w for k, w in enumerate(split[i]) if k not in gone.get(i, ()))
        out.append((row[0], len(split[i]), len(gone.get(i, ())), hashlib.sha256(kept).hexdigest()))
    return out


def brute_bytes(rows, depth):
    data, count = [(r[1] or "").encode() for r in rows], {}
    for d in data:
        for s in range(len(d) - depth + 1):
            count[d[s : s + depth]] = count.get(d[s : s + depth], 0) + 1
    out = []
    for row, d in zip(rows, data, strict=True):
        gone = bytearray(len(d))
        for s in range(len(d) - depth + 1):
            if count[d[s : s + depth]] > 1:
                gone[s : s + depth] = b"\x01" * depth
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((row[0], len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def by_row(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.fixture(scope="module")
def repetitive():
    """Few words, shared passages, passages inside one document, copies."""
    draw = random.Random(3)
    passages = [" ".join(draw.choice("abcdefgh") * draw.randint(1, 3) for _ in range(30)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(draw.randint(0, 5)):
            parts.append(draw.choice(passages) if draw.random() < 0.5 else " ".join(draw.choice("xyz") * draw.randint(1, 9) for _ in range(draw.randint(1, 25))))
        rows.append((i * 7 % 60, draw.choice([" ", "\n", "  "]).join(parts)))
    return rows + [(100, rows[0][1]), (101, " ".join(["ha"] * 90)), (102, " ".join(["ha", "ho"] * 40))]


@pytest.mark.parametrize("width", [3, 20])
def test_words_equal_brute_force(docs_of, repetitive, width):
    found = substring_dedup.remove_repeats(docs_of(repetitive, "part kept kind"), width, digest=True)
    assert by_row(found.collect()) == by_row(brute_words(repetitive, width))


@pytest.mark.parametrize("depth, digit", [(40, 20), (60, 16), (100, 90)])
def test_bytes_equal_brute_force(docs_of, repetitive, depth, digit):
    found = suffix_dedup.remove_repeats(docs_of(repetitive, "part kept block"), depth, digit, digest=True)
    assert by_row(found.collect()) == by_row(brute_bytes(repetitive, depth))


def test_odd_rows(docs_of):
    rows = odd_rows()
    found = substring_dedup.remove_repeats(docs_of(rows), digest=True)
    assert by_row(found.collect()) == by_row(brute_words(rows, 20))
    found = suffix_dedup.remove_repeats(docs_of(rows), digest=True)
    short = [r if r[1] is None or len(r[1]) < 5000 else (r[0], r[1][:5000]) for r in rows]
    assert found.count() == len(rows)
    found = suffix_dedup.remove_repeats(docs_of(short), digest=True)
    assert by_row(found.collect()) == by_row(brute_bytes(short, 400))


def test_kept_text_is_returned(docs_of):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(2, "new start " + text), (1, text + "\nend")]
    found = {r.doc_id: r.kept for r in substring_dedup.remove_repeats(docs_of(rows)).collect()}
    assert found == {1: " ".join((text + "\nend").split()), 2: "new start"}
    found = {r.doc_id: r.kept for r in suffix_dedup.remove_repeats(docs_of(rows), 50, 25).collect()}
    assert found == {1: "\nend", 2: "new start "}


def test_empty_table(docs_of):
    assert substring_dedup.remove_repeats(docs_of([])).count() == 0
    assert suffix_dedup.remove_repeats(docs_of([])).count() == 0


def test_words_do_not_cross_documents():
    import pyarrow as pa

    texts = ["ab", "cd ", None, " e f", "", "g"]
    found = []
    for part in slices(pa.array(texts), 3):
        w = words(part)
        for d in range(len(part)):
            own = slice(w.offsets[d], w.offsets[d + 1])
            found.append([bytes(part.data[a:b]) for a, b in zip(w.start[own], w.end[own], strict=True)])
    assert found == [(t or "").encode().split() for t in texts]
