"""Removal of repeated word windows, with a count-min sketch before the exact count.

First pass: every part counts its windows of ``width`` words in a count-min sketch of ``ROWS`` rows
that is sparse (the cells that it touched, as gaps) and sends each block of cells to its owner.
The owner merges the partial sketches and tells each part which of its cells hold two or more.
A window can only be repeated if all its cells do: the sketch overestimates, never less.

Second pass: only windows estimated repeated are grouped, by 128 bits of their word sequence.
The owner of a window keeps the occurrence with the smallest document and start; each word that
a later occurrence covers goes. The sketch is as wide as the data need (``CELLS`` cells for each
window), and no part of it is ever in one place.

Rows: null text has no words; a null ``doc_id`` comes after all ids; rows that repeat both id and
text are each as early as the other and get the same result. Texts with fewer words than a
window lose nothing. Memory follows the longest text of a part.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewatch.llm.arrays import Rolling, covered, mix, slices, wide, windows, word_hashes, words
from tidewatch.llm.parts import (
    LEAST_BLOCKS, SENT, answered, ask, bits_for, blocks_for, column, deal, distinct, each_part, ids, pack, part_of, text_bytes, unpack,
)

ROWS = 2
#: To 5, as the number of cells is a power of two.
CELLS = 2.5
_U = np.uint64
#: Bytes of text that hold a word, about; only sets the width of the sketch.
_WORD = 6

RESULT = "doc_id bigint, text string, n_words bigint, n_removed bigint, kept string"


def _window_hashes(docs: pa.Table, width: int) -> np.ndarray:
    out = [np.zeros(0, _U)]
    for part in slices(column(docs, "text")):
        found = words(part)
        start, _ = windows(found.offsets, width)
        out.append(Rolling(word_hashes(part, found)).of(start, start + width))
    return np.concatenate(out)


def _cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    cells = mix(hashes + _U(row)) >> _U(64 - bits)
    return cells.astype(np.uint32) if bits <= 32 else cells


def _own_cells(hashes: np.ndarray, row: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The cells of a row that a part touches, ascending, and which it touches twice or more."""
    cells = _cells(hashes, row, bits)
    cells.sort()
    new = np.ones(len(cells), bool)
    new[1:] = cells[1:] != cells[:-1]
    first = np.flatnonzero(new)
    return cells[first], np.diff(np.append(first, len(cells))) > 1


def _gaps(places: np.ndarray) -> bytes:
    """Ascending places of a block as gaps of 1, 2 or 4 bytes, whichever suits their mean. The
    largest value of the word adds to the gap that follows it."""
    width = 1 if places[-1] < 350 * len(places) else 2 if places[-1] < 90_000 * len(places) else 4
    most = (1 << 8 * width) - 1
    gaps = np.diff(places.astype(np.int64), prepend=0)
    out = np.full(int((gaps // most).sum()) + len(gaps), most, f"u{width}")
    out[np.cumsum(gaps // most + 1) - 1] = gaps % most
    return bytes([width]) + out.tobytes()


def _places(coded: bytes) -> np.ndarray:
    steps = np.frombuffer(coded, f"u{coded[0]}", offset=1)
    return np.cumsum(steps, dtype=np.int64)[steps < (1 << 8 * coded[0]) - 1]


def _sketch_blocks(bits: int) -> int:
    return max(LEAST_BLOCKS, 1 << max(0, bits - 22))


def _send_sketch(docs: pa.Table, width: int, bits: int) -> pa.Table:
    hashes, part, blocks = _window_hashes(docs, width), part_of(docs), _sketch_blocks(bits)
    size, rows = (1 << bits) // blocks, []
    for row in range(ROWS):
        cells, twice = _own_cells(hashes, row, bits)
        edge = np.searchsorted(cells, (np.arange(blocks) * size).astype(cells.dtype))
        edge = np.append(edge, len(cells))
        for b in np.flatnonzero(edge[1:] > edge[:-1]):
            own = slice(edge[b], edge[b + 1])
            coded = _gaps(cells[own] - cells.dtype.type(b * size))
            rows.append((row * blocks + int(b), len(coded).to_bytes(8, "little") + coded + np.packbits(twice[own]).tobytes()))
    return pa.table(
        {
            "part": pa.array([part] * len(rows), pa.int32()),
            "block": pa.array([x[0] for x in rows], pa.int32()),
            "sent": pa.array([x[1] for x in rows], pa.binary()),
        }
    )


def _merge_sketch(got: pa.Table, bits: int) -> pa.Table:
    counts = np.zeros((1 << bits) // _sketch_blocks(bits), np.int32)
    own = []
    for sent in got["sent"].to_pylist():
        n = int.from_bytes(sent[:8], "little")
        places = _places(sent[8 : 8 + n])
        twice = np.unpackbits(np.frombuffer(sent[8 + n :], np.uint8), count=len(places))
        counts[places] += 1 + twice
        own.append(places)
    return answered(got, "cell", [counts[x] >= 2 for x in own])


class _Suspects:
    """The windows of a part that the sketch says may be repeated, in the order of the texts."""

    def __init__(self, docs: pa.Table, answers: pa.Table, width: int, bits: int, blocks: int):
        hashes = _window_hashes(docs, width)
        per_row, size = _sketch_blocks(bits), (1 << bits) // _sketch_blocks(bits)
        suspect = np.ones(len(hashes), bool)
        for row in range(ROWS):
            cells = _cells(hashes, row, bits)
            order, new = distinct(cells)
            cells = cells[order[new]]
            full = bits_for(answers, "cell", row * per_row + (cells // cells.dtype.type(size)).astype(np.int32))
            suspect[order] &= full[np.cumsum(new) - 1]
            del cells, order, new
        del hashes
        self.mine = []
        keys: list[list[np.ndarray]] = []
        at, doc_ids = 0, ids(docs)
        for part in slices(column(docs, "text")):
            found = words(part)
            start, _ = windows(found.offsets, width)
            at, mine = at + len(start), suspect[at : at + len(start)]
            start = start[mine]
            self.mine.append(start)
            one, two = wide(word_hashes(part, found), start, start + width)
            of = np.searchsorted(found.offsets, start, "right") - 1
            keys.append([one, two, doc_ids[part.first + of], start - found.offsets[of]])
        none = np.zeros(0, _U)
        one, two, doc, start = (np.concatenate(x) for x in zip([none, none, none.view(np.int64), none.view(np.int64)], *keys, strict=True))
        self.order, self.new = distinct(one, two, most=(doc, start))
        first = self.order[self.new]
        self.one, self.two, self.doc, self.start = one[first], two[first], doc[first], start[first]
        self.block = (self.one >> _U(64 - int(np.log2(blocks)))).astype(np.int64)
        # the part's own later occurrences, unless they are the same row of the table twice
        group = np.cumsum(self.new) - 1
        self.group = group
        self.later = (doc[self.order] != self.doc[group]) | (start[self.order] != self.start[group])


def _send_suspects(docs: pa.Table, answers: pa.Table, width: int, bits: int, blocks: int) -> pa.Table:
    s = _Suspects(docs, answers, width, bits, blocks)
    return pack(part_of(docs), s.block, blocks, s.one, s.two, s.doc, s.start)


def _judge_first(got: pa.Table) -> pa.Table:
    sent = [unpack(x, _U, _U, np.int64, np.int64) for x in got["sent"].to_pylist()]
    one, two, doc, start = (np.concatenate(x) for x in zip(*sent, strict=True))
    order, new = distinct(one, two, most=(doc, start))
    first = order[new][np.cumsum(new) - 1]
    later = np.empty(len(order), bool)
    later[order] = (doc[order] != doc[first]) | (start[order] != start[first])
    return answered(got, "later", np.split(later, np.cumsum([len(x[0]) for x in sent])[:-1]))


def _remove(docs: pa.Table, answers: pa.Table, width: int, bits: int, blocks: int) -> pa.Table:
    s = _Suspects(docs, answers, width, bits, blocks)
    removed = np.empty(len(s.order), bool)
    removed[s.order] = s.later | bits_for(answers, "later", s.block)[s.group]
    n_words, n_removed, kept, at = [], [], [], 0
    for part, start in zip(slices(column(docs, "text")), s.mine, strict=True):
        found = words(part)
        at, hit = at + len(start), removed[at : at + len(start)]
        gone = covered(start[hit], width, len(found.start))
        data = part.data.tobytes()
        for d in range(len(part)):
            stay = ~gone[found.offsets[d] : found.offsets[d + 1]]
            own = data[part.offsets[d] : part.offsets[d + 1]].split()
            n_words.append(len(own))
            n_removed.append(int(len(stay) - stay.sum()))
            kept.append(b" ".join(compress(own, stay.tolist()) if n_removed[-1] else own))
    return pa.table(
        {
            "doc_id": column(docs, "doc_id"),
            "text": column(docs, "text"),
            "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "kept": pa.array(kept, pa.binary()).cast(pa.string()),
        }
    )


def _digest(cleaned: pa.Table) -> pa.Table:
    sums = [hashlib.sha256(x).hexdigest() for x in column(cleaned, "kept").cast(pa.binary()).to_pylist()]
    return cleaned.drop_columns(["text", "kept"]).append_column("kept_sha256", pa.array(sums, pa.string()))


def remove_repeats(docs: DataFrame, width: int = 20, digest: bool = False) -> DataFrame:
    """``doc_id, text, n_words, n_removed, kept``: the words that are left, joined by one space.

    With ``digest`` the texts are left out and ``kept_sha256`` takes the place of ``kept``.
    """
    dealt = deal(docs)
    n = max(1, text_bytes(dealt) // _WORD)
    bits = max(20, int(np.ceil(np.log2(CELLS * n))))
    blocks = blocks_for(n)
    sketch = each_part(dealt, lambda d, _: _send_sketch(d, width, bits), SENT)
    cells = ask(sketch, lambda got: _merge_sketch(got, bits), "cells")
    sent = each_part(dealt, lambda d, a: _send_suspects(d, a, width, bits, blocks), SENT, cells)
    later = ask(sent, _judge_first, "later")
    if digest:
        schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
        work = lambda d, a: _digest(_remove(d, a, width, bits, blocks))
    else:
        schema, work = RESULT, lambda d, a: _remove(d, a, width, bits, blocks)
    return each_part(dealt, work, schema, cells.unionByName(later))
