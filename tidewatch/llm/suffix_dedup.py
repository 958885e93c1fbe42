"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes are ordered only through their first ``depth`` bytes, most significant digit first, and a
suffix leaves the sort as soon as its bucket holds no other. Equal groups that are left after the
last digit are exactly the repeated strings. The digits:

1. the ``digit`` bytes at the suffix's anchor, which is the place within its first
   ``depth - digit + 1`` bytes whose 16 bytes hash lowest (the leftmost of equals). It follows from
   the suffix's own bytes, so equal suffixes share it, and neighbouring suffixes share one too:
   one record stands for about a hundred suffixes;
2. the whole stretch of neighbouring suffixes that share an anchor. Stretches that occur twice are
   repeated from end to end; of equal stretches one goes on as a stand-in;
3. the ``depth`` bytes of each suffix in buckets that still hold different stretches.

Digits are compared by 96 to 128 bits of hash within the bucket. Each pass drops repetitions in
its part first and sends records to the block that owns their range (``parts.py``), so a string
that is everywhere costs one record for each part.

Rows: null text is empty; each row is a document of its own, also if an id is null or repeated;
texts shorter than ``depth`` lose nothing. Bytes that are left of a character cut in two are
replaced in ``kept`` (not in the digest). Memory follows the longest text of a part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewatch.llm.arrays import BYTES, Rolling, covered, mix, slices, wide, windows
from tidewatch.llm.parts import (
    SENT, answered, ask, bits_for, blocks_for, column, deal, distinct, each_part, pack, part_of,
    text_bytes, unpack,
)

GRAM = 16
_U = np.uint64
_H = np.uint32
_LOW = _U(0xFFFFFFFF)


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """For each stretch of ``width`` values the place of its leftmost lowest value."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    best = (values & ~_LOW) | np.arange(n, dtype=_U)
    span = 1
    while 2 * span <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    rest = width - span
    if rest:
        best = np.minimum(best[:-rest], best[rest:])
    return (best & _LOW).astype(np.int64)


class _Runs:
    """Stretches of neighbouring suffixes of a part that share an anchor."""

    def __init__(self, docs: pa.Table, depth: int, digit: int):
        self.slices, first, last, anchor, of = [], [], [], [], []
        self.digest = [np.zeros(0, _U)]
        for k, part in enumerate(slices(column(docs, "text"))):
            self.slices.append(part)
            start, _ = windows(part.offsets, depth)
            if not len(start):
                continue
            rolled = Rolling(BYTES[part.data])
            grams = rolled.of(np.arange(len(part.data) - GRAM + 1), np.arange(GRAM, len(part.data) + 1))
            own = lowest(grams, depth - digit + 1)[start]
            del grams
            new = np.ones(len(start), bool)
            new[1:] = (own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1)
            head = np.flatnonzero(new)
            first.append(start[head])
            last.append(start[np.append(head[1:], len(start)) - 1])
            anchor.append(own[head])
            of.append(np.full(len(head), k))
            self.digest.append(rolled.of(own[head], own[head] + digit))
        none = np.zeros(0, np.int64)
        self.first, self.last, self.anchor, self.of = (np.concatenate([none, *x]) for x in (first, last, anchor, of))
        self.digest = np.concatenate(self.digest)

    def on_slices(self, chosen: np.ndarray):
        """Slice by slice the places of the chosen runs."""
        for k in np.unique(self.of[chosen]):
            yield self.slices[k], np.flatnonzero(chosen & (self.of == k))


class _Sort:
    """The passes over one part; each takes the answers to the passes before."""

    def __init__(self, docs: pa.Table, answers: pa.Table | None, depth: int, digit: int, blocks: tuple[int, int]):
        self.depth, self.answers = depth, answers
        self.runs = _Runs(docs, depth, digit)
        self.few, self.many = blocks

    @staticmethod
    def block(keys: np.ndarray, blocks: int) -> np.ndarray:
        return (keys >> _U(64 - int(np.log2(blocks)))).astype(np.int64)

    def anchors(self):
        """First digit: the anchors' buckets."""
        self.order1, self.new1 = distinct(self.runs.digest)
        self.digest = self.runs.digest[self.order1[self.new1]]
        size = np.diff(np.append(np.flatnonzero(self.new1), len(self.order1)))
        block = self.block(self.digest, self.few)
        return block, self.digest, (size > 1).view(np.uint8)

    def stretches(self):
        """Second digit: whole stretches in buckets that are shared."""
        block, digest, _ = self.anchors()
        shared = np.zeros(len(self.runs.digest), bool)
        shared[self.order1] = bits_for(self.answers, "anchor", block)[np.cumsum(self.new1) - 1]
        self.shared = np.flatnonzero(shared)
        runs = self.runs
        one, two = np.empty(len(shared), _U), np.empty(len(shared), _U)
        for part, at in runs.on_slices(shared):
            ahead = (runs.anchor[at] - runs.first[at]).astype(_U)
            one[at], two[at] = wide(BYTES[part.data], runs.first[at], runs.last[at] + self.depth)
            one[at] = mix(one[at] + ahead)
        one, two, digest = one[self.shared], two[self.shared], runs.digest[self.shared]
        self.order2, self.new2 = distinct(digest, one, two)
        head = self.order2[self.new2]
        size = np.diff(np.append(np.flatnonzero(self.new2), len(self.order2)))
        return self.block(digest[head], self.few), digest[head], one[head], two[head], (size > 1).view(np.uint8)

    def suffixes(self):
        """Third digit: single suffixes where a bucket holds different stretches."""
        block = self.stretches()[0]
        group = np.cumsum(self.new2) - 1
        self.repeated = np.zeros(len(self.runs.first), bool)
        self.repeated[self.shared[self.order2]] = bits_for(self.answers, "repeated", block)[group]
        stands = np.zeros(len(self.runs.first), bool)
        stands[self.shared[self.order2[self.new2]]] = bits_for(self.answers, "open", block)
        runs, keys = self.runs, [(np.zeros(0, _U), np.zeros(0, _U))]
        self.places = []
        for part, at in runs.on_slices(stands):
            n = runs.last[at] - runs.first[at] + 1
            start = np.arange(n.sum()) + np.repeat(runs.first[at] - np.cumsum(n) + n, n)
            self.places.append((int(runs.of[at[0]]), start))
            keys.append(wide(BYTES[part.data], start, start + self.depth))
        one, two = (np.concatenate(x) for x in zip(*keys, strict=True))
        two = (two >> _U(32)).astype(_H)
        self.order3, self.new3 = distinct(one, two)
        head = self.order3[self.new3]
        size = np.diff(np.append(np.flatnonzero(self.new3), len(self.order3)))
        return self.block(one[head], self.many), one[head], two[head], (size > 1).view(np.uint8)

    def found(self) -> list[list[np.ndarray]]:
        """For each slice the starts of repeated strings."""
        block = self.suffixes()[0]
        hit = np.empty(len(self.order3), bool)
        hit[self.order3] = bits_for(self.answers, "suffix", block)[np.cumsum(self.new3) - 1]
        runs, out, at = self.runs, [[] for _ in self.runs.slices], 0
        for _, own in runs.on_slices(self.repeated):
            n = runs.last[own] - runs.first[own] + 1
            out[runs.of[own[0]]].append(np.arange(n.sum()) + np.repeat(runs.first[own] - np.cumsum(n) + n, n))
        for k, start in self.places:
            out[k].append(start[hit[at : at + len(start)]])
            at += len(start)
        return out


def _merged(got: pa.Table, *types: type):
    sent = [unpack(x, *types) for x in got["sent"].to_pylist()]
    cuts = np.cumsum([len(x[0]) for x in sent])[:-1]
    return cuts, *(np.concatenate(x) for x in zip(*sent, strict=True))


def _sizes(order: np.ndarray, new: np.ndarray, twice: np.ndarray) -> np.ndarray:
    """For each row: how often its key occurs, 2 standing for any more in one part."""
    group = np.cumsum(new) - 1
    size = np.bincount(group, 1 + twice[order])
    out = np.empty(len(order))
    out[order] = size[group]
    return out


def _judge_anchors(got: pa.Table) -> pa.Table:
    cuts, digest, twice = _merged(got, _U, np.uint8)
    return answered(got, "anchor", np.split(_sizes(*distinct(digest), twice) > 1, cuts))


def _judge_suffixes(got: pa.Table) -> pa.Table:
    cuts, one, two, twice = _merged(got, _U, _H, np.uint8)
    return answered(got, "suffix", np.split(_sizes(*distinct(one, two), twice) > 1, cuts))


def _judge_stretches(got: pa.Table) -> pa.Table:
    """Which stretches are repeated; which stand for their equals in a bucket with others."""
    cuts, digest, one, two, twice = _merged(got, _U, _U, _U, np.uint8)
    order, new = distinct(digest, one, two)
    repeated = _sizes(order, new, twice) > 1
    bucket = np.ones(len(order), bool)
    bucket[1:] = digest[order][1:] != digest[order][:-1]
    bucket = np.cumsum(bucket) - 1
    kinds = np.bincount(bucket, new)
    stands = np.empty(len(order), bool)
    stands[order] = new & (kinds[bucket] > 1)
    return pa.concat_tables(
        [answered(got, "repeated", np.split(repeated, cuts)), answered(got, "open", np.split(stands, cuts))]
    )


def _cut(docs: pa.Table, answers: pa.Table, depth: int, digit: int, blocks: tuple[int, int], digest: bool) -> pa.Table:
    work = _Sort(docs, answers, depth, digit, blocks)
    n_bytes, n_removed, n_spans, kept = [], [], [], []
    for part, found in zip(work.runs.slices, work.found(), strict=True):
        gone = covered(np.concatenate(found), depth, len(part.data)) if found else np.zeros(len(part.data), bool)
        data = part.data.tobytes()
        for a, b in zip(part.offsets[:-1].tolist(), part.offsets[1:].tolist(), strict=True):
            own, rest = gone[a:b], data[a:b]
            n_bytes.append(b - a)
            n_removed.append(int(own.sum()))
            n_spans.append(int((own[1:] & ~own[:-1]).sum()) + bool(own[:1].any()) if n_removed[-1] else 0)
            if n_removed[-1]:
                rest = part.data[a:b][~own].tobytes()
            kept.append(hashlib.sha256(rest).hexdigest() if digest else rest.decode("utf-8", "replace"))
    out = {
        "doc_id": column(docs, "doc_id"),
        "text": column(docs, "text"),
        "n_bytes": pa.array(n_bytes, pa.int64()),
        "n_removed": pa.array(n_removed, pa.int64()),
        "n_spans": pa.array(n_spans, pa.int64()),
        "kept_sha256" if digest else "kept": pa.array(kept, pa.string()),
    }
    if digest:
        out.pop("text")
    return pa.table(out)


def remove_repeats(docs: DataFrame, depth: int = 400, digit: int = 200, digest: bool = False) -> DataFrame:
    """``doc_id, text, n_bytes, n_removed, n_spans, kept`` of all rows.

    With ``digest`` the texts are left out and ``kept_sha256`` takes the place of ``kept``.
    """
    if not GRAM <= digit < depth:
        raise ValueError("digit must be at least 16 and less than depth")
    dealt = deal(docs)
    n = text_bytes(dealt)
    blocks = blocks_for(n * 2 / (depth - digit + 2)), blocks_for(n / 8)

    def send(keys):
        return lambda d, a: pack(part_of(d), (k := keys(_Sort(d, a, depth, digit, blocks)))[0], blocks[keys is _Sort.suffixes], *k[1:])

    answers = ask(each_part(dealt, send(_Sort.anchors), SENT), _judge_anchors, "anchors")
    more = ask(each_part(dealt, send(_Sort.stretches), SENT, answers), _judge_stretches, "stretches")
    answers = answers.unionByName(more)
    more = ask(each_part(dealt, send(_Sort.suffixes), SENT, answers), _judge_suffixes, "suffixes")
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    if not digest:
        schema = "doc_id bigint, text string, n_bytes bigint, n_removed bigint, n_spans bigint, kept string"
    return each_part(
        dealt, lambda d, a: _cut(d, a, depth, digit, blocks, digest), schema, answers.unionByName(more)
    )
