"""Documents that hold a benchmark item, also with other numbers, names and units.

A token is a word without the ASCII punctuation around it, in lower case. Templates put a typed
placeholder for numbers (digits with ``.,`` inside, a sign before, a percent sign after), for units (a
word of ``UNITS`` after a number) and for names (A-Z followed by a-z, not at the start of a sentence). A
window with names also counts with the names as they are, for texts all in capitals or small letters.
A window is ``WINDOW`` tokens of a template; an item with fewer has one window of all its tokens.

Documents are scanned where they are read; windows that a bitmap of fixed size over the items'
windows lets through go on, with the values in their slots. They are hash-joined with the items'
windows. Windows whose values are the item's count as they are. Others count where the alignment (place in
the document less place in the item) is consistent: the same value of the item always has the same value
in the document, while two of its values may become one. So a question asked with other parameters is
caught, and text that only shares the template's words is not. A document is contaminated by an item when consistent alignments cover ``SHARE`` of its windows.

Rows: null texts and texts without tokens match nothing, as do items without tokens; an item id may
be null; rows are told apart by id and text, null ids included.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.arrays import FOLDED, Rolling, Slice, Words, mix, slices, windows, words
from tidewatch.staging import stage

WINDOW = 8
SHARE = 0.5
#: Places of the bitmap.
BITS = 22
UNITS = (
    "km m cm mm mile miles yard yards foot feet inch inches kg g mg ton tons lb lbs pound pounds oz ounce ounces "
    "l ml liter liters litre litres gallon gallons s ms sec second seconds min minute minutes h hr hour hours day days "
    "week weeks month months year years usd eur dollar dollars euro euros cent cents percent degree degrees mph kmh "
    "kilometers kilometres meters metres centimeters centimetres grams kilograms watt watts volt volts"
).split()

_U = np.uint64
_NUMBER, _UNIT, _NAME = (_U(x) for x in (0x1D8E4E27C47D124F, 0x2545F4914F6CDD1D, 0x3C6EF372FE94F82B))
_KINDS = {1: "number", 2: "unit", 3: "name"}


def _bytes(*ranges: tuple[int, int] | str) -> np.ndarray:
    out = np.zeros(256, bool)
    for r in ranges:
        if isinstance(r, str):
            out[np.frombuffer(r.encode(), np.uint8)] = True
        else:
            out[r[0] : r[1] + 1] = True
    return out


_BODY = _bytes("0123456789", (65, 90), (97, 122), (128, 255))
_DIGIT = _bytes("0123456789")
_NUMERIC = _bytes("0123456789.,")
_STOP = _bytes(".!?:\n")
_UPPER, _LOWER = _bytes((65, 90)), _bytes((97, 122))


def _before(mask: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(mask)))


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    part = Slice(0, data, np.array([0, len(data)]))
    found = words(part)
    return np.sort(Rolling(FOLDED[data]).of(found.start, found.end))


def tokens(part: Slice) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Stripped words, the hash of each in the template and in the one that keeps names, and its kind
    (0: a plain word)."""
    data, found = part.data, words(part)
    body = np.flatnonzero(_BODY[data])
    first, last = np.searchsorted(body, found.start), np.searchsorted(body, found.end) - 1
    some = first <= last
    start, end = body[first[some]], body[last[some]] + 1
    offsets = np.concatenate(([0], np.cumsum(some)))[found.offsets]
    hashes = Rolling(FOLDED[data]).of(start, end)
    kind = np.zeros(len(start), np.int8)
    if len(start):
        numeric = _before(_NUMERIC[data])
        number = _DIGIT[data[start]] & (numeric[end] - numeric[start] == end - start)
        unit = np.zeros(len(start), bool)
        unit[1:] = number[:-1]
        unit[offsets[:-1][offsets[:-1] < len(start)]] = False
        unit &= np.isin(hashes, _unit_hashes())
        stop = _before(_STOP[data])
        opens = np.ones(len(start), bool)
        opens[1:] = stop[start[1:]] > stop[end[:-1]]
        opens[offsets[:-1][offsets[:-1] < len(start)]] = True
        second = data[np.minimum(start + 1, len(data) - 1)]
        name = _UPPER[data[start]] & (end > start + 1) & _LOWER[second] & ~opens
        kind[name], kind[unit], kind[number] = 3, 2, 1
        hashes[kind == 1], hashes[kind == 2] = _NUMBER, _UNIT
    return Words(start, end, offsets), np.where(kind == 3, _NAME, hashes), hashes, kind


def template_windows(part: Slice, widths: list[int], whole: bool = False):
    """``(document, place, width, hash, named, slots)`` of each window of a slice; slots as a function
    of the chosen windows. Windows with names come a second time (not ``named``) with the names as plain
    words. With ``whole`` a short document is one window of its own width."""
    found, hashes, plain, kind = tokens(part)
    counts = found.counts()
    start, width = [], []
    for w in widths:
        own, _ = windows(found.offsets, w)
        start.append(own)
        width.append(np.full(len(own), w))
    if whole:
        short = np.flatnonzero((counts > 0) & (counts < min(widths)))
        start.append(found.offsets[short])
        width.append(counts[short])
    start, width = np.concatenate(start), np.concatenate(width)
    names = _before(kind == 3)
    again = np.flatnonzero(names[start + width] > names[start])
    named = np.arange(len(start) + len(again)) < len(start)
    key = np.concatenate(
        (Rolling(hashes).of(start, start + width), Rolling(plain).of(start[again], start[again] + width[again]))
    )
    start, width = np.concatenate((start, start[again])), np.concatenate((width, width[again]))
    key = mix(key + width.astype(_U))
    document = np.searchsorted(found.offsets, start, "right") - 1

    def slots(chosen: np.ndarray) -> list[list[str]]:
        data, out = part.data.tobytes(), []
        for s, w, n in zip(start[chosen].tolist(), width[chosen].tolist(), named[chosen].tolist(), strict=True):
            at = np.flatnonzero((kind[s : s + w] > 0) & (n | (kind[s : s + w] < 3))) + s
            out.append(
                [f"{_KINDS[kind[i]]}:{data[found.start[i] : found.end[i]].decode('utf-8', 'replace').lower()}" for i in at]
            )
        return out

    return document, start - found.offsets[document], width, key, named, slots


_ITEM = "item_id bigint, place int, width int, key bigint, slots array<string>, n_windows int"
_HIT = "doc_id bigint, mark bigint, place int, key bigint, slots array<string>"


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch["text"]):
            document, place, width, key, named, slots = template_windows(part, [WINDOW], whole=True)
            yield pa.record_batch(
                {
                    "item_id": batch["item_id"].take(pa.array(document + part.first)),
                    "place": pa.array(place, pa.int32()),
                    "width": pa.array(width, pa.int32()),
                    "key": pa.array(key.view(np.int64)),
                    "slots": pa.array(slots(np.arange(len(key))), pa.list_(pa.string())),
                    "n_windows": pa.array(np.bincount(document[named], minlength=len(part))[document], pa.int32()),
                }
            )


def _bitmap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bitmap of a partition of items, and as a second one the widths of their windows."""
    bits, widths = np.zeros(1 << BITS, bool), np.zeros(WINDOW + 1, bool)
    for batch in batches:
        bits[batch["key"].to_numpy().view(_U) >> _U(64 - BITS)] = True
        widths[batch["width"].to_numpy()] = True
    yield pa.record_batch({"bits": pa.array([np.packbits(bits).tobytes(), np.packbits(widths).tobytes()], pa.binary()), "kind": pa.array([0, 1], pa.int32())})


def _merge(maps: list[bytes], n: int) -> np.ndarray:
    out = np.zeros(-(-n // 8), np.uint8)
    for x in maps:
        out |= np.frombuffer(x, np.uint8)
    return np.unpackbits(out, count=n).astype(bool)


def _hits(packed: bytes, widths: list[int]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
        for batch in batches:
            for part in slices(batch["text"]):
                document, place, _, key, _, slots = template_windows(part, widths)
                hit = np.flatnonzero(bits[key >> _U(64 - BITS)])
                row = pa.array(document[hit] + part.first)
                yield pa.record_batch(
                    {
                        "doc_id": batch["doc_id"].take(row),
                        "mark": batch["mark"].take(row),
                        "place": pa.array(place[hit], pa.int32()),
                        "key": pa.array(key[hit].view(np.int64)),
                        "slots": pa.array(slots(hit), pa.list_(pa.string())),
                    }
                )

    return work


def marked(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("mark"),
        F.col("text").cast("string").alias("text"),
    )


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, mark, item_id, n_matched, n_windows, share, reparameterised`` of each contaminated
    document and item; ``mark`` is the hash of the text."""
    items = items.select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")
    ).distinct()
    asked = stage(items.mapInArrow(_item_windows, _ITEM), "items")
    # one bitmap of fixed size for each of a few partitions
    maps = asked.select("key", "width").coalesce(8).mapInArrow(_bitmap, "bits binary, kind int").collect()
    bits = _merge([r.bits for r in maps if r.kind == 0], 1 << BITS)
    widths = [int(w) for w in np.flatnonzero(_merge([r.bits for r in maps if r.kind == 1], WINDOW + 1))]
    hits = stage(marked(docs).mapInArrow(_hits(np.packbits(bits).tobytes(), widths or [WINDOW]), _HIT), "hits")

    asked = asked.select("item_id", "key", "n_windows", F.col("place").alias("item_place"), F.col("slots").alias("item_slots"))
    found = hits.join(asked, "key").withColumn("line", F.col("place") - F.col("item_place"))
    found = stage(found, "found")
    line = ["doc_id", "mark", "item_id", "line"]
    # slots of a window are paired in order; equal templates have as many
    pair = F.explode(F.arrays_zip("item_slots", "slots"))
    pairs = found.where(F.size("slots") > 0).select(*line, pair.alias("p")).select(
        *line, F.col("p.item_slots").alias("theirs"), F.col("p.slots").alias("ours")
    )
    pairs = stage(pairs.groupBy(*line, "theirs", "ours").agg(F.count(F.lit(1)).alias("n")), "slots")
    broken = pairs.groupBy(*line, "theirs").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*line).distinct()
    broken = broken.select(*[F.col(c).alias(f"_{c}") for c in line], F.lit(1).alias("broken"))
    key = ["doc_id", "mark", "item_id"]
    same = F.lit(True)
    for c in line:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    found = found.join(broken, same, "left").withColumn("changed", F.col("slots") != F.col("item_slots"))
    good = found.where("broken is null or not changed").groupBy(*key, "n_windows", "item_place").agg(F.max("changed").alias("changed"))
    return (
        good.groupBy(*key, "n_windows")
        .agg(F.count(F.lit(1)).alias("n_matched"), F.max("changed").alias("changed"))
        .where(F.col("n_matched") >= SHARE * F.col("n_windows"))
        .select(
            *key, F.col("n_matched"), F.col("n_windows").cast("bigint").alias("n_windows"),
            (F.col("n_matched") / F.col("n_windows")).alias("share"), F.col("changed").alias("reparameterised"),
        )
    )


def without(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item contaminates."""
    bad = stage(contaminated(docs, items).select("doc_id", "mark").distinct(), "bad")
    same = docs["doc_id"].cast("bigint").eqNullSafe(bad["doc_id"]) & (F.xxhash64(docs["text"]) == bad["mark"])
    return docs.join(bad, same, "left_anti")
