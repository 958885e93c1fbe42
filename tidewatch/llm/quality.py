"""Quality of documents by a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into windows of ``WIDTH`` bytes every ``STRIDE``, the last one padded, so
that overlapping windows cover the whole text; ``PER_CHUNK`` windows are a chunk, which shares bytes
with the next. Each byte is a learned vector, and ``FILTERS`` learned filters see each window. A
filter's largest response is taken for each chunk; the mean and the maximum over the chunks, weighted,
are the log odds of one probability.

The network learns on the driver from labels of at most ``SAMPLE`` documents, those whose ids hash
lowest, of at most ``LONGEST`` bytes each; only the text is an input. Every document is scored whole
where it is read, in blocks of ``BLOCK`` windows.

Rows: null text is empty and is scored like any other; labels that are neither 0 nor 1 and labels
without an id are left out; a null ``doc_id`` is not held out. Without labels of both kinds every score
is the mean label, 0.5 where there is none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.arrays import Slice, slices
from tidewatch.staging import stage

WIDTH = 16
STRIDE = 8
PER_CHUNK = 64
VECTOR = 8
FILTERS = 24
BLOCK = 16_384
SAMPLE = 3000
LONGEST = 32_768
#: Steps of the descent, each on so many documents, however many there are.
STEPS = 640
BATCH = 24
RATE = 4e-3
THRESHOLD = 0.3
FOLDS = 5
SEED = 11


@dataclass
class Network:
    byte: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    @classmethod
    def fresh(cls, odds: float = 0.0) -> Network:
        random = np.random.default_rng(SEED)
        normal = lambda *shape: random.normal(size=shape).astype(np.float32)
        return cls(
            normal(256, VECTOR) / 2, normal(WIDTH * VECTOR, FILTERS) / np.float32(np.sqrt(WIDTH * VECTOR)),
            np.zeros(FILTERS, np.float32), np.zeros(2 * FILTERS, np.float32), np.full(1, odds, np.float32),
        )

    def values(self) -> list[np.ndarray]:
        return [self.byte, self.filters, self.bias, self.weights, self.offset]


@dataclass
class Windows:
    """Places of all windows of a slice; ``chunk`` of each, ``document`` of each chunk."""

    start: np.ndarray
    end: np.ndarray
    chunk: np.ndarray
    document: np.ndarray

    @classmethod
    def of(cls, part: Slice) -> Windows:
        size = np.diff(part.offsets)
        n = np.maximum(1, -(-(size - WIDTH) // STRIDE) + 1)
        first = np.cumsum(n) - n
        within = np.arange(n.sum()) - np.repeat(first, n)
        chunks = -(-n // PER_CHUNK)
        return cls(
            np.repeat(part.offsets[:-1], n) + within * STRIDE,
            np.repeat(part.offsets[1:], n),
            np.repeat(np.cumsum(chunks) - chunks, n) + within // PER_CHUNK,
            np.repeat(np.arange(len(size)), chunks),
        )


def _bytes(data: np.ndarray, windows: Windows, own: slice) -> np.ndarray:
    place = windows.start[own, None] + np.arange(WIDTH)
    inside = place < windows.end[own, None]
    if not len(data):
        return np.zeros(place.shape, np.uint8)
    return np.where(inside, data[np.minimum(place, len(data) - 1)], 0)


def _respond(net: Network, data: np.ndarray, windows: Windows, best: bool = False):
    """The largest response of each filter for each chunk; with ``best`` also the windows."""
    n = len(windows.document)
    top = np.full((n, FILTERS), -np.inf, np.float32)
    at = np.zeros((n, FILTERS), np.int64) if best else None
    for first in range(0, len(windows.start), BLOCK):
        own = slice(first, first + BLOCK)
        seen = net.byte[_bytes(data, windows, own)].reshape(-1, WIDTH * VECTOR) @ net.filters
        chunk = windows.chunk[own]
        head = np.flatnonzero(np.concatenate(([True], chunk[1:] != chunk[:-1])))
        high = np.maximum.reduceat(seen, head)
        ids = chunk[head]
        if best:
            size = np.diff(np.append(head, len(chunk)))
            hit = seen == np.repeat(high, size, axis=0)
            index = np.where(hit, np.arange(len(chunk))[:, None], len(chunk))
            found = np.minimum.reduceat(index, head) + first
            better = high > top[ids]
            at[ids] = np.where(better, found, at[ids])
        top[ids] = np.maximum(top[ids], high)
    return top, at


def _combine(net: Network, top: np.ndarray, document: np.ndarray):
    """Log odds of each document, and what they were made from."""
    active = np.maximum(top + net.bias, 0)
    head = np.flatnonzero(np.concatenate(([True], document[1:] != document[:-1])))
    size = np.diff(np.append(head, len(document)))
    mean = np.add.reduceat(active, head) / size[:, None]
    most = np.maximum.reduceat(active, head)
    return np.concatenate((mean, most), axis=1) @ net.weights + net.offset, active, mean, most, head, size


def _chance(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds.astype(float), -60, 60)))


def _gradients(net: Network, part: Slice, label: np.ndarray) -> list[np.ndarray]:
    windows = Windows.of(part)
    top, at = _respond(net, part.data, windows, best=True)
    odds, active, mean, most, head, size = _combine(net, top, windows.document)
    error = ((_chance(odds) - label) / len(label)).astype(np.float32)
    to_weights = np.concatenate((mean, most), axis=1).T @ error
    each = np.repeat(np.arange(len(size)), size)
    back = error[each, None] * (net.weights[:FILTERS] / size[each, None])
    # of equally large chunks the first one moves the maximum
    place = np.arange(len(active))[:, None]
    first = np.minimum.reduceat(np.where(active == most[each], place, len(active)), head)
    back = back + np.where(place == first[each], error[each, None] * net.weights[FILTERS:], 0)
    back = (back * (active > 0)).astype(np.float32)
    to_byte, to_filters = np.zeros_like(net.byte), np.zeros_like(net.filters)
    for f in range(FILTERS):
        own = np.flatnonzero(back[:, f])
        if not len(own):
            continue
        seen = _bytes(part.data, windows, at[own, f])
        to_filters[:, f] = back[own, f] @ net.byte[seen].reshape(len(own), -1)
        pull = back[own, f, None, None] * net.filters[:, f].reshape(WIDTH, VECTOR)
        for v in range(VECTOR):
            to_byte[:, v] += np.bincount(seen.ravel(), pull[:, :, v].ravel(), 256)
    return [to_byte, to_filters, back.sum(axis=0), to_weights, error.sum(keepdims=True)]


def learn(texts: list[str], labels: np.ndarray) -> Network:
    """Gradient descent with momentum and scaled steps, in a fixed order."""
    mean = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
    net = Network.fresh(np.log(mean / (1 - mean)))
    if not len(labels) or labels.min() == labels.max():
        return net
    random = np.random.default_rng(SEED)
    pace = [np.zeros_like(v) for v in net.values()]
    scale = [np.zeros_like(v) for v in net.values()]
    order = np.zeros(0, np.int64)
    for step in range(1, STEPS + 1):
        if not len(order):
            order = random.permutation(len(labels))
        own, order = order[:BATCH], order[BATCH:]
        (part,) = slices(pa.array([texts[i] for i in own], pa.string()), 1 << 40)
        rate = RATE * min(1, 2 * (1 - step / (STEPS + 1)))
        for v, g, p, s in zip(net.values(), _gradients(net, part, labels[own]), pace, scale, strict=True):
            p += 0.1 * (g - p)
            s += 0.01 * (g * g - s)
            v -= (rate * (p / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def score_texts(net: Network, texts: pa.Array) -> np.ndarray:
    out = [np.zeros(0)]
    for part in slices(texts, 1 << 18):
        windows = Windows.of(part)
        out.append(_chance(_combine(net, _respond(net, part.data, windows)[0], windows.document)[0]))
    return np.concatenate(out)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Network:
    """A network from the documents that are not held out."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
    mark = F.xxhash64("doc_id")
    last = known.select(mark.alias("mark")).orderBy("mark").limit(SAMPLE).agg(F.max("mark")).head()[0]
    if last is None:
        return learn([], np.zeros(0))
    known = stage(known.where(mark <= F.lit(last)), "known")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = (
        texts.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= LONGEST).join(known, "doc_id")
        .orderBy("doc_id", "quality", "text").limit(SAMPLE).toArrow()
    )
    return learn([t or "" for t in rows["text"].to_pylist()], rows["quality"].to_numpy())


def score(docs: DataFrame, net: Network, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of all rows, ``score``, the chance of a good document, and ``predicted``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, texts = batch.columns
            yield pa.RecordBatch.from_arrays([*columns, pa.array(score_texts(net, texts))], names)

    plain = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("text to score"))
    schema = T.StructType([*plain.schema.fields[:-1], T.StructField("score", T.DoubleType())])
    names = schema.names
    return plain.mapInArrow(work, schema).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, net: Network) -> DataFrame:
    """The rows of ``docs`` that the network predicts to be good, whatever their columns are named."""
    row = docs.select(F.struct("*").alias("row"), "text")
    return score(row, net, ("row",)).where("predicted = 1").select("row.*")
