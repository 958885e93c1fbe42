"""Near-duplicate embeddings by spherical-cap filters.

A filter is a direction; a vector belongs to all filters whose cosine with it reaches ``CAP``. The
directions are a random product code: the dimensions are cut into ``BLOCKS`` blocks, each with
``WORDS`` random unit vectors, and every combination of one word for each block, scaled to length
one, is a direction. A vector's filters are list-decoded block by block: a partial combination is
dropped as soon as the best words of the blocks that are left cannot lift it to ``CAP``. A vector
that reaches no filter gets its best one.

Vectors are decoded in a fixed pseudorandom rotation of their space, so that blocks hold alike much of
a vector also where coordinates differ in spread or are empty; cosines are of the vectors as they are.

Vectors meet on label and filter and are compared in double precision there. A linked pair is
counted only in the lowest filter that both share. A bucket returns a count for each vector and
a forest of its links, never pairs; one with more than ``ROWS`` vectors is cut into blocks, and each
pair of blocks is a key of its own. Equal vectors of a label are one class with a multiplicity.

Two vectors link when their labels are equal and their cosine is at least ``cosine``, and are found
when they share a filter: a pair at cosine 0.98 in 64 dimensions has some 16 filters on each side
and misses all with a chance far below one in a thousand (tests measure it against all pairs).

Rows: a null label, a vector that is null, empty, zero or has a null or non-finite component, and
a null id link with nothing; vectors of different length never link; rows that share an id and
differ in vector are each compared, and counted together.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.arrays import mix
from tidewatch.llm.components import LINKS, components, forest
from tidewatch.staging import stage

BLOCKS = 2
WORDS = 256
#: In units of the spread of a random vector's cosine, one over the root of the dimensions.
CAP = 3.6
#: Filters of a vector at least.
LEAST = 12
ROWS = 1024
#: Vectors decoded, and linked pairs looked up, at a time.
_BATCH = 512

_CAPS = "label bigint, id bigint, size bigint, vector binary, filters array<int>, names binary"
_FOUND = "a bigint, b bigint, n bigint"


def _normal(n: int, salt: int) -> np.ndarray:
    seed = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) + np.uint64(salt))
    u = (seed >> np.uint64(11)).astype(float) / (1 << 53) + 2.0**-54
    return np.sqrt(-2 * np.log(u[::2])) * np.cos(2 * np.pi * u[1::2])


def code(dimensions: int) -> list[np.ndarray]:
    """The words of each block: unit vectors over the square root of the number of blocks."""
    out = []
    for k, own in enumerate(np.array_split(np.arange(dimensions), min(BLOCKS, dimensions))):
        normal = _normal(WORDS * len(own), 1000003 * (k + 1)).reshape(WORDS, len(own))
        normal /= np.linalg.norm(normal, axis=1, keepdims=True)
        # a block of one dimension has two directions only
        out.append(np.unique(normal, axis=0) / np.sqrt(min(BLOCKS, dimensions)))
    return out


@lru_cache(maxsize=4)
def rotation(dimensions: int) -> np.ndarray:
    """A pseudorandom orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(_normal(dimensions * dimensions, 1 << 40).reshape(dimensions, dimensions))
    return q * np.where(np.diag(r) < 0, -1.0, 1.0)


def decode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, filter)`` of all filters that the rows reach."""
    n, dimensions = unit.shape
    unit = unit @ rotation(dimensions)
    words = code(dimensions)
    cap = CAP / np.sqrt(dimensions)
    cuts = np.cumsum([w.shape[1] for w in words])[:-1]
    inner = [x @ w.T for x, w in zip(np.split(unit, cuts, axis=1), words, strict=True)]
    best = np.cumsum([x.max(axis=1) for x in inner[::-1]], axis=0)[::-1]
    row, name, value = np.arange(n), np.zeros(n, np.int64), np.zeros(n)
    top = np.zeros((n, 1))
    for x in inner:
        most = -np.sort(-x, axis=1)[:, :LEAST]
        top = (top[:, :, None] + most[:, None]).reshape(n, -1)
        top = -np.sort(-top, axis=1)[:, :LEAST]
    reach = np.minimum(cap, top[:, -1] - 1e-12)
    for k, x in enumerate(inner):
        value = value[:, None] + x[row]
        name = name[:, None] * x.shape[1] + np.arange(x.shape[1])
        rest = best[k + 1] if k + 1 < len(inner) else np.zeros(n)
        keep = value + rest[row][:, None] >= reach[row][:, None]
        row, name, value = np.broadcast_to(row[:, None], keep.shape)[keep], name[keep], value[keep]
    return row, name


def _units(raw: np.ndarray) -> np.ndarray:
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def _filters(kind: type):
    """One row for each vector, with its values as ``kind`` and the filters that it reaches."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array([len(v) for v in batch["vector"]])
            flat = np.asarray(batch["vector"].flatten(), kind)
            place = np.concatenate(([0], np.cumsum(lengths)))
            for d in np.unique(lengths):
                same = np.flatnonzero(lengths == d)
                for at in range(0, len(same), _BATCH):
                    own = same[at : at + _BATCH]
                    raw = flat[place[own][:, None] + np.arange(d)]
                    row, name = decode(_units(raw.astype(float)))
                    edge = np.searchsorted(row, np.arange(len(own) + 1))
                    lists = [name[a:b].astype(np.int32) for a, b in zip(edge[:-1], edge[1:], strict=True)]
                    chosen = pa.array(own)
                    yield pa.record_batch(
                        {
                            "label": batch["label"].take(chosen),
                            "id": batch["id"].take(chosen),
                            "size": batch["size"].take(chosen),
                            "vector": pa.array([x.tobytes() for x in raw], pa.binary()),
                            "filters": pa.array(lists, pa.list_(pa.int32())),
                            "names": pa.array([x.tobytes() for x in lists], pa.binary()),
                        }
                    )

    return work


def _lowest_shared(lists: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    width = max(map(len, lists))
    padded = np.full((len(lists), width), -1, np.int32)
    for i, names in enumerate(lists):
        padded[i, : len(names)] = names
    out = np.empty(len(x), np.int32)
    for at in range(0, len(x), _BATCH):
        own = slice(at, at + _BATCH)
        p, q = padded[x[own]], padded[y[own]]
        shared = (p[:, :, None] == q[:, None, :]).any(axis=2) & (p >= 0)
        out[own] = p[np.arange(len(p)), shared.argmax(axis=1)]
    return out


def _bucket(rows: pa.Table, cosine: float, kind: type) -> pa.RecordBatch | None:
    """Counts (``b`` null) and forest links (``n`` null) of a pair of blocks of a bucket."""
    name, block = rows["filter"][0].as_py(), rows["block"].to_numpy()
    low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
    id, size = rows["id"].to_numpy(), rows["size"].to_numpy()
    vectors = rows["vector"].to_pylist()
    lists = [np.frombuffer(x, np.int32) for x in rows["names"].to_pylist()]
    lengths = np.array([len(v) for v in vectors])
    links = []
    for d in np.unique(lengths):
        same = np.flatnonzero(lengths == d)
        own, other = (same[block[same] == k] for k in (low, high))
        if not len(own) or not len(other):
            continue
        values = [
            _units(np.frombuffer(b"".join(vectors[i] for i in side), kind).reshape(len(side), -1).astype(float))
            for side in (own, other)
        ]
        x, y = np.nonzero(values[0] @ values[1].T >= cosine)
        if low == high:
            x, y = x[x < y], y[x < y]
        links.append((own[x], other[y]))
    if not links:
        return None
    x, y = (np.concatenate(z) for z in zip(*links, strict=True))
    if not len(x):
        return None
    a, b = forest(id[x], id[y])
    first = _lowest_shared(lists, x, y) == name
    x, y = x[first], y[first]
    count = np.bincount(x, size[y], len(id)) + np.bincount(y, size[x], len(id))
    some = np.flatnonzero(count)
    return pa.record_batch(
        {
            "a": pa.array(np.concatenate((id[some], a)), pa.int64()),
            "b": pa.array([None] * len(some) + b.tolist(), pa.int64()),
            "n": pa.array(count[some].astype(np.int64).tolist() + [None] * len(a), pa.int64()),
        }
    )


def _buckets(cosine: float, kind: type):
    key = ["label", "filter", "low", "high"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([rest, rows]) if rest is not None else rows
            if not rows.num_rows:
                continue
            keys = np.stack([rows[c].to_numpy() for c in key])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            cuts = np.concatenate(([0], cuts, [rows.num_rows]))
            for first, last in zip(cuts[:-2], cuts[1:-1], strict=True):
                if last - first > 1 and (found := _bucket(rows.slice(first, last - first).combine_chunks(), cosine, kind)):
                    yield found
            rest = rows.slice(cuts[-2])
        if rest is not None and rest.num_rows > 1 and (found := _bucket(rest.combine_chunks(), cosine, kind)):
            yield found

    return work


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.98, id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of all rows."""
    single = vectors.schema[vector].dataType.elementType == T.FloatType()
    kind = np.float32 if single else float
    rows = vectors.select(
        F.col(id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"),
        F.col(vector).cast("array<float>" if single else "array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = (
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite
        & F.exists("vector", lambda x: x != 0.0)
    )
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    classes = stage(
        rows.where("usable").groupBy("label", "vector")
        .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("size")),
        "classes",
    )
    caps = stage(
        classes.select(F.col("rep").alias("id"), "label", "vector", "size").mapInArrow(_filters(kind), _CAPS), "caps"
    )
    sent = caps.withColumn("filter", F.explode("filters")).drop("filters")
    large = stage(
        sent.groupBy("label", "filter").agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > ROWS)
        .select("label", "filter", F.ceil(F.col("rows") / ROWS).cast("int").alias("cuts")),
        "large",
    )
    cuts = F.coalesce("cuts", F.lit(1))
    sent = sent.join(large, ["label", "filter"], "left").withColumn("block", F.pmod(F.xxhash64("id"), cuts).cast("int"))
    sent = sent.withColumn("other", F.explode(F.sequence(F.lit(0), cuts - 1)))
    sent = sent.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", "cuts")
    key = ["label", "filter", "low", "high"]
    found = stage(
        sent.repartition(*key).sortWithinPartitions(*key).mapInArrow(_buckets(cosine, kind), _FOUND), "found"
    )
    linked = components(found.where("n is null").select("a", "b")).withColumnRenamed("node", "rep")
    counts = found.where("n is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    known = stage(
        classes.join(counts, "rep", "left").join(linked, "rep", "left").select(
            "label", "vector",
            (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        ),
        "known",
    )
    usable = rows.where("usable").join(known, ["label", "vector"])
    alone = rows.where("not usable").withColumns({"n_links": F.lit(0).cast("bigint"), "component_id": F.col("id")})
    columns = ["id", "n_links", "component_id"]
    return usable.select(*columns).unionByName(alone.select(*columns)).select(
        F.col("id").alias(id), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
