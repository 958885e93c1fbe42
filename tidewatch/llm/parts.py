"""Repeated keys across a large table, found by an exchange that answers the sender.

Documents are dealt into parts (the splits they were read in) and written once as a table
bucketed by part, so that every later pass over the texts runs where a part is read and moves no
text. In a pass each part works out its keys (hashes of stretches of text), drops its own
repetitions and sends them, sorted and packed, to the block that owns their range. A block
merges what the parts sent and returns one bit for each key to the part that sent it. Traffic is
a few bytes for each key, no block depends on how often a key occurs, and a hot key reaches
its block once for each part.

Memory: a part holds the hashes of a split of about ``PART_BYTES`` of files, a block about ``BLOCK`` keys.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.staging import new_folder, stage

#: Keys that a block receives, about.
BLOCK = 1 << 20
LEAST_BLOCKS = 64
#: Larger splits are cut into several parts.
PART_BYTES = 8 << 20
#: A document without an id comes after all others.
NO_ID = np.iinfo(np.int64).max

SENT = "part int, block int, sent binary"
ANSWER = "part int, kind string, block int, bits binary"


def deal(docs: DataFrame, *more: Column) -> DataFrame:
    """``part, doc_id, text`` and ``more`` of all rows, written in buckets of ``part``."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"dealt_{uuid.uuid4().hex}"
    cuts = -(-_split_bytes(spark) // PART_BYTES)
    (
        docs.select(
            (F.spark_partition_id() * cuts + F.pmod(F.xxhash64("doc_id"), F.lit(cuts))).cast("int").alias("part"),
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.col("text").cast("string").alias("text"),
            *more,
        )
        .write.bucketBy(buckets, "part")
        .option("path", new_folder(spark, "dealt"))
        .option("compression", "zstd")
        .saveAsTable(name)
    )
    return spark.table(name)


def _split_bytes(spark: SparkSession) -> int:
    size = spark.conf.get("spark.sql.files.maxPartitionBytes").lower().rstrip("b")
    unit = {"k": 10, "m": 20, "g": 30}.get(size[-1:], 0)
    return int(size.rstrip("kmg")) << unit


def text_bytes(parts: DataFrame) -> int:
    return parts.agg(F.sum(F.octet_length("text"))).head()[0] or 0


def blocks_for(keys: float) -> int:
    """A power of two of blocks for about so many keys."""
    return max(LEAST_BLOCKS, 1 << max(0, int(np.ceil(np.log2(max(1, keys) / BLOCK)))))


def column(table: pa.Table, name: str) -> pa.Array:
    whole = table[name].combine_chunks()
    return whole.combine_chunks() if isinstance(whole, pa.ChunkedArray) else whole


def ids(table: pa.Table) -> np.ndarray:
    return column(table, "doc_id").fill_null(int(NO_ID)).to_numpy()


def part_of(table: pa.Table) -> int:
    return table["part"][0].as_py()


def pack(part: int, block: np.ndarray, blocks: int, *columns: np.ndarray) -> pa.Table:
    """One row for each block that gets keys; ``block`` is ascending, as the columns are sorted."""
    edge = np.searchsorted(block, np.arange(blocks + 1))
    used = np.flatnonzero(edge[1:] > edge[:-1])
    sent = [b"".join(x[edge[b] : edge[b + 1]].tobytes() for x in columns) for b in used]
    return pa.table(
        {
            "part": pa.array(np.full(len(used), part), pa.int32()),
            "block": pa.array(used, pa.int32()),
            "sent": pa.array(sent, pa.binary()),
        }
    )


def unpack(sent: bytes, *types: type) -> list[np.ndarray]:
    n = len(sent) // sum(np.dtype(t).itemsize for t in types)
    out, at = [], 0
    for t in types:
        out.append(np.frombuffer(sent, t, n, at))
        at += n * np.dtype(t).itemsize
    return out


def answered(table: pa.Table, kind: str, bits: list[np.ndarray]) -> pa.Table:
    """The rows of ``answer`` for what the rows of ``table`` sent."""
    n = table.num_rows
    return pa.table(
        {
            "part": column(table, "part"),
            "kind": pa.array([kind] * n, pa.string()),
            "block": column(table, "block"),
            "bits": pa.array([np.packbits(x).tobytes() for x in bits], pa.binary()),
        }
    )


def ask(sent: DataFrame, judge: Callable[[pa.Table], pa.Table], name: str) -> DataFrame:
    """Let each block judge what it was sent; the answers are staged."""
    return stage(sent.groupBy("block").applyInArrow(judge, ANSWER), name)


def bits_for(answers: pa.Table, kind: str, block: np.ndarray) -> np.ndarray:
    """The answers of a kind to keys that were sent in the order of ``block``."""
    out = np.zeros(len(block), bool)
    rows = [(b, bits) for k, b, bits in zip(*(answers[c].to_pylist() for c in ("kind", "block", "bits")), strict=True) if k == kind]
    places = np.array([b for b, _ in rows], block.dtype)
    first, last = (np.searchsorted(block, places, side).tolist() for side in ("left", "right"))
    for (_, bits), a, b in zip(rows, first, last, strict=True):
        out[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).view(bool)
    return out


def each_part(
    parts: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str,
    answers: DataFrame | None = None,
) -> DataFrame:
    """``work(documents of a part, answers to it)`` for every part that has documents."""
    if answers is None:
        return parts.groupBy("part").applyInArrow(lambda docs: work(docs, None), schema)

    def both(docs: pa.Table, got: pa.Table) -> pa.Table:
        return work(docs, got) if docs.num_rows else empty_of(schema)

    return (
        parts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(both, schema)
    )


_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def empty_of(schema: str) -> pa.Table:
    fields = [x.split() for x in schema.split(", ")]
    return pa.schema([(n, _ARROW[t]) for n, t in fields]).empty_table()


def distinct(*keys: np.ndarray, most: Iterable[np.ndarray] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by the keys (``most``: further sort columns), and which of the ordered rows
    begins a new key. Only rows whose first key is not unique are sorted by the others."""
    order = np.argsort(keys[0])
    new = np.ones(len(order), bool)
    ranked = keys[0][order]
    new[1:] = ranked[1:] != ranked[:-1]
    shared = np.flatnonzero(~new)
    if len(shared):
        tied = ~new
        tied[shared - 1] = True
        rows = order[tied]
        order[tied] = rows[np.lexsort([k[rows] for k in reversed((*keys, *most))])]
        for k in keys[1:]:
            k = k[order]
            new[1:] |= k[1:] != k[:-1]
    return order, new
