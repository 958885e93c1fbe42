"""Documents packed into sequences of a fixed number of tokens, in as few as can be found.

Each document is tokenized once where it is read and ends with a separator; only documents longer than a
sequence are cut, into whole sequences and a first piece that may be shorter. A task writes one row for each
piece, with the number of the piece among those of its length in the task. The table of lengths, at
most as many numbers as a sequence has tokens, is all that the driver sees: `bin_completion` finds
fillings for it, and how many sequences get each. The n-th piece of a length then finds its sequence and
place by its number. Neither texts nor tokens are shuffled, and the packing is one over all documents.

A whole sequence of its own gets a negative number and takes no part in the search.

Rows: a null text is empty, and an empty text is its separator alone; every row is a document, ids may be
null or repeated; a very long text is one row in memory, and its pieces come in batches. Pieces of equal
length are taken as they come. An empty table has no sequences. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.llm import bin_completion
from tidewatch.llm.byte_bpe import Encoder
from tidewatch.staging import stage

#: Pieces in a batch that a task hands on.
BATCH = 4096
#: Tasks' pieces of a length are numbered in their order; a task has fewer pieces than this of any length.
_TASK = 1 << 40

PIECES = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, task bigint, number bigint"
)
RESULT = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def cuts(length: int, capacity: int) -> Iterator[tuple[int, int]]:
    """Start and length of each piece; only the first may be shorter than ``capacity``."""
    at = 0
    while at < length:
        size = length if length <= capacity else (length - at) % capacity or capacity
        yield at, size
        at += size


def pieces(docs: DataFrame, model_file: str, capacity: int, separator: int, keep_ids: bool) -> DataFrame:
    """One row for each piece of a document, staged."""
    end = separator.to_bytes(4, "little")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = Encoder(model_file), TaskContext.get().partitionId()
        seen: list[int] = [0] * (capacity + 1)
        rows: list[tuple] = []

        def taken() -> pa.RecordBatch:
            done = list(zip(*rows, strict=True)) or [()] * 7
            rows.clear()
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
            made = [pa.array(x, k) for x, k in zip(done, kinds, strict=True)]
            made.insert(6, pa.array(np.full(len(made[0]), task), pa.int64()))
            return pa.record_batch(made, names=[x.split()[0] for x in PIECES.split(", ")])

        for batch in batches:
            doc_ids = batch["doc_id"].to_pylist()
            for doc_id, ids in zip(doc_ids, encode.documents(batch["text"]), strict=True):
                ids += end
                for piece, (start, size) in enumerate(cuts(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + size)]
                    rows.append((doc_id, piece, start, size, zlib.crc32(own), own if keep_ids else None, seen[size]))
                    seen[size] += 1
                    if len(rows) >= BATCH:
                        yield taken()
        yield taken()

    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(read.mapInArrow(work, PIECES), "pieces")


class Places:
    """Where the n-th piece of each length goes."""

    def __init__(self, packing: bin_completion.Packing):
        found: dict[int, list[tuple[int, int, int, int]]] = {}
        given: dict[int, int] = {}
        first = 0
        for filling, bins in packing:
            at = 0
            for size in sorted(set(filling), reverse=True):
                each = filling.count(size)
                found.setdefault(size, []).append((given.get(size, 0), first, each, at))
                given[size] = given.get(size, 0) + bins * each
                at += each * size
            first += bins
        self.of = {size: np.array(rows, np.int64).T for size, rows in found.items()}

    def __call__(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for size in np.unique(length).tolist():
            mine = length == size
            begin, first, each, at = self.of[size]
            row = np.searchsorted(begin, number[mine], "right") - 1
            turn, place = np.divmod(number[mine] - begin[row], each[row])
            sequence[mine], offset[mine] = first[row] + turn, at[row] + place * size
        return sequence, offset


def pack(
    docs: DataFrame, model_file: str, capacity: int = 2048, separator: int = 0, keep_ids: bool = False
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, and ``ids`` if they are kept.

    ``start`` is the number of the document's ids before the piece, ``offset`` its place in the sequence.
    """
    cut = pieces(docs, model_file, capacity, separator, keep_ids)
    result = [*RESULT, *(["ids"] if keep_ids else [])]
    whole = cut.filter(F.col("length") == capacity).select(
        *[c for c in result if c not in ("sequence_id", "offset")],
        (-1 - F.col("task") * F.lit(_TASK) - F.col("number")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"),
    )
    part = cut.filter(F.col("length") < capacity)
    sizes = stage(part.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "piece-lengths")
    # at most one row for each length below the capacity
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(bin_completion.complete(counts, capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    earlier = sizes.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    kinds = {f.name: f.dataType.simpleString() for f in cut.schema.fields}
    schema = ", ".join(f"{c} {kinds.get(c, 'bigint')}" for c in result)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places(batch["length"].to_numpy(), batch["number"].to_numpy())
            made = {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
            yield pa.record_batch({c: made[c] if c in made else batch[c] for c in result})

    numbered = part.join(earlier, ["task", "length"]).withColumn("number", F.col("earlier") + F.col("number"))
    return numbered.select(*[c for c in kinds]).mapInArrow(placed, schema).unionByName(whole)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, length, ids``: the token ids of each sequence, of a packing that kept them."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")).select(
        "sequence_id", "length", F.unhex(F.array_join("parts.ids", "")).alias("ids")
    )
