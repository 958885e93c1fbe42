"""The prefix trie of conversations: every distinct beginning, who shares it, and what sharing saves.

A turn is 16 bytes of hash of its role and text, a conversation's path the bytes of its turns in
order, so beginnings are prefixes of paths and the order of paths keeps each subtree together.
Texts do not move; a path carries the number of words of each turn.

* Splitters are chosen from a sample of paths. The prefixes of the splitters are the skeleton, a
  small trie that travels with the function to all tasks. Rows go to the shard between two splitters
  by (path, id), so a conversation that very many have is cut as well.
* A node that is no prefix of a splitter lies in one shard. Each shard reads its rows in order,
  keeps the nodes of the present path open and finishes them when the path leaves them.
* A skeleton node may lie in many shards. Each adds a partial aggregate: members, smallest member,
  finished children, and what these hold. Partials are summed by node, and the sums are carried up to
  the skeleton's ancestors; finished nodes below the skeleton get its smallest members.

The trie exact but for equal 128-bit hashes. A digest of the ids that end at a node reads them in order,
in pieces, in one task, as such a hash is defined; everything else of a hot node is spread.

Rows: null role or text is empty; null turns come first, rows of one conversation and turn in the order of
their hash; rows without a ``conv_id`` are no conversation; a row that is repeated is a turn of its own. Very
long texts are hashed only. An empty table has no trie, not even a root. Extra columns are not read.
Memory: the turns of the longest conversation at 24 bytes each, and in a shard the finished children of
one node, at most `SHARD_TURNS`.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.staging import stage

#: Bytes of a turn in a path.
TURN = 16
#: Turns that a shard gets, about, where there are more than the session's partitions need.
SHARD_TURNS = 2_000_000
#: Paths looked at to choose splitters: so many, or so many for each shard if that is more.
SAMPLE, SAMPLE_A_SHARD = 20_000, 4
#: A splitter is the beginning of a path up to so many turns; all together take so many bytes at most.
SPLITTER_TURNS, SKELETON_BYTES = 64, 64 << 20
#: Ids of a skeleton node leave a shard in pieces of about so many characters.
PIECE = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"

PATHS = "conv_id bigint, path binary, words array<bigint>"
FOUND = (
    "node binary, below binary, shard int, piece int, conv_id bigint, depth bigint, parent_conv_id bigint,"
    " n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, words bigint, ends string"
)
_TYPES = {"binary": pa.binary(), "int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
_SCHEMA = pa.schema([(n, _TYPES[t]) for n, t in (x.split() for x in FOUND.split(","))])
_NO_IDS = hashlib.sha256(b"").hexdigest()


def paths(conversations: DataFrame) -> DataFrame:
    """``conv_id, path, words``: each conversation's turns in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("key"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    )
    return (
        conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("turn"))
        .filter("conv_id is not null")
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
        .select(
            "conv_id",
            F.unhex(F.array_join("turns.key", "")).alias("path"),
            F.col("turns.words").alias("words"),
        )
    )


def grafted(own: DataFrame, every: int = 20, at_most: int = 4) -> DataFrame:
    """Conversations that begin as another one does: the first h turns are those of the conversation
    ``conv_id - conv_id % every``, as far as there are any, h being the id's checksum modulo ``at_most``."""
    taken = F.pmod(F.crc32(F.encode(F.col("conv_id").cast("string"), "utf-8")), F.lit(at_most)).cast("int")
    heads = own.filter(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("head"),
        F.substring("path", 1, TURN * (at_most - 1)).alias("head_path"),
        F.slice("words", 1, at_most - 1).alias("head_words"),
    )
    return (
        own.withColumn("head", F.col("conv_id") - F.col("conv_id") % every)
        .withColumn("h", taken)
        .join(heads, "head", "left")
        .selectExpr(
            "conv_id",
            f"concat(substring(coalesce(head_path, x''), 1, {TURN} * h), substring(path, {TURN} * h + 1)) as path",
            "concat(slice(coalesce(head_words, array()), 1, h), slice(words, h + 1, size(words))) as words",
        )
    )


class Skeleton:
    """The splitters, and the trie of their prefixes."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))

    def nodes(self) -> set[bytes]:
        return {b""} | {p[: TURN * d] for p, _ in self.splitters for d in range(1, len(p) // TURN + 1)}


def skeleton_of(rows: DataFrame) -> Skeleton:
    """Splitters for about as many rows in each shard."""
    count, turns = rows.agg(F.count(F.lit(1)), F.sum(F.size("words"))).head()
    shards = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), (turns or 0) // SHARD_TURNS)
    wanted = max(SAMPLE, SAMPLE_A_SHARD * shards)
    some = rows if count <= wanted else rows.filter(F.pmod(F.xxhash64("conv_id"), F.lit(-(-count // wanted))) == 0)
    seen = sorted(
        (bytes(r[0]), r[1]) for r in some.select(F.substring("path", 1, TURN * SPLITTER_TURNS), "conv_id").collect()
    )
    chosen = sorted({seen[len(seen) * i // shards] for i in range(1, shards)}) if seen else []
    while sum(len(p) for p, _ in chosen) > SKELETON_BYTES:
        chosen = chosen[1::2]
    return Skeleton(chosen)


class _Node:
    """A node that is open: members may still come."""

    __slots__ = ("key", "words", "least", "members", "children", "leaves", "saved", "done", "ended", "pieces")

    def __init__(self, key: bytes | None, words: int):
        self.key = key  # of a skeleton node
        self.words = words
        self.least = None
        self.members = self.children = self.leaves = self.saved = self.pieces = 0
        self.done: list[tuple] = []
        self.ended = None

    def meet(self, conv_id: int, members: int) -> None:
        self.members += members
        if self.least is None or conv_id < self.least:
            self.least = conv_id


class _Shard:
    """Reads the rows of a shard in order and finishes its nodes."""

    def __init__(self, skeleton: Skeleton):
        self.nodes = skeleton.nodes()
        self.out: list[tuple] = []
        self.shard = 0
        self.path = b""
        self.open: list[_Node] = []

    def row(self, shard: int, conv_id: int, path: bytes, words: list[int]) -> None:
        if not self.open or shard != self.shard:
            self.leave(0)
            self.shard = shard
            self.open = [_Node(b"", 0)]
            self.path = b""
        same, last = 0, min(len(path), len(self.path))
        while same < last and path[same : same + TURN] == self.path[same : same + TURN]:
            same += TURN
        self.leave(same // TURN + 1)
        for d in range(len(self.open), len(path) // TURN + 1):
            key = path[: TURN * d] if self.open[-1].key is not None else None
            self.open.append(_Node(key if key in self.nodes else None, words[d - 1]))
        self.path = path
        node = self.open[-1]
        node.meet(conv_id, 1)
        if node.key is None:
            if node.ended is None:
                node.ended = hashlib.sha256(b"%d" % conv_id)
            else:
                node.ended.update(b",%d" % conv_id)
            return
        node.ended = [] if node.ended is None else node.ended
        node.ended.append(str(conv_id))
        if len(node.ended) >= PIECE >> 3:
            self.piece(node)

    def piece(self, node: _Node) -> None:
        if node.ended:
            ends = ",".join(node.ended)
            self.out.append((node.key, None, self.shard, node.pieces, *[None] * 8, ends))
            node.pieces += 1
            node.ended = []

    def leave(self, depth: int) -> None:
        """Close the open nodes of ``depth`` and more turns."""
        while len(self.open) > depth:
            node, at = self.open.pop(), len(self.open)
            parent = self.open[-1] if self.open else None
            if node.key is not None:
                self.piece(node)
                self.out.append((
                    node.key, None, self.shard, None, node.least, at, None, node.members, node.children, node.leaves,
                    node.saved, node.words, None,
                ))
            else:
                leaves = node.leaves if node.children else 1
                saved = node.saved + (node.members - 1) * node.words
                ends = node.ended.hexdigest() if node.ended is not None else _NO_IDS
                made = (node.least, at, node.members, node.children, leaves, saved, ends)
                parent.children += 1
                parent.leaves += leaves
                parent.saved += saved
                if parent.key is None:
                    parent.done.append(made)
                else:
                    self.finish(made, None, self.path[: TURN * (at - 1)])
                for child in node.done:
                    self.finish(child, node.least, None)
            if parent is not None:
                parent.meet(node.least, node.members)

    def finish(self, made: tuple, parent: int | None, below: bytes | None) -> None:
        conv_id, depth, members, children, leaves, saved, ends = made
        self.out.append((None, below, None, None, conv_id, depth, parent, members, children, leaves, saved, None, ends))

    def taken(self) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(self.out), 10_000):
            columns = zip(*self.out[at : at + 10_000], strict=True)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)
        self.out = []


def _dealt(rows: DataFrame, skeleton: Skeleton) -> DataFrame:
    """The rows with the number of their shard."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch["path"].to_pylist(), batch["conv_id"].to_pylist(), strict=True)
            yield batch.append_column("shard", pa.array([skeleton.shard(*k) for k in keys], pa.int32()))

    return rows.mapInArrow(work, f"{PATHS}, shard int")


def _finished(rows: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Finished nodes, and partial aggregates of skeleton nodes, of all shards."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(skeleton)
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("shard", "conv_id", "path", "words")), strict=True):
                shard.row(*row)
            yield from shard.taken()
        shard.leave(0)
        yield from shard.taken()

    return (
        _dealt(rows, skeleton)
        .repartitionById(len(skeleton.splitters) + 1, F.col("shard"))
        .sortWithinPartitions("path", "conv_id")
        .mapInArrow(work, FOUND)
    )


def _digests(pieces: DataFrame) -> DataFrame:
    """``node, ends_sha256``: pieces of ids are read in order, never a node's together."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def row() -> pa.RecordBatch:
            return pa.record_batch({"node": pa.array([node], pa.binary()), "ends_sha256": pa.array([digest.hexdigest()])})

        for batch in batches:
            for key, ends in zip(batch["node"].to_pylist(), batch["ends"].to_pylist(), strict=True):
                if digest is None or key != node:
                    if digest is not None:
                        yield row()
                    node, digest = key, hashlib.sha256(ends.encode())
                else:
                    digest.update(b"," + ends.encode())
        if digest is not None:
            yield row()

    return pieces.repartition("node").sortWithinPartitions("node", "shard", "piece").select("node", "ends").mapInArrow(
        work, "node binary, ends_sha256 string"
    )


def _above(node: Column, depth: Column) -> Column:
    """The node itself and all beginnings of it."""
    return F.transform(F.sequence(F.lit(0).cast("bigint"), depth), lambda d: node.substr(F.lit(1), (d * TURN).cast("int")))


def _reduced(found: DataFrame) -> DataFrame:
    """The skeleton's nodes, their partial aggregates put together."""
    partial = found.filter("node is not null and piece is null")
    nodes = stage(
        partial.groupBy("node", "depth").agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
            F.sum("n_children").alias("finished"), F.sum("n_leaves").alias("leaves"),
            F.sum("saved_tokens").alias("saved"), F.max("words").alias("words"),
        ),
        "skeleton",
    )
    parent = F.col("node").substr(F.lit(1), ((F.col("depth") - 1) * TURN).cast("int"))
    inner = nodes.filter("depth > 0").groupBy(parent.alias("node")).agg(F.count(F.lit(1)).alias("inner"))
    known = nodes.join(inner, "node", "left").withColumn(
        "n_children", F.col("finished") + F.coalesce("inner", F.lit(0))
    )
    rolled = (
        known.select(
            F.explode(_above(F.col("node"), F.col("depth"))).alias("node"),
            F.when(F.col("n_children") == 0, 1).otherwise(F.col("leaves")).cast("bigint").alias("leaves"),
            (F.col("saved") + (F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        )
        .groupBy("node")
        .agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    )
    parents = nodes.select(F.col("node").alias("_above"), F.col("conv_id").alias("parent_conv_id"))
    return (
        known.select("node", "depth", "conv_id", "n_convs", "n_children")
        .join(rolled, "node")
        .join(_digests(found.filter("piece is not null")), "node", "left")
        .withColumn("_above", F.when(F.col("depth") > 0, parent))
        .join(parents, "_above", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_IDS)))
        .select("node", *RESULT)
    )


RESULT = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
)


def trie(rows: DataFrame) -> DataFrame:
    """One row for each node of the trie of ``conv_id, path, words``, as `paths` makes them.

    ``conv_id`` is the smallest member, ``n_convs`` counts members, ``n_leaves`` the childless nodes of the
    subtree, ``saved_tokens`` the words that need not be stored again below, the node's own turn included;
    ``ends_sha256`` is the digest of the ids that end here.
    """
    rows = stage(rows.select("conv_id", "path", "words"), "paths")
    found = stage(_finished(rows, skeleton_of(rows)), "trie")
    top = stage(_reduced(found), "trie-top")
    # as many rows as the skeleton has nodes at most, and so bounded by its splitters
    ends = F.broadcast(top.select(F.col("node").alias("below"), F.col("conv_id").alias("_parent")))
    rest = (
        found.filter("node is null")
        .join(ends, "below", "left")
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_parent"))
        .withColumnRenamed("ends", "ends_sha256")
    )
    return rest.select(*RESULT).unionByName(top.select(*RESULT))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are."""
    return trie(paths(conversations))
