"""Near-duplicate documents by an LSH forest of MinHash signatures.

A document's set is its distinct shingles of ``shingle`` words (``[^\\x20\\x09-\\x0D]+``, A-Z in lower
case); a document with fewer words has its whole sequence as the only one, one without words has
none and is linked with nothing. Documents with equal sets are one class with its smallest id.

``TREES`` sorted orders of the classes, each by ``DEPTH`` signature values, are dealt by range, so
equal prefixes of any number spread over tasks. In an order the neighbours with the longest
common prefix are candidates: the next ``REGION`` - 1 that share ``LEAST`` values, less those that cannot
link by their sizes and the parities of their sets (see below). They come from as many
values deep as leave a region with ``REGION`` classes, so the depth is each region's own, and all
pairs of a region of that size are among them. Regions that stay larger to the last value are
also tied to their first row.

From the depths at which its regions have ``REGION`` classes follows a class's chance that the forest
misses a pair of it at the threshold. Classes with more than ``MISS`` are crowded (they share a template
below the threshold, say) and go through an exact join after the forest: shingles ordered by their
frequency among the crowded classes, rarest first, of two sets that link a prefix of the larger one,
``n - ceil(p n) + 1`` long, shares a shingle with a prefix of the smaller one, ``n - ceil(2 p n / (1 + p)) + 1``
long. Sets with few shingles of their own bring a shared template into their prefixes, so two bounds that no
pair that links can miss are part of the join: the places of the shingle in both orders leave enough
shingles behind it, and the sets' parities by 256 residues of the hash differ in no more places than the sets may
differ in shingles. Only pairs between the components that the forest left apart go on, and all of
them are compared on the full sets. Any order gives the same links, so frequencies are counted in a table
of fixed size.

Of the forest's candidates each class confirms its most frequent one on the full sets; those between the
components that result follow, unless the whole signatures put them more than five standard
deviations below the threshold. So a large group of copies costs a few confirmations for each copy.
Links have a Jaccard similarity of at least ``percent`` / 100, in whole numbers, on 64-bit hashes of the
shingles.

Rows: null text is empty; a null ``doc_id`` is linked with nothing and kept; rows that share an id
are one document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.arrays import FOLDED, Slice, mix, slices, word_hashes, words
from tidewatch.llm.components import LINKS, components
from tidewatch.staging import stage

TREES = 12
DEPTH = 8
LEAST = 3
REGION = 8
#: A class's chance to lose a pair at the threshold above which it is crowded.
MISS = 1e-3
#: Places of the table of frequencies.
BITS = 20
VALUES = TREES * DEPTH
#: Bytes of a key's values, and of what follows them: a set's parities and its size.
KEY, TAIL = 4 * DEPTH, 40
#: Documents of a written file, about, however many partitions a shuffle has.
FILE = 8000
#: Documents whose sets are compared at a time.
_ROWS = 256

_U = np.uint64
_SEEDS = mix(np.arange(1, 2 * VALUES + 1, dtype=_U) * _U(0xC2B2AE3D27D4EB4F))
_FLIP, _TIMES = _SEEDS[:VALUES], _SEEDS[VALUES:] | _U(1)
_PLACE = mix(np.arange(101, 165, dtype=_U)) | _U(1)


def shingles(part: Slice, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a slice and the range of each document."""
    found = words(part)
    one = word_hashes(part, found, FOLDED)
    counts = found.counts()
    width = np.minimum(counts, k)
    n = np.where(counts > 0, counts - width + 1, 0)
    offsets = np.concatenate(([0], np.cumsum(n)))
    start = np.arange(offsets[-1]) + np.repeat(found.offsets[:-1] - offsets[:-1], n)
    wide = np.repeat(width, n)
    total = np.zeros(len(start), _U)
    for j in range(k):
        use = wide > j
        total[use] += one[start[use] + j] * _PLACE[j]
    return mix(total + wide.astype(_U)), offsets


def _sets(column: pa.Array, k: int) -> list[np.ndarray]:
    out = []
    for part in slices(column):
        hashes, offsets = shingles(part, k)
        out += [np.unique(hashes[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return out


def _parities(sets: list[np.ndarray]) -> np.ndarray:
    """Whether the number of a set's hashes is odd, by 256 residues, as four numbers. Two sets differ in at least
    as many shingles as these differ in bits."""
    odd = np.array([np.bincount((x & _U(255)).astype(np.int64), minlength=256) & 1 for x in sets], np.uint8)
    return np.packbits(odd.reshape(-1, 256), axis=1).view(_U)


def _may_link(a: np.ndarray, b: np.ndarray, parity: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of rows may have the similarity, by their sizes and parities; no other can."""
    differ = np.bitwise_count(parity[a] ^ parity[b]).sum(axis=1, dtype=np.int64)
    both = n[a] + n[b]
    near = (100 + percent) * differ <= (100 - percent) * both
    return near & (100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b]))


def _sign(k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch["text"]):
                hashes, offsets = shingles(part, k)
                sets = [np.unique(hashes[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                n = np.array([len(x) for x in sets])
                low = np.zeros((len(part), VALUES), np.uint32)
                full = np.flatnonzero(n)
                marks = np.zeros((2, len(part)), _U)
                if len(full):
                    flat = np.concatenate(sets)
                    first = np.concatenate(([0], np.cumsum(n)))[full]
                    for j in range(VALUES):
                        low[full, j] = np.minimum.reduceat(((flat ^ _FLIP[j]) * _TIMES[j]) >> _U(32), first)
                    for j in range(2):
                        marks[j, full] = np.add.reduceat(mix(flat + _U(j)), first)
                yield pa.record_batch(
                    {
                        "doc_id": batch["doc_id"].slice(part.first, len(part)),
                        "n_shingles": pa.array(n, pa.int64()),
                        "one": marks[0].view(np.int64),
                        "two": marks[1].view(np.int64),
                        "signature": pa.array(
                            [
                                x.astype(">u4").tobytes() + odd.tobytes() + int(size).to_bytes(8, "little")
                                for x, odd, size in zip(low, _parities(sets), n, strict=True)
                            ],
                            pa.binary(),
                        ),
                    }
                )

    return work


def _neighbours(ends: bool, percent: int):
    """Candidates among sorted rows that may link by size and parities; with ``ends`` also the first and last rows of the partition, with
    their key, and the depth of rows whose region is larger than ``REGION`` at first, with an empty key."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rows = pa.Table.from_batches(got)
        tree, rep = rows["tree"].to_numpy(), rows["rep"].to_numpy()
        whole = rows["key"].to_pylist()
        raw = np.frombuffer(b"".join(whole), np.uint8).reshape(-1, KEY + TAIL)
        keys = np.ascontiguousarray(raw[:, :KEY]).view(">u4")
        parity, sizes = np.split(np.ascontiguousarray(raw[:, KEY:]).view(_U), [4], axis=1)
        sizes = sizes[:, 0].astype(np.int64)
        n = len(rep)
        same = np.cumprod(keys[1:] == keys[:-1], axis=1).sum(axis=1) * (tree[1:] == tree[:-1])
        # the next rows that share LEAST values, nearest first; all pairs of a small region are among them
        pairs, common = [], same
        for step in range(1, REGION):
            at = np.flatnonzero(common >= LEAST)
            pairs.append(np.stack((at, at + step)))
            common = np.minimum(common[:-1], same[step:])
        deep = np.full(n, DEPTH + 1)
        for depth in range(DEPTH, LEAST - 1, -1):
            region = np.concatenate(([0], np.cumsum(same < depth)))
            size = np.bincount(region)
            if ends:  # the other half of a region may be in the partition beside
                size[[0, -1]] *= 2
            deep[size[region] <= REGION] = depth
        head = np.concatenate(([True], same < DEPTH))
        head = np.flatnonzero(head)[np.cumsum(head) - 1]
        rest = np.flatnonzero((deep > DEPTH) & (head < np.arange(n)))
        pairs.append(np.stack((head[rest], rest)))
        a, b = np.concatenate(pairs, axis=1)
        near = _may_link(a, b, parity, sizes, percent)
        a, b = rep[a[near]], rep[b[near]]
        yield _candidates(np.minimum(a, b), np.maximum(a, b), None)
        if ends:
            edge = np.unique(np.concatenate((np.arange(min(n, REGION)), np.arange(max(0, n - REGION), n))))
            yield _candidates(rep[edge], tree[edge].astype(np.int64), [whole[i] for i in edge])
            some = np.flatnonzero(deep > LEAST)
            yield _candidates(rep[some], deep[some], [b""] * len(some))

    return work


def _candidates(a: np.ndarray, b: np.ndarray, key: list[bytes] | None) -> pa.RecordBatch:
    return pa.record_batch({"a": a, "b": b, "key": pa.array(key or [None] * len(a), pa.binary())})


def _confirm(k: int, percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(at, _ROWS)
                alike = []
                for x, y in zip(_sets(rows["text_a"], k), _sets(rows["text_b"], k), strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    alike.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                yield rows.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))

    return work


def _likely(percent: int):
    share = percent / 100
    least = VALUES * (share - 5 * math.sqrt(share * (1 - share) / VALUES))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(s[: 4 * VALUES] for s in batch[c].to_pylist()), ">u4").reshape(-1, VALUES)
                for c in ("sig_a", "sig_b")
            )
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= least))

    return work


def _beside(pairs: DataFrame, rows: DataFrame, value: str, name: str) -> DataFrame:
    """The pairs with a value of either side; merged, so that volume grows with the input alone."""
    for side in ("a", "b"):
        values = rows.select(F.col("id").alias(side), F.col(value).alias(f"{name}_{side}"))
        pairs = pairs.join(values.hint("merge"), side)
    return pairs


def _frequencies(k: int):
    """How many sets of a partition have a shingle in each place of the table."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for x in _sets(batch["text"], k):
                np.add.at(total, x >> _U(64 - BITS), 1)
        some = np.flatnonzero(total)
        for at in range(0, len(some), FILE):
            own = some[at : at + FILE]
            yield pa.record_batch({"place": pa.array(own, pa.int64()), "n": pa.array(total[own], pa.int64())})

    return work


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The table of a partition of places, in eighths of a power of two."""
    out = np.zeros(1 << BITS, np.uint8)
    for batch in batches:
        out[batch["place"].to_numpy()] = np.minimum(255, 8 * np.log2(1 + batch["n"].to_numpy()))
    yield pa.record_batch({"levels": pa.array([out.tobytes()], pa.binary())})


def _prefixes(k: int, percent: int, packed: bytes):
    """The prefix of each set with the places of its shingles, and the set's parities; ``first`` marks the
    part that a larger set's prefix must meet."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = np.frombuffer(packed, np.uint8)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(at, _ROWS)
                sets = _sets(rows["text"], k)
                n = np.array([len(x) for x in sets])
                long = n + percent * n // -100 + 1
                # sets are sorted by hash, so equal frequencies are in one order everywhere
                kept = [x[np.argsort(levels[x >> _U(64 - BITS)], kind="stable")][:m] for x, m in zip(sets, long, strict=True)]
                place = np.concatenate([np.arange(m) for m in long])
                row = np.repeat(np.arange(len(n)), long)
                parity = _parities(sets).view(np.int64)[row]
                yield pa.record_batch(
                    {
                        "token": pa.array(np.concatenate(kept).view(np.int64)),
                        "id": rows["id"].take(pa.array(row)),
                        "component": rows["component"].take(pa.array(row)),
                        "n": pa.array(n[row], pa.int64()),
                        "place": pa.array(place, pa.int64()),
                        **{f"odd{i}": pa.array(np.ascontiguousarray(parity[:, i])) for i in range(4)},
                        "first": pa.array(place < (n + 2 * percent * n // -(100 + percent) + 1)[row]),
                    }
                )

    return work


def crowded_pairs(texts: DataFrame, k: int, percent: int, files: int) -> DataFrame:
    """``a, b`` of all pairs between components that may link; ``texts`` has ``id, text, component``."""
    places = texts.select("text").mapInArrow(_frequencies(k), "place bigint, n bigint")
    places = places.groupBy("place").agg(F.sum("n").alias("n"))
    tables = places.coalesce(8).mapInArrow(_packed, "levels binary").collect()
    levels = np.zeros(1 << BITS, np.uint8)
    for r in tables:
        levels = np.maximum(levels, np.frombuffer(r.levels, np.uint8))
    odd = [f"odd{i}" for i in range(4)]
    columns = f"token bigint, id bigint, component bigint, n bigint, place bigint, {' bigint, '.join(odd)} bigint, first boolean"
    rows = stage(texts.mapInArrow(_prefixes(k, percent, levels.tobytes()), columns).coalesce(files), "prefixes")
    # a shingle within one component joins nothing, however many sets have it
    between = rows.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    between = between.where("low < high").select("token")
    rows = stage(rows.join(between.hint("merge"), "token", "left_semi").coalesce(files), "between")
    side = lambda name: [F.col("token"), *[F.col(c).alias(f"{c}_{name}") for c in ("id", "component", "n", "place", *odd)]]
    met = rows.select(*side("x")).join(rows.where("first").select(*side("y")), "token")
    smaller = F.struct("n_y", "id_y") < F.struct(F.col("n_x"), F.col("id_x"))
    both = F.col("n_x") + F.col("n_y")
    # a pair meets at its first common shingle too, and shares nothing before it
    behind = F.least(F.col("n_x") - F.col("place_x"), F.col("n_y") - F.col("place_y"))
    differ = sum(F.bit_count(F.col(f"{c}_x").bitwiseXOR(F.col(f"{c}_y"))) for c in odd)
    met = met.where(
        (F.col("component_x") != F.col("component_y")) & smaller & (100 * F.col("n_y") >= percent * F.col("n_x"))
        & ((100 + percent) * behind >= percent * both) & ((100 + percent) * differ <= (100 - percent) * both)
    )
    return met.select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct()


def candidates(reps: DataFrame, files: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``a, b, votes``: pairs of classes that are candidates in so many orders; ``id`` of crowded classes."""
    values = F.substring("signature", F.col("tree") * KEY + 1, F.lit(KEY))
    key = F.concat(values, F.substring("signature", 4 * VALUES + 1, TAIL))
    orders = reps.select("rep", "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    orders = orders.select("tree", key.alias("key"), "rep")
    parts = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = "a bigint, b bigint, key binary"
    found = stage(
        orders.repartitionByRange(parts, "tree", "key", "rep")
        .sortWithinPartitions("tree", "key", "rep")
        .mapInArrow(_neighbours(True, percent), columns)
        .coalesce(files),
        "neighbours",
    )
    # the ends of all partitions, a few rows of each: neighbours across a cut
    ends = found.where("length(key) > 0").select(F.col("b").cast("int").alias("tree"), "key", F.col("a").alias("rep"))
    across = ends.coalesce(1).sortWithinPartitions("tree", "key", "rep").mapInArrow(_neighbours(False, percent), columns)
    pairs = found.where("key is null").unionByName(across)
    lost = [math.log1p(-((min(percent, 99) / 100) ** d)) for d in range(LEAST, DEPTH + 1)] + [0.0]
    more = F.element_at(F.array(*[F.lit(x - lost[0]) for x in lost]), (F.col("b") - LEAST + 1).cast("int"))
    crowded = (
        found.where("length(key) = 0").groupBy(F.col("a").alias("id")).agg(F.sum(more).alias("more"))
        .where(F.col("more") + TREES * lost[0] > math.log(MISS)).select("id")
    )
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("votes")), crowded


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of all rows; of a component the smallest id is kept."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stage(
        docs.mapInArrow(_sign(shingle), "doc_id bigint, n_shingles bigint, one bigint, two bigint, signature binary"),
        "signed",
    )
    files = -(-signed.count() // FILE) or 1
    written = lambda df, name: stage(df.coalesce(files), name)
    sets = ["n_shingles", "one", "two"]
    classes = written(
        signed.where("doc_id is not null and n_shingles > 0")
        .groupBy(*sets).agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature")),
        "classes",
    )
    pairs, crowded = candidates(classes.select("rep", "signature"), files, percent)
    pairs, crowded = written(pairs, "pairs"), written(crowded, "crowded")

    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "votes"))
    ids = both.select(F.col("a").alias("id")).unionByName(crowded).distinct()
    texts = written(docs.withColumnRenamed("doc_id", "id").join(ids.hint("merge"), "id", "left_semi"), "texts")
    confirmed = lambda some: _beside(some, texts, "text", "text").mapInArrow(_confirm(shingle, percent), LINKS)
    best = both.groupBy("a").agg(F.max_by("b", F.struct("votes", F.xxhash64("a", "b"))).alias("b"))
    best = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = written(confirmed(best), "links")

    label = written(components(links), "labels").select(F.col("node").alias("id"), "component")
    open_pairs = pairs.select("a", "b")
    for side in ("a", "b"):
        open_pairs = open_pairs.join(
            label.select(F.col("id").alias(side), F.col("component").alias(f"in_{side}")), side, "left"
        )
    apart = F.coalesce("in_a", "a") != F.coalesce("in_b", "b")
    open_pairs = open_pairs.where(apart).select("a", "b").join(best, ["a", "b"], "left_anti")
    signatures = classes.select(F.col("rep").alias("id"), "signature")
    linked = lambda some: written(
        confirmed(written(_beside(some, signatures, "signature", "sig").mapInArrow(_likely(percent), LINKS), "likely")),
        "links",
    )
    links = links.unionByName(linked(open_pairs))

    if crowded.head(1):
        label = written(components(links), "labels").select(F.col("node").alias("id"), "component")
        crowd = crowded.join(label, "id", "left").withColumn("component", F.coalesce("component", "id"))
        crowd = texts.select("id", "text").join(crowd.hint("merge"), "id")
        met = written(crowded_pairs(crowd, shingle, percent, files), "met")
        links = links.unionByName(written(confirmed(met), "links"))

    found = components(links).select(F.col("node").alias("rep"), "component")
    known = written(
        classes.select(*sets, "rep").join(found, "rep", "left")
        .select(*sets, F.coalesce("component", "rep").alias("component")),
        "known",
    )
    component = F.coalesce("component", "doc_id")
    return signed.drop("signature").join(known, sets, "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
