"""Connected components of a link table, by alternating stars.

Links are first thinned to a forest inside each task. Then two steps alternate until nothing
changes: every node hands its larger neighbours to the smallest node that it knows, and every
node's smaller neighbours meet at the smallest of them. The number of rounds grows with the
logarithm of the number of nodes. Tables of a round are written to the shared folder, so that a
lost executor repeats one step only and a node with very many links is split by adaptive joins. They
have one file for about ``ROWS`` links, however many partitions a shuffle has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.staging import stage

LINKS = "a bigint, b bigint"
#: Links of a file.
ROWS = 100_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(node, smallest node of its component)`` for all nodes but the smallest ones."""
    nodes, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    label = np.arange(len(nodes))
    x, y = place[: len(a)], place[len(a) :]
    while len(x):
        low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
        apart = low != high
        if not apart.any():
            break
        x, y = x[apart], y[apart]
        np.minimum.at(label, high[apart], low[apart])
        while (label != (label := label[label])).any():
            pass
    rest = label != np.arange(len(nodes))
    return nodes[rest], nodes[label[rest]]


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a = b = np.zeros(0, np.int64)
    for batch in batches:
        a, b = forest(np.concatenate((a, batch["a"].to_numpy())), np.concatenate((b, batch["b"].to_numpy())))
    yield pa.record_batch({"a": a, "b": b})


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of all nodes that have a link."""
    links = links.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b"))
    links = stage(links.where("a <> b").mapInArrow(_thin, LINKS).distinct(), "links")
    before = _trace(links)
    files = -(-before[0] // ROWS) or 1
    while True:
        links = _small_star(_large_star(links, files), files)
        after = _trace(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )


def _trace(links: DataFrame) -> tuple:
    """A number that tells whether the links have changed."""
    mark = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(mark)).head())


def _large_star(links: DataFrame, files: int) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("low")).coalesce(files), "least")
    moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return stage(moved.where("a <> b").distinct().coalesce(files), "links")


def _small_star(links: DataFrame, files: int) -> DataFrame:
    least = stage(links.groupBy("a").agg(F.min("b").alias("low")).coalesce(files), "least")
    met = links.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    own = least.select("a", F.col("low").alias("b"))
    return stage(met.unionByName(own).distinct().coalesce(files), "links")
