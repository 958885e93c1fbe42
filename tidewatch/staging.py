"""Intermediate tables on shared storage, and row numbering without a global sort.

Steps that several later steps read (edges, walk levels, detections) are written once as
Parquet and read back. That cuts the lineage, survives the loss of any executor, and gives
the planner true sizes, so it can choose a broadcast join where one fits.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

#: Where the folders made meanwhile are noted down, if anyone asked for it.
_NOTED: ContextVar[list[str] | None] = ContextVar("noted", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Only a local session may name
    none; it stages beside its warehouse."""
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(named or spark.conf.get("spark.sql.warehouse.dir") + "/_staged")
        folder = context.getCheckpointDir()
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    noted = _NOTED.get()
    if noted is not None:
        noted.append(folder)
    return folder


@contextmanager
def noting(folders: list[str]) -> Iterator[None]:
    """Add the name of every folder made inside to ``folders``."""
    token = _NOTED.set(folders)
    try:
        yield
    finally:
        _NOTED.reset(token)


class step(cached_property):
    """A table of a `Staged` object that is built once; folders staged for it are the object's."""

    def __get__(self, owner, kind=None):
        if owner is None:
            return self
        with noting(owner.folders):
            return super().__get__(owner, kind)


class Staged:
    """Something that builds tables step by step and deletes what it staged when it is closed."""

    def __init__(self) -> None:
        self.folders: list[str] = []

    def close(self) -> None:
        """Delete the staged tables. What was written elsewhere or collected stays."""
        while self.folders:
            drop_folder(SparkSession.active(), self.folders.pop())

    def __enter__(self):
        return self

    def __exit__(self, *_) -> None:
        self.close()


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def move_folder(spark: SparkSession, folder: str, target: str) -> None:
    """Put ``folder`` in the place of ``target``, whose files go."""
    drop_folder(spark, target)
    path, to = map(spark._jvm.org.apache.hadoop.fs.Path, (folder, target))
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).rename(path, to):
        raise OSError(f"{folder} could not be renamed to {target}")


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the queries that run inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def shuffles_freed(spark: SparkSession):
    """Queries that run inside delete their shuffle files as they end, not when the driver happens to collect its
    garbage. None of them should be run a second time from the same DataFrame."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def write_stage(df: DataFrame, name: str) -> str:
    """Write ``df`` to a new folder and return the folder."""
    folder = new_folder(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(folder)
    return folder


def read_stage(spark: SparkSession, schema: StructType, *folders: str) -> DataFrame:
    """The staged rows of one or more folders as a single scan."""
    return spark.read.schema(schema).parquet(*folders)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads it back."""
    return read_stage(df.sparkSession, df.schema, write_stage(df, name))


def together(*steps: Callable[[], object]) -> None:
    """Run independent steps at the same time, so that one step's last tasks and its planning
    do not leave the cluster idle."""
    session = SparkSession.active()
    # wrapped one by one, or all would share, and Spark would overwrite, one set of local properties
    own = [inheritable_thread_target(session)(step) for step in steps]
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        for done in [pool.submit(copy_context().run, step) for step in own]:
            done.result()


def ranged(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` staged in ranges of a total order, the number of the range in ``_slot``.

    Running results over a long group are taken range by range and carried over, so that no
    task holds a group. The rows are staged twice: before ranging, which reads them for its
    sample and again, and after, so that all later steps see the same ranges even if a task
    is run again.
    """
    placed = stage(df, "unranged").repartitionByRange(*order).withColumn("_slot", F.spark_partition_id())
    return stage(placed, "ranged")


def number_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``name`` = 1, 2, 3 ... in the given total order.

    A window without a partition key would pull every row into one task. Here the rows are
    ranged, each range numbers its own rows, and only one count per range is summed up.
    """
    rows = ranged(df, *order)
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_slot")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_slot", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy("_slot").orderBy(*order)
    return (
        rows.withColumn("_rank", F.row_number().over(within))
        .join(offsets, "_slot")
        .withColumn(name, F.col("_offset") + F.col("_rank"))
        .drop("_slot", "_offset", "_rank")
    )
