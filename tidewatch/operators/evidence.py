"""Id lists of a detection, in numbered parts of bounded size.

A path has a handful of ids, but a device or an account may have any number, and an array is
built in one task. A detection with n ids has ceil(n / ``PART``) parts; an id belongs to the part
that a hash of it names, so parts hold about as many ids each, and a list is never missing or
cut. Most detections have one part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = 1000


def in_parts(
    members: DataFrame, detections: DataFrame, key: str, size: str, member: str, part: int = PART
) -> DataFrame:
    """``members`` with ``part``, the number of the part, from 0, and ``parts`` of its detection.

    Only detections of several parts are looked up; they are at most one for ``part`` members.
    """
    large = detections.filter(F.col(size) > part).select(
        key, F.ceil(F.col(size) / F.lit(part)).cast("int").alias("parts")
    )
    parts = F.coalesce("parts", F.lit(1))
    return members.join(large, key, "left").withColumns(
        {"part": F.pmod(F.xxhash64(member), parts).cast("int"), "parts": parts}
    )


def listed(order: list[str], member: str) -> Column:
    """The members of a group as an array in ``order``."""
    entry = F.struct(*order, F.col(member).alias("_id"))
    return F.array_sort(F.collect_list(entry)).getField("_id")
