"""Interval joins as equi-joins.

"Same account, later by at most so long, amount in such a band" has one equality and two
ranges. Joined on the account alone, one busy account would put all its pairs into one task.
Both ranges are therefore cut into cells: a row on the earlier side is copied to each cell
its ranges touch, a row on the later side has exactly one cell, so every pair meets exactly
once, in one of very many small cells. Adaptive skew handling splits a cell that is still hot.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import amount_cell, day_cell, decimal, hours

_CELL = ["_at", "_day", "_money"]


def follow_on_pairs(
    first: DataFrame,
    then: DataFrame,
    *,
    within_hours: int,
    keep: str,
    how: str = "inner",
) -> DataFrame:
    """Join each row of ``first`` with the rows of ``then`` that follow on from it.

    ``first`` has columns ``at, time, amount`` and ``then`` has ``then_at, then_time,
    then_amount``; both may carry more. A pair is kept if the accounts are equal, ``then_time``
    is strictly later by at most ``within_hours``, and ``then_amount`` lies between ``keep``
    times ``amount`` and ``amount``, bounds included.
    """
    cell_days = max(1, math.ceil(within_hours / 24)) * 2
    width = 3 * abs(math.log(float(keep)))
    floor_amount = F.col("amount") * decimal(keep)
    latest = F.col("time") + hours(within_hours)

    left = (
        first.withColumn("_at", F.col("at"))
        .withColumn(
            "_day",
            F.explode(F.sequence(day_cell(F.col("time"), cell_days), day_cell(latest, cell_days))),
        )
        .withColumn(
            "_money",
            F.explode(
                F.sequence(
                    F.least(amount_cell(floor_amount, width), amount_cell(F.col("amount"), width)),
                    amount_cell(F.col("amount"), width),
                )
            ),
        )
    )
    right = (
        then.withColumn("_at_r", F.col("then_at"))
        .withColumn("_day_r", day_cell(F.col("then_time"), cell_days))
        .withColumn("_money_r", amount_cell(F.col("then_amount"), width))
    )
    same_cell: Column = F.lit(True)
    for name in _CELL:
        same_cell = same_cell & (F.col(name) == F.col(f"{name}_r"))
    follows = (
        same_cell
        & (F.col("then_time") > F.col("time"))
        & (F.col("then_time") <= latest)
        & (F.col("then_amount") >= floor_amount)
        & (F.col("then_amount") <= F.col("amount"))
    )
    joined = left.join(right, follows, how)
    return joined.drop(*_CELL, *[f"{name}_r" for name in _CELL])
