"""Column helpers shared by the jobs. All of them are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_cell(moment: Column, days: int) -> Column:
    """Number of the ``days``-long slice of the calendar that holds ``moment``.

    Later moments never get a smaller number, so a time range maps to a range of cells.
    """
    return F.floor(F.unix_date(moment.cast("date")) / F.lit(days))


def amount_cell(amount: Column, width: float) -> Column:
    """Number of the logarithmic slice that holds ``amount``; ``width`` is in units of ln.

    Larger amounts never get a smaller number; everything below one cent shares a cell.
    """
    return F.floor(F.ln(F.greatest(amount.cast("double"), F.lit(0.01))) / F.lit(width))


def decimal(text: str) -> Column:
    """A decimal literal. Shares and thresholds of money must not pass through floats."""
    digits = len(text.replace(".", "").replace("-", ""))
    scale = len(text.split(".")[1]) if "." in text else 0
    return F.lit(text).cast(f"decimal({max(digits, scale + 1)},{scale})")


def hours(n: int | str) -> Column:
    return F.expr(f"interval '{int(n)}' hour")


def days(n: int | str) -> Column:
    return F.expr(f"interval '{int(n)}' day")


def decay_pct(first: Column, last: Column) -> Column:
    """How much of the first amount was lost on the way, in percent with one decimal."""
    share = F.try_divide(last, first)
    return F.round(F.lit(100) * (F.lit(1) - share), 1).cast("decimal(5,1)")


def path_key(txn_ids: Column) -> Column:
    return F.array_join(txn_ids, ",")


def document(*fields: Column) -> Column:
    """A VARIANT object of the given columns; fields that are null are left out."""
    return F.parse_json(F.to_json(F.struct(*fields)))


def iso_second(moment: Column) -> Column:
    """Whole seconds as text. The cast, unlike ``date_format``, never consults a time zone."""
    text = moment.cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8))


def microsecond_text(moment: Column) -> Column:
    text = moment.cast("string")
    filled = F.concat(F.substring(text, 1, 19), F.lit("."), F.substring(text, 21, 6))
    return F.rpad(filled, 26, "0")


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` and the number, zero-filled to ``width`` but never cut."""
    digits = number.cast("string")
    filled = F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
    return F.concat(F.lit(prefix), filled)
