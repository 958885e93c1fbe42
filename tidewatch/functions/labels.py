"""Display names of codes."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names shown for pattern, detector and closing codes.
PATTERNS = {
    "round_trip": "Round-trip",
    "round_trip_shared_device": "Round-trip · shared device",
    "round_trip_phone_link": "Round-trip · phone link",
    "round_trip_sub_threshold": "Round-trip · sub-threshold",
    "layering_chain": "Layering chain",
    "mule_network": "Mule network",
    "structuring": "Structuring",
}
DETECTORS = {
    "round_trip (detector)": "round_trip",
    "layering (detector)": "layering_chain",
    "mule (detector)": "mule_network",
    "structuring (detector)": "structuring",
}
CLOSED_BY = {
    "same_account": "Same account",
    "linked_phone": "Linked · phone",
    "linked_email": "Linked · email",
    "linked_device": "Linked · device",
}
OUTCOMES = {"found_full": "Found", "found_partial": "Partial", "missed": "Missed"}
NONE = "—"


def lookup(names: dict, code: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(names.items())])
    return F.try_element_at(pairs, code)


def capitalized(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 1 << 30)))


def pattern_name(code: Column) -> Column:
    return F.coalesce(lookup(PATTERNS, code), capitalized(F.replace(code, F.lit("_"), F.lit(" "))))


def pattern_rank(code: Column) -> Column:
    return lookup({name: i for i, name in enumerate(PATTERNS)}, code)


def tier_name(tier: Column) -> Column:
    return F.when(F.length(tier) > 0, capitalized(tier)).otherwise(NONE)


def tier_list(tiers: Column) -> Column:
    """Names for a comma-separated list of tiers."""
    named = F.transform(F.split(tiers, ","), lambda t: tier_name(t))
    return F.when(F.length(tiers) > 0, F.array_join(named, ", ")).otherwise(NONE)


def closed_by_name(code: Column, none: str = NONE) -> Column:
    return F.when(code.isNull(), none).otherwise(F.coalesce(lookup(CLOSED_BY, code), code))


def detection_type(closed_by: Column) -> Column:
    """Only round trips have a closing code."""
    return F.when(closed_by.isNull(), PATTERNS["layering_chain"]).otherwise(PATTERNS["round_trip"])
