"""Dropping records that were delivered before, by record key within a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POLICIES = ("off", "old", "new")


def record_key(key: str = "key", value: str = "value"):
    """The key's JSON, the value's where there is no key."""
    return F.coalesce(F.to_json(key), F.to_json(value))


def deduplicate(records: DataFrame, policy: str, by: list[str], order: list[str]) -> DataFrame:
    """off: all; old: the first record of each key stays; new: the last one does.

    Rows whose `by` is null are one group like any other: group by record_key() where keys may be missing.
    """
    policy = policy.lower()
    if policy not in POLICIES:
        raise ValueError(f"the policy is one of {POLICIES}")
    if policy == "off":
        return records
    rest = [c for c in records.columns if c not in by]
    pick = F.min_by if policy == "old" else F.max_by
    best = records.groupBy(*by).agg(pick(F.struct(*rest), F.struct(*order)).alias("__row"))
    return best.select(*[F.col(c) if c in by else F.col("__row")[c].alias(c) for c in records.columns])


def deduplicate_stream(records: DataFrame, by: list[str], event_time: str, delay: str) -> DataFrame:
    """The first record of each key; a key is remembered for `delay` of event time, which bounds the state."""
    return records.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(by)
