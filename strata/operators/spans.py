"""Conditions that all keys of a batch meet, as literals, so that a scan of a large table skips what cannot hold any of them.

A join tells its keys only when it runs. Bounds that are known when it is planned reach the Parquet reader instead: a row group, or a page of
it, is read only if its least and greatest key leave room for one of the batch. Where rows lie in order of the key, a batch of some
months then reads little more than their rows. A handful of keys are given one by one, so that dictionaries and bloom filters of
row groups, too, tell which to leave out, in whatever order the rows lie.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

#: Keys that are given one by one at most. A bloom filter lets one key in a hundred pass, so beyond this most row groups pass anyway.
FEW = 64
#: Spans of a key at most, and the equal steps between its least and greatest value in which gaps are looked for.
SPANS, STEPS = 32, 4096


def _any(conditions: list[Column]) -> Column:
    """One of them, as a flat tree: its depth is the logarithm of their number."""
    while len(conditions) > 1:
        conditions = [reduce(Column.__or__, conditions[i : i + 2]) for i in range(0, len(conditions), 2)]
    return conditions[0]


def key_spans(updates: DataFrame, key: str, spans: int = SPANS, steps: int = STEPS) -> list[tuple[int, int]]:
    """At most `spans` intervals, ends included, that together hold all whole-number keys of `updates`, the widest gaps left out.

    One aggregate over the key column: least and greatest key of each of `steps` equal steps, reduced before the shuffle; so at most
    `steps` rows come to the driver, whatever the number of keys. NULL keys lie nowhere. No keys: no intervals.
    """
    low, high = updates.agg(F.min(key), F.max(key)).first()
    if low is None:
        return []
    width = (high - low) // steps + 1
    # the difference of two longs may not fit a long
    step = F.floor((F.col(key).cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)"))
    found = updates.filter(F.col(key).isNotNull()).groupBy(step.alias("step")).agg(F.min(key).alias("low"), F.max(key).alias("high")).collect()
    ends = sorted((r.low, r.high) for r in found)
    # keys that follow each other leave no gap between two steps
    apart = [i for i in range(1, len(ends)) if ends[i][0] - ends[i - 1][1] > 1]
    gaps = sorted(apart, key=lambda i: ends[i - 1][1] - ends[i][0])[: spans - 1]
    starts = [0, *sorted(gaps), len(ends)]
    return [(ends[a][0], ends[b - 1][1]) for a, b in zip(starts, starts[1:])]


def within(updates: DataFrame, key: str, rows: int | None = None, few: int = FEW, spans: int = SPANS) -> Column:
    """A condition on `key` that every row of another table meets whose key is one of `updates`; rows without a key do not meet it.

    rows: the number of updates, where it is known. Up to `few` different keys are listed; more whole numbers are held by spans, more
    texts by the first and last of them. Keys of other types are not narrowed: the condition is true.
    """
    kind = updates.schema[key].dataType
    if not isinstance(kind, (IntegralType, StringType)):
        return F.lit(True)
    maybe_few = rows is None and updates.agg(F.approx_count_distinct(key)).first()[0] <= 2 * few  # else all keys would be shuffled
    listed = None
    if maybe_few or (rows is not None and rows <= few):
        listed = [r[0] for r in updates.select(key).filter(F.col(key).isNotNull()).distinct().limit(few + 1).collect()]
    if listed is not None and len(listed) <= few:
        return _any([F.col(key) == F.lit(v) for v in sorted(listed)]) if listed else F.lit(False)
    if isinstance(kind, IntegralType):
        held = key_spans(updates, key, spans)
    else:
        held = [(r[0], r[1]) for r in updates.agg(F.min(key), F.max(key)).collect() if r[0] is not None]
    return _any([F.col(key).between(*ends) for ends in held]) if held else F.lit(False)


def narrowed(table: DataFrame, updates: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """The rows of `table` that can have a key of `updates`: all that have one, and few others. The bounds reach the scan.

    For joins that keep nothing else of the table: a semi join with the updates, or updates without their known keys.
    """
    return table.filter(within(updates, key, rows))
