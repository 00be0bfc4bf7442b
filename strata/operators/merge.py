"""Merges by key (upserts) as plans, for tables whose files cannot be updated in place, and stable surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata import session
from strata.operators.numbering import number_rows

INSERT, UPDATE, KEEP = "insert", "update", "keep"
_NULL_KEY_SALTS = 1024


def _has_null(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


def _salted(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a NULL key match nothing, yet an outer join would hash them all into one task. Spread them by their content."""
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(_NULL_KEY_SALTS)).cast("int")
    return df.withColumn("_salt", F.when(_has_null(keys), spread).otherwise(F.lit(0)))


def _first_per_key(updates: DataFrame, keys: Sequence[str], first_by: Sequence[str]) -> DataFrame:
    """The first row of each key, aggregated before the shuffle, so that a key repeated without bound stays cheap. Rows with a NULL key
    conflict with nothing, so all of them stay: a number tells them apart."""
    apart = F.when(_has_null(keys), F.monotonically_increasing_id())
    rank = F.struct(*(first_by or updates.columns))
    best = updates.withColumn("_apart", apart).groupBy(*keys, "_apart").agg(F.min_by(F.struct(*updates.columns), rank).alias("_row"))
    return best.select("_row.*")


def _reject_repeated(salted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fails on a repeated key. Partitions and sorts exactly as the merge join that follows, so the check adds no shuffle of its own."""
    by = [*keys, "_salt"]
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(*by))
    repeated = (F.col("_nth") > 1) & ~_has_null(keys)
    message = F.lit(f"repeated key in updates: {', '.join(keys)}")
    return salted.withColumn("_nth", nth).filter(F.when(repeated, F.raise_error(message)).otherwise(F.lit(True))).drop("_nth")


def _unique(updates: DataFrame, keys: Sequence[str], on_duplicate: str, first_by: Sequence[str]) -> DataFrame:
    """`updates` plus `_salt`, one row per key."""
    if on_duplicate == "error":
        return _reject_repeated(_salted(updates, keys), keys)
    if on_duplicate == "first":
        return _salted(_first_per_key(updates, keys, first_by), keys)
    raise ValueError(f"unknown duplicate handling: {on_duplicate}")


def not_yet_present(updates: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Updates whose key the target lacks. Only the target's key columns are read."""
    return updates.join(target.select(*keys), list(keys), "left_anti").select(*updates.columns)


def _held_keys(target: DataFrame, few: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target's keys, cut to those of a few updates before anything is shuffled."""
    return target.select(*keys).join(F.broadcast(few.select(*keys)), list(keys), "left_semi")


def _absent(fresh: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`not_yet_present` for rows that carry `_salt`, on the partitioning they already have."""
    known = target.select(*keys, F.when(_has_null(keys), 1).otherwise(0).alias("_salt"))
    return fresh.join(known, [*keys, "_salt"], "left_anti").select(*[c for c in fresh.columns if c != "_salt"])


def merged(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    on_duplicate: str = "error",
    first_by: Sequence[str] = (),
    updates_rows: int | None = None,
    changed: str | None = None,
) -> DataFrame:
    """The merged table plus `_action` (insert, update, keep) per row. Columns only the target has are NULL in inserts.

    A key repeated in `updates` fails ("error"), or only its first row by `first_by` (all columns if not given) counts ("first").
    A NULL in a key conflicts with nothing. changed: name of a further column that tells updates which change something."""
    keys, update_cols = list(keys), list(update_cols)
    rest = [c for c in target.columns if c not in keys]
    unknown = [c for c in keys + update_cols if c not in target.columns or c not in updates.columns]
    if unknown:
        raise ValueError(f"merge columns missing on one side: {', '.join(unknown)}")
    updates = updates.select(*[c for c in target.columns if c in updates.columns])
    fresh = _unique(updates, keys, on_duplicate, first_by)

    few = updates_rows is not None and updates_rows <= session.BROADCAST_ROWS and changed is None
    unchanged = [F.lit(False).alias(changed)] if changed else []

    if not update_cols:
        inserts = _absent(fresh, _held_keys(target, fresh, keys) if few else target, keys).withColumn("_action", F.lit(INSERT))
        return target.withColumn("_action", F.lit(KEEP)).unionByName(inserts, allowMissingColumns=True).select("*", *unchanged)

    if few:
        return _merged_small(target, fresh.drop("_salt"), keys, update_cols)

    # One shuffle of each side. The flags, not the values, tell what matched, so that a new NULL overwrites an old value.
    given = [c for c in updates.columns if c not in keys]
    t = _salted(target, keys).select(*keys, "_salt", *[F.col(c).alias(f"_t_{c}") for c in rest], F.lit(True).alias("_old"))
    u = fresh.select(*keys, "_salt", *[F.col(c).alias(f"_u_{c}") for c in given], F.lit(True).alias("_new"))
    joined = t.join(u, [*keys, "_salt"], "full_outer")
    old, new = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def value(c: str) -> Column:
        before, after = F.col(f"_t_{c}"), F.col(f"_u_{c}") if c in given else F.lit(None)
        return F.when(new, after).otherwise(before) if c in update_cols else F.when(old, before).otherwise(after)

    action = F.when(old & new, UPDATE).when(new, INSERT).otherwise(KEEP)
    columns = [F.col(c) if c in keys else value(c).alias(c) for c in target.columns]
    differs = reduce(Column.__or__, [~F.col(f"_t_{c}").eqNullSafe(F.col(f"_u_{c}")) for c in update_cols if c not in keys], F.lit(False))
    return joined.select(*columns, action.alias("_action"), *([(old & new & differs).alias(changed)] if changed else []))


def all_new(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`merged` into a table known to have no rows: all updates are inserts, and a repeated key fails. The rows are written, as they came,
    and read back: no join follows that would need them by key, so nothing but the keys is shuffled, to see that there are as many different
    ones as the write has counted."""
    given = updates.select(*[c for c in target.columns if c in updates.columns])
    rows, seen = session.materialize_counted(given, "inserts", {"keyed": F.count_if(~_has_null(keys))}, session.DENSE)
    if rows.select(*keys).na.drop().distinct().count() < seen["keyed"]:
        raise ValueError(f"repeated key in updates: {', '.join(keys)}")
    return target.limit(0).unionByName(rows, allowMissingColumns=True).withColumn("_action", F.lit(INSERT))


def _merged_small(target: DataFrame, fresh: DataFrame, keys: list[str], update_cols: list[str]) -> DataFrame:
    """Few updates against a large target: the target is never shuffled. Its keys are narrowed to those updated before the anti join."""
    small = F.broadcast(fresh.select(*keys, F.struct(*update_cols).alias("_u"), F.lit(True).alias("_new")))
    joined = target.join(small, keys, "left")
    new = F.col("_new").isNotNull()
    columns = [
        F.when(new, F.col(f"_u.{c}")).otherwise(F.col(c)).alias(c) if c in update_cols else F.col(c) for c in target.columns
    ]
    kept = joined.select(*columns, F.when(new, UPDATE).otherwise(KEEP).alias("_action"))
    inserts = not_yet_present(fresh, _held_keys(target, fresh, keys), keys).withColumn("_action", F.lit(INSERT))
    return kept.unionByName(inserts, allowMissingColumns=True)


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    on_duplicate: str = "error",
    first_by: Sequence[str] = (),
    updates_rows: int | None = None,
) -> DataFrame:
    """`target` with `updates` merged in: a known key gets `update_cols` from its update (NULLs included) or, if the list is empty, stays
    as it is; an unknown key is inserted. Give `updates_rows` when the number of updates has been counted: a small batch is then
    broadcast instead of shuffling the target."""
    return merged(target, updates, keys, update_cols, on_duplicate, first_by, updates_rows).drop("_action")


def merge_counts(actions: DataFrame) -> DataFrame:
    """Rows per action of a `merged` frame."""
    return actions.groupBy(F.col("_action").alias("action")).agg(F.count("*").alias("row_count"))


class Keyed(NamedTuple):
    """A merged table with surrogate keys and `_action`, its rows by action, and how many known rows the updates change."""

    rows: DataFrame
    counts: dict[str, int]
    changed: int


def action_counts() -> dict[str, Column]:
    """What a write of merged rows can count on the way."""
    return {action: F.count_if(F.col("_action") == action) for action in (INSERT, UPDATE, KEEP)}


def keyed_merge(target: DataFrame, updates: DataFrame, natural_key: str, key_col: str, update_cols: Sequence[str]) -> Keyed:
    """Merge by a natural key and give new rows the next numbers in its order; known rows keep theirs.

    One join yields the old number, the action and the new content of every row, written once with its counts and the last number;
    only new rows are put in order afterwards. Neither side is read or shuffled a second time.
    """
    joined = merged(target, updates, [natural_key], update_cols, changed="_changed")
    counts = {**action_counts(), "changed": F.count_if("_changed"), "last": F.max(key_col)}
    held, seen = session.materialize_counted(joined, "merged", counts)
    held = held.drop("_changed")
    fresh = number_rows(held.filter(F.col("_action") == INSERT).drop(key_col), [F.col(natural_key)], key_col, after=seen["last"] or 0)
    rows = held.filter(F.col("_action") != INSERT).unionByName(fresh)
    return Keyed(rows, {a: seen[a] for a in (INSERT, UPDATE, KEEP) if seen[a]}, seen["changed"])


def assign_keys(target: DataFrame, updates: DataFrame, natural_key: str, key_col: str) -> DataFrame:
    """`updates` with `key_col`: known natural keys keep their number, new ones get the next numbers in natural-key order."""
    last = target.agg(F.max(key_col)).first()[0] or 0
    known = target.select(natural_key, key_col)
    tagged = updates.join(known, natural_key, "left").select(*updates.columns, key_col)
    fresh = number_rows(tagged.filter(F.col(key_col).isNull()).drop(key_col), [F.col(natural_key)], key_col, after=last)
    return tagged.filter(F.col(key_col).isNotNull()).unionByName(fresh)
