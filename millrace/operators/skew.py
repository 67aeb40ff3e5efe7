"""Joins whose left side may hold one key in a large share of its rows.

Keys above a fraction of a percent of the rows are found with a sketch and split here. What is below
the sketch's resolution is left to adaptive execution, which splits large partitions of these joins
(left, left semi, left anti, inner) at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key above this many rows is split into slots of this many rows.
HOT_ROWS = 1_000_000

# Size of the sketch, and with it the bound of the broadcast list of hot keys. Every key with more
# than about 1/500 of the rows is in it.
TRACKED = 2048

# Rows with an incomplete key match nothing and are spread over this many slots.
NULL_SLOTS = 4096

SLOT = "_slot"


def incomplete(keys: list[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key hash, slots) of the heavy keys, at most ``TRACKED`` rows.

    Each task sends one small sketch of its keys; the keys themselves are not shuffled. A missed or
    doubled hash costs balance, never rows.
    """
    top = df.where(~incomplete(keys)).agg(
        F.call_function(
            "approx_top_k", F.xxhash64(*[F.col(k) for k in keys]), F.lit(TRACKED), F.lit(TRACKED)
        ).alias("top")
    )
    found = top.select(F.explode("top").alias("k")).where(F.col("k.count") > hot_rows)
    return found.select(
        F.col("k.item").alias("_h"), F.ceil(F.col("k.count") / hot_rows).cast("int").alias("_slots")
    )


def null_slot(keys: list[str], row_id: list[str]) -> Column:
    """Slot 0 for complete keys; the others are spread by row id."""
    pick = F.pmod(F.xxhash64(*[F.col(c) for c in row_id]), F.lit(NULL_SLOTS))
    return F.when(incomplete(keys), pick).otherwise(F.lit(0)).cast("int")


def spread(
    left: DataFrame, right: DataFrame, keys: list[str], row_id: list[str] | None, hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with a slot column, and the extended join keys.

    Left rows of a hot key pick a slot by row id and its right rows are repeated once per slot. All
    other keys stay in slot 0, so the result equals the plain join on ``keys``. Without a row id the
    position in the scan serves, which needs ``left`` to be read from storage.
    """
    hot = F.broadcast(hot_keys(left, keys, hot_rows))
    hashed = F.xxhash64(*[F.col(k) for k in keys]).alias("_h")
    pick = F.xxhash64(*[F.col(c) for c in row_id]) if row_id else F.monotonically_increasing_id()
    slots = F.coalesce(F.col("_slots"), F.lit(1))
    slot = F.pmod(pick, F.when(incomplete(keys), F.lit(NULL_SLOTS)).otherwise(slots)).cast("int")
    left_slots = (
        left.select("*", hashed).join(hot, "_h", "left").select(*left.columns, slot.alias(SLOT))
    )
    right_slots = (
        right.select("*", hashed)
        .join(hot, "_h", "left")
        .select(*right.columns, F.explode(F.sequence(F.lit(0), slots - 1)).alias(SLOT))
    )
    return left_slots, right_slots, [*keys, SLOT]


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    row_id: list[str] | None,
    how: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``left.join(right, keys, how)`` for how in left, left_semi, left_anti, inner; skew-safe on the left."""
    lhs, rhs, on = spread(left, right, keys, row_id, hot_rows)
    # Estimates of landed tables are far too low where columns are mostly NULL; a side is never broadcast by them.
    return lhs.join(rhs.hint("merge"), on, how).drop(SLOT)
