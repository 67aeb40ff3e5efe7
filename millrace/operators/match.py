"""Incoming rows against the stored keys. Key equality is SQL ``=``: a NULL key part never matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.skew import HOT_ROWS, spread_join


def near_keys(target: DataFrame, source: DataFrame, keys: list[str], small_source: bool) -> DataFrame:
    """Target rows that can matter to the source. For a batch that was checked to fit a broadcast, the
    target is filtered by its keys while being read, and only matches are left to shuffle."""
    if not small_source:
        return target
    return target.join(F.broadcast(source.select(keys).distinct()), keys, "left_semi")


def existing_rows(
    source: DataFrame, target: DataFrame, keys: list[str], row_id: list[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    stored = target.select(keys).distinct()
    return spread_join(source, stored, keys, row_id, "left_semi", hot_rows).select(source.columns)


def new_rows(
    source: DataFrame,
    target: DataFrame,
    keys: list[str],
    row_id: list[str],
    hot_rows: int = HOT_ROWS,
    small_source: bool = False,
) -> DataFrame:
    """Rows with a key the target lacks; rows with an incomplete key are new too."""
    stored = near_keys(target.select(keys), source, keys, small_source).distinct()
    return spread_join(source, stored, keys, row_id, "left_anti", hot_rows).select(source.columns)


def classify_changes(
    source: DataFrame,
    target: DataFrame,
    keys: list[str],
    tracked: list[str],
    row_id: list[str],
    hot_rows: int = HOT_ROWS,
    small_source: bool = False,
) -> DataFrame:
    """Source rows plus ``change``: new, changed or unchanged on the tracked columns, NULL-safe.

    A key stored more than once is judged by one of its rows, the largest tracked values.
    """
    near = near_keys(target.select(*keys, *tracked), source, keys, small_source)
    stored = near.groupBy(*keys).agg(F.max(F.struct(*tracked)).alias("_old"))
    joined = spread_join(source, stored, keys, row_id, "left", hot_rows)
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(c).eqNullSafe(F.col(f"_old.{c}"))
    change = F.when(F.col("_old").isNull(), "new").when(same, "unchanged").otherwise("changed")
    return joined.select(*source.columns, change.alias("change"))
