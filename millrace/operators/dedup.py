"""In-file duplicates. NULL key parts are equal to each other here, unlike in a merge.

``order`` must order the rows totally (row position in the source). The one-row-per-key filters are
written as ``row_number() = 1``: Spark pushes that limit below the shuffle, so a key that holds a
third of the rows arrives as one row per map task. What remains is found by an anti join on the row
id, which is unique, so the hot key never gathers anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _top(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.select("*", rank.alias("_rank")).where(F.col("_rank") == 1).drop("_rank")


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _top(df, keys, [F.col(c).asc() for c in order])


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _top(df, keys, [F.col(c).desc() for c in order])


def rejects(
    df: DataFrame, keys: list[str], order: list[str], row_id: list[str] | None = None
) -> DataFrame:
    """Every row that ``keep_first`` drops. ``row_id`` defaults to the order columns."""
    row_id = row_id or order
    narrow = df.select(list(dict.fromkeys([*keys, *order, *row_id])))
    return df.join(keep_first(narrow, keys, order).select(row_id), row_id, "left_anti")


def group_members(df: DataFrame, keys: list[str], row_id: list[str]) -> DataFrame:
    """All rows of keys that occur more than once: all rows but those alone under their key.

    Counting combines on the map side and the anti join runs on the unique row id.
    """
    lone = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(f"_id{i}") for i, c in enumerate(row_id)])
        .where(F.col("_n") == 1)
        .select([F.col(f"_id{i}").alias(c) for i, c in enumerate(row_id)])
    )
    return df.join(lone, row_id, "left_anti")
