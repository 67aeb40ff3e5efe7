"""Column profiles: how many different values the text columns of a table hold.

Two forms. The exact one turns cells into (column, value) rows that are combined before their shuffle, so a value with a
third of all rows is one row per task, and a column of many values is spread. The other keeps a sketch per column and
file; sketches are stored and united, so a profile over files read at any time costs no second look at their rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.schema import quoted

#: Precision of a sketch: 2 ** LG_K registers, a relative error of about 0.8 percent.
LG_K = 14


def text_columns(df: DataFrame) -> list[str]:
    return [n for n, t in df.dtypes if t == "string"]


def _rated(distinct: Column, rows: Column, limit: float) -> list[Column]:
    ratio = distinct / F.nullif(rows, F.lit(0))
    return [distinct.alias("distinct_values"), ratio.alias("ratio"), (ratio < limit).alias("low")]


def cardinality_profile(df: DataFrame, exact: bool = True, limit: float = 0.5) -> DataFrame:
    """Distinct share of each text column as rows (column_name, distinct_values, ratio, low)."""
    if not exact:
        return merged_profile(column_sketches(df, []), limit).drop("rows")
    cells = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(quoted(n)).alias("value")) for n in text_columns(df)])
    values = df.select(F.inline(cells)).groupBy("column_name", "value").agg(F.count("*").alias("n"))
    counts = values.groupBy("column_name").agg(F.count("value").alias("d"), F.sum("n").alias("n"))
    every = df.sparkSession.createDataFrame([(n,) for n in text_columns(df)], "column_name string")  # of an empty table too
    return every.join(counts, "column_name", "left").select("column_name", *_rated(F.coalesce("d", F.lit(0)), F.coalesce("n", F.lit(0)), limit))


def column_sketches(df: DataFrame, by: list[str]) -> DataFrame:
    """(by, column_name, rows, sketch) of each text column of each group, such as a file; the rows are read once."""
    names = [n for n in text_columns(df) if n not in by]
    sketches = [F.hll_sketch_agg(quoted(n), LG_K).alias(f"_{i}") for i, n in enumerate(names)]
    grouped = df.groupBy(*by).agg(F.count("*").alias("rows"), *sketches)
    entries = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(f"_{i}").alias("sketch")) for i, n in enumerate(names)])
    return grouped.select(*by, "rows", F.inline(entries)).select(*by, "column_name", "rows", "sketch")


def merged_profile(sketches: DataFrame, limit: float = 0.5) -> DataFrame:
    """The profile (column_name, rows, distinct_values, ratio, low) of all groups of some sketches together.

    A sketch that was never united is estimated from more than its registers; united with itself it is not, so the
    estimate is the same whether the rows came as one group or as many.
    """
    united = sketches.groupBy("column_name").agg(F.sum("rows").alias("rows"), F.hll_union_agg("sketch").alias("sketch"))
    return united.select("column_name", "rows", *_rated(F.hll_sketch_estimate(F.hll_union("sketch", "sketch")), F.col("rows"), limit))
