"""Bad rows are set apart before a merge, each with its reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import CharType, DecimalType, StructType, VarcharType

Rule = tuple[Column, str]


def limits(target: str | StructType) -> list[Rule]:
    """What a target refuses, from its columns: (condition, reason) of missing values in columns that must have one,
    text beyond its length, and numbers that don't fit, once rounded, into their digits."""
    rules: list[Rule] = []
    for field in (StructType.fromDDL(target) if isinstance(target, str) else target).fields:
        value = F.col("`" + field.name.replace("`", "``") + "`")
        if not field.nullable:
            rules.append((value.isNull(), f"missing {field.name}"))
        if isinstance(field.dataType, (VarcharType, CharType)):
            rules.append((F.length(value) > field.dataType.length, f"too long {field.name}"))
        if isinstance(field.dataType, DecimalType):
            whole, scale = field.dataType.precision - field.dataType.scale, field.dataType.scale
            rules.append((F.abs(F.round(value, scale)) >= F.lit(10.0**whole), f"out of range {field.name}"))
    return rules


def reject_reason(required: list[str], castable: dict[str, str]) -> Column:
    """First failed rule of a row, or NULL. ``castable`` maps a cleaned column to its raw text:
    raw text that cleaned to NULL is a failed cast."""
    reason = None
    for name in required:
        rule = F.col(name).isNull(), F.lit(f"missing {name}")
        reason = F.when(*rule) if reason is None else reason.when(*rule)
    for name, raw in castable.items():
        text = F.trim(F.col(raw))
        rule = (F.col(name).isNull() & (text != ""), F.lit(f"bad {name}"))
        reason = F.when(*rule) if reason is None else reason.when(*rule)
    return F.lit(None).cast("string") if reason is None else reason


def split_valid(
    df: DataFrame, required: list[str] | None = None, castable: dict[str, str] | None = None, rules: list[Rule] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, and the others with ``reason``, that of the first rule they fail. One narrow pass each, no shuffle."""
    reason = reject_reason(required or [], castable or {})
    for condition, text in reversed(rules or []):
        reason = F.when(condition, F.lit(text)).otherwise(reason)
    marked = df.withColumn("reason", reason)
    return (
        marked.where(F.col("reason").isNull()).drop("reason"),
        marked.where(F.col("reason").isNotNull()),
    )
