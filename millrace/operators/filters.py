"""Row filters of the feed work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The file types each entry point accepts.
UPLOAD_EXTENSIONS = (".xlsx", ".xls", ".csv")
FEED_EXTENSIONS = (".dbf", ".csv")


def complete_key(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropna(subset=keys)


def received_on(ts: Column, day: str) -> Column:
    """Half-open range of one calendar day, so that the bound reaches the scan."""
    start = F.lit(day).cast("date")
    return (ts >= start.cast("timestamp_ntz")) & (ts < F.date_add(start, 1).cast("timestamp_ntz"))


def has_extension(path: Column, extensions=UPLOAD_EXTENSIONS) -> Column:
    low = F.lower(path)
    cond = F.lit(False)
    for e in extensions:
        cond = cond | low.endswith(e)
    return cond
