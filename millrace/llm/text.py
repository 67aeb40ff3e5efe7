"""Words and lines of whole texts, as Spark expressions."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Callable
from functools import cache
from pathlib import Path
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_path

T = TypeVar("T")

#: White space that separates words: space and the control characters tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text in order; none where the text is null or blank."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case; every other letter stays as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def land(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again, so that nothing before it is run twice.

    The files stay until the folder is cleared; an executor that is lost takes nothing with it.
    """
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_held: dict[str, object] = {}


def held(key: str, make: Callable[[], T]) -> T:
    """What ``make`` gives, kept by this worker from task to task. A worker serves stage after stage and keeps one such
    thing: what an earlier one left is given back first."""
    if key not in _held:
        _held.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _held[key] = make()
    return _held[key]


@cache
def _shipped(application: str) -> str:
    root = Path(__file__).resolve().parents[2]
    path = f"{tempfile.mkdtemp(prefix='millrace-')}/millrace.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted((root / "millrace").rglob("*.py")):
            z.write(p, p.relative_to(root))
    return path


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once a session, through Spark's own file service."""
    context = spark.sparkContext
    path = _shipped(context.applicationId)
    if not any(f.endswith(Path(path).name) for f in context.listFiles):
        context.addPyFile(path)
