"""One number per row that stands for its place: cheap to compare, to join on, and to aggregate without sorting."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.session import scratch_path

POSITION = "row_pos"

#: Row numbers of one scan task: what Spark leaves below the partition number of a row id.
TASK_BITS = 33

#: Rows of one file of a landed table. Wide rows that are mostly NULL take next to no room in a file and much in memory: a
#: scan task gets its share by the size of files, so files are bounded by rows.
FILE_ROWS = 1 << 16

#: Splits are broadcast to their rows up to this many; beyond it they are joined by a shuffle.
BROADCAST_SPLITS = 500_000

#: Hashes of keys that come more than once are broadcast up to this many.
BROADCAST_REPEATS = 500_000

#: Rows that others of their key drop are broadcast by their positions up to this many.
BROADCAST_LOST = 500_000


def place(order: list[str]) -> Column:
    """The order as one value: the column itself if there is one, so that a maximum needs no sorted aggregation."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def land(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, so that it is worked out once."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """A table without rows that is known to be empty when a query is planned: joins with it need no shuffle."""
    return spark.range(1).where(F.lit(False)).select([F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def known_empty(df: DataFrame) -> bool:
    """Whether the plan alone tells that there are no rows, as with ``no_rows``."""
    most = df._jdf.queryExecution().optimizedPlan().maxRows()
    return most.isDefined() and most.get() == 0


@dataclass(frozen=True)
class RepeatedKeys:
    """Hashes of the keys that several rows hold. Keys that share a hash by chance are taken for one: rows that are
    ``others`` are alone under their key, ``rows`` are still to be compared."""

    keys: list[str]
    hashes: DataFrame
    count: int

    def _join(self, df: DataFrame, how: str) -> DataFrame:
        hashed = df.withColumn("_key_hash", key_hash(self.keys))
        return hashed.join(F.broadcast(self.hashes), "_key_hash", how).select(df.columns)

    def rows(self, df: DataFrame) -> DataFrame:
        return self._join(df, "left_semi") if self.count else df.where(F.lit(False))

    def others(self, df: DataFrame) -> DataFrame:
        return self._join(df, "left_anti") if self.count else df


def key_hash(keys: list[str]) -> Column:
    """Equal for keys that are equal, NULLs included."""
    return F.xxhash64(*[F.col(k) for k in keys])


def repeated_keys(rows: DataFrame, keys: list[str]) -> RepeatedKeys | None:
    """The keys that more than one row holds, found from one number per row; None where they are too many to broadcast."""
    counted = rows.select(key_hash(keys).alias("_key_hash")).groupBy("_key_hash").count()
    hashes = land(counted.where(F.col("count") > 1).select("_key_hash"), "repeats")
    count = hashes.count()
    return RepeatedKeys(keys, hashes, count) if count <= BROADCAST_REPEATS else None


def with_position(landed: DataFrame, path: Callable[[Column], Column] | None = None) -> DataFrame:
    """Landed rows with ``row_pos``: split by split in the order of files and blocks, then by row number.

    Splits are few (one per task that read the input): they are numbered from two columns of the table alone. ``path``
    makes the path of a file from what the table has as such.
    """
    split = ["file_path", "row_block"]
    found = landed.select(split).distinct().withColumn("_path", path(F.col("file_path")) if path else F.col("file_path"))
    numbered = found.withColumn("_split", F.row_number().over(Window.orderBy("_path", "row_block")).cast("bigint"))
    numbered = land(numbered, "splits")
    if numbered.count() <= BROADCAST_SPLITS:
        numbered = F.broadcast(numbered)
    row = F.col("row_seq").bitwiseAND(F.lit((1 << TASK_BITS) - 1))
    joined = landed.join(numbered, split).withColumn(POSITION, F.shiftleft("_split", TASK_BITS).bitwiseOR(row))
    return joined.withColumn("file_path", F.col("_path")).select(*landed.columns, POSITION)


def lost_positions(rows: DataFrame, keys: list[str], rule: str) -> DataFrame | None:
    """Positions of the rows that the first (or last) row of their key drops, to broadcast; None where they are too many.

    Positions are unique numbers, so the kept ones are a hash aggregation, and nothing but numbers is shuffled after it.
    """
    best = F.min(POSITION) if rule == "first" else F.max(POSITION)
    kept = rows.groupBy(*keys).agg(best.alias(POSITION)).select(POSITION)
    lost = land(rows.select(POSITION).join(kept.hint("merge"), POSITION, "left_anti"), "lost")
    return F.broadcast(lost) if lost.count() <= BROADCAST_LOST else None


def land_in_order(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows of any order as a table with ``row_pos``: written in ranges, each row known by its range and its number there.

    Rows that are equal in ``order`` get some order among themselves, fixed from then on.
    """
    path = scratch_path(df.sparkSession, name)
    df.orderBy(*order).withColumn("_range", F.spark_partition_id().cast("bigint")).write.parquet(path)
    stored = df.sparkSession.read.schema(StructType([*df.schema.fields, StructField("_range", LongType())])).parquet(path)
    number = F.shiftleft("_range", 40).bitwiseOR(F.col("_metadata.row_index"))
    return stored.withColumn(POSITION, number).select(*df.columns, POSITION)
