"""Target tables kept as partition snapshots on a shared folder.

A table is a folder of Parquet partitions plus a small ``log`` table with one row per written
partition: (version, part, path, run_id, kind). A partition consists of its newest ``replace`` folder
and the ``append`` folders after it. A merge writes the partitions its batch touches to fresh folders
and then adds to the log; that is one file and it is the commit. Readers never see half a merge, the
path being read is never overwritten, and a run id in the log means that run is already applied. One
writer per table at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.position import no_rows
from millrace.sources.text import list_files

LOG_SCHEMA = "version bigint, part string, path string, run_id string, kind string"
PART = "_part"
REPLACE, APPEND, APPENDED = "replace", "append", "appended"


def date_part(name: str) -> Column:
    """Month of a date that belongs to the key: matching rows always share it."""
    day = F.col(name).cast("date")
    plain = day.between(F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date"))
    month = F.when(plain, F.substring(day.cast("string"), 1, 7)).otherwise(F.date_format(day, "yyyy-MM"))
    return F.coalesce(month, F.lit("none"))


def hash_part(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("string")


@dataclass(frozen=True)
class SnapshotTable:
    spark: SparkSession
    root: str
    schema: StructType
    part: Column

    def _log(self) -> DataFrame:
        empty = self.spark.createDataFrame([], LOG_SCHEMA)
        try:
            # Materialise the analysis here, so that a missing folder shows up now.
            return self.spark.read.schema(empty.schema).parquet(f"{self.root}/log")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return empty
            raise

    def _current(self) -> list[tuple[str, str]]:
        """(part, path) of the current folders: table metadata, a few entries per partition."""
        log = self._log()
        base = log.groupBy("part").agg(
            F.max(F.when(F.col("kind") == REPLACE, F.col("version"))).alias("base")
        )
        live = log.join(base, "part").where(F.col("version") >= F.coalesce("base", F.lit(0)))
        return [(r["part"], r["path"]) for r in live.dropna(subset="path").select("part", "path").collect()]

    def applied(self, run_id: str) -> bool:
        return not self._log().where(F.col("run_id") == run_id).isEmpty()

    def runs(self) -> DataFrame:
        return self._log().select("run_id").distinct()

    def read(self, parts: set[str] | None = None) -> DataFrame:
        """Current rows, or those of some partitions only."""
        return self.read_as(self.schema, parts)

    def read_as(self, schema: StructType, parts: set[str] | None = None) -> DataFrame:
        """The same with the columns of another schema, such as that of the stored rows."""
        paths = [p for part, p in self._current() if parts is None or part in parts]
        if not paths:
            return no_rows(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def stored_schema(self) -> StructType | None:
        """Columns of the stored rows, or None before there are any."""
        paths = [p for _, p in self._current()]
        return self.spark.read.parquet(paths[0]).schema if paths else None

    def touched(self, source: DataFrame) -> set[str]:
        """Partitions a batch falls into, at most as many as the table has."""
        return {r[0] for r in source.select(self.part.alias("p")).distinct().collect()}

    def replace(self, rows: DataFrame, parts: set[str], run_id: str, same: dict[str, Column] | None = None) -> None:
        """Write the new content of ``parts`` and commit it under ``run_id``. ``same`` has the columns that hold one value in
        all of ``rows``, with it: these are not shuffled and sorted with the others."""
        self._commit(rows, self.part, parts, run_id, REPLACE, same or {})

    def append(self, rows: DataFrame, run_id: str) -> None:
        """Add rows without rewriting anything; they form one partition of their own."""
        self._commit(rows, F.lit(APPENDED), {APPENDED}, run_id, APPEND)

    def _commit(
        self, rows: DataFrame, part: Column, parts: set[str], run_id: str, kind: str, same: dict[str, Column] | None = None
    ) -> None:
        version = 1 + (self._log().agg(F.max("version")).first()[0] or 0)
        folder = f"{self.root}/data/{version:010d}-{uuid.uuid4().hex}"
        names = self.schema.fieldNames()
        if kind == REPLACE:
            # Rows of a partition are brought together for few, large files; adaptive execution splits a
            # partition that holds most of the rows. Never NULL, so that the writer takes the order as it is.
            same = same or {}
            named = F.coalesce(part, F.lit("none")).alias(PART)
            out = rows.select(*[n for n in names if n not in same], named).hint("rebalance", PART).sortWithinPartitions(PART)
            out = out.select(*[same[n].alias(n) if n in same else n for n in names], PART)
            out.write.partitionBy(PART).parquet(folder)
        else:
            # Appended rows are one partition and stay where they are, in a folder that is named without a sort.
            rows.select(names).write.parquet(f"{folder}/{PART}={APPENDED}")
        written = {
            r[0]
            for r in list_files(self.spark, folder, "*.parquet")
            .select(F.regexp_extract("path", f"/{PART}=([^/]+)/", 1))
            .distinct()
            .collect()
        }
        # A partition without rows gets an entry without a folder.
        entries = [
            (version, p, f"{folder}/{PART}={p}" if p in written else None, run_id, kind)
            for p in sorted(parts)
        ]
        self.spark.createDataFrame(entries, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{self.root}/log"
        )
