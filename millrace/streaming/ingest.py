"""Incremental forms of the feed work."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.operators.merge import MergeResult
from millrace.plans.feed import run_feed
from millrace.plans.spec import FeedSpec
from millrace.sources.snapshot import SnapshotTable
from millrace.sources.text import list_files, move_files


def ingest_feed(
    spark: SparkSession,
    spec: FeedSpec,
    inbox: str,
    root: str,
    checkpoint: str,
    run_ts: str | None = None,
    archive: str | None = None,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """New files of an inbox through ``run_feed``, one micro-batch at a time.

    The stream carries file names only. A batch that is replayed after a failure finds its run id in
    the table's log, and a file that returns under any name finds its content in the ledger.

    With ``archive``, the files of a batch move there once the batch is committed, to a folder of its day and run. A
    stream that dies in between finds the batch applied when it starts again, and only moves what is left of it.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
    )

    def apply(batch: DataFrame, epoch: int) -> None:
        paths = [r["path"] for r in batch.select("path").toLocalIterator()]
        known = [p for p in paths if p.lower().endswith((".csv", ".dbf"))]
        if not known:
            return
        # The same files give the same run id, so a replayed batch finds itself applied.
        digest = hashlib.md5("\n".join(sorted(known)).encode(), usedforsecurity=False).hexdigest()
        stamp = run_ts or datetime.now().strftime("%Y-%m-%d %H:%M:%S")
        result = run_feed(batch.sparkSession, spec, known, root, stamp, f"{spec.code}-{digest}")
        if archive:
            below = f"{archive.rstrip('/')}/{stamp[:10]}/{result.run_id}"
            move_files(batch.sparkSession, [(p, f"{below}/{archive_name(p, inbox)}") for p in known])

    return (
        reader.load(inbox)
        .select("path")
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def archive_name(path: str, inbox: str) -> str:
    """The path of a file below its inbox, or its name where the inbox is given by another address."""
    plain = inbox.split(":", 1)[-1].rstrip("/") + "/"
    return path.split(plain, 1)[1] if plain in path else path.rsplit("/", 1)[-1]


def merge_stream(
    stream: DataFrame,
    table: SnapshotTable,
    merge: Callable[[DataFrame, DataFrame], MergeResult],
    prepare: Callable[[DataFrame], DataFrame],
    name: str,
    checkpoint: str,
) -> StreamingQuery:
    """Merge each micro-batch of rows into a table. Checkpoint and batch number make the run id, so a
    replayed batch is skipped even when the failure came after its commit. A stream that starts over
    without its checkpoint merges its rows again, which changes nothing under an upsert."""
    origin = hashlib.md5(checkpoint.encode(), usedforsecurity=False).hexdigest()

    def apply(batch: DataFrame, epoch: int) -> None:
        run_id = f"{name}-{origin}-{epoch}"
        if table.applied(run_id):
            return
        rows = prepare(batch)
        touched = table.touched(rows)
        if touched:
            table.replace(merge(table.read(touched), rows).snapshot, touched, run_id)

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_table_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000
) -> DataFrame:
    """Parquet files below a folder as a stream, new files only."""
    return (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def dedup_stream(
    stream: DataFrame, keys: list[str], event_time: str | None = None, keep_for: str | None = None
) -> DataFrame:
    """First arrival per key across all files.

    The state holds one entry per key for good, unless an event time and a retention bound are given.
    """
    if event_time and keep_for:
        return stream.withWatermark(event_time, keep_for).dropDuplicatesWithinWatermark(keys)
    return stream.dropDuplicates(keys)


def dedup_to_table(stream: DataFrame, keys: list[str], arrived: str, keep_for: str, path: str, checkpoint: str) -> StreamingQuery:
    """First arrival per key across all files into a table, with a state that is bounded.

    The state keeps the keys of the last ``keep_for`` of ``arrived``, the time rows came in, which never goes back
    from batch to batch. What passes it is looked up in the table, so that a key that returns later than that is
    dropped all the same: the result is exact, and the state only spares look-ups. Batches are folders, so one
    that is replayed writes over itself.
    """
    columns = stream.columns

    def apply(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        done = [f.path for f in _folders(spark, path) if int(f.name.removeprefix("batch=")) < epoch]
        fresh = batch.select(columns)
        if done:
            # Rows without a whole key are equal to each other here, so NULLs must meet.
            stored = spark.read.schema(fresh.schema).parquet(*done).select([F.col(k).alias(f"_{k}") for k in keys])
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
            fresh = fresh.join(stored, same, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    return (
        dedup_stream(stream, keys, arrived, keep_for)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


@dataclass(frozen=True)
class Folder:
    name: str
    path: str


def _folders(spark: SparkSession, path: str) -> list[Folder]:
    """The batch folders of a table that hold a file, as Spark's listing of it names them."""
    try:
        files = list_files(spark, path, "*.parquet")
        names = files.select(F.regexp_extract("path", "/(batch=[0-9]+)/", 1).alias("name")).distinct()
        return [Folder(r["name"], f"{path}/{r['name']}") for r in names.collect()]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return []
        raise
