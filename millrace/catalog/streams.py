"""Streaming forms. Events are written as feed files to the shared folder and streamed from there; each
query drains its streams and returns the final table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.catalog.base import query, table
from millrace.catalog.runs import RUN_TS, write_lines
from millrace.operators import merge
from millrace.operators.dedup import keep_last
from millrace.plans.feed import FeedStore
from millrace.plans.registry import FEEDS
from millrace.session import scratch_path
from millrace.sources.snapshot import SnapshotTable, hash_part
from millrace.sources.text import list_files
from millrace.streaming.ingest import dedup_to_table, ingest_feed, merge_stream, read_table_stream

COLUMNS = ["event_id", "user_id", "event_type", "value", "wave"]
KEYS = ["event_id"]


def wave_rows(spark, sf_dir, wave: int) -> DataFrame:
    """The first wave holds all events; the second corrects values and moves some to new ids."""
    events = table(spark, sf_dir, "events")
    if wave == 1:
        return events.selectExpr("event_id", "user_id", "event_type", "value", "1 AS wave")
    return events.selectExpr(
        "CASE WHEN event_type = 'error' THEN event_id + 1000000000000 ELSE event_id END AS event_id",
        "user_id",
        "event_type",
        "value + 1 AS value",
        "2 AS wave",
    )


def merged(spark, table_: SnapshotTable, inbox: str, name: str, checkpoint: str) -> None:
    update = ["user_id", "event_type", "value", "wave"]
    merge_stream(
        read_table_stream(spark, inbox, table_.schema),
        table_,
        lambda target, rows: merge.upsert(target, rows, KEYS, update, KEYS),
        lambda rows: keep_last(rows, KEYS, ["wave", "value"]),
        name,
        checkpoint,
    ).awaitTermination()


def event_table(spark, sf_dir) -> SnapshotTable:
    schema = wave_rows(spark, sf_dir, 1).schema
    return SnapshotTable(spark, scratch_path(spark, "events"), schema, hash_part(KEYS, 8))


MERGED_SQL = """SELECT event_id, user_id, event_type, CASE WHEN event_type = 'error' THEN value ELSE value + 1 END AS value,
    CASE WHEN event_type = 'error' THEN 1 ELSE 2 END AS wave FROM events
  UNION ALL SELECT event_id + 1000000000000, user_id, event_type, value + 1, 2 FROM events WHERE event_type = 'error'"""


@query("stream_ingest_merge", MERGED_SQL)
def stream_ingest_merge(spark, sf_dir):
    """Two waves of files through one stream with one checkpoint."""
    target, inbox = event_table(spark, sf_dir), scratch_path(spark, "inbox")
    checkpoint = scratch_path(spark, "checkpoint")
    for wave in (1, 2):
        wave_rows(spark, sf_dir, wave).write.mode("append").parquet(f"{inbox}/wave{wave}")
        merged(spark, target, inbox, "ingest", checkpoint)
    return target.read().select(COLUMNS)


@query("stream_replay_idempotent", MERGED_SQL)
def stream_replay_idempotent(spark, sf_dir):
    """Files that come twice, and a whole stream that starts again without its checkpoint, change nothing."""
    target, inbox = event_table(spark, sf_dir), scratch_path(spark, "inbox")
    checkpoint = scratch_path(spark, "checkpoint")
    for wave in (1, 2):
        for copy in ("a", "b"):
            wave_rows(spark, sf_dir, wave).write.mode("append").parquet(f"{inbox}/wave{wave}{copy}")
        merged(spark, target, inbox, "replay", checkpoint)
    merged(spark, target, inbox, "replay", scratch_path(spark, "checkpoint"))
    return target.read().select(COLUMNS)


@query(
    "stream_dedup_keys",
    """SELECT event_id, user_id, event_type, value FROM events
    UNION ALL SELECT event_id + 1000000000000, user_id, 'late', value FROM events WHERE event_id % 3 = 0""",
)
def stream_dedup_keys(spark, sf_dir):
    """Every file arrives twice, some keys return within the state's time and some beyond it; each comes out once."""
    inbox, out = scratch_path(spark, "inbox"), scratch_path(spark, "unique")
    checkpoint = scratch_path(spark, "checkpoint")
    events = wave_rows(spark, sf_dir, 1).drop("wave")
    late = events.where("event_id % 3 = 0").selectExpr("event_id + 1000000000000 AS event_id", "user_id", "'late' AS event_type", "value")
    waves = [events.union(events), events.where("event_id % 2 = 0"), events.union(late), late]
    for n, (rows, hours) in enumerate(zip(waves, (0, 1, 9, 30), strict=True)):
        stamp = f"timestamp'2024-01-01 00:00:00' + make_dt_interval(0, {hours})"
        arriving = rows.selectExpr("*", f"{stamp} AS arrived")
        arriving.write.parquet(f"{inbox}/{n}")
        dedup_to_table(read_table_stream(spark, inbox, arriving.schema), KEYS, "arrived", "2 hours", out, checkpoint).awaitTermination()
    return spark.read.schema(events.schema).option("recursiveFileLookup", "true").parquet(out)


ARCHIVED_LINE = """CAST(o_custkey AS STRING) || ',T' || CAST(o_orderkey AS STRING) || ',' || date_format(o_orderdate, 'yyyy-MM-dd')"""


@query(
    "stream_ingest_archive",
    """SELECT CAST(o_custkey AS VARCHAR) AS folio_no, 'T' || o_orderkey AS trxnno, CAST(o_orderdate AS DATE) AS traddate FROM orders""",
)
def stream_ingest_archive(spark, sf_dir):
    """Two deliveries through the feed stream, the second with copies of the first; files move to the archive."""
    inbox, root, archive = scratch_path(spark, "inbox"), scratch_path(spark, "store"), scratch_path(spark, "archive")
    checkpoint, spec = scratch_path(spark, "checkpoint"), FEEDS["wbr2c"]
    orders = table(spark, sf_dir, "orders")
    parts = [orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 2 = 1")]
    sent = 0
    for n, wave in enumerate((parts[:1], parts)):
        for k, rows in enumerate(wave):
            folder = f"{inbox}/{n}-{k}"
            write_lines(rows.selectExpr(ARCHIVED_LINE), "FOLIO_NO,TrxnNo,TRADDATE", folder)
            sent += list_files(spark, folder, "*.csv").count()
        ingest_feed(spark, spec, inbox, root, checkpoint, RUN_TS, archive).awaitTermination()
    left, moved = list_files(spark, inbox, "*.csv").count(), list_files(spark, archive, "*.csv").count()
    if (left, moved) != (0, sent):
        raise RuntimeError(f"{left} files left, {moved} of {sent} archived")
    return FeedStore(spark, root).table(spec).read().select("folio_no", "trxnno", "traddate")
