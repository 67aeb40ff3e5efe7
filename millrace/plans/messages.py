"""Message rows to the files they announce: links and attachments, fields, class, feed and ledger key, each key once.

Messages are a table: (message_id, received, subject, body, plain), with an optional table of attachments
(message_id, filename). What a message announces is a row of work: its key is known for good once the run commits, and a
key that several messages of one batch announce belongs to the first of them.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.extract import field, html_fields, ledger_key, message_links, source_class
from millrace.functions.routing import route_col
from millrace.operators.filters import has_extension, received_on
from millrace.operators.skew import spread_join

KEY_SCHEMA = "file_key string, run_id string, recorded_at bigint"
WORK_SCHEMA = (
    "message_id bigint, received timestamp_ntz, subject string, kind string, location string, source string, file_type string, "
    "fields map<string,string>, code string, table_name string, file_key string"
)
LINK, ATTACHMENT = "link", "attachment"


def announced(messages: DataFrame, attachments: DataFrame | None = None) -> DataFrame:
    """One row per link or archive attachment of each message.

    The fields come from the first table of the body; the feed from the subject. A link is known by subject and
    address, an attachment by its name and the subject.
    """
    fields = F.coalesce(html_fields(F.col("body")), F.create_map().cast("map<string,string>"))
    read = messages.select(
        "message_id",
        "received",
        F.coalesce("subject", F.lit("")).alias("subject"),
        message_links(F.coalesce("body", F.lit(""))).alias("links"),
        fields.alias("fields"),
    )
    own = ["message_id", "received", "subject", "fields"]
    links = read.select(*own, F.lit(LINK).alias("kind"), F.explode("links").alias("location"))
    links = links.withColumns({"source": source_class(F.col("location")), "file_key": ledger_key(F.col("subject"), F.col("location"))})
    found = links
    if attachments is not None:
        archives = attachments.where(has_extension(F.col("filename"), (".zip",)))
        files = read.select(*own).join(archives.select("message_id", F.col("filename").alias("location")), "message_id")
        files = files.select(*own, F.lit(ATTACHMENT).alias("kind"), "location", F.lit("cams").alias("source"), ledger_key(F.col("location"), F.col("subject")).alias("file_key"))
        found = links.unionByName(files)
    return found.withColumns(
        {"file_type": field(F.col("fields"), "File Type"), "code": route_col(F.col("subject"), to_code=True), "table_name": route_col(F.col("subject"))}
    )


def first_claims(work: DataFrame) -> DataFrame:
    """The row of each key that claims it: the earliest message, then the smallest id. Combined before the shuffle, so a
    key in every message is one row per task."""
    rest = [c for c in work.columns if c != "file_key"]
    order = F.struct(F.coalesce(F.col("received").cast("timestamp_ntz"), F.lit("9999-12-31").cast("timestamp_ntz")), "message_id", "kind", "location")
    best = work.groupBy("file_key").agg(F.min_by(F.struct(*rest), order).alias("_one"))
    return best.select("_one.*", "file_key").select(work.columns)


def message_files(
    messages: DataFrame, known: DataFrame, attachments: DataFrame | None = None, day: str | None = None
) -> DataFrame:
    """What the messages (of one day) announce and no earlier run has taken; ``known`` holds file_key."""
    if day is not None:
        messages = messages.where(received_on(F.col("received"), day))
    claimed = first_claims(announced(messages, attachments))
    return spread_join(claimed, known.select("file_key").distinct(), ["file_key"], ["file_key"], "left_anti").select(claimed.columns)


def run_messages(
    spark: SparkSession,
    messages: DataFrame,
    root: str,
    run_id: str,
    attachments: DataFrame | None = None,
    day: str | None = None,
) -> DataFrame:
    """The new work of a run, written below ``root``; its keys are then known, which is the commit.

    A run that dies before that leaves its keys free. A run that is started again under its id returns what it had.
    """
    root = root.rstrip("/")
    keys = _read_or_empty(spark, f"{root}/message_keys", KEY_SCHEMA)
    work = f"{root}/messages/run_id={run_id}"
    if keys.where(F.col("run_id") == run_id).isEmpty():
        fresh = message_files(messages, keys, attachments, day)
        shape = StructType.fromDDL(WORK_SCHEMA)
        fresh.select([F.col(f.name).cast(f.dataType) for f in shape]).write.mode("overwrite").parquet(work)
        taken = spark.read.parquet(work).select("file_key", F.lit(run_id).alias("run_id"), F.lit(time.time_ns()).alias("recorded_at"))
        taken.write.mode("append").parquet(f"{root}/message_keys")
    return spark.read.schema(WORK_SCHEMA).parquet(work)


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise
