"""Counts per file and per job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUMMARY_SCHEMA = (
    "run_date date, feed string, source_file string, total_rows bigint, inserted bigint, "
    "updated bigint, unchanged bigint, duplicates bigint, failed bigint, status string, detail string"
)

ACTIONS = ("insert", "update", "unchanged", "duplicate", "reject")


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/\\]+$", 0)


def file_summary(rows: DataFrame, by: list[str]) -> DataFrame:
    """Counts of a row-level ``action`` column; combines on the map side, so a huge file is no hot spot."""
    count = lambda a: F.count_if(F.col("action") == a)
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"),
        count("insert").alias("inserted"),
        count("update").alias("updated"),
        count("unchanged").alias("unchanged"),
        count("duplicate").alias("duplicates"),
        count("reject").alias("failed"),
    )


def detail_line(file: Column, records: Column, table: Column, error: Column) -> Column:
    """One line of the job report."""
    return F.when(
        error.isNull(),
        F.concat(file, F.lit(" - "), records.cast("string"), F.lit(" records -> "), table),
    ).otherwise(F.concat(file, F.lit(" - Error: "), error))


def job_summary(files: DataFrame) -> DataFrame:
    """Successes, failures, total and detail text per run from (run_date, feed, file, records, error).

    The text lists feeds, of which there are as many as registered codes; the lines of single files
    stay rows (``detail_line``) because their number has no bound.
    """
    failed = F.col("error").isNotNull()
    per_feed = files.groupBy("run_date", "feed").agg(
        F.count_if(~failed).alias("ok"),
        F.count_if(failed).alias("bad"),
        F.sum("records").alias("records"),
    )
    line = F.concat(
        F.col("feed"),
        F.lit(": "),
        F.col("ok").cast("string"),
        F.lit(" ok, "),
        F.col("bad").cast("string"),
        F.lit(" failed, "),
        F.col("records").cast("string"),
        F.lit(" records"),
    )
    return per_feed.groupBy("run_date").agg(
        F.sum("ok").alias("success"),
        F.sum("bad").alias("failures"),
        F.sum(F.col("ok") + F.col("bad")).alias("total"),
        F.array_join(F.array_sort(F.collect_list(line)), "; ").alias("details"),
    )
