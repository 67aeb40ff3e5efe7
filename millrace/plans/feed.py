"""One feed from raw rows to merged table: the plan, and the run that writes it."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.functions.names import match_column, plain_name, snake_case
from millrace.operators import dedup, ledger, merge, report, validate
from millrace.operators.filters import FEED_EXTENSIONS, has_extension
from millrace.operators.position import FILE_ROWS, POSITION, known_empty, land, lost_positions, repeated_keys, with_position
from millrace.operators.schema import LINEAGE, absent_cells, conform, conform_dynamic, dynamic_kinds, quoted, rename_all
from millrace.operators.skew import incomplete
from millrace.plans.spec import FeedSpec
from millrace.session import compiled_methods
from millrace.sources import dbf, heads
from millrace.sources.snapshot import SnapshotTable
from millrace.sources.text import ORDER, list_files, plain_path, read_csv_strings

# A batch may be broadcast against its target when its plain, uncompressed files are smaller than this.
SMALL_BATCH_BYTES = 32 << 20

# Keys that several files of a batch hold are broadcast up to this many.
BROADCAST_KEYS = 200_000


RAW = "_raw"
# The record of a row with more cells than its header; and the cells that could not be read.
SURPLUS, BAD = "_surplus", "_bad"
# The input cells of a landed row.
CELLS = "_cells"
# The file of a row whose input is a folder of files.
SHEET = "_sheet"


@dataclass(frozen=True)
class FeedPlan:
    """The merge, and the positions with raw text of the rows left out before it; ``refused`` has the reason too,
    ``members`` every row of a key that the parts of one input share."""

    result: merge.MergeResult
    duplicates: DataFrame
    dropped: DataFrame
    refused: DataFrame
    members: DataFrame


def input_columns(raw: DataFrame) -> list[str]:
    return [c for c in raw.columns if c not in (*ORDER, SURPLUS)]


def _named(spec: FeedSpec, raw: DataFrame, *more: Column) -> DataFrame:
    """Input rows under the names of the feed's rule, and ``more`` columns under their own."""
    rule = plain_name if spec.code == "scheme" else snake_case
    own = (*ORDER, SURPLUS, RAW, CELLS)
    if SURPLUS not in raw.columns:
        raw = raw.withColumn(SURPLUS, F.lit(None).cast("string"))
    return rename_all(raw.select("*", *more), lambda n: n if n in own else rule(n))


def _typed(spec: FeedSpec, raw: DataFrame, run_ts: str, whole: Column, name: str) -> DataFrame:
    """Typed rows with lineage and position, and ``whole`` beside them, in one projection."""
    shape = conform_dynamic if spec.dynamic else conform
    now = F.lit(run_ts).cast("timestamp")
    rows = shape(_named(spec, raw, whole.alias(name)), spec.cleaning, (*ORDER, SURPLUS, name), century_from(run_ts), BAD)
    return rows.select("*", now.alias("created_at"), now.alias("updated_at"))


def century_from(run_ts: str) -> int:
    return int(run_ts[:4]) - 50


def stage(spec: FeedSpec, raw: DataFrame, run_ts: str) -> DataFrame:
    """Typed rows with lineage, position and the untouched input row as JSON, in one projection."""
    whole = F.to_json(F.struct(*[F.col(quoted(c)) for c in input_columns(raw)]))
    if SURPLUS in raw.columns:
        whole = F.coalesce(F.col(SURPLUS), whole)
    return _typed(spec, raw, run_ts, whole, RAW)


def same_in_all(spec: FeedSpec, raw: DataFrame, run_ts: str) -> dict[str, Column]:
    """Columns of ``stage`` that hold one value in all rows: those the input lacks, and the times of the run."""
    now = F.lit(run_ts).cast("timestamp")
    keep = (*ORDER, SURPLUS)
    return {**absent_cells(_named(spec, raw).columns, spec.cleaning, keep, spec.dynamic), "created_at": now, "updated_at": now}


def land_staged(spec: FeedSpec, raw: DataFrame, run_ts: str, path: str) -> DataFrame:
    """``stage`` by way of a table. It holds the input cells one by one, of which the JSON is only made where it is read,
    and no column that is the same in all rows."""
    names = input_columns(raw)
    cells = [F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(names)] or [F.lit(None).cast("string").alias("c0")]
    rows, same = _typed(spec, raw, run_ts, F.struct(*cells), CELLS), same_in_all(spec, raw, run_ts)
    kept = rows.drop(*same)
    with compiled_methods(raw.sparkSession):
        kept.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    whole = F.to_json(F.struct(*[F.col(f"{CELLS}.c{i}").alias(c) for i, c in enumerate(names)]))
    shown = {**same, CELLS: F.coalesce(F.col(SURPLUS), whole).alias(RAW)}
    stored = raw.sparkSession.read.schema(kept.schema).parquet(path)
    return stored.select([shown[c].alias(RAW if c == CELLS else c) if c in shown else F.col(quoted(c)) for c in rows.columns])


def collapse_files(source: DataFrame, keys: list[str], update: list[str]) -> DataFrame:
    """Files of one batch as if merged one after another: a key keeps its first row, and takes the
    update columns of its last.

    Where rows have positions, both ends of a key are found from these alone, and only rows of keys that came more than
    once are put together. Otherwise, and where such keys are too many, it is one aggregation with map-side combine.
    """
    if POSITION in source.columns and SHEET not in source.columns:
        ends = source.where(~incomplete(keys)).groupBy(*keys).agg(F.min(POSITION).alias("_first"), F.max(POSITION).alias("_last"))
        several = land(ends.where(F.col("_first") < F.col("_last")), "several")
        if several.count() <= BROADCAST_KEYS:
            marked = source.join(F.broadcast(several), keys, "left")
            alone = marked.where(F.col("_first").isNull()).select(source.columns)
            last = marked.where(F.col(POSITION) == F.col("_last")).select(F.col("_first").alias("_of"), *update)
            first = marked.where(F.col(POSITION) == F.col("_first")).drop(*update)
            return alone.unionByName(first.join(last.hint("merge"), F.col("_first") == F.col("_of")).select(source.columns))
    fixed = [c for c in source.columns if c not in keys and c not in update]
    at = F.struct(*ORDER)
    ends = (
        source.where(~incomplete(keys))
        .groupBy(*keys)
        .agg(
            F.min_by(F.struct(*fixed), at).alias("_first"),
            F.max_by(F.struct(*update), at).alias("_last"),
        )
        .select(*keys, "_first.*", "_last.*")
    )
    return ends.unionByName(source.where(incomplete(keys)))


def merged(
    spec: FeedSpec,
    target: DataFrame,
    some: DataFrame,
    alone: DataFrame | None,
    order: list[str],
    many_files: bool,
    small_source: bool,
) -> merge.MergeResult:
    """The merge of a batch under the feed's policy; rows that no other row shares the key with may come as ``alone``."""
    keys, update = spec.merge_keys, spec.update_columns
    whole = lambda rows: rows if alone is None else rows.unionByName(alone)
    batch = source = whole(some)
    collapsed = bool(keys) and (spec.policy == "dynamic_key" or many_files and spec.policy in ("upsert", "declared_key"))
    if collapsed:
        source = whole(collapse_files(some, keys, update))
    match spec.policy:
        case "upsert":
            result = merge.upsert(target, source, keys, update, order, small_source)
        case "declared_key":
            result = merge.declared_key(
                target, source, list(spec.keys), update, order, spec.key_declared, small_source
            )
        case "dynamic_key" if keys:
            result = merge.upsert(target, source, keys, update, order, small_source)
        case "append" | "dynamic_key":
            result = merge.append(target, source)
        case "contact_only":
            result = merge.contact_only(
                target, source, keys, update, order, small_source=small_source, many_files=many_files
            )
        case "if_changed":
            result = merge.if_changed(
                target, source, keys, list(spec.tracked), update, order, small_source=small_source,
                files=["file_path"] if many_files else None,
            )
        case "last_wins":
            result = merge.last_wins(
                target, source, keys, list(spec.kinds), list(LINEAGE), order, small_source=small_source, repeated=some
            )
    if collapsed:
        result = merge.MergeResult(
            result.snapshot,
            lambda: merge.ordered_actions(batch, target, keys, order, small_source, some),
        )
    return result


def plan_feed(
    spec: FeedSpec,
    staged: DataFrame,
    target: DataFrame,
    many_files: bool = False,
    small_source: bool = False,
) -> FeedPlan:
    """The whole feed as lazy frames over staged rows."""
    keys, update = spec.merge_keys, spec.update_columns
    order = [POSITION] if POSITION in staged.columns else ORDER
    shown = list(dict.fromkeys([*ORDER, *order]))
    part = [SHEET] if SHEET in staged.columns else []
    narrow = lambda rows: rows.select(*spec.keys, *shown, *part, RAW)
    slim = narrow(staged)
    nothing = slim.where(F.lit(False)).select(*ORDER, RAW)
    dropped = duplicates = members = nothing
    if spec.complete_key:
        dropped = slim.where(incomplete(list(spec.keys))).select(*ORDER, RAW)
        staged, slim = staged.dropna(subset=list(spec.keys)), slim.dropna(subset=list(spec.keys))
    # Rows alone under their key need neither be compared nor put in order; ``some`` are all the others.
    repeats = repeated_keys(slim, keys or list(spec.keys)) if spec.keys and order == [POSITION] else None
    alone, some = (repeats.others(staged), repeats.rows(staged)) if repeats else (None, staged)
    if repeats and repeats.count:
        some = land(some, "repeated")
    batch, few = some.drop(RAW, SURPLUS, BAD), narrow(some)
    if spec.in_file is not None and (repeats is None or repeats.count):
        keep = dedup.keep_first if spec.in_file == "first" else dedup.keep_last
        per_file = [*spec.keys, "file_path"]
        kept = keep(few.drop(RAW), per_file, order).select(order)
        lost = lost_positions(few, per_file, spec.in_file) if order == [POSITION] else None
        if lost is not None:
            # The few rows that go are broadcast: the wide rows that stay are neither sorted nor shuffled.
            duplicates = few.select(*shown, RAW).join(lost, POSITION).select(*ORDER, RAW)
            batch = batch.join(lost, POSITION, "left_anti").select(batch.columns)
        else:
            duplicates = few.select(*shown, RAW).join(kept, order, "left_anti").select(*ORDER, RAW)
            batch = keep(batch, per_file, order)
        if part:
            # A key once per part first; then whatever more than one part holds.
            parts = keep(few.drop(RAW), [*per_file, *part], order)
            shared = dedup.group_members(parts, per_file, order).select(order)
            members = few.select(*shown, RAW).join(shared, order, "left_semi").select(*ORDER, RAW)
    if alone is not None:
        alone = alone.drop(RAW, SURPLUS, BAD)
    refused = nothing.withColumn("reason", F.lit(None).cast("string"))
    if spec.limits:
        rules = validate.limits(spec.limits)
        batch, bad = validate.split_valid(batch, rules=rules)
        if alone is not None:
            alone, more = validate.split_valid(alone, rules=rules)
            bad = bad.unionByName(more)
        refused = slim.select(*shown, RAW).join(bad.select(*order, "reason"), order).select(*ORDER, RAW, "reason")

    if alone is not None and known_empty(target):
        # Nothing stored to meet: rows alone under their key are inserted as they are.
        result = merge.append(target, alone)
        if repeats.count:
            first, rest = result, merged(spec, target, batch, None, order, many_files, small_source)
            result = merge.MergeResult(
                first.snapshot.unionByName(rest.snapshot), lambda: first.actions.unionByName(rest.actions)
            )
    else:
        result = merged(spec, target, batch, alone, order, many_files, small_source)
    return FeedPlan(result, duplicates, dropped, refused, members)


@dataclass(frozen=True)
class FeedResult:
    """One record for every outcome; ``status`` is success, skipped or error."""

    feed: str
    status: str
    detail: str = ""
    run_id: str = ""
    summary: DataFrame | None = None


class FeedStore:
    """Folders of one installation below a shared root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def table(self, spec: FeedSpec) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/tables/{spec.table}", spec.schema, spec.part)

    def read_or_empty(self, name: str, schema: str) -> DataFrame:
        empty = self.spark.createDataFrame([], schema)
        try:
            return self.spark.read.schema(empty.schema).parquet(f"{self.root}/{name}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return empty
            raise

    def ledger(self, spec: FeedSpec) -> DataFrame:
        """One row per input the feed has claimed or completed."""
        return ledger.current(self.read_or_empty(f"ledger/{spec.table}", ledger.EVENT_SCHEMA))

    def record(self, spec: FeedSpec, entries: DataFrame) -> None:
        """Adds entries to the ledger; the last one of a hash counts. One small file and one commit, nothing is rewritten."""
        told = entries.withColumn("recorded_at", F.lit(time.time_ns()))
        told.coalesce(1).write.mode("append").parquet(f"{self.root}/ledger/{spec.table}")

    def completed(self, spec: FeedSpec) -> DataFrame:
        """Ledger rows of input that is merged: completed ones, and claims of runs that are in the table's log but
        died before they could complete them."""
        entries = self.ledger(spec)
        applied = self.table(spec).runs().withColumn("_applied", F.lit(True))
        merged = (F.col("status") == ledger.COMPLETED) | ((F.col("status") == ledger.CLAIMED) & F.col("_applied"))
        return entries.join(applied, "run_id", "left").where(merged).drop("_applied").withColumn("status", F.lit(ledger.COMPLETED))


def hash_files(files: DataFrame) -> DataFrame:
    """(path, file_hash) of whole files."""
    cloudpickle.register_pickle_by_value(heads)
    return files.select("path").mapInArrow(heads.hash_files, "path string, file_hash string")


def read_raw(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All rows as strings with their position, each file read by its extension. ``file_path`` is an address, as in a
    row's metadata: ``plain_path`` has the path, and it is told once per split, not for every row."""
    tables = [p for p in paths if p.lower().endswith(".dbf")]
    texts = [p for p in paths if p.lower().endswith(".csv")]
    frames = [read_csv_strings(spark, texts, with_position=True, surplus=SURPLUS, plain=False)] if texts else []
    if tables:
        df = dbf.read_tables(spark, tables)
        frames.append(
            df.select(
                *[quoted(c) for c in df.columns if c not in ("file_path", "row_ord")],
                F.replace(F.col("file_path"), F.lit("%"), F.lit("%25")).alias("file_path"),
                F.lit(0).cast("bigint").alias("row_block"),
                F.col("row_ord").alias("row_seq"),
            )
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def run_feed(
    spark: SparkSession,
    spec: FeedSpec,
    path: str | list[str],
    root: str,
    run_ts: str | None = None,
    run_id: str | None = None,
) -> FeedResult:
    """Ingest new files of one feed and merge them.

    Files are known by content; a copy, or a file merged before, changes nothing. The raw rows land
    as a table first, so that positions are fixed and the text is parsed once. The merge commits in
    one step; a run that dies before it leaves the target as it was.
    """
    run_ts = run_ts or datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    run_id = run_id or uuid.uuid4().hex
    store = FeedStore(spark, root)
    table = store.table(spec)
    if table.applied(run_id):
        return FeedResult(spec.code, "skipped", "run_already_applied", run_id)
    # Listed paths have the form that rows name their file in.
    files = list_files(spark, path).where(has_extension(F.col("path"), FEED_EXTENSIONS))
    inputs = input_hashes(hash_files(files), spec).withColumn("table_name", F.lit(spec.table))
    fresh = ledger.unprocessed(inputs, store.completed(spec), ["source_file"])
    if spec.policy == "contact_only":
        # A file that is stored under its path is skipped as a whole, whatever it holds now.
        fresh = fresh.join(store.completed(spec).select("source_file").distinct(), "source_file", "left_anti")
    # File names only, as many as Spark's own file index holds for the same folder.
    todo = fresh.select("source_file", "file_hash", F.explode("paths").alias("path")).toLocalIterator()
    paths: dict[str, str] = {}
    hashes: dict[str, str] = {}
    for r in todo:
        paths[r["path"]], hashes[r["source_file"]] = r["source_file"], r["file_hash"]
    if not paths:
        return FeedResult(spec.code, "skipped", "file_already_processed", run_id)
    return FeedResult(spec.code, "success", "", run_id, _run_batch(store, spec, sorted(paths), hashes, run_ts, run_id))


WORKBOOK_RE = r"(?i)^(.*?\.xlsx?)/"
SHEET_RE = r"(?i)^(.*?\.xlsx?/[^/]+)"


def workbook_of(path: Column) -> Column:
    """The input a file belongs to: the folder that is named like a workbook, or the file itself."""
    return F.coalesce(F.nullif(F.regexp_extract(path, WORKBOOK_RE, 1), F.lit("")), path)


def sheet_of(path: Column) -> Column:
    """The sheet a file belongs to: a file, or a folder of files, in the folder of a workbook."""
    return F.coalesce(F.nullif(F.regexp_extract(path, SHEET_RE, 1), F.lit("")), path)


def input_hashes(hashed: DataFrame, spec: FeedSpec) -> DataFrame:
    """(source_file, file_hash, paths) of whole inputs. A workbook is known by the hashes of its sheets in their order."""
    if not spec.workbook:
        return hashed.select(F.col("path").alias("source_file"), "file_hash", F.array("path").alias("paths"))
    sheets = F.sort_array(F.collect_list(F.struct("path", "file_hash")))
    books = hashed.groupBy(workbook_of(F.col("path")).alias("source_file")).agg(sheets.alias("sheets"))
    combined = F.when(F.size("sheets") == 1, F.col("sheets")[0]["file_hash"]).otherwise(F.md5(F.array_join("sheets.file_hash", ",")))
    return books.select("source_file", combined.alias("file_hash"), F.col("sheets.path").alias("paths"))


def with_all_columns(spec: FeedSpec, table: SnapshotTable, raw: DataFrame) -> FeedSpec:
    """A feed whose columns only its table knows: those of the stored table, or, before there is one,
    the known columns and every other column of the input."""
    if spec.policy != "dynamic_key":
        return spec
    stored = table.stored_schema()
    if stored is not None:
        return spec.for_catalog(stored)
    headers = [snake_case(c) for c in raw.columns if c not in (*ORDER, SURPLUS)]
    used = {match_column(name, headers) for name in spec.kinds}
    rest = StructType([StructField(h, StringType()) for h in headers if h not in used])
    more = dynamic_kinds(rest, date_words=spec.date_words, number_words=spec.number_words)
    return replace(spec, kinds={**spec.kinds, **more})


def _run_batch(
    store: FeedStore, spec: FeedSpec, files: list[str], hashes: dict[str, str], run_ts: str, run_id: str
) -> DataFrame:
    """``files`` are read, ``hashes`` holds the hash of each input they make up."""
    spark = store.spark
    raw = read_raw(spark, files)
    spec = with_all_columns(spec, store.table(spec), raw)
    table = store.table(spec)
    now = F.lit(run_ts).cast("timestamp")
    claims = spark.createDataFrame(list(hashes.items()), "source_file string, file_hash string").select(
        "file_hash",
        F.lit(spec.table).alias("table_name"),
        "source_file",
        F.lit(0).cast("bigint").alias("total_records"),
        F.lit(ledger.CLAIMED).alias("status"),
        now.alias("processed_at"),
        now.alias("created_at"),
        F.lit(run_id).alias("run_id"),
    )
    store.record(spec, claims)
    landing = f"{store.root}/landing/{spec.table}/{run_id}"
    landed = with_position(land_staged(spec, raw, run_ts, landing), plain_path)
    if spec.workbook:
        # The place of a row comes from its sheet; from here on its file is the workbook.
        landed = landed.withColumn(SHEET, sheet_of(F.col("file_path"))).withColumn("file_path", workbook_of(F.col("file_path")))
    staged = landed.where(F.col(SURPLUS).isNull())
    # Rows that are stored although cells of them could not be read.
    landed.where((F.size(BAD) > 0) & F.col(SURPLUS).isNull()).select(
        F.lit(spec.code).alias("feed"), *ORDER, F.col(BAD).alias("cells"), F.col(RAW).alias("raw")
    ).write.mode("overwrite").parquet(f"{store.root}/unread/run_id={run_id}")

    keyed = bool(spec.merge_keys)
    touched = table.touched(staged) if keyed else set()
    # An append does not look at what is stored.
    target = table.read(touched)
    size = list_files(spark, files).agg(F.sum("length")).first()[0]
    plan = plan_feed(
        spec, staged, target, many_files=len(hashes) > 1, small_source=size <= SMALL_BATCH_BYTES
    )
    run_date = F.lit(run_ts).cast("date").alias("run_date")
    marked = lambda df, action, reason: df.withColumns({"action": F.lit(action), "reason": F.lit(reason)})
    surplus = landed.where(F.col(SURPLUS).isNotNull()).select(*ORDER, RAW)
    lost = (
        marked(plan.duplicates, "duplicate", "key repeated in file")
        .unionByName(marked(plan.dropped, "reject", "incomplete key"))
        .unionByName(marked(surplus, "reject", "more cells than the header"))
        .unionByName(plan.refused.withColumn("action", F.lit("reject")))
    )
    base = f"{store.root}/rejects/run_id={run_id}"
    lost.select(run_date, F.lit(spec.code).alias("feed"), *ORDER, "action", "reason", F.col(RAW).alias("raw")).write.mode(
        "overwrite"
    ).partitionBy("run_date", "feed").parquet(base)
    if spec.workbook:
        plan.members.select(run_date, F.lit(spec.code).alias("feed"), *ORDER, F.col(RAW).alias("raw")).write.mode(
            "overwrite"
        ).parquet(f"{store.root}/duplicates/run_id={run_id}")
    acted = f"{store.root}/actions/{spec.table}/run_id={run_id}"
    # One day: its folder is named here, since rows that are written by a column's value are sorted for that.
    day = spark.range(1).select(run_date.cast("string")).first()[0]
    plan.result.actions.select(*spec.columns, "action").write.mode("overwrite").parquet(f"{acted}/run_date={day}")

    told = spark.read.schema("file_path string, action string")
    counted, rejected = (told.parquet(p).select("file_path", "action") for p in (acted, base))
    counts = land(report.file_summary(counted.unionByName(rejected), ["file_path"]), "counts")
    summary = (
        counts.select(
            run_date,
            F.lit(spec.code).alias("feed"),
            report.base_name(F.col("file_path")).alias("source_file"),
            "total_rows",
            "inserted",
            "updated",
            "unchanged",
            "duplicates",
            "failed",
            F.lit("success").alias("status"),
            F.lit("").alias("detail"),
        )
    )
    summary_path = f"{store.root}/summary/run_id={run_id}"
    summary.write.mode("overwrite").parquet(summary_path)

    if keyed:
        # Without stored rows, what is the same in all rows of the batch is so in the table.
        same = same_in_all(spec, raw, run_ts) if known_empty(target) else {}
        table.replace(plan.result.snapshot, touched, run_id, same)
    else:
        table.append(plan.result.snapshot, run_id)
    stored_rows = F.col("inserted") + F.col("updated") + F.col("unchanged")
    per_file = counts.select(F.col("file_path").alias("source_file"), stored_rows.alias("n"))
    done = claims.join(per_file, "source_file", "left").withColumns(
        {"total_records": F.coalesce("n", F.lit(0)).cast("bigint"), "status": F.lit(ledger.COMPLETED)}
    )
    store.record(spec, done.select(claims.columns))
    return spark.read.schema(report.SUMMARY_SCHEMA).parquet(summary_path)
