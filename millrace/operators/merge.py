"""Merge policies: a target snapshot and an incoming batch give a new snapshot and an action per row.

Key equality is SQL ``=``, so rows with an incomplete key never meet and are inserted on every run:
stored ones bypass the joins, incoming ones are spread over them. On a match the incoming value wins
even when it is NULL.

Where the key is declared unique, both sides hold a key once and one full outer join does the merge.
Where it is not, copies may pile up on either side, so updates and inserts are two joins that split
hot keys (``operators.skew``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.dedup import keep_first, keep_last
from millrace.operators.match import near_keys
from millrace.operators.position import POSITION, land, lost_positions, place
from millrace.operators.skew import HOT_ROWS, incomplete, null_slot, spread_join

INSERT, UPDATE, UNCHANGED = "insert", "update", "unchanged"


@dataclass(frozen=True)
class MergeResult:
    """``snapshot`` has the columns of the target, ``actions`` those of the source plus ``action``.

    The action plan is only built when asked for.
    """

    snapshot: DataFrame
    build_actions: Callable[[], DataFrame]

    @cached_property
    def actions(self) -> DataFrame:
        return self.build_actions()


def matched_actions(
    source: DataFrame,
    target: DataFrame,
    keys: list[str],
    order: list[str],
    small_source: bool = False,
) -> DataFrame:
    """Insert or update for each source row, from the target's keys alone."""
    known = target.where(~incomplete(keys)).select(keys)
    near = near_keys(known, source, keys, small_source)
    stored = near.distinct().withColumn("_hit", F.lit(True))
    joined = spread_join(source, stored, keys, order, "left")
    action = F.when(F.col("_hit"), UPDATE).otherwise(INSERT)
    return joined.select(*source.columns, action.alias("action"))


def ordered_actions(
    source: DataFrame,
    target: DataFrame,
    keys: list[str],
    order: list[str],
    small_source: bool = False,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """Actions of rows applied one after another: of a new key the first row inserts, the rest update.

    ``repeated``, where it is known, has all rows of the source that share their key, and maybe others.
    """
    ends = source if repeated is None else repeated
    slim = ends.where(~incomplete(keys)).select(list(dict.fromkeys([*keys, *order])))
    acted = matched_actions(source, target, keys, order, small_source)
    later = lost_positions(slim, keys, "first") if order == [POSITION] else None
    if later is not None:
        late = acted.join(later.withColumn("_late", F.lit(True)), POSITION, "left")
        return late.withColumn("action", F.when(F.col("_late"), UPDATE).otherwise(F.col("action"))).drop("_late").select(*source.columns, "action")
    slim = source.where(~incomplete(keys)).select(list(dict.fromkeys([*keys, *order])))
    first = keep_first(slim, keys, order).select(*order, F.lit(True).alias("_opens"))
    opens = F.col("_opens") | incomplete(keys)
    return (
        acted.join(first.hint("merge"), order, "left")
        .withColumn("action", F.when(opens, F.col("action")).otherwise(UPDATE))
        .select(*source.columns, "action")
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: list[str],
    order: list[str],
    small_source: bool = False,
) -> MergeResult:
    """Insert new keys whole; on a match change only the ``update`` columns.

    ``source`` holds a complete key at most once. ``small_source`` is for a batch whose size was
    checked to fit a broadcast: the target is then streamed past it and not shuffled.
    """
    cols = target.columns
    stored, loose = target.where(~incomplete(keys)), target.where(incomplete(keys))
    if small_source:
        fresh = source.select(cols)
        known = stored.select(keys).join(F.broadcast(fresh.select(keys)), keys, "left_semi")
        merged = update_matches(stored, fresh, keys, update, small_source=True).unionByName(
            fresh.join(known, keys, "left_anti")
        )
    else:
        s = source.select(*cols, null_slot(keys, order).alias("_slot"), F.lit(True).alias("_in"))
        t = stored.select(*cols, F.lit(0).alias("_slot"), F.lit(True).alias("_in"))
        on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in [*keys, "_slot"]]

        def pick(c: str) -> str:
            first, second = ("s", "t") if c in update else ("t", "s")
            return f"CASE WHEN {first}._in THEN {first}.`{c}` ELSE {second}.`{c}` END AS `{c}`"

        merged = t.alias("t").join(s.alias("s").hint("merge"), on, "full_outer").selectExpr([pick(c) for c in cols])
    return MergeResult(
        merged.unionByName(loose),
        lambda: matched_actions(source, target, keys, order, small_source),
    )


def _values(values: DataFrame, keys: list[str], update: list[str]) -> DataFrame:
    """Keys, a mark that tells a match from none, and the new values under names of their own."""
    return values.selectExpr(
        *[f"`{k}`" for k in keys], "true AS _hit", *[f"`{c}` AS `_new_{c}`" for c in update]
    )


def _apply(joined: DataFrame, cols: list[str], update: list[str]) -> DataFrame:
    return joined.selectExpr(
        [
            f"CASE WHEN _hit THEN `_new_{c}` ELSE `{c}` END AS `{c}`" if c in update else f"`{c}`"
            for c in cols
        ]
    )


def update_matches(
    target: DataFrame,
    values: DataFrame,
    keys: list[str],
    update: list[str],
    hot_rows: int = HOT_ROWS,
    small_source: bool = False,
) -> DataFrame:
    """Target rows with the ``update`` columns replaced wherever ``values`` has the key.

    The stored target may hold a key many times, whole copies included: a small batch is broadcast
    to it, otherwise hot keys are split.
    """
    new = _values(values, keys, update)
    if small_source:
        joined = target.join(F.broadcast(new), keys, "left")
    else:
        joined = spread_join(target, new, keys, None, "left", hot_rows)
    return _apply(joined, target.columns, update)


def append(target: DataFrame, source: DataFrame) -> MergeResult:
    return MergeResult(
        target.unionByName(source.select(target.columns)),
        lambda: source.withColumn("action", F.lit(INSERT)),
    )


def contact_only(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    contact: list[str],
    order: list[str],
    hot_rows: int = HOT_ROWS,
    small_source: bool = False,
    many_files: bool = False,
) -> MergeResult:
    """Insert new rows, all copies; on a match change the contact columns to those of the last copy.

    A file whose path the target already holds is skipped whole. ``many_files``: the files of the source
    count as merged one after another by path, in one pass: the first file with a new key inserts it, later
    ones change its contact columns. One aggregation tells of each key whether it is stored, where its last row is and
    which file has it first; the judged rows land as a table, and snapshot and actions are taken from it.
    """
    arriving = source.select("file_path").distinct()
    seen = target.select("file_path").distinct().join(arriving, "file_path", "left_semi")
    batch = land(spread_join(source, seen, ["file_path"], order, "left_anti", hot_rows), "batch")
    complete = batch.where(~incomplete(keys))
    near = near_keys(target.select(keys), complete, keys, small_source).where(~incomplete(keys))
    nothing = F.lit(None)
    rows = complete.select(*keys, place(order).alias("_at"), F.col("file_path").alias("_file"), F.lit(False).alias("_stored"))
    kinds = dict(rows.dtypes)
    known = near.select(*keys, nothing.cast(kinds["_at"]).alias("_at"), nothing.cast("string").alias("_file"), F.lit(True).alias("_stored"))
    ends = rows.unionByName(known).groupBy(*keys).agg(
        F.max("_at").alias("_last"), F.min("_file").alias("_first"), F.max("_stored").alias("_known")
    )
    joined = spread_join(batch, ends, keys, order, "left", hot_rows)
    stored = F.coalesce(F.col("_known"), F.lit(False))
    later = F.coalesce(F.col("file_path") > F.col("_first"), F.lit(False)) if many_files else F.lit(False)
    matched = stored | later
    last = F.coalesce(place(order) == F.col("_last"), F.lit(False))
    action = F.when(matched, UPDATE).otherwise(INSERT)
    judged = land(joined.select(*source.columns, action.alias("action"), (matched & last).alias("_last_word")), "judged")
    inserted = judged.where(F.col("action") == INSERT).select(target.columns)
    snapshot = update_matches(target.unionByName(inserted), judged.where("_last_word"), keys, contact, hot_rows, small_source)
    return MergeResult(snapshot, lambda: judged.drop("_last_word"))


def _file_ends(source: DataFrame, keys: list[str], files: list[str], tracked: list[str], order: list[str]) -> DataFrame:
    """What a file can do to a key, in one row per key and file: the tracked values and place of its last row (``_value``,
    ``_at``), and of its last row that differs from that one (``_other``, ``_other_at``), if there is one.

    A file leaves the key at the first of the two that is not what it found, so these two stand for all its rows. Rows
    of equal values are combined before the shuffle, and two rows of each key and task pass the limit below the next.
    """
    complete = source.where(~incomplete(keys)).select(*keys, *files, *tracked, place(order).alias("_at"))
    ends = complete.groupBy(*keys, *files, *tracked).agg(F.max("_at").alias("_at"))
    latest = Window.partitionBy(*keys, *files).orderBy(F.col("_at").desc())
    two = ends.withColumn("_rank", F.row_number().over(latest)).where(F.col("_rank") <= 2)
    two = two.select(*keys, *files, F.struct(*tracked).alias("_value"), "_at", "_rank")
    before = lambda c: F.lead(c).over(latest)
    pairs = two.withColumns({"_other": before("_value"), "_other_at": before("_at")}).where(F.col("_rank") == 1).drop("_rank")
    if not files:
        return pairs.withColumn("_most", F.col("_value"))
    # What a later file finds after one that brought the key in: of several copies, the largest values.
    most = ends.groupBy(*keys, *files).agg(F.max(F.struct(*tracked)).alias("_most"))
    return pairs.join(most, [*keys, *files])


def change_fold(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    tracked: list[str],
    order: list[str],
    files: list[str],
    small_source: bool = False,
) -> DataFrame:
    """Files applied one after another, without applying them: per key and file the tracked values it finds (``_before``;
    NULL when it brings the key in), and ``_wins``, the place of the row that has the last word on the key.

    After a file the key stands at one of the file's two values, so its state is one bit. A file sets the bit to a
    constant, keeps it, or turns it round; the last constant and the number of turns since then give it. That is one
    window over one row per key and file.
    """
    ends = _file_ends(source, keys, files, tracked, order)
    near = near_keys(target.select(*keys, *tracked), source, keys, small_source).where(~incomplete(keys))
    stored = near.groupBy(*keys).agg(F.max(F.struct(*tracked)).alias("_value"))
    both = ends.withColumn("_stored", F.lit(False)).unionByName(stored.withColumn("_stored", F.lit(True)), allowMissingColumns=True)
    one = Window.partitionBy(*keys).orderBy(F.col("_stored").desc(), *files)
    prior = lambda c: F.lag(c).over(one)
    rows = both.withColumn("_opens", ~F.col("_stored") & (F.row_number().over(one) == 1))
    rows = rows.withColumn("_left", F.when(F.col("_opens"), F.col("_most")).otherwise(F.col("_value")))
    rows = rows.withColumn("_mixed", F.col("_other_at").isNotNull() & ~F.col("_opens") & ~F.col("_stored"))
    moved = ~prior("_left").eqNullSafe(F.col("_left"))
    moved_other = F.when(prior("_mixed"), ~prior("_other").eqNullSafe(F.col("_left"))).otherwise(moved)
    rows = rows.withColumns({"_x": F.coalesce(moved, F.lit(True)), "_y": F.coalesce(moved_other, F.lit(True))})
    constant = F.when(~F.col("_mixed"), 1).when(F.col("_x") == F.col("_y"), F.col("_x").cast("int"))
    rows = rows.withColumns({"_constant": constant, "_turn": (F.col("_mixed") & F.col("_y") & ~F.col("_x")).cast("int")})
    upto = one.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_turns", F.sum("_turn").over(upto))
    known = F.struct(F.col("_constant").alias("bit"), F.col("_turns").alias("turns"))
    rows = rows.withColumn("_known", F.last(F.when(F.col("_constant").isNotNull(), known), ignorenulls=True).over(upto))
    bit = (F.col("_known.bit") + F.col("_turns") - F.col("_known.turns")) % 2 == 1
    rows = rows.withColumn("_after", F.when(bit, F.col("_left")).otherwise(F.col("_other")))
    rows = rows.withColumn("_before", prior("_after"))
    wins = F.when(F.col("_opens") | F.col("_stored"), None).when(~F.col("_before").eqNullSafe(F.col("_value")), F.col("_at")).otherwise(F.col("_other_at"))
    rows = rows.withColumn("_win", wins)
    whole = one.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("_wins", F.max("_win").over(whole)).where(~F.col("_stored"))
    return rows.select(*keys, *files, "_opens", "_before", "_wins")


def if_changed(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    tracked: list[str],
    update: list[str],
    order: list[str],
    hot_rows: int = HOT_ROWS,
    small_source: bool = False,
    files: list[str] | None = None,
) -> MergeResult:
    """Insert new rows, all copies; update a match only when a tracked column differs.

    ``files`` names the columns that tell files apart, in the order of which they count as merged one after another;
    one pass does them all. Without it the source is one file. The judged rows land as a table; snapshot and actions
    are taken from it.
    """
    files = files or []
    fold = change_fold(target, source, keys, tracked, order, files, small_source)
    joined = spread_join(source, fold, [*keys, *files], order, "left", hot_rows)
    new = F.coalesce(F.col("_opens"), F.lit(True))
    action = F.when(new, INSERT).when(F.struct(*tracked).eqNullSafe(F.col("_before")), UNCHANGED).otherwise(UPDATE)
    last_word = F.coalesce(place(order) == F.col("_wins"), F.lit(False))
    judged = land(joined.select(*source.columns, action.alias("action"), last_word.alias("_last_word")), "judged")
    inserted = judged.where(F.col("action") == INSERT).select(target.columns)
    winners = judged.where("_last_word")
    snapshot = update_matches(target.unionByName(inserted), winners, keys, update, hot_rows, small_source)
    return MergeResult(snapshot, lambda: judged.drop("_last_word"))


def last_wins(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    values: list[str],
    lineage: list[str],
    order: list[str],
    hot_rows: int = HOT_ROWS,
    small_source: bool = False,
    repeated: DataFrame | None = None,
) -> MergeResult:
    """Rows applied one after another: a key ends with the values of its last row.

    A stored row keeps its lineage, an inserted key takes that of its first row. The places of both ends of a key are
    aggregated, no row travels with them; the rows are then fetched by their places, which are unique. With an order
    of one column that is a hash aggregation.
    """
    cols = target.columns
    payload = [c for c in values if c not in keys]
    complete = source.where(~incomplete(keys))
    at = place(order)
    ends = complete.groupBy(*keys).agg(F.min(at).alias("_first"), F.max(at).alias("_last"))
    roles = F.array_distinct(F.array("_first", "_last"))
    wanted = ends.select("_first", "_last", F.explode(roles).alias("_place"))
    # One shuffle of the rows serves both ends; a row of each key is left, or two.
    picked = complete.withColumn("_place", at).join(wanted.hint("merge"), "_place")
    if order == [POSITION]:
        # Landed, so that it is one shuffle indeed; only keys with two rows have their ends joined.
        picked = land(picked.select(*keys, *payload, *lineage, "_first", "_last", "_place"), "picked")
    is_last, is_first = F.col("_place") == F.col("_last"), F.col("_place") == F.col("_first")
    last = picked.where(is_last).select(*keys, *payload, F.col("_first").alias("_of"))
    first = picked.where(is_first).select(F.col("_first").alias("_of"), *lineage)
    updated = update_matches(target, last, keys, payload, hot_rows, small_source)
    known = target.where(~incomplete(keys)).select(keys)
    stored = near_keys(known, last, keys, small_source).distinct()
    if order == [POSITION]:
        two = F.col("_first") < F.col("_last")
        lasts = picked.where(two & is_last).select(*keys, *payload, F.col("_first").alias("_of"))
        firsts = picked.where(two & is_first).select(F.col("_first").alias("_of"), *lineage)
        news = picked.where(~two).select(cols).unionByName(lasts.join(firsts.hint("merge"), "_of").select(cols))
        added = news.join(stored.hint("merge"), keys, "left_anti")
    else:
        added = last.join(stored.hint("merge"), keys, "left_anti").join(first.hint("merge"), "_of")
    loose = source.where(incomplete(keys)).select(cols)
    return MergeResult(
        updated.unionByName(added.select(cols)).unionByName(loose),
        lambda: ordered_actions(source, target, keys, order, small_source, repeated),
    )


def present_keys(candidates: list[str], columns: list[str]) -> list[str]:
    """The candidate key columns that exist; fewer than two make no key."""
    found = [c for c in candidates if c in columns]
    return found if len(found) >= 2 else []


def dynamic_key(
    target: DataFrame,
    source: DataFrame,
    candidates: list[str],
    order: list[str],
    fixed: tuple[str, ...] = ("file_path", "created_at"),
    small_source: bool = False,
) -> MergeResult:
    """Upsert on the candidate keys that exist, the last copy of a key standing for all; append without
    a key."""
    keys = present_keys(candidates, target.columns)
    if not keys:
        return append(target, source)
    update = [c for c in target.columns if c not in keys and c not in fixed]
    # Rows with an incomplete key never conflict, so only complete keys are reduced.
    batch = keep_last(source.where(~incomplete(keys)), keys, order).unionByName(
        source.where(incomplete(keys))
    )
    return upsert(target, batch, keys, update, order, small_source)


def declared_key(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: list[str],
    order: list[str],
    declared: bool,
    small_source: bool = False,
) -> MergeResult:
    """Upsert when the target declares the unique key, else append."""
    if declared:
        return upsert(target, source, keys, update, order, small_source)
    return append(target, source)
