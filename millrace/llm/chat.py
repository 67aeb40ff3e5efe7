"""Dialogues rendered from the side of each of their speakers.

For every speaker of a conversation, the whole dialogue is written once with that speaker as the assistant and all
others as users with their names; the mask covers what the assistant says, with its end mark. System turns are
context in every rendering.

A conversation is one rendering, whatever its turns are numbered by. Only one whose text is longer than
``Settings.part_chars`` is rendered in several rows: its turns are dealt to parts by the text before them, each part holds
whole turns in a row, and the parts joined in order are the whole. Conversations of that length are found by a sum that
is combined before its shuffle; their turns are sorted in ranges, and running sums are taken inside ranges and over them,
so that no conversation meets in one task. Speakers are found by an aggregation that is combined likewise.

Defined cases: turns stand by number (null last), then role, then text; repeated turns are all rendered. A null text
is empty. A turn without a role is a user without a name. A conversation without a speaker is rendered once, with a
null speaker and nothing masked. A row without a conversation is a dialogue of its own, with a null conv_id. The
marks' opening sign inside a text is broken by a space. An empty table gives an empty result. Other columns are not
read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.text import land

SYSTEM = "system"
END = "<|end|>\n"


@dataclass(frozen=True)
class Settings:
    part_chars: int = 1 << 20
    broadcast_rows: int = 500_000


PRODUCTION = Settings()


def _safe(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _turn(number: Column, role: Column, text: Column) -> Column:
    return F.struct(number.isNull().alias("last"), number.alias("turn"), role.alias("role"), _safe(text).alias("text"))


ASSISTANT = "<|assistant|>\n"


def _head(role: Column) -> Column:
    """What stands before a turn where its speaker is not the assistant."""
    named = F.concat(F.lit("<|user name="), _safe(role), F.lit("|>\n"))
    return F.when(role == SYSTEM, F.lit("<|system|>\n")).when(role.isNull(), F.lit("<|user|>\n")).otherwise(named)


def _rendered(dialogues: DataFrame) -> DataFrame:
    """Adds n_turns, rendered and spans to rows with ``turns`` and ``speaker``.

    ``before`` of a turn is the text before it if nobody is the assistant. A speaker's own turns differ from that by one
    and the same length each, so a span follows from the number of own turns before it: all is linear in the turns.
    """
    own = lambda t: F.coalesce(t["role"] == F.col("speaker"), F.lit(False))
    whole = lambda t: F.concat(F.when(own(t), F.lit(ASSISTANT)).otherwise(_head(t["role"])), t["text"], F.lit(END))
    gain = F.lit(len(ASSISTANT)) - F.length(_head(F.col("speaker")))

    def span(t, k):
        start = t["before"] + k * F.col("gain") + len(ASSISTANT)
        return F.struct(start.alias("start"), (start + F.length(t["text"]) + len(END) - 1).alias("end"))  # without the line break

    df = dialogues.withColumn("gain", gain.cast("long"))
    return df.withColumns(
        {
            "n_turns": F.size("turns"),
            "rendered": F.array_join(F.transform("turns", whole), ""),
            "spans": F.transform(F.filter("turns", own), span),
        }
    )


def _parts(held: DataFrame, settings: Settings) -> DataFrame:
    """Turns with ``part``: 0, or for a turn of a long conversation the number of whole ``part_chars`` before it."""
    spark = held.sparkSession
    sized = held.withColumn("size", (F.length("one.text") + len(END)).cast("long"))
    total = sized.groupBy("conv_id").agg(F.sum("size").alias("total")).where(F.col("total") > settings.part_chars)
    long = land(spark, total.select("conv_id"), "chat-long")
    few = long.count()
    if not few:
        return held.withColumn("part", F.lit(0).cast("long"))
    if few <= settings.broadcast_rows:
        long = F.broadcast(long)
    # Equal turns are told apart by their place in the scan, so that a range holds no more of them than of others.
    rows = sized.join(long, "conv_id", "left_semi").withColumn("at", F.monotonically_increasing_id())
    ranged = land(spark, rows.orderBy("conv_id", "one", "at").withColumn("range", F.spark_partition_id()), "chat-ranges")
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("conv_id", "range").agg(F.sum("size").alias("size"))  # a row per conversation and range
    offsets = sums.select("conv_id", "range", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("conv_id", "range").orderBy("one", "at").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offsets, ["conv_id", "range"])
    part = F.floor((F.col("offset") + F.col("inner")) / settings.part_chars).cast("long")
    short = held.join(long, "conv_id", "left_anti").withColumn("part", F.lit(0).cast("long"))
    return short.unionByName(placed.select("conv_id", "one", part.alias("part")))


def rotate(
    turns: DataFrame, settings: Settings = PRODUCTION, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation, part and speaker: conv_id, part, speaker, n_turns, rendered, and spans (start and end
    of the characters to learn from)."""
    number = F.col(f"`{turn}`").cast("long")
    one = _turn(number, F.col(f"`{role}`").cast("string"), F.col(f"`{text}`").cast("string"))
    plain = turns.select(F.col(f"`{conv_id}`").alias("conv_id"), one.alias("one"))
    held = plain.where("conv_id IS NOT NULL")
    length = F.length(_head(F.col("one.role"))) + F.length("one.text") + len(END)
    earlier = Window.partitionBy("conv_id", "part").orderBy("one").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(length).over(earlier), F.lit(0)).cast("long")
    told = _parts(held, settings).select("conv_id", "part", F.struct("one.*", before.alias("before")).alias("one"))
    dialogues = told.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    speaks = F.col("one.role").isNotNull() & (F.col("one.role") != SYSTEM)
    speakers = held.where(speaks).select("conv_id", F.col("one.role").alias("speaker")).distinct()
    alone = plain.where("conv_id IS NULL").select("conv_id", F.lit(0).cast("long").alias("part"), F.array(F.struct("one.*", F.lit(0).cast("long").alias("before"))).alias("turns"), F.when(speaks, F.col("one.role")).alias("speaker"))
    both = dialogues.join(speakers, "conv_id", "left").select("conv_id", "part", "turns", "speaker").union(alone)
    return _rendered(both).select("conv_id", "part", "speaker", "n_turns", "rendered", "spans")
