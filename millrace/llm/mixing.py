"""Mixing sources to target weights along a curriculum.

1. **Targets.** Sources share a budget of words by weight. None may give more than ``most`` times what it has; what
   it cannot give is shared again by weight. The result is one level: a source gives ``least(level * weight, cap)``,
   and the level follows from sources sorted by cap over weight.
2. **Order.** Inside a source, documents stand in the order of the md5 of their id and text, so that rows of one id, or of
   none, lie apart. The running sum of words is
   taken in two steps, over slices of the hash range and inside each slice, so that no source meets in one task.
3. **Copies.** As many whole passes as fit into the target, and one more copy of each document whose middle lies
   below the rest of it. A source ends at most half a document from its target.
4. **Positions.** Each source has a weight schedule over the run, linear between knots. Its integral, scaled to the
   target, is the source's cumulative demand; a copy is placed where that demand reaches the words before its middle.
5. ``mix`` sorts all copies by position with a range partitioning.

Defined cases: a null source is a source of its own and stands last; a null or blank text has size 0, and a document
of size 0 is taken as often as its place says, with 0 words; a null id is left out of the hash. Repeated rows count each. A source without a word has target 0. An empty table gives an empty mix. Other columns are carried unread.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.text import land, words


@dataclass(frozen=True)
class Curriculum:
    """``weights`` go to the sources in code point order and repeat; ``schedules`` likewise, one weight per knot.

    ``budget`` is the share of all words to hand out, ``most`` the most passes over one document. The schedule bends
    only when a source is read, not how much of it.
    """

    weights: tuple[float, ...] = (5, 2, 1)
    budget: float = 1.5
    most: int = 2
    knots: tuple[float, ...] = (0.0, 0.5, 1.0)
    schedules: tuple[tuple[float, ...], ...] = ((3.0, 2.0, 1.0), (1.0, 1.0, 1.0), (1.0, 2.0, 4.0))


PRODUCTION = Curriculum()


def targets(sizes: DataFrame, plan: Curriculum = PRODUCTION) -> DataFrame:
    """(source, source_size) with ``weight``, ``target`` and ``schedule`` added; one row per source."""
    pick = lambda values, kind: F.element_at(
        F.array(*[F.lit(v) if not isinstance(v, tuple) else F.array(*[F.lit(float(x)) for x in v]) for v in values]).cast(kind),
        (F.col("rank") % len(values) + 1).cast("int"),
    )
    # One row per source from here on.
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumns({"weight": pick(plan.weights, "array<double>"), "schedule": pick(plan.schedules, "array<array<double>>")})
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(plan.most)))
    by_need = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    upto = by_need.rowsBetween(Window.unboundedPreceding, -1)
    after = by_need.rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(every) * F.lit(float(plan.budget)) - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))
    ) / F.sum("weight").over(after)
    # The first source, by need, that the level does not fill sets the level for all behind it.
    levelled = ranked.withColumn("own", level).withColumn("open", F.col("own") * F.col("weight") < F.col("cap"))
    final = F.min(F.when(F.col("open"), F.struct("cap_by", "rank", "own"))).over(every)["own"]
    levelled = levelled.withColumn("cap_by", F.col("cap") / F.col("weight")).withColumn("level", final)
    given = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("level") * F.col("weight"), F.col("cap")))
    return levelled.select("source", "source_size", "weight", given.alias("target"), "schedule")


def slices(rows: int) -> int:
    """Slices of the hash range: their number and their size both grow with the root of the rows."""
    return max(1, int(rows**0.5))


def _sized(docs: DataFrame, carried: Column, doc_id: str, source: str, text: str, parts: int) -> DataFrame:
    """One row per document: carried columns, its source, size, and place (``slice``, ``hash``) in its source."""
    own = docs.select(
        carried.alias("carried"),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.size(words(F.col(f"`{text}`"))).cast("long").alias("size"),
        F.md5(F.concat_ws("|", F.col(f"`{doc_id}`").cast("string"), F.col(f"`{text}`"))).alias("hash"),
    )
    first = F.coalesce(F.conv(F.substring("hash", 1, 8), 16, 10).cast("long"), F.lit(0))
    return own.withColumn("slice", F.floor(first * F.lit(parts) / F.lit(1 << 32)).cast("long"))


def _sums(sized: DataFrame) -> DataFrame:
    return sized.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"), F.count("*").alias("slice_docs"))


def _placed(sized: DataFrame, sums: DataFrame, plan: Curriculum) -> DataFrame:
    """``sized`` with ``before`` (words before it in its source), target, and number of copies."""
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)))
    per_source = targets(sums.groupBy("source").agg(F.sum("slice_size").alias("source_size")), plan)
    known = offsets.alias("o").join(per_source.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source"))).select(
        F.col("o.source").alias("source_"), F.col("slice").alias("slice_"), "offset", "source_size", "target", "schedule"
    )
    inside = Window.partitionBy("source", "slice").orderBy("hash", "size").rowsBetween(Window.unboundedPreceding, -1)
    local = sized.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = local.join(known, F.col("source").eqNullSafe(F.col("source_")) & (F.col("slice") == F.col("slice_")))
    before = F.col("offset") + F.col("inner")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    joined = joined.withColumns({"before": before, "passes": passes})
    more = F.when((F.col("passes") < plan.most) & (2 * F.col("before") + F.col("size") <= 2 * rest), 1).otherwise(0)
    return joined.withColumn("copies", (F.col("passes") + more).cast("int"))


def _position(copy: Column, plan: Curriculum) -> Column:
    """Where in the run, from 0 to 1, the cumulative demand of the source reaches the middle of this copy."""
    k, g = plan.knots, F.col("schedule")
    at = lambda i: F.element_at(g, i + 1)
    areas = [(at(i) + at(i + 1)) / 2 * (k[i + 1] - k[i]) for i in range(len(k) - 1)]
    ends = [areas[0]]
    for a in areas[1:]:
        ends.append(ends[-1] + a)
    reached = copy * F.col("source_size") + F.col("before") + F.col("size") / 2
    share = F.when(F.col("target") > 0, F.least(reached / F.col("target"), F.lit(1.0))).otherwise(0.0)
    wanted = share * ends[-1]
    out = None
    for i in reversed(range(len(areas))):
        rest = wanted - (ends[i - 1] if i else F.lit(0.0))
        slope = (at(i + 1) - at(i)) / (k[i + 1] - k[i])
        solved = F.lit(k[i]) + 2 * rest / (at(i) + F.sqrt(at(i) * at(i) + 2 * slope * rest))
        solved = F.when(rest > 0, solved).otherwise(F.lit(k[i]))
        out = solved if out is None else F.when(wanted <= ends[i], solved).otherwise(out)
    return out


def account(
    spark: SparkSession, docs: DataFrame, plan: Curriculum = PRODUCTION, doc_id: str = "doc_id", source: str = "source", text: str = "text"
) -> DataFrame:
    """One row per document: size, its source's size and target, the words taken, copies, first position; in the
    order of positions, documents not taken last."""
    sized = land(spark, _sized(docs, F.struct(F.col(f"`{doc_id}`").alias("doc_id")), doc_id, source, text, slices(docs.count())), "mix-sizes")
    placed = _placed(sized, _sums(sized), plan)
    first = F.when(F.col("copies") > 0, _position(F.lit(0), plan))
    rows = placed.select(
        "hash",
        "carried.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", first.alias("position")
    )
    return rows.orderBy(F.col("position").asc_nulls_last(), "hash").drop("hash")


def mix(
    spark: SparkSession, docs: DataFrame, plan: Curriculum = PRODUCTION, doc_id: str = "doc_id", source: str = "source", text: str = "text"
) -> DataFrame:
    """The mixed rows in training order, each as often as it is taken, with the columns of ``docs``."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    own = [f"c{names.index(c)}" for c in (doc_id, source, text)]
    parts = slices(docs.count())
    sums = land(spark, _sums(_sized(plain, F.lit(0), *own, parts)), "mix-sums")
    placed = _placed(_sized(plain, F.struct(*plain.columns), *own, parts), sums, plan)
    taken = placed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    ordered = taken.withColumn("position", _position(F.col("copy"), plan)).orderBy("position", "hash")
    return ordered.select(*[F.col(f"carried.{c}") for c in plain.columns]).toDF(*names)
