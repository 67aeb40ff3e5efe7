"""How the sources of a language differ in their words: K-squared quadtrees over the group-term count matrix.

1. One pass over the texts counts terms per (lang, source) and slice of a batch: occurrences, and documents that hold
   the term. Spark adds them up with map-side combine, so a source with a third of all rows is one row per term and task.
2. A term stays in its language if ``least_docs`` documents hold it. Shares are whole numbers in billionths,
   p = 1 + floor(10^9 (count + 1) / (N + V)), worked out in decimals of 38 digits.
3. The matrix of a language is dealt by a hash of the term into blocks of about ``block_terms`` columns, and by source
   into bands of ``band_groups`` rows; a task holds two bands of one block at a time, whatever the number of sources.
4. ``Tree`` is the K-squared tree of a block: bitmaps, level by level, of the quadrants that hold a count. Two bands
   are walked down together: a node is a quadrant of the one, a quadrant of the other, and the columns they share. A
   node that is empty on both sides is priced at once: every pair of its rows gains its columns times one constant,
   as an uncounted term has the same share for all of a group. Only nodes with a count on either side are split,
   down to single terms, which are priced by their shares.
5. Sums over blocks give the divergence of a pair; terms are ranked with a limit below the shuffle.

Defined cases: null text, lang and source are the empty string, and so one group with that. Rows of one id are
documents each, as are repeated rows. A group without a term has counts of 0; a language without a kept term has
pairs of value 0. A source alone in its language has no pair. A text of any length is counted whole; a slice holds
one such text at least. An empty table gives an empty result. Other columns are not read. The result has a row for
each ordered pair of sources of a language, as asked; their number, not the texts, then sets the cost of step 4.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.shingles import slices
from millrace.llm.text import land, ship

#: What becomes of each byte: ASCII letters in lower case, bytes of other characters as they are, blanks for the rest.
LETTERS = np.full(256, ord(" "), dtype=np.uint8)
LETTERS[ord("a") : ord("z") + 1] = LETTERS[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
LETTERS[128:] = np.arange(128, 256)

BILLION = 1_000_000_000


@dataclass(frozen=True)
class Settings:
    least_docs: int = 3
    top_terms: int = 200
    block_terms: int = 2_048
    block_cells: int = 1 << 22
    band_groups: int = 64
    slice_bytes: int = 8 << 20


PRODUCTION = Settings()


def terms_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All terms of texts without nulls, one text after the other, and the text of each."""
    plain = texts.cast(pa.large_string())
    _, places, data = plain.buffers()
    at = np.frombuffer(places, dtype=np.int64)[plain.offset : plain.offset + len(plain) + 1].astype(np.int64)
    letters = LETTERS[np.frombuffer(data or b"", dtype=np.uint8)[at[0] : at[-1]]]
    clean = pa.LargeStringArray.from_buffers(len(plain), pa.py_buffer((at - at[0]).tobytes()), pa.py_buffer(letters.tobytes()))
    split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(clean))
    owner = np.repeat(np.arange(len(plain)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    words = split.flatten()
    real = pc.not_equal(words, "")  # a text without a term splits into an empty one
    return words.filter(real).dictionary_encode(), owner[real.to_numpy(zero_copy_only=False)]


def count_slice(texts: pa.Array, groups: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Group, term, occurrences and documents, for the groups (numbered) and terms of a slice."""
    words, owner = terms_of(texts)
    code, size = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(1, len(words.dictionary))
    in_doc, n = np.unique(owner * size + code, return_counts=True)
    cell = groups[in_doc // size] * size + in_doc % size
    cells, where, docs = np.unique(cell, return_inverse=True, return_counts=True)
    total = np.bincount(where, weights=n, minlength=len(cells)).astype(np.int64)
    return cells // size, words.dictionary.take(pa.array(cells % size)), total, docs


COUNTS = "lang string, source string, term string, n long, docs long"


def term_counts(spark: SparkSession, groups_of: DataFrame, settings: Settings = PRODUCTION) -> DataFrame:
    """(lang, source, term, n, docs) of (lang, source, text) without nulls."""
    ship(spark)

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(2), settings.slice_bytes):
                part = batch.slice(a, b - a)
                pair = pa.StructArray.from_arrays([part.column(0), part.column(1)], names=["lang", "source"])
                names: dict[tuple, int] = {}
                number = np.array([names.setdefault((g["lang"], g["source"]), len(names)) for g in pair.to_pylist()], dtype=np.int64)
                which, term, n, docs = count_slice(part.column(2), number)
                lang, source = (pa.array([k[i] for k in names], pa.string()).take(pa.array(which)) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([lang, source, term.cast(pa.string()), pa.array(n), pa.array(docs)], names=["lang", "source", "term", "n", "docs"])

    counted = groups_of.select("lang", "source", "text").mapInArrow(run, COUNTS)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (total + terms)); 1 where a language has no term."""
    wide = lambda c: c.cast("decimal(27,0)")
    whole = F.call_function("div", (wide(count) + 1) * F.lit(BILLION).cast("decimal(10,0)"), wide(total) + wide(terms))
    return F.when(total + terms > 0, 1 + whole).otherwise(1).cast("long")


class Tree:
    """The K-squared tree of a block: ``levels[k]`` tells which quadrants of 2^k rows and columns hold a count.

    The block is padded to whole quadrants; ``rows`` and ``columns`` are what it really has.
    """

    def __init__(self, counted: np.ndarray, rows: int, columns: int) -> None:
        self.rows, self.columns, self.levels = rows, columns, [counted]
        while len(self.levels[-1]) > 1:
            a = self.levels[-1]
            self.levels.append(a[0::2, 0::2] | a[1::2, 0::2] | a[0::2, 1::2] | a[1::2, 1::2])

    def width(self, level: int, column: np.ndarray) -> np.ndarray:
        """Real columns below nodes."""
        return np.clip(self.columns - (column << level), 0, 1 << level)


def excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q)"""
    return (p - q) * (p - q) // q


#: Quadrants of the highest level that are walked at a time; bounds the memory of a walk.
ROOTS = 4
CHILDREN = tuple(x.ravel() for x in np.meshgrid([0, 1], [0, 1], [0, 1], indexing="ij"))


def walk(one: Tree, two: Tree, p_one: np.ndarray, p_two: np.ndarray, zero_one: np.ndarray, zero_two: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Divergence of every row of ``one`` from every row of ``two`` over a block, the reverse, and the number of terms
    that were priced singly."""
    side, top = len(zero_one), len(one.levels) - 1
    sums, back, priced = np.zeros(side * side, dtype=np.int64), np.zeros(side * side, dtype=np.int64), 0
    empty = np.zeros((side, side), dtype=np.int64)  # columns priced at once, for each pair of rows
    for root in range(0, one.levels[top].shape[1], ROOTS):
        c = np.arange(root, min(root + ROOTS, one.levels[top].shape[1]))
        r, s = np.zeros(len(c), dtype=np.int64), np.zeros(len(c), dtype=np.int64)
        for level in range(top, -1, -1):
            real = ((r << level) < one.rows) & ((s << level) < two.rows) & ((c << level) < one.columns)
            r, s, c = r[real], s[real], c[real]
            counted = one.levels[level][r, c] | two.levels[level][s, c]
            bare = np.zeros((side >> level, side >> level), dtype=np.int64)
            np.add.at(bare, (r[~counted], s[~counted]), one.width(level, c[~counted]))
            empty += np.repeat(np.repeat(bare, 1 << level, axis=0), 1 << level, axis=1)
            r, s, c = r[counted], s[counted], c[counted]
            if level:
                r, s, c = ((2 * x[:, None] + y).ravel() for x, y in zip((r, s, c), CHILDREN, strict=True))
        p, q, at = p_one[r, c], p_two[s, c], r * side + s
        np.add.at(sums, at, excess(p, q))
        np.add.at(back, at, excess(q, p))
        priced += len(c)
    a, b, shape = zero_one[:, None], zero_two[None, :], (side, side)
    return sums.reshape(shape) + empty * excess(a, b), back.reshape(shape) + empty * excess(b, a), priced


def _compare(frame: pd.DataFrame, side: int) -> pd.DataFrame:
    """Pairs of two bands over one block. Column -1 is no term: such a row stands for a group, and has its share of
    an uncounted term."""
    high, low, columns = (int(frame[c].iloc[0]) for c in ("high", "low", "columns"))
    marks, cells = frame[frame["column"] < 0], frame[frame["column"] >= 0]
    wide = -(-max(columns, 1) // side) * side

    def band(number: int):
        zero, counted = np.ones(side, dtype=np.int64), np.zeros((side, wide), dtype=bool)
        own, at = marks[marks["band"] == number], cells[cells["band"] == number]
        zero[own["row"]] = own["p"]
        p = np.repeat(zero[:, None], wide, axis=1)
        p[at["row"], at["column"]], counted[at["row"], at["column"]] = at["p"], True
        return zero, p, Tree(counted, len(own), columns)

    zero_one, p_one, one = band(low)
    zero_two, p_two, two = (zero_one, p_one, one) if high == low else band(high)
    there, back, _ = walk(one, two, p_one, p_two, zero_one, zero_two)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(one.rows), np.arange(two.rows), indexing="ij"))
    if high == low:  # both ways are in ``there``
        a, b = a[a != b], b[a != b]
    first, second, values = low * side + a, high * side + b, there[a, b]
    if high != low:
        first, second, values = np.append(first, second), np.append(second, first), np.append(values, back[a, b])
    return pd.DataFrame({"lang": frame["lang"].iloc[0], "group": first, "other": second, "value": values})


def _prepared(spark: SparkSession, docs: DataFrame, settings: Settings, lang: str, source: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(cells, groups), landed: the counts of kept terms with shares of group and language, and one row per group."""
    value = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    plain = docs.select(value(lang).alias("lang"), value(source).alias("source"), value(text).alias("text"))
    counts = land(spark, term_counts(spark, plain, settings), "divergence-counts")
    # Sums over the sources of a term, with map-side combine, then one join by term.
    per_term = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("lang_docs"))
    terms = land(spark, per_term.where(F.col("lang_docs") >= settings.least_docs).drop("lang_docs"), "divergence-terms")
    cells = land(spark, counts.join(terms, ["lang", "term"]).drop("docs"), "divergence-cells")
    langs = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    filled = cells.groupBy("lang").agg(F.count("*").alias("cells"))
    occurring = plain.groupBy("lang", "source").agg(F.count("*").alias("docs"))
    known = occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(filled, "lang", "left")
    known = known.na.fill(0, ["total", "terms", "lang_total", "cells"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return cells, land(spark, known.withColumn("number", number.cast("long")), "divergence-groups")


def audit(
    spark: SparkSession, docs: DataFrame, settings: Settings = PRODUCTION, lang: str = "lang", source: str = "source", text: str = "text"
) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item (the other source, or a term), value, rank, count (of the term in
    the group), p and q (shares in billionths; of a pair null)."""
    ship(spark)
    cells, groups = _prepared(spark, docs, settings, lang, source, text)
    side = settings.band_groups
    if side & (side - 1):
        raise ValueError("band_groups must be a power of two")
    blocks = F.greatest(F.ceil(F.col("terms") / settings.block_terms), F.ceil(F.col("cells") / settings.block_cells), F.lit(1)).cast("long")
    own = groups.select("lang", "source", "number", "total", "terms", "lang_total", blocks.alias("blocks"))
    priced = cells.join(own, ["lang", "source"]).withColumns(
        {"p": share(F.col("n"), F.col("total"), F.col("terms")), "q": share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))}
    )
    place = [(F.floor(F.col("number") / side)).cast("int").alias("band"), F.pmod("number", F.lit(side)).cast("int").alias("row")]
    # Columns are numbered inside a block; the numbering and the comparison share one shuffle.
    of_block = priced.select("lang", F.pmod(F.xxhash64("term"), "blocks").alias("block"), "term", *place, "p")
    marks = own.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(None).cast("string").alias("term"), *place,
        share(F.lit(0), F.col("total"), F.col("terms")).alias("p"))
    both = of_block.unionByName(marks)
    column = F.dense_rank().over(Window.partitionBy("lang", "block").orderBy(F.col("term").asc_nulls_first())) - 2  # -1 for the marks
    numbered = both.withColumn("column", column.cast("int"))
    numbered = numbered.withColumn("columns", F.max("column").over(Window.partitionBy("lang", "block")) + 1)
    numbered = numbered.join(groups.groupBy("lang").agg(F.floor(F.max("number") / side).alias("last")), "lang")  # a row per language
    partner = F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))).alias("partner")
    paired = numbered.select("*", partner).select(
        "lang", "block", F.least(F.col("band").cast("long"), "partner").alias("low"), F.greatest(F.col("band").cast("long"), "partner").alias("high"),
        "band", "row", "column", "columns", "p",
    )
    compared = paired.groupBy("lang", "block", "low", "high").applyInPandas(
        lambda frame: _compare(frame, side), "lang string, group long, other long, value long"
    )
    sums = compared.groupBy("lang", "group", "other").agg(F.sum("value").alias("value"))
    name = lambda c, n: groups.select("lang", F.col("number").alias(c), F.col("source").alias(n))
    pairs = sums.join(name("group", "source"), ["lang", "group"]).join(name("other", "item"), ["lang", "other"])
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    nothing = {"count": F.lit(None).cast("long"), "p": F.lit(None).cast("long"), "q": F.lit(None).cast("long")}
    pairs = pairs.withColumn("rank", F.row_number().over(order)).withColumns({"part": F.lit("pair"), **nothing})
    value = F.expr("(p - q) * (p - q) div q")
    above = priced.where(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), value.alias("value"), F.col("n").alias("count"), "p", "q")
    best = above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.top_terms).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank", "count", "p", "q"]
    return pairs.select(columns).unionByName(best.select(columns))
