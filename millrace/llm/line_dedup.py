"""Lines that many documents share, dropped from all of them but the last.

1. Every text is split at line feeds. A line's key is the line without white space at its ends, A to Z in lower case.
   Lines whose key is long enough become narrow entries: two hashes of the key, the document, the line's number. The
   text stays behind.
2. The entries are range-partitioned by their hashes and sorted, inside a range, by document (largest first) and
   line. One pass over the sorted rows ranks the documents of a key: rank 1 are the first occurrences, which stay;
   the rest goes where the key reaches ``least_docs`` documents.
3. A key with very many entries would put one range into one task. Such keys are found exactly: entries are counted by
   a prefix of the hash, and keys only in crowded prefixes. At most ``2 ** HOT_BITS`` keys are hot; their largest
   documents, found with map-side combine, are broadcast to the entries, which then need no shuffle at all.
4. What is returned is a bitmap per document that loses lines, as runs of dropped lines; texts meet it at the end.

Defined cases: a null text is empty, and an empty text is one empty line. Rows of one id are one document: a line in
several of them counts once, and all rows of the largest id keep it. A null id is a document below every other; rows
with a null id are one document. Repeated lines of one document count once and go, or stay, together. Repeated rows
all come back. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.text import BLANKS, land, lower_ascii

#: A key is hot beyond this many entries, or beyond a 2 ** -HOT_BITS share of all if that is more.
HOT_ROWS, HOT_BITS, PREFIX_BITS = 4_096, 16, 18

ROW = ["doc_id", "text_a", "text_b"]
KEY = ["key_a", "key_b"]


@dataclass(frozen=True)
class Settings:
    least_chars: int = 20
    least_docs: int = 3
    hot_rows: int = HOT_ROWS


PRODUCTION = Settings()


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    """The line as it is compared. Pure ASCII takes the short way: there, lower case changes A to Z only."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(lower_ascii(bare))


def _hashes(value: Column, names: list[str]) -> list[Column]:
    """Two 64-bit hashes of different seeds."""
    return [F.xxhash64(value).alias(names[0]), F.xxhash64(F.lit(1), value).alias(names[1])]


def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text_a, text_b, text): an id and two hashes of the text tell rows apart that differ."""
    own = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), *_hashes(own, ROW[1:]), own.alias("text"))


def entries(docs: DataFrame, settings: Settings = PRODUCTION, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One narrow row per line that can be dropped: the key's hashes, the row's name, and the line's number."""
    split = _named(docs, doc_id, text).select(*ROW, F.posexplode(lines(F.col("text"))).alias("line", "value"))
    keyed = split.select(*ROW, "line", key_of(F.col("value")).alias("value")).where(F.length("value") >= settings.least_chars)
    return keyed.select(*_hashes(F.col("value"), KEY), *ROW, "line")


def _hot(spark: SparkSession, landed: DataFrame, settings: Settings) -> DataFrame:
    """(key, largest, least) of keys with more entries than a task should sort; at most 2 ** HOT_BITS rows.

    ``largest`` and ``least`` are documents in a struct, in which a null id is less than any other.
    """
    most = max(settings.hot_rows, landed.count() >> HOT_BITS)
    prefix = F.shiftrightunsigned("key_a", 64 - PREFIX_BITS)
    crowded = landed.groupBy(prefix.alias("prefix")).count().where(F.col("count") > most).select("prefix")
    near = landed.withColumn("prefix", prefix).join(F.broadcast(crowded), "prefix", "left_semi")
    doc = F.struct("doc_id")
    counted = near.groupBy(*KEY).agg(F.count("*").alias("n"), F.max(doc).alias("largest"), F.min(doc).alias("least"))
    return land(spark, counted.where(F.col("n") > most).drop("n"), "lines-hot")


def _hot_dropped(spark: SparkSession, landed: DataFrame, hot: DataFrame, settings: Settings) -> DataFrame:
    """Dropped entries of hot keys. Documents are counted by walking down from the largest, a step per document
    needed, so nothing but the next document of a key is ever gathered."""
    doc, here = F.struct("doc_id"), hot.withColumn("at", F.col("largest"))
    for _ in range(settings.least_docs - 2):
        below = landed.join(F.broadcast(here), KEY).where(doc < F.col("at"))
        nearest = below.groupBy(*KEY).agg(F.max(doc).alias("at"), F.first("largest").alias("largest"), F.first("least").alias("least"))
        here = land(spark, nearest, "lines-hot-next")
    if settings.least_docs > 1:
        here = here.where(F.col("least") < F.col("at"))
    return landed.join(F.broadcast(here.select(*KEY, "largest")), KEY).where(doc < F.col("largest")).select(*ROW, "line")


def _cold_dropped(landed: DataFrame, hot: DataFrame, settings: Settings) -> DataFrame:
    """Dropped entries of all other keys: one range shuffle with a secondary sort, and one pass."""
    latest = F.col("doc_id").desc_nulls_last()
    cold = landed.join(F.broadcast(hot.select(*KEY)), KEY, "left_anti").repartitionByRange(*KEY)
    streamed = cold.sortWithinPartitions(*KEY, latest, "line")  # the windows below find this order and add nothing
    ranked = streamed.withColumn("rank", F.dense_rank().over(Window.partitionBy(*KEY).orderBy(latest)))
    whole = Window.partitionBy(*KEY)
    counted = ranked.withColumn("docs", F.max("rank").over(whole))
    return counted.where((F.col("rank") > 1) & (F.col("docs") >= settings.least_docs)).select(*ROW, "line")


def _runs(dropped: Column) -> Column:
    """Sorted numbers as runs (start, size)."""
    starts = F.filter(dropped, lambda x, i: (i == 0) | (F.get(dropped, i - 1) != x - 1))
    ends = F.filter(dropped, lambda x, i: (i == F.size(dropped) - 1) | (F.get(dropped, i + 1) != x + 1))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b - a + 1).alias("size")))


def bitmaps(spark: SparkSession, docs: DataFrame, settings: Settings = PRODUCTION, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per different row that loses lines: doc_id, text_a, text_b, n_dropped, and ``drops``, its bitmap of
    lines in compressed form: the runs (start, size) of dropped lines, in order."""
    landed = land(spark, entries(docs, settings, doc_id, text), "lines")
    hot = _hot(spark, landed, settings)
    parts = [_cold_dropped(landed, hot, settings), _hot_dropped(spark, landed, hot, settings)]
    dropped = reduce(DataFrame.unionAll, parts).groupBy(*ROW).agg(F.sort_array(F.collect_set("line")).alias("gone"))
    return land(spark, dropped.select(*ROW, F.size("gone").cast("long").alias("n_dropped"), _runs(F.col("gone")).alias("drops")), "line-bitmaps")


def kept_lines(every: Column, drops: Column) -> Column:
    """The lines outside ``drops``, as slices between runs. Both are columns at hand, so that neither is worked out
    again for every run."""
    n = F.size(drops)

    def between(i: Column) -> Column:
        start = F.when(i == 0, 0).otherwise(F.get(drops, i - 1)["start"] + F.get(drops, i - 1)["size"])
        end = F.when(i == n, F.size(every)).otherwise(F.get(drops, i)["start"])
        return F.slice(every, start + 1, end - start)

    return F.flatten(F.transform(F.sequence(F.lit(0), n), between))


def apply(docs: DataFrame, maps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, drops, and kept, the text that is left."""
    named = _named(docs, doc_id, text)
    known = maps.select(F.col("doc_id").alias("own_id"), F.col("text_a").alias("own_a"), F.col("text_b").alias("own_b"), "n_dropped", "drops")
    on = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_a") == F.col("own_a")) & (F.col("text_b") == F.col("own_b"))
    joined = named.join(known, on, "left").withColumn("lines", lines(F.col("text")))
    return joined.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        "drops",
        F.when(F.col("drops").isNull(), F.col("text")).otherwise(F.array_join(kept_lines(F.col("lines"), F.col("drops")), "\n")).alias("kept"),
    )
