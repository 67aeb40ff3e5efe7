"""SimHash fingerprints, and all fingerprints within a Hamming radius.

**Fingerprint.** A text's terms are its shingles of ``words`` words (all its words, if fewer). Each occurrence of a
term votes with its 64-bit hash: for a set bit, against a clear one; the fingerprint has the bits that win. Hashes of a
text are exploded and summed inside the task that reads it, two bits in one 64-bit sum, so a document leaves the task
as one row of sums.

**Search.** 64 bits are cut into blocks. Two fingerprints that differ in at most ``radius`` bits agree on
``blocks - radius`` blocks or more, so for every choice of that many blocks there is a table keyed by them; a pair is
found in the first table that holds it and is then compared in full.

**Neighbours.** The next document in descending id is found without sorting all rows in one place: ids are cut into
ranges (quantiles, and equal steps between two of them), each range is sorted by itself, and the first row of each is
also sent to the end of the range before it.

Defined cases: a null text is empty, an empty text has fingerprint 0. Documents stand by id descending, null ids last,
then by a hash of the text, then by the text; of equal rows either may come first. A single document is its own next.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.text import land, words

BITS = 64
LANES = "4294967297L"  # bits 0 and 32
#: Ranges of ids: quantiles, and equal steps inside each; null ids have as many ranges by hash as there are quantiles.
QUANTILES = 64


@dataclass(frozen=True)
class Settings:
    """Two fingerprints in ``blocks`` choose ``radius`` tables; more blocks make longer keys for larger corpora."""

    words: int = 5
    radius: int = 3
    blocks: int = 5
    rows_per_range: int = 1024


PRODUCTION = Settings()


def term_hashes(text: str, settings: Settings) -> str:
    """SQL for the hashes of all terms of the word array ``text``."""
    k = settings.words
    parts = ", ".join(f"get({text}, i + {j})" for j in range(k))
    return f"transform(sequence(0, greatest(size({text}) - {k}, 0)), i -> xxhash64({parts}))"


def fingerprints(df: DataFrame, texts: dict[str, str], settings: Settings = PRODUCTION) -> DataFrame:
    """``df`` with a fingerprint (long) per text column, under the names ``texts`` gives: {text: name}. The other
    columns name a row: no two rows may agree on all of them."""
    own = [c for c in df.columns if c not in texts]
    for n, t in enumerate(texts):
        df = df.withColumn(f"_w{n}", words(F.col(t)))
    # Whole rows from here: what stands before the explosion is worked out once a document.
    df = df.select(*own, *[F.when(F.size(f"_w{n}") > 0, F.expr(term_hashes(f"_w{n}", settings))).otherwise(F.array().cast("array<bigint>")).alias(f"_h{n}") for n in range(len(texts))])
    most = F.greatest(*[F.size(f"_h{n}") for n in range(len(texts))], F.lit(0))
    places = F.explode(F.sequence(F.lit(0), F.greatest(most - 1, F.lit(0)))).alias("_i")
    df = df.select("*", places)
    sums = []
    for n in range(len(texts)):
        h = f"coalesce(get(_h{n}, _i), 0L)"
        sums += [F.sum(F.expr(f"shiftrightunsigned({h}, {k}) & {LANES}")).alias(f"_s{n}_{k}") for k in range(32)]
        sums.append(F.count(F.expr(f"get(_h{n}, _i)")).alias(f"_n{n}"))
    voted = df.groupBy(*own).agg(*sums)
    out = []
    for n, name in enumerate(texts.values()):
        bits = []
        for k in range(32):
            bits.append(f"IF(2 * (_s{n}_{k} & 4294967295L) > _n{n}, {1 << k}L, 0L)")
            high = f"{1 << (k + 32)}L" if k < 31 else "shiftleft(1L, 63)"
            bits.append(f"IF(2 * shiftright(_s{n}_{k}, 32) > _n{n}, {high}, 0L)")
        out.append(F.expr(" | ".join(bits)).alias(name))
    return voted.select(*own, *out)


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / float(BITS)


def as_text(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def masks(settings: Settings) -> list[int]:
    """The bits of each table's key, as signed 64-bit numbers."""
    n = settings.blocks
    edges = [BITS * k // n for k in range(n + 1)]
    blocks = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(n)]
    keys = [sum(c) for c in combinations(blocks, n - settings.radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in keys]


def within_radius(queries: DataFrame, all_: DataFrame, settings: Settings = PRODUCTION) -> DataFrame:
    """(query, fp) for all distinct fingerprints of ``all_`` (column fp) near one of ``queries`` (column fp)."""
    keys = masks(settings)

    def tables(df: DataFrame, name: str) -> DataFrame:
        one = F.array(*[F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for t, m in enumerate(keys)])
        return df.select("fp").distinct().select(F.col("fp").alias(name), F.explode(one).alias("e")).select(name, "e.table", "e.key")

    met = tables(queries, "query").join(tables(all_, "fp"), ["table", "key"])
    apart = F.col("query").bitwiseXOR(F.col("fp"))
    first = F.coalesce(*[F.when(apart.bitwiseAND(F.lit(m).cast("long")) == 0, F.lit(t)) for t, m in enumerate(keys)])
    return met.where((F.bit_count(apart) <= settings.radius) & (first == F.col("table"))).select("query", "fp")


def with_next(spark: SparkSession, docs: DataFrame, settings: Settings = PRODUCTION) -> DataFrame:
    """``docs`` (doc_id, text) with ``row`` (names a row), ``next_row`` and ``next_text`` of the next document."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    grid = [k / QUANTILES for k in range(1, QUANTILES)]
    seen = ids.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.percentile_approx("doc_id", grid, 10_000).alias("cuts"), F.count("*").alias("n")).first()
    edges = [0, 0] if seen["low"] is None else [seen["low"], *seen["cuts"], seen["high"]]
    # The number of ranges and the rows of each both grow with the root of the rows, once there are enough.
    steps = max(1, int(seen["n"] // (max(settings.rows_per_range, seen["n"] ** 0.5) * QUANTILES)))
    n = len(edges) - 1

    edge = F.array(*[F.lit(e).cast("long") for e in edges])
    id_ = F.col("doc_id")
    at = F.greatest(F.size(F.filter(edge, lambda e: e <= id_)), F.lit(1))
    at = F.least(at, F.lit(n))
    low, high = F.element_at(edge, at).cast("double"), F.element_at(edge, at + 1).cast("double")
    step = F.when(high > low, F.floor((id_.cast("double") - low) / (high - low) * steps)).otherwise(0)
    step = F.least(F.greatest(step, F.lit(0)), F.lit(steps - 1))
    # Ranges count up as documents stand: from the largest ids down, null ids last.
    hash_ = F.xxhash64("text")
    by_id = n * steps - 1 - ((at - 1) * steps + step)
    by_hash = n * steps + F.shiftright(hash_, 58) + 32
    plain = plain.withColumn("hash", hash_).withColumn("range", F.when(id_.isNotNull(), by_id).otherwise(by_hash).cast("long"))

    order = [F.col("doc_id").desc_nulls_last(), "hash"]
    # The complement turns the order of ids round; a range holds null ids only, or none.
    rank = F.struct(F.coalesce(F.bitwise_not(id_), F.lit(0)).alias("d"), F.col("hash").alias("h"))
    heads = plain.groupBy("range").agg(F.min(rank).alias("rank"))  # at most one row per range
    ring = Window.orderBy("range")
    last = F.max("range").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.withColumn("before", F.coalesce(F.lag("range").over(ring), last))
    heads = heads.select(F.col("range").alias("r"), F.col("rank").alias("k"), "before")
    # At most as many rows as the root of all rows, or as there are quantiles.
    marked = plain.withColumn("rank", rank).join(F.broadcast(heads), (F.col("range") == F.col("r")) & (F.col("rank") == F.col("k")), "left")
    stays = F.struct(F.col("range").alias("place"), F.lit(0).alias("tail"))
    sent = F.struct(F.col("before").alias("place"), F.lit(1).alias("tail"))
    spread = marked.select("doc_id", "text", "hash", "range", F.explode(F.when(F.col("before").isNull(), F.array(stays)).otherwise(F.array(stays, sent))).alias("p"))
    spread = spread.select("doc_id", "text", "hash", "range", "p.place", "p.tail")

    w = Window.partitionBy("place").orderBy("tail", *order, "text")
    key = lambda r, k: F.shiftleft(r, 40) + k
    found = spread.withColumns(
        {
            "number": F.row_number().over(w).cast("long"),
            "next_text": F.lead("text").over(w),
            "next_tail": F.lead("tail").over(w),
            "next_range": F.lead("range").over(w),
        }
    ).where("tail = 0")
    follows = F.when(F.col("next_tail") == 0, key(F.col("range"), F.col("number") + 1)).otherwise(key(F.col("next_range"), F.lit(1)))
    return found.select("doc_id", "text", key(F.col("range"), F.col("number")).alias("row"), follows.alias("next_row"), "next_text")


def compare_edited(
    spark: SparkSession, docs: DataFrame, settings: Settings = PRODUCTION, doc_id: str = "doc_id", text: str = "text", every: int = 100
) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    and n_near: for ids divisible by ``every``, how many other documents are within the radius."""
    plain = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, CAST(n_chars - half AS INT))"), F.expr("substring(next_text, 1, half)"))
    rows = with_next(spark, plain, settings).withColumn("n_chars", n.cast("long")).withColumn("half", half)
    rows = rows.select("row", "next_row", "doc_id", "n_chars", "text", edited.alias("edited"))
    rows = rows.select("row", "next_row", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "text", "edited")
    prints = land(spark, fingerprints(rows, {"text": "fp", "edited": "edited_fp"}, settings), "simhash")

    following = prints.select(F.col("row").alias("next_row"), F.col("fp").alias("next_fp"))
    asked = prints.where(F.pmod("doc_id", F.lit(every)) == 0).select("fp")
    copies = prints.groupBy("fp").agg(F.count("*").alias("copies"))
    near = within_radius(asked, prints, settings).join(copies, "fp").groupBy("query").agg(F.sum("copies").alias("found"))
    joined = prints.join(following, "next_row").join(near.withColumnRenamed("query", "fp"), "fp", "left")
    return joined.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(F.pmod("doc_id", F.lit(every)) == 0, F.col("found") - 1).alias("n_near"),
    )
