"""Near-duplicate documents by MinHash bands, with sequential Bayesian verification.

1. One pass over the texts: the distinct shingles of each text, their MinHash signature, and a 128-bit digest of the
   set. Equal sets are one *class*; from here on a class stands for all its copies.
2. Bands of the signature name buckets; only buckets with two classes or more are kept.
3. Candidates are compared in rounds. A round pairs the classes of a bucket with one of them: first with the smallest
   id, then with one picked by hash from the bucket's largest component so far. Buckets whose classes all are in one
   component are done. After the rounds, all pairs from different components in a bucket are compared, in blocks, that can be
   similar enough at all, by the sizes of their sets and the shingles that no other class left has. So a bucket of thousands of near copies costs a few comparisons per member, and no link between
   different components is left out.
4. A comparison reads signatures in batches. After each batch, a pair goes on only if the posterior probability of a
   similarity at the threshold or above (uniform prior) is at least ``miss``.
5. Survivors are confirmed on their full sets of words, and links are joined to components by alternating stars.

Every step is a Spark job on a table in the shared folder. The driver holds counts only.

Defined cases: a text that is null or has no word has an empty set, links with nothing and is kept. Rows of one id
are one document: they share their component. A null id links with nothing; its component is null and it is kept.
An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

from collections import OrderedDict
from dataclasses import dataclass
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.shingles import mixed, shingle_hashes, shingle_set, slices
from millrace.llm.text import land, ship


@dataclass(frozen=True)
class Settings:
    """At similarity 0.8, 32 bands of 5 rows miss a pair with probability 3e-6; ``miss`` is that of each batch."""

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5
    batch: int = 32
    miss: float = 1e-6
    rounds: int = 2
    broadcast_rows: int = 500_000
    block_classes: int = 512
    block_bytes: int = 8 << 20

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


PRODUCTION = Settings()


def _parameters(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_501)
    return rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def least_matches(settings: Settings) -> list[tuple[int, int]]:
    """(hashes read, matches needed to go on) after each batch.

    With a uniform prior, m matches in n give a Beta(m + 1, n - m + 1) posterior, and P(similarity >= t) is the
    probability of at most m successes in n + 1 trials of chance t.
    """
    t, out = settings.percent / 100, []
    for n in range(settings.batch, settings.hashes + settings.batch, settings.batch):
        n = min(n, settings.hashes)
        total, m = 0.0, -1
        while total < settings.miss:
            m += 1
            total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def signatures(spark: SparkSession, docs: DataFrame, settings: Settings, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, size of its set, two halves of the set's digest, signature."""
    ship(spark)
    slim = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    kind = dict(slim.dtypes)["id"]

    def run(batches):
        a, b = _parameters(settings.hashes)
        for batch in batches:
            for start, stop in slices(batch.column(1)):
                h, sizes = shingle_hashes(batch.column(1).slice(start, stop - start), settings.words)
                full = np.flatnonzero(sizes)
                at = (np.cumsum(sizes) - sizes)[full]
                sig = np.zeros((len(sizes), settings.hashes), dtype=np.uint32)
                digest = np.zeros((2, len(sizes)), dtype=np.uint64)
                if len(full):
                    with np.errstate(over="ignore"):
                        for k in range(settings.hashes):
                            sig[full, k] = np.minimum.reduceat((h * a[k] + b[k]) >> np.uint64(32), at)
                        for k in (0, 1):
                            digest[k, full] = np.add.reduceat(mixed(h, k + 1), at)
                width = pa.binary(settings.hashes * 4)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        pa.array(sizes),
                        pa.array(digest[0].view(np.int64)),
                        pa.array(digest[1].view(np.int64)),
                        pa.Array.from_buffers(width, len(sizes), [None, pa.py_buffer(sig.tobytes())]).cast(pa.binary()),
                    ],
                    names=["id", "n", "d1", "d2", "sig"],
                )
            pa.default_memory_pool().release_unused()

    return slim.mapInArrow(run, f"id {kind}, n long, d1 long, d2 long, sig binary")


def _similar_so_far(pairs: DataFrame, settings: Settings) -> DataFrame:
    """(a, b) of the pairs (a, b, sig_a, sig_b) that no batch of hashes rules out."""
    steps = least_matches(settings)

    def run(batches):
        for batch in batches:
            live = np.arange(batch.num_rows)
            left, right = (_matrix(batch.column(k), settings.hashes) for k in (2, 3))
            matches = np.zeros(batch.num_rows, dtype=np.int32)
            done = 0
            for n, least in steps:
                matches[live] += (left[live, done:n] == right[live, done:n]).sum(axis=1, dtype=np.int32)
                live = live[matches[live] >= least]
                done = n
            yield pa.RecordBatch.from_arrays([c.take(pa.array(live)) for c in batch.columns[:2]], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(len(column), width)


def _confirmed(pairs: DataFrame, settings: Settings) -> DataFrame:
    """(a, b) of the pairs (a, b, text_a, text_b) whose full sets are similar enough."""

    def run(batches):
        recent: OrderedDict = OrderedDict()

        def sets(key, text):
            if key in recent and recent[key][0] == text:
                recent.move_to_end(key)
            else:
                recent[key] = (text, shingle_set(text, settings.words))
                if len(recent) > 64:
                    recent.popitem(last=False)
            return recent[key][1]

        for batch in batches:
            hits = []
            for start in range(0, batch.num_rows, 256):  # few texts at a time as Python strings
                rows = zip(*(c.to_pylist() for c in batch.slice(start, 256).columns), strict=True)
                for n, (a, b, s, t) in enumerate(rows, start):
                    x, y = sets(a, s), sets(b, t)
                    common = len(x & y)
                    if common and 100 * common >= settings.percent * (len(x) + len(y) - common):
                        hits.append(n)
            yield pa.RecordBatch.from_arrays([c.take(pa.array(hits, pa.int64())) for c in batch.columns[:2]], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _links(spark: SparkSession, pairs: DataFrame, classes: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) that hold, landed."""
    side = lambda x, v: classes.select(F.col("rep").alias(x), F.col("sig").alias(v))
    read = lambda x, v: texts.select(F.col("rep").alias(x), F.col("text").alias(v))
    signed = pairs.join(side("a", "sig_a"), "a").join(side("b", "sig_b"), "b").select("a", "b", "sig_a", "sig_b")
    alive = land(spark, _similar_so_far(signed, settings), "dup-alive").distinct()
    whole = alive.join(read("a", "text_a"), "a").join(read("b", "text_b"), "b").select("a", "b", "text_a", "text_b")
    return land(spark, _confirmed(whole, settings), "dup-links")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of its component, for every node of the edges (a, b); alternating stars."""
    now = land(spark, edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "dup-stars")
    state = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Every edge points down now: the smallest neighbour below u takes all the others and u itself.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m"))
        now = land(spark, small.where("u <> v").distinct(), "dup-stars")
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = seen


def _labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members with the root of their component; only buckets with two components or more."""
    named = members.join(roots, members["rep"] == roots["node"], "left").select("bucket", "hub", "rep", "n", F.coalesce("root", "rep").alias("root"))
    split = named.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("bucket")
    return named.join(split, "bucket")


def _alone(spark: SparkSession, texts: DataFrame, reps: DataFrame, settings: Settings) -> DataFrame:
    """(rep, alone): how many shingles of each class no other of these classes has. Two classes have at most the rest
    of either in common, which rules out pairs without comparing them."""

    def run(batches):
        for batch in batches:
            for start, stop in slices(batch.column(1)):
                h, sizes = shingle_hashes(batch.column(1).slice(start, stop - start), settings.words)
                at = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
                held = pa.LargeListArray.from_arrays(at, pa.array(h.view(np.int64))).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), held], names=["rep", "h"])

    own = texts.join(reps, "rep", "left_semi").mapInArrow(run, "rep long, h array<long>").select("rep", F.explode("h").alias("h"))
    single = own.groupBy("h").agg(F.count("*").alias("c"), F.min("rep").alias("rep")).where("c = 1").groupBy("rep").agg(F.count("*").alias("c"))
    several = texts.groupBy("rep").agg(F.count("*").alias("texts")).where("texts > 1")  # ids that were given twice
    both = reps.join(single, "rep", "left").join(several, "rep", "left")
    return land(spark, both.select("rep", F.when(F.col("texts").isNull(), F.coalesce("c", F.lit(0))).otherwise(0).alias("alone")), "dup-alone")


def _links_across(spark: SparkSession, rest: DataFrame, classes: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Links between different components in a bucket, landed; rest: (bucket, hub, rep, n, root) of open buckets.

    Classes that share a bucket share its hub, so all classes of a hub's open buckets make one group. A group is cut
    into blocks of a bounded number of classes and bytes, and each pair of blocks is one task's input. A task compares
    the pairs that meet in a band, have different roots, and can be similar enough by size; it returns links only.
    """
    ship(spark)
    percent = settings.percent
    rest = land(spark, rest, "dup-rest")
    work = rest.select("hub", "rep", "n", "root").distinct()
    work = work.join(_alone(spark, texts, rest.select("rep").distinct(), settings), "rep")
    work = work.withColumn("s", F.col("n") - F.col("alone")).where(100 * F.col("s") >= percent * F.col("n"))
    sized = texts.groupBy("rep").agg(F.max(F.octet_length("text")).alias("bytes"))
    work = land(spark, work.join(sized, "rep").select("hub", "rep", "n", "s", "root", "bytes"), "dup-work")
    group = work.groupBy("hub").agg(F.count("*").alias("m"), F.sum("bytes").alias("bytes"), F.min("root").alias("low"), F.max("root").alias("high"))
    blocks = F.greatest(F.ceil(F.col("m") / settings.block_classes), F.ceil(F.col("bytes") / settings.block_bytes)).cast("int")
    group = group.where("low <> high").select("hub", blocks.alias("blocks"))
    placed = work.drop("bytes").join(group, "hub").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    turns = placed.withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    turns = turns.withColumns({"i": F.least("block", "turn"), "j": F.greatest("block", "turn")}).drop("turn", "blocks")
    held = classes.select("rep", "n", "sig").join(texts, "rep")
    full = turns.join(held, ["rep", "n"])
    found = full.groupBy("hub", "i", "j").applyInPandas(lambda key, frame: _compare_blocks(key, frame, settings), "a long, b long")
    return land(spark, found.distinct(), "dup-links")


def _compare_blocks(key: tuple, frame: pd.DataFrame, settings: Settings) -> pd.DataFrame:
    frame = frame.sort_values("rep", ignore_index=True)
    rep, n, s, root = (frame[c].to_numpy(np.int64) for c in ("rep", "n", "s", "root"))
    sig = np.frombuffer(b"".join(frame["sig"]), dtype=np.uint32).reshape(len(frame), settings.bands, settings.rows)
    flat = sig.reshape(len(frame), -1)
    block = frame["block"].to_numpy()
    left, right = np.flatnonzero(block == key[1]), np.flatnonzero(block == key[2])
    sets: dict[int, set] = {}
    of = lambda k: sets[k] if k in sets else sets.setdefault(k, shingle_set(frame["text"][k], settings.words))
    steps = least_matches(settings)
    found = []
    for x in left:
        y = right[(root[right] != root[x]) & ((100 + settings.percent) * np.minimum(s[right], s[x]) >= settings.percent * (n[right] + n[x]))]
        if key[1] == key[2]:
            y = y[rep[y] > rep[x]]
        y = y[(sig[y] == sig[x]).all(axis=2).any(axis=1)]
        done, matches = 0, np.zeros(len(y), dtype=np.int64)
        for upto, least in steps:
            matches += (flat[y, done:upto] == flat[x, done:upto]).sum(axis=1)
            y, matches, done = y[matches >= least], matches[matches >= least], upto
        for k in y:
            common = len(of(x) & of(k))
            if 100 * common >= settings.percent * (len(of(x)) + len(of(k)) - common):
                found.append((min(rep[x], rep[k]), max(rep[x], rep[k])))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def near_duplicates(
    spark: SparkSession, docs: DataFrame, settings: Settings = PRODUCTION, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    kind = docs.select(F.col(f"`{doc_id}`")).schema[0].dataType
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    sigs = land(spark, signatures(spark, docs, settings), "dup-signatures")
    linkable = sigs.where("n > 0 AND id IS NOT NULL")
    classes = land(spark, linkable.groupBy("d1", "d2", "n").agg(F.min("id").alias("rep"), F.first("sig").alias("sig")), "dup-classes")

    width = settings.rows * 4
    keys = F.array(*[F.xxhash64(F.lit(k), F.substring("sig", k * width + 1, width)) for k in range(settings.bands)])
    bands = classes.select("rep", "n", F.explode(keys).alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.count("*").alias("c"), F.min("rep").alias("hub")).where("c > 1").drop("c")
    members = land(spark, bands.join(shared, "bucket").select("bucket", "hub", "rep", "n"), "dup-members")

    wanted = land(spark, members.select("rep").distinct(), "dup-wanted")
    few = wanted.count() <= settings.broadcast_rows
    texts = docs.join(F.broadcast(wanted) if few else wanted, docs["doc_id"] == wanted["rep"], "left_semi")
    texts = land(spark, texts.select(F.col("doc_id").alias("rep"), "text").distinct(), "dup-texts")

    pair = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    links = _links(spark, members.where("rep <> hub").select(*pair("hub", "rep")).distinct(), classes, texts, settings)
    roots = components(spark, links)
    for turn in range(settings.rounds):
        open_ = _labelled(members, roots)
        largest = open_.groupBy("bucket", "root").agg(F.count("*").alias("c"), F.min(F.xxhash64(F.lit(turn), "bucket", "rep")).alias("h"))
        top = largest.groupBy("bucket").agg(F.max(F.struct("c", "root", "h")).alias("t")).select("bucket", "t.root", "t.h")
        picked = open_.join(top.withColumnRenamed("root", "top"), "bucket")
        one = picked.where((F.col("root") == F.col("top")) & (F.xxhash64(F.lit(turn), "bucket", "rep") == F.col("h")))
        one = one.select("bucket", F.col("rep").alias("pick"), F.col("n").alias("pick_n"))
        others = picked.where("root <> top").join(one, "bucket").where(_sizes_fit("n", "pick_n", settings))
        fresh = land(spark, others.where("rep <> hub AND pick <> hub").select(*pair("rep", "pick")).distinct(), "dup-pairs")
        if fresh.isEmpty():
            break
        more = _links(spark, fresh, classes, texts, settings)
        if more.isEmpty():
            continue
        roots = land(spark, components(spark, more.union(roots.select(F.col("root").alias("a"), F.col("node").alias("b")))), "dup-roots")
    more = _links_across(spark, _labelled(members, roots).where("rep <> hub"), classes, texts, settings)
    if not more.isEmpty():
        roots = components(spark, more.union(roots.select(F.col("root").alias("a"), F.col("node").alias("b"))))

    of_class = classes.select("d1", "d2", "n", "rep").join(roots, F.col("rep") == F.col("node"), "left")
    of_class = of_class.select("d1", "d2", "n", F.coalesce("root", "rep").alias("component"))
    named = sigs.drop("sig").join(of_class, ["d1", "d2", "n"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return named.select(
        F.col("id").cast(kind).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.cast(kind).alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _sizes_fit(x: str, y: str, settings: Settings):
    """Sets whose sizes differ too much can't be similar enough."""
    return 100 * F.least(x, y) >= settings.percent * F.greatest(x, y)


def keep_one(
    spark: SparkSession, docs: DataFrame, settings: Settings = PRODUCTION, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of each group of near duplicates, that with the smallest id, with the columns it came with."""
    names = docs.columns
    key = f"c{names.index(doc_id)}"
    found = near_duplicates(spark, docs, settings, doc_id, text).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    stay = plain.join(found, plain[key] == found["doc_id"], "left_semi")
    first = Window.partitionBy(key).orderBy(f"c{names.index(text)}")
    stay = stay.withColumn("place", F.row_number().over(first)).where("place = 1").drop("place")
    return stay.union(plain.where(F.col(key).isNull())).toDF(*names)
