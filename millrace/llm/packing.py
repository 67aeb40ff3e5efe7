"""Best-fit packing into sequences of several permitted lengths.

Pieces are dealt by a hash of their place in the scan into shards of a bounded number (``Settings.shard``), whatever
their ids; each shard is packed by itself, so no step sees more than a shard, and the loss is a few half-filled bins per shard.

Documents in training order (``in_order``) are dealt by their place in it instead, ``Settings.stretch`` in a row to a
shard: a sequence holds documents of one stretch of the run, and shards stand in the order of the run.

Sizes are tokens of ``Settings.tokenizer``, the one that ``tokens`` counts with. A document of more tokens than the
largest length is cut, between two tokens, into pieces of that length and a rest; nothing is dropped. Inside a
shard, pieces go from long to short. A piece goes into the open bin it fills best, of whatever length. If none holds
it, the length with the least cost for each token that the bin is expected to hold is opened: the cost of a bin is an
overhead, its length and a quadratic part, and it is expected to hold what is left of the shard, up to its length. At
the end each bin is downsized to the shortest permitted length that holds its contents.

Defined cases: a text without tokens has length 0 and no piece, but still a row, with a null bin. A word belongs to the
piece that its first token stands in, so a piece inside one long word has no words. Repeated rows are packed each; two
copies of a document can share a sequence only where their places in the run lie within one stretch. Ids may be null or
repeat. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm import tokens
from millrace.llm.shingles import slices
from millrace.llm.text import land, ship


@dataclass(frozen=True)
class Settings:
    lengths: tuple[int, ...] = (512, 1024, 2048, 4096)
    overhead: float = 96.0
    quadratic: float = 32_768.0
    shard: int = 8_192
    stretch: int = 1_024
    tokenizer: str = tokens.PRODUCTION.tokenizer

    def cost(self, length: int) -> float:
        """What a sequence of this length takes to train on, in tokens."""
        return self.overhead + length + length * length / self.quadratic


PRODUCTION = Settings()


def pack(sizes: np.ndarray, settings: Settings = PRODUCTION) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For pieces of the given sizes (each from 1 to the largest length): bin, length of the bin, place in the bin."""
    lengths = sorted(settings.lengths)
    order = np.argsort(-sizes, kind="stable")
    left = int(sizes.sum())
    where = np.zeros(len(sizes), dtype=np.int64)
    offset = np.zeros(len(sizes), dtype=np.int64)
    used: list[int] = []
    opened: list[int] = []
    free: list[list[int]] = [[] for _ in range(lengths[-1] + 1)]  # open bins by room left
    rooms = 0  # bit r: there is a bin with room r
    cost = {c: settings.cost(c) for c in lengths}
    for k in order.tolist():
        size = int(sizes[k])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                rooms ^= 1 << room
        else:
            length = min(lengths[bisect_left(lengths, size) :], key=lambda c: cost[c] / min(c, left))
            b, room = len(used), length
            used.append(0)
            opened.append(length)
        where[k], offset[k] = b, used[b]
        used[b] += size
        left -= size
        if room > size:
            if not free[room - size]:
                rooms |= 1 << (room - size)
            free[room - size].append(b)
    final = np.array([lengths[bisect_left(lengths, u)] for u in used], dtype=np.int64)
    return where, final[where] if len(used) else where, offset


#: Of a piece: its number, its words (start in the document, number), and its tokens likewise.
PIECE = "piece int, piece_start long, piece_size long, token_start long, piece_tokens long"


def cut(texts: pa.Array, counts: tokens.WordCounts, longest: int) -> tuple[np.ndarray, ...]:
    """Row of each piece of the texts, tokens of its text, and PIECE; a text without tokens has one piece of none."""
    size, real, owner = tokens.counted_words(texts, counts)
    before = np.concatenate([[0], np.cumsum(size)])
    edge = before[np.searchsorted(owner, np.arange(len(texts) + 1))]
    total = np.diff(edge)
    pieces = np.maximum(1, -(-total // longest))
    first = np.cumsum(pieces) - pieces
    row = np.repeat(np.arange(len(texts)), pieces)
    number = np.arange(len(row)) - first[row]
    at = first[owner] + np.minimum((before[:-1] - edge[owner]) // longest, pieces[owner] - 1)
    n_words = np.bincount(at[real], minlength=len(row))
    upto = np.cumsum(n_words) - n_words
    start = number * longest
    return row, total[row], number, upto - upto[first[row]], n_words, start, np.minimum(total[row] - start, longest)


def in_order(spark: SparkSession, docs: DataFrame, broadcast_rows: int = 200_000) -> DataFrame:
    """``docs``, as read from files, with ``position``: the row's place in the order in which the rows were written.

    Spark numbers the files of a sorted table by its partitions, so files in order of their numbers, and the rows of
    each, are the order. Offsets are a table with one row per file; none of it comes to the driver.
    """
    place = docs.metadataColumn("_metadata")
    files = docs.select(place["file_path"].alias("packing_file")).groupBy("packing_file").agg(F.count("*").alias("n"))
    number = F.regexp_extract("packing_file", "part-([0-9]+)[^/]*$", 1).try_cast("long")
    earlier = Window.orderBy(number, "packing_file").rowsBetween(Window.unboundedPreceding, -1)
    known = files.select("packing_file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("packing_start"))
    known = land(spark, known, "packing-files")
    if known.count() <= broadcast_rows:
        known = F.broadcast(known)
    joined = docs.select("*", place["file_path"].alias("packing_path"), place["row_index"].alias("packing_row"))
    joined = joined.join(known, F.col("packing_path") == F.col("packing_file"))
    return joined.withColumn("position", F.col("packing_start") + F.col("packing_row")).select(*[f"`{c}`" for c in docs.columns if c != "position"], "position")


def _pieces(spark: SparkSession, sized: DataFrame, settings: Settings, path: str | None) -> DataFrame:
    """The pieces of texts, by tokens, with the other columns of ``sized``."""
    ship(spark)
    longest, own = max(settings.lengths), [n for n in sized.columns if n != "text"]
    sized = sized.select("text", *own)
    names = ["n_tokens", *[c.split()[0] for c in PIECE.split(", ")]]
    key = uuid.uuid4().hex

    def run(batches):
        import public_tokenizers

        counts = tokens.word_counts(key, path or public_tokenizers.path(settings.tokenizer))
        for batch in batches:
            for a, b in slices(batch.column(0)):
                row, *columns = cut(batch.column(0).slice(a, b - a), counts, longest)
                carried = [c.slice(a, b - a).take(pa.array(row)) for c in batch.columns[1:]]
                arrays = [pa.array(c, pa.int32() if n == "piece" else pa.int64()) for n, c in zip(names, columns, strict=True)]
                yield pa.RecordBatch.from_arrays([*carried, *arrays], names=[*own, *names])
            pa.default_memory_pool().release_unused()

    kinds = dict(sized.dtypes)
    return sized.mapInArrow(run, ", ".join([*[f"{n} {kinds[n]}" for n in own], "n_tokens long", PIECE]))


def _measured(docs: DataFrame, length: Column, own: list[Column], longest: int) -> DataFrame:
    """The pieces of documents of the given lengths; words are not told from tokens."""
    sized = docs.select(*own, F.coalesce(length.cast("long"), F.lit(0)).alias("n_tokens"))
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n_tokens") - 1, F.lit(0)), F.lit(longest).cast("long"))
    pieces = sized.select("*", F.posexplode(starts).alias("piece", "piece_start"))
    pieces = pieces.withColumn("piece_size", F.least(F.col("n_tokens") - F.col("piece_start"), F.lit(longest)))
    return pieces.withColumns({"token_start": F.col("piece_start"), "piece_tokens": F.col("piece_size")})


def pack_table(
    spark: SparkSession,
    docs: DataFrame,
    length: Column | None = None,
    settings: Settings = PRODUCTION,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    position: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, n_tokens of the document, piece number, piece_start and piece_size (the words before
    it and in it), token_start and piece_tokens likewise, bin_shard and bin_no that name the bin, bin_length, and
    bin_offset of the piece, both in tokens. ``length`` takes the place of the count of tokens; ``path`` names the
    tokenizer's file on the executors. With ``position``, a column of places from 0, the result has that place too, and
    bin_shard is the number of the stretch in the run."""
    ship(spark)
    own = [F.col(f"`{doc_id}`").alias("doc_id"), *([F.col(f"`{position}`").cast("long").alias("position")] if position else [])]
    if length is None:
        pieces = _pieces(spark, docs.select(*own, F.col(f"`{text}`").alias("text")), settings, path)
    else:
        pieces = _measured(docs, length, own, max(settings.lengths))
    if position:
        shard = F.floor(F.col("position") / settings.stretch).cast("int")
    else:
        shards = max(1, -(-docs.count() // settings.shard))
        # By the place of the row in the scan: rows of one id, or of none, are spread like any other.
        shard = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    # A row without tokens goes to no bin; its shard is a negative one, so that the texts are read once.
    pieces = pieces.withColumn("bin_shard", F.when(F.col("n_tokens") > 0, shard).otherwise(-1 - shard))
    order = ["piece_tokens", "position" if position else "doc_id", "piece"]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        if frame["bin_shard"].iloc[0] < 0:
            return frame.assign(piece=None, piece_start=None, token_start=None, bin_shard=None, bin_no=None, bin_length=None, bin_offset=None)
        frame = frame.sort_values(order, ascending=[False, True, True], kind="stable", ignore_index=True)
        at, ends, offset = pack(frame["piece_tokens"].to_numpy(np.int64), settings)
        return frame.assign(bin_no=at.astype("int32"), bin_length=ends, bin_offset=offset)

    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema], "bin_no int, bin_length long, bin_offset long"])
    return pieces.groupBy("bin_shard").applyInPandas(run, schema)
