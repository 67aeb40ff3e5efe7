"""Fill-in-the-middle: a text's prefix, middle and suffix, in an order a model can learn to fill from.

A text is cut between units: a word with the white space before it, or the white space at the end. Units are found on
the UTF-8 bytes of a whole batch; white space is never part of another character there. Two numbers drawn from the
document's id name the cuts, two more the form.

Cuts are needed in bytes, to slice, and in code points, to report. ``ExceptionIndex`` holds only the characters of
more than one byte: where each starts, and how many bytes it and those before it take beyond one each. A place in
bytes or code points becomes the other by one binary search; a text of plain ASCII has an empty index, and both are
the same number. Its size is that of the exceptions, not of the text.

Defined cases: a null text is empty; an empty text, and one that holds a mark, stays plain. A text of white space is
one unit. A null id draws from the empty string. Rows of one id are cut at the same shares of their own units.
Repeated rows are each written. Texts of any length are handled whole, one by one beyond a slice of a batch. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.shingles import slices
from millrace.llm.text import ship

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARK = "<[PSM]>"


@dataclass(frozen=True)
class Settings:
    """``rate`` percent of the documents are cut, ``suffix_first`` percent of those in the order suffix, prefix, middle."""

    seed: str = "42"
    rate: int = 50
    suffix_first: int = 80


PRODUCTION = Settings()


class ExceptionIndex:
    """Characters of more than one byte in a run of UTF-8 bytes."""

    def __init__(self, data: np.ndarray) -> None:
        lead = np.flatnonzero(data >= 0xC0)
        extra = 1 + (data[lead] >= 0xE0).astype(np.int64) + (data[lead] >= 0xF0)
        self.upto = np.cumsum(extra)  # bytes beyond one each, of this character and those before it
        self.at_byte = lead
        self.at_char = lead - (self.upto - extra)

    def __len__(self) -> int:
        return len(self.at_byte)

    def _excess(self, places: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if not len(self):
            return np.zeros(len(places), dtype=np.int64)
        before = np.searchsorted(starts, places, "left")
        return np.where(before > 0, self.upto[before - 1], 0)

    def chars(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before each cut, given in bytes between two characters."""
        return cuts - self._excess(cuts, self.at_byte)

    def bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes before each cut, given in code points."""
        return cuts + self._excess(cuts, self.at_char)


def unit_ends(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the units of texts end, in bytes of ``data``, and how many each text has. Text i is data[starts[i]:starts[i+1]]."""
    blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    last = np.zeros(len(data), dtype=bool)
    last[starts[1:][np.diff(starts) > 0] - 1] = True
    ends = np.flatnonzero(last | (~blank & np.append(blank[1:], True))) + 1
    return ends, np.diff(np.searchsorted(ends, starts, "right"))


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts without nulls, and where each starts, the end included."""
    _, places, data = texts.buffers()
    at = np.frombuffer(places, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data or b"", dtype=np.uint8)[at[0] : at[-1]], at - at[0]


FORMS = np.array(["plain", "psm", "spm"], dtype=object)


def rewrite(texts: pa.Array, draws: list[np.ndarray], marked: np.ndarray, settings: Settings = PRODUCTION) -> tuple:
    """For texts without nulls: units, form, and cuts (prefix and middle, in code points), then the rewritten texts."""
    data, starts = _flat(texts)
    ends, n = unit_ends(data, starts)
    first = np.cumsum(n) - n
    one, two = draws[0] % (n + 1), draws[1] % (n + 1)
    plain = (n == 0) | marked | (draws[2] % 100 >= settings.rate)
    form = np.where(plain, 0, np.where(draws[3] % 100 < settings.suffix_first, 2, 1))
    edge = np.concatenate([[0], ends])  # edge[first + k] is the end of unit k where k > 0
    cut = lambda k: np.where(k > 0, edge[first + k], starts[:-1])
    a, b = cut(np.minimum(one, two)), cut(np.maximum(one, two))
    index = ExceptionIndex(data)
    origin = index.chars(starts[:-1])
    a_chars, b_chars = index.chars(a), index.chars(b)
    raw = data.tobytes()
    out = []
    for f, s, x, y, e in zip(form.tolist(), starts[:-1].tolist(), a.tolist(), b.tolist(), starts[1:].tolist(), strict=True):
        if f == 0:
            out.append(raw[s:e])
        elif f == 1:
            out.append(b"".join([b"<P>", raw[s:x], b"<S>", raw[y:e], b"<M>", raw[x:y]]))
        else:
            out.append(b"".join([b"<S>", raw[y:e], b"<P>", raw[s:x], b"<M>", raw[x:y]]))
    masked = lambda v: pa.array(v, pa.int64(), mask=plain)
    return pa.array(n, pa.int64()), pa.array(FORMS[form], pa.string()), masked(a_chars - origin), masked(b_chars - a_chars), out


def draws_of(doc_id: Column, settings: Settings = PRODUCTION) -> list[Column]:
    """Four unsigned 32-bit numbers of a document."""
    digest = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"draw_{i}") for i in range(4)]


def transform(spark: SparkSession, docs: DataFrame, settings: Settings = PRODUCTION, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n (units), form, prefix_chars and middle_chars (null if plain), output."""
    ship(spark)
    own, body = F.col(f"`{doc_id}`"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    slim = docs.select(own.alias("doc_id"), body.alias("text"), body.rlike(MARK).alias("marked"), *draws_of(own, settings))
    kind = dict(slim.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(1)):
                part = batch.slice(a, b - a)
                texts = part.column(1).cast(pa.large_string())
                draws = [part.column(3 + i).to_numpy(zero_copy_only=False) for i in range(4)]
                *columns, out = rewrite(texts, draws, part.column(2).to_numpy(zero_copy_only=False), settings)
                arrays = [part.column(0), *columns, pa.array(out, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return slim.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The exact text behind an output. A text with a mark stays plain, and no mark can arise across a cut: each begins
    with a sign that it holds only once. So an output that is not plain has three marks, its own."""
    parts = F.split(output, MARK, -1)
    prefix = F.when(form == "psm", F.get(parts, F.lit(1))).otherwise(F.get(parts, F.lit(2)))
    suffix = F.when(form == "psm", F.get(parts, F.lit(2))).otherwise(F.get(parts, F.lit(1)))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, F.get(parts, F.lit(3)), suffix))
