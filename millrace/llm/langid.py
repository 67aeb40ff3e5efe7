"""Language identification with unigram pieces, summed over all segmentations.

A language is a probability for every piece of a fixed public vocabulary. The probability of a word is the sum over
all ways to cut it into pieces, by the forward algorithm; a text is as likely as its words. Piece probabilities are
learned by expectation maximisation over the same sum: every segmentation counts as much as it is likely.

``fit`` counts the words of all rows (``WHOLE``), or of a bounded sample (``Settings.docs_per_lang`` documents a language
are expected, picked by a hash of the id), and runs the E-step as a Spark job over the distinct words; the driver holds one number per piece
and language. ``predict`` and ``keep`` read whole texts in Arrow batches: a batch's words are reduced to distinct
ones, and words not met before by this worker are scored together, one array operation per pair of positions.

Defined cases: a text that is null or has no letter is ``und`` with score 0; so is every text if nothing was learned.
A character outside the vocabulary has one small probability in every language. Words run between white space, in
lower case; a longer run than ``PART`` characters is scored in consecutive parts. Equal likelihoods go to the first
language by code point. The score is the posterior of the language under equal priors. Repeated rows are judged one
by one. Other columns are never read by a prediction; ``keep`` hands them on.

The posterior of a long text is 1 whatever it says, so ``keep`` also holds a text's mean log-likelihood a character
against the bound of its language (``with_bounds``): the median of all texts that may be learned from, less ``margins``
times the distance at which the ``lowest`` share of all of them lies below their medians, ``least_margin`` at least.
A text in a language that was not learned, or in none, lies far below.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.text import held, land, ship
from millrace.operators.position import POSITION, land_in_order

UNDETERMINED = "und"
#: Longest run of characters scored as one word, with the mark of its start.
PART = 24
START = "▁"
BASE = np.uint64(0x9E3779B97F4A7C15)
SLICE_BYTES = 4 << 20


@dataclass(frozen=True)
class Settings:
    """``docs_per_lang`` bounds the sample that ``fit`` learns from (None: it learns from all rows); everything else is
    done over all rows."""

    docs_per_lang: int | None = 300
    rounds: int = 3
    smoothing: float = 0.05
    unknown: float = 1e-9
    known_words: int = 100_000
    least_score: float = 0.5
    lowest: float = 0.01
    margins: float = 3.0
    least_margin: float = 1.0


PRODUCTION = Settings()
#: Learns from every row that may be learned from.
WHOLE = Settings(docs_per_lang=None)


def vocabulary(path: str | None = None) -> list[str]:
    """Pieces of a sentencepiece model that stand for text, longest runs of white space aside."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    plain = (
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    )
    return sorted({p for p in plain if START not in p[1:] and len(p) <= PART})


def _codes(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


class Lattice:
    """Finds which stretches of words are pieces, for many words of one length at a time."""

    def __init__(self, pieces: list[str]) -> None:
        self.size = len(pieces)
        self.longest = max(map(len, pieces), default=1)
        powers = [np.uint64(1)]
        with np.errstate(over="ignore"):
            for _ in range(PART):
                powers.append(powers[-1] * BASE)
            lengths = np.array([len(p) for p in pieces], dtype=np.int64)
            codes, hashes = _codes(pieces), np.zeros(len(pieces), dtype=np.uint64)
            ends = np.cumsum(lengths)
            for k in range(int(self.longest)):
                on = lengths > k
                hashes[on] = hashes[on] * BASE + codes[(ends - lengths)[on] + k] + np.uint64(1)
        self.powers = powers
        self.order = np.argsort(hashes)
        self.keys = hashes[self.order]
        self.seen = np.zeros(1 << 22, dtype=bool)
        self.seen[(self.keys >> np.uint64(42)).astype(np.int64)] = True

    def stretches(self, codes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, pieces) of every stretch that is a piece, by start; codes: words x characters."""
        length = codes.shape[1]
        upto = [np.zeros(len(codes), dtype=np.uint64)]
        with np.errstate(over="ignore"):
            for k in range(length):
                upto.append(upto[-1] * BASE + codes[:, k] + np.uint64(1))
            for i in range(length):
                for j in range(i + 1, min(length, i + self.longest) + 1):
                    h = upto[j] - upto[i] * self.powers[j - i]
                    rows = np.flatnonzero(self.seen[(h >> np.uint64(42)).astype(np.int64)])
                    at = np.minimum(np.searchsorted(self.keys, h[rows]), len(self.keys) - 1)
                    found = self.keys[at] == h[rows]
                    yield i, j, rows[found], self.order[at[found]]


def parts(words: list[str]) -> tuple[list[str], np.ndarray]:
    """Words with the mark of their start, in parts of at most PART characters, and the word of each part."""
    out, owner = [], []
    for n, w in enumerate(words):
        w = START + w
        for k in range(0, len(w), PART):
            out.append(w[k : k + PART])
            owner.append(n)
    return out, np.array(owner, dtype=np.int64)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    order = np.argsort(lengths, kind="stable")
    for k in np.unique(lengths):
        own = order[np.searchsorted(lengths[order], k) : np.searchsorted(lengths[order], k, "right")]
        for a in range(0, len(own), 50_000):
            rows = own[a : a + 50_000]
            yield rows, _codes([words[r] for r in rows]).reshape(len(rows), int(k))


def forward(lattice: Lattice, codes: np.ndarray, probs: np.ndarray, unknown: float, keep: list | None = None) -> list[np.ndarray]:
    """Per position, the summed probability of all segmentations up to it; probs: pieces x languages."""
    alpha = [np.zeros((len(codes), probs.shape[1])) for _ in range(codes.shape[1] + 1)]
    alpha[0][:] = 1.0
    for i, j, rows, pieces in lattice.stretches(codes):
        if j == i + 1:
            rare = np.ones(len(codes), dtype=bool)
            rare[rows] = False
            alpha[j][rare] += alpha[i][rare] * unknown
            if keep is not None:
                keep.append((i, j, np.flatnonzero(rare), None))
        alpha[j][rows] += alpha[i][rows] * probs[pieces]
        if keep is not None:
            keep.append((i, j, rows, pieces))
    return alpha


def log_likelihood(lattice: Lattice, words: list[str], probs: np.ndarray, unknown: float) -> np.ndarray:
    """words x languages."""
    pieces, owner = parts(words)
    out = np.zeros((len(words), probs.shape[1]))
    for rows, codes in by_length(pieces):
        np.add.at(out, owner[rows], np.log(forward(lattice, codes, probs, unknown)[-1]))
    return out


def expected_counts(lattice: Lattice, words: list[str], counts: np.ndarray, probs: np.ndarray, unknown: float) -> np.ndarray:
    """How often each piece is used, over all segmentations of all words; probs: of one language."""
    pieces, owner = parts(words)
    out = np.zeros(lattice.size)
    for rows, codes in by_length(pieces):
        used: list = []
        alpha = [a[:, 0] for a in forward(lattice, codes, probs[:, None], unknown, used)]
        beta = [np.zeros(len(codes)) for _ in alpha]
        beta[-1][:] = 1.0
        weight = counts[owner[rows]] / alpha[-1]
        for i, j, own, ids in reversed(used):
            p = unknown if ids is None else probs[ids]
            if ids is not None:
                out += np.bincount(ids, weights=weight[own] * alpha[i][own] * p * beta[j][own], minlength=lattice.size)
            beta[i][own] += p * beta[j][own]
    return out


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    pieces: tuple[str, ...]
    probs: np.ndarray  # pieces x languages
    settings: Settings
    bounds: tuple[float, ...] = ()  # least mean log-likelihood a character, per language


def _known(docs: DataFrame, learn: Column | None, doc_id: str, text: str, lang: str) -> DataFrame:
    """(lang, pick, text) of every row that may be learned from."""
    known = docs.where(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    known = known if learn is None else known.where(learn)
    return known.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.xxhash64(F.col(f"`{doc_id}`").cast("string")).alias("pick"), F.col(f"`{text}`").alias("text"))


def _learned_from(known: DataFrame, settings: Settings) -> tuple[DataFrame, tuple[str, ...]]:
    """(lang, text) that is learned from, and the languages."""
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    languages = tuple(sorted(sizes))
    if not languages or settings.docs_per_lang is None:
        return known.select("lang", "text"), languages
    share = F.element_at(F.map_from_arrays(F.array(*map(F.lit, languages)), F.array(*[F.lit(min(1.0, settings.docs_per_lang / sizes[x])) for x in languages])), F.col("lang"))
    return known.where(F.pmod("pick", F.lit(1_000_003)) < share * 1_000_003).select("lang", "text"), languages


def fit(
    spark: SparkSession,
    docs: DataFrame,
    learn: Column | None = None,
    settings: Settings = PRODUCTION,
    vocabulary_path: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> Model:
    """Learns from the rows where ``learn`` holds and neither text nor language is null."""
    ship(spark)
    pieces = vocabulary(vocabulary_path)
    sample, languages = _learned_from(_known(docs, learn, doc_id, text, lang), settings)
    if not languages:
        return Model((), tuple(pieces), np.zeros((len(pieces), 0)), settings)
    split = F.split(F.lower("text"), r"\s+")
    counted = sample.select("lang", F.explode(split).alias("word")).where("word <> ''").groupBy("lang", "word").agg(F.count("*").alias("n"))
    if settings.docs_per_lang is not None:
        counted = counted.coalesce(8)
    counted = land(spark, counted, "lang-words")
    probs = np.full((len(pieces), len(languages)), 1.0 / len(pieces))
    for _ in range(settings.rounds):
        shared = spark.sparkContext.broadcast((pieces, languages, probs, settings.unknown))
        sums = counted.mapInPandas(_e_step(shared), "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        got = sums.toPandas()  # at most one number per piece and language
        shared.unpersist()
        counts = np.zeros_like(probs)
        counts[got["piece"].to_numpy(int), got["lang"].to_numpy(int)] = got["n"].to_numpy(float)
        counts += settings.smoothing
        probs = np.round(counts / counts.sum(axis=0), 12) + 1e-12
    return Model(languages, tuple(pieces), probs, settings)


def _lattice(pieces) -> Lattice:
    """The lattice of this worker, built once per vocabulary."""
    return held(f"lattice {hash(tuple(pieces))}", lambda: Lattice(list(pieces)))


def _e_step(model):
    def run(frames):
        import pandas as pd

        pieces, languages, probs, unknown = model.value
        lattice = _lattice(pieces)
        total = np.zeros((len(pieces), len(languages)))
        for frame in frames:
            for k, name in enumerate(languages):
                own = frame[frame["lang"] == name]
                if len(own):
                    total[:, k] += expected_counts(lattice, own["word"].tolist(), own["n"].to_numpy(float), probs[:, k], unknown)
        piece, lang = np.nonzero(total)
        yield pd.DataFrame({"lang": lang.astype("int32"), "piece": piece.astype("int32"), "n": total[piece, lang]})

    return run


class Scorer:
    """Scores whole texts; keeps the words it has met, up to ``known_words``, then starts afresh."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.lattice = Lattice(list(model.pieces))
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((model.settings.known_words, len(model.languages)))

    def _of(self, words: list[str]) -> np.ndarray:
        """words x languages, for distinct words."""
        at = np.fromiter(map(self.rows.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        new = np.flatnonzero(at < 0)
        out = np.empty((len(words), len(self.model.languages)))
        out[at >= 0] = self.scores[at[at >= 0]]
        if len(new):
            fresh = [words[k] for k in new]
            out[new] = found = log_likelihood(self.lattice, fresh, self.model.probs, self.model.settings.unknown)
            if len(self.rows) + len(fresh) > len(self.scores):
                self.rows.clear()
            if len(fresh) <= len(self.scores):
                start = len(self.rows)
                self.scores[start : start + len(fresh)] = found
                self.rows.update(zip(fresh, range(start, start + len(fresh)), strict=True))
        return out

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language (-1: undetermined), its score, and its mean log-likelihood a character, per text."""
        best, score, mean = np.full(len(texts), -1, dtype=np.int64), np.zeros(len(texts)), np.zeros(len(texts))
        if not self.model.languages:
            return best, score, mean
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < len(texts):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + SLICE_BYTES, "right")))
            best[start:stop], score[start:stop], mean[start:stop] = self._slice(texts.slice(start, stop - start))
            start = stop
        return best, score, mean

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        letters = pc.match_substring_regex(texts, r"\pL").to_numpy(zero_copy_only=False)
        split = pc.utf8_split_whitespace(pc.utf8_lower(texts))
        words = split.flatten().dictionary_encode()
        owner = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
        each = self._of(words.dictionary.to_pylist())[words.indices.to_numpy(zero_copy_only=False)]
        total = np.stack([np.bincount(owner, weights=each[:, k], minlength=len(texts)) for k in range(each.shape[1])], axis=1)
        top = total.argmax(axis=1)
        posterior = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        marked = pc.add(pc.utf8_length(words.dictionary), 1).to_numpy(zero_copy_only=False)[words.indices.to_numpy(zero_copy_only=False)]
        size = np.bincount(owner, weights=marked, minlength=len(texts))
        mean = total.max(axis=1) / np.maximum(size, 1)
        return np.where(letters, top, -1), np.where(letters, np.clip(posterior, 0.0, 1.0), 0.0), mean


def _scorer(key: str, broadcast) -> Scorer:
    """The scorer of this worker, kept from task to task."""
    return held(key, lambda: Scorer(broadcast.value))


def _shared(spark: SparkSession, model: Model):
    ship(spark)
    return uuid.uuid4().hex, spark.sparkContext.broadcast(model)


def predict(spark: SparkSession, docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score."""
    key, shared = _shared(spark, model)
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = dict(slim.dtypes)["doc_id"]

    def run(batches):
        score = _scorer(key, shared)
        names = pa.array([*shared.value.languages, UNDETERMINED], pa.string())
        for b in batches:
            best, values, _ = score(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), names.take(pa.array(np.where(best < 0, len(names) - 1, best))), pa.array(values)], names=["doc_id", "lang_pred", "score"]
            )
            pa.default_memory_pool().release_unused()

    return slim.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def quantiles(values: DataFrame, group: str, value: str, share: float) -> dict[int, float]:
    """The quantile of every group, exact, between the two values around it as near as it lies to each.

    The values are sorted in ranges and written; a value's rank is its place in its range, behind the ranges before.
    Two values a group come to the driver.
    """
    ordered = land_in_order(values.select(group, value), [group, value], "quantiles")
    split, row = F.shiftright(POSITION, 40), F.col(POSITION).bitwiseAND(F.lit((1 << 40) - 1))
    sizes = ordered.groupBy(split.alias("split")).agg(F.count("*").alias("n")).orderBy("split").collect()  # one row a range
    before, at = {}, 0
    for r in sizes:
        before[r["split"]], at = at, at + r["n"]
    first, wanted = 0, {}
    for r in ordered.groupBy(group).agg(F.count("*").alias("n")).orderBy(group).collect():  # one row a group
        place = (r["n"] - 1) * share
        low = int(place)
        wanted[r[group]] = (first + low, first + min(low + 1, r["n"] - 1), place - low)
        first += r["n"]
    if not wanted:
        return {}
    spots = {p for low, high, _ in wanted.values() for p in (low, high)}
    places = [(k, p - start) for p in spots for k, start in [max(((k, s) for k, s in before.items() if s <= p), key=lambda x: (x[1], x[0]))]]
    spark = values.sparkSession
    asked = spark.createDataFrame(places, "split long, row long")
    found = ordered.select(split.alias("split"), row.alias("row"), value).join(F.broadcast(asked), ["split", "row"]).collect()
    got = {before[r["split"]] + r["row"]: r[value] for r in found}
    return {g: got[low] + (got[high] - got[low]) * part for g, (low, high, part) in wanted.items()}


def with_bounds(
    spark: SparkSession, docs: DataFrame, model: Model, learn: Column | None = None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> Model:
    """``model`` with a bound per language, from every row that may be learned from and whose language it finds."""
    if not model.languages:
        return model
    key, shared = _shared(spark, model)

    def run(batches):
        score = _scorer(key, shared)
        names = np.array([*shared.value.languages, UNDETERMINED], dtype=object)
        for b in batches:
            best, _, mean = score(b.column(1))
            own = names[best] == b.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(best[own]), pa.array(mean[own])], names=["lang", "mean"])
            pa.default_memory_pool().release_unused()

    found = _known(docs, learn, doc_id, text, lang).select("lang", "text").mapInArrow(run, "lang long, mean double")
    found = land(spark, found, "lang-means")  # two numbers a row
    shared.unpersist()
    middle = quantiles(found, "lang", "mean", 0.5)
    if not middle:
        return model
    middles = F.element_at(F.create_map(*[F.lit(x) for k, m in middle.items() for x in (k, m)]), F.col("lang"))
    distances = found.select(F.lit(0).cast("long").alias("all"), (middles - F.col("mean")).alias("below"))
    below = quantiles(distances, "all", "below", 1 - model.settings.lowest)[0]
    margin = max(model.settings.least_margin, model.settings.margins * below)
    other = float(np.median(list(middle.values())))
    return replace(model, bounds=tuple(float(middle.get(k, other)) - margin for k in range(len(model.languages))))


def keep(spark: SparkSession, docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows whose language is found with at least ``least_score`` and that are as likely as the model's bound for
    it, if it has bounds; with the columns they came with."""
    key, shared = _shared(spark, model)
    at, names = docs.columns.index(text), docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])

    def run(batches):
        score, own = _scorer(key, shared), shared.value
        least = np.array([*(own.bounds or [-np.inf] * len(own.languages)), np.inf])  # the last for undetermined
        for b in batches:
            best, values, mean = score(b.column(at))
            yield b.filter(pa.array((best >= 0) & (values >= own.settings.least_score) & (mean >= least[best])))
            pa.default_memory_pool().release_unused()

    return plain.mapInArrow(run, plain.schema).toDF(*names)


def held_out(doc_id: str = "doc_id") -> Column:
    """A fifth of the rows, by id: those that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % 5 == 0, F.lit(False))
