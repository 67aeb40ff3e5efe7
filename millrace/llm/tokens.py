"""Token counts of whole texts, with overlap resynchronisation for huge documents.

A text up to ``chunk`` characters is counted by its words: the tokenizer drops white space and never lets a token cross
it, so it makes of a text what it makes of its words, and few words make up most texts. A longer text is encoded in
chunks that overlap, with the offsets of every token. Two neighbouring chunks are spliced at a character position p in
their overlap that is *proven stable*: the tokenizer's own rules end a piece before p whatever stands around it, a token
starts at p in both encodings, and both agree, token for token, on the stretch up to p from the stable position before
it. Such positions are the ends of white space, the sides of a digit, and those between a letter and a mark of
punctuation. Where an overlap has none, it is widened up to the last positions there are; where the chunk has none at
all, as inside one endless word, a chunk twice as long is encoded, so that the work stays in proportion to the text.
The counts are those of encoding the whole text, and no call holds the tokens of more than a chunk where the text has
stable positions at all.

Defined cases: a null text counts as empty, with 0 bytes and 0 tokens. Repeated rows are counted each. An empty table
gives an empty result. Other columns are not read. Special strings inside a text are what the tokenizer's defaults
make of them; begin and end tokens are not added, nothing is cut or padded.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.shingles import lowered, slices
from millrace.llm.text import BLANKS, held, ship

BLANK = frozenset(" \t\n\x0b\x0c\r")

#: How a special string starts; a text with one is cut at white space only.
SPECIAL = "<|"

#: Marks that end a run of letters and join with nothing before them. An apostrophe is left out: it can start a piece
#: that takes letters in.
MARKS = frozenset('!"#$%&()*+,-./:;=>?@[]_{}~、。，．！？；：')

# How the public tokenizer normalizes a text and splits it into pieces.
PIECE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLITTERS = [
    {"type": "Split", "pattern": {"Regex": PIECE_PATTERN}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
#: ASCII without control characters and space.
PRINTED = "".join(map(chr, range(0x21, 0x7F)))
#: Letters beyond ASCII (Latin-1, Latin Extended-A, Cyrillic) that NFC leaves alone among each other and ASCII, and whose
#: lower case is one letter.
LETTERS = "".join(c for c in map(chr, [*range(0xC0, 0x180), *range(0x400, 0x460)]) if c.isalpha() and len(c.lower()) == 1)
PLAIN = re.compile(f"[{re.escape(PRINTED)}{LETTERS}]+")
#: The pattern for words of these, in lower case.
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LETTERS}]+|[0-9]|[^a-z0-9{LETTERS}]+")

#: Where a letter is followed by a mark or a digit: whatever stands around, a piece ends between them.
PART_END = f"([a-zA-Z{LETTERS}])([!-@[-`{{-~])"


@dataclass(frozen=True)
class Settings:
    tokenizer: str = "word_bpe_49k.json"
    limit: int = 2048
    chunk: int = 32_768
    overlap: int = 256
    batch_bytes: int = 4 << 20


PRODUCTION = Settings()

Encode = Callable[[str], tuple[list[int], list[tuple[int, int]]]]


def is_stable(text: str, p: int) -> bool:
    """Whether the tokenizer ends a piece before position p, whatever is left or right of the two characters there."""
    before, after = text[p - 1], text[p]
    if before in BLANK:
        return True
    if before.isascii() and after.isascii() and ((before.isdigit() and after.isalnum()) or (after.isdigit() and before.isalnum())):
        return True
    return after in MARKS and before.isalpha()


def stable(text: str, offsets: list[tuple[int, int]], start: int, low: int, high: int, only_blanks: bool = False) -> list[int]:
    """Stable positions of ``text`` from low to high where a token of the chunk at ``start`` begins."""
    at = bisect_left(offsets, (low - start, -1))
    out = []
    while at < len(offsets) and offsets[at][0] + start < high:
        p = offsets[at][0] + start
        known = p > 0 and (text[p - 1] in BLANK if only_blanks else is_stable(text, p))
        if known and (at == 0 or offsets[at - 1][1] + start <= p) and (not out or out[-1] != p):
            out.append(p)
        at += 1
    return out


def before_last(text: str, low: int, high: int, n: int, only_blanks: bool = False) -> int | None:
    """A position with n stable ones behind it, up to ``high``; none if there are fewer above ``low``."""
    for p in range(high - 1, low, -1):
        if (text[p - 1] in BLANK) if only_blanks else is_stable(text, p):
            n -= 1
            if n < 0:
                return p
    return None


def _between(ids: list[int], offsets: list[tuple[int, int]], start: int, low: int, high: int) -> list[tuple[int, int]]:
    """(id, place) of the tokens that start from low to high."""
    a, b = bisect_left(offsets, (low - start, -1)), bisect_left(offsets, (high - start, -1))
    return [(i, s + start) for i, (s, _) in zip(ids[a:b], offsets[a:b], strict=True)]


def splice(text: str, left: tuple, right: tuple, left_start: int, left_end: int, right_start: int, only_blanks: bool = False) -> int | None:
    """The last proven stable position in the overlap of two encoded chunks, if there is one."""
    one = stable(text, left[1], left_start, right_start + 1, left_end, only_blanks)
    both = sorted(set(one) & set(stable(text, right[1], right_start, right_start + 1, left_end, only_blanks)))
    for q, p in zip(both[-2::-1], both[:0:-1], strict=False):
        if _between(*left, left_start, q, p) == _between(*right, right_start, q, p):
            return p
    return None


def count_long(text: str, encode: Encode, settings: Settings = PRODUCTION) -> tuple[int, int, int]:
    """(tokens, chunks, overlaps widened) of a text of any length."""
    start, end = 0, min(settings.chunk, len(text))
    ids, offsets = encode(text[:end])
    total, chunks, widened = 0, 1, 0
    done = 0  # everything before is counted
    only_blanks = SPECIAL in text
    while end < len(text):
        wide, at = 4, None
        while at is None:
            reach = before_last(text, done, end, wide, only_blanks)
            if reach is None:
                break
            begin = min(end - settings.overlap, reach) if wide == 4 else reach
            begin = max(begin, done + 1)
            stop = min(max(begin + settings.chunk, end + settings.overlap), len(text))
            right = encode(text[begin:stop])
            at = splice(text, (ids, offsets), right, start, end, begin, only_blanks)
            if at is not None and at <= done:
                at = None
            if at is None:
                wide, widened = 4 * wide, widened + 1
        if at is None:  # no way to cut: as one, and longer
            begin, stop, at, widened = done, min(done + 2 * (end - done), len(text)), done, widened + 1
            right = encode(text[begin:stop])
        total += len(_between(ids, offsets, start, done, at))
        ids, offsets = right
        start, end, done, chunks = begin, stop, at, chunks + 1
    return total + len(_between(ids, offsets, start, done, len(text) + 1)), chunks, widened


def load(path: str):
    """The tokenizer, if it is of the kind that drops white space."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the executor's cores are taken by other tasks
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    probe = "a b\tc\nd  e"
    for s, e in made.encode(probe, add_special_tokens=False).offsets:
        if any(c in BLANK for c in probe[s:e]):
            raise ValueError(f"{path}: a token covers white space, chunks can't be spliced there")
    return made


_loaded: dict[str, object] = {}


class WordCounts:
    """Tokens of single words; keeps what it has met, at most ``KNOWN_WORDS``, and of those what was met last.

    Words are few, their spellings many: where the tokenizer's normalizer and pattern are the known ones, a word of
    ``PRINTED`` and ``LETTERS`` is the sum of its pieces in lower case, and a piece not met before goes straight to the
    tokenizer's model, spelled as its pre-tokenizer spells it. Any other word is encoded whole.
    """

    KNOWN_WORDS, LONGEST_KEPT, BATCH = 300_000, 32, 4_096

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}  # what was known before ``known`` was last full
        part = lambda p: json.loads(p.__getstate__()) if p is not None else {}
        self.splits = part(tokenizer.normalizer).get("normalizers") == NORMALIZERS and part(tokenizer.pre_tokenizer).get("pretokenizers") == SPLITTERS
        if self.splits:
            spell = tokenizer.pre_tokenizer.pre_tokenize_str
            self.model = tokenizer.model
            self.spelled = str.maketrans({c: spell(c)[0][0] for c in PRINTED + LETTERS if c == c.lower()})

    def pieces(self, word: str) -> list[str] | None:
        """The pieces of a word, if it is known how the tokenizer tells them apart."""
        if not self.splits or SPECIAL in word or not (word.isprintable() if word.isascii() else PLAIN.fullmatch(word)):
            return None
        word = word.lower()
        return [word] if word.isalpha() else PIECES.findall(word)

    def keep(self, word: str, n: int) -> int:
        if len(word) <= self.LONGEST_KEPT:
            if 2 * len(self.known) >= self.KNOWN_WORDS:
                self.known, self.older = {}, self.known
            self.known[word] = n
        return n

    def encoded(self, piece: str) -> int:
        if len(piece) > self.BATCH:
            return len(self.tokenizer.encode_batch_fast([piece], add_special_tokens=False)[0])
        return len(self.model.tokenize(piece if piece.isascii() else piece.translate(self.spelled)))

    def piece(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            n = self.older.get(piece)
            n = self.keep(piece, self.encoded(piece) if n is None else n)
        return n

    def __call__(self, words: list[str]) -> np.ndarray:
        """Counts of distinct words."""
        out = np.fromiter(map(self.known.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        whole = []
        for k in np.flatnonzero(out < 0).tolist():
            word = words[k]
            n = self.older.get(word)
            if n is None:
                parts = self.pieces(word)
                if parts is None:
                    whole.append(k)
                    continue
                n = self.encoded(word) if parts == [word] else sum(map(self.piece, parts))
            out[k] = self.keep(word, n)
        for a in range(0, len(whole), self.BATCH):
            part = whole[a : a + self.BATCH]
            got = self.tokenizer.encode_batch_fast([words[k] for k in part], add_special_tokens=False)
            for k, n in zip(part, map(len, got), strict=True):
                out[k] = self.keep(words[k], n)
        return out


def distinct_words(words: pa.Array, counts: WordCounts, special: bool) -> np.ndarray:
    """Counts of distinct words by their parts, which are fewer: a letter ends a part where a mark or a digit follows, as
    it ends a piece."""
    if special or not counts.splits:
        return counts(words.to_pylist())
    parts = pc.split_pattern(pc.replace_substring_regex(words, PART_END, r"\1 \2"), " ")
    each = parts.flatten().dictionary_encode()
    owner = np.repeat(np.arange(len(words)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    size = counts(each.dictionary.to_pylist())[each.indices.to_numpy(zero_copy_only=False)]
    return np.bincount(owner, weights=size, minlength=len(words)).astype(np.int64)


def counted_words(texts: pa.Array, counts: WordCounts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every word of the texts, one text after the other: its tokens, whether it is a word (a blank text splits into an
    empty one), and the text it is in."""
    plain = pc.fill_null(texts.cast(pa.large_string()), "")
    special = pc.any(pc.match_substring(plain, SPECIAL)).as_py()
    if not special:
        plain = lowered(plain)  # as the tokenizer does, but before the words are told apart
    split = pc.ascii_split_whitespace(pc.utf8_trim(plain, characters=BLANKS))
    each = split.flatten().dictionary_encode()
    of = each.indices.to_numpy(zero_copy_only=False)
    real = pc.not_equal(each.dictionary, "").to_numpy(zero_copy_only=False)[of]
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    return distinct_words(each.dictionary, counts, special)[of], real, owner


def word_counts(key: str, file: str) -> WordCounts:
    """The counts of this worker, kept from task to task of one query."""

    def make() -> WordCounts:
        if file not in _loaded:
            _loaded[file] = load(file)
        return WordCounts(_loaded[file])

    return held(key, make)


def count_tokens(
    spark: SparkSession, docs: DataFrame, settings: Settings = PRODUCTION, path: str | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit, n_chunks, n_widened.

    ``path`` names the tokenizer's file on the executors; without it, ``settings.tokenizer`` of the public files.
    """
    ship(spark)
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = dict(slim.dtypes)["doc_id"]

    key = uuid.uuid4().hex

    def run(batches):
        import public_tokenizers

        file = path or public_tokenizers.path(settings.tokenizer)
        counts = word_counts(key, file)
        tokenizer = counts.tokenizer

        def encode(part: str):
            got = tokenizer.encode(part, add_special_tokens=False)
            return got.ids, got.offsets

        for batch in batches:
            texts = batch.column(1)
            tokens, chunks, widened = (np.zeros(len(texts), dtype=t) for t in (np.int64, np.int32, np.int32))
            long = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False) > settings.chunk
            short = pc.if_else(pa.array(long), "", texts)
            for a, b in slices(short, settings.batch_bytes):
                each, _, owner = counted_words(short.slice(a, b - a), counts)
                tokens[a:b] = np.bincount(owner, weights=each, minlength=b - a).astype(np.int64)
            chunks[~long] = 1
            for n in np.flatnonzero(long).tolist():
                tokens[n], chunks[n], widened[n] = count_long(texts[n].as_py(), encode, settings)
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            arrays = [batch.column(0), size, pa.array(tokens), pa.array(tokens > settings.limit), pa.array(chunks), pa.array(widened)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_bytes", "n_tokens", "over_limit", "n_chunks", "n_widened"])

    return slim.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, n_chunks int, n_widened int")
