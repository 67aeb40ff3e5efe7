"""Distinct word shingles of texts, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

_M = np.uint64(0x9DDFEA08EB382D69)
SLICE_BYTES = 4 << 20


def mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser, so that sums of products of word hashes spread over all bits."""
    with np.errstate(over="ignore"):
        h = h + np.uint64(salt)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
        return h ^ (h >> np.uint64(32))


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes of text each; a longer text is a range of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, "right")))
        yield start, stop
        start = stop


def lowered(texts: pa.Array) -> pa.Array:
    """A to Z in lower case, byte by byte: bytes of other characters are never in that range."""
    plain = pc.fill_null(texts.cast(pa.large_string()), "")
    _, places, data = plain.buffers()
    at = np.frombuffer(places, dtype=np.int64)[plain.offset : plain.offset + len(plain) + 1] if len(plain) else np.zeros(1, dtype=np.int64)
    own = np.frombuffer(data or b"", dtype=np.uint8)[at[0] : at[-1]].copy()
    own[(own >= ord("A")) & (own <= ord("Z"))] += 32
    return pa.LargeStringArray.from_buffers(len(plain), pa.py_buffer((at - at[0]).tobytes()), pa.py_buffer(own.tobytes()))


def split_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of the texts, A-Z lowered, and how many each text has."""
    plain = pc.ascii_trim_whitespace(lowered(texts))
    split = pc.ascii_split_whitespace(plain)
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    blank = pc.equal(plain, "").to_numpy(zero_copy_only=False)
    words = split.flatten()
    if blank.any():
        words = words.filter(pc.not_equal(words, ""))
        counts = np.where(blank, 0, counts)
    return words.dictionary_encode(), counts


def word_hashes(words: pa.DictionaryArray) -> np.ndarray:
    each = pd.util.hash_array(np.array(words.dictionary.to_pylist(), dtype=object), categorize=False)
    return each[words.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, dtype=np.uint64)


def shingle_hashes(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct k-word shingles of each text, one text after the other, and their numbers.

    A text with fewer than k words has its whole sequence as one shingle; one without words has none.
    """
    words, counts = split_words(texts)
    h = word_hashes(words)
    ends = np.cumsum(counts)
    starts = ends - counts
    with np.errstate(over="ignore"):
        full = h[: max(0, len(h) - k + 1)].copy()
        for i in range(1, k):
            full = full * _M + h[i : len(h) - k + 1 + i]
        full = mixed(full)
        out, sizes = [], np.zeros(len(counts), dtype=np.int64)
        for n, (a, c) in enumerate(zip(starts, counts, strict=True)):
            if c >= k:
                own = np.unique(full[a : a + c - k + 1])
            elif c:
                short = h[a]
                for x in h[a + 1 : a + c]:
                    short = short * _M + x
                own = mixed(np.array([short]), int(c))
            else:
                continue
            out.append(own)
            sizes[n] = len(own)
    return (np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)), sizes


def shingle_set(text: str | None, k: int) -> set[tuple[str, ...]]:
    """The same set in full, as words."""
    data = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if len(data) < k:
        return {tuple(data)} if data else set()
    return set(zip(*(data[i:] for i in range(k)), strict=False))
