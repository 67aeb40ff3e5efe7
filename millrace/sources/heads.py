"""Executor-side reads of whole or partial files. Shipped by value with the plan, so it imports no
sibling module."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSystem, FileType

PIECE_BYTES = 1 << 16
CHUNK_BYTES = 8 << 20


def arrow_path(path: str) -> str:
    """Spark's ``file:/x`` as a plain path; names on other systems are escaped into a valid address."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return path if path.startswith("/") else quote(path, safe=":/@")


def open_stream(path: str):
    fs, name = FileSystem.from_uri(arrow_path(path))
    return fs.open_input_stream(name)


# What decides where the first record ends: quotes, cell ends and line breaks. Bytes of other characters are never these.
SIGNS = re.compile(rb'[",\n]')


def first_record(stream) -> bytes:
    """Everything before the first line break outside quotes, however long it is.

    A quote opens a cell only at its start; inside an open cell, two quotes are one and a single one closes it. Any
    other quote is text.
    """
    parts: list[bytes] = []
    opened = pending = False  # inside quotes; behind a quote that may close them
    last, read = -1, 0  # place of the last sign outside quotes; bytes read before this piece
    while piece := stream.read(PIECE_BYTES):
        if not read and piece.startswith(b"\xef\xbb\xbf"):
            last = 2  # behind the byte order mark the first cell starts
        for m in SIGNS.finditer(piece):
            at, sign = read + m.start(), m[0]
            if pending and not (sign == b'"' and at == last + 1):
                opened = pending = False
            if opened:
                if sign == b'"':
                    pending, last = not pending, at
            elif sign == b'"':
                if at == last + 1:
                    opened = True
            elif sign == b"\n":
                return b"".join([*parts, piece[: m.end()]])
            else:
                last = at
        read += len(piece)
        parts.append(piece)
    return b"".join(parts)


def has_quotes(stream) -> bool:
    """Whether there is a quote; read in chunks, up to the first one."""
    while chunk := stream.read(CHUNK_BYTES):
        if b'"' in chunk:
            return True
    return False


def read_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First record of each file, as a header may hold line breaks in quotes; and whether the file has quotes at all."""
    for batch in batches:
        paths = batch.column("path").to_pylist()
        lines, quotes = [], []
        for path in paths:
            with open_stream(path) as f:
                lines.append(first_record(f).decode("utf-8-sig").rstrip("\r\n"))
            with open_stream(path) as f:
                quotes.append(has_quotes(f))
        yield pa.RecordBatch.from_pydict({"path": paths, "header": lines, "quotes": quotes})


def hash_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of each file's bytes, read in chunks: a file of any size takes constant memory."""
    for batch in batches:
        paths = batch.column("path").to_pylist()
        hashes = []
        for path in paths:
            digest = hashlib.md5(usedforsecurity=False)
            with open_stream(path) as f:
                while chunk := f.read(CHUNK_BYTES):
                    digest.update(chunk)
            hashes.append(digest.hexdigest())
        yield pa.RecordBatch.from_pydict({"path": paths, "file_hash": hashes})


def move_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Moves each file to its target. A file that an earlier attempt moved is done."""
    for batch in batches:
        for path, target in zip(batch.column("path").to_pylist(), batch.column("target").to_pylist(), strict=True):
            fs, source = FileSystem.from_uri(arrow_path(path))
            _, goal = FileSystem.from_uri(arrow_path(target))
            if fs.get_file_info(source).type == FileType.NotFound:
                if fs.get_file_info(goal).type == FileType.NotFound:
                    raise FileNotFoundError(path)
                continue
            fs.create_dir(goal.rsplit("/", 1)[0], recursive=True)
            fs.move(source, goal)
        yield batch
