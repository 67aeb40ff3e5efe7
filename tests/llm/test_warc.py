import base64
import glob
import hashlib
import io
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from millrace.llm import warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


ROWS = [(i, f"http://x.example/{i}", f"<html>{'page ' * (i % 7)} é {i // 3}</html>") for i in range(60)]
ROWS += [(100, None, None), (101, "u", ""), (102, "a b\r\nX: y", "x" * 300_000), (103, "v", "same"), (104, "w", "same"), (104, "w", "same"), (None, "z", "same"), (None, "z", "alone"), (None, "z", "alone")]


def expected(rows, least=0):
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        twins = [j for j, _, h in rows if (h or "").encode() == body and j is not None]
        last = max(twins, default=None)
        again = len([1 for _, _, h in rows if (h or "").encode() == body]) > 1 and len(body) >= least and last is not None and i != last
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", last if again else None))
    return sorted(map(str, out))


@pytest.mark.parametrize("settings", [warc.PRODUCTION, warc.Settings(least_bytes=20, archive_bytes=2000, broadcast_rows=0)])
def test_round_trip(spark, folder, settings):
    manifest = warc.write(spark, pages(spark, ROWS).withColumns({"digest": F.lit(1), "size": F.lit(2)}), f"file://{folder}/out", settings)
    got = warc.read(spark, manifest, payloads=True).collect()
    found = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got]
    assert sorted(map(str, found)) == expected(ROWS, settings.least_bytes)
    bodies = {(h or "").encode() for _, _, h in ROWS}
    assert {bytes(r["payload"]) for r in got if r["record_type"] == "response"} == bodies
    assert manifest.agg(F.sum("n_records")).first()[0] == len(ROWS)


def test_archives_are_plain_zstandard(spark, folder):
    """The head is a skippable frame with the dictionary; any record can be read alone from its offset."""
    rows = warc.read(spark, warc.write(spark, pages(spark, ROWS), f"file://{folder}/out")).collect()
    for path in glob.glob(f"{folder}/out/*.warc.zst"):
        data = open(path, "rb").read()
        magic, n = struct.unpack("<II", data[:8])
        assert magic == 0x184D2A5D
        shared = zstandard.ZstdCompressionDict(data[8 : 8 + n])
        for r in (r for r in rows if path.endswith(r["archive"])):
            raw = zstandard.ZstdDecompressor(dict_data=shared).decompressobj().decompress(data[r["record_offset"] :])
            assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
            assert warc.parse(raw)["page_id"] == r["page_id"]


def test_broken_archives_are_noticed():
    one = warc.record(1, "u", b"body" * 100, None, warc.PRODUCTION)
    head = struct.pack("<II", warc.SKIPPABLE, 0)
    frame = zstandard.ZstdCompressor().compress(one)
    assert [r for _, r in warc.frames(io.BytesIO(head + frame + frame))] == [one, one]
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.frames(io.BytesIO(head + frame + frame[:-9])))
    with pytest.raises(ValueError, match="digest"):
        warc.parse(one.replace(b"bodybody", b"bodyBODY", 1))
    with pytest.raises(ValueError, match="dictionary"):
        list(warc.frames(io.BytesIO(frame)))


def test_lost_tasks_leave_only_unnamed_files(spark, folder):
    manifest = warc.write(spark, pages(spark, ROWS), f"file://{folder}/out")
    open(f"{folder}/out/left-over.warc.zst", "wb").write(b"half")
    assert warc.read(spark, manifest).count() == len(ROWS)


def test_empty(spark, folder):
    manifest = warc.write(spark, pages(spark, ROWS).where("false"), f"file://{folder}/out")
    assert manifest.count() == 0 and warc.read(spark, manifest).count() == 0
