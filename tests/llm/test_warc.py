import io
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from wearline.llm import warc

PAGES = [(1, "http://a/1", "x" * 999), (2, "http://a/2", "x" * 999), (3, "http://a/3", "é" * 600),
         (5, "http://a/5", "é" * 600), (4, "http://a/4 \r\nb", "é" * 600), (6, None, None), (7, "u", ""),
         (8, "u", "<p>" * 400000), (8, "u", "<p>" * 400000), (None, "v", "é" * 600), (None, "w", "q" * 2000)]


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "z") for p in PAGES], "page_id long, url string, html string, record_type string")
    archives = warc.write_archives(pages.repartition(2), f"{tmp_path}/w", archive_bytes=500)
    assert archives.count() > 2
    records = warc.read_archives(archives).where("record_type != 'warcinfo'").withColumn("id", warc.page_number(F.col("record_id")))
    got = sorted(((r.id or 0, r.record_type, r.payload_length, bytes(r.payload).decode(), warc_id(r.refers_to))
                  for r in records.collect()), key=str)
    want = sorted(((i or 0, "revisit" if i in (3, 4) or i is None and h[0] == "é" else "response", len((h or "").encode()),
                    "" if i in (3, 4) or i is None and h[0] == "é" else h or "",
                    5 if i in (3, 4) or i is None and h[0] == "é" else None) for i, _, h in PAGES), key=str)
    assert got == want
    assert records.where("target_uri = 'http://a/4%20%0D%0Ab'").count() == 1


def warc_id(text):
    return None if text is None else int(text.strip("<>").rsplit(":", 1)[1])


def test_empty(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    archives = warc.write_archives(none, f"{tmp_path}/w")
    assert archives.count() == 0 and warc.read_archives(archives).count() == 0


def packed(*records, dictionary=b"WARC/1.1 response Content-Length: ", compress=True):
    d = zstandard.ZstdCompressionDict(dictionary)
    body = zstandard.compress(dictionary) if compress else dictionary
    out = struct.pack("<II", warc.DICTIONARY_MAGIC, len(body)) + body
    return out + b"".join(zstandard.ZstdCompressor(dict_data=d).compress(r) for r in records)


GOOD = warc.record({"WARC-Type": "resource", "WARC-Record-ID": "<a>", "WARC-Date": "d"}, b"hello")


@pytest.mark.parametrize("compress", [True, False])
def test_frames(compress):
    data = packed(GOOD, GOOD * 20000, compress=compress) + struct.pack("<II", 0x184D2A51, 3) + b"abc" + packed(GOOD)[0:0]
    found = list(warc.frames(io.BytesIO(data)))
    assert [c for _, c in found] == [GOOD, GOOD * 20000]
    assert data[found[1][0]:found[1][0] + 4] == warc.FRAME_MAGIC
    with pytest.raises(ValueError, match="cut"):
        list(warc.frames(io.BytesIO(packed(GOOD)[:-2])))
    with pytest.raises(ValueError, match="no frame"):
        list(warc.frames(io.BytesIO(packed(GOOD) + b"01234567")))


@pytest.mark.parametrize("bad", [b"WARC/9\r\n\r\n", GOOD[:-4], GOOD[:-1] + b"x", GOOD.replace(b"WARC-Date: d\r\n", b""),
                                 GOOD.replace(b"Length: 5", b"Length: 6"), GOOD.replace(b"WARC-Date: d", b"nothing")])
def test_bad_records_are_told(spark, tmp_path, bad):
    path = tmp_path / "a.warc.zst"
    path.write_bytes(packed(GOOD, bad, GOOD))
    paths = spark.createDataFrame([(str(path),)], "path string")
    rows = warc.read_archives(paths, "report").collect()
    assert [r.error is None for r in rows] == [True, False, True]
    with pytest.raises(Exception, match="a.warc.zst"):
        warc.read_archives(paths).collect()
