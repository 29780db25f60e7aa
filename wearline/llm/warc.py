"""WARC archives compressed with Zstandard: one frame per record, the dictionary in front."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import time
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, functions as F

from wearline.session import settle, work_path

#: Fixed values of the format: the skippable frame that holds a dictionary, a Zstandard frame, and
#: the profile of a record that repeats an earlier payload.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 64 << 20
DICTIONARY_BYTES = 32 << 10
#: Pages that the dictionary is trained on, and the longest of them.
DICTIONARY_PAGES = 300
DICTIONARY_PAGE_BYTES = 1 << 20
CHUNK = 32 << 10
REVISIT_BYTES = 1000
URN = "urn:wearline:page:"
CONTROL = re.compile(r"[\x00-\x20\x7f]")


def train_dictionary(pages: DataFrame, column: str = "html") -> bytes:
    """A dictionary trained on a bounded number of pages; without enough of them, common headers."""
    rows = (pages.select(F.col(column).cast("binary").alias("b"))
            .where(F.octet_length("b").between(64, DICTIONARY_PAGE_BYTES)).limit(DICTIONARY_PAGES).collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [bytes(r["b"]) for r in rows]).as_bytes()
    except zstandard.ZstdError:
        return record({"WARC-Type": "response", "Content-Type": "application/http;msgtype=response"}, http_head(1000))


def http_head(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def record(fields: dict, block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def with_revisits(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                  least: int = REVISIT_BYTES) -> DataFrame:
    """pages with _digest, _length and _refers_to: the largest id that has an equal payload.

    _refers_to is null for that page itself, for short payloads, and where no equal payload has an
    id. A page without an id refers to the largest id.
    """
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    marked = pages.withColumns({"_digest": F.sha1(payload), "_length": F.octet_length(payload).cast("long")})
    repeated = (marked.where(F.col("_length") >= least).groupBy(F.col("_digest").alias("_same"))
                .agg(F.max(id_col).alias("_last"), F.count("*").alias("_n")).where("_n > 1").drop("_n"))
    own = F.col(id_col)
    return (marked.join(repeated, (F.col("_digest") == F.col("_same")) & (F.col("_length") >= least), "left")
            .withColumn("_refers_to", F.when(own.isNull() | (own < F.col("_last")), F.col("_last")))
            .drop("_same", "_last"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes one record per page below folder and returns (path, n_records) of the archives.

    folder must be a store that pyarrow opens, on every executor. Each attempt of a task writes
    files of its own; only those in the returned table count. A null page or html is an empty
    payload, a null url or id is left out of the header. An empty table gives no archive.
    """
    rows = with_revisits(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                                      F.col(html_col).alias("html")), "id", "html")
    # A revisit leaves its payload out.
    rows = rows.withColumn("html", F.when(F.col("_refers_to").isNull(), F.col("html")))
    dictionary = train_dictionary(pages, html_col)
    date = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())

    def name(page_id):
        return f"<{URN}{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"

    def entry(page_id, url, html, digest, length, refers_to) -> bytes:
        same = refers_to is not None
        block = http_head(length) + (b"" if same else (html or "").encode())
        return record({
            "WARC-Type": "revisit" if same else "response", "WARC-Record-ID": name(page_id), "WARC-Date": date,
            "WARC-Target-URI": None if url is None else CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url),
            "Content-Type": "application/http;msgtype=response",
            "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
            "WARC-Profile": SAME_PAYLOAD if same else None,
            "WARC-Refers-To": name(refers_to) if same else None}, block)

    def run(batches):
        store, base = pafs.FileSystem.from_uri(folder)
        packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary),
                                          write_checksum=True)
        packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
        out = path = None
        count, done = 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    store.create_dir(base, recursive=True)
                    path = f"{base}/{uuid.uuid4().hex}.warc.zst"
                    out, count = store.open_output_stream(path, compression=None), 0
                    out.write(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
                    info = record({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
                                   "WARC-Date": date, "Content-Type": "application/warc-fields"},
                                  b"format: WARC File Format 1.1\r\n")
                    out.write(packer.compress(info))
                out.write(packer.compress(entry(row["id"], row["url"], row["html"], row["_digest"], row["_length"],
                                                row["_refers_to"])))
                count += 1
                if out.tell() >= archive_bytes:
                    out.close()
                    done.append((path, count))
                    out = None
        if out is not None:
            out.close()
            done.append((path, count))
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder.rstrip('/')}/{p.rsplit('/', 1)[1]}" for p, _ in done], pa.string()),
                                          pa.array([n for _, n in done], pa.int64())], names=["path", "n_records"])

    columns = ("id", "url", "html", "_digest", "_length", "_refers_to")
    return settle(rows.select(*columns).mapInArrow(run, "path string, n_records long"), "archives")


def frames(stream, dictionary=None):
    """(offset, content) of every frame of an open archive, one at a time in bounded memory.

    A leading skippable frame holds the dictionary, itself compressed or not; later skippable
    frames are passed over. A cut frame raises ValueError.
    """
    data, offset = stream.read(CHUNK), 0

    def need(n):
        nonlocal data
        while len(data) < n:
            more = stream.read(CHUNK)
            if not more:
                return False
            data += more
        return True

    unpacker = None
    while need(1):
        if not need(8):
            raise ValueError(f"frame at {offset} is cut")
        magic, size = struct.unpack("<II", data[:8])
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if not need(8 + size):
                raise ValueError(f"frame at {offset} is cut")
            if magic == DICTIONARY_MAGIC and offset == 0:
                body = data[8:8 + size]
                if body[:4] == FRAME_MAGIC:
                    body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
                dictionary = zstandard.ZstdCompressionDict(body) if body else None
            data, offset = data[8 + size:], offset + 8 + size
            continue
        if data[:4] != FRAME_MAGIC:
            raise ValueError(f"no frame at {offset}")
        if unpacker is None:
            unpacker = zstandard.ZstdDecompressor(dict_data=dictionary)
        one, parts, taken = unpacker.decompressobj(), [], 0
        while True:
            try:
                parts.append(one.decompress(data))
            except zstandard.ZstdError as e:
                raise ValueError(f"frame at {offset}: {e}") from e
            taken += len(data)
            if one.eof:
                break
            data = stream.read(CHUNK)
            if not data:
                raise ValueError(f"frame at {offset} is cut")
        data = one.unused_data
        taken -= len(data)
        yield offset, b"".join(parts)
        offset += taken


def parse_record(content: bytes) -> dict:
    """Header fields (lower case) and block of one record; ValueError if it is not well formed."""
    head, gap, rest = content.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise ValueError("no WARC header")
    fields = {}
    for line in lines[1:]:
        key, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"header line {line!r}")
        fields[key.strip().lower()] = value.strip()
    for key in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if key not in fields:
            raise ValueError(f"no {key}")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError("the block is not as long as the header says")
    return fields | {"block": rest[:-4]}


def parse_payload(fields: dict) -> dict:
    """Adds payload, payload_length and payload_digest (hex) and checks them."""
    payload, length = fields["block"], len(fields["block"])
    if fields.get("content-type", "").startswith("application/http"):
        head, gap, payload = payload.partition(b"\r\n\r\n")
        if not gap:
            raise ValueError("no HTTP header")
        said = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", head)
        length = int(said[1]) if said else len(payload)
        if fields["warc-type"] == "response" and length != len(payload):
            raise ValueError("the payload is not as long as the HTTP header says")
    digest = fields.get("warc-payload-digest")
    digest = base64.b32decode(digest[5:]).hex() if digest and digest.startswith("sha1:") else None
    if fields["warc-type"] == "response" and digest is not None and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError("the payload does not have the digest of the header")
    return fields | {"payload": payload, "payload_length": length, "payload_digest": digest}


RECORD = pa.schema([
    ("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
    ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_length", pa.int64()),
    ("payload_digest", pa.string()), ("payload", pa.binary()), ("error", pa.string())])


def read_archives(paths: DataFrame, on_error: str = "raise") -> DataFrame:
    """Every record of the archives in column path, with its payload.

    on_error: "raise" stops at a broken archive and names it; "report" gives a row with the error
    and goes on with the next record, or the next archive if a frame is broken.
    """
    def one(path):
        store, at = pafs.FileSystem.from_uri(path)
        with store.open_input_stream(at, compression=None) as stream:
            walk = frames(stream)
            while True:
                offset = None
                try:
                    item = next(walk, None)
                    if item is None:
                        return
                    offset = item[0]
                    f = parse_payload(parse_record(item[1]))
                except (ValueError, UnicodeDecodeError) as e:
                    if on_error == "raise":
                        raise ValueError(f"{path}, offset {offset}: {e}") from e
                    yield {"path": path, "offset": offset, "error": str(e)}
                    if offset is None:
                        return
                    continue
                yield {"path": path, "offset": offset, "record_type": f["warc-type"], "record_id": f["warc-record-id"],
                       "target_uri": f.get("warc-target-uri"), "refers_to": f.get("warc-refers-to"),
                       "payload_length": f["payload_length"], "payload_digest": f["payload_digest"],
                       "payload": f["payload"]}

    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for row in one(path):
                    rows.append(row)
                    held += len(row.get("payload") or b"")
                    if held > 8 << 20 or len(rows) >= 2000:
                        yield pa.RecordBatch.from_pylist(rows, RECORD)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, RECORD)

    n = max(1, paths.count())
    return paths.select("path").repartition(n).mapInArrow(
        run, "path string, offset long, record_type string, record_id string, target_uri string, refers_to string, "
             "payload_length long, payload_digest string, payload binary, error string")


def page_number(urn):
    """The page id in a record id, or null."""
    return F.regexp_extract(urn, URN + r"(-?\d+)>", 1).try_cast("long")


def archive_folder(spark) -> str:
    return work_path(spark, "warc")
