"""WARC archives compressed record by record with a dictionary of their own.

A file starts with a skippable frame that holds a Zstandard dictionary built from
the first records it archives; every record is a frame of its own, so any record
can be read with the dictionary and its offset. Equal payloads are archived once;
the other pages become revisit records that name the response.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

from wardstat.llm.blocks import new_file, open_file, saved, trimmed
from wardstat.session import scratch_path

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The dictionary is built from the first records of a file, up to this many bytes, and written to each file.
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 32 << 10
LEVEL = 3
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
MANIFEST = "path string, n_records long"


def roles(pages, id_col="page_id", url_col="url", html_col="html", least_bytes=0):
    """``page_id, url, payload, refers_to`` of every page.

    Of pages with equal payloads of at least ``least_bytes`` bytes that with the
    largest id is archived, and ``refers_to`` of the others is its id. A null
    payload counts as empty. Null ids refer to others and are never referred
    to; pages that repeat id and payload are all archived. Digests, not
    payloads, are grouped, with a map-side part, and joined back, so that a hot
    payload can be split.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # Pages without an equal have no second row; payloads only move beside the ids that need them.
    last = rows.groupBy("digest").agg(F.max("page_id").alias("last"))
    joined = rows.join(last, "digest", "left")
    own = (F.length("payload") < least_bytes) | F.col("last").isNull() | F.col("page_id").eqNullSafe(F.col("last"))
    return joined.select("page_id", "url", "payload", F.when(~own, F.col("last")).alias("refers_to"))


def digest_of(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload, refers_to):
    """The bytes of one record: response with its payload, or revisit with the HTTP head alone."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}"]
    if url is not None:  # no line may end inside the address
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data):
    """The row of one record; see ``RECORDS``."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a record does not end where it says")
    http, _, payload = block.partition(b"\r\n\r\n")
    number = re.compile(r"<urn:page:(-?\d*)>")
    page_id = number.fullmatch(fields["WARC-Record-ID"])[1]
    revisit = fields["WARC-Type"] == "revisit"
    url = fields.get("WARC-Target-URI")
    return {
        "page_id": int(page_id) if page_id else None,
        "url": url and re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url),
        "record_type": fields["WARC-Type"],
        "refers_to": int(number.fullmatch(fields["WARC-Refers-To"])[1]) if revisit else None,
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload_bytes": int(re.search(rb"Content-Length: (\d+)", http)[1]),
        "payload": None if revisit else payload}


class Archive:
    """Writes one file; waits for ``SAMPLE_BYTES`` of records before it builds the dictionary."""

    def __init__(self, folder):
        self.path, self.out = new_file(folder, ".warc.zst")
        self.waiting, self.size, self.compressor, self.count = [], 0, None, 0

    def add(self, data):
        self.count += 1
        if self.compressor:
            self.out.write(self.compressor.compress(data))
            return
        self.waiting.append(data)
        self.size += len(data)
        if self.size >= SAMPLE_BYTES:
            self.begin()

    def begin(self):
        samples = [x[at:at + 16384] for x in self.waiting for at in range(0, len(x), 16384)]
        try:
            built = zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL)
        except zstandard.ZstdError:  # too few records: their own bytes are the dictionary
            built = zstandard.ZstdCompressionDict(
                b"".join(samples)[-DICTIONARY_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data = built.as_bytes()
        self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(data)) + data)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=built, write_content_size=True)
        for x in self.waiting:
            self.out.write(self.compressor.compress(x))
        self.waiting = []

    def close(self):
        if not self.compressor:
            self.begin()
        self.out.close()


def write_archives(rows, folder=None):
    """Archive the rows of ``roles``; the saved manifest of the files, ``path, n_records``.

    One file for each partition. Every attempt of a task writes a file with a
    name of its own and only those in the manifest count. An empty table gives
    an empty manifest.
    """
    folder = folder or scratch_path(rows.sparkSession, "archives")

    def run(batches):
        archive = None
        for batch in batches:
            archive = archive or (Archive(folder) if batch.num_rows else None)
            columns = [batch.column(i) for i in range(4)]
            for i in range(batch.num_rows):
                archive.add(record(*(c[i].as_py() for c in columns)))
        if archive:
            archive.close()
            yield pa.RecordBatch.from_pylist([{"path": archive.path, "n_records": archive.count}])

    return saved(rows.select("page_id", "url", "payload", "refers_to").mapInArrow(trimmed(run), MANIFEST), "archive-manifest")


def records_of(path, read_bytes=1 << 20):
    """The records of a file in order. Memory holds one record and ``read_bytes`` of the file."""
    with open_file(path) as file:
        magic, size = struct.unpack("<II", file.read(8))
        if magic != DICTIONARY_FRAME:
            raise ValueError(f"{path} does not start with a dictionary")
        data = file.read(size)
        trained = data[:4] == b"\x37\xa4\x30\xec"
        made = zstandard.ZstdCompressionDict(
            data, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)
        decompressor = zstandard.ZstdDecompressor(dict_data=made)
        rest = file.read(read_bytes)
        while rest:
            frame, parts = decompressor.decompressobj(), []
            while True:
                parts.append(frame.decompress(rest))
                if frame.eof:
                    rest = frame.unused_data or file.read(read_bytes)
                    break
                rest = file.read(read_bytes)
                if not rest:
                    raise ValueError(f"{path} ends inside a record")
            yield b"".join(parts)


def read_archives(manifest, files_at_once=None):
    """The records of the files of a manifest; columns as in ``RECORDS``, ``payload`` null for revisits."""
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                for data in records_of(path):
                    rows.append(parsed(data))
                    size += len(data)
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = files_at_once or max(1, manifest.count())
    return manifest.select("path").repartition(files).mapInArrow(trimmed(run), RECORDS)
