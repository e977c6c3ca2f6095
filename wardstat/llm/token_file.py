"""Token ids in binary files of patched frame-of-reference blocks.

Documents are sorted by id into ranges, one file for each range. A file holds

    b"PFR1" | blocks | index | int64 offset of the index, b"PFR1"

A block stands for ``BLOCK`` ids (the last of a file for fewer): its minimum as
uint32, the number of ids as uint16, the width in bits and the number of
exceptions as uint16 each; the residuals above the minimum packed at that width,
lowest bit first; the exceptions as uint16 places and uint32 residuals. The width
is the least that holds ``PERCENTILE`` of the block's residuals; the larger ones
are the exceptions. The index has the number of blocks and of documents (int64),
the start of every block (int64), and the id, a null mark and the token count of
every document (int64, uint8, int64).
"""

from __future__ import annotations

import io
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardstat.llm.blocks import new_file, open_file, saved, slices, trimmed
from wardstat.llm.segments import Encoder
from wardstat.session import scratch_path

MAGIC = b"PFR1"
BLOCK = 256
PERCENTILE = 0.9
ENTRIES = 600_000  # pieces that a worker remembers
GROUP = 4096  # blocks packed or read at once
HEADER = np.dtype([("least", "<u4"), ("count", "<u2"), ("width", "<u2"), ("exceptions", "<u2")])
MANIFEST = "part int, path string, n_documents long, n_tokens long"
READ = "doc_id long, part int, local_start long, n_tokens long, ids binary"


@lru_cache(2)
def encoder(path):
    """The library's tokenizer from a file. Texts that may name a special token are encoded whole."""
    from tokenizers import Tokenizer

    return Encoder(Tokenizer.from_file(path), whole=(r"<\|",), lower=True, entries=ENTRIES)


def packed(values):
    """The bytes of blocks of ``BLOCK`` ids (one shorter block if there are fewer), and their lengths."""
    rows = values.reshape(-1, BLOCK) if len(values) >= BLOCK else values.reshape(1, -1)
    least = rows.min(axis=1)
    rest = rows - least[:, None]
    bits = np.frexp(rest.astype(np.float64))[1].astype(np.uint8)
    width = np.sort(bits, axis=1)[:, int(np.ceil(PERCENTILE * rows.shape[1])) - 1]
    outside = bits > width[:, None]
    packs = [b""] * len(rows)
    for w in np.unique(width[width > 0]):
        some = np.flatnonzero(width == w)
        ones = np.unpackbits(rest[some].astype("<u4").view(np.uint8), axis=1, bitorder="little").reshape(len(some), -1, 32)
        flat = np.packbits(ones[:, :, :w].reshape(len(some), -1), axis=1, bitorder="little")
        for i, line in zip(some, flat):
            packs[i] = line.tobytes()
    head = np.zeros(len(rows), HEADER)
    head["least"], head["count"], head["width"] = least, rows.shape[1], width
    head["exceptions"] = outside.sum(axis=1)
    blocks = []
    for i, pack in enumerate(packs):
        places = np.flatnonzero(outside[i])
        blocks.append(b"".join((head[i].tobytes(), pack, places.astype("<u2").tobytes(),
                                rest[i][places].astype("<u4").tobytes())))
    return blocks


def unpacked(data, starts):
    """The ids of the blocks that begin at ``starts`` in ``data``."""
    heads = np.array([np.frombuffer(data, HEADER, 1, s)[0] for s in starts], HEADER)
    out = [None] * len(starts)
    for count, w in {(int(c), int(w)) for c, w in zip(heads["count"], heads["width"])}:
        some = np.flatnonzero((heads["count"] == count) & (heads["width"] == w))
        size = (count * w + 7) // 8
        rows = np.repeat(heads["least"][some][:, None], count, axis=1)
        if w:
            raw = np.frombuffer(b"".join(
                data[starts[i] + HEADER.itemsize:starts[i] + HEADER.itemsize + size] for i in some), np.uint8)
            ones = np.zeros((len(some), count, 32), np.uint8)
            ones[:, :, :w] = np.unpackbits(
                raw.reshape(len(some), size), axis=1, count=count * w, bitorder="little").reshape(len(some), count, w)
            rows = rows + np.packbits(ones.reshape(len(some), -1), axis=1, bitorder="little").view("<u4")
        for row, i in zip(rows, some):
            n = int(heads["exceptions"][i])
            if n:
                at = starts[i] + HEADER.itemsize + size
                places = np.frombuffer(data, "<u2", n, at)
                row[places] = heads["least"][i] + np.frombuffer(data, "<u4", n, at + 2 * n)
            out[i] = row
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


class Writer:
    """Writes one file; holds less than ``GROUP`` blocks of ids besides the index."""

    def __init__(self, folder):
        self.path, self.out = new_file(folder, ".pfr")
        self.out.write(MAGIC)
        self.at, self.starts, self.waiting, self.held = len(MAGIC), [], [], 0
        self.doc_ids, self.counts = [], []

    def add(self, doc_ids, counts, ids):
        self.doc_ids += doc_ids
        self.counts.append(counts)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK * GROUP:
            self.flush(self.held - self.held % BLOCK)

    def flush(self, upto):
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        full = upto - upto % BLOCK
        for first, last in [(a, min(a + GROUP * BLOCK, full)) for a in range(0, full, GROUP * BLOCK)] + [(full, upto)]:
            if first == last:
                continue
            blocks = packed(ids[first:last].astype(np.uint32))
            self.starts.append(self.at + np.cumsum([0, *map(len, blocks[:-1])]))
            self.out.write(b"".join(blocks))
            self.at += sum(map(len, blocks))
        self.waiting, self.held = [ids[upto:]], len(ids) - upto

    def close(self):
        self.flush(self.held)
        starts = np.concatenate(self.starts) if self.starts else np.zeros(0, np.int64)
        counts = np.concatenate(self.counts) if self.counts else np.zeros(0, np.int64)
        self.out.write(b"".join((
            np.array([len(starts), len(counts)], "<i8").tobytes(), starts.astype("<i8").tobytes(),
            np.array([x or 0 for x in self.doc_ids], "<i8").tobytes(),
            np.array([x is None for x in self.doc_ids], np.uint8).tobytes(),
            counts.astype("<i8").tobytes(), np.int64(self.at).tobytes(), MAGIC)))
        self.out.close()
        return len(counts), int(counts.sum())


def write_tokens(docs, path, folder=None, end_id=1, id_col="doc_id", text_col="text"):
    """Encode every text, add ``end_id``, write the files; their manifest ``part, path, n_documents, n_tokens``.

    Files follow one another in the order of ``doc_id`` (null ids first, equal
    ids in the order of their texts). The texts move once, by ranges of the id.
    Every attempt of a task writes a file with a name of its own and only those
    in the saved manifest count, so a lost executor leaves no half file behind.
    A null text counts as empty and gives the end id alone; an empty table
    gives an empty manifest. Other columns are not looked at.
    """
    folder = folder or scratch_path(docs.sparkSession, "token-files")

    def run(batches):
        from pyspark import TaskContext

        writer = None
        for batch in batches:
            for part, texts in slices(batch, "text"):
                writer = writer or Writer(folder)
                counts, ids = encoder(path)(texts)
                ids = np.insert(ids, np.cumsum(counts), end_id)
                writer.add(part.column(0).to_pylist(), counts + 1, ids)
        if writer:
            n_documents, n_tokens = writer.close()
            yield pa.RecordBatch.from_pylist([{
                "part": TaskContext.get().partitionId(), "path": writer.path,
                "n_documents": n_documents, "n_tokens": n_tokens}], schema=pa.schema([
                    ("part", pa.int32()), ("path", pa.string()), ("n_documents", pa.int64()), ("n_tokens", pa.int64())]))

    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    return saved(rows.mapInArrow(trimmed(run), MANIFEST), "token-manifest")


def documents_of(path):
    """Ids, null marks and token counts of a file's documents, and its blocks' starts with their end."""
    with open_file(path) as file:
        size = file.size()
        file.seek(size - 12)
        end = int(np.frombuffer(file.read(8), "<i8")[0])
        if file.read(4) != MAGIC:
            raise ValueError(f"{path} is no token file")
        file.seek(end)
        index = io.BytesIO(file.read(size - 12 - end))
    n_blocks, n_documents = np.frombuffer(index.read(16), "<i8")
    starts = np.frombuffer(index.read(8 * n_blocks), "<i8")
    doc_ids = np.frombuffer(index.read(8 * n_documents), "<i8")
    null = np.frombuffer(index.read(n_documents), np.uint8) > 0
    counts = np.frombuffer(index.read(8 * n_documents), "<i8")
    return doc_ids, null, counts, np.append(starts, end)


def groups_of(path, bounds):
    """The ids of a file, ``GROUP`` blocks at a time."""
    with open_file(path) as file:
        for first in range(0, len(bounds) - 1, GROUP):
            last = min(first + GROUP, len(bounds) - 1)
            file.seek(int(bounds[first]))
            data = file.read(int(bounds[last] - bounds[first]))
            yield unpacked(data, (bounds[first:last] - bounds[first]).tolist())


def read_tokens(manifest):
    """The documents of the files of a manifest: ``doc_id, start, n_tokens, ids, ids_crc32``.

    ``ids`` are little-endian uint32; ``start`` counts the ids of all documents
    before. Files are read where they are needed, a few blocks at a time; only
    the manifest's counts, a row for each file, are summed in one place.
    """
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                doc_ids, null, counts, bounds = documents_of(row["path"])
                ends = np.cumsum(counts)
                rest, seen, done = np.zeros(0, np.uint32), 0, 0
                for ids in groups_of(row["path"], bounds):
                    rest = np.concatenate([rest, ids])
                    upto = int(np.searchsorted(ends, seen + len(rest), "right"))
                    cells = np.split(rest, ends[done:upto] - seen)
                    if upto > done:
                        yield pa.RecordBatch.from_arrays([
                            pa.array(doc_ids[done:upto], mask=null[done:upto]),
                            pa.array(np.full(upto - done, row["part"], np.int32)),
                            pa.array(ends[done:upto] - counts[done:upto]), pa.array(counts[done:upto]),
                            pa.array([x.astype("<u4").tobytes() for x in cells[:-1]], pa.binary())],
                            names=["doc_id", "part", "local_start", "n_tokens", "ids"])
                        seen, done = int(ends[upto - 1]), upto
                    rest = cells[-1]

    before = F.coalesce(F.sum("n_tokens").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.select("part", before.alias("before"))
    rows = manifest.select("part", "path").repartition(
        max(1, manifest.count())).mapInArrow(trimmed(run), READ)
    return rows.join(F.broadcast(files), "part").select(
        "doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids",
        F.crc32("ids").alias("ids_crc32"))


def crc32_of(values):
    """crc32 of ids as little-endian uint32, as Spark's crc32 of their bytes."""
    return zlib.crc32(np.asarray(values, "<u4").tobytes())
