"""Arrow text columns as byte blocks, small numpy helpers, files on shared storage."""

from __future__ import annotations

import ctypes
import gc
import io
import sys
import uuid
import zipfile
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs

from wardstat.session import scratch_path

SLICE_BYTES = 2 << 20


SHIPPED = set()


def ship(spark):
    """Let Python workers import this package: a copy in the shared folder, once for each application."""
    if spark.sparkContext.applicationId not in SHIPPED:
        top = Path(__file__).resolve().parent.parent
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as copy:
            for path in sorted(top.rglob("*.py")):
                copy.write(path, path.relative_to(top.parent))
        folder = scratch_path(spark, "package")
        system, inner = store(folder)
        system.create_dir(inner, recursive=True)
        with system.open_output_stream(f"{inner}/{top.name}.zip") as out:
            out.write(held.getvalue())
        spark.sparkContext.addPyFile(f"{folder}/{top.name}.zip")
        SHIPPED.add(spark.sparkContext.applicationId)
    return spark


def saved(df, label):
    """Write a table to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def trimmed(run):
    """A function over batches that hands back its memory at the end: workers live on between tasks."""
    def wrapped(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux":
            ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def text_column(column):
    """A text column without nulls, with 64-bit offsets."""
    column = pc.cast(column, pa.large_string())
    return pc.fill_null(column, "") if column.null_count else column


def byte_block(column):
    """Offsets from 0 and the bytes of a column made by ``text_column``."""
    buffers = column.buffers()
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0]:offsets[-1]]


def slices(batch, text_name, limit=SLICE_BYTES):
    """Parts of a record batch of whole rows, each of at most ``limit`` bytes of text or one row."""
    column = text_column(batch.column(batch.schema.get_field_index(text_name)))
    ends = byte_block(column)[0][1:]
    first = 0
    while first < len(ends):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(first, last - first), column.slice(first, last - first)
        first = last


def ranges(starts, lengths):
    """The numbers start .. start + length - 1 of every range, one after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return shift + np.arange(total)


def as_list(lengths, values):
    """An Arrow list column from the lengths and the values one after the other."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def crc_fold(doc_id):
    """crc32 of an id as text modulo 5, as Spark's crc32(cast(id as string)) % 5."""
    return zlib.crc32(str(doc_id).encode()) % 5


def store(path):
    """The file system and inner path of a folder or file URI that all executors share."""
    return fs.FileSystem.from_uri(path)


def new_file(folder, suffix):
    """A fresh name below a shared folder, so that a repeated task never writes over another's file."""
    system, inner = store(folder)
    system.create_dir(inner, recursive=True)
    name = f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"
    return name, system.open_output_stream(
        f"{inner.rstrip('/')}/{name.rsplit('/', 1)[-1]}", compression=None)


def open_file(path):
    system, inner = store(path)
    return system.open_input_file(inner)
