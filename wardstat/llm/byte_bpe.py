"""Byte-level BPE encoding and decoding with offsets, from a file of ranks.

The tokenizers library runs over Arrow batches. Its vocabulary writes every
byte as one printable character; the table between the two is reversed for
decoding. Offsets count characters: a token that starts or ends inside a
character takes in the whole character.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from wardstat.llm.blocks import as_list, byte_block, slices, trimmed
from wardstat.llm.segments import Encoder

ENCODED = "doc_id long, ids array<int>, starts array<int>, ends array<int>"
DECODED = "doc_id long, ids array<int>, decoded binary"


def byte_letters():
    """The printable character that stands for each byte: itself if it has one, else the next free from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def read_ranks(path):
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(2)
def tokenizer(path, pattern):
    """A tokenizer of the library that merges like the ranks do: any two parts whose union has a rank."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, letters = read_ranks(path), byte_letters()
    spelled = {token: "".join(letters[b] for b in token) for token in ranks}
    merges = [
        (spelled[token[:i]], spelled[token[i:]])
        for token in sorted(ranks, key=ranks.get) for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks]
    made = Tokenizer(models.BPE(
        vocab={spelled[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    made.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return made


@lru_cache(2)
def encoder(path, pattern):
    return Encoder(tokenizer(path, pattern))


@lru_cache(2)
def token_bytes(path):
    """The bytes of every token, by id, as one Arrow column; ids without a token are null."""
    ranks = read_ranks(path)
    table = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return pa.array(table, pa.large_binary())


def encode(docs, path, pattern, id_col="doc_id", text_col="text"):
    """``doc_id, ids, starts, ends``: token ids and the character range of each token.

    ``path`` is a file of base64 tokens and ranks that every executor has,
    ``pattern`` the split before merging. A null text counts as empty and has
    no ids; null ids and repeated rows are carried through. Other columns are
    not looked at; an empty table gives an empty table. No shuffle.
    """
    def run(batches):
        lengths_of = np.diff(byte_block(token_bytes(path))[0])
        for batch in batches:
            for part, texts in slices(batch, "text"):
                counts, ids = encoder(path, pattern)(texts)
                offsets, data = byte_block(texts)
                size = lengths_of[ids]
                end = np.cumsum(size)
                # The character that holds each byte, counted from the start of its text.
                held = np.cumsum((data & 0xC0) != 0x80) - 1
                base = np.repeat(held[np.minimum(offsets[:-1], len(data) - 1)], counts) if len(ids) else 0
                first = held[end - size] - base if len(ids) else end
                last = held[end - 1] - base + 1 if len(ids) else end
                yield pa.RecordBatch.from_arrays([
                    part.column(0), *(as_list(counts, pa.array(x.astype(np.int32))) for x in (ids, first, last))],
                    names=["doc_id", "ids", "starts", "ends"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(trimmed(run), ENCODED)


def decode(encoded, path, id_col="doc_id", ids_col="ids"):
    """``doc_id, ids, decoded``: the bytes that the ids stand for, joined before any reading as characters.

    A character whose bytes are spread over tokens comes out whole; bytes that
    are no text stay as they are, see ``readable``. A null list counts as empty,
    an id outside the table is an error.
    """
    def run(batches):
        table = token_bytes(path)
        for batch in batches:
            lists = batch.column(1)
            counts = np.asarray(lists.value_lengths().fill_null(0), dtype=np.int64)
            tokens = table.take(lists.flatten())
            if tokens.null_count:
                raise ValueError(f"ids without a token in {path}")
            at = byte_block(tokens)
            ends = np.concatenate([[0], np.cumsum(counts)])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), lists, pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(counts),
                    [None, pa.py_buffer(at[0][ends]), pa.py_buffer(np.ascontiguousarray(at[1]))]).cast(pa.binary())],
                names=["doc_id", "ids", "decoded"])

    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(trimmed(run), DECODED)


def readable(decoded):
    """Decoded bytes as text; each byte that is part of no character becomes U+FFFD."""
    return F.make_valid_utf8(F.col(decoded).cast("string"))
