"""Tokens, token files and archives: library results and exact round trips."""

import base64
import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from odd_cases import SF_DIR, odd_rows
from tokenizers import Tokenizer

from wardstat.llm import byte_bpe, token_file, warc
from wardstat.llm.blocks import ship

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def strange_texts():
    draw = random.Random(6)
    letters = list("aab  \n\t'stre-=—.!?09é ß  　́中文🙂ABC'ſ<|\u0085\u001fǅİ")
    made = ["".join(draw.choices(letters, k=draw.randint(0, 40))) for _ in range(3000)]
    made += ["".join(draw.choices("ab", k=draw.randint(0, 40))) for _ in range(500)]
    return made + [draw.choice("aA=-. \n") * draw.randint(1, 70) + draw.choice(["", "b", "x y"]) for _ in range(500)]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [*odd_rows(), *((1000 + i, t) for i, t in enumerate(strange_texts()))]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_byte_bpe(spark, texts, documents, nothing):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    pieces = {r: t for t, r in byte_bpe.read_ranks(RANKS).items()}
    for frame in (texts, documents):
        encoded = byte_bpe.encode(frame, RANKS, public_tokenizers.PATTERN)
        both = sorted(((r.doc_id is None, r.doc_id, list(r.ids), list(r.starts), list(r.ends)) for r in encoded.collect()))
        expected = []
        for r in frame.collect():
            text = r.text or ""
            ids = library.encode_ordinary(text)
            spots, at = [], 0
            chars = [i for i, c in enumerate(text) for _ in c.encode()]
            for t in ids:
                spots.append((chars[at], chars[at + len(pieces[t]) - 1] + 1))
                at += len(pieces[t])
            expected.append((r.doc_id is None, r.doc_id, ids, [a for a, _ in spots], [b for _, b in spots]))
        assert both == sorted(expected)
        decoded = byte_bpe.decode(encoded, RANKS).withColumn("text", byte_bpe.readable("decoded"))
        assert sorted(bytes(r.decoded) for r in decoded.collect()) == sorted((r.text or "").encode() for r in frame.collect())
        assert sorted(r.text for r in decoded.collect()) == sorted(r.text or "" for r in frame.collect())
    assert byte_bpe.encode(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def test_decoding_parts_of_a_character(spark):
    ids = spark.createDataFrame([(1, [byte_bpe.read_ranks(RANKS)[b"\xf0"]]), (2, None), (None, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: (bytes(r.decoded), r.text) for r in byte_bpe.decode(ids, RANKS).withColumn(
        "text", byte_bpe.readable("decoded")).collect()}
    assert got == {1: (b"\xf0", "�"), 2: (b"", ""), None: (b"", "")}
    with pytest.raises(Exception, match="ids without a token|out of bounds"):
        byte_bpe.decode(spark.createDataFrame([(1, [9_000_000])], "doc_id long, ids array<int>"), RANKS).collect()


@pytest.mark.parametrize("values", [
    [], [7], [0] * 300, [2 ** 32 - 1, 0], list(range(1000)), [5] * 255 + [2 ** 31], [2 ** 32 - 1] * 256])
def test_blocks_round_trip(values):
    values = np.array(values, np.uint32)
    full = len(values) // token_file.BLOCK * token_file.BLOCK
    blocks = [b for part in (values[:full], values[full:]) if len(part) for b in token_file.packed(part)]
    starts = np.cumsum([0, *map(len, blocks)])[:-1].tolist()
    assert token_file.unpacked(b"".join(blocks), starts).tolist() == values.tolist()


def test_random_blocks_round_trip():
    draw = np.random.default_rng(7)
    for width in (1, 5, 16, 31):
        values = draw.integers(0, 2 ** width, 256 * 9).astype(np.uint32)
        values[draw.integers(0, len(values), 60)] = draw.integers(0, 2 ** 32, 60)
        blocks = token_file.packed(values)
        assert token_file.unpacked(b"".join(blocks), np.cumsum([0, *map(len, blocks)])[:-1].tolist()).tolist() == values.tolist()
    assert len(b"".join(token_file.packed(np.arange(256, dtype=np.uint32) % 4))) < 256  # two bits each


def test_blocks_are_packed_without_a_number_for_each_bit():
    """A group of blocks costs a byte for each of 32 bits of an id at a time, and no wider copies of them."""
    values = np.random.default_rng(1).integers(0, 1 << 17, token_file.BLOCK * 1024, dtype=np.uint32)
    tracemalloc.start()
    blocks = token_file.packed(values)
    packing = tracemalloc.get_traced_memory()[1]
    data, starts = b"".join(blocks), np.cumsum([0, *map(len, blocks)])[:-1].tolist()
    tracemalloc.reset_peak()
    held = tracemalloc.get_traced_memory()[0]
    ids = token_file.unpacked(data, starts)
    unpacking = tracemalloc.get_traced_memory()[1] - held
    tracemalloc.stop()
    assert (ids == values).all()
    assert packing < 75 * len(values) and unpacking < 75 * len(values), (packing / len(values), unpacking / len(values))


def test_token_files(spark, texts, documents, nothing):
    library = Tokenizer.from_file(WORDS)
    for frame in (texts, documents):
        manifest = token_file.write_tokens(frame, WORDS)
        rows = sorted(((r.doc_id, r.text) for r in frame.collect()), key=lambda r: (
            r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
        expected, at = [], 0
        for i, text in rows:
            ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
            expected.append((i, at, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes()))
            at += len(ids)
        got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids))
               for r in token_file.read_tokens(manifest).orderBy("start").collect()]
        assert got == expected
    assert token_file.read_tokens(token_file.write_tokens(nothing, WORDS)).count() == 0


def test_large_files_are_read_in_groups(spark, monkeypatch, documents):
    manifest = token_file.write_tokens(documents, WORDS)
    whole = sorted((r.start, r.ids_crc32) for r in token_file.read_tokens(manifest).collect())
    for path in [r.path for r in manifest.collect()]:
        _, _, counts, bounds = token_file.documents_of(path)
        monkeypatch.setattr(token_file, "GROUP", 3)
        assert sum(len(x) for x in token_file.groups_of(path, bounds)) == counts.sum()
        monkeypatch.undo()
    assert len(whole) == documents.count()


def payloads(rows):
    last = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if i is not None:
            last[data] = max(i, last.get(data, i))
    for i, url, html in rows:
        data = (html or "").encode()
        to = last.get(data)
        own = to is None or to == i
        yield (i, url, "response" if own else "revisit", None if own else to,
               base64.b32encode(hashlib.sha1(data).digest()).decode(), len(data), data if own else None)


def test_archives(spark):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()]
    pages += [(1000 + i, f"http://x/{i}", pages[3][2]) for i in range(5)]
    pages += [(2000, None, None), (2001, "http://x/\r\nWARC-Type: forged\r\n%41 ü", ""), (None, "n", pages[3][2]),
              (None, "n", "only here"), (2002, "long", "<p>é</p>" * 400_000), (7, pages[7][1], pages[7][2])]
    frame = spark.createDataFrame([(*p, "x", None) for p in pages],
                                  "page_id long, url string, html string, digest string, payload string").repartition(3)
    roles = warc.roles(frame)
    manifest = warc.write_archives(roles)
    records = warc.read_archives(manifest)
    got = [(*r[:6], None if r.payload is None else bytes(r.payload)) for r in records.collect()]
    assert sorted(got, key=repr) == sorted(payloads(pages), key=repr)
    assert sum(r.n_records for r in manifest.collect()) == len(pages)
    small = warc.roles(frame, least_bytes=10 ** 9).where("refers_to is not null")
    assert small.count() == 0
    empty = warc.write_archives(warc.roles(frame.limit(0)))
    assert warc.read_archives(empty).count() == 0


def test_records_are_frames_of_their_own(tmp_path):
    archive = warc.Archive(str(tmp_path))
    data = [warc.record(i, f"http://x/{i}", b"<p>body</p>" * i, None if i % 3 else 99) for i in range(400)]
    for x in data:
        archive.add(x)
    archive.close()
    assert list(warc.records_of(archive.path)) == data
    assert list(warc.records_of(archive.path, read_bytes=7)) == data
    raw = open(archive.path, "rb").read()
    assert raw[:4] == (0x184D2A5D).to_bytes(4, "little")
    assert raw.count(b"\x28\xb5\x2f\xfd") >= 400
    whole = open(archive.path, "r+b")
    whole.truncate(len(raw) - 3)
    with pytest.raises(Exception):
        list(warc.records_of(archive.path))
