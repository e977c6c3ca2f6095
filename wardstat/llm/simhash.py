"""Near-duplicates by SimHash fingerprints, linked through BK-trees.

Fingerprints within ``radius`` bits agree on all but ``radius`` of ``BANDS`` bit
bands. The distinct fingerprints that agree on the other bands are one shard,
every choice of bands makes shards of its own, so two linked fingerprints meet in
at least one. Each shard becomes a BK-tree, whose children are keyed by their
Hamming distance to the parent, and each of its members follows only the edges
within the radius. The free bits bound a shard: 22 of them, 4 million distinct
fingerprints of 8 bytes, however large a group of copies is. Trees therefore
travel to the tasks by shuffle, not by a broadcast of a size that grows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from wardstat.llm.blocks import ranges, saved, slices, trimmed
from wardstat.llm.exact_dedup import decided, digest, without
from wardstat.llm.graph import connected_components, with_least

SHINGLE = 3
RADIUS = 2
BANDS = 6
SEED = 42
BITS = 64
#: Pairs of a query and a node that are looked at together, and fingerprints read before trees are built.
FRONTIER = 2_000_000
READ = 200_000


def fingerprint(text, shingle=SHINGLE):
    """The fingerprint of UTF-8 bytes, as an unsigned number; see ``fingerprints``."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    gap = min(shingle, len(words)) - 1
    count = len(words) - gap
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, 500_000):
        pairs = zip(starts[at:at + 500_000].tolist(), ends[gap + at:gap + at + 500_000].tolist())
        hashes = np.array([digest(joined[s:e], SEED) for s, e in pairs], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count).view(">u8")[0])


def fingerprints(docs, id_col="doc_id", text_col="text", shingle=SHINGLE, digests=False):
    """``doc_id, fp`` of every row, and its ``digest`` if asked; ``fp`` is the fingerprint's 64 bits as a long.

    A bit is set if it is in over half the XXH64 hashes of the shingles, which
    repeat as often as the text does. Fewer words are one shingle; no words, as
    in a null or empty text, have the fingerprint 0.
    """
    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, "text"):
                made = [fingerprint(t.encode(), shingle) for t in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.array(made, np.uint64).view(np.int64)), *part.columns[2:]],
                    names=["doc_id", "fp", *extra])

    extra = ["digest"] if digests else []
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), *(digest(text).alias(c) for c in extra))
    return rows.mapInArrow(trimmed(run), ", ".join(["doc_id long", "fp long", *(f"{c} binary" for c in extra)]))


def band_masks(radius=RADIUS, bands=BANDS):
    """For every choice of ``radius`` bands to leave out, the mask of the others' bits."""
    bands = max(bands, radius + 1)
    parts = np.array_split(np.arange(BITS), bands)
    for free in combinations(range(bands), radius):
        yield sum(1 << int(b) for i, part in enumerate(parts) if i not in free for b in part)


class Forest:
    """BK-trees of the members of each shard; ``shard`` is sorted, members of one shard are distinct."""

    def __init__(self, members, shard):
        self.members = members
        n = len(members)
        parent, edge = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        first = np.append(True, shard[1:] != shard[:-1])
        number = np.cumsum(first) - 1
        self.root = np.flatnonzero(first)[number]
        self.size = np.bincount(number)[number]
        left, key = np.arange(n), number
        while len(left):
            # The first member of each subtree is its root, the others go below it by their distance.
            first = np.append(True, key[1:] != key[:-1])
            root = left[first][np.cumsum(first) - 1][~first]
            left = left[~first]
            distance = np.bitwise_count(members[left] ^ members[root]).astype(np.int64)
            key = root * (BITS + 1) + distance
            order = np.argsort(key, kind="stable")
            left, key = left[order], key[order]
            top = np.append(True, key[1:] != key[:-1]) if len(left) else np.zeros(0, bool)
            parent[left[top]], edge[left[top]] = key[top] // (BITS + 1), key[top] % (BITS + 1)
        self.child = np.flatnonzero(parent >= 0)
        code = parent[self.child] * (BITS + 1) + edge[self.child]
        order = np.argsort(code, kind="stable")
        self.child, self.code = self.child[order], code[order]

    def near(self, queries, radius):
        """Pairs of a query and a later member of its tree within the radius."""
        found = []
        at = np.array(queries)
        node = self.root[at]
        while len(at):
            distance = np.bitwise_count(self.members[at] ^ self.members[node]).astype(np.int64)
            hit = (distance <= radius) & (node > at)
            found.append((at[hit], node[hit]))
            low = np.searchsorted(self.code, node * (BITS + 1) + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.code, node * (BITS + 1) + np.minimum(distance + radius, BITS), "right")
            at = np.repeat(at, high - low)
            node = self.child[ranges(low, high - low)]
        return [np.concatenate(x) for x in zip(*found)]

    def links(self, radius):
        """Every linked member with the first member that its links lead to in this shard."""
        label = np.arange(len(self.members))
        todo = np.flatnonzero(self.size > 1)
        load = np.cumsum(self.size[todo])
        first = 0
        while first < len(todo):
            base = load[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(load, base + FRONTIER, "right")))
            a, b = self.near(todo[first:last], radius)
            while True:
                low = np.minimum(label[a], label[b])
                before = label.copy()
                np.minimum.at(label, label[a], low)
                np.minimum.at(label, label[b], low)
                label = label[label]
                if (label == before).all():
                    break
            first = last
        while (label != label[label]).any():
            label = label[label]
        moved = np.flatnonzero(label != np.arange(len(label)))
        return self.members[moved], self.members[label[moved]]


def near_links(distinct, radius=RADIUS):
    """Edges ``a, b`` between fingerprints that span the links of every shard; input: distinct ``fp``."""
    def run(batches):
        def linked(rows):
            keys, fps = (np.concatenate(x) for x in zip(*rows))
            if not len(fps):
                return None
            a, b = Forest(fps.view(np.uint64), keys).links(radius)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        held, count, shard, before = [], 0, -1, None
        for batch in batches:
            if not batch.num_rows:
                continue
            which, masked, fp = (np.asarray(batch.column(i)) for i in range(3))
            # Number the shards on: a new one wherever the choice or the masked bits change.
            new = np.append(before != (which[0], masked[0]), (which[1:] != which[:-1]) | (masked[1:] != masked[:-1]))
            keys = shard + np.cumsum(new)
            shard, before = int(keys[-1]), (which[-1], masked[-1])
            held.append((keys, fp.astype(np.int64)))
            count += len(fp)
            if count >= READ and keys[0] != shard:
                upto = int(np.searchsorted(keys, shard))  # the last shard may go on
                made = linked([*held[:-1], (keys[:upto], held[-1][1][:upto])])
                held, count = [(keys[upto:], held[-1][1][upto:])], len(fp) - upto
                if made is not None:
                    yield made
        if held:
            made = linked(held)
            if made is not None:
                yield made

    masks = [m - (1 << BITS) if m >> (BITS - 1) else m for m in band_masks(radius)]
    shards = distinct.select(F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks)))
                             .alias("choice", "masked"), "fp")
    return (shards.repartition("choice", "masked").sortWithinPartitions("choice", "masked")
            .mapInArrow(trimmed(run), "a long, b long"))


def named_fingerprints(rows, radius=RADIUS, **least):
    """``fp, component_id`` of the distinct fingerprints of ``rows``, and the least of each component for ``name=column``."""
    least = {"component_id": "doc_id", **least}
    distinct = saved(rows.groupBy("fp").agg(*(F.min(c).alias(name) for name, c in least.items())), "distinct-fingerprints")
    roots = connected_components(near_links(distinct.select("fp"), radius))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", *(F.col(name).alias(f"own_{name}") for name in least), F.coalesce("root", "fp").alias("root"))
    named = with_least(rooted, "root", "fp", **{name: f"own_{name}" for name in least})
    return saved(named.select("fp", *least), "named-fingerprints")


def near_groups(docs, id_col="doc_id", text_col="text", shingle=SHINGLE, radius=RADIUS):
    """``doc_id, fingerprint, component_id`` of every row.

    Fingerprints link at ``radius`` or fewer differing bits; ``component_id`` is
    the smallest id that can be reached over links, the row's own included.
    Equal fingerprints are reduced to one before anything else moves. Null ids
    are never a component's id unless it has no other; repeated rows are
    carried through; other columns are not looked at; an empty table gives an
    empty table. No link is dropped: shards hand on edges that span them.
    """
    rows = saved(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    return rows.join(named_fingerprints(rows, radius), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs, id_col="doc_id", text_col="text", shingle=SHINGLE, radius=RADIUS):
    """The rows of ``docs`` that stay, with all their columns: one of each component, that with the smallest id.

    A row is judged by its own text. Null ids come after all others, of several
    texts under the smallest id that with the least SHA-256 stays, of rows that
    repeat both id and text the smallest in column order.
    """
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    rows = saved(fingerprints(docs, id_col, text_col, shingle, digests=True), "fingerprints")
    named = named_fingerprints(rows.withColumn("place", place), radius, first="place").drop("component_id")
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("digest") == F.col("first.digest"))
    return without(docs, decided(rows.join(named, "fp").select("doc_id", "digest", kept.alias("kept"))), id_col, text_col)
