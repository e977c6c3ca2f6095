"""Hard negatives by threshold joins of integer vectors over an inverted index with norm bounds.

All rows are dealt to shards, the anchors that still search to blocks, each a file
of the shared folder; a pair of both is one piece of work. A search has windows of
scores. The index of a shard leaves out the leading dimensions of a row as long as
their norm alone cannot reach the lowest threshold, and rows that never can. Partial
scores are added up from the last dimensions to the first, and a pair goes once the
norms of what remains cannot lift it over its anchor's threshold. Thresholds start
high and are lowered, for the anchors alone whose windows are not yet full.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardstat.functions.names import column
from wardstat.llm.blocks import new_file, open_file, saved, trimmed
from wardstat.llm.vectors import doubles, finite, matrix, whole
from wardstat.session import scratch_path

POSITIVES = 5
NEGATIVES = 3
#: A negative's score, in hundredths of the positive's.
LOW, HIGH = 50, 95
#: Thresholds of the rounds: of the largest possible score for positives, of the window's height for negatives.
LEVELS = (0.7, 0.4, 0.2, -1.0)
DEPTHS = (0.15, 1.0)
#: Rows in a shard, anchors in a block, dimensions that are added together.
SHARD_ROWS = 8192
BLOCK_ROWS = 512
GROUP = 16
#: Pairs of a shard and a block that one task looks at.
PIECES = 4
#: Part of the pairs below which they are followed one by one, so many at a time.
SPARSE = 0.02
FOLLOWED = 1 << 16
#: Larger entries take no part: a long could not hold their products.
MOST = 1 << 28
ABOVE = 1 << 62


def _prefix_norms(x):
    """Norm of the first j entries of each row, for j from 0 to all."""
    return np.sqrt(np.concatenate([np.zeros((len(x), 1)), np.cumsum(x.astype(np.float64) ** 2, axis=1)], axis=1))


class Index:
    """A shard's rows by the dimension where their indexed part begins, for scores of ``reach`` times the anchor's norm."""

    def __init__(self, x, norms, reach):
        left = x.shape[1] - np.maximum((norms < reach).sum(axis=1) - 1, 0)
        begin = np.maximum(x.shape[1] - -(-left // GROUP) * GROUP, 0)  # where a group begins
        able = np.flatnonzero(norms[:, -1] >= reach)
        self.place = able[np.argsort(begin[able], kind="stable")]
        self.begin, self.x, self.norms = begin[self.place], x[self.place], norms[self.place]

    def above(self, queries, least):
        """Query, row and score of every pair whose score is its query's ``least`` or more."""
        own = _prefix_norms(queries)
        largest = self.norms[:, -1].max(initial=0)
        slack = 1e-9 * (1 + np.abs(least) + own[:, -1] * largest)
        kept, rest, end = np.arange(len(self.place)), self.begin, queries.shape[1]
        partial = np.zeros((len(queries), len(kept)), queries.dtype)
        alive = np.ones(partial.shape, bool)
        while end and alive.sum() > SPARSE * alive.size:
            start = max(0, end - GROUP)
            # Rows whose indexed part begins behind these dimensions have no postings here.
            count = int(np.searchsorted(self.begin[kept], end))
            partial[:, :count] += queries[:, start:end] @ self.x[kept[:count], start:end].T
            rest = np.where(np.arange(len(kept)) < count, start, self.begin[kept])  # dimensions not added yet
            alive = partial + own[:, rest] * self.norms[kept, rest] >= (least - slack)[:, None]
            some = alive.any(axis=0)
            kept, rest, partial, alive = kept[some], rest[some], partial[:, some], alive[:, some]
            end = start
        query, at = np.nonzero(alive)
        score = partial[query, at]
        for first in range(0, len(query), FOLLOWED):
            part = slice(first, first + FOLLOWED)
            left = rest[at[part]]
            if left.any():
                held = np.arange(queries.shape[1]) < left[:, None]
                score[part] += (queries[query[part]] * self.x[kept[at[part]]] * held).sum(axis=1)
        sure = score >= least[query]
        return query[sure], self.place[kept[at[sure]]], score[sure].astype(np.int64)


def _dumped(folder, **arrays):
    held = io.BytesIO()
    np.savez(held, **arrays)
    path, out = new_file(folder, ".vectors")
    out.write(held.getvalue())
    out.close()
    return path


def _loaded(path):
    with open_file(path) as file, np.load(io.BytesIO(file.read())) as held:
        return {k: held[k] for k in held.files}


def _dealt(rows, size, total, folder, width, name):
    """Rows in files of about ``size``: ``number, path``; every column but the vector ``x`` is an array of longs."""
    others = [c for c in rows.columns if c != "x"]

    def write(table):
        held = {c: table.column(c).combine_chunks().flatten().to_numpy() if c == "windows" else table.column(c).to_numpy()
                for c in others}
        path = _dumped(folder, x=matrix(table.column("x").combine_chunks(), width, np.int64), **held)
        return pa.table({"number": table.column("number").slice(0, 1), "path": [path]})

    numbered = rows.withColumn("number", F.pmod(F.xxhash64("row"), F.lit(-(-total // size))).cast("int"))
    return saved(numbered.groupBy("number").applyInArrow(write, "number int, path string"), name)


class Block:
    """Anchors of a file, their windows and lowest thresholds."""

    def __init__(self, path, number):
        held = _loaded(path)
        self.x, self.label, self.row = held["x"].astype(number), held["label"], held["row"]
        self.windows = held["windows"].reshape(-1, 4)  # the anchor's row, key, low, high
        order = np.argsort(self.row)
        self.anchor = order[np.searchsorted(self.row, self.windows[:, 0], sorter=order)]
        self.least = np.full(len(self.row), ABOVE)
        np.minimum.at(self.least, self.anchor, self.windows[:, 2])

    def reach(self):
        """The least threshold in parts of an anchor's norm; an anchor of norm 0 reaches all."""
        norm = _prefix_norms(self.x)[:, -1]
        parts = np.divide(self.least, norm, out=np.full(len(norm), -1.0), where=norm > 0)
        return float(parts.min()) * (1 - 1e-9)

    def best(self, shard, norms, same, want):
        """Place of the window, place of the row in the shard and score of the best rows of each window."""
        query, at, score = Index(shard["x"].astype(self.x.dtype), norms, self.reach()).above(self.x, self.least)
        fit = (self.label[query] == shard["label"][at]) == same
        fit &= self.row[query] != shard["row"][at]
        query, at, score = query[fit], at[fit], score[fit]
        order = np.lexsort((shard["row"][at], shard["id"][at], shard["no_id"][at], -score, query))
        query, at, score = query[order], at[order], score[order]
        first = np.searchsorted(query, np.arange(len(self.row) + 1))
        picked, of = [], []
        for number, (a, low, high) in enumerate(zip(self.anchor, self.windows[:, 2], self.windows[:, 3])):
            mine = -score[first[a]:first[a + 1]]
            begin = int(np.searchsorted(mine, -high))
            end = min(begin + want, int(np.searchsorted(mine, -low, "right")))
            picked.append(np.arange(begin, max(begin, end)) + first[a])
            of.append(np.full(len(picked[-1]), number))
        picked, of = np.concatenate(picked), np.concatenate(of)
        return of, at[picked], score[picked]


def _searched(shards, blocks, total, same, want, exact):
    """``anchor, key, score, id, row, rank``: the best ``want`` rows of each window, from every pair of shard and block."""
    number = np.float64 if exact else np.int64

    def run(batches):
        last = (None, None, None)
        for batch in batches:
            for mine, theirs in zip(*(c.to_pylist() for c in batch.columns)):
                if last[0] != mine:
                    shard = _loaded(mine)
                    last = (mine, shard, _prefix_norms(shard["x"]))
                _, shard, norms = last
                block = Block(theirs, number)
                of, at, score = block.best(shard, norms, same, want)
                yield pa.RecordBatch.from_arrays([
                    pa.array(block.windows[of, 0]), pa.array(block.windows[of, 1]), pa.array(score),
                    pa.array(shard["id"][at], mask=shard["no_id"][at] > 0), pa.array(shard["row"][at])],
                    names=["anchor", "key", "score", "id", "row"])

    pairs = shards.select(F.col("path").alias("mine"), F.explode(F.sequence(F.lit(0), F.lit(total - 1))).alias("number"))
    pairs = saved(pairs.join(blocks.withColumnRenamed("path", "theirs"), "number").select("mine", "theirs"), "pairs")
    found = pairs.repartition(max(1, -(-pairs.count() // PIECES)), "mine", "theirs").sortWithinPartitions("mine").mapInArrow(
        trimmed(run), "anchor long, key long, score long, id long, row long")
    place = Window.partitionBy("anchor", "key").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= want)


class Search:
    """Rows and anchors of one table, and the searches for windows of scores."""

    def __init__(self, rows, shard_rows=SHARD_ROWS, block_rows=BLOCK_ROWS):
        self.folder = scratch_path(rows.sparkSession, "hard-negatives")
        self.block_rows = block_rows
        norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda n, c: n + c.cast("double") * c.cast("double")))
        largest = F.max(F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x"))))
        n, self.width, self.norm, most = rows.agg(
            F.count("*"), F.max(F.size("x")), F.max(norm), largest).first()
        self.exact = (self.width or 0) * (most or 0) ** 2 < 1 << 53  # in doubles
        self.anchors = rows.where("anchor").select("row", "id", "label", "x", norm.alias("norm"))
        self.shards = _dealt(rows.select(
            "row", F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().cast("long").alias("no_id"), "label", "x"),
            shard_rows, n, self.folder, self.width, "vector-shards") if n else None

    def best(self, windows, want, same):
        """The best ``want`` rows of each window ``anchor, key, low, high``, all if fewer; ``rank`` counts from 1."""
        listed = windows.groupBy("anchor").agg(F.flatten(F.collect_list(F.array("anchor", "key", "low", "high"))).alias("windows"))
        held = saved(listed.join(self.anchors, F.col("anchor") == F.col("row")).select("row", "label", "x", "windows"), "anchors")
        n = held.count()
        if not n:
            return None
        blocks = _dealt(held, self.block_rows, n, self.folder, self.width, "anchor-blocks")
        return saved(_searched(self.shards, blocks, -(-n // self.block_rows), same, want, self.exact), "best-rows")

    def filled(self, windows, rounds, want, same):
        """``best``, with thresholds lowered from round to round for the windows that are not full.

        ``windows`` has ``anchor, key, high`` and what the expressions in ``rounds``
        need for the threshold; the last is the window's own end.
        """
        made = None
        for number, low in enumerate(rounds):
            found = self.best(windows.withColumn("low", low.cast("long")), want, same)
            if found is None:
                break
            if number < len(rounds) - 1:
                full = found.where(F.col("rank") == want).select("anchor", "key")
                found = found.join(full, ["anchor", "key"], "left_semi")
                windows = saved(windows.join(full, ["anchor", "key"], "left_anti"), "open-windows")
            made = found if made is None else made.unionByName(found)
        return made


SCHEMA = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def hard_negatives(docs, is_anchor, id_col="vec_id", vector_col="embedding", label_col="label", positives=POSITIVES,
                   negatives=NEGATIVES, low=LOW, high=HIGH, shard_rows=SHARD_ROWS, block_rows=BLOCK_ROWS):
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(256 c)``; a row's score is its inner product with the
    anchor. Higher scores come first, ties by the smaller id, null ids last. The
    anchors are the rows for which the expression ``is_anchor`` holds, their
    positives the first ``positives`` other rows of the same label, and for each of
    these come the first ``negatives`` rows of other labels whose score is between
    ``low`` and ``high`` hundredths of the positive's. Rows with a null label, a null
    vector, a null or non-finite component, or one of more than a million, take no
    part. A shorter vector stands for one with zeros at its end. Repeated rows are
    rows of their own, as anchors too. Other columns are not looked at; an empty
    table, or one without anchors, gives an empty table.
    """
    spark = docs.sparkSession
    vector = doubles(vector_col)
    rows = docs.where(column(label_col).isNotNull() & finite(vector)).select(
        column(id_col).cast("long").alias("id"), column(label_col).cast("long").alias("label"), whole(vector).alias("x"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    rows = rows.where(F.forall("x", lambda c: F.abs(c) <= MOST)).withColumn("row", F.monotonically_increasing_id())
    search = Search(saved(rows, "vector-rows"), shard_rows, block_rows)
    if search.shards is None:
        return spark.createDataFrame([], SCHEMA)
    most = F.ceil(F.col("norm") * F.lit(search.norm))
    windows = search.anchors.select(F.col("row").alias("anchor"), F.lit(0).cast("long").alias("key"),
                                    F.lit(ABOVE).alias("high"), most.alias("most"))
    found = search.filled(windows, [F.ceil(F.lit(level) * F.col("most")) for level in LEVELS], positives, True)
    if found is None:
        return spark.createDataFrame([], SCHEMA)
    found = saved(found.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
                               F.col("rank").alias("place")), "positives")
    rest = F.pmod("key", F.lit(100))  # hundredths without overflow
    whole_part = F.expr("(key - pmod(key, 100)) div 100")
    windows = found.select("anchor", F.col("positive_score").alias("key")).distinct().select(
        "anchor", "key", (whole_part * high + F.floor(rest * high / 100.0)).alias("high"),
        (whole_part * low + F.ceil(rest * low / 100.0)).alias("least"))
    windows = saved(windows.where("least <= high"), "windows")
    rounds = [F.greatest(F.col("least"), F.col("high") - F.ceil((F.col("high") - F.col("least")) * depth)) for depth in DEPTHS]
    others = search.filled(windows, rounds, negatives, False)
    if others is None:
        return spark.createDataFrame([], SCHEMA)
    named = search.anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    others = others.select("anchor", F.col("key").alias("positive_score"), "rank", F.col("id").alias("negative_id"),
                           F.col("score").alias("negative_score"))
    return found.join(others, ["anchor", "positive_score"]).join(named, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
