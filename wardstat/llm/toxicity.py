"""Toxicity by a linear-chain conditional random field over words.

Labels of documents become labels of words: words and prefixes that hardly ever
occur in clean documents are chosen until they account for each toxic document
``COVER`` times over, the one that accounts for most first, and the words of toxic
documents that have a chosen one are toxic. The field is fitted to those labels.
Forward-backward gives every word of a text its marginal probability; marginals
aggregate to the score of the document and to the places of its toxic spans.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from wardstat.llm.blocks import crc_fold, ranges, slices, text_column, trimmed
from wardstat.llm.labels import sample
from wardstat.llm.words import word_cells

COVER = 3
LEAST_DOCS = 3
#: Share of clean documents that a chosen word or prefix may occur in.
CLEAN_SHARE = 0.001
PREFIXES = (4, 5, 6)
STEPS = 40
RATE = 0.5
RIDGE = 1e-4
CHUNK = 64
REMEMBERED = 150_000
SPAN = 0.5  # marginal from which a word is part of a toxic span
EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def features(word):
    """What the field sees of a word: its core, the core's prefixes and suffix, and how it is written."""
    core = EDGE.sub("", word)
    return ["=" + core, *("^" + core[:n] for n in PREFIXES if len(core) >= n), "$" + core[-3:],
            "~" + "".join(dict.fromkeys("a" if c.isalpha() else "0" if c.isdigit() else "." for c in word))]


class Chains:
    """Words of several texts laid out in chunks, for sums over all labellings."""

    def __init__(self, counts):
        self.counts = counts
        self.chunks = -(-counts // CHUNK)
        self.first = np.cumsum(self.chunks) - self.chunks
        n = int(self.chunks.sum())
        # Place of each word as row of its chunk and chunk.
        inside = ranges(np.zeros(len(counts), np.int64), counts)
        self.at = (inside % CHUNK, np.repeat(self.first, counts) + inside // CHUNK)
        self.full = np.zeros((CHUNK, n), bool)
        self.full[self.at] = True
        order = np.argsort(-self.chunks, kind="stable")
        self.order, self.sorted = order, -self.chunks[order]

    def active(self, step):
        """Texts with more than ``step`` chunks."""
        return self.order[:np.searchsorted(self.sorted, -step, "left")]

    def run(self, odds, step):
        """Marginals of label 1, and the expected number of each pair of labels in a row.

        ``odds`` are log odds of label 1 for each word alone, ``step[i, j]`` the
        weight of label j after label i. Texts start after a clean word.
        """
        n = self.full.shape[1]
        weight = np.zeros((CHUNK, n))
        weight[self.at] = np.exp(np.clip(odds, -30, 30))
        a, b, c, d = step.ravel()
        product = np.zeros((4, n))
        product[0] = product[3] = 1
        for t in range(CHUNK):
            on, x = self.full[t], weight[t]
            p, q, r, s = product
            new = np.stack([p * a + q * c, (p * b + q * d) * x, r * a + s * c, (r * b + s * d) * x])
            product = np.where(on, new / new.sum(axis=0, where=True, initial=1e-300), product)
        into = np.tile([[1.0], [0.0]], n)
        out = np.ones((2, n))
        most = int(self.chunks.max()) if len(self.chunks) else 0
        for s in range(1, most):
            k = self.first[self.active(s)] + s
            v = np.stack([into[0, k - 1] * product[0, k - 1] + into[1, k - 1] * product[2, k - 1],
                          into[0, k - 1] * product[1, k - 1] + into[1, k - 1] * product[3, k - 1]])
            into[:, k] = v / v.sum(axis=0)
        for s in range(most - 1, 0, -1):
            k = self.first[self.active(s)] + s
            v = np.stack([product[0, k] * out[0, k] + product[1, k] * out[1, k],
                          product[2, k] * out[0, k] + product[3, k] * out[1, k]])
            out[:, k - 1] = v / v.sum(axis=0)
        forward = np.empty((CHUNK + 1, 2, n))
        forward[0] = into
        for t in range(CHUNK):
            x, (u, v) = weight[t], forward[t]
            new = np.stack([u * a + v * c, (u * b + v * d) * x])
            forward[t + 1] = np.where(self.full[t], new / (new.sum(axis=0) + 1e-300), forward[t])
        marginal = np.zeros((CHUNK, n))
        pairs = np.zeros((2, 2))
        back = out
        for t in range(CHUNK - 1, -1, -1):
            on, x = self.full[t], weight[t]
            joint = forward[t + 1] * back
            marginal[t] = joint[1] / (joint.sum(axis=0) + 1e-300)
            u, v = forward[t]
            cells = np.stack([u * a * back[0], u * b * x * back[1], v * c * back[0], v * d * x * back[1]])
            pairs += (cells / (cells.sum(axis=0) + 1e-300))[:, on].sum(axis=1).reshape(2, 2)
            new = np.stack([a * back[0] + b * x * back[1], c * back[0] + d * x * back[1]])
            back = np.where(on, new / (new.sum(axis=0) + 1e-300), back)
        return marginal[self.at], pairs


def evidence(names, doc, feature, labels):
    """Numbers of the words and prefixes that account for the toxic documents.

    ``doc`` and ``feature`` are the distinct pairs of a document and one of its features.
    """
    toxic = labels[doc] == 1
    seen = [np.bincount(feature[toxic == bool(k)], minlength=len(names)) for k in (0, 1)]
    least = min(LEAST_DOCS, max(1, int(labels.sum())))
    allowed = CLEAN_SHARE * max(1, len(labels) - int(labels.sum()))
    able = np.array([n[0] in "=^" and len(n) > 3 for n in names]) & (seen[1] >= least) & (seen[0] <= allowed)
    some = np.flatnonzero(toxic & able[feature])
    some = some[np.argsort(feature[some], kind="stable")]
    edges = np.flatnonzero(np.diff(feature[some], prepend=-1))
    holders = {int(f): d for f, d in zip(feature[some][edges], np.split(doc[some], edges[1:]))} if len(some) else {}
    need = np.full(len(labels), COVER)
    chosen = []
    while holders:
        # Shorter prefixes win ties: they account for more that was not seen.
        gain, _, _, best = max((int((need[docs] > 0).sum()), -len(names[f]), names[f], f)
                               for f, docs in holders.items())
        if gain < least:
            break
        chosen.append(best)
        need[holders.pop(best)] -= 1
        holders = {f: docs for f, docs in holders.items() if (need[docs] > 0).any()}
    return chosen


class Tagger:
    """The fitted field: weights of features, weights of pairs of labels, and the document's score."""

    def __init__(self, weights, step, scale):
        self.weights, self.step, self.scale = weights, step, scale
        self.known = {}

    def __reduce__(self):
        return Tagger, (self.weights, self.step, self.scale)

    def odds(self, words):
        """Log odds of distinct words; remembers up to ``REMEMBERED`` of them."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        weights, known = self.weights, self.known
        bias = weights.get("", 0.0)
        made = np.empty(len(words))
        for i, word in enumerate(words):
            value = known.get(word)
            if value is None:
                value = known[word] = bias + sum(weights.get(f, 0.0) for f in features(word.decode().lower()))
            made[i] = value
        return made

    def tag(self, texts):
        """Words of each text of a column, and their marginals one after the other."""
        counts, cells = word_cells(texts)
        odds = self.odds(cells.dictionary.to_pylist())[np.asarray(cells.indices)]
        if not len(odds):
            return counts, odds
        return counts, Chains(counts).run(odds, self.step)[0]

    def score(self, counts, marginals):
        return 1 / (1 + np.exp(-np.clip(summary(counts, marginals) @ self.scale, -30, 30)))


def summary(counts, marginals):
    """What a text's marginals say of it: 1, the largest, and the log of 1 and the sum of those above a tenth."""
    largest, total = np.zeros(len(counts)), np.zeros(len(counts))
    some = counts > 0
    first = (np.cumsum(counts) - counts)[some]
    if len(first):
        largest[some] = np.maximum.reduceat(marginals, first)
        total[some] = np.add.reduceat(np.where(marginals > 0.1, marginals, 0), first)
    return np.stack([np.ones(len(counts)), largest, np.log1p(total)], axis=1)


def fit(texts, labels):
    """Fit a ``Tagger`` to whole texts and their labels, on the driver: the sample is bounded."""
    counts, cells = word_cells(text_column(pa.array(texts, pa.string())))
    words = cells.dictionary.to_pylist()
    codes = np.asarray(cells.indices).astype(np.int64)
    labels = np.array(labels, np.int64)
    if not len(codes) or not 0 < labels.sum() < len(labels):
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        return Tagger({"": -5.0}, np.ones((2, 2)), np.array([np.log(share / (1 - share)), 0, 0]))
    number, flat, sizes = {}, [], np.zeros(len(words), np.int64)
    for i, word in enumerate(words):
        held = features(word.decode().lower())
        sizes[i] = len(held)
        flat += [number.setdefault(f, len(number)) for f in held]
    names, flat = list(number), np.array(flat, np.int64)
    del number
    begin = np.cumsum(sizes) - sizes
    ends = np.cumsum(counts)
    doc = np.repeat(np.arange(len(counts)), counts)
    pair = np.unique(doc * len(words) + codes)
    doc, word = pair // len(words), pair % len(words)
    pair = np.unique(np.repeat(doc, sizes[word]) * len(names) + flat[ranges(begin[word], sizes[word])])
    doc, feature = pair // len(names), pair % len(names)
    chosen = np.zeros(len(names), bool)
    chosen[evidence(names, doc, feature, labels)] = True
    owner = np.repeat(np.arange(len(words)), sizes)
    toxic_word = np.bincount(owner, chosen[flat], len(words)) > 0
    target = toxic_word[codes] & np.repeat(labels == 1, counts)

    # Features of a single sampled text say nothing about others.
    common = np.bincount(feature, minlength=len(names)) > 1
    del pair, doc, word, feature
    index = np.cumsum(common) - 1
    owner, flat = owner[common[flat]], index[flat[common[flat]]]
    names = [n for n, keep in zip(names, common) if keep]
    chains = Chains(counts)
    weight, bias, step = np.zeros(len(names)), -3.0, np.zeros((2, 2))
    before = np.append(False, target[:-1])
    before[(ends - counts)[counts > 0]] = False
    real = np.zeros((2, 2))
    np.add.at(real, (before.astype(int), target.astype(int)), 1)
    squares = [np.full(len(names), 1e-8), 1e-8, np.full((2, 2), 1e-8)]
    for _ in range(STEPS):
        each = bias + np.bincount(owner, weight[flat], len(words))
        marginal, pairs = chains.run(each[codes], np.exp(step))
        rest = np.bincount(codes, target - marginal, len(words))
        slopes = [np.bincount(flat, rest[owner], len(names)) / len(texts) - RIDGE * weight,
                  rest.sum() / len(texts), (real - pairs) / len(texts) - RIDGE * step]
        for i, s in enumerate(slopes):
            squares[i] = squares[i] + s * s
        moves = [RATE * s / np.sqrt(q) for s, q in zip(slopes, squares)]
        weight, bias, step = weight + moves[0], bias + moves[1], step + moves[2]
    weights = {f: float(w) for f, w in zip(names, weight) if w} | {"": float(bias)}
    tagger = Tagger(weights, np.exp(step), np.zeros(3))
    # Scale the summaries to the labels, with a small ridge.
    x, y = summary(counts, chains.run(tagger.odds(words)[codes], tagger.step)[0]), np.array(labels, float)
    scale = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ scale, -30, 30)))
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3)
        scale += np.linalg.solve(bend, x.T @ (y - p) - 0.05 * scale)
    return Tagger(tagger.weights, tagger.step, scale)


def train(docs, labels, id_col="doc_id", text_col="text"):
    """The tagger of a bounded sample of labelled documents; equal texts count once."""
    rows = {(r.text, r.label) for r in sample(docs, labels, "toxic", id_col, text_col).collect()}
    rows = sorted(rows)
    return fit([t for t, _ in rows], [y for _, y in rows])


def _spans(texts, counts, marginals):
    """Byte ranges of runs of toxic words of each text, as character ranges."""
    made = []
    toxic = marginals >= SPAN
    ends = np.cumsum(counts)
    for i in np.flatnonzero(np.add.reduceat(np.append(toxic, False), np.minimum(ends - counts, len(toxic)))
                            * (counts > 0)) if len(counts) else ():
        text = texts[i].as_py()
        on = toxic[ends[i] - counts[i]:ends[i]]
        spots, last = [], False
        for word, flag in zip(re.finditer(r"[^\x20\x09-\x0D]+", text), on):
            if flag and last:
                spots[-1] = (spots[-1][0], word.end())
            elif flag:
                spots.append(word.span())
            last = flag
        made.append((int(i), spots))
    return made


SCORES = "doc_id long, held_out boolean, score double, predicted int, spans array<struct<start: int, end: int>>"


def toxicity_scores(docs, tagger, id_col="doc_id", text_col="text", threshold=0.5):
    """``doc_id, held_out, score, predicted, spans`` of every whole text. No shuffle.

    ``held_out`` is true where crc32 of the id modulo 5 is 0; ``spans`` are the
    character ranges of toxic words in a row. A null or empty text has no words
    and gets the score of that; null ids and repeated rows are carried through;
    other columns are not looked at; an empty table gives an empty table.
    """
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, "text"):
                counts, marginals = tagger.tag(texts)
                score = tagger.score(counts, marginals)
                spots = dict(_spans(texts, counts, marginals))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([x is not None and crc_fold(x) == 0 for x in part.column(0).to_pylist()]),
                    pa.array(score), pa.array((score >= threshold).astype(np.int32)),
                    pa.array([[{"start": a, "end": b} for a, b in spots.get(i, ())] for i in range(len(counts))], kind)],
                    names=["doc_id", "held_out", "score", "predicted", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(trimmed(run), SCORES)


def drop_toxic(docs, tagger, text_col="text", threshold=0.5):
    """The rows of ``docs`` whose score is below the threshold, with all their columns. No shuffle."""
    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, text_col):
                yield part.filter(pa.array(tagger.score(*tagger.tag(texts)) < threshold))

    return docs.mapInArrow(trimmed(run), docs.schema)
