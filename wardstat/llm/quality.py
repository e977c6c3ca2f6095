"""Quality by attention-based multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE`` words, only the bag has a label.
Every passage is encoded by how its words are written, repeated and marked; a
hidden layer and gated attention (tanh times sigmoid) give each passage a weight,
and the weighted sum of the hidden layers is scored. Weights and score are learned
together from document labels.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from wardstat.llm.blocks import crc_fold, ranges, slices, trimmed
from wardstat.llm.labels import sample
from wardstat.llm.words import word_cells

PASSAGE = 64
SHAPES = 48
WORDS = 48
HIDDEN = 24
ATTENTION = 12
EPOCHS = 60
BATCH = 256
RATE = 0.01
RIDGE = 1e-4
SAMPLE_DOCS = 3000
STATISTICS = 13
SIZE = STATISTICS + SHAPES + WORDS
REMEMBERED = 150_000


def shape(word):
    """How a word is written: runs of the same kind of character, punctuation as it is, up to eight of them."""
    made, last = [], ""
    for c in word:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if kind != last:
            made.append(kind)
            last = kind
    return "".join(made[:8])


def bucket(text, buckets):
    value = 2166136261
    for byte in text.encode():
        value = (value ^ byte) * 16777619 & 0xFFFFFFFF
    return value % buckets


def traits(word):
    """Numbers of one word: length, kinds of characters, and the buckets of its shape and its letters."""
    n = len(word)
    alpha = sum(c.isalpha() for c in word)
    upper = sum(c.isupper() for c in word)
    digit = sum(c.isdigit() for c in word)
    marks = n - alpha - digit
    return (n, alpha / n, upper / n, digit / n, marks / n, float(alpha == 0), float(upper == n),
            float(word[:1].isupper()), float(word[-1] in ".!?"), float(marks > 1),
            bucket(shape(word), SHAPES), bucket(word.lower(), WORDS))


REMEMBER = {}


def encode(texts):
    """Number of passages of each text, at least one, and a row of ``SIZE`` numbers for each passage.

    The last numbers of a row are shares of its words in hashed buckets, of
    shapes and of words. A text without words is one passage of zeros.
    """
    counts, cells = word_cells(texts, lower=False)
    codes = np.asarray(cells.indices).astype(np.int64)
    if len(REMEMBER) > REMEMBERED:
        REMEMBER.clear()
    table = np.zeros((len(cells.dictionary), 12))
    for i, word in enumerate(cells.dictionary.to_pylist()):
        made = REMEMBER.get(word)
        if made is None:
            made = REMEMBER[word] = traits(word.decode())
        table[i] = made
    passages = np.maximum(1, -(-counts // PASSAGE))
    total = int(passages.sum())
    first = np.cumsum(passages) - passages
    inside = ranges(np.zeros(len(counts), np.int64), counts)
    owner = np.repeat(first, counts) + inside // PASSAGE
    size = np.bincount(owner, minlength=total)
    share = np.maximum(size, 1)
    rows = np.zeros((total, SIZE))
    for k in range(10):
        rows[:, k] = np.bincount(owner, table[codes, k], total) / share
    # Share of different words, and of words that repeat the one before.
    pair = np.unique(owner * max(1, len(table)) + codes)
    rows[:, 10] = np.bincount(pair // max(1, len(table)), minlength=total) / share
    same = np.append(False, (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])) if len(codes) else codes
    rows[:, 11] = np.bincount(owner, same, total) / share
    rows[:, 12] = np.log1p(size) / 5
    for at, k, buckets in ((STATISTICS, 10, SHAPES), (STATISTICS + SHAPES, 11, WORDS)):
        cell = np.bincount(owner * buckets + table[codes, k].astype(np.int64), minlength=total * buckets)
        rows[:, at:at + buckets] = cell.reshape(total, buckets) / share[:, None]
    return passages, rows


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Attention:
    """The network: hidden layer, gated attention, score of the weighted passage."""

    NAMES = ("hidden", "hidden_0", "gate_t", "gate_s", "weigh", "out", "out_0")

    def __init__(self, mean, scale, seed=7):
        random = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        normal = lambda *shape: random.normal(0, shape[0] ** -0.5, shape)
        self.hidden, self.hidden_0 = normal(SIZE, HIDDEN), np.zeros(HIDDEN)
        self.gate_t, self.gate_s = normal(HIDDEN, ATTENTION), normal(HIDDEN, ATTENTION)
        self.weigh, self.out, self.out_0 = normal(ATTENTION), normal(HIDDEN), np.zeros(1)

    def forward(self, passages, rows):
        first = np.cumsum(passages) - passages
        x = np.clip((rows - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ self.hidden + self.hidden_0)
        t, s = np.tanh(h @ self.gate_t), sigmoid(h @ self.gate_s)
        raw = (t * s) @ self.weigh
        raw = np.exp(raw - np.repeat(np.maximum.reduceat(raw, first), passages))
        weight = raw / np.repeat(np.add.reduceat(raw, first), passages)
        bag = np.add.reduceat(h * weight[:, None], first, axis=0)
        return x, h, t, s, weight, bag, sigmoid(bag @ self.out + self.out_0[0])

    def slopes(self, passages, rows, labels):
        """Slopes of the mean log loss, by the names of the weights."""
        x, h, t, s, weight, bag, score = self.forward(passages, rows)
        n = len(labels)
        error = (score - labels) / n
        bag_error = error[:, None] * self.out
        each = np.repeat(bag_error, passages, axis=0)
        first = np.cumsum(passages) - passages
        gain = (each * h).sum(axis=1)
        raw_error = weight * (gain - np.repeat(np.add.reduceat(weight * gain, first), passages))
        gate = raw_error[:, None] * self.weigh
        t_error, s_error = gate * s * (1 - t * t), gate * t * s * (1 - s)
        h_error = (each * weight[:, None] + t_error @ self.gate_t.T + s_error @ self.gate_s.T) * (1 - h * h)
        return {"hidden": x.T @ h_error, "hidden_0": h_error.sum(axis=0), "gate_t": h.T @ t_error,
                "gate_s": h.T @ s_error, "weigh": (t * s).T @ raw_error, "out": bag.T @ error,
                "out_0": np.array([error.sum()])}

    def fit(self, passages, rows, labels, seed=11):
        """Adam over shuffled batches of whole documents."""
        random = np.random.default_rng(seed)
        first = np.cumsum(passages) - passages
        moments = {k: [np.zeros_like(getattr(self, k)), np.zeros_like(getattr(self, k))] for k in self.NAMES}
        step = 0
        for _ in range(EPOCHS):
            order = random.permutation(len(labels))
            for at in range(0, len(order), BATCH):
                part = order[at:at + BATCH]
                step += 1
                made = self.slopes(passages[part], rows[ranges(first[part], passages[part])], labels[part])
                for k, slope in made.items():
                    slope = slope + RIDGE * getattr(self, k)
                    m = moments[k]
                    m[0] = 0.9 * m[0] + 0.1 * slope
                    m[1] = 0.999 * m[1] + 0.001 * slope * slope
                    move = m[0] / (1 - 0.9 ** step) / (np.sqrt(m[1] / (1 - 0.999 ** step)) + 1e-8)
                    setattr(self, k, getattr(self, k) - RATE * move)
        return self


class Constant:
    """Stands in where the sample does not hold both labels."""

    def __init__(self, share):
        self.share = share

    def forward(self, passages, rows):
        return None, None, None, None, np.ones(len(rows)), None, np.full(len(passages), self.share)


def train(docs, labels, id_col="doc_id", text_col="text", seed=7):
    """The network of a bounded sample of labelled documents, whose passages are encoded by the workers."""
    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, "text"):
                passages, rows = encode(texts)
                cells = np.split(rows.astype("<f4"), np.cumsum(passages)[:-1])
                yield pa.RecordBatch.from_arrays([
                    pa.array([c.tobytes() for c in cells], pa.binary()), part.column(1)], names=["rows", "label"])

    made = (sample(docs, labels, "quality", id_col, text_col, SAMPLE_DOCS)
            .mapInArrow(trimmed(run), "rows binary, label int").collect())
    bags = sorted((bytes(r["rows"]), r["label"]) for r in made)  # the order of the rows must not matter
    y = np.array([label for _, label in bags], float)
    if not 0 < y.sum() < len(y):
        return Constant((y.sum() + 1) / (len(y) + 2))
    cells = [np.frombuffer(data, "<f4").reshape(-1, SIZE).astype(float) for data, _ in bags]
    rows = np.concatenate(cells)
    model = Attention(rows.mean(axis=0), rows.std(axis=0) + 1e-3, seed)
    return model.fit(np.array([len(c) for c in cells]), rows, y)


SCORES = "doc_id long, held_out boolean, score double, predicted int, n_passages int, weightiest int"


def quality_scores(docs, model, id_col="doc_id", text_col="text", threshold=0.3):
    """``doc_id, held_out, score, predicted, n_passages, weightiest`` of every whole text. No shuffle.

    ``held_out`` is true where crc32 of the id modulo 5 is 0; ``weightiest`` is
    the passage with the largest attention weight, from 0. A null or empty text
    is one passage without words; null ids and repeated rows are carried
    through; other columns are not looked at; an empty table gives an empty table.
    """
    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, "text"):
                if not part.num_rows:
                    continue
                passages, rows = encode(texts)
                *_, weight, _, score = model.forward(passages, rows)
                first = np.cumsum(passages) - passages
                top = np.repeat(np.maximum.reduceat(weight, first), passages) == weight
                place = np.where(top, ranges(np.zeros(len(passages), np.int64), passages), len(weight))
                ids = part.column(0)
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array([x is not None and crc_fold(x) == 0 for x in ids.to_pylist()], pa.bool_()),
                    pa.array(score), pa.array((score >= threshold).astype(np.int32)),
                    pa.array(passages.astype(np.int32)),
                    pa.array(np.minimum.reduceat(place, first).astype(np.int32))],
                    names=[x.split()[0] for x in SCORES.split(", ")])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(trimmed(run), SCORES)
