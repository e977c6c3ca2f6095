"""Classifiers by held-out accuracy, the n-gram model beside brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from odd_cases import odd_rows

from wardstat.llm import ngrams, quality, queries, toxicity
from wardstat.llm.blocks import ship
from wardstat.llm.words import word_cells


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


@pytest.mark.parametrize("name, label, least, area", [("op8_toxicity", "toxic", 0.95, 0.95), ("op4_quality", "quality", 0.95, 0.98)])
def test_held_out_accuracy(spark, name, label, least, area):
    sf_dir = "/root/testdata/sf0.01"
    rows = queries.QUERIES[name](spark, sf_dir)
    known = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = rows.collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.held_out == (fold(r.doc_id) == 0) for r in got)
    threshold = 0.5 if label == "toxic" else 0.3
    assert all(r.predicted == (r.score >= threshold) for r in got)
    judged = [(r.predicted, known[r.doc_id]) for r in got if r.held_out and r.doc_id in known]
    assert sum(p == y for p, y in judged) >= least * len(judged)
    scores = [[r.score for r in got if r.held_out and known.get(r.doc_id) == y] for y in (0, 1)]
    ranked = [(high > low) + (high == low) / 2 for low in scores[0] for high in scores[1]]
    assert sum(ranked) >= area * len(ranked)
    again = {r.doc_id: r.score for r in queries.QUERIES[name](spark, sf_dir).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in got)


def labelled(spark, documents):
    rows = [(r.doc_id, *([0, 1] if r.doc_id % 2 else [1, 0])) for r in documents.collect()]
    return spark.createDataFrame([*rows, (None, 1, 1), (3, None, None), (3, 1, 1)], "doc_id long, quality int, toxic int")


def test_scores_of_odd_rows(spark, odd, nothing, documents):
    some = labelled(spark, documents)
    for labels in (some, some.limit(0), some.where("toxic = 1 and quality = 1")):
        tagger, model = toxicity.train(documents, labels), quality.train(documents, labels)
        for made in (toxicity.toxicity_scores(odd, tagger), quality.quality_scores(odd, model)):
            rows = made.collect()
            assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
            of = defaultdict(set)
            for r in rows:
                of[r.doc_id].add((r.score, r.held_out))
            assert all(len(x) == 1 for i, x in of.items() if i == 7)
        assert toxicity.toxicity_scores(nothing, tagger).count() == 0
        assert quality.quality_scores(nothing, model).count() == 0
        kept = toxicity.drop_toxic(odd, tagger)
        assert kept.columns == odd.columns
        assert kept.count() == toxicity.toxicity_scores(odd, tagger).where("predicted = 0").count()


def test_chains_sum_over_all_labellings():
    draw = np.random.default_rng(1)
    counts = np.array([0, 1, 3, 7, 0, 9])
    odds, step = draw.normal(0, 2, counts.sum()), np.exp(draw.normal(0, 1, (2, 2)))
    marginal, pairs = toxicity.Chains(counts).run(odds, step)
    expected, total, at = [], np.zeros((2, 2)), 0
    for n in counts:
        weights = defaultdict(float)
        for code in range(2 ** n):
            labels = [code >> k & 1 for k in range(n)]
            weight, last = 1.0, 0
            for k, label in enumerate(labels):
                weight *= step[last, label] * math.exp(odds[at + k] * label)
                last = label
            weights[tuple(labels)] += weight
        z = sum(weights.values())
        expected += [sum(w for x, w in weights.items() if x[k]) / z for k in range(n)]
        for x, w in weights.items():
            for a, b in zip((0, *x[:-1]), x):
                total[a, b] += w / z
        at += n
    assert np.allclose(marginal, expected) and np.allclose(pairs, total)


def test_long_chains_are_those_of_short_ones():
    draw = np.random.default_rng(2)
    odds, step = draw.normal(0, 2, 1000), np.exp(draw.normal(0, 1, (2, 2)))
    whole = toxicity.Chains(np.array([1000])).run(odds, step)[0]
    forward, backward = np.zeros((1000, 2)), np.ones((1000, 2))
    last = np.array([1.0, 0.0])
    for t in range(1000):
        last = last @ step * np.array([1, math.exp(odds[t])])
        forward[t] = last = last / last.sum()
    for t in range(998, -1, -1):
        backward[t] = step @ (np.array([1, math.exp(odds[t + 1])]) * backward[t + 1])
        backward[t] /= backward[t].sum()
    both = forward * backward
    assert np.allclose(whole, both[:, 1] / both.sum(axis=1))


def test_spans_are_the_toxic_words():
    draw = random.Random(8)
    words = [f"{a}{b}" for a in ("stone", "river", "cloud", "lamp", "ein", "grau") for b in ("", "s", "er", "ing", "ly")]
    clean = [" ".join(draw.choices(words, k=30)) for _ in range(200)]
    toxic = []
    for _ in range(150):
        text = draw.choices(words, k=30)
        for _ in range(3):
            text.insert(draw.randrange(30), f"vile{draw.randint(1, 9)}")
        toxic.append(" ".join(text))
    tagger = toxicity.fit(clean + toxic, [0] * 200 + [1] * 150)
    column = pa.array(["ein vile7 Lamp  vile2 vile33 !", "ein Lamp er river !"], pa.large_string())
    counts, marginals = tagger.tag(column)
    (place, spots), = toxicity._spans(column, counts, marginals)
    assert place == 0 and [column[0].as_py()[a:b] for a, b in spots] == ["vile7", "vile2 vile33"]
    score = tagger.score(counts, marginals)
    assert score[0] > 0.5 > score[1]


def test_attention_slopes():
    draw = np.random.default_rng(3)
    passages = np.array([1, 3, 2])
    rows, labels = draw.normal(0, 1, (6, quality.SIZE)), np.array([1.0, 0.0, 1.0])
    net = quality.Attention(np.zeros(quality.SIZE), np.ones(quality.SIZE))

    def loss():
        score = net.forward(passages, rows)[-1]
        return -(labels * np.log(score) + (1 - labels) * np.log(1 - score)).mean()
    for name, slope in net.slopes(passages, rows, labels).items():
        value = getattr(net, name)
        for spot in [tuple(draw.integers(0, n) for n in value.shape) for _ in range(4)]:
            before = value[spot]
            value[spot] = before + 1e-6
            up = loss()
            value[spot] = before - 1e-6
            down = loss()
            value[spot] = before
            assert abs((up - down) / 2e-6 - slope[spot]) < 1e-5


def test_passages_cover_whole_texts():
    texts = pa.array(["", "w " * 130, "a b c", "x " * 64], pa.large_string())
    passages, rows = quality.encode(texts)
    assert passages.tolist() == [1, 3, 1, 1] and rows.shape == (6, quality.SIZE)
    assert not rows[0].any()
    net = quality.Attention(rows.mean(axis=0), rows.std(axis=0) + 1)
    weight = net.forward(passages, rows)[4]
    assert np.allclose(np.add.reduceat(weight, [0, 1, 4, 5]), 1)


def brute(rows, order=2):
    """Scores by the recursion, from counters of tuples; and the sum of all chances after some contexts."""
    def words(text):
        return re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower()) + [b" "]

    def grams(text, k):
        held = [b"\n"] * (order - 1) + words(text)
        return [tuple(held[i - k + 1:i + 1]) for i in range(order - 1, len(held))]

    learned = [text for i, text in rows if i is None or fold(i) != 1]
    single = Counter(w for t in learned for w in words(t))
    n, v = sum(single.values()), len(single)
    count = {order: Counter(g for t in learned for g in grams(t, order))}
    for k in range(order - 1, 0, -1):
        count[k] = Counter(g[1:] for g in count[k + 1])
    cut, total, mass = {}, {}, {}
    for k in count:
        kinds = Counter(count[k].values())
        cut[k] = ngrams.discounts([kinds[i] for i in (1, 2, 3, 4)])
        total[k], mass[k] = Counter(), defaultdict(float)
        for g, c in count[k].items():
            total[k][g[:-1]] += c
            mass[k][g[:-1]] += cut[k][min(c, 3) - 1]

    def chance(g):
        k = len(g)
        if not k:
            return 1 / (v + 1)
        all_of = total[k][g[:-1]]
        if not all_of:
            return chance(g[1:])
        c = count[k][g]
        return (max(c - cut[k][min(c, 3) - 1], 0) / all_of if c else 0) + mass[k][g[:-1]] / all_of * chance(g[1:])

    for i, text in rows:
        w = words(text)
        yield (i, i is not None and fold(i) == 1, len(w), sum(x in single for x in w), n,
               sum(math.log10((single.get(x, 0) + 0.5) / (n + 0.5 * (v + 1))) for x in w),
               sum(math.log10(chance(g)) for g in grams(text, order)))
    if single:
        for context in list(count[order])[:3] + [(b"\n",) * order, (b"never seen",) * order]:
            unknown = chance((*context[1:], b"never seen"))
            assert abs(sum(chance((*context[1:], w)) for w in single) + unknown - 1) < 1e-9


@pytest.mark.parametrize("order", [2, 3, 4])
def test_scores_of_texts(spark, odd, documents, nothing, order):
    for frame in (odd, documents, odd.where("doc_id = 7")) if order < 4 else (odd,):
        rows = [(r.doc_id, r.text or "") for r in frame.collect()]
        key = lambda r: (r[0] is None, r[0], r[2], r[5])
        got = sorted(ngrams.perplexity_scores(frame, order=order).collect(), key=key)
        expected = sorted(brute(rows, order), key=key)
        assert [tuple(r)[:5] for r in got] == [r[:5] for r in expected]
        assert np.allclose([r[5:] for r in got], [r[5:] for r in expected], rtol=0, atol=1e-6)
    assert ngrams.perplexity_scores(nothing, order=order).count() == 0


@pytest.mark.parametrize("order", [2, 3])
def test_frequent_ngrams_and_several_files(spark, monkeypatch, order):
    """Counts that do not fit a byte, more than one file, and no training text at all."""
    monkeypatch.setattr(ngrams, "FILE_TOKENS", 100)
    texts = ["aa bb " * 700, "aa cc " * 300 + "bb dd", *(f"w{i} w{i * 7 % 50} aa" for i in range(200))]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got, expected = sorted(map(tuple, ngrams.perplexity_scores(frame, order=order).collect())), sorted(brute(rows, order))
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in expected], rtol=0, atol=1e-6)
    held = [(i, t) for i, t in odd_rows() if i is not None and fold(i) == 1][:3]
    only = spark.createDataFrame(held, "doc_id long, text string")
    assert {r.score for r in ngrams.perplexity_scores(only, order=order).collect()} == {0.0}


def test_keys_in_halves(tmp_path):
    """Keys whose upper halves differ, over several files."""
    draw = np.random.default_rng(4)
    keys = np.unique(np.concatenate([draw.integers(0, 1 << 62, 500), (7 << 32) + draw.integers(0, 1 << 32, 500), np.arange(50)]))
    files = []
    for part in np.array_split(keys, 3):
        lower, extra = ngrams.halves(part)
        path = ngrams.write_arrays(tmp_path.as_uri(), [lower, (part % 200).astype("u1")], extra.astype("<i8").tobytes())
        files.append((path, len(part), int(part[0]), 8 * len(extra)))
    table = ngrams.Keys(files, ("<u4", "u1"))
    assert (table.keys_at(np.arange(len(keys))[::-1]) == keys[::-1]).all()
    asked = np.unique(np.concatenate([[-1], keys[::2], keys + 1, keys ^ (1 << 33)]))
    place, (value,) = table.find(asked, (1,))
    known = {int(k): i for i, k in enumerate(keys)}
    assert place.tolist() == [known.get(int(k), -1) for k in asked]
    assert value.tolist() == [k % 200 if int(k) in known else 0 for k in asked.tolist()]


def test_lookups_do_not_go_through_upper_halves_one_by_one(tmp_path, monkeypatch):
    """The larger the model, the fewer of a block's keys share an upper half."""
    keys = np.arange(4000) << 32 | 5
    lower, extra = ngrams.halves(keys)
    path = ngrams.write_arrays(tmp_path.as_uri(), [lower, np.ones(len(keys), "u1")], extra.astype("<i8").tobytes())
    table = ngrams.Keys([(path, len(keys), int(keys[0]), 8 * len(extra))], ("<u4", "u1"))
    searches, search = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda *x, **more: searches.append(1) or search(*x, **more))
    place, (value,) = table.find(np.sort(np.concatenate([keys, keys + 1])), (1,))
    assert len(searches) < 10
    assert place.tolist() == [x for i in range(len(keys)) for x in (i, -1)] and value.sum() == len(keys)


def test_places_by_file_and_in_any_order(tmp_path):
    files = [(ngrams.write_arrays(tmp_path.as_uri(), [np.arange(a, b)]), b - a, a, 0) for a, b in ((0, 3), (3, 4), (4, 50))]
    table = ngrams.SortedTable(files, ("<i8",))
    places = np.random.default_rng(6).integers(0, 50, 200)
    assert (table.at(places) == places).all() and len(table.at(places[:0])) == 0
    assert [(int(i), some.tolist()) for i, some in table.by_file(np.array([49, 3, 4]))] == [(1, [1]), (2, [0, 2])]


@pytest.mark.parametrize("most", [0, 5, 1 << 40, 1 << 62])
def test_grouped_numbers(most):
    """Numbers that fit in 64 bits beside their places, and larger ones."""
    draw = np.random.default_rng(5)
    for n in (0, 1, 300):
        keys = draw.choice(np.append(draw.integers(-1, most + 1, 100), -1), n)
        distinct, inverse = ngrams.grouped(keys)
        assert (distinct == np.unique(keys)).all() and (distinct[inverse] == keys).all()


@pytest.mark.parametrize("lower", [True, False])
def test_words_of_texts_side_by_side(lower):
    texts = ["", "Ab", "cD e", "", "\t", " x\x0b\x0cY ", "é\x85Z\x1f\x08 \r\n[@`{", "A"]
    counts, cells = word_cells(pa.array(texts, pa.large_string()).slice(1), lower)
    expected = [re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower() if lower else t.encode()) for t in texts[1:]]
    assert counts.tolist() == [len(x) for x in expected]
    assert cells.dictionary_decode().to_pylist() == sum(expected, [])
