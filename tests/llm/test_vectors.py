"""Operators on embeddings beside brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from odd_cases import SF_DIR
from pyspark.sql import functions as F

from wardstat.llm import hard_negatives, near_vectors, smallworld, whitening
from wardstat.llm.blocks import ship

SCHEMA = "vec_id long, embedding array<float>, label int, x string, node long, shard int, digest string, n long, row long"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="module")
def embeddings(spark):
    return spark.read.parquet(f"{SF_DIR}/embeddings.parquet")


def frame(spark, rows):
    rows = [(i, v and [c if c is None else float(c) for c in v], label) for i, v, label in rows]
    return spark.createDataFrame([(*r, "y", None, 7, "d", None, 3) for r in rows], SCHEMA).repartition(3)


def odd_vectors(n=240, width=6):
    """Groups of near copies, repeated rows, scaled copies, null and short vectors, bad entries, null ids and labels."""
    draw = random.Random(3)
    rows = []
    for i in range(n):
        base = random.Random(i % 40)
        vector = [base.gauss(0, 1) for _ in range(width)]
        if i % 3:
            vector = [c + draw.gauss(0, 0.12) for c in vector]
        rows.append((i, vector, [0, 0, 1, 2][i % 40 % 4]))
    rows += [rows[5], rows[5], (1000, rows[5][1], rows[5][2]), (-50, rows[7][1], 0), (1001, [2 * c for c in rows[9][1]], rows[9][2])]
    rows += [(1002, None, 0), (1003, [], 0), (1004, [0.0] * width, 1), (1005, [1.0, None, 0, 0, 0, 0], 1),
             (1006, [math.nan] * width, 0), (1007, [math.inf] + [1.0] * 5, 0), (1008, rows[11][1], None),
             (None, rows[13][1], rows[13][2]), (None, None, None), (1050, [1.0, 2.0], 0), (1100, [1.0, 2.0, 0, 0, 0, -0.0], 0)]
    return rows


def usable(rows, width=6):
    for i, vector, label in rows:
        if vector is not None and all(c is not None and math.isfinite(c) for c in vector):
            yield i, [float(np.float32(c)) for c in vector] + [0.0] * (width - len(vector)), label


def brute_whitening(rows, k):
    rows = [(i, tuple(math.floor(256 * c) for c in v)) for i, v, _ in rows]
    fit = np.array(sorted({v for _, v in rows}))
    n, sums = len(fit), fit.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True))
    order = np.argsort(values)[::-1][:k]
    for i, v in rows:
        z = (np.array(v) - sums / n) @ vectors[:, order] / np.sqrt(values[order])
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(v, sums))
        for c in range(k):
            yield i, c + 1, n, deviation, z[c], values[order[c]] / values.sum()


def check_whitening(got, expected):
    def key(r):
        return r[1], r[0] is None, r[0] or 0, r[3], abs(round(r[4], 6))

    got, expected = sorted((tuple(r) for r in got), key=key), sorted(expected, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in expected]
    for c in {r[1] for r in got}:
        mine, theirs = ([r[4] for r in x if r[1] == c] for x in (got, expected))
        sign = np.sign(np.dot(mine, theirs))
        assert np.allclose(mine, np.multiply(sign, theirs), rtol=1e-7, atol=1e-7)
    assert np.allclose([r[5] for r in got], [r[5] for r in expected], rtol=1e-9)
    assert len({r[6] for r in got}) == 1 and got[0][6] < 1e-9


def test_whitening(spark, embeddings):
    rows = odd_vectors()
    check_whitening(whitening.whiten(frame(spark, rows), components=3).collect(), list(brute_whitening(list(usable(rows)), 3)))
    plain = [(r.vec_id, r.embedding, r.label) for r in embeddings.collect()]
    check_whitening(whitening.whiten(embeddings).collect(), list(brute_whitening(plain, 4)))


def test_whitening_without_spread(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None, 0), (2, [math.nan], 0)])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 1)])).count() == 0
    flat = whitening.whiten(frame(spark, [(1, [1.0, 2.0, 0], 0), (2, [2.0, 2.0], 1), (3, [5.0, 2.0], 1)])).collect()
    assert sorted((r.vec_id, r.component, r.n) for r in flat) == [(1, 1, 3), (2, 1, 3), (3, 1, 3)]
    assert all(r.explained == pytest.approx(1) for r in flat)


def test_whitening_of_large_entries(spark):
    rows = [(i, [float(c) for c in np.random.default_rng(i).integers(-2 ** 50, 2 ** 50, 3)], 0) for i in range(9)]
    made = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), components=2)
    check_whitening(made.collect(), list(brute_whitening(rows, 2)))
    ends = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [3.0, 5.0])], "vec_id long, embedding array<double>")
    made = {r.vec_id: r.deviation for r in whitening.whiten(ends, components=1).collect()}
    assert made[1] is None and made[2] is None and made[3] < 10 ** 20


@pytest.mark.parametrize("width", [1, 2, 5, 40])
def test_sliced_spectrum(width):
    draw = np.random.default_rng(width)
    turn = np.linalg.qr(draw.standard_normal((width, width)))[0]
    for values in (draw.random(width), np.ones(width), np.repeat([3.0, 1.0], width)[:width] * (np.arange(width) < 4),
                   1 + 1e-9 * np.arange(width), np.maximum(0, 1 - np.arange(width))):
        square = turn @ np.diag(values) @ turn.T
        square = (square + square.T) / 2
        expected = np.sort(values)[::-1]
        for shift in (-0.5, 0.3, 1.5):
            assert whitening.count_above(square, shift) == (values > shift).sum()
        found, vectors = whitening.leading(square, 4)
        assert len(found) == min(4, (values > 1e-9).sum())
        assert np.allclose(found, expected[:len(found)], rtol=1e-11, atol=1e-11)
        assert np.allclose(vectors @ vectors.T, np.eye(len(found)), atol=1e-9)
        assert np.allclose(square @ vectors.T, vectors.T * found, atol=1e-10)
    assert len(whitening.leading(np.zeros((3, 3)))[0]) == 0


def brute_links(rows, least):
    """Links and smallest reachable id of every row, from all pairs."""
    made = [(i, None, None) for i, _, _ in rows]
    width = max((len(v) for _, v, _ in rows if v), default=0)
    some = [k for k, (_, v, label) in enumerate(rows) if label is not None and v and any(v)
            and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([list(rows[k][1]) + [0.0] * (width - len(rows[k][1])) for k in some]).reshape(len(some), width)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    labels = np.array([rows[k][2] for k in some])
    near = (x @ x.T >= least) & (labels[:, None] == labels[None])
    np.fill_diagonal(near, False)
    root = np.arange(len(some))
    for _ in range(len(some)):
        before = root.copy()
        for k in range(len(some)):
            root[k] = min([root[k], *root[near[k]]])
        if (root == before).all():
            break
    made = [(i, 0, i, True) for i, _, _ in rows]
    for k, place in enumerate(some):
        ids = [rows[some[m]][0] for m in np.flatnonzero(root == root[k])]
        least_id = min((i for i in ids if i is not None), default=None)
        made[place] = (rows[place][0], int(near[k].sum()), least_id, rows[place][0] == least_id)
    return made


def same(got, expected):
    def key(row):
        return tuple((x is None, x) for x in row)

    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, expected), key=key)


def as_floats(rows):
    return [(i, v and [c if c is None else float(np.float32(c)) for c in v], label) for i, v, label in rows]


@pytest.mark.parametrize("shard_rows", [16_384, 20])
def test_near_vectors(spark, shard_rows):
    rows = as_floats(odd_vectors())
    same(near_vectors.near_vectors(frame(spark, rows), shard_rows=shard_rows).collect(), brute_links(rows, 0.93))


def test_near_vectors_of_a_hot_group(spark):
    """A third of all rows in one group of near copies, with many equal ones; several shards."""
    draw = np.random.default_rng(4)
    base = draw.standard_normal(16)
    rows = [(i, (base + 0.08 * draw.standard_normal(16)).tolist(), 1) for i in range(500)]
    rows += [(i, rows[i % 7][1], 1) for i in range(500, 700)]
    rows += [(i, draw.standard_normal(16).tolist(), int(draw.integers(0, 3))) for i in range(700, 2000)]
    rows = as_floats(rows)
    made = {r.vec_id: tuple(r) for r in near_vectors.near_vectors(frame(spark, rows), shard_rows=300).collect()}
    expected = {r[0]: r for r in brute_links(rows, 0.93)}
    assert [made[i][2:] for i in made] == [expected[i][2:] for i in made]
    assert sum(m[1] for m in made.values()) >= 0.99 * sum(e[1] for e in expected.values())
    assert all(made[i][1] <= expected[i][1] for i in made)


def test_near_vectors_of_nothing(spark):
    assert near_vectors.near_vectors(frame(spark, [])).count() == 0
    rows = [(1, None, 0), (2, [0.0, 0.0], 0), (None, [1.0], None)]
    same(near_vectors.near_vectors(frame(spark, rows)).collect(), [(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True)])


def test_beams_widen_until_the_audit_passes(monkeypatch):
    """Searches that lose most links with a small beam: the pair of shards is searched again."""
    draw = np.random.default_rng(2)
    shard = near_vectors.Shard.build(draw.standard_normal((600, 4)), np.arange(600), np.ones(600, np.int64))
    beams, plain = [], smallworld.Graph.near

    def forgetful(self, queries, least, beam):
        beams.append(beam)
        row, member = plain(self, queries, least, beam)
        return (row, member) if beam > 100 else (row[::3], member[::3])

    monkeypatch.setattr(smallworld.Graph, "near", forgetful)
    _, counts = near_vectors.linked(shard, shard, 0.93, True)
    assert sorted(set(beams)) == [32, 64, 128]
    exact = (shard.unit @ shard.unit.T >= 0.93).sum() - 600
    assert exact >= counts[0][1].sum() >= 0.98 * exact


def test_work_of_shards_grows_with_their_rows(monkeypatch):
    """Classes meet the members of cells that are near, not all of the other shard; found links are as good as all."""
    draw = np.random.default_rng(8)
    base = near_vectors.units(draw.standard_normal((9000, 64)))
    copies = base[:3000] + draw.uniform(0.05, 0.4, (3000, 1)) * draw.standard_normal((3000, 64)) / 8
    vectors = np.concatenate([base, copies]).astype(np.float32)
    rows = draw.integers(1, 4, len(vectors))
    plan = near_vectors.Plan.build(vectors, np.arange(len(vectors)), len(vectors), 6500)
    cell, shard = plan.dealt(vectors, np.arange(len(vectors)))
    shards = []
    for number in range(shard.max() + 1):
        mine = np.flatnonzero(shard == number)
        some, at = np.unique(cell[mine], return_inverse=True)
        shards.append(near_vectors.Shard.build(vectors[mine], mine, rows[mine], plan.graph.points[some], at))
    met, plain = [], near_vectors.Shard.linked_to
    monkeypatch.setattr(near_vectors.Found, "_block", lambda self, one, some, other, members, *more, block=near_vectors.Found._block: (
        met.append(len(some) * (members.stop - members.start)), block(self, one, some, other, members, *more)))
    links, edges = np.zeros(len(vectors), np.int64), []
    for i, one in enumerate(shards):
        for other in shards[i:]:
            some, counts = near_vectors.linked(one, other, 0.93, one is other)
            edges.append(some)
            for node, n in counts:
                links[node] += n
    unit = near_vectors.units(vectors.astype(np.float64))
    true = unit @ unit.T >= 0.93
    np.fill_diagonal(true, False)
    assert len(shards) > 1 and plain is near_vectors.Shard.linked_to and sum(met) < 0.1 * len(vectors) ** 2
    assert (links <= true @ rows).all() and links.sum() >= 0.999 * (true @ rows).sum()
    assert all(true[a, b] or links[a] for a, b in np.concatenate(edges))


def test_the_widest_beam_misses_nothing(monkeypatch):
    """Few dimensions, where a first beam loses many links."""
    draw = np.random.default_rng(3)
    vectors = draw.standard_normal((3000, 6)).astype(np.float32)
    shard = near_vectors.Shard.build(vectors, np.arange(3000), np.ones(3000, np.int64))
    monkeypatch.setattr(near_vectors, "BEAM", near_vectors.WHOLE)
    _, counts = near_vectors.linked(shard, shard, 0.93, True)
    unit = near_vectors.units(vectors.astype(np.float64))
    expected = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    assert (counts[0][1] == expected[counts[0][0]]).all()


def test_walked_centres(spark, monkeypatch):
    """Centres with a graph that is walked; a hot cell is dealt over several shards."""
    monkeypatch.setattr(near_vectors, "WALKED", 50)
    draw = np.random.default_rng(6)
    vectors = near_vectors.units(draw.standard_normal((2000, 16))).astype(np.float32)
    plan = near_vectors.Plan.build(vectors, np.arange(2000), 2000, 5)
    assert plan.graph.layers and (plan.parts > 1).any()
    cell, shard = plan.dealt(vectors, np.arange(2000))
    best = np.argmax(vectors @ plan.graph.points.T, axis=1)
    assert np.mean(cell == best) > 0.95
    assert (shard >= plan.first[cell]).all() and (shard < plan.first[cell] + plan.parts[cell]).all()
    again = near_vectors.Plans({"x": plan.written(f"{spark.conf.get('spark.checkpoint.dir')}/plans")}).of("x")
    assert (again.dealt(vectors, np.arange(2000))[1] == shard).all()


@pytest.mark.parametrize("width", [2, 30])
def test_graph_finds_the_nearest(width):
    draw = np.random.default_rng(width)
    unit = near_vectors.units(draw.standard_normal((3000, width)))
    graph, order = smallworld.Graph.build(unit)
    assert sorted(order) == list(range(3000))
    queries = near_vectors.units(draw.standard_normal((200, width))).astype(np.float32)
    ids, scores = graph._search(queries, graph._entries(queries, 3000), graph.layers[-1], 3000, 64)
    best = np.argsort(-(queries @ graph.points.T), axis=1)[:, :10]
    assert np.mean([len(set(a[:10]) & set(b)) for a, b in zip(ids, best)]) > 9.5
    again, held = smallworld.Graph.loaded(graph.dumped(extra=np.arange(3)))
    assert all((a == b).all() for a, b in zip(again.layers, graph.layers)) and list(held["extra"]) == [0, 1, 2]


def brute_negatives(rows, every, positives=5, negatives=3):
    """Every score of every anchor."""
    rows = [(i, [math.floor(256 * c) for c in v], label) for i, v, label in rows if label is not None]
    for k, (i, x, label) in enumerate(rows):
        if i is None or i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), j is None, j or 0, m) for m, (j, y, _) in enumerate(rows) if m != k)
        mine = [(m, -s) for s, _, _, m in scored if rows[m][2] == label][:positives]
        for p, ps in mine:
            fit = [(m, -s) for s, _, _, m in scored if rows[m][2] != label and 50 * ps <= -100 * s <= 95 * ps]
            for rank, (m, ns) in enumerate(fit[:negatives], 1):
                yield i, rows[p][0], rank, rows[m][0], ps, ns


def test_hard_negatives(spark, embeddings):
    rows = as_floats(odd_vectors())
    got = hard_negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0, shard_rows=50, block_rows=6)
    expected = list(brute_negatives(list(usable(rows)), 10))
    assert len(expected) > 100
    same(got.collect(), expected)
    plain = [(r.vec_id, [float(c) for c in r.embedding], r.label) for r in embeddings.collect()]
    same(hard_negatives.hard_negatives(embeddings, F.col("vec_id") % 50 == 0).collect(), list(brute_negatives(plain, 50)))


def test_hard_negatives_of_few_and_large(spark):
    plain = "vec_id long, embedding array<double>, label int"
    none = [[], [(1, [1.0], 0)], [(0, [1.0], 0)], [(0, None, 0)], [(0, [0.0, 0.0], 0), (1, [0.0], 0), (2, [], 1)]]
    for rows in none:
        made = hard_negatives.hard_negatives(spark.createDataFrame(rows, plain), F.col("vec_id") % 50 == 0)
        same(made.collect(), list(brute_negatives(list(usable(rows, 2)), 50)))
    draw = np.random.default_rng(6)
    rows = [(i, (draw.standard_normal(5) * 3e5).tolist(), i % 3) for i in range(60)]  # products beyond a double's digits
    made = hard_negatives.hard_negatives(spark.createDataFrame(rows, plain), F.col("vec_id") % 5 == 0)
    same(made.collect(), list(brute_negatives(rows, 5)))


@pytest.mark.parametrize("part", [-1.0, 0.0, 0.3, 0.7, 2.0])
def test_index_loses_no_pair(part):
    draw = np.random.default_rng(int(10 * part) % 7)
    x, q = (draw.integers(-90, 90, (n, 33)).astype(float) for n in (400, 30))
    x[:40] *= draw.random((40, 1)) < 0.5
    x[40:60] = q[draw.integers(0, 30, 20)]
    norm = np.linalg.norm(q, axis=1)
    least = np.ceil(part * norm * np.linalg.norm(x, axis=1).max()).astype(np.int64)
    reach = float((least / norm).min()) * (1 - 1e-9)
    query, at, score = hard_negatives.Index(x, hard_negatives._prefix_norms(x), reach).above(q, least)
    expected = q @ x.T
    assert sorted(zip(query, at)) == sorted(zip(*np.nonzero(expected >= least[:, None])))
    assert (score == expected[query, at]).all()
