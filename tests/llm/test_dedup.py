"""Exact and near deduplication, repeats and leaks beside brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from odd_cases import LINE, SF_DIR, odd_rows
from pyspark.sql import functions as F

from wardstat.llm import decontaminate, exact_dedup, simhash, suffixes
from wardstat.llm.blocks import saved, ship
from wardstat.llm.graph import connected_components
from wardstat.llm.queries import ORACLE


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def key(row):
    return tuple((x is None, x) for x in row)


def same(got, expected):
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, expected), key=key)


def pairs(frame):
    return [(r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect()]


def groups(rows):
    members = defaultdict(list)
    for i, text in rows:
        members[text].append(i)
    for i, text in rows:
        known = [x for x in members[text] if x is not None]
        keep = max(known) if known else None
        yield i, keep, len(members[text]), i == keep, hashlib.sha256(text.encode()).hexdigest()


def test_exact_groups(odd, documents, nothing):
    for frame in (odd, documents):
        same(exact_dedup.exact_groups(frame).collect(), groups(pairs(frame)))
    assert exact_dedup.exact_groups(nothing).count() == 0


def test_chunks_are_the_text(spark, odd):
    joined = odd.select("text", F.array_join(exact_dedup.chunks(F.col("text")), "").alias("again"))
    assert joined.where("text is not null and text != again").count() == 0
    cut = odd.where("length(text) > 15000").select(F.explode(exact_dedup.chunks(F.col("text"))).alias("c"))
    assert cut.where(f"length(c) > {exact_dedup.MAX_CHARS}").count() == 0 and cut.count() > 5


def test_rows_in_doubt_are_told_apart_by_their_digest(spark, monkeypatch, odd):
    """Take every identifier for a shared one: the result must be the same."""
    monkeypatch.setattr(exact_dedup, "shared_identifiers", lambda listed: listed.select(
        F.explode("parts.identifier").alias("identifier")).distinct())
    same(exact_dedup.exact_groups(odd).collect(), groups(pairs(odd)))


def test_exact_copies_drop_with_all_columns(odd):
    left = exact_dedup.drop_exact_copies(odd)
    assert left.columns == odd.columns
    kept = {i for i, keep, *_ in groups(pairs(odd)) if i == keep and i is not None}
    assert {r.doc_id for r in left.collect() if r.doc_id is not None} == kept
    assert left.where("doc_id is null").count() == 3


def fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows):
    prints = [(i, fingerprint(t)) for i, t in rows]
    distinct = sorted({f for _, f in prints})
    parent = {f: f for f in distinct}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    least = {}
    for i, f in prints:
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    return [(i, f"{f:016x}", least.get(root(f))) for i, f in prints]


def test_near_groups(odd, documents, nothing):
    for frame in (odd, documents):
        expected = components(pairs(frame))
        same(simhash.near_groups(frame).collect(), expected)
    assert len({c for _, _, c in components(odd_rows_as_text())}) < len({f for _, f, _ in components(odd_rows_as_text())})
    assert simhash.near_groups(nothing).count() == 0


def odd_rows_as_text():
    return [(i, t or "") for i, t in odd_rows()]


def test_spark_hashes_shingles_alike(spark):
    assert spark.sql("SELECT xxhash64('a b c')").first()[0] % 2 ** 64 == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_trees_find_every_link(radius):
    draw = np.random.default_rng(radius)
    members = np.unique(draw.integers(0, 2 ** 63, 30).astype(np.uint64)[draw.integers(0, 30, 600)]
                        ^ (np.uint64(1) << draw.integers(0, 64, 600).astype(np.uint64))
                        ^ (np.uint64(1) << draw.integers(0, 64, 600).astype(np.uint64)))
    shard = np.sort(draw.integers(0, 7, len(members)))
    forest = simhash.Forest(members, shard)
    a, b = forest.near(np.arange(len(members)), radius)
    expected = {(i, j) for i in range(len(members)) for j in range(i + 1, len(members))
                if shard[i] == shard[j] and int(members[i] ^ members[j]).bit_count() <= radius}
    assert set(zip(a.tolist(), b.tolist())) == expected and len(a) == len(expected)


def test_bands_leave_no_pair_out():
    masks = list(simhash.band_masks())
    assert all(64 - m.bit_count() <= 22 for m in masks)
    for i in range(64):
        for j in range(i, 64):
            change = (1 << i) | (1 << j)
            assert any(not m & change for m in masks)


def test_near_links_across_batches(spark, monkeypatch):
    """One dense cluster in one shard, and single fingerprints around it."""
    cluster = [(1 << 40) | (1 << b) | (1 << c) for b in range(20) for c in range(b, 20)]
    frame = spark.createDataFrame([(x,) for x in cluster + [1 << 62, 3 << 61]], "fp long").distinct()
    roots = {r.node: r.root for r in connected_components(simhash.near_links(frame)).collect()}
    assert len(set(roots.values())) == 2


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(150)] + [(1000, i) for i in range(1001, 1300)] + [(5, 5), (None, 7), (2000, 2001)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(4)
    roots = {r.node: r.root for r in connected_components(frame).collect()}
    assert roots == {**{i: 0 for i in range(1, 151)}, **{i: 1000 for i in range(1001, 1300)}, 2001: 2000}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def without_repeats(rows):
    first = {}
    order = {i: (2 ** 63 - 1 if i is None else i) for i, _ in rows}
    for i, text in rows:
        data = text.encode()
        for p in range(len(data) - 49):
            first[data[p:p + 50]] = min(order[i], first.get(data[p:p + 50], 2 ** 63))
    for i, text in rows:
        data = np.frombuffer(text.encode(), np.uint8)
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 49):
            if first[data[p:p + 50].tobytes()] < order[i]:
                gone[p:p + 50] = True
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum()) if len(data) else 0
        yield i, len(data), int(gone.sum()), spans, hashlib.sha256(data[~gone].tobytes()).hexdigest(), data[~gone].tobytes()


def test_repeats(odd, documents, nothing):
    for frame in (odd, documents):
        same([(*r[:5], bytes(r[5])) for r in suffixes.remove_repeats(frame).collect()], without_repeats(pairs(frame)))
    assert suffixes.remove_repeats(nothing).count() == 0


def test_repeats_of_a_hot_line(spark):
    """More neighbours of one anchor than a block sends, over several blocks, with one letter changed in some."""
    draw = random.Random(1)
    letters = "abcdefghijklmnop "
    rows = []
    for i in range(700):
        line = LINE if i % 5 else LINE.replace("many", "MANY")
        rows.append((i, "".join(draw.choices(letters, k=draw.randint(0, 70))) + line + "".join(draw.choices(letters, k=60))))
    draw.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    same([(*r[:5], bytes(r[5])) for r in suffixes.remove_repeats(frame).collect()], without_repeats(rows))


def test_suffix_sort():
    draw = random.Random(2)
    for letters, limit in (("ab", 50), ("abc", 7)):
        data = np.frombuffer("".join(draw.choices(letters, k=900)).encode() + b"ab" * 100, np.uint8)
        starts = np.array(sorted(draw.sample(range(len(data) - 50), 400)))
        group = np.sort(np.array([draw.randint(0, 9) for _ in starts]))
        order, classes = suffixes.SuffixSort(data, limit).classes(starts, group)
        cut = [(group[i], data[starts[i]:starts[i] + limit].tobytes()) for i in range(len(starts))]
        assert [cut[i] for i in order] == sorted(cut)
        assert len(set(classes)) == len(set(cut))
        assert all((cut[order[i]] == cut[order[i - 1]]) == (classes[i] == classes[i - 1]) for i in range(1, len(order)))


def test_equal_windows_have_equal_units():
    """What the passes rely on: the anchor of a window follows from its bytes alone."""
    draw = random.Random(3)
    text = "".join(draw.choices("abcd ", k=400)).encode()
    made = []
    for before in (b"", b"zz some other text before it, long enough to matter in any case "):
        data = before + text
        units = suffixes.Units(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        spots = {}
        for first, last, anchor, h in zip(units.first, units.last, units.anchor, units.h):
            for p in range(first, last + 1):
                spots[p - len(before)] = (anchor - p, h)
        made.append(spots)
    assert all(made[0][p] == made[1][p] for p in made[0])


def test_suffixes_are_compared_once(monkeypatch):
    """Of two suffixes that meet in a merge one is compared, not each with the other."""
    draw = random.Random(4)
    data = np.frombuffer("".join(draw.choices("ab", k=2100)).encode(), np.uint8)
    compared = []
    before = suffixes.SuffixSort.before
    monkeypatch.setattr(suffixes.SuffixSort, "before", lambda self, a, b, ties: compared.append(len(a)) or before(self, a, b, ties))
    starts, group = np.arange(2000), np.arange(2000) // 2
    order = suffixes.SuffixSort(data).sort(starts, group)
    assert [data[i:i + 50].tobytes() for i in order] == [
        x for i in range(0, 2000, 2) for x in sorted(data[j:j + 50].tobytes() for j in (i, i + 1))]
    assert sum(compared) == 1000


def test_texts_are_hashed_in_small_blocks(monkeypatch):
    """Three megabytes in texts of 1000 letters: no pass hashes much more at once than a core's cache holds."""
    draw = random.Random(5)
    batch = pa.RecordBatch.from_pydict({
        "doc_id": pa.array(range(3000), pa.int64()),
        "text": ["".join(draw.choices("abcdefgh ", k=1000)) for _ in range(3000)]})
    sizes = []
    start = suffixes.PrefixHashes.__init__
    monkeypatch.setattr(suffixes.PrefixHashes, "__init__", lambda self, data: sizes.append(len(data)) or start(self, data))
    (rows,) = suffixes._units_rows([batch])
    assert max(sizes) <= 1 << 18 and sum(sizes) == 3_000_000
    assert rows.num_rows > 3000


def test_units_that_are_sent():
    """Equal units of a block go once, plain, and once for each later document, covered; ids may be null or repeat."""
    draw = random.Random(6)
    lines = ["".join(draw.choices("abcdefgh ", k=80)) for _ in range(12)]
    ids = [draw.choice([None, *range(9)]) for _ in range(60)]
    texts = ["".join(draw.choices(lines, k=draw.randint(0, 4))) for _ in ids]
    (rows,) = suffixes._units_rows([pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "text": texts})])
    seen = {}
    for i, text in zip(ids, texts):
        units = suffixes.Units(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
        for unit in zip(units.h.tolist(), units.g.tolist()):
            seen.setdefault(unit, set()).add(suffixes.LAST if i is None else i)
    sent = {}
    for h, g, doc in zip(*(c.to_numpy().view(np.uint64).tolist() for c in rows.columns)):
        sent.setdefault((h, g & ~3), []).append((g & 3, doc))
    assert set(sent) == set(seen)
    for unit, docs in seen.items():
        first, *others = sorted(docs)
        assert sorted(doc for flag, doc in sent[unit] if flag == 2) == others
        assert [doc for flag, doc in sent[unit] if flag != 2] == [first]


def test_runs_of_ranges():
    draw = random.Random(7)
    offsets = np.array([0, 0, 40, 40, 90, 120])
    for _ in range(50):
        spans = [(a, draw.randint(a + 1, high)) for low, high in ((0, 40), (40, 90), (90, 120))
                 for a in draw.choices(range(low, high), k=draw.randint(0, 4))]
        draw.shuffle(spans)
        begin, end = (np.array([x[k] for x in spans], np.int64) for k in (0, 1))
        whole = {(t, p) for a, b in spans for p in range(a, b) for t in [int(np.searchsorted(offsets, a, "right")) - 1]}
        made = list(zip(*(x.tolist() for x in suffixes._merged(begin, end, offsets))))
        assert {(t, p) for a, b, t in made for p in range(a, b)} == whole
        assert sum(b - a for a, b, _ in made) == len(whole)
        assert len(made) == sum((t, p - 1) not in whole for t, p in whole)


def tokens(text):
    return re.findall(r"[^\W_]+", text.lower())


def leaks(docs, items):
    for i, text in docs:
        held = tokens(text)
        for j, item in items:
            part = tokens(item)
            if len(part) < 8:
                continue
            span = min(13, len(part))
            need = span if span < 13 else 11
            best = 0
            for shift in range(-len(part) + 1, len(held)):
                equal = [0 <= p + shift < len(held) and held[p + shift] == w for p, w in enumerate(part)]
                best = max([best, *(sum(equal[s:s + span]) for s in range(len(part) - span + 1))])
            if best >= need:
                yield i, j, span, best


def test_leaks(spark, nothing):
    draw = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    items = [(k, " ".join(draw.choices(words, k=n))) for k, n in enumerate((5, 8, 10, 12, 13, 14, 20, 30))]
    items += [(99, None), (None, "x y"), (98, "")]
    docs = []
    for i in range(60):
        _, item = items[i % 8]
        part = item.split()
        for _ in range(i // 8 % 5):  # up to four words replaced
            part[draw.randrange(len(part))] = "other"
        around = draw.choices(words, k=20)
        docs.append((i, " ".join(around[:10]) + ", " + " ".join(part).title() + ". " + " ".join(around[10:])))
    docs += [(100, None), (101, ""), (None, items[7][1]), (102, items[7][1]), (102, items[7][1])]
    schema = "doc_id long, text string, seed string, item string, held string"
    frame = spark.createDataFrame([(i, t, "s", None, "h") for i, t in docs], schema).repartition(3)
    bench = spark.createDataFrame([(j, t, "q") for j, t in items], "item_id long, text string, seed string")
    expected = set(leaks([(i, t or "") for i, t in docs], [(j, t or "") for j, t in items]))
    same(decontaminate.overlaps(frame, bench).collect(), expected)
    left = decontaminate.drop_contaminated(frame, bench)
    gone = {i for i, *_ in expected if i is not None}
    assert Counter(r.doc_id for r in left.collect()) == Counter(i for i, _ in docs if i not in gone)
    assert decontaminate.overlaps(nothing, bench).count() == 0
    assert decontaminate.overlaps(frame, bench.limit(0)).count() == 0


def test_masks_are_lossless():
    from itertools import combinations
    for changed in combinations(range(decontaminate.WINDOW), 2):
        assert any(not {s + m for m in mask} & set(changed)
                   for mask in decontaminate.MASKS for s in range(decontaminate.WINDOW - max(mask)))


def test_large_benchmarks_are_not_broadcast(spark, documents, monkeypatch):
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    usual = sorted(map(tuple, decontaminate.overlaps(documents, bench).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = decontaminate.overlaps(documents, bench)
        assert "BroadcastHashJoin" not in frame._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, frame.collect())) == usual and usual
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_long_items_are_there_once(spark, monkeypatch):
    """Seeds hold no token arrays, items are bounded by bytes, and far parts of a document are not moved."""
    draw = random.Random(9)
    words = [f"w{i}" for i in range(500)]
    long = draw.choices(words, k=1000)
    items = [(1, " ".join(long)), (1, " ".join(draw.choices(words, k=40))), (None, " ".join(draw.choices(words, k=9)))]
    items += [(3, items[1][1]), (3, items[1][1])]
    docs = [(i, " ".join(draw.choices(words, k=300) + long[150 * i:150 * i + 11 + i] + draw.choices(words, k=300)))
            for i in range(6)]
    docs += [(None, "x " + items[2][1]), (None, items[1][1]), (4, items[1][1]), (4, items[1][1]), (9, " ".join(long[-11:]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = {}

    def seen(df, label):
        kept[label] = df
        return saved(df, label)
    monkeypatch.setattr(decontaminate, "saved", seen)
    first = {}
    for i, j, span, best in leaks(docs, items):
        first[i, j] = tuple(map(max, (span, best), first.get((i, j), (0, 0))))
    expected = [(*k, *v) for k, v in first.items()]
    same(decontaminate.overlaps(frame, bench).collect(), expected)
    assert not [t for _, t in kept["benchmark-seeds"].dtypes if t.startswith("array")] and len(expected) > 6
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 8 * 1000)
    same(decontaminate.overlaps(frame, bench).collect(), expected)
    assert not [t for _, t in kept["spots"].dtypes if t.startswith("array")]


ODD_IDS = [(5, "A one"), (9, "A one"), (5, "B two"), (7, "C three"), (7, "C three"), (None, "A one"),
           (None, "D four"), (None, "D four"), (6, None), (4, ""), (None, "")]


def test_rows_are_judged_by_their_own_text(spark):
    """Repeated and null ids: exactly one row of each group stays, and no text is lost with another's id."""
    frame = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(ODD_IDS)], "doc_id long, text string, k int").repartition(3)
    same(exact_dedup.drop_exact_copies(frame, spare_null_ids=False).collect(),
         [(9, "A one", 1), (5, "B two", 2), (7, "C three", 3), (None, "D four", 6), (6, None, 8)])
    same(simhash.drop_near_copies(frame).collect(),
         [(5, "A one", 0), (5, "B two", 2), (7, "C three", 3), (None, "D four", 6), (4, "", 9)])
    spared = exact_dedup.drop_exact_copies(frame)
    assert sorted(r.k for r in spared.collect()) == [1, 2, 3, 5, 6, 7, 8, 10]


def test_one_row_of_each_component_stays(spark, odd):
    rows = pairs(odd)
    of = {(i, t): c for (i, t), c in zip(rows, (f for _, f, _ in components(rows)))}
    left = pairs(simhash.drop_near_copies(odd))
    prints = sorted({int(f, 16) for f in of.values()})
    assert len({of[r] for r in left}) == len(left)
    far = [of[r] for r in left]
    assert not any((int(a, 16) ^ int(b, 16)).bit_count() <= 2 for n, a in enumerate(far) for b in far[:n])
    assert {c for _, _, c in components(rows)} == {i for i, _ in left} and len(prints) >= len(left)


def test_leaks_are_judged_by_their_own_text(spark):
    item = " ".join(f"w{i}" for i in range(20))
    docs = [(1, "x " + item), (1, "clean"), (None, item), (None, "clean"), (2, None), (None, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    same(decontaminate.drop_contaminated(frame, bench, spare_null_ids=False).collect(), [d for d in docs if item not in (d[1] or "")])
    same(decontaminate.drop_contaminated(frame, bench).collect(), docs[1:])


def short_leaks(docs, items):
    """Items of fewer than 13 words by 80 per cent of their length, whole below 8 tokens."""
    def cut(text):
        return re.findall(r"[\u3040-\u30ff\u4e00-\u9fff]|[^\W_\u3040-\u30ff\u4e00-\u9fff]+", text.lower())
    for i, text in docs:
        held = cut(text)
        for j, item in items:
            part = cut(item)
            if not part or len(tokens(item)) >= 13:
                continue
            span = min(13, len(part))
            best = max([0, *(sum(held[p + k] == w for k, w in enumerate(part[s:s + span]) if 0 <= p + k < len(held))
                             for s in range(len(part) - span + 1) for p in range(-span, len(held)))])
            if best >= (math.ceil(0.8 * span) if span >= 8 else span):
                yield i, j, span, best


def test_short_items(spark, monkeypatch):
    """Items of 1 to 12 tokens and of a script without spaces, with up to three tokens replaced."""
    draw = random.Random(12)
    words, signs = [f"w{i}" for i in range(40)], [chr(0x4e00 + i) for i in range(40)]
    items = [(n, " ".join(draw.choices(words, k=n))) for n in range(2, 13)] + [(1, "alone"), (98, ""), (99, None)]
    items += [(100 + n, "".join(draw.choices(signs, k=n))) for n in (3, 9, 12, 13, 25)]
    docs = [(500, "alone"), (501, None), (502, ""), (503, "w1")]
    for n, item in items:
        for changed in range(4 if item else 0):
            part, gap = (list(item), "") if n > 100 else (item.split(), " ")
            for k in draw.sample(range(len(part)), min(changed, len(part))):
                part[k] = "他" if n > 100 else "other"
            docs.append((len(docs), gap.join(draw.choices(signs if n > 100 else words, k=9) + part + ["end"])))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = set(short_leaks([(i, t or "") for i, t in docs], [(j, t or "") for j, t in items]))
    assert {(j, b) for _, j, _, b in expected} >= {(12, 11), (12, 10), (8, 7), (3, 3), (1, 1), (109, 8), (125, 12)}
    same(decontaminate.overlaps(frame, bench, short_items=True).collect(), expected)
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    same(decontaminate.overlaps(frame, bench, short_items=True).collect(), expected)
    left = decontaminate.drop_contaminated(frame, bench, short_items=True)
    assert {r.doc_id for r in left.collect()} == {i for i, _ in docs} - {i for i, *_ in expected}
    con = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        con.register(name, pa.table({key: [r[0] for r in rows], "text": [r[1] for r in rows]}))
    same(con.execute(ORACLE["op10_decontamination"]).fetchall(), expected)


def test_runs_of_short_windows_are_lossless():
    from itertools import combinations
    for n in range(decontaminate.LEAST_TOKENS, decontaminate.WINDOW):
        run, changed = decontaminate.least_run(n), n - math.ceil(decontaminate.SIMILARITY * n)
        for gone in combinations(range(n), changed):
            assert any(not set(range(s, s + run)) & set(gone) for s in range(n - run + 1))
