"""Interpolated modified Kneser-Ney n-gram model, counted in Spark, scored from memory-mapped files.

Words are 64-bit hashes. The vocabulary is a sorted array of hashes over several
files, and a word's number is its place in it. An n-gram is one number too: the
place of all its words but the last among the shorter n-grams, and its last word's
number. So each level is a sorted array of exact keys, and the n-grams after one
context lie together. Counts are combined for each block of text and dealt by key
to files of bounded size; where a key belongs follows from the counts of the level
before, so no pass over the texts is spent on finding ranges. What a block sends to
one file is a single row: sorted keys as differences, their bytes in planes,
compressed. Statistics of n-grams as contexts and as continuations travel the same
way and are arrays by place. Workers map the files of the shared folder into memory
and look up the sorted distinct n-grams of a block of texts, so a model may be far
larger than a worker.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from wardstat.llm.arrays import SortedTable, mapped, write_arrays
from wardstat.llm.blocks import byte_block, crc_fold, saved, slices, trimmed
from wardstat.llm.words import word_cells
from wardstat.session import scratch_path

#: Words in an n-gram. Text counted and scored together, and training tokens for each file of n-grams.
ORDER = 3
COUNT_BYTES = 8 << 20
SCORE_BYTES = 8 << 20
FILE_TOKENS = 1_000_000
MERGED = 1_000_000  # rows that a task holds before it sums those of equal keys
MOST = 255  # larger counts of an n-gram are kept in a list of their own
# No word holds white space, so these are no words.
END, START = b" ", b"\n"


def word_hash(word):
    return np.uint64(xxhash.xxh64_intdigest(word, 42)).astype(np.int64)


END_HASH = int(word_hash(END))


def starts_of(ordered):
    """Where the runs of equal numbers begin."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(new)


def run_places(held, wanted, begin, rows):
    """Place of each number in its own ascending run of an array, -1 if it is not there; all runs are searched at once."""
    at, left = begin.copy(), rows.copy()
    for _ in range(int(left.max(initial=1) - 1).bit_length()):
        half = left >> 1
        at += half * (held[at + half] <= wanted)
        left -= half
    return np.where((rows > 0) & (held[at] == wanted), at, -1)


def grouped(keys):
    """Distinct numbers of -1 or more, ascending, and which of them each one is.

    Where a number and its place fit in 64 bits they are sorted as one, several times faster than an order is found.
    """
    shift = len(keys).bit_length()
    if not len(keys) or int(keys.max() + 1).bit_length() + shift > 63:
        return np.unique(keys, return_inverse=True)
    ordered = (keys + 1 << shift) | np.arange(len(keys))
    ordered.sort()
    at = ordered & (1 << shift) - 1
    ordered >>= shift
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    inverse = np.empty(len(keys), np.int64)
    inverse[at] = np.cumsum(new) - 1
    return ordered[new] - 1, inverse


class Keys(SortedTable):
    """Sorted keys, of which the files hold the lower 32 bits, and where the upper ones change in the extra part."""

    def parts(self, i):
        """Arrays of a file, the distinct upper halves, where each begins, and the rest of the extra part."""
        path, rows, _, extra, *_ = self.files[i]
        arrays, more = mapped(path, rows, self.kinds, extra)
        more = more.view("<i8")
        n = int(more[0])
        return arrays, more[1:n + 1], more[n + 1:2 * n + 1], more[2 * n + 1:]

    def find(self, keys, wanted=()):
        place = np.full(len(keys), -1, np.int64)
        values = [np.zeros(len(keys), self.kinds[i]) for i in wanted]
        bounds = np.append(np.searchsorted(keys, self.firsts), len(keys))
        for i in np.flatnonzero(np.diff(bounds)):
            arrays, upper, begin, _ = self.parts(i)
            some = keys[bounds[i]:bounds[i + 1]]
            high, low = some >> 32, (some & 0xFFFFFFFF).astype("<u4")
            first = starts_of(high)
            spots = np.minimum(np.searchsorted(upper, high[first]), len(upper) - 1)
            rows = np.diff(begin, append=len(arrays[0]))[spots] * (upper[spots] == high[first])
            times = np.diff(first, append=len(high))
            at = run_places(arrays[0], low, np.repeat(begin[spots], times), np.repeat(rows, times))
            hit = np.flatnonzero(at >= 0)
            at = at[hit]
            hit += bounds[i]
            place[hit] = self.before[i] + at
            for value, k in zip(values, wanted):
                value[hit] = arrays[k][at]
        return place, values

    def keys_at(self, places):
        """The keys at places in any order."""
        made = np.zeros(len(places), np.int64)
        for i, some in self.by_file(places):
            arrays, upper, begin, _ = self.parts(i)
            at = places[some] - self.before[i]
            made[some] = (upper[np.searchsorted(begin, at, "right") - 1] << 32) | arrays[0][at].astype(np.int64)
        return made


def halves(keys):
    """The lower halves of sorted keys, and the upper ones as ``Keys`` reads them."""
    upper = keys >> 32
    first = starts_of(upper)
    return (keys & 0xFFFFFFFF).astype("<u4"), np.concatenate([[len(first)], upper[first], first])


class Grams(Keys):
    """Counts of n-grams, a byte each; those of ``MOST`` or more are in the extra part."""

    def __init__(self, files):
        super().__init__(files, ("<u4", "u1"))

    def counts(self, keys):
        count = self.find(keys, (1,))[1][0].astype(np.int64)
        for i in np.flatnonzero(count == MOST):
            large = self.parts(int(np.searchsorted(self.firsts, keys[i], "right")) - 1)[3].reshape(2, -1)
            count[i] = large[1][np.searchsorted(large[0], keys[i])]
        return count


def pack(columns):
    """Columns of numbers from 0, the first of them ascending, as bytes."""
    columns = [np.diff(columns[0], prepend=0), *columns[1:]]
    widths = [max(1, -(-int(c.max()).bit_length() // 8)) for c in columns]
    planes = [np.ascontiguousarray(np.ascontiguousarray(c, "<i8").view("u1").reshape(-1, 8)[:, :w].T).tobytes()
              for c, w in zip(columns, widths)]
    return bytes(widths) + pa.compress(b"".join(planes), "zstd", asbytes=True)


def unpack(data, rows, n_columns):
    """The columns of ``pack``."""
    widths = data[:n_columns]
    planes = np.frombuffer(pa.decompress(data[n_columns:], rows * sum(widths), "zstd", asbytes=True), "u1")
    columns, at = [], 0
    for w in widths:
        wide = np.zeros((rows, 8), "u1")
        wide[:, :w] = planes[at:at + rows * w].reshape(w, rows).T
        columns.append(wide.view("<i8").ravel())
        at += rows * w
    return [np.cumsum(columns[0]), *columns[1:]]


def summed(parts):
    """Distinct keys of several lists of columns, ascending, and the sums of the other columns."""
    columns = [np.concatenate(c) for c in zip(*parts)]
    order = np.argsort(columns[0])
    keys = columns[0][order]
    first = starts_of(keys)
    return [keys[first], *(np.add.reduceat(c[order], first) if len(first) else c for c in columns[1:])]


RUN = "part int, n long, run binary"


def run_rows(part, columns):
    """Rows of ``RUN`` for columns whose ascending first one goes to ascending parts."""
    first = starts_of(part)
    return [{"part": int(part[a]), "n": int(b - a), "run": pack([c[a:b] for c in columns])}
            for a, b in zip(first, np.append(first[1:], len(part)))]


def merged(batches, n_columns):
    """``summed`` of the runs of a task's rows; memory is bounded by its distinct keys."""
    held, size, due = [[np.zeros(0, np.int64)] * n_columns], 0, MERGED
    for batch in batches:
        for n, run in zip(batch.column("n").to_pylist(), batch.column("run")):
            held.append(unpack(run.as_py(), n, n_columns))
            size += n
            if size >= due:
                held = [summed(held)]
                size = len(held[0][0])
                due = max(MERGED, 2 * size)
    return summed(held)


def _blocks(batches, limit):
    """Ids, words of each text, codes and distinct words' hashes of blocks of text."""
    for batch in batches:
        for part, texts in slices(batch, "text", limit):
            counts, cells = word_cells(texts)
            ends, letters = byte_block(cells.dictionary)
            letters = letters.tobytes()
            hashes = np.fromiter((xxhash.xxh64_intdigest(letters[a:b], 42) for a, b in pairwise(ends.tolist())),
                                 np.uint64, len(cells.dictionary)).view(np.int64)
            yield part.column(0), counts, np.asarray(cells.indices).astype(np.int64), hashes


def _lookup(table, hashes, wanted=()):
    """``SortedTable.find`` for keys in any order."""
    order = np.argsort(hashes)
    place, values = table.find(hashes[order], wanted)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return place[back], [v[back] for v in values]


def _padded(counts, codes, start, end, order):
    """The words of all texts in a row, ``order - 1`` starts before each and an end after it, and places of the tokens."""
    ends = np.cumsum(counts)
    at = np.repeat((ends - counts)[:, None], order, axis=1)
    at[:, -1] = ends
    words = np.insert(codes, at.ravel(), np.tile([start] * (order - 1) + [end], len(counts)))
    place = np.arange(len(words)) - np.repeat(np.cumsum(counts + order) - counts - order, counts + order)
    return words, place


def _pairs(before, own, n):
    """One number for the n-gram that ends at each word, from its rank one word before and the word's; -1 if one is unknown."""
    before = np.concatenate([[-1], before[:-1]])
    return np.where((before < 0) | (own < 0), -1, before * n + own)


def _placed(found, inverse):
    """Places that are known, and which of them each word has; -1 if unknown."""
    known = found >= 0
    return found[known], np.where(known, np.cumsum(known) - 1, -1)[inverse]


def _written(df, folder, columns, kinds, summed=None):
    """Write a table's sorted columns as one file for each partition; the files for ``SortedTable``.

    The column ``summed`` is replaced by the sums before each row of a file.
    """
    def run(batches):
        held = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if held:
            whole = pa.concat_tables(held)
            arrays = [whole.column(c).to_numpy().astype(k) for c, k in zip(columns, kinds)]
            mass = 0
            if summed is not None:
                sums = np.cumsum(arrays[summed])
                arrays[summed], mass = sums - arrays[summed], int(sums[-1])
            yield pa.RecordBatch.from_pylist([{
                "path": write_arrays(folder, arrays), "n_rows": len(arrays[0]), "first": int(arrays[0][0]), "mass": mass}])

    made = saved(df.select(*dict.fromkeys(columns)).mapInArrow(
        trimmed(run), "path string, n_rows long, first long, mass long"), "array-files")
    return [(r.path, r.n_rows, r.first, 0, r.mass) for r in made.collect()]


def discounts(n):
    """The three discounts from the numbers of n-grams seen once to four times; 0.5 k where they say nothing."""
    if not (n[0] and n[1]):
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    made = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.5 * k for k in (1, 2, 3)]
    return tuple(min(max(d, 0.0), k) if d > 0 else 0.5 * k for k, d in zip((1, 2, 3), made))


NAMES = ("total", "once", "twice", "more", "continued")


class Stats:
    """``NAMES`` of each n-gram of a length by its place; files of ``span`` places, in the smallest type that holds them."""

    def __init__(self, span, files):
        self.span, self.files = span, files

    def find(self, places, wanted):
        """Statistics of ascending places; 0 for -1."""
        made = [np.zeros(len(places)) for _ in wanted]
        file = places // self.span
        first = starts_of(file)
        for a, b in zip(first, np.append(first[1:], len(file))):
            if int(file[a]) in self.files:
                path, rows, kind = self.files[int(file[a])]
                arrays = mapped(path, rows, (kind,) * len(NAMES), 0)[0]
                inside = places[a:b] - file[a] * self.span
                for m, k in zip(made, wanted):
                    m[a:b] = arrays[NAMES.index(k)][inside]
        return made


class Level:
    """N-grams of one length: their keys, and the statistics of each, by its place, as context and as continuation."""

    def __init__(self, keys, places, n_files):
        self.keys, self.stats, self.discount = keys, None, (0.5, 1.0, 1.5)
        self.places = places
        self.span = max(1, -(-places // n_files))

    def found(self, keys):
        """Places of sorted keys."""
        return self.keys.find(keys)[0]

    def continued(self, places):
        """Of ascending places; a 0 for what is unknown comes last."""
        return np.append(self.stats.find(places, ("continued",))[0], 0)

    def contexts(self, places, discount):
        """Tokens after each of ascending places, and what share the discount takes; 1 and 1 where there are none, and last."""
        total, once, twice, more = (np.append(x, 0) for x in self.stats.find(places, NAMES[:4]))
        some = total > 0
        weight = np.where(some, discount[0] * once + discount[1] * twice + discount[2] * more, 1.0)
        total = np.where(some, total, 1.0)
        return total, weight / total

    def runs(self, contexts, n, suffixes):
        """Rows of ``RUN`` with what n-grams one word longer say of this level.

        ``contexts`` are the ascending places of their words but the last, ``n`` their
        counts, ``suffixes`` the places of their words but the first.
        """
        begin = starts_of(contexts)
        sums = [np.add.reduceat(x.astype(np.int64), begin) if len(begin) else begin for x in (n, n == 1, n == 2, n > 2)]
        ids, continued = np.unique(suffixes, return_counts=True)
        none = [np.broadcast_to(0, len(ids))] * 4
        above = contexts[begin]
        return run_rows(above // self.span, [above, *sums, np.broadcast_to(0, len(above))]) \
            + run_rows(ids // self.span, [ids, *none, continued])


class Model:
    """What a worker needs to score: the levels of sorted arrays, the longest n-grams' counts and a few numbers."""

    def __init__(self, words, order):
        self.words, self.order = words, order
        self.levels = {}
        self.grams, self.discount, self.n_tokens = None, None, 0
        self.types, self.spread = 0, 1.0

    @property
    def size(self):
        return len(self.words)

    def suffix(self, length, places):
        """Place of the n-gram without its first word, for n-grams of two words or more."""
        key = self.levels[length].keys.keys_at(places)
        word = key % (self.size + 1)
        if length == 2:
            return word
        before, inverse = np.unique(key // (self.size + 1), return_inverse=True)
        return self.suffix_of(length, self.suffix(length - 1, before)[inverse], word)

    def suffix_of(self, length, before, word):
        """The same, from the place of the words between the first and the last, and the last."""
        if length == 2:
            return word
        distinct, inverse = np.unique(before * (self.size + 1) + word, return_inverse=True)
        return self.levels[length - 1].found(distinct)[inverse]

    def numbers(self, hashes):
        """Numbers and counts of a block's distinct words, the end and the start after them."""
        number, (seen,) = _lookup(self.words, np.append(hashes, END_HASH), (2,))
        return np.append(number, self.size), np.append(seen, 0)

    def keys(self, pairs, places, known):
        """Keys of ascending numbers from ``_pairs``: the n-grams' order is that of the ranks."""
        before = pairs // len(known)
        above = np.append(places, 0)[before]  # there may be no places
        return np.where(pairs < 0, -1, above * (self.size + 1) + known[pairs - before * len(known)])

    def counted(self, numbers, words, some, length):
        """Distinct keys of the n-grams of a length that end at some words of a block, and how often they do."""
        known, rank = _placed(*grouped(numbers))
        own = rank[words]
        places, at = known, own
        for k in range(2, length):
            pairs, inverse = grouped(_pairs(at, own, len(known)))
            places, at = _placed(self.levels[k].found(self.keys(pairs, places, known)), inverse)
        pairs = np.sort(_pairs(at, own, len(known))[some])
        first = starts_of(pairs)
        return self.keys(pairs[first], places, known), np.diff(first, append=len(pairs))

    @staticmethod
    def discounted(count, discount):
        cut = np.array([0.0, *discount])[np.minimum(count, 3).astype(np.int64)]
        return np.maximum(count - cut, 0)

    def score(self, counts, codes, hashes):
        """Tokens, known tokens, base score and score of each text of a block."""
        numbers, seen = self.numbers(hashes)
        words, inside = _padded(counts, codes, len(hashes) + 1, len(hashes), self.order)
        number = numbers[words]
        known, rank = _placed(*grouped(numbers))
        own = rank[words]
        continued = self.levels[1].continued(known)
        p = (self.discounted(continued, self.levels[1].discount) / max(1, self.types) + self.spread / (self.size + 1))[own]
        places, at = known, own
        for k in range(2, self.order + 1):
            before, context = np.concatenate([[-1], at[:-1]]), places
            pairs, inverse = grouped(_pairs(at, own, len(known)))
            keys = self.keys(pairs, places, known)
            if k < self.order:
                places, at = _placed(self.levels[k].found(keys), inverse)
                count, discount = self.levels[k].continued(places), self.levels[k].discount
            else:
                count, at, discount = self.grams.counts(keys), inverse, self.discount
            # An n-gram after a context without tokens has no count. What is unknown comes last.
            total, share = self.levels[k - 1].contexts(context, discount)
            p = self.discounted(count, discount)[at] / total[before] + share[before] * p
        tokens = inside >= self.order - 1
        base = np.log10((seen + 0.5) / (self.n_tokens + 0.5 * (self.size + 1)))[words][tokens]
        first = np.cumsum(counts + 1) - counts - 1
        return (counts + 1, np.add.reduceat((seen > 0)[words][tokens].astype(np.int64), first),
                np.add.reduceat(base, first), np.add.reduceat(np.log10(p[tokens]), first))


FILE = "path string, rows long, first long, extra long, mass long, once long, twice long, thrice long, four long, more long, types long"
ROWS = pa.schema([("part", pa.int32()), ("n", pa.int64()), ("run", pa.binary()), ("path", pa.string()), *(
    (c.split()[0], pa.int64()) for c in FILE.split(", ")[1:]), ("kind", pa.string())])


def _kinds_of(n):
    """How many n-grams have a count of one to four."""
    return {c: int((n == k).sum()) for k, c in enumerate(("once", "twice", "thrice", "four"), 1)}


def _counted(texts, model, length, masses, n_files, folder):
    """Files of the n-grams of a length and their counts, and the statistics that those of the longest give.

    A key's file follows from the tokens in contexts before its own, so a file
    holds at most ``FILE_TOKENS`` rows and one more for each block.
    """
    size, last = model.size, length == model.order

    def count(batches):
        for _, counts, codes, hashes in _blocks(batches, COUNT_BYTES):
            numbers, _ = model.numbers(hashes)
            words, inside = _padded(counts, codes, len(hashes) + 1, len(hashes), model.order)
            keys, n = model.counted(numbers, words, inside >= length - 1, length)
            above = keys // (size + 1)
            begin = starts_of(above)
            before, own = (np.repeat(x, np.diff(np.append(begin, len(above)))) for x in masses(above[begin]))
            at = before + own * ((keys - above * (size + 1)) / (size + 1))
            part = np.minimum(at // FILE_TOKENS, n_files - 1).astype(np.int32)
            yield pa.RecordBatch.from_pylist(run_rows(part, [keys, n]), schema=pa.schema(list(ROWS)[:3]))

    def write(batches):
        keys, n = merged(batches, 2)
        if not len(keys):
            return
        about = {"rows": len(keys), "first": int(keys[0]), "mass": int(n.sum()), **_kinds_of(n)}
        lower, extra = halves(keys)
        if last:
            large = n >= MOST
            extra = np.concatenate([extra, keys[large], n[large]])
            about["path"] = write_arrays(folder, [lower, np.minimum(n, MOST).astype("u1")], extra.astype("<i8").tobytes())
            context = keys // (size + 1)
            begin = starts_of(context)
            before = None
            if length > 2:
                before = np.repeat(model.suffix(length - 1, context[begin]), np.diff(np.append(begin, len(context))))
            suffixes = model.suffix_of(length, before, keys - context * (size + 1))
            yield pa.RecordBatch.from_pylist(model.levels[length - 1].runs(context, n, suffixes), schema=ROWS)
        else:  # the tokens before each n-gram say where the longer ones after it belong
            about["path"] = write_arrays(folder, [lower, (np.cumsum(n) - n).astype("<f4")], extra.astype("<i8").tobytes())
        yield pa.RecordBatch.from_pylist([about | {"extra": 8 * len(extra)}], schema=ROWS)

    rows = texts.mapInArrow(trimmed(count), RUN).repartitionById(n_files, "part").select("n", "run")
    return saved(rows.mapInArrow(trimmed(write), f"{RUN}, {FILE}, kind string"), f"grams-{length}")


def _levelled(model, rows, length, n_files, folder):
    """Take a level's statistics in, and hand on those that it gives the level before."""
    level, size = model.levels[length], model.size

    def write(batches):
        columns = merged(batches, 1 + len(NAMES))
        ids, continued = columns[0], columns[-1]
        if not len(ids):
            return
        part = int(ids[0]) // level.span
        n_rows = min(level.span, level.places - part * level.span)
        kind = next(k for k in ("<u1", "<u2", "<u4", "<i8") if max(c.max() for c in columns[1:]) <= np.iinfo(k).max)
        arrays = np.zeros((len(NAMES), n_rows), kind)
        arrays[:, ids - part * level.span] = columns[1:]
        path = write_arrays(folder, [arrays])
        # The start is a context only: it continues nothing.
        n = continued[ids != size] if length == 1 else continued
        yield pa.RecordBatch.from_pylist([{
            "part": part, "path": path, "rows": n_rows, "kind": kind, **_kinds_of(n), "more": int((n > 2).sum()),
            "types": int(n.sum())}], schema=ROWS)
        if length > 1:
            some = np.flatnonzero(continued)
            ids, n = ids[some], continued[some]
            runs = model.levels[length - 1].runs(level.keys.keys_at(ids) // (size + 1), n, model.suffix(length, ids))
            yield pa.RecordBatch.from_pylist(runs, schema=ROWS)

    runs = rows.where("run IS NOT NULL").select(*(c.split()[0] for c in RUN.split(", ")))
    made = saved(runs.repartitionById(n_files, "part").select("n", "run").mapInArrow(
        trimmed(write), f"{RUN}, {FILE}, kind string"), f"stats-{length}")
    files = made.where("path IS NOT NULL").drop("run").collect()  # one row for each file
    level.stats = Stats(level.span, {r.part: (r.path, r.rows, r.kind) for r in files})
    once, twice, thrice, four, more, types = (
        sum(r[c] for r in files) for c in ("once", "twice", "thrice", "four", "more", "types"))
    level.discount = discounts([once, twice, thrice, four])
    if length == 1:
        model.types = types
        model.spread = sum(d * n for d, n in zip(level.discount, (once, twice, more))) / types if types else 1.0
    return made


class Mass:
    """Tokens in the contexts before each context, and in it; contexts by place."""

    def __init__(self, table, start):
        self.table, self.start = table, start
        self.own = np.array([f[4] for f in table.files], np.float64)
        self.bases = np.concatenate([[0], np.cumsum(self.own)])

    def __call__(self, places):
        own, before = np.zeros(len(places)), np.zeros(len(places))
        known = places < len(self.table)
        if self.start is not None:  # the start is no word of the table, it comes last
            before[~known], own[~known] = self.start
        at = places[known]
        file = np.searchsorted(self.table.before, at, "right") - 1
        end = self.own[file]
        inside = np.minimum(self.table.at(at, 1), end)
        final = at + 1 == self.table.before[file + 1]
        after = np.where(final, end, np.minimum(self.table.at(np.where(final, at, at + 1), 1), end))
        before[known], own[known] = self.bases[file] + inside, after - inside
        return before, own


def train(docs, text_col="text", order=ORDER):
    """The model of all texts of a table. Null texts count as empty: an end alone."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "ngrams")
    texts = docs.select(F.lit(0).alias("row"), F.col(text_col).cast("string").alias("text"))

    def count_words(batches):
        for _, counts, codes, hashes in _blocks(batches, COUNT_BYTES):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.append(hashes, END_HASH)),
                pa.array(np.append(np.bincount(codes, minlength=len(hashes)), len(counts)))], names=["word", "n"])

    counted = saved(texts.mapInArrow(trimmed(count_words), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")),
                    "word-counts")
    n_tokens, n_texts = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(
        F.max(F.when(F.col("word") == END_HASH, F.col("n"))), F.lit(0))).first()
    kinds = ("<i8",) * 3
    files = _written(counted.repartitionByRange("word").sortWithinPartitions("word"), folder, ("word", "n", "n"), kinds, summed=1)
    table = SortedTable(files, kinds)
    model = Model(table, order)
    model.n_tokens = n_tokens
    total = n_tokens + n_texts * (order - 1)
    n_files = max(8, -(-total // FILE_TOKENS))
    masses = Mass(table, (n_tokens, n_texts * (order - 1)))
    model.levels[1] = Level(None, len(table) + 1, n_files)  # the start comes after all words
    for length in range(2, order + 1):
        rows = _counted(texts, model, length, masses, n_files, folder)
        made = rows.where("path IS NOT NULL").drop("run").collect()  # one row for each file
        files = [(r.path, r.rows, r.first, r.extra, r.mass) for r in made]
        if length < order:
            table = Keys(files, ("<u4", "<f4"))
            masses = Mass(table, None)
            model.levels[length] = Level(table, len(table), n_files)
    model.grams = Grams([f[:4] for f in files])
    model.discount = discounts([sum(r[c] for r in made) for c in ("once", "twice", "thrice", "four")])
    for length in range(order - 1, 0, -1):
        rows = _levelled(model, rows, length, n_files, folder)
    return model


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs, model, id_col="doc_id", text_col="text", held_out=lambda doc_id: False):
    """Scores of every text, see ``perplexity_scores``."""
    def run(batches):
        for ids, counts, codes, hashes in _blocks(batches, SCORE_BYTES):
            made = model.score(counts, codes, hashes)
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([held_out(x) for x in ids.to_pylist()], pa.bool_()),
                pa.array(made[0]), pa.array(made[1]), pa.array(np.full(len(counts), model.n_tokens)),
                *map(pa.array, made[2:])], names=[x.split()[0] for x in SCORES.split(", ")])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(trimmed(run), SCORES)


def perplexity_scores(docs, id_col="doc_id", text_col="text", order=ORDER):
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Learns from all rows whose crc32 of the id, modulo 5, is not 1 (the others are
    held out; null ids are learned from). ``score`` is the model's log10
    probability of the text and its end, ``base_score`` that of single words with
    half a count added. Perplexity is ``pow(10, -score / n_tokens)``. A null or
    empty text is its end alone; without training text every word has
    probability 1 over one unknown word. Repeated rows count as often as they
    are there. Other columns are not looked at.
    """
    rest = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5
    model = train(docs.where(F.coalesce(rest, F.lit(0)) != 1), text_col, order)
    return score(docs, model, id_col, text_col, lambda x: x is not None and crc_fold(x) == 1)
