"""Removal of repeated passages by a hash-compared suffix sort.

Every byte that a string of ``LENGTH`` bytes covers goes if that string also
starts in a document with a smaller id. Three narrow passes over the texts and
two shuffles of what they find; the texts themselves never move.

1. Every window of ``LENGTH`` bytes belongs to its anchor, the gram of ``GRAM``
   bytes in it with the least hash, so that equal windows have equal anchors. The
   windows of one anchor are neighbours; together they are a unit. Units meet by
   anchor: of equal units the one in the first document stays and all others are
   covered; units that share the anchor but not the rest are in doubt.
2. Units in doubt meet once more with their bytes. Their windows are suffixes cut
   at ``LENGTH``; a mergesort orders them, whose comparisons find the common
   extension of two suffixes by binary search over prefix hashes. Neighbours with
   an extension of the full length are compared byte by byte and are one class;
   windows of documents after the first of their class are covered.
3. Covered windows are laid over each text.

A block of texts sends one row for equal units of its own documents and at most
``HOT_BLOCK`` for one anchor; anchors beyond that or ``HOT`` units, as at the edges
of a passage that a third of all documents share, are told apart by whole windows,
of which a block again sends one each.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from wardstat.llm.arrays import SortedTable, mapped, write_arrays
from wardstat.llm.blocks import byte_block, ranges, saved, slices, trimmed
from wardstat.session import scratch_path

LENGTH = 50
GRAM = 24
HOT_BLOCK = 32
HOT = 256
#: Bytes of text that are hashed together, but for one longer text: the arrays stay in a core's cache.
HASHED = 1 << 18
#: Suffixes that are sorted together, but for one anchor's, which are at most ``HOT`` units.
SORTED = 400_000
LAST = np.iinfo(np.int64).max  # stands for a null id: after all others

BASE = 0x9E3779B97F4A7C15
LOW = np.uint64(0xFFFFFFFF)
FLAGS = np.uint64(3)  # bits of a hash that are left free
COVERED, DOUBT, DOUBT_HOT = 1, 2, 3  # what the first shuffle says of a unit
POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
LETTERS = np.random.default_rng(3).integers(1, 2 ** 63, 256, dtype=np.uint64) | np.uint64(1)


def mix(x):
    """Spread the bits of hashes."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(n):
    """Powers of ``BASE`` and of its inverse modulo 2 ** 64, from 0 to at least ``n``."""
    if len(POWERS[0]) <= n:
        for i, base in enumerate((BASE, pow(BASE, -1, 2 ** 64))):
            factors = np.full(n + 1, base, np.uint64)
            factors[0] = 1
            POWERS[i] = np.cumprod(factors)
    return POWERS


class PrefixHashes:
    """Polynomial hashes of any part of some bytes, from sums over their prefixes."""

    def __init__(self, data):
        self.up, self.down = powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(LETTERS[data] * self.down[:len(data)], out=self.sums[1:])

    def of(self, starts, lengths):
        return (self.sums[starts + lengths] - self.sums[starts]) * self.up[starts]

    def grams(self, length):
        """The hashes of all parts of one length, in the order of their starts."""
        count = len(self.sums) - length
        return (self.sums[length:] - self.sums[:-length]) * self.up[:count]


def name_of(h, g):
    """One number for anchor and content; its last two bits are free."""
    return mix(h ^ (g * np.uint64(BASE))) & ~FLAGS


class Units:
    """The units of a block of texts: first and last window, anchor, hashes and text of each."""

    def __init__(self, data, offsets):
        self.hashes = PrefixHashes(data)
        self.text = np.zeros(0, np.int64)
        empty = np.zeros(0, np.int64)
        self.first, self.last, self.anchor = empty, empty, empty
        self.h, self.g = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        if len(data) < LENGTH:
            return
        gram = self.hashes.grams(GRAM)
        gram = (gram ^ (gram >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        gram ^= gram >> np.uint64(29)
        least = (gram & ~LOW) | np.arange(len(gram), dtype=np.uint64)
        span, width = 1, LENGTH - GRAM + 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[:span - width], least[width - span:])
        # Windows that run over the end of their text are none.
        ends = np.minimum(offsets[1:], len(least))
        over = np.minimum(np.maximum(offsets[:-1], offsets[1:] - LENGTH + 1), ends)
        inside = np.ones(len(least), bool)
        inside[ranges(over, ends - over)] = False
        window = np.flatnonzero(inside)
        if not len(window):
            return
        anchor = (least[window] & LOW).astype(np.int64)
        new = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        self.first, self.last = window[new], window[np.append(new[1:], len(window)) - 1]
        self.anchor = anchor[new]
        self.h = gram[self.anchor]
        shape = (self.anchor - self.first) * 1021 + (self.last - self.first)
        size = self.last - self.first + LENGTH
        self.g = mix(self.hashes.of(self.first, size) + mix(shape.astype(np.uint64))) & ~FLAGS
        self.text = np.searchsorted(offsets, self.first, "right") - 1

    @property
    def name(self):
        """One number for anchor and content; its last two bits are free."""
        return name_of(self.h, self.g)


def _ids(column):
    return np.asarray(column.fill_null(LAST), dtype=np.int64)


def _starts(*sorted_columns):
    new = np.zeros(len(sorted_columns[0]), bool)
    if len(new):
        new[0] = True
    for c in sorted_columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _spread(values, starts, total):
    return np.repeat(values, np.diff(np.append(starts, total)))


def _repeated(grouped):
    """Whether each of the values, of which equal ones are neighbours, is there more than once."""
    same = grouped[1:] == grouped[:-1]
    return np.append(False, same) | np.append(same, False) if len(grouped) else np.zeros(0, bool)


def _equal_cells(data, a, b, length):
    """Whether the bytes from places ``a`` on are those from ``b`` on."""
    cells = np.lib.stride_tricks.sliding_window_view(data, length)
    return (cells[a] == cells[b]).all(axis=1)


def _units_rows(batches):
    """Pass 1: rows ``h, g, doc``, the flag in the last bits of ``g``.

    Flags: 0 plain, 1 of a hot anchor, 2 covered, 3 hot and not sent. Rows come in
    the order of documents, which the shuffle's compression makes use of.
    """
    for batch in batches:
        held = []
        for part, texts in slices(batch, "text", HASHED):
            offsets, data = byte_block(texts)
            units = Units(data, offsets)
            held.append((units.h, units.g, _ids(part.column(0))[units.text]))
        if not held:
            continue
        h, g, doc = (np.concatenate(x) for x in zip(*held))
        # A unit that is alone with its anchor goes as it is.
        order = np.argsort(h)
        some = order[_repeated(h[order])]
        some = some[np.lexsort((doc[some], g[some], h[some]))]
        starts = _starts(h[some], g[some])
        lead = some[starts]
        gone = some[doc[some] > _spread(doc[lead], starts, len(some))]
        # One row for each unit in each document, of the covered ones too.
        gone = gone[_starts(h[gone], g[gone], doc[gone])]
        lead = lead[np.lexsort((doc[lead], h[lead]))]
        starts = _starts(h[lead])
        place = np.arange(len(lead)) - _spread(starts, starts, len(lead))
        size = _spread(np.diff(np.append(starts, len(lead))), starts, len(lead))
        flag = np.where(size <= HOT_BLOCK, 0, np.where(place < HOT_BLOCK, 1, 3)).astype(np.uint64)
        sent = np.ones(len(h), bool)
        sent[some] = False
        sent[lead] = sent[gone] = True
        g[lead] |= flag
        g[gone] |= np.uint64(2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(h[sent].view(np.int64)), pa.array(g[sent].view(np.int64)), pa.array(doc[sent])],
            names=["h", "g", "doc"])


def _whole_groups(batches, key, most):
    """Tables of the sorted rows of whole groups of equal keys, of about ``most`` rows."""
    held, count, due = [], 0, most
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        count += batch.num_rows
        if count >= due:
            table = pa.concat_tables(held)
            keys = table.column(key).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))  # the last group may go on
            if cut:
                yield table.slice(0, cut)
            held, count = [table.slice(cut)], len(keys) - cut
            due = max(most, 2 * count)
    if held:
        yield pa.concat_tables(held)


def _verdicts(bounds):
    """Shuffle 1: rows ``bucket, doc, said`` for covered units and units in doubt."""
    def run(batches):
        for table in _whole_groups(batches, "h", 500_000):
            h, g, doc = (table.column(i).to_numpy() for i in range(3))
            h, g = h.view(np.uint64), g.view(np.uint64)
            g, flag = g & ~FLAGS, (g & FLAGS).astype(np.int64)
            passed = flag >= 2
            out = [(h[passed], g[passed], doc[passed], np.where(flag[passed] == 2, COVERED, DOUBT_HOT))]
            # Nothing is said of a unit that is alone with its anchor.
            some = np.flatnonzero(~passed)
            some = some[_repeated(h[some]) | (flag[some] == 1)]
            some = some[np.lexsort((doc[some], g[some], h[some]))]
            h, g, doc, flag = h[some], g[some], doc[some], flag[some]
            if len(h):
                starts, anchors = _starts(h, g), _starts(h)
                first = _spread(doc[starts], starts, len(h))
                unit = np.zeros(len(h), np.int64)
                unit[starts] = 1
                units = _spread(np.add.reduceat(unit, anchors), anchors, len(h))
                several = _spread(np.minimum.reduceat(doc, anchors) < np.maximum.reduceat(doc, anchors),
                                  anchors, len(h))
                hot = _spread(np.maximum.reduceat(flag, anchors), anchors, len(h)) > 0
                said = np.where(doc > first, COVERED, 0)
                said = np.where((said == 0) & (units > 1) & several, np.where(units > HOT, DOUBT_HOT, DOUBT), said)
                said = np.where(hot & (said != COVERED), DOUBT_HOT, said)
                keep = said > 0
                out.append((h[keep], g[keep], doc[keep], said[keep]))
            h, g, doc, said = (np.concatenate(x) for x in zip(*out))
            name = name_of(h, g)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.searchsorted(bounds, doc, "right").astype(np.int32)), pa.array(doc),
                pa.array((name | said.astype(np.uint64)).view(np.int64))], names=["bucket", "doc", "said"])

    return run


def _by_document(rows, columns, folder, buckets):
    """Write rows with ``bucket`` and ``doc`` as sorted files; lists of rows by document. Input is shuffled once."""
    def run(batches):
        for table in _whole_groups(batches, "bucket", 1 << 62):
            bucket = table.column("bucket").to_numpy()
            edges = np.append(_starts(bucket), len(bucket))
            for a, b in zip(edges[:-1], edges[1:]):
                part = [table.column(c).to_numpy()[a:b] for c in ("doc", *columns)]
                order = np.lexsort(part[::-1])
                doc = part[0][order]
                starts = _starts(doc)
                extra = b"".join(np.ascontiguousarray(x[order]).tobytes() for x in part[1:])
                path = write_arrays(folder, [doc[starts].astype("<i8"), starts.astype("<i8"),
                                             np.diff(np.append(starts, len(doc))).astype("<i8")], extra)
                yield pa.RecordBatch.from_pylist([{
                    "path": path, "n_rows": len(starts), "first": int(doc[0]), "extra": len(extra)}])

    made = saved(rows.repartition(buckets, "bucket").sortWithinPartitions("bucket")
                 .mapInArrow(trimmed(run), "path string, n_rows long, first long, extra long"), "by-document")
    return ByDocument([(r.path, r.n_rows, r.first, r.extra) for r in made.collect()], len(columns))


class ByDocument(SortedTable):
    """Rows of 64-bit numbers for each document, over several files."""

    def __init__(self, files, columns):
        super().__init__(files, ("<i8",) * 3)
        self.columns = columns

    def rows(self, docs):
        """For sorted distinct ids the number of rows of each, and their columns one id after the other."""
        place, (start, count) = self.find(docs, (1, 2))
        made = [np.zeros((self.columns, 0), np.int64)]
        known = np.flatnonzero(place >= 0)
        for i, some in self.by_file(place[known]):
            path, size, _, length = self.files[i]
            extra = mapped(path, size, self.kinds, length)[1].view("<i8").reshape(self.columns, -1)
            made.append(extra[:, ranges(start[known[some]], count[known[some]])])
        return count, np.concatenate(made, axis=1)


def _asked(units, owner, count, known):
    """What is said of each unit of a block: 0 or a verdict. ``owner`` is the place of each text's id in ``count``."""
    said = np.zeros(len(units.h), np.int64)
    if not len(known):
        return said
    known = known.view(np.uint64)
    names, of = known & ~FLAGS, np.repeat(np.arange(len(count)), count)
    order = np.lexsort((of, names))
    names, of, known = names[order], of[order], known[order]
    name = units.name
    # Most units are unknown: a table of the first bits of names tells nearly all of them.
    table = np.zeros(1 << 16, bool)
    table[names >> np.uint64(48)] = True
    some = np.flatnonzero(table[name >> np.uint64(48)])
    mine, name = owner[units.text[some]], name[some]
    low, high = np.searchsorted(names, name), np.searchsorted(names, name, "right")
    # A name that several documents hold stands once for each, in their order.
    while (low < high).any():
        middle = (low + high) >> 1
        ahead = of[np.minimum(middle, len(of) - 1)] < mine
        open_ = low < high
        low, high = np.where(open_ & ahead, middle + 1, low), np.where(open_ & ~ahead, middle, high)
    low = np.minimum(low, len(names) - 1)
    hit = (names[low] == name) & (of[low] == mine)
    said[some[hit]] = (known[low[hit]] & FLAGS).astype(np.int64)
    return said


def _pieces(offsets):
    """First and next text of pieces of at most ``HASHED`` bytes or one text."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + HASHED, "right")) - 1)
        yield first, last
        first = last


def _doubt_rows(verdicts):
    """Pass 2: rows ``key, relative, bytes, doc, crc, place, flag`` of units and windows in doubt; flag 1: covered."""
    names = ["key", "relative", "bytes", "doc", "crc", "place", "flag"]

    def made(key, relative, starts, sizes, data, doc, crc, place, flag):
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        cells = pa.BinaryArray.from_buffers(
            pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data[ranges(starts, sizes)])])
        return pa.RecordBatch.from_arrays([
            pa.array(key.view(np.int64)), pa.array(relative.astype(np.int32)), cells, pa.array(doc), pa.array(crc),
            pa.array(place), pa.array(np.full(len(key), flag, np.int8))], names=names)

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, "text"):
                docs = _ids(part.column(0))
                distinct, owner = np.unique(docs, return_inverse=True)
                rows, (known,) = verdicts.rows(distinct)
                some = np.flatnonzero(rows[owner])
                docs, texts = docs[some], texts.take(pa.array(some))
                offsets, data = byte_block(texts)
                crc = np.array([zlib.crc32(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], np.int64)
                hot = []
                for low, high in _pieces(offsets):
                    inner, begin = offsets[low:high + 1] - offsets[low], offsets[low]
                    units = Units(data[begin:offsets[high]], inner)
                    mine = owner[some[low:high]]
                    ids, mine = np.unique(mine, return_inverse=True)
                    ends = np.cumsum(rows)[ids]
                    said = _asked(units, mine, rows[ids], known[ranges(ends - rows[ids], rows[ids])])
                    a = np.flatnonzero(said == DOUBT)
                    if len(a):
                        text, first = units.text[a] + low, units.first[a] + begin
                        yield made(units.h[a], units.anchor[a] - units.first[a], first, units.last[a] - units.first[a] + LENGTH,
                                   data, docs[text], crc[text], first - offsets[text], 0)
                    a = np.flatnonzero(said == DOUBT_HOT)
                    if len(a):
                        count = units.last[a] - units.first[a] + 1
                        at = ranges(units.first[a], count)
                        hot.append((at + begin, np.repeat(units.text[a] + low, count), mix(units.hashes.of(at, LENGTH))))
                if hot:
                    at, text, key = (np.concatenate(x) for x in zip(*hot))
                    order = np.lexsort((docs[text], key))
                    at, text, key = at[order], text[order], key[order]
                    starts = _starts(key)
                    lead = _spread(starts, starts, len(key))
                    covered = docs[text] > docs[text][lead]
                    check = np.flatnonzero(covered)
                    for j in range(0, len(check), 100_000):  # the bytes decide
                        few = check[j:j + 100_000]
                        covered[few] = _equal_cells(data, at[few], at[lead[few]], LENGTH)
                    for keep, flag in ((~covered, 0), (covered, 1)):
                        sizes = np.full(int(keep.sum()), 0 if flag else LENGTH)
                        yield made(key[keep], np.zeros(len(sizes)), at[keep], sizes, data,
                                   docs[text[keep]], crc[text[keep]], at[keep] - offsets[text[keep]], flag)

    return run


class SuffixSort:
    """Sorts suffixes of some bytes within groups, by a mergesort that compares through prefix hashes."""

    def __init__(self, data, limit=LENGTH):
        self.data, self.hashes, self.limit = data, PrefixHashes(data), limit

    def extension(self, a, b):
        """Length of the common extension of suffixes at ``a`` and ``b``, up to the limit."""
        up, down, sums = self.hashes.up, self.hashes.down, self.hashes.sums
        # Hashes of both, brought to the place of b: equal if their sums differ by ``shift``.
        factor = up[a] * down[b]
        shift = sums[a] * factor - sums[b]
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.limit)
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = sums[a + middle] * factor - sums[b + middle] == shift
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before(self, a, b, ties):
        """Whether suffix ``a`` comes before ``b``; equal ones as ``ties`` say."""
        common = self.extension(a, b)
        at = np.minimum(common, self.limit - 1)
        return np.where(common == self.limit, ties, self.data[a + at] < self.data[b + at])

    def sort(self, starts, group):
        """The order of the suffixes at ``starts`` within runs of equal ``group``."""
        n = len(starts)
        order = np.arange(n)
        edges = _starts(group)
        base = _spread(edges, edges, n)
        end = base + _spread(np.diff(np.append(edges, n)), edges, n)
        run, open_ = 1, np.flatnonzero(end - base > 1)
        while len(open_):
            number = (open_ - base[open_]) // run
            left = open_[(number & 1) == 0]
            right = open_[(number & 1) == 1]
            # Count the other run's suffixes that come before each of the left run.
            first = np.minimum(base[left] + ((left - base[left]) // run + 1) * run, end[left])
            low, high = first.copy(), np.minimum(first + run, end[left])
            todo = np.flatnonzero(low < high)
            mine, below, above = starts[order[left[todo]]], low[todo], high[todo]
            while len(todo):
                middle = (below + above) >> 1
                ahead = self.before(starts[order[middle]], mine, False)
                below, above = np.where(ahead, middle + 1, below), np.where(ahead, above, middle)
                low[todo] = below
                on = below < above
                todo, mine, below, above = todo[on], mine[on], below[on], above[on]
            # The right run's suffixes take the places between, in their order.
            place = left + low - first
            merged = order.copy()
            merged[place] = order[left]
            free = np.zeros(n, bool)
            free[open_] = True
            free[place] = False
            merged[free] = order[right]
            order = merged
            run *= 2
            open_ = open_[end[open_] - base[open_] > run]
        return order

    def classes(self, starts, group):
        """Order, and the class of each place in it: equal up to the limit, proven by the bytes."""
        order = self.sort(starts, group)
        at, of = starts[order], group[order]
        whole = self.hashes.of(at, self.limit)
        same = np.flatnonzero((whole[1:] == whole[:-1]) & (of[1:] == of[:-1]))
        new = np.ones(len(at), bool)
        for j in range(0, len(same), 100_000):
            some = same[j:j + 100_000]
            new[some + 1] = ~_equal_cells(self.data, at[some], at[some + 1], self.limit)
        return order, np.cumsum(new) - 1


def _runs(bounds, doc, crc, place):
    """Rows ``bucket, doc, crc, place, n`` of windows that follow one another."""
    order = np.lexsort((place, crc, doc))
    doc, crc, place = doc[order], crc[order], place[order]
    keep = _starts(doc, crc, place)
    doc, crc, place = doc[keep], crc[keep], place[keep]
    starts = _starts(doc, crc, place - np.arange(len(place)))
    return pa.RecordBatch.from_arrays([
        pa.array(np.searchsorted(bounds, doc[starts], "right").astype(np.int32)), pa.array(doc[starts]),
        pa.array(crc[starts]), pa.array(place[starts]), pa.array(np.diff(np.append(starts, len(doc))))],
        names=["bucket", "doc", "crc", "place", "n"])


def _covered_runs(bounds):
    """Shuffle 2: sort the suffixes of each key's units; rows of ``_runs``."""
    def run(batches):
        for table in _whole_groups(batches, "key", SORTED // 16):
            key, relative, doc, crc, place, flag = (
                table.column(c).to_numpy() for c in ("key", "relative", "doc", "crc", "place", "flag"))
            done = flag == 1
            if done.any():
                yield _runs(bounds, doc[done], crc[done], place[done])
            some = np.flatnonzero(~done)
            if not len(some):
                continue
            cells = table.column("bytes").combine_chunks().take(pa.array(some)).cast(pa.large_binary())
            key, relative, doc, crc, place = (x[some] for x in (key, relative, doc, crc, place))
            offsets, data = byte_block(cells)
            count = np.diff(offsets) - LENGTH + 1
            owner = np.repeat(np.arange(len(some)), count)
            inside = ranges(np.zeros(len(some), np.int64), count)
            # Equal windows have their anchor at the same place.
            spot = relative[owner] - inside
            order = np.lexsort((spot, key[owner]))
            owner, inside, spot = owner[order], inside[order], spot[order]
            starts = _starts(key[owner], spot)
            group = _spread(np.arange(len(starts)), starts, len(owner))
            order, classes = SuffixSort(data).classes(offsets[owner] + inside, group)
            owner, inside = owner[order], inside[order]
            first = np.minimum.reduceat(doc[owner], _starts(classes))
            hit = doc[owner] > first[classes]
            if hit.any():
                mine = owner[hit]
                yield _runs(bounds, doc[mine], crc[mine], place[mine] + inside[hit])

    return run


def _merged(begin, end, offsets):
    """The maximal runs of ranges within texts, and the text of each."""
    order = np.argsort(begin)
    begin, end = begin[order], end[order]
    text = np.searchsorted(offsets, begin, "right") - 1
    reach = np.maximum.accumulate(end)
    new = np.ones(len(begin), bool)
    new[1:] = (begin[1:] > reach[:-1]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(new)
    return begin[starts], reach[np.append(starts[1:], len(begin))[:len(starts)] - 1], text[starts]


def _pieces_left(data, offsets, begin, end, spans):
    """The bytes of each text without its runs."""
    bytes_ = memoryview(np.ascontiguousarray(data))
    begin, end, at = begin.tolist(), end.tolist(), 0
    kept = []
    for a, b, n in zip(offsets[:-1].tolist(), offsets[1:].tolist(), spans.tolist()):
        cuts = [a, *(x for run in zip(begin[at:at + n], end[at:at + n]) for x in run), b]
        kept.append(b"".join([bytes_[x:y] for x, y in zip(cuts[::2], cuts[1::2])]))
        at += n
    return kept


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _without(verdicts, runs, keep_bytes):
    """Pass 3: lay covered windows over each text."""
    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, "text", HASHED):
                docs = _ids(part.column(0))
                offsets, data = byte_block(texts)
                distinct, owner = np.unique(docs, return_inverse=True)
                count, (known,) = verdicts.rows(distinct)
                begins, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                some = np.flatnonzero(count[owner])
                if len(some):
                    inner, bytes_ = byte_block(texts.take(pa.array(some)))
                    units = Units(bytes_, inner)
                    said = _asked(units, owner[some], count, known) == COVERED
                    text = units.text[said]
                    shift = offsets[some][text] - inner[text]
                    begins.append(units.first[said] + shift)
                    ends.append(units.last[said] + LENGTH + shift)
                # Runs of each text: those of its id and its bytes.
                count, (crc, place, n) = runs.rows(distinct)
                some = np.flatnonzero(count[owner])
                if len(some):
                    mine = owner[some]
                    line = ranges((np.cumsum(count) - count)[mine], count[mine])
                    text = np.repeat(some, count[mine])
                    own = np.zeros(len(docs), np.int64)
                    own[some] = [zlib.crc32(data[offsets[i]:offsets[i + 1]]) for i in some]
                    fits = crc[line] == own[text]
                    line, text = line[fits], text[fits]
                    begins.append(offsets[text] + place[line])
                    ends.append(offsets[text] + place[line] + n[line] - 1 + LENGTH)
                begin, end, text = _merged(np.concatenate(begins), np.concatenate(ends), offsets)
                spans = np.bincount(text, minlength=len(docs))
                sums = np.concatenate([[0], np.cumsum(end - begin)])
                last = np.cumsum(spans)
                removed = sums[last] - sums[last - spans]
                kept = _pieces_left(data, offsets, begin, end, spans)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(np.diff(offsets)), pa.array(removed), pa.array(spans),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                    pa.array(kept if keep_bytes else [None] * len(kept), pa.binary())],
                    names=[x.split()[0] for x in REMOVED.split(", ")])

    return run


def remove_repeats(docs, id_col="doc_id", text_col="text", keep_bytes=True):
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every row.

    Removes each byte of the UTF-8 text that a string of ``LENGTH`` bytes covers
    which also starts in a document with a smaller id. ``n_spans`` counts the runs
    that go, ``kept`` is what is left (null without ``keep_bytes``). Strings are
    judged on the input and never cross texts. Null and short texts lose nothing.
    A null id comes after all others, rows with equal ids do not touch each other.
    Other columns are not looked at; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "repeats")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = texts.approxQuantile("doc_id", [i / buckets for i in range(1, buckets)], 0.2 / buckets)
    bounds = np.unique(np.array(cuts, np.float64).astype(np.int64)) if cuts else np.zeros(0, np.int64)

    found = texts.mapInArrow(trimmed(_units_rows), "h long, g long, doc long")
    # Rows that only pass through are dealt out by document, the others meet by anchor.
    met = found.repartition(F.when(F.col("g").bitwiseAND(2) > 0, F.xxhash64("h", "doc")).otherwise(F.col("h")))
    said = met.sortWithinPartitions("h").mapInArrow(trimmed(_verdicts(bounds)), "bucket int, doc long, said long")
    verdicts = _by_document(said, ("said",), folder, buckets)

    doubt = texts.mapInArrow(trimmed(_doubt_rows(verdicts)), "key long, relative int, bytes binary, doc long, crc long, place long, flag byte")
    met = doubt.repartition(F.when(F.col("flag") == 1, F.xxhash64("key", "doc", "place")).otherwise(F.col("key")))
    covered = met.sortWithinPartitions("key").mapInArrow(trimmed(_covered_runs(bounds)), "bucket int, doc long, crc long, place long, n long")
    runs = _by_document(covered, ("crc", "place", "n"), folder, buckets)
    return texts.mapInArrow(trimmed(_without(verdicts, runs, keep_bytes)), REMOVED)
