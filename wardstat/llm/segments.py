"""Encode text with the tokenizers library, each distinct piece of text once per block.

Both vocabularies split a text into runs of one character class before any
merge, so a text may be cut beforehand wherever such a run surely ends: before
a run of ASCII white space, and between ASCII letters, digits and punctuation.
The pieces of a block become a dictionary column, only its distinct values are
encoded, and the ids are gathered back. Texts for which a cut could matter
(white space beyond ASCII, the text of a special token) are encoded whole.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from wardstat.llm.blocks import byte_block, ranges

SPACE, LETTER, DIGIT, MARK, OTHER = range(5)
# Apostrophes join letters in contractions, bytes beyond ASCII may be anything.
CLASSES = np.array([
    SPACE if b in b"\t\n\x0b\x0c\r " else OTHER if b >= 128 or b == 39 or b < 32 or b == 127
    else LETTER if chr(b).isalpha() else DIGIT if chr(b).isdigit() else MARK
    for b in range(256)], np.uint8)
ODD_SPACE = r"[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
ENTRIES = 150_000


class Encoder:
    """Ids of texts; remembers at most ``entries`` pieces."""

    def __init__(self, tokenizer, whole=(), lower=False, entries=ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = tokenizer
        self.whole = "|".join([ODD_SPACE, *whole])
        self.lower, self.entries = lower, entries
        self.known = {}
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    def learn(self, pieces):
        """Place of each of the pieces, and starts, lengths and ids to read there.

        The first ``entries`` distinct pieces are remembered, the frequent ones
        among them; others are encoded anew for each block.
        """
        known, room = self.known, self.entries - len(self.known)
        new = [p for p in pieces if p not in known]
        lists = []
        for at in range(0, len(new), 5_000):
            lists += [np.array(e.ids, np.uint32) for e in
                      self.tokenizer.encode_batch_fast(new[at:at + 5_000], add_special_tokens=False)]
        lengths = np.array([len(x) for x in lists], np.int64)
        starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        lengths = np.concatenate([self.lengths, lengths])
        ids = np.concatenate([self.ids, *lists])
        first = len(known)
        place = {p: first + i for i, p in enumerate(new)}
        row = np.fromiter((known[p] if p in known else place[p] for p in pieces), np.int64, len(pieces))
        if room > 0 and new:
            known.update((p, place[p]) for p in new[:room])
            kept = len(known)
            self.starts, self.lengths = starts[:kept].copy(), lengths[:kept].copy()
            self.ids = ids[:self.starts[-1] + self.lengths[-1]].copy()
        return row, starts, lengths, ids

    def __call__(self, column):
        """Number of ids of each text of a column from ``text_column``, and all ids in order."""
        offsets, data = byte_block(column)
        plain = ~np.asarray(pc.match_substring_regex(column, self.whole).fill_null(False))
        kind = CLASSES[data]
        if self.lower:  # the tokenizer would do the same, piece by piece
            capital = (data >= 65) & (data <= 90)
            if not plain.all():
                capital &= np.repeat(plain, np.diff(offsets))
            data = data | (capital.view(np.uint8) << 5)
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        if len(data) > 1:
            a, b = kind[:-1], kind[1:]
            inside = ((b == SPACE) & (a != SPACE)) | (
                (a != b) & (a != SPACE) & (a != OTHER) & (b != OTHER))
            if not plain.all():
                inside &= np.repeat(plain, np.diff(offsets))[1:]
            cut[1:-1] |= inside
        cut[len(data)] = False
        starts = np.flatnonzero(cut)
        bounds = np.append(starts, len(data))
        # Empty texts hold no piece; every other text starts one.
        pieces = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
        if not len(starts):
            return np.zeros(len(column), np.int64), np.zeros(0, np.uint32)
        cells = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
        coded = cells.dictionary_encode()
        row, starts, lengths, ids = self.learn(coded.dictionary.to_pylist())
        row = row[np.asarray(coded.indices)]
        lengths = lengths[row]
        ids = ids[ranges(starts[row], lengths)]
        totals = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(pieces)
        return totals[ends] - totals[ends - pieces], ids
