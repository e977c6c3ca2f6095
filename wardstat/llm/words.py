"""Words of Arrow text columns, coded so that each distinct word is looked at once per block."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from wardstat.llm.blocks import byte_block


def word_cells(column, lower=True):
    """Number of words of each text, and all words, parted by ASCII white space, A-Z lower-cased.

    The words come as an Arrow dictionary column: codes and distinct values.
    """
    offsets, data = byte_block(column)
    ink = (data != 32) & (data - np.uint8(9) > 4)  # bytes wrap around: 9 to 13 are white space
    begins, lasts = ink.copy(), ink.copy()
    if len(data):
        begins[1:] &= ~ink[:-1]
        lasts[:-1] &= ~ink[1:]
        at = offsets[:-1][np.diff(offsets) > 0]
        begins[at] = ink[at]
        lasts[at[1:] - 1] = ink[at[1:] - 1]
    letters = data[ink]
    if lower:
        letters = letters | ((letters - np.uint8(65) < 26).view(np.uint8) << 5)
    begin = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(begin, offsets))
    starts = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(np.flatnonzero(lasts) + 1 - begin, out=starts[1:])
    cells = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begin), [None, pa.py_buffer(starts), pa.py_buffer(np.ascontiguousarray(letters))])
    return counts, cells.dictionary_encode()
