"""Vector columns: which rows count, their whole-number form, Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from wardstat.functions.names import column
from wardstat.llm.blocks import ranges

#: Parts of one that the whole-number form keeps.
UNIT = 256


def doubles(name):
    """A vector column as an array of doubles."""
    return column(name).cast("array<double>")


def finite(vector):
    """Whether a vector is there and all its entries are numbers; one without entries is."""
    whole = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vector.isNotNull() & whole


def whole(vector):
    """``floor(256 c)`` of every entry, as longs."""
    return F.transform(vector, lambda c: F.floor(c * UNIT))


def matrix(cells, width, kind):
    """An Arrow list column as a matrix; a shorter list stands for one with zeros at its end."""
    lengths = cells.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = cells.flatten().to_numpy(zero_copy_only=False).astype(kind)
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    made = np.zeros((len(lengths), width), kind)
    made[np.repeat(np.arange(len(lengths)), lengths), ranges(np.zeros(len(lengths), np.int64), lengths)] = values
    return made
