"""Whitening of embeddings along their leading components, found by spectrum slicing.

The vectors are taken as whole numbers. Distinct ones are counted once; their
sums and their covariance are gathered by Spark in two passes with one partial
result for each task, so only numbers of the vectors' dimension reach the driver.
There the spectrum of the covariance is sliced: the signs of the pivots of an
LDLᵀ factorization of the shifted matrix say how many eigenvalues lie above the
shift, bisection by these counts isolates each leading eigenvalue, Rayleigh
quotient iteration finishes it, and two more counts prove its number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from wardstat.functions.names import column
from wardstat.llm.blocks import saved, trimmed
from wardstat.llm.vectors import doubles, finite, matrix, whole

COMPONENTS = 4
#: Rows handled together.
ROWS = 8192
#: Pivot rule of the factorization, (1 + sqrt 17) / 8.
ALPHA = 0.6403882032022076
#: Eigenvalues nearer than this part of the largest count as equal; one below it as none.
TIE = 1e-12
MOST_STEPS = 60


def count_above(symmetric, shift):
    """Number of eigenvalues above the shift: positive pivots of LDLᵀ with pivots of one or two rows."""
    rest = symmetric - shift * np.eye(len(symmetric))
    positive = 0
    while len(rest):
        diagonal = np.abs(rest.diagonal())
        away = np.abs(rest - np.diag(rest.diagonal()))
        p, (r, s) = int(diagonal.argmax()), np.unravel_index(away.argmax(), away.shape)
        if not max(diagonal[p], away[r, s]):
            break  # the rest are eigenvalues equal to the shift
        if diagonal[p] >= ALPHA * away[r, s]:
            picked = [p]
            positive += bool(rest[p, p] > 0)
        else:  # the determinant is negative: one eigenvalue on each side
            picked = [int(r), int(s)]
            positive += 1
        others = np.delete(np.arange(len(rest)), picked)
        side = rest[np.ix_(others, picked)]
        rest = rest[np.ix_(others, others)] - side @ np.linalg.solve(rest[np.ix_(picked, picked)], side.T)
        rest = (rest + rest.T) / 2
    return positive


def _solved(symmetric, shift, right, scale):
    """``(symmetric - shift)^-1 right``, of length one."""
    for nudge in (0, 1, 3):
        try:
            made = np.linalg.solve(symmetric - (shift + nudge * 4e-16 * scale) * np.eye(len(symmetric)), right)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(made).all() and made.any():
            return made / np.linalg.norm(made / np.abs(made).max()) / np.abs(made).max()
    return right


def _iterated(symmetric, low, high, found, scale):
    """Rayleigh quotient iteration that starts inside an interval; value, vector and residual of its end."""
    def free(vector):
        for _ in range(2):
            for other in found:
                vector = vector - other * (other @ vector)
        return vector / np.linalg.norm(vector)

    start = np.random.default_rng(len(found)).standard_normal(len(symmetric))
    vector = free(start)
    for _ in range(2):
        vector = free(_solved(symmetric, (low + high) / 2, vector, scale))
    best = None
    for _ in range(MOST_STEPS):
        value = vector @ symmetric @ vector
        residual = np.linalg.norm(symmetric @ vector - value * vector)
        if best is not None and residual >= best[2] / 2:
            break
        best = (value, vector, residual)
        vector = free(_solved(symmetric, value, vector, scale))
    return best


def leading(symmetric, most=COMPONENTS):
    """The largest eigenvalues of a positive semidefinite matrix and their unit vectors, in falling order.

    Eigenvalues within ``TIE`` of the largest above zero are left out, so fewer
    than ``most`` may come back. Each is proven to have its number: no more
    eigenvalues than come before it lie above it, by ``TIE`` of the largest.
    """
    if not len(symmetric) or not np.abs(symmetric).max():
        return np.zeros(0), np.zeros((0, len(symmetric)))
    scale = float(np.abs(symmetric).sum(axis=1).max())  # no eigenvalue is larger
    tie = TIE * scale
    counts = {0.0: len(symmetric), scale * (1 + 1e-9): 0}

    def above(shift):
        if shift not in counts:
            counts[shift] = count_above(symmetric, shift)
        return counts[shift]

    least = above(tie)
    values, vectors = [], []
    for number in range(1, min(most, least) + 1):
        low = max(s for s, n in counts.items() if n >= number)
        high = min(s for s, n in counts.items() if n < number and s > low)
        made = None
        while made is None:
            middle = (low + high) / 2
            narrow = high - low <= tie or not low < middle < high
            if narrow or above(low) == number and above(high) == number - 1:
                value, vector, residual = _iterated(symmetric, low, high, vectors, scale)
                if narrow or low - tie <= value <= high + tie and residual <= tie:
                    if above(value + tie) < number <= above(value - tie):
                        made = value, vector
                    elif narrow:
                        raise ArithmeticError(f"eigenvalue {number} near {value} is not certified by the counts")
            if made is None:
                low, high = (middle, high) if above(middle) >= number else (low, middle)
        values.append(made[0])
        vectors.append(made[1])
    return np.array(values), np.array(vectors)


def _added(rows, width, run, names, kind="double"):
    """Sums of the vectors that ``run`` makes of matrices of longs, one result of each task."""
    def task(batches):
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                made = run(matrix(batch.column(0).slice(at, ROWS), width, np.int64))
                total = made if total is None else [a + b for a, b in zip(total, made)]
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total[0]), dtype=np.int64)), *map(pa.array, total)], names=["cell", *names])

    schema = ", ".join(["cell long", *(f"{n} {kind}" for n in names)])
    added = rows.mapInArrow(trimmed(task), schema).groupBy("cell").agg(
        *(F.sum(n).alias(n) for n in names))
    return added.orderBy("cell").collect()  # as many rows as a vector or a square of it has entries


class Whitening:
    """Mean and leading components of a list of distinct vectors of whole numbers."""

    def __init__(self, n, sums):
        self.n, self.sums = n, sums
        self.values = self.vectors = np.zeros((0, len(sums)))
        self.trace = self.identity_error = 0.0

    @property
    def width(self):
        return len(self.sums)

    def centred(self, x):
        """``x - S / n`` in doubles: whole parts first, so that little is lost."""
        middle = [s // self.n for s in self.sums]
        rest = np.array([float(s - m * self.n) / self.n for s, m in zip(self.sums, middle)])
        return x.astype(np.float64) - np.array(middle, np.float64) - rest

    def whitened(self, x):
        return self.centred(x) @ (self.vectors / np.sqrt(self.values)[:, None]).T

    def deviation(self, x):
        """Sum of ``(n x - S)^2`` of every row, exact, as a list of Python integers."""
        most = max([1, *map(abs, self.sums), int(np.abs(x.astype(np.float64)).max(initial=0))])
        small = most * most * max(1, x.shape[1]) < 1 << 62
        kind = np.int64 if small else object
        x, sums = x.astype(kind), np.array(self.sums, kind)
        squares, mixed = (x * x).sum(axis=1).tolist(), (x * sums).sum(axis=1).tolist()
        constant = sum(s * s for s in self.sums)
        return [self.n * self.n * a - 2 * self.n * b + constant for a, b in zip(squares, mixed)]


def fit(docs, vector_col="embedding", components=COMPONENTS):
    """The ``Whitening`` of the distinct vectors of a table; None if it has none."""
    vector = doubles(vector_col)
    listed = saved(docs.where(finite(vector)).select(whole(vector).alias("x")).distinct(), "distinct-vectors")
    n, width = listed.agg(F.count("*"), F.max(F.size("x"))).first()
    if not n:
        return None
    if listed.where(F.size("x") != width).limit(1).count():  # zeros at the end may make more of them equal
        zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))
        listed = saved(listed.select(F.concat("x", zeros).alias("x")).distinct(), "distinct-vectors")
        n = listed.count()

    def sums(x):  # in halves of 32 bits, which cannot overflow
        return [(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]

    made = Whitening(n, [(r.high << 32) + r.low for r in _added(listed, width, sums, ["high", "low"], "long")])
    upper = np.triu_indices(width)

    def products(x):
        z = made.centred(x)
        return [(z.T @ z)[upper]]

    covariance = np.zeros((width, width))
    covariance[upper] = [r.v / n for r in _added(listed, width, products, ["v"])]
    covariance = np.triu(covariance) + np.triu(covariance, 1).T
    made.values, made.vectors = leading(covariance, components)
    made.trace = float(covariance.trace())
    k = len(made.values)
    if k:
        def moments(x):
            w = made.whitened(x)
            return [np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])]

        total = np.array([r.v / n for r in _added(listed, width, moments, ["v"])])
        spread = total[k:].reshape(k, k) - np.outer(total[:k], total[:k])
        made.identity_error = float(np.abs(spread - np.eye(k)).max())
    return made


SCHEMA = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
          "identity_error double")


def whiten(docs, id_col="vec_id", vector_col="embedding", components=COMPONENTS):
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every row and component.

    Rows whose vector is null or holds null or non-finite entries are left out.
    Entries become ``floor(256 c)``, at the ends of a long where they would pass
    them. A shorter vector stands for one with zeros at its end, so one without
    entries is all zeros. ``n`` distinct vectors with sums ``S`` are fitted;
    ``deviation`` is the sum of ``(n x - S)^2``, exact, null beyond 38 digits.
    ``whitened`` is ``x - S / n`` along the component over the root of its
    eigenvalue, ``explained`` the eigenvalue's part of the trace. A component
    without spread has no rows, so a single vector, or an empty table, gives
    none. Repeated rows and null ids are carried through; other columns are not
    looked at. The driver holds one covariance, the square of the vectors'
    dimension, whatever the number of rows.
    """
    model = fit(docs, vector_col, components)
    spark = docs.sparkSession
    if model is None or not len(model.values):
        return spark.createDataFrame([], SCHEMA)
    k = len(model.values)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = matrix(part.column(1), model.width, np.int64)
                deviation = [d if abs(d) < 10 ** 38 else None for d in model.deviation(x)]
                each = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), model.n)),
                    pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(each)),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(model.values / model.trace, len(x))),
                    pa.array(np.full(len(each), model.identity_error))],
                    names=[c.split()[0] for c in SCHEMA.replace("(38,0)", "").split(", ")])

    vector = doubles(vector_col)
    rows = docs.where(finite(vector)).select(column(id_col).cast("long").alias("vec_id"), whole(vector).alias("x"))
    return rows.mapInArrow(trimmed(run), SCHEMA)
