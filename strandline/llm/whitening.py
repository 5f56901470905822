"""Whitening of embeddings by incremental eigendecomposition.

Every partition keeps the spectrum (mean, eigenvalues, eigenvectors) of the vectors that
it has seen.  A vector changes the scatter by a centred rank-one update, whose new
eigenvalues are the roots of a secular equation; parts that the update does not touch,
and all but one direction of equal eigenvalues, are deflated.  Spectra are combined by
more such updates: one for each direction of the smaller one and one for the distance
of the means, in a tree.  A last pass projects all vectors on the basis found and solves
what is left between its directions (Rayleigh-Ritz), so rounding of the many updates
does not stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import written

#: An entry c becomes the whole number floor(STEPS * c) + SHIFT.
STEPS = 64
SHIFT = 1_000_000
COMPONENTS = 32
#: Spectra that one task combines.
TOGETHER = 16
#: Vectors between two orthonormalisations of a spectrum.
TIDY = 256
_EPS = float(np.finfo(np.float64).eps)


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + rho * sum(z2 / (d - x))``: each as the index of its nearest pole
    and the distance from it.

    ``d`` rises strictly, ``z2`` (squares) is positive, ``rho`` positive: one root lies
    above each pole and below the next.  A step fits one pole below and one above to the
    sums on either side of the root and takes the root of that; where it leaves the
    bracket, the middle is taken.
    """
    n = len(d)
    room = np.append(np.diff(d), rho * z2.sum())
    index = np.arange(n)
    # The half of its interval that holds the root decides the pole to measure from.
    middle = d + room / 2
    at_middle = 1 + rho * (z2 / (d - middle[:, None])).sum(axis=1)
    right = (at_middle < 0) & (index < n - 1)
    pole = index + right
    delta = d - d[pole][:, None]
    low = np.where(right, -room / 2, np.where(at_middle < 0, room / 2, 0.0))
    high = np.where(right, 0.0, np.where(at_middle < 0, room, room / 2))
    x = (low + high) / 2
    left_pole = delta[index, index]
    right_pole = delta[index, np.minimum(index + 1, n - 1)]
    weight = rho * z2
    open_ = index
    for _ in range(60):
        y = x[open_]
        gap = delta[open_] - y[:, None]
        term = weight / gap
        value = 1 + term.sum(axis=1)
        done = np.abs(value) <= 16 * _EPS * (1 + np.abs(term).sum(axis=1))
        if done.all():
            break
        low[open_] = np.where(value < 0, y, low[open_])
        high[open_] = np.where(value < 0, high[open_], y)
        if done.any():
            open_, y, value = open_[~done], y[~done], value[~done]
            term, gap = term[~done], gap[~done]
        term /= gap
        slope = term.sum(axis=1)
        slope_low = np.where(index <= open_[:, None], term, 0.0).sum(axis=1)
        last = open_ == n - 1
        slope_high = np.where(last, 0.0, slope - slope_low)
        a, b = left_pole[open_] - y, right_pole[open_] - y
        # value(y) = c + s / (a - y) + t / (b - y), with equal value and slopes.
        s, t = slope_low * a * a, slope_high * b * b
        c = value - slope_low * a - slope_high * b
        p = c * (a + b) + s + t
        q = c * a * b + s * b + t * a
        root = np.sqrt(np.maximum(p * p - 4 * c * q, 0.0))
        big = (p + np.where(p >= 0, root, -root)) / 2
        least, most = low[open_], high[open_]
        with np.errstate(divide="ignore", invalid="ignore"):
            one, two = q / big, big / c
            step = np.where((y + one > least) & (y + one < most), one, two)
            step = y + np.where(last, a + s / c, step)
        x[open_] = np.where((step > least) & (step < most), step, (least + most) / 2)
    return pole, x


@dataclass
class Spectrum:
    """``n`` vectors with their ``mean``; the scatter around it is
    ``basis @ diag(values) @ basis.T``, values rising."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @staticmethod
    def empty(size: int) -> Spectrum:
        return Spectrum(0, np.zeros(size), np.zeros(size), np.eye(size))

    def add(self, vector: np.ndarray, times: int = 1) -> None:
        """Take in a vector, ``times`` times."""
        total = self.n + times
        away = vector - self.mean
        if self.n:
            self.update(away, self.n * times / total)
        self.mean = self.mean + away * (times / total)
        self.n = total

    def update(self, vector: np.ndarray, rho: float) -> None:
        """Add ``rho`` times the outer product of ``vector`` to the scatter."""
        length = float(vector @ vector)
        if not length:
            return
        values, basis = self.values, self.basis
        z = vector @ basis
        scale = max(float(values[-1]), rho * length)
        same = np.flatnonzero(np.diff(values) <= 8 * _EPS * scale)
        if len(same):
            # Among equal values a reflection turns all of z into one direction.
            edges = np.flatnonzero(np.diff(same) > 1)
            for a, b in zip(same[np.append(0, edges + 1)], same[np.append(edges, -1)] + 2):
                part = z[a:b].copy()
                norm = np.sqrt(part @ part)
                if norm:
                    part[-1] += norm if part[-1] >= 0 else -norm
                    basis[:, a:b] -= np.outer(basis[:, a:b] @ part, part * (2 / (part @ part)))
                    z[a : b - 1] = 0.0
                    z[b - 1] = -norm if part[-1] > 0 else norm
        live = np.flatnonzero(rho * np.abs(z) * np.sqrt(length) > 8 * _EPS * scale)
        if not len(live):
            return
        d, w = values[live], z[live]
        # Values within rounding of each other, but in different runs, count as equal.
        pole, x = secular_roots(d, w * w, rho)
        gap = (d - d[pole][:, None]) - x[:, None]
        gap[gap == 0] = np.finfo(np.float64).tiny
        turn = w / gap
        turn /= np.sqrt((turn * turn).sum(axis=1))[:, None]
        values = values.copy()
        values[live] = d[pole] + x
        basis[:, live] = basis[:, live] @ turn.T
        order = np.argsort(values, kind="stable")
        self.values, self.basis = values[order], basis[:, order]

    def tidy(self) -> None:
        """Take the rounding of many updates out of the basis."""
        basis, upper = np.linalg.qr(self.basis)
        self.basis = basis * np.where(np.diag(upper) < 0, -1.0, 1.0)

    def join(self, other: Spectrum) -> None:
        """Take in all vectors of another spectrum."""
        if not other.n:
            return
        if not self.n:
            self.n, self.mean = other.n, other.mean
            self.values, self.basis = other.values, other.basis.copy()
            return
        for value, vector in zip(other.values, other.basis.T):
            if value > 0:
                self.update(vector, float(value))
        total = self.n + other.n
        away = other.mean - self.mean
        self.update(away, self.n * other.n / total)
        self.mean = self.mean + away * (other.n / total)
        self.n = total
        self.tidy()


SPECTRUM = "n bigint, mean array<double>, values array<double>, basis array<double>"
Fit = dict[str, object]


def _matrix(array: pa.Array, size: int, kind: type = np.float64) -> np.ndarray:
    return array.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, size)


def whole(vectors: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """The rows of ``vectors`` with a usable vector, and the length of all of them.

    Not usable is a vector that is null or empty or holds null or non-finite entries, or
    that has another length than most usable ones (of equally many the longest).
    """
    entry = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    usable = vectors.filter(F.size(vector) > 0).filter(~F.exists(vector, entry))
    sizes = usable.groupBy(F.size(vector).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.agg(F.max_by("size", F.struct("n", "size"))).first()[0] or 0
    return usable.filter(F.size(vector) == most), most


def stepped(values: np.ndarray) -> np.ndarray:
    """Entries as whole numbers, without the shift."""
    return np.floor(STEPS * values)


def spectra(vectors: DataFrame, vector: str, size: int) -> DataFrame:
    """The spectrum of each partition of ``vectors``; repeated vectors of a batch are one
    update."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum.empty(size)
        since = 0
        for batch in batches:
            x, times = np.unique(stepped(_matrix(batch.column(0), size)), axis=0, return_counts=True)
            for row, n in zip(x, times.tolist()):
                own.add(row, n)
                since += 1
                if since % TIDY == 0:
                    own.tidy()
        yield packed(own)

    return vectors.select(vector).mapInArrow(run, SPECTRUM)


def packed(s: Spectrum) -> pa.RecordBatch:
    rows = [[s.n], [s.mean.tolist()], [s.values.tolist()], [s.basis.ravel().tolist()]]
    kinds = [pa.int64(), *[pa.list_(pa.float64())] * 3]
    return pa.RecordBatch.from_arrays(
        [pa.array(r, k) for r, k in zip(rows, kinds)], ["n", "mean", "values", "basis"]
    )


def combined(parts: DataFrame, size: int) -> Spectrum:
    """All spectra as one, ``TOGETHER`` at a time in rounds of tasks; only the last one
    goes to the driver."""

    def merge(group: pa.Table) -> pa.Table:
        total = Spectrum.empty(size)
        for r in group.sort_by("turn").to_pylist():
            basis = np.array(r["basis"]).reshape(size, size)
            total.join(Spectrum(r["n"], np.array(r["mean"]), np.array(r["values"]), basis))
        return pa.Table.from_batches([packed(total)])

    turn = F.monotonically_increasing_id().alias("turn")
    state = written(parts.filter("n > 0").select(turn, "*"), "spectra")
    while (n := state.count()) > 1:
        # Dense numbers of the groups from those of the rows: a hash deals them out.
        group = F.pmod(F.xxhash64("turn"), F.lit(-(-n // TOGETHER)))
        merged = state.groupBy(group.alias("group")).applyInArrow(merge, SPECTRUM)
        state = written(merged.select(turn, "*"), "spectra")
    last = state.first()
    if last is None:
        return Spectrum.empty(size)
    basis = np.array(last["basis"]).reshape(size, size)
    return Spectrum(last["n"], np.array(last["mean"]), np.array(last["values"]), basis)


def summed(
    vectors: DataFrame, vector: str, size: int, of: Callable[[np.ndarray], np.ndarray], kind: str
) -> np.ndarray | None:
    """The sum of ``of`` (matrix of stepped vectors to a flat array) over all batches: each
    task adds its own, then place by place; only the sums go to the driver."""
    whole_numbers = kind == "bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(stepped(_matrix(batch.column(0), size)))
                total = part if total is None else total + part
        if total is not None:
            made = total.astype(np.int64 if whole_numbers else np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(made))), pa.array(made)], ["place", "value"]
            )

    parts = vectors.select(vector).mapInArrow(run, f"place bigint, value {kind}")
    added = F.sum(F.col("value").cast("decimal(38,0)") if whole_numbers else F.col("value"))
    rows = parts.groupBy("place").agg(added.alias("value")).orderBy("place").collect()
    if not rows:
        return None
    return np.array([int(r["value"]) if whole_numbers else r["value"] for r in rows], object if whole_numbers else np.float64)


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Fit:
    """What whitening needs of all usable rows of ``vectors``: ``size``, ``n``, ``sums`` (exact,
    of the whole numbers), ``values`` (falling eigenvalues of the covariance), ``directions``
    (their unit eigenvectors as columns), ``trace``, ``kept`` (how many of at most
    ``components`` have an eigenvalue above rounding) and ``identity_error``.

    No usable row, or vectors that are all equal, keep no component.
    """
    rows, size = whole(vectors, vector)
    if not size:
        return {"size": 0, "n": 0, "kept": 0}
    tally = summed(rows, vector, size, lambda x: np.append(x.sum(axis=0), len(x)), "bigint")
    n, steps = int(tally[-1]), tally[:-1]
    mean = np.array([float(s // n) + (s % n) / n for s in steps])
    basis = combined(spectra(rows, vector, size), size).basis
    basis = np.linalg.qr(basis)[0]

    # Rayleigh-Ritz: the covariance between the directions of the basis, over all rows.
    def outer(x: np.ndarray) -> np.ndarray:
        y = (x - mean) @ basis
        return (y.T @ y).ravel()

    between = summed(rows, vector, size, outer, "double").reshape(size, size) / n
    values, turn = np.linalg.eigh((between + between.T) / 2)
    values, directions = values[::-1], (basis @ turn)[:, ::-1]
    trace = float(np.trace(between))
    kept = int((values[:components] > size * 64 * _EPS * max(values[0], 0.0)).sum())
    found: Fit = {
        "size": size, "n": n, "sums": [int(s) + n * SHIFT for s in steps], "steps": steps,
        "mean": mean, "values": values, "directions": directions, "trace": trace, "kept": kept,
        "identity_error": 0.0,
    }
    if kept:
        white = whitener(found)

        def spread(x: np.ndarray) -> np.ndarray:
            w = white(x)
            return np.append((w.T @ w).ravel(), w.sum(axis=0))

        both = summed(rows, vector, size, spread, "double") / n
        covariance = both[: kept * kept].reshape(kept, kept)
        centre = both[kept * kept :]
        left = covariance - np.outer(centre, centre) - np.eye(kept)
        found["identity_error"] = float(np.abs(left).max())
    return found


def whitener(found: Fit) -> Callable[[np.ndarray], np.ndarray]:
    kept = found["kept"]
    scaled = found["directions"][:, :kept] / np.sqrt(found["values"][:kept])
    mean = found["mean"]
    return lambda x: (x - mean) @ scaled


def deviations(x: np.ndarray, n: int, steps: np.ndarray) -> list[int]:
    """Exact squared lengths of ``n * x - sums`` for every row."""
    most = n * int(np.abs(x).max(initial=0)) + max(abs(int(s)) for s in steps)
    if most * most * x.shape[1] < 1 << 62:
        away = n * x.astype(np.int64) - steps.astype(np.int64)
        return (away * away).sum(axis=1).tolist()
    away = n * x.astype(np.int64).astype(object) - steps
    return (away * away).sum(axis=1).tolist()


def whitened(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """For every usable row of ``vectors`` (see ``whole``): ``vec_id``, ``n`` (usable rows),
    ``deviation`` (exact, decimal), ``whitened`` (its coordinates on the components that
    ``fit`` keeps), ``explained`` (their shares of the trace) and ``identity_error``.

    Repeated rows count each and stay repeated; null ids stay null.  Components with an
    eigenvalue of zero have no scale and are left out, so an empty table gives no rows
    and equal vectors give empty lists.
    """
    found = fit(vectors, vector, components)
    kind = vectors.schema[vec_id].dataType.simpleString()
    schema = (
        f"vec_id {kind}, n bigint, deviation decimal(38,0), whitened array<double>, "
        "explained array<double>, identity_error double"
    )
    if not found["n"]:
        return vectors.sparkSession.createDataFrame([], schema)
    size, n, kept, steps = found["size"], found["n"], found["kept"], found["steps"]
    explained = (found["values"][:kept] / found["trace"]).tolist() if kept else []
    white, error = whitener(found) if kept else None, found["identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            x = stepped(_matrix(batch.column(1), size))
            flat = white(x).ravel() if kept else np.zeros(0)
            ends = pa.array(np.arange(rows + 1, dtype=np.int32) * kept)
            shares = pa.array(np.tile(explained, rows)).cast(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(np.full(rows, n)),
                    pa.array(deviations(x, n, steps)).cast(pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(ends, pa.array(flat)),
                    pa.ListArray.from_arrays(ends, shares), pa.array(np.full(rows, error)),
                ],
                ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    rows = whole(vectors, vector)[0]
    return rows.select(F.col(vec_id).alias("vec_id"), F.col(vector)).mapInArrow(run, schema)
