"""Embedding whitening by an incrementally updated eigendecomposition.

Each partition keeps the spectrum (count, mean, eigenvalues, eigenvectors) of the scatter of the vectors seen so
far. New vectors arrive in blocks; an orthogonal transform turns a block's centred rows into at most as many
rows as there are dimensions without changing their scatter, and each of these, and the shift between the two
means, is a rank-one update: the new eigenvalues are the roots of a secular equation, found between the old ones,
and the eigenvectors follow from them. Directions that the update does not touch and repeated eigenvalues are
deflated first. Spectra of partitions are combined the same way, one update per eigenpair of the smaller one, a
bounded number of spectra per task and level. A last pass projects all vectors on the directions found and
solves the small problem that is left (Rayleigh-Ritz), so components are right to double precision however
rounding went in the updates.

Vectors are quantized: an entry c becomes floor(64 * c) + 1,000,000. Sums and deviations are exact integers.

Rows: a vector that is NULL or holds a NULL or non-finite entry takes no part, nor does one whose quantized
entries are no longs. All other rows are returned, repeated ones and those without an id too. A shorter vector
stands for itself with zeros behind it. No row gives no row. Components without variance (equal vectors, fewer
vectors than dimensions) have ``whitened`` NULL and do not enter ``identity_error``. ``deviation`` is NULL where
it is no long any more; ``deviation_exact`` has it as text at any size. Memory is that of a block and some
matrices of dimensions times dimensions.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import written
from tidemark.llm.vectors import finite_rows, in_blocks, lists, longest, matrix

SCALE, SHIFT = 64, 1_000_000
BLOCK_ROWS = 4_096
# Spectra or partial sums that one task combines.
FAN_IN = 16
# Largest entry whose quantized value is a long with room for the shift.
LARGEST = 2.0**55
# Eigenvalues closer than this share of the largest are one; weights below it are none.
DEFLATE = 1e-14
# A component explains nothing below this share of the largest eigenvalue.
NO_VARIANCE = 1e-12


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(weights / (poles - x)) for ascending poles and positive weights, one above each pole.

    Returns the nearest pole of each root and the root's distance from it, which keeps the digits that the root
    itself would lose beside a large pole. Found by bisection in that distance, all roots at once. What is halved
    are the distance's bits, which are in its order: beside a pole of little weight, too, all digits are right.
    """
    gaps = np.append(np.diff(poles), weights.sum())
    middle = poles + gaps / 2
    # The function rises from minus infinity above a pole to plus infinity below the next.
    at_middle = 1 + (weights / (poles - middle[:, None])).sum(axis=1)
    upper = at_middle < 0
    upper[-1] = False
    origin = np.arange(len(poles)) + upper
    sign = np.where(upper, -1.0, 1.0)
    low = np.ones(len(poles), np.int64)
    high = np.append(gaps[:-1] / 2, gaps[-1]).view(np.int64)
    from_origin = poles - poles[origin][:, None]
    for _ in range(63):
        half = low + (high - low) // 2
        x = sign * half.view(np.float64)
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            above = 1 + (weights / (from_origin - x[:, None])).sum(axis=1) > 0
        nearer = above != upper
        low, high = np.where(nearer, low, half), np.where(nearer, half, high)
    return origin, sign * high.view(np.float64)


@dataclass
class Spectrum:
    """Count, mean and eigenpairs (ascending) of the scatter of a set of vectors."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, width: int) -> Spectrum:
        return cls(0, np.zeros(width), np.zeros(width), np.eye(width))

    def update(self, direction: np.ndarray) -> None:
        """Add ``direction`` times itself to the scatter."""
        z = direction @ self.vectors
        size = np.abs(z).max(initial=0.0)
        largest = max(self.values[-1], size * size)
        if largest == 0:
            return
        vectors, values, z = self.vectors.copy(), self.values.copy(), z.copy()
        # Of eigenvalues that are one, a reflection leaves a single eigenvector with all the weight.
        starts = np.flatnonzero(np.diff(values, prepend=-np.inf) > DEFLATE * largest)
        for start, end in zip(starts, np.append(starts[1:], len(values))):
            weight = np.sqrt(z[start:end] @ z[start:end])
            if end - start > 1 and weight > 0:
                mirror = z[start:end].copy()
                mirror[0] += weight if mirror[0] >= 0 else -weight
                mirror /= np.sqrt(mirror @ mirror)
                vectors[:, start:end] -= 2 * np.outer(vectors[:, start:end] @ mirror, mirror)
                turned = -weight if z[start] >= 0 else weight
                z[start:end] = 0
                z[start] = turned
        touched = np.flatnonzero(z * z > DEFLATE * DEFLATE * largest)
        if len(touched):
            poles = values[touched]
            origin, offset = secular_roots(poles, z[touched] ** 2)
            # Distances from every pole to every root, exact near the poles.
            apart = (poles[:, None] - poles[origin]) - offset
            # The weights for which these are the exact roots: eigenvectors from them are orthogonal.
            between = poles[:, None] - poles
            np.fill_diagonal(between, 1.0)
            ratio = apart / between
            own = -np.diag(apart)
            np.fill_diagonal(ratio, 1.0)
            turned = np.copysign(np.sqrt(np.abs(own * ratio.prod(axis=1))), z[touched])[:, None] / apart
            turned /= np.sqrt((turned**2).sum(axis=0))
            vectors[:, touched] = vectors[:, touched] @ turned
            values[touched] = poles[origin] + offset
        order = np.argsort(values, kind="stable")
        self.values, self.vectors = values[order], vectors[:, order]

    def add_scatter(self, n: int, mean: np.ndarray, directions: np.ndarray) -> None:
        """Take in ``n`` vectors around ``mean`` whose scatter is that of the rows of ``directions``."""
        shift = mean - self.mean
        if self.n:
            self.update(shift * np.sqrt(self.n * n / (self.n + n)))
        for direction in directions:
            self.update(direction)
        self.mean = self.mean + shift * (n / (self.n + n))
        self.n += n

    def add_block(self, rows: np.ndarray) -> None:
        if not len(rows):
            return
        mean = rows.mean(axis=0)
        centred = rows - mean
        if len(centred) > centred.shape[1]:
            centred = np.linalg.qr(centred, mode="r")
        self.add_scatter(len(rows), mean, centred)

    def add(self, other: Spectrum) -> None:
        self.add_scatter(other.n, other.mean, (other.vectors * np.sqrt(np.maximum(other.values, 0))).T)


def _tree(parts: DataFrame, combine, schema: str) -> DataFrame:
    """One row from the rows of all partitions, ``FAN_IN`` of them per task and level. ``parts`` has an int ``place``."""
    parts = written(parts, "partial")
    partitions = parts.agg(F.max("place")).first()[0] + 1
    while partitions > 1:
        partitions = -(-partitions // FAN_IN)
        parts = parts.withColumn("place", F.floor(F.col("place") / FAN_IN).cast("int"))
        parts = parts.groupBy("place").applyInArrow(combine, schema)
    return parts


def _quantized(table: pa.Table, width: int) -> np.ndarray:
    return np.floor(matrix(table["vector"].chunk(0), width) * SCALE).astype(np.int64) + SHIFT


def _place() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def _sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """Count and exact sums per dimension, added up in a task and then by Spark."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, object)
        for table in in_blocks(batches, BLOCK_ROWS):
            x = _quantized(table, width)
            n, total = n + len(x), total + (x >> 32).sum(axis=0).astype(object) * 2**32 + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
        if n:
            yield pa.RecordBatch.from_pydict({
                "dimension": pa.array(range(width), pa.int32()), "n": pa.array([n] * width, pa.int64()),
                "total": pa.array([int(t) for t in total], pa.decimal128(38, 0)),
            })

    parts = rows.mapInArrow(partial, "dimension int, n long, total decimal(38,0)")
    found = parts.groupBy("dimension").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    totals = {r["dimension"]: int(r["total"]) for r in found}
    return (found[0]["n"] if found else 0), [totals[i] for i in sorted(totals)]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int]]:
    """(n * x - S) / n with one rounding, and the exact sum of (n * x - S)^2 of each row."""
    middle = [s // n for s in sums]
    near = x - np.array(middle, np.int64)
    rest = np.array([s - n * m for s, m in zip(sums, middle)], object)
    reach = int(np.abs(near).max(initial=0)) * n + n
    if len(sums) * reach * reach < 2**63:
        apart = near * n - rest.astype(np.int64)
        return apart / n, (apart * apart).sum(axis=1).tolist()
    apart = near.astype(object) * n - rest
    return (apart / n).astype(float), (apart * apart).sum(axis=1).tolist()


SPECTRUM = "place int, n long, mean array<double>, values array<double>, vectors array<double>"


def _spectrum_row(place: int, s: Spectrum) -> pa.Table:
    return pa.table({
        "place": pa.array([place], pa.int32()), "n": pa.array([s.n], pa.int64()), "mean": lists(s.mean[None]),
        "values": lists(s.values[None]), "vectors": lists(s.vectors.reshape(1, -1)),
    })


def spectrum(rows: DataFrame, width: int, sums: tuple[int, list[int]]) -> Spectrum:
    """Spectrum of all quantized vectors, relative to their mean."""
    n, totals = sums

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Spectrum.empty(width)
        for table in in_blocks(batches, BLOCK_ROWS):
            held.add_block(_centred(_quantized(table, width), n, totals)[0])
        if held.n:
            yield from _spectrum_row(_place(), held).to_batches()

    def combine(table: pa.Table) -> pa.Table:
        held = Spectrum.empty(width)
        for r in table.sort_by("place").to_pylist():
            held.add(Spectrum(r["n"], np.array(r["mean"]), np.array(r["values"]), np.array(r["vectors"]).reshape(width, width)))
        return _spectrum_row(table["place"][0].as_py(), held)

    parts = rows.mapInArrow(partial, SPECTRUM)
    r = _tree(parts, combine, SPECTRUM).first()
    return Spectrum(r["n"], np.array(r["mean"]), np.array(r["values"]), np.array(r["vectors"]).reshape(width, width))


MOMENTS = "place int, n long, mean array<double>, scatter array<double>"


def _moments(rows: DataFrame, project, width: int, size: int) -> np.ndarray:
    """Covariance of ``project(quantized)``, centred in each block before multiplying and combined by shifts of means."""

    def merged(parts: Iterable[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
        n, mean, scatter = 0, np.zeros(size), np.zeros((size, size))
        for m, centre, more in parts:
            shift = centre - mean
            scatter = scatter + more + np.outer(shift, shift) * (n * m / (n + m))
            n, mean = n + m, mean + shift * (m / (n + m))
        return n, mean, scatter

    def row(place: int, n: int, mean: np.ndarray, scatter: np.ndarray) -> pa.Table:
        return pa.table({
            "place": pa.array([place], pa.int32()), "n": pa.array([n], pa.int64()),
            "mean": lists(mean[None]), "scatter": lists(scatter.reshape(1, -1)),
        })

    def blocks(batches):
        for table in in_blocks(batches, BLOCK_ROWS):
            y = project(_quantized(table, width))
            centred = y - y.mean(axis=0)
            yield len(y), y.mean(axis=0), centred.T @ centred

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, scatter = merged(blocks(batches))
        if n:
            yield from row(_place(), n, mean, scatter).to_batches()

    def combine(table: pa.Table) -> pa.Table:
        held = table.sort_by("place").to_pylist()
        return row(held[0]["place"], *merged((r["n"], np.array(r["mean"]), np.array(r["scatter"]).reshape(size, size)) for r in held))

    parts = rows.mapInArrow(partial, MOMENTS)
    r = _tree(parts, combine, MOMENTS).first()
    return np.array(r["scatter"]).reshape(size, size) / r["n"]


RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
    "deviation_exact string"
)


def whiten(vectors: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row per remaining vector and component, components numbered from 1 by falling eigenvalue."""
    small = F.forall("vector", lambda c: F.abs(c) < F.lit(LARGEST))
    rows = finite_rows(vectors, id_col, vector_col).where(small)
    nothing = rows.sparkSession.createDataFrame([], RESULT)
    width = longest(rows)
    if not width:
        return nothing
    n, sums = _sums(rows, width)
    found = spectrum(rows, width, (n, sums))
    basis = np.linalg.qr(found.vectors)[0]
    ritz = _moments(rows, lambda x: _centred(x, n, sums)[0] @ basis, width, width)
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, axes = np.maximum(values[::-1], 0.0), (basis @ turn)[:, ::-1]
    kept = min(components, width)
    varied = int((values[:kept] > NO_VARIANCE * values[0]).sum()) if values[0] > 0 else 0
    axes = axes[:, :varied] / np.sqrt(values[:varied])
    error = 0.0
    if varied:
        error = float(np.abs(_moments(rows, lambda x: _centred(x, n, sums)[0] @ axes, width, varied) - np.eye(varied)).max())
    explained = values[:kept] / values.sum() if values.sum() > 0 else np.zeros(kept)

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not table.num_rows:
                continue
            centred, exact = _centred(_quantized(table, width), n, sums)
            out = np.full((len(centred), kept), np.nan)
            out[:, :varied] = centred @ axes
            size = out.size
            yield pa.RecordBatch.from_pydict({
                "vec_id": table["vec_id"].combine_chunks().take(pa.array(np.repeat(np.arange(len(out)), kept))),
                "component": pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(out))),
                "n": pa.array(np.full(size, n)),
                "deviation": pa.array([d if d < 2**63 else None for d in exact for _ in range(kept)], pa.int64()),
                "whitened": pa.array(out.ravel(), mask=np.tile(np.arange(kept) >= varied, len(out))),
                "explained": pa.array(np.tile(explained, len(out))),
                "identity_error": pa.array(np.full(size, error)),
                "deviation_exact": pa.array([str(d) for d in exact for _ in range(kept)]),
            })

    return rows.mapInArrow(project, RESULT)
