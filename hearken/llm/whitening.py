"""Embedding whitening: two-pass covariance, a symmetric eigendecomposition, and a broadcast projection.

Entries become whole numbers, so the first pass sums them exactly and gives the mean without rounding. The second pass
sums outer products of vectors centred at that mean, one matrix product a batch; both passes leave one partial result a
partition, merged by treeAggregate. The eigenvectors of the covariance, a table of dimensions x components whatever the
input, are broadcast, and a last pass projects every vector.

Null vectors, vectors with null or non-finite entries, and vectors with an entry beyond LARGEST go. The most frequent
length of the others, the longer of two, is the number of dimensions; vectors of another length go too. Rows that repeat,
or share or lack a vec_id, count one by one. A component without variance is whitened to 0 and explains 0. An empty table,
or one without such vectors, gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
LARGEST = float(1 << 51)  # of entries: their whole numbers are exact as doubles
NO_SCALE = 1e-13  # share of the trace up to which an eigenvalue is rounding


@dataclass
class Whitening:
    n: int
    sums: np.ndarray  # exact Python integers
    vectors: np.ndarray  # dimension, component
    values: np.ndarray  # eigenvalues, falling
    trace: float

    @property
    def scales(self) -> np.ndarray:
        """Factors to unit variance; 0 where there is none."""
        has = self.values > self.trace * NO_SCALE
        return np.where(has, 1 / np.sqrt(np.where(has, self.values, 1)), 0.0)

    @property
    def explained(self) -> np.ndarray:
        return np.maximum(self.values, 0) / self.trace if self.trace > 0 else np.zeros(len(self.values))

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the mean: the mean's whole part goes exactly, the rest is below 1."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s - self.n * int(w)) / self.n for s, w in zip(self.sums, whole, strict=True)])
        return (x - whole).astype(float) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors * self.scales

    def deviations(self, x: np.ndarray) -> list[int]:
        """The sum over dimensions of (n x - S)^2 of each row, exact at any size."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        far = int(np.abs(x - whole).max(initial=0)) + 1
        if self.n * far < 1 << 31 and (self.n * far) ** 2 * x.shape[1] < 1 << 63:
            off = (x - whole) * self.n - np.array([s - self.n * int(w) for s, w in zip(self.sums, whole, strict=True)], np.int64)
            return (off * off).sum(axis=1).tolist()
        return [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist()]


def finite(rows: DataFrame, vector: str) -> DataFrame:
    """vec_id and x, an array of doubles, of the rows whose vector is whole."""
    x = F.col(vector).cast("array<double>")
    fits = F.forall(x, lambda c: c.isNotNull() & (F.abs(c) <= LARGEST))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(x.isNotNull() & (F.size(x) > 0) & fits)


def _whole(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors' whole numbers, a row each."""
    column = batch.column("x")
    return np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False)).astype(np.int64).reshape(len(column), -1) + OFFSET


def _of(batch: pa.RecordBatch, dimensions: int) -> pa.RecordBatch:
    return batch.filter(pc.equal(pc.list_value_length(batch.column("x")), dimensions))


def _merged(parts: DataFrame, zero: np.ndarray) -> np.ndarray:
    """The sum of the matrices in `part`, one a partition, by treeAggregate."""
    shape, kind = zero.shape, zero.dtype
    return parts.rdd.map(lambda r: np.frombuffer(r.part, kind).reshape(shape)).treeAggregate(zero, np.add, np.add, 2)


def _summed(rows: DataFrame, dimensions: int, work, shape: tuple[int, ...], kind) -> np.ndarray:
    """The sum over all batches of work(whole numbers): added up in each partition, then merged."""

    def run(batches):
        total = np.zeros(shape, kind)
        for batch in batches:
            own = _of(batch, dimensions)
            if own.num_rows:
                total += work(_whole(own))
        yield pa.RecordBatch.from_pydict({"part": pa.array([total.tobytes()], pa.binary())})

    return _merged(rows.mapInArrow(run, "part binary"), np.zeros(shape, kind))


def dimensions_of(rows: DataFrame) -> int:
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    first = lengths.first()
    return first.d if first else 0


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fits to all vectors of `rows` (vec_id, x), as `finite` gives them; None without any."""
    d = dimensions_of(rows)
    if not d:
        return None

    def sums(x):
        # High and low halves apart, so that no sum of fewer than 2**31 rows passes 64 bits.
        return np.stack((np.append((x >> 32).sum(axis=0), len(x)), np.append((x & 0xFFFFFFFF).sum(axis=0), 0)))

    high, low = _summed(rows, d, sums, (2, d + 1), np.int64)
    exact = np.array([(int(h) << 32) + int(l) for h, l in zip(high[:-1], low[:-1], strict=True)], object)
    model = Whitening(int(high[-1]), exact, np.empty((d, 0)), np.empty(0), 0.0)

    def products(x):
        off = model.centred(x)
        return off.T @ off

    covariance = _summed(rows, d, products, (d, d), np.float64) / model.n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    falling = np.argsort(-values, kind="stable")[:components]
    model.values, model.vectors, model.trace = values[falling], vectors[:, falling], float(np.trace(covariance))
    largest = np.abs(model.vectors).argmax(axis=0)
    model.vectors = model.vectors * np.where(model.vectors[largest, np.arange(len(falling))] < 0, -1, 1)
    return model


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened vectors' covariance, measured over all of them, less the identity."""
    d, k = model.vectors.shape

    def moments(x):
        w = model.whitened(x)
        return np.vstack((w.sum(axis=0), w.T @ w))

    total = _summed(rows, d, moments, (k + 1, k), np.float64) / model.n
    # The vectors are centred at their exact mean; what rounding leaves of it is taken off.
    return float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(k)).max(initial=0))


def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation decimal(38,0), whitened, explained, identity_error: a row for each vector
    that is left and each component."""
    whole = finite(rows, vector)
    model = fit(whole, components)
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    error = identity_error(whole, model)
    shared = rows.sparkSession.sparkContext.broadcast(model)  # dimensions x components

    def run(batches):
        own = shared.value
        d, k = own.vectors.shape
        for batch in batches:
            batch = _of(batch, d)
            if not batch.num_rows:
                continue
            x, each = _whole(batch), np.repeat(np.arange(batch.num_rows), k)
            deviation = pa.array([Decimal(v) for v in own.deviations(x)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id").take(pa.array(each)),
                "component": pa.array(np.tile(np.arange(1, k + 1), batch.num_rows), pa.int32()),
                "n": pa.array(np.full(len(each), own.n)),
                "deviation": deviation.take(pa.array(each)),
                "whitened": pa.array(own.whitened(x).ravel()),
                "explained": pa.array(np.tile(own.explained, batch.num_rows)),
                "identity_error": pa.array(np.full(len(each), error)),
            })

    return whole.mapInArrow(run, schema)
