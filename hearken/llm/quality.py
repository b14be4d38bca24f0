"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

Every document has a vector of statistics. Random Fourier features of the standardised vector approximate a Gaussian
kernel; each partition of labelled rows adds up its share of the normal equations, which are summed by row of the
matrix and solved on the driver (FEATURES + 1 unknowns, whatever the input). Scores of the labelled rows, counted in
1,025 bins, give the isotonic calibration.

Null texts are empty and are scored; labels that are null are left out and repeated ones each count; without labelled
rows every score is 0.5; texts are read whole; equal statistics get equal scores, and bins of equal shares are pooled; each
row is scored by itself, whether doc_ids repeat or are null, and rows that repeat a labelled doc_id each teach; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, id_and_bytes, map_slices, saved

FEATURES, RIDGE, WIDTH, SEED, BINS = 256, 1e-3, 1.0, 8, 1024
SIGNS = b"!#$%&*|.,?"
STATISTICS = 19 + len(SIGNS)


def statistics(bodies: list[bytes]) -> np.ndarray:
    """A row of STATISTICS numbers for each text."""
    words = Words(bodies)
    n = len(bodies)
    size = np.fromiter(map(len, bodies), np.int64, n)
    edges = words.begin
    kind = np.zeros((256, 7 + len(SIGNS)), np.int64)
    for k, (low, high) in enumerate(((65, 91), (97, 123), (48, 58), (128, 256), (10, 11), (32, 33))):
        kind[low:high, k] = 1
    kind[33:127, 6] = 1 - kind[33:127, :3].sum(axis=1)
    for k, sign in enumerate(SIGNS):
        kind[sign, 7 + k] = 1
    shares = np.empty((n, kind.shape[1]))
    for k in range(kind.shape[1]):
        total = np.concatenate(([0], np.cumsum(kind[:, k].astype(np.int32)[words.text], dtype=np.int64)))
        shares[:, k] = total[edges[1:] - 1] - total[edges[:-1]]
    shares /= np.maximum(size, 1)[:, None]
    counts = np.diff(words.first)
    doc = np.repeat(np.arange(n), counts)
    length = words.ends - words.starts
    mean = np.bincount(doc, weights=length, minlength=n) / np.maximum(counts, 1)
    square = np.bincount(doc, weights=length.astype(float) ** 2, minlength=n) / np.maximum(counts, 1)
    order = np.lexsort((words.hashes, doc))
    d, h = doc[order], words.hashes[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    distinct = np.bincount(d[new], minlength=n) / np.maximum(counts, 1)
    runs = np.diff(np.append(np.flatnonzero(new), len(d)))
    most = np.zeros(n)
    np.maximum.at(most, d[new], runs)
    last = words.text[words.ends - 1] if len(doc) else np.empty(0, np.uint8)
    first = words.text[words.starts] if len(doc) else np.empty(0, np.uint8)
    closed = np.bincount(doc, weights=(last == 46), minlength=n) / np.maximum(counts, 1)
    marked = np.bincount(doc, weights=((last < 48) & (last != 46) & (last != 44)), minlength=n) / np.maximum(counts, 1)
    raised = np.bincount(doc, weights=(first >= 65) & (first < 91), minlength=n) / np.maximum(counts, 1)
    long = np.bincount(doc, weights=length > 12, minlength=n) / np.maximum(counts, 1)
    lines, repeated = np.empty(n), np.empty(n)
    for i, body in enumerate(bodies):
        own = body.split(b"\n")
        lines[i], repeated[i] = len(own), 1 - len(set(own)) / len(own)
    return np.column_stack((np.log1p(size), np.log1p(counts), mean, np.sqrt(np.maximum(square - mean**2, 0)), distinct, most / np.maximum(counts, 1), closed, marked, raised, long, np.log1p(lines), shares, repeated)).astype(float)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and its statistics."""

    def work(batch):
        x = statistics(batch.column("body").to_pylist())
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "x": pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))})

    return map_slices(id_and_bytes(docs), work, "doc_id long, x array<double>")


class Classifier:
    def __init__(self, mean, scale, seed: int = SEED):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.mean, self.scale = mean, scale
        self.weights = rng.normal(size=(len(mean), FEATURES)) * WIDTH / np.sqrt(len(mean))
        self.phase = rng.uniform(0, 2 * np.pi, FEATURES)
        self.beta = np.zeros(FEATURES + 1)
        self.at, self.level = np.array([0.5]), np.array([0.5])

    def lift(self, x: np.ndarray) -> np.ndarray:
        """A row's features do not depend on the rows beside it: a matrix product may add up a row at the edge of its blocks
        in another order, so statistics are added one by one."""
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        z = np.ones((len(x), FEATURES + 1))
        for k in range(0, len(x), 64):
            own = x[k : k + 64].T[:, :, None]
            total = np.repeat(self.phase[None], own.shape[1], axis=0)
            for column, weights in zip(own, self.weights, strict=True):
                total += column * weights
            z[k : k + 64, :-1] = np.cos(total) * np.sqrt(2 / FEATURES)
        return z

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((self.lift(x) * self.beta).sum(axis=1), 0, 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.at, self.level)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fit(train: DataFrame) -> Classifier:
    """Fits to the columns x and y (0 or 1) of all rows of `train`."""
    moments = train.select(F.posexplode("x").alias("k", "v")).groupBy("k").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).orderBy("k").collect()
    if not moments:
        return Classifier(np.zeros(STATISTICS), np.ones(STATISTICS))
    model = Classifier(np.array([r.m for r in moments]), np.array([r.s if r.s and r.s > 1e-9 else 1.0 for r in moments]))

    def equations(batches):
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            if batch.num_rows:
                z, y = model.lift(_matrix(batch.column("x"))), batch.column("y").to_numpy()
                total[:, :-1] += z.T @ z
                total[:, -1] += z.T @ y
        yield pa.RecordBatch.from_pydict({"row": pa.array(np.arange(FEATURES + 1), pa.int32()), "own": pa.array(list(total), pa.list_(pa.float64()))})

    def add(table: pa.Table) -> pa.Table:
        return pa.table({"row": table.column("row").slice(0, 1), "own": pa.array([_matrix(table.column("own")).sum(axis=0)], pa.list_(pa.float64()))})

    rows = train.select("x", "y").mapInArrow(equations, "row int, own array<double>").groupBy("row").applyInArrow(add, "row int, own array<double>").orderBy("row").collect()
    system = np.array([r.own for r in rows])
    n = system[-1, -2]
    model.beta = np.linalg.solve(system[:, :-1] + RIDGE * n * np.eye(FEATURES + 1) / FEATURES, system[:, -1])

    def binned(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict({"bin": pa.array(np.rint(model.raw(_matrix(batch.column("x"))) * BINS), pa.int64()), "y": batch.column("y")})

    bins = train.select("x", "y").mapInArrow(binned, "bin long, y double").groupBy("bin").agg(F.sum("y").alias("y"), F.count("*").alias("n")).orderBy("bin").collect()
    blocks: list[list[float]] = []  # pool adjacent violators: [sum of labels, rows, first bin, last bin]
    for r in bins:
        blocks.append([r.y, r.n, r.bin, r.bin])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            y, m, _, last = blocks.pop()
            blocks[-1][0] += y
            blocks[-1][1] += m
            blocks[-1][3] = last
    model.at = np.array([b for block in blocks for b in block[2:]]) / BINS
    model.level = np.repeat([b[0] / b[1] for b in blocks], 2)
    return model


def classify(docs: DataFrame, labels: DataFrame, learn) -> DataFrame:
    """doc_id and score of every document, learned from `labels` (doc_id, quality) of documents where `learn` holds."""
    known = saved(measured(docs), "statistics")
    marked = labels.where(F.col("quality").isNotNull() & learn).select("doc_id", F.col("quality").cast("double").alias("y"))
    train = saved(known.join(marked, "doc_id").select("x", "y"), "labelled")
    model = fit(train)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def score(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(shared.value.score(_matrix(batch.column("x"))))})

    return known.mapInArrow(score, "doc_id long, score double")
