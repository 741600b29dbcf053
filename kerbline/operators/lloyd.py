"""Many k-means fits in shared passes over the rows.

A pass hands each task the centers of all fits that still move. For its rows the task finds the nearest center of every fit
by one matrix product, adds members up by another, and returns counts and sums of all centers; sums of many tasks are added in groups
first. A fit stops by itself when no center moves by more than ``TOLERANCE``, so there are as many passes as the longest
fit needs, whatever the number of fits.

Starts are k-means++: the first center is a row drawn evenly, each other one a row drawn by its squared distance from the centers so
far. A row's draw is a hash of its values and the fit, so starts do not depend on partitions, and the k-th centers of all fits
are drawn in one pass.

Defined cases: rows without a vector are left out; fewer distinct rows than centers leave the surplus centers on a row that has one,
without members; equal distances go to the first center; an empty table is an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.errors import DataError
from kerbline.shared import block_splits, fresh_path

# Fixed values.
MOST_PASSES = 300
TOLERANCE = 1e-4
BLOCK_ROWS, GROUP_BLOCKS = 4096, 16
#: Rows whose distances to all centers are held at once, so that they stay in a core's cache.
CACHE_ROWS = 1024
FAN_IN = 64
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


@dataclass(frozen=True)
class Centers:
    """One fit: its centers, the sum of squared distances to them, and the passes it took."""

    size: int
    restart: int
    centers: np.ndarray
    inertia: float
    passes: int
    features: str = "features"
    prediction: str = "cluster"

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the number of the nearest center."""
        x = array_of(rows, self.features)
        gaps = [
            F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, v: t + v)
            for c in self.centers
        ]
        # Inside the lambda the distances are bound once.
        nearest = F.transform(F.array(F.array(*gaps)), lambda g: F.array_position(g, F.array_min(g)))[0] - 1
        return rows.withColumn(self.prediction, F.when(x.isNotNull(), nearest.cast("int")))

    def save(self, spark: SparkSession, path: str) -> None:
        row = (self.size, self.restart, self.centers.tolist(), self.inertia, self.passes, self.features, self.prediction)
        spark.createDataFrame([row], _STORED).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Centers:
        row = spark.read.parquet(path).first().asDict()
        return cls(**{**row, "centers": np.array(row["centers"])})


_STORED = "size int, restart int, centers array<array<double>>, inertia double, passes int, features string, prediction string"
PART = T.StructType([T.StructField("slot", T.IntegerType()), T.StructField("part", T.BinaryType())])


def array_of(rows: DataFrame, column: str):
    return F.col(column).cast("array<double>") if dict(rows.dtypes)[column].startswith("array") else vector_to_array(column)


class Rows:
    """The vectors of a table as blocks of matrices, written once."""

    def __init__(self, rows: DataFrame, column: str) -> None:
        frame = rows.select(array_of(rows, column).alias("x")).where("x IS NOT NULL")

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                    blocks = [x[at : at + BLOCK_ROWS].tobytes() for at in range(0, len(x), BLOCK_ROWS)]
                    yield pa.RecordBatch.from_arrays([pa.array([x.shape[1]] * len(blocks), pa.int32()), pa.array(blocks, pa.binary())], names=["width", "block"])

        path = fresh_path(rows.sparkSession, "kmeans-rows")
        # Small row groups, so that a few files are still read by many tasks.
        frame.mapInArrow(pack, "width int, block binary").write.option("parquet.block.row.count.limit", GROUP_BLOCKS).parquet(path)
        self.blocks = rows.sparkSession.read.schema("width int, block binary").parquet(path)
        with block_splits(rows.sparkSession):
            found = self.blocks.select("width", F.spark_partition_id().alias("task")).agg(F.max("width"), F.count_distinct("task")).first()
        if not found[0]:
            raise DataError("no vectors to cluster")
        self.width, self.many = found[0], found[1] > FAN_IN

    def fold(self, of_rows: Callable[[np.ndarray], np.ndarray], add: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """One pass: ``of_rows`` of each block, brought together by ``add``."""
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, slot = None, 0
            for batch in batches:
                for block in batch.column(1):
                    x = np.frombuffer(block.as_buffer()).reshape(-1, width)
                    part, slot = of_rows(x), slot + len(x)
                    total = part if total is None else add(total, part)
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([slot % FAN_IN], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slot", "part"])

        def joined(parts: Iterable[pa.Scalar]) -> np.ndarray:
            arrays = [np.frombuffer(p.as_buffer()) for p in parts]
            total = arrays[0]
            for part in arrays[1:]:
                total = add(total, part)
            return total

        def together(table: pa.Table) -> pa.Table:
            return pa.table({"slot": table.column("slot")[:1], "part": pa.array([joined(table.column("part")).tobytes()], pa.binary())})

        parts = self.blocks.mapInArrow(run, PART)
        if self.many:
            parts = parts.groupBy("slot").applyInArrow(together, PART)
        with block_splits(parts.sparkSession):
            # Sorted here: a sort by Spark would make the pass twice, once to find its bounds.
            return joined(sorted(parts.toArrow().column("part"), key=lambda p: p.as_py()))


def hashed(x: np.ndarray) -> np.ndarray:
    """A hash of each row's values, the same wherever the row stands."""
    h = np.zeros(len(x), np.uint64)
    for k in range(x.shape[1]):
        h = (h ^ np.ascontiguousarray(x[:, k] + 0.0).view(np.uint64)) * _MIX[0]
        h = (h ^ (h >> np.uint64(29))) * _MIX[1]
        h ^= h >> np.uint64(32)
    return h


def draws(h: np.ndarray, seed: int) -> np.ndarray:
    """An even draw from (0, 1) for each hash."""
    z = (h ^ np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)) * _MIX[0]
    z = (z ^ (z >> np.uint64(29))) * _MIX[1]
    z ^= z >> np.uint64(32)
    return (z >> np.uint64(11)) * 2.0**-53 + 2.0**-54


def starts(rows: Rows, fits: list[tuple[int, int]], seed: int) -> list[np.ndarray]:
    """Centers to begin with; pass k draws the k-th center of all fits that have one."""
    width = rows.width
    chosen = [np.zeros((0, width)) for _ in fits]
    for k in range(max(size for size, _ in fits)):
        open_ = [i for i, (size, _) in enumerate(fits) if size > k]
        held = [(chosen[i], 1 + seed + 1_000_003 * fits[i][1] + 7919 * fits[i][0] + 104_729 * k) for i in open_]

        centers = np.concatenate([c for c, _ in held])
        bounds = np.arange(len(held) + 1) * k

        def best(x: np.ndarray, held=held, centers=centers, bounds=bounds) -> np.ndarray:
            out, h = [], hashed(x)
            squares = np.hstack([s for *_, s in _members(x, centers, bounds)]) if len(centers) else np.ones((len(held), len(x)))
            for weight, (_, own) in zip(squares, held):
                # The least of -log(u) / w is drawn with probability w over the sum of all; (1 - u) / w is below it.
                u, open_ = draws(h, own), weight > 1e-12
                bound = np.where(open_, (1 - u) / np.maximum(weight, 1e-300), np.inf)
                first = int(bound.argmin())
                if open_[first]:
                    near = np.flatnonzero(bound <= -np.log(u[first]) / weight[first])
                    keys = -np.log(u[near]) / weight[near]
                    at, key = near[keys.argmin()], keys.min()
                else:
                    at, key = np.lexsort(x.T[::-1])[0], np.inf
                out.append(np.concatenate([[key], x[at]]))
            return np.concatenate(out)

        def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            a, b = a.reshape(-1, width + 1), b.reshape(-1, width + 1)
            return np.array([min(p.tolist(), q.tolist()) for p, q in zip(a, b)]).ravel()

        found = rows.fold(best, least).reshape(-1, width + 1)
        for i, row in zip(open_, found):
            chosen[i] = np.vstack([chosen[i], row[1:]])
    return chosen


def fit_all(vectors: DataFrame | Rows, column: str, fits: list[tuple[int, int]], seed: int = 42) -> list[Centers]:
    """Fit every (number of centers, restart) together; the result is that of fitting each alone."""
    rows = vectors if isinstance(vectors, Rows) else Rows(vectors, column)
    centers = starts(rows, fits, seed)
    done: dict[int, Centers] = {}
    for n in range(1, MOST_PASSES + 1):
        moving = [i for i in range(len(fits)) if i not in done]
        sums = _assigned(rows, [centers[i] for i in moving])
        for i, part in zip(moving, sums):
            counts, totals, inertia = part[:, 0], part[:, 1:-1], float(part[:, -1].sum())
            moved = np.where(counts[:, None] > 0, totals / np.maximum(counts, 1)[:, None], centers[i])
            if n == MOST_PASSES or ((moved - centers[i]) ** 2).sum(axis=1).max() <= TOLERANCE**2:
                done[i] = Centers(*fits[i], centers[i], inertia, n, column)
            centers[i] = moved
        if len(done) == len(fits):
            break
    return [done[i] for i in range(len(fits))]


def _members(x: np.ndarray, whole: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows after a column of ones, a row a center that marks its members, and a row a fit of squared distances to them.

    ``whole`` holds the centers of all fits, those of a fit between two ``bounds``.
    """
    lift = np.concatenate([(whole * whole).sum(axis=1)[:, None], -2 * whole], axis=1)
    sizes = np.diff(bounds)
    firsts = np.flatnonzero(np.concatenate([[True], sizes[1:] != sizes[:-1]])).tolist()
    alike = [(a, b, int(sizes[a])) for a, b in zip(firsts, [*firsts[1:], len(sizes)])]  # fits of equal size side by side
    for at in range(0, len(x), CACHE_ROWS):
        part = x[at : at + CACHE_ROWS]
        ones = np.concatenate([np.ones((len(part), 1)), part], axis=1)
        distance = lift @ ones.T  # less the row's own square, which all centers share
        least, picked = np.empty((len(sizes), len(part))), np.empty(distance.shape, bool)
        for a, b, size in alike:
            own, marks = (m[bounds[a] : bounds[b]].reshape(b - a, size, -1) for m in (distance, picked))
            least[a:b] = own[:, 0]
            for k in range(1, size):
                np.minimum(least[a:b], own[:, k], out=least[a:b])
            np.equal(own, least[a:b, None], out=marks)
            if np.count_nonzero(marks) != (b - a) * len(part):  # equal distances go to the first center
                marks[:] = own.argmin(axis=1)[:, None] == np.arange(size)[:, None]
        yield ones, picked.astype(np.float64), np.maximum(least + (part * part).sum(axis=1), 0)


def _assigned(rows: Rows, centers: list[np.ndarray]) -> list[np.ndarray]:
    """For each fit a row a center: members and their sum, and in the last column of the first row the squared distances of all."""
    whole, bounds = np.vstack(centers), np.cumsum([0, *[len(c) for c in centers]])

    def count(x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(whole), x.shape[1] + 2))
        for ones, picked, squares in _members(x, whole, bounds):
            out[:, :-1] += picked @ ones
            out[bounds[:-1], -1] += squares.sum(axis=1)
        return out.ravel()

    total = rows.fold(count, np.add).reshape(len(whole), -1)
    return [total[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def silhouettes(rows: Rows, fits: list[Centers]) -> list[float]:
    """The mean silhouette of every fit over all rows by ``cluster.silhouette_rows``, in two passes for all fits."""
    whole, bounds = np.vstack([f.centers for f in fits]), np.cumsum([0, *[len(f.centers) for f in fits]])

    def add_up(x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(whole), x.shape[1] + 2))  # members, their sum, their squares
        for ones, picked, _ in _members(x, whole, bounds):
            out += picked @ np.concatenate([ones, (ones[:, 1:] ** 2).sum(axis=1)[:, None]], axis=1)
        return out.ravel()

    sums = rows.fold(add_up, np.add).reshape(len(whole), -1)
    n, s, q = sums[:, :1], sums[:, 1:-1], sums[:, -1:]

    def score(x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(fits) + 1)
        out[-1] = len(x)
        for ones, picked, _ in _members(x, whole, bounds):
            away = np.maximum(n * (ones[:, 1:] ** 2).sum(axis=1) + q - 2 * s @ ones[:, 1:].T, 0)
            for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                own, size = picked[a:b] > 0, n[a:b]
                near = np.where(own, away[a:b] / np.maximum(size - 1, 1), 0).sum(axis=0)
                far = np.where(own | (size == 0), np.inf, away[a:b] / np.maximum(size, 1)).min(axis=0)
                widest = np.maximum(near, far)
                judged = ((size * own).sum(axis=0) > 1) & np.isfinite(far) & (widest > 0)
                out[k] += ((far[judged] - near[judged]) / widest[judged]).sum()
        return out

    *total, count = rows.fold(score, np.add)
    return [float(t / count) for t in total]
