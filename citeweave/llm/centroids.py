"""Centroid clustering in whole numbers with equal-average equal-variance search.

Vectors become whole numbers once.  In a round every vector goes to its nearest centroid, and
every centroid to the floor of its vectors' mean.  Centroids are sorted by the mean of their
components; a vector starts at the centroid whose mean is next to its own and goes outward.
With ``k`` components, sums S and deviations V (the length of what is left after the mean is
taken off), a squared distance is at least ``(S_x - S_c)**2 / k + (V_x - V_c)**2``.  The first
part alone ends the scan on one side, both together pass over a centroid; only what is left
is measured, exactly.  The bounds leave room for rounding, so no nearest centroid, tied ones
included, is ever passed over.

Vectors stay where they were read: a round sends out the centroids and gets back one row of
sums per task and centroid.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import named, prepare
from citeweave.sources.tables import staged

# Fixed values of the contract.
DIMENSIONS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = "3"
# Whole components stay below this, so that no squared distance or sum of them leaves 64 bits.
LARGEST = 1 << 27
# Room for rounding in a bound: this share of it and one whole unit.
ROOM = 1e-9


class Codebook:
    """Centroids in the order of their means, with what the bounds need."""

    def __init__(self, centroids: np.ndarray):
        self.size, self.width = centroids.shape
        sums = centroids.sum(axis=1)
        self.numbers = np.lexsort((np.arange(self.size), sums))
        self.centroids = centroids[self.numbers]
        self.sums = sums[self.numbers]
        self.deviations = _deviations(self.centroids, self.sums)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of and squared distance to the nearest centroid of each vector (ties: the smaller
        number), and how many distances were measured."""
        n, width = vectors.shape
        sums = vectors.sum(axis=1)
        deviations = _deviations(vectors, sums)
        best = np.full(n, np.iinfo(np.int64).max, dtype=np.int64)
        number = np.full(n, self.size, dtype=np.int64)
        above = np.searchsorted(self.sums, sums)  # next centroid to try upwards
        below = above - 1  # and downwards
        rows = np.arange(n)
        measured = 0
        while len(rows):
            up, down = above[rows], below[rows]
            gap_up = np.where(up < self.size, np.abs(self.sums[np.minimum(up, self.size - 1)] - sums[rows]).astype(float), np.inf)
            gap_down = np.where(down >= 0, np.abs(sums[rows] - self.sums[np.maximum(down, 0)]).astype(float), np.inf)
            upwards = gap_up < gap_down
            gap = np.where(upwards, gap_up, gap_down)
            limit = best[rows].astype(float) * (1 + ROOM) + 1
            # The nearer side is out of reach by mean, and so is all that lies beyond on both sides.
            open_ = np.isfinite(gap) & (gap * gap / width <= limit)
            rows, upwards, gap, limit = rows[open_], upwards[open_], gap[open_], limit[open_]
            at = np.where(upwards, above[rows], below[rows])
            above[rows] += upwards
            below[rows] -= ~upwards
            apart = deviations[rows] - self.deviations[at]
            near = gap * gap / width + apart * apart <= limit
            tried, places = rows[near], at[near]
            measured += len(tried)
            differences = vectors[tried] - self.centroids[places]
            distance = np.einsum("ij,ij->i", differences, differences)
            own = self.numbers[places]
            better = (distance < best[tried]) | ((distance == best[tried]) & (own < number[tried]))
            best[tried[better]] = distance[better]
            number[tried[better]] = own[better]
        return number, best, measured


def _deviations(vectors: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Length of each vector after its mean is taken off.

    The floor of the mean is taken off in whole numbers, so that nothing is lost where a
    vector lies far out; what that leaves out is less than one for each component.
    """
    width = vectors.shape[1]
    floors = sums // width
    centred = vectors - floors[:, None]
    left = (sums - floors * width).astype(float)
    squares = np.einsum("ij,ij->i", centred, centred).astype(float)
    return np.sqrt(np.maximum(squares - left * left / width, 0))


def _batch_vectors(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("vector").values.to_numpy(zero_copy_only=False)[
        batch.column("vector").offsets[0].as_py():batch.column("vector").offsets[-1].as_py()].reshape(-1, width)


def _sums(centroids: np.ndarray):
    """Per task and centroid: count, distances and component sums of the vectors it got."""
    schema = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("spread", pa.int64()), ("total", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(centroids)
        count, spread = np.zeros((2, book.size), dtype=np.int64)
        total = np.zeros((book.size, book.width), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _batch_vectors(batch, book.width)
            number, distance, _ = book.nearest(vectors)
            np.add.at(count, number, 1)
            np.add.at(spread, number, distance)
            np.add.at(total, number, vectors)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(count[used]), pa.array(spread[used]),
             pa.array(list(total[used]), pa.list_(pa.int64()))], schema=schema)

    return run


_SUMS = "cluster int, n bigint, spread bigint, total array<bigint>"


def _assignments(centroids: np.ndarray):
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(centroids)
        for batch in batches:
            if batch.num_rows:
                number, distance, _ = book.nearest(_batch_vectors(batch, book.width))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance)], schema=schema)

    return run


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, dimensions: int, scale: int) -> DataFrame:
    """``vec_id, vector``: kept vectors as whole numbers."""
    cells = named(vector_col).cast("array<double>")
    usable = (F.size(cells) == dimensions) & F.forall(
        cells, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.where(usable).select(
        named(id_col).cast("bigint").alias("vec_id"), F.transform(cells, lambda x: F.floor(F.lit(float(scale)) * x)).alias("vector"))
    too_large = F.exists("vector", lambda x: F.abs(x) >= LARGEST)
    message = f"a component reaches {LARGEST} after scaling; its distances do not fit 64 bits"
    return kept.withColumn("vector", F.when(too_large, F.raise_error(F.lit(message)).cast("array<bigint>"))
                           .otherwise(F.col("vector")))


def _start_order(vec_id: Column, seed: str) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(vec_id.cast("string"), F.lit(""))), 256)


def _gathered(whole: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, int, list[int]]]:
    """Count, distances and component sums of each non-empty cluster: one row per centroid comes back."""
    partial = whole.select("vector").mapInArrow(_sums(centroids), _SUMS)
    totals = F.array(*[F.sum(F.col("total")[i]) for i in range(centroids.shape[1])])
    rows = partial.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("spread").alias("spread"), totals.alias("total"))
    return {row["cluster"]: (row["n"], row["spread"], row["total"]) for row in rows.collect()}


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS,
            rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: str = SEED) -> DataFrame:
    """Every kept vector with its cluster, by ``rounds`` rounds of exact whole-number means.

    Kept are vectors of exactly ``dimensions`` components, none null or not finite; each
    component becomes ``floor(scale * x)``.  Centroids start as the ``clusters`` kept vectors
    with the smallest SHA-256 of ``seed:vec_id`` (a null id is written as nothing; equal ids
    are ordered by their vectors), or as all of them if there are fewer.  Every round assigns
    each vector to the nearest centroid by squared Euclidean distance, ties to the smaller
    number, and replaces each centroid that got vectors by the componentwise floor of their
    mean; others stay.  A last assignment follows.

    Returns ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``, one row
    per kept row; repeated rows are separate vectors.  A vector with a component of 2**27 or
    more after scaling ends the job with an error, as its distances may not fit a long.  An
    empty table, or one without a kept vector, gives an empty table.  Columns other than the
    two are not looked at, whatever their names.

    To the driver come the centroids and one row of sums for each: their size follows from
    ``clusters`` and ``dimensions``.
    """
    spark = vectors.sparkSession
    prepare(spark)
    whole = staged(whole_vectors(vectors, id_col, vector_col, dimensions, scale), "vectors")
    first = whole.orderBy(_start_order(F.col("vec_id"), seed), "vector").limit(clusters).collect()
    centroids = np.array([row["vector"] for row in first], dtype=np.int64).reshape(-1, dimensions)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, "
                                         "inertia bigint, centroid_sha256 string")
    for _ in range(rounds):
        for number, (n, _, total) in _gathered(whole, centroids).items():
            centroids[number] = [value // n for value in total]  # whole-number division rounds down
    met = _gathered(whole, centroids)
    described = [(number, spread, sum(one[1] for one in met.values()),
                  hashlib.sha256(",".join(map(str, centroids[number].tolist())).encode()).hexdigest())
                 for number, (_, spread, _) in met.items()]
    by_cluster = spark.createDataFrame(described, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    assigned = whole.mapInArrow(_assignments(centroids), "vec_id bigint, cluster int, distance bigint")
    return assigned.join(F.broadcast(by_cluster), "cluster").select(  # one row per centroid
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
