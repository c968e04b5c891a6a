"""Centroid clustering of integer vectors with ns-bounds (norm-of-sum bounds).

Every vector keeps, for each centroid, the distance that was last measured and the round in which it was.  The centroids of
all rounds are kept as history, so a stored distance is loosened by the norm of the centroid's total displacement since that
round, ||c(now) - c(then)||, and not by the sum of its drifts round by round, which is never smaller.  A vector whose
upper bound to its own centroid lies under its lower bounds to all others stays where it is, unmeasured.  Where that fails the
distance to the own centroid is measured first; then those centroids whose lower bound still lies under it are measured
exactly, in integers, and the nearest of them is taken (ties: the smaller number).

Centroids are few numbers (K vectors) and live on the driver; vectors, assignments and bounds are a table in the shared folder,
rewritten once a round.  Sums are taken by Spark, partially in the map tasks: a round shuffles K rows a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

WIDTH, CLUSTERS, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1
LARGEST = 1 << 27  # of a component: squared distances of 64 such components still fit in a long
SLACK = 1e-9  # relative room for the rounding of square roots; a bound that decides by less is measured


def integers(vector: Column, width: int = WIDTH, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as a long; null for vectors of another length or with null or non-finite components."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    usable = (F.size(vector) == width) & F.forall(vector, fine)
    made = F.transform(vector.cast("array<double>"), lambda x: F.floor(F.lit(float(scale)) * x).cast("long"))
    return F.when(F.coalesce(usable, F.lit(False)), made)


def starts(vectors: DataFrame, clusters: int, seed: int) -> list[np.ndarray]:
    """The vectors with the smallest SHA-256 of ``seed:vec_id``, in that order; equal hashes by the vector, null ids last."""
    code = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = vectors.select(code.alias("code"), "x").orderBy(F.col("code").asc_nulls_last(), "x").limit(clusters).collect()
    return [np.array(r["x"], np.int64) for r in first]


def measured(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x to one centroid, or to one each."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


class Bounds:
    """State of a batch: own cluster, distances last measured, and the rounds in which they were."""

    def __init__(self, own: np.ndarray, far: np.ndarray, when: np.ndarray):
        self.own, self.far, self.when = own, far, when

    @classmethod
    def fresh(cls, x: np.ndarray, centroids: np.ndarray, now: int) -> Bounds:
        d = np.column_stack([measured(x, c) for c in centroids])
        return cls(d.argmin(axis=1).astype(np.int32), np.sqrt(d.astype(np.float64)), np.full(d.shape, now, np.int8))

    def step(self, x: np.ndarray, history: np.ndarray) -> int:
        """Move to the last round of ``history`` (round, centroid, component); the number of distances measured."""
        now, rows = len(history) - 1, np.arange(len(x))
        moved = np.sqrt((((history - history[now]).astype(np.float64)) ** 2).sum(axis=2))  # total displacement since each round
        gap = moved[self.when, np.arange(history.shape[1])]
        upper, lower = (self.far[rows, self.own] + gap[rows, self.own]) * (1 + SLACK), (self.far - gap) * (1 - SLACK)
        lower[rows, self.own] = np.inf
        nearest = lower.min(axis=1, initial=np.inf)
        open_ = np.flatnonzero(upper >= nearest)
        if not len(open_):
            return 0
        # tighten the own distance, then look again
        own, count = self.own[open_], len(open_)
        d = measured(x[open_], history[now][own])
        self.far[open_, own], self.when[open_, own] = np.sqrt(d.astype(np.float64)), now
        again = np.flatnonzero(self.far[open_, own] * (1 + SLACK) >= nearest[open_])
        open_, own, d = open_[again], own[again], d[again]
        exact = np.full((len(open_), history.shape[1]), np.iinfo(np.int64).max)
        exact[np.arange(len(open_)), own] = d
        near = lower[open_] <= (np.sqrt(d.astype(np.float64)) * (1 + SLACK))[:, None]
        for j in range(history.shape[1]):
            some = np.flatnonzero(near[:, j])
            if len(some):
                count += len(some)
                exact[some, j] = measured(x[open_[some]], history[now][j])
                self.far[open_[some], j], self.when[open_[some], j] = np.sqrt(exact[some, j].astype(np.float64)), now
        self.own[open_] = exact.argmin(axis=1)  # the first of equal ones
        return count


def table(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(np.ascontiguousarray(x).reshape(-1)))


def assigned(state: DataFrame, history: np.ndarray, first: bool) -> DataFrame:
    """``state`` (vec_id, x[, own, far, rounds]) moved to the last round of ``history``; ``measures`` counts distances."""
    k, width = history.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 4096):
                part = batch.slice(s, 4096)
                x = table(part.column(1), width)
                if first:
                    b, count = Bounds.fresh(x, history[-1], len(history) - 1), np.full(len(x), k)
                else:
                    own = part.column(2).to_numpy()
                    b = Bounds(own.copy(), table(part.column(3), k).copy(), table(part.column(4), k).astype(np.int8))
                    total = b.step(x, history)
                    count = np.zeros(len(x), np.int64)
                    count[0] = total
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(b.own), lists(b.far), lists(b.when.astype(np.int8)), pa.array(count)],
                                                 ["vec_id", "x", "own", "far", "rounds", "measures"])

    kind = state.schema["vec_id"].dataType.simpleString()
    given = state if first else state.select("vec_id", "x", "own", "far", "rounds")
    return given.mapInArrow(run, f"vec_id {kind}, x array<long>, own int, far array<double>, rounds array<tinyint>, measures long")


def means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count) of each cluster's vectors; a cluster without any keeps its centroid."""
    width = centroids.shape[1]
    sums = state.groupBy("own").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.col("x")[i]) for i in range(width)]).alias("s")).collect()  # K rows
    out = centroids.copy()
    for r in sums:
        out[r["own"]] = [v // r["n"] for v in r["s"]]
    return out


def cluster(rows: DataFrame, width: int = WIDTH, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, np.ndarray, list[int]]:
    """Clusters of ``rows`` (vec_id, embedding; others are left out): (vec_id, x, cluster, distance: squared) of each vector, the
    final centroids, and the distances measured in each round (without bounds: vectors times centroids).

    Vectors that ``integers`` makes null take no part; repeated rows and repeated vec_ids are vectors of their own, a null vec_id
    too, which starts no centroid before others do.  With fewer vectors than ``clusters`` there are as many clusters as vectors; an
    empty table gives an empty result.  A component of ``LARGEST`` or more stops the job: its squared distances would not fit in a long.
    """
    made = rows.select("vec_id", integers(F.col("embedding"), width, scale).alias("x")).where("x IS NOT NULL")
    fits = F.forall("x", lambda v: F.abs(v) < LARGEST)
    checked = F.when(fits, F.col("x")).otherwise(F.raise_error(F.lit(f"a component of {LARGEST} or more: squared distances do not fit in a long")).cast("array<long>"))
    state = written(made.withColumn("x", checked), "vectors")
    first = starts(state, clusters, seed)
    if not first:
        return state.select("vec_id", "x", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), np.zeros((0, width), np.int64), []
    history, spent = [np.array(first)], []
    for turn in range(rounds + 1):
        state = written(assigned(state, np.array(history), turn == 0), "assigned")
        spent.append(int(state.agg(F.sum("measures")).first()[0]))
        if turn < rounds:
            history.append(means(state, history[-1]))
    last = history[-1]

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, own = table(batch.column(1), width), batch.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(measured(x, last[own]))], ["vec_id", "x", "cluster", "distance"])

    kind = state.schema["vec_id"].dataType.simpleString()
    return state.select("vec_id", "x", "own").mapInArrow(close, f"vec_id {kind}, x array<long>, cluster int, distance long"), last, spent


def centroid_digest(c: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest()


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance with cluster_inertia, inertia (sums of the distances) and centroid_sha256 of each row's cluster."""
    spark = found.sparkSession
    found = written(found.drop("x"), "distances")
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # K rows
    rows = [(j, int(sums.get(j, 0)), int(sum(sums.values())), centroid_digest(c)) for j, c in enumerate(centroids)]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # K rows
