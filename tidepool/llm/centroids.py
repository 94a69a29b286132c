"""Exact k-means over integer vectors by Shallot search.

A vector's state is its nearest and its second nearest centroid with an upper
bound of the distance to the first and a lower bound of the distance to every
other.  After centroids have moved, bounds are widened by how far; a vector
whose upper bound stays below its lower bound, or below half the distance from
its centroid to the next one, keeps its centroid unseen.  For the others the
distances to both remembered centroids are taken, and the closer one's
neighbours are scanned in order of their distance from it.  The ball in which a
neighbour may still matter has the radius (distance to the centre) + (second
smallest distance so far); it shrinks whenever a closer one is found, and the
scan of a vector ends at the first neighbour outside.  Survivors are compared by
exact integer squared distances (ties: the smaller number); bounds are floats,
widened by a margin beyond their rounding error, and only ever leave out what
is surely further away.

On Spark the vectors with their state are one table a round, written in the
shared folder (which ends the lineage, and the round before is deleted).  Each
task pre-aggregates its vectors to one row per centroid; only those are
shuffled, so a centroid that owns a third of all vectors is no hot key.  What
reaches the driver are the k centroids (k times the dimension numbers).

Defined results: a vector that is null, has another number of components, or a
null or non-finite one is left out; a null id counts as the empty text in the
hash; repeated rows are vectors of their own, and of equal hashes the smaller
vector comes first as a start; with fewer vectors than k every one is a start;
a table without vectors gives no rows; other columns are ignored.  Integers are
exact up to ``LIMIT`` in size, beyond it (256 times a component of 2 ** 52) a
squared distance fits no long and the job stops with a message; so it does for
a distance or an inertia that no long holds.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.scratch import drop, shared_folder

#: Largest size of a component's integer; up to EXACT float64 products of them are exact sums.
LIMIT = 1 << 60
EXACT = 1 << 21
#: Relative and absolute margin of the float bounds.
_MARGIN = 1e-9

_STATE = "vec_id bigint, v array<bigint>, near int, next int, upper double, lower double"


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x from the rows of c at the same place (or from one c)."""
    d = x - c
    big = max((int(abs(m)) for m in (d.max(initial=0), d.min(initial=0))), default=0)
    if big <= EXACT:
        return np.einsum("ij,ij->i", d, d)
    return (d.astype(object) ** 2).sum(axis=1)


@dataclass
class Search:
    """The centroids of a round, how far each has moved since the last one, and their neighbours."""

    centers: np.ndarray  # int64, k rows
    moved: np.ndarray  # float64, k

    def __post_init__(self):
        k = len(self.centers)
        between = np.array([[float(d) for d in squared(self.centers, c)] for c in self.centers]).reshape(k, k)
        self.between = np.sqrt(between)
        self.order = np.argsort(self.between, axis=1, kind="stable")
        apart = self.between + np.where(np.eye(k, dtype=bool), np.inf, 0)
        self.half = apart.min(axis=1) / 2 if k > 1 else np.full(k, np.inf)
        # the furthest move of any other centroid
        top = np.argsort(-self.moved, kind="stable")[:2]
        self.others = np.full(k, self.moved[top[0]] if k else 0.0)
        if k:
            self.others[top[0]] = self.moved[top[1]] if k > 1 else 0.0

    def assign(self, x: np.ndarray, near: np.ndarray, second: np.ndarray, upper: np.ndarray,
               lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """New (near, second, upper, lower) of the rows of x; near -1 where none is known."""
        near, second, upper, lower = near.copy(), second.copy(), upper.copy(), lower.copy()
        fresh = near < 0
        near[fresh], second[fresh] = 0, min(1, len(self.centers) - 1)
        upper = _up(upper + self.moved[near])
        lower = np.where(fresh, 0.0, _down(lower - self.others[near]))
        bound = np.maximum(lower, _down(self.half[near]))
        open_ = np.flatnonzero(fresh | ~(upper < bound))
        if len(open_):  # the exact distance may be enough
            upper[open_] = _up(_root(squared(x[open_], self.centers[near[open_]])))
            open_ = open_[fresh[open_] | ~(upper[open_] < bound[open_])]
        if not len(open_) or len(self.centers) == 1:
            lower[open_] = np.inf
            return near, second, upper, lower
        a, b = near[open_], second[open_]
        da, db = squared(x[open_], self.centers[a]), squared(x[open_], self.centers[b])
        swap = ((db < da) | ((db == da) & (b < a))).astype(bool)
        a, b, da, db = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, db, da), np.where(swap, da, db)
        for center in np.unique(a):
            at = np.flatnonzero(a == center)
            rows = open_[at]
            near[rows], second[rows], upper[rows], lower[rows] = self._scan(int(center), x[rows], da[at], b[at], db[at])
        return near, second, upper, lower

    def _scan(self, center: int, x: np.ndarray, d1: np.ndarray, second: np.ndarray, d2: np.ndarray):
        """Scan the neighbours of ``center``, the closer remembered one (at d1) of each row of x, ``second`` (at d2) the other."""
        first, around = np.full(len(x), center), _root(d1)
        other, remembered = second.copy(), second
        d1, d2 = d1.copy(), d2.copy()
        live = np.arange(len(x))
        for j in self.order[center]:
            if j == center:
                continue
            # neighbours come by rising distance and d2 only falls: once outside, outside for good
            live = live[self.between[center, j] <= _up(around[live] + _root(d2[live]))]
            if not len(live):
                break
            rows = live[remembered[live] != j]
            d = squared(x[rows], self.centers[j])
            closest = ((d < d1[rows]) | ((d == d1[rows]) & (j < first[rows]))).astype(bool)
            r = rows[closest]
            other[r], d2[r], first[r], d1[r] = first[r], d1[r], j, d[closest]
            between = ~closest & (d < d2[rows]).astype(bool)
            other[rows[between]], d2[rows[between]] = j, d[between]
        return first, other, _up(_root(d1)), _down(_root(d2))


def _up(x: np.ndarray) -> np.ndarray:
    return x * (1 + _MARGIN) + _MARGIN


def _down(x: np.ndarray) -> np.ndarray:
    return np.maximum(x * (1 - _MARGIN) - _MARGIN, 0)


def _root(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64))


def integers(vectors: DataFrame, dim: int, scale: int, id_col: str, col: str) -> DataFrame:
    """(vec_id, v) of the vectors that are kept, ``v`` the integers floor(scale * x)."""
    finite = F.forall(col, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    whole = F.transform(col, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    fits = F.forall(col, lambda x: F.abs(x.cast("double")) * F.lit(float(scale)) < F.lit(float(LIMIT)))
    kept = vectors.where(F.col(col).isNotNull() & (F.size(col) == dim) & finite)
    checked = F.when(F.assert_true(fits, "a component is too large for squared distances in a long").isNull(), whole)
    return kept.select(F.col(id_col).cast("bigint").alias("vec_id"), checked.alias("v"))


def starts(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors of the smallest sha256 of ``seed:id``, in that order."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return np.array([r["v"] for r in vectors.orderBy(h, "v").limit(k).collect()], dtype=np.int64)


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(n, -1)


def _assigned(state: DataFrame, centers: np.ndarray, moved: np.ndarray) -> DataFrame:
    """``state`` after one more assignment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centers, moved)
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(1), b.num_rows)
                found = search.assign(x, *(np.asarray(b.column(i)) for i in range(2, 6)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), *(pa.array(f, t) for f, t in zip(found, (pa.int32(), pa.int32(), pa.float64(), pa.float64())))],
                    names=["vec_id", "v", "near", "next", "upper", "lower"])

    return state.mapInArrow(run, _STATE)


def _moved(state: DataFrame, centers: np.ndarray) -> np.ndarray:
    """The centroids after the round: floor(sum / count) of their vectors, where they have any."""
    k, dim = centers.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, dim), dtype=object)
        for b in batches:
            if b.num_rows:
                near, x = np.asarray(b.column(0)), _matrix(b.column(1), b.num_rows)
                small = max(abs(int(x.max())), abs(int(x.min()))) * len(x) < 1 << 62
                for c in np.unique(near):
                    rows = x[near == c]
                    n[c] += len(rows)
                    sums[c] += (rows if small else rows.astype(object)).sum(axis=0).astype(object)
        own = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(n[own], pa.int64()),
                                          pa.array([[str(s) for s in sums[c]] for c in own], pa.list_(pa.string()))], names=["c", "n", "s"])

    rows = state.select("near", "v").mapInArrow(partial, "c int, n bigint, s array<string>")
    per_dim = rows.select("c", "n", F.posexplode("s").alias("i", "s")).groupBy("c", "i").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    after = centers.copy()
    for r in per_dim.collect():  # k * dim rows
        after[r["c"], r["i"]] = int(r["s"]) // r["n"]
    return after


def _distances(state: DataFrame, centers: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                near = np.asarray(b.column(1))
                d = squared(_matrix(b.column(2), b.num_rows), centers[near])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(d.tolist(), pa.int64())],
                                                 names=["vec_id", "cluster", "distance"])

    return state.select("vec_id", "near", "v").mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2,
            id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of
    every vector after ``rounds`` of assignment and update and one more assignment."""
    if k < 1 or rounds < 0 or dim < 1:
        raise ValueError("k and dim must be positive, rounds not negative")
    spark = vectors.sparkSession
    base = f"{shared_folder(spark)}/centroids/{uuid.uuid4().hex}"
    whole = integers(vectors, dim, scale, id_col, col)
    centers = starts(whole, k, seed)
    if not len(centers):
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    state = whole.select("vec_id", "v", F.lit(-1).alias("near"), F.lit(-1).alias("next"), F.lit(0.0).alias("upper"), F.lit(0.0).alias("lower"))
    moved = np.zeros(len(centers))
    for r in range(rounds + 1):
        _assigned(state, centers, moved).write.parquet(f"{base}/{r}")
        state = spark.read.schema(_STATE).parquet(f"{base}/{r}")
        if r:
            drop(spark, f"{base}/{r - 1}")
        if r < rounds:
            after = _moved(state, centers)
            centers, moved = after, _up(_root(squared(after, centers)))
    _distances(state, centers).write.parquet(f"{base}/found")
    drop(spark, f"{base}/{rounds}")
    found = spark.read.schema("vec_id bigint, cluster int, distance bigint").parquet(f"{base}/found")
    sha = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centers]
    inertias = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(inertias.values())
    if total >= 1 << 63:
        raise ValueError("the inertia fits no long")
    per = spark.createDataFrame([(c, s, total, sha[c]) for c, s in inertias.items()],
                                "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # per: k rows
