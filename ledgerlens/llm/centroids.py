"""k-means on integer vectors, its distance work filtered by n-simplex projection.

Some vectors are pivots. A vector's distances to them, computed once and stored, become the apex of
a simplex over the pivots: a place in the space that the pivots span, and a
height above it. Two apexes on the same side of that space are never farther
apart than their vectors are, on opposite sides never closer. So a centroid
whose lower bound lies above the least upper bound of all is not the nearest
one; only the others are compared, exactly, in integers. Rounding is covered by a
margin, so the bounds decide nothing that is not certain.

Each round is one pass over the stored vectors: a task adds up its vectors by
centroid and sends ``k`` x ``dims`` sums; their totals (no more rows than
that) make the next centroids on the driver. A round that changes no centroid
ends the loop, since all later ones would repeat it.

Defined cases: vectors of another length, or with a null or non-finite
component, are left out; a null id counts as the empty string where start
vectors are drawn, and vectors with equal ids are ordered by their components; equal
distances go to the smaller number; with fewer than ``k`` vectors there are as many
centroids as vectors; an empty table gives an empty result. Repeated rows are
vectors of their own; further columns are ignored. A component of
:data:`LIMIT` or more (as an integer) raises, since squared distances
would leave the range of a long. Vectors have a fixed length, so no row is long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored

#: Integer components lie below this in size.
LIMIT = 1 << 27
#: What the driver holds and sends to the tasks: k x dims numbers at most.
MOST_NUMBERS = 1 << 20
#: A pivot must stand this far above the others' simplex, as a share of the first pivots' squared distance.
LEAST_HEIGHT = 1e-2


def integer_vectors(df: DataFrame, scale: int = 1024, dims: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): vectors of ``dims`` finite components as floor(scale * x)."""
    x = F.transform(F.col(vector_col), lambda e: e.cast("double"))
    finite = (F.size(x) == dims) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    whole = F.transform(x, lambda e: F.floor(e * F.lit(float(scale))))
    fits = F.forall(whole, lambda e: F.abs(e) < LIMIT)
    checked = F.when(fits, whole).otherwise(F.raise_error(F.lit(f"a vector component is {LIMIT} or more")).cast("array<bigint>"))
    return df.where(finite).select(F.col(id_col).alias("vec_id"), checked.cast("array<int>").alias("v"))


def first_vectors(vectors: DataFrame, n: int, dims: int, seed: int = 3) -> np.ndarray:
    """The ``n`` vectors with the least sha256 of ``seed:vec_id`` (a top-n)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("_h"), "v").orderBy("_h", "v").limit(n).collect()
    return np.array([r.v for r in rows], np.int64).reshape(len(rows), dims)


class Simplex:
    """Apexes over a simplex of pivots, from squared distances to them."""

    def __init__(self, candidates: np.ndarray):
        """Takes from ``candidates`` (rows), one after another, the one that
        stands highest above the simplex so far, while one stands high enough."""
        self.pivots = candidates[:1]
        self.base = np.zeros((len(self.pivots), 0))  # the pivots' places: a lower triangle
        self._solve()
        while len(self.pivots) < len(candidates):
            apex = self.apexes(candidates)
            at = int(apex[:, -1].argmax())
            height = apex[at, -1]
            if height <= 0 or (len(self.pivots) > 1 and height ** 2 < LEAST_HEIGHT * (self.base[1] ** 2).sum()):
                break
            self.pivots = np.vstack([self.pivots, candidates[at]])
            self.base = np.vstack([np.pad(self.base, ((0, 0), (0, 1))), apex[at]])
            self._solve()

    def _solve(self) -> None:
        edges = self.base[1:]
        self.inverse = np.linalg.inv(2 * edges) if len(edges) else np.zeros((0, 0))
        self.narrow = np.linalg.svd(edges, compute_uv=False).min() if len(edges) else np.inf
        self.norms = (edges ** 2).sum(1)

    def squared_distances(self, vectors: np.ndarray) -> np.ndarray:
        return np.stack([((vectors - p) ** 2).sum(1) for p in self.pivots], 1)

    def apexes(self, vectors: np.ndarray, distances: np.ndarray | None = None) -> np.ndarray:
        """A row for each vector: its place over the pivots, then its height."""
        d = (self.squared_distances(vectors) if distances is None else distances).astype(np.float64)
        place = (self.norms + d[:, :1] - d[:, 1:]) @ self.inverse.T
        height = np.sqrt(np.maximum(d[:, 0] - (place ** 2).sum(1), 0))
        return np.column_stack([place, height])

    def candidates(self, apexes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """For each apex (row) and each centroid's apex whether that centroid can be the nearest one."""
        along = ((apexes[:, None, :-1] - centroids[None, :, :-1]) ** 2).sum(2)
        h, c = apexes[:, None, -1], centroids[None, :, -1]
        lower, upper = along + (h - c) ** 2, along + (h + c) ** 2
        size = (apexes ** 2).sum(1) + (centroids ** 2).sum(1).max()  # squared distances to the first pivot
        margin = 1e-6 * size * np.sqrt(np.maximum(1.0, np.sqrt(size) / self.narrow))
        return lower <= (upper.min(1) + margin)[:, None]


def nearest(simplex: Simplex, vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray,
            with_distance: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance to it) of each row.
    Only where several centroids can be the nearest, or the distance is asked
    for, integers are compared."""
    can = simplex.candidates(apexes, simplex.apexes(centroids))
    number = can.argmax(1)
    distance = np.full(len(vectors), np.iinfo(np.int64).max)
    open_ = np.ones(len(vectors), bool) if with_distance else can.sum(1) > 1
    for k in range(len(centroids)):
        rows = np.flatnonzero(can[:, k] & open_)
        d = ((vectors[rows] - centroids[k]) ** 2).sum(1)
        closer = d < distance[rows]
        number[rows[closer]], distance[rows[closer]] = k, d[closer]
    return number, distance


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


class Clustering:
    """Rounds over stored vectors, and what comes out of them."""

    def __init__(self, vectors: DataFrame, k: int = 8, pivots: int = 16, dims: int = 64, seed: int = 3):
        if max(k, pivots) * dims > MOST_NUMBERS:
            raise ValueError(f"k x dims may be {MOST_NUMBERS} at most")
        first = first_vectors(vectors, max(k, pivots), dims, seed)
        self.dims, self.centroids = dims, first[:k]
        self.simplex = Simplex(first[:pivots]) if len(first) else None
        self.table = self._with_apexes(vectors)

    def _with_apexes(self, vectors: DataFrame) -> DataFrame:
        """Stored (vec_id, v, apex)."""
        simplex, dims = self.simplex, self.dims

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                apex = simplex.apexes(_matrix(b.column("v"), dims).astype(np.int64)) if b.num_rows else np.zeros((0, 1))
                offsets = np.arange(b.num_rows + 1, dtype=np.int32) * apex.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id"), b.column("v"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(apex.ravel()))],
                    ["vec_id", "v", "apex"])

        id_type = vectors.schema["vec_id"].dataType.simpleString()
        return stored(vectors.mapInArrow(run, f"vec_id {id_type}, v array<int>, apex array<double>"), "apexes")

    def _pass(self, batch: pa.RecordBatch, centroids: np.ndarray, with_distance: bool):
        vectors = _matrix(batch.column("v"), self.dims).astype(np.int64)
        apexes = _matrix(batch.column("apex"), len(self.simplex.pivots))
        return vectors, *nearest(self.simplex, vectors, apexes, centroids, with_distance)

    def round(self) -> bool:
        """One assignment and update; whether a centroid changed."""
        me, centroids, k, dims = self._in_tasks(), self.centroids, len(self.centroids), self.dims

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
            for b in batches:
                if b.num_rows:
                    vectors, number, _ = me._pass(b, centroids, False)
                    count += np.bincount(number, minlength=k)
                    for c in range(k):
                        total[c] += vectors[number == c].sum(0)
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(used, dims)), pa.array(np.tile(np.arange(dims), len(used))),
                 pa.array(total[used].ravel()), pa.array(np.repeat(count[used], dims))], ["cluster", "dim", "total", "n"])

        parts = self.table.select("v", "apex").mapInArrow(run, "cluster long, dim long, total long, n long")
        sums = parts.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
                                                   F.sum("n").alias("n")).collect()
        after = centroids.copy()
        for r in sums:
            after[r.cluster, r.dim] = int(r.total) // r.n
        changed = bool((after != centroids).any())
        self.centroids = after
        return changed

    def assigned(self) -> DataFrame:
        """Stored (vec_id, cluster, distance) for the centroids as they are."""
        me, centroids = self._in_tasks(), self.centroids

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    _, number, distance = me._pass(b, centroids, True)
                    yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance)],
                                                     ["vec_id", "cluster", "distance"])

        id_type = self.table.schema["vec_id"].dataType.simpleString()
        return stored(self.table.mapInArrow(run, f"vec_id {id_type}, cluster int, distance long"), "clusters")

    def _in_tasks(self) -> Clustering:
        """Without the table, which tasks neither need nor can hold."""
        out = object.__new__(Clustering)
        out.dims, out.simplex = self.dims, self.simplex
        return out


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, pivots: int = 16, dims: int = 64, seed: int = 3) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every row of :func:`integer_vectors`, final centroids)."""
    made = Clustering(vectors, k, pivots, dims, seed)
    if made.simplex is not None:
        for _ in range(rounds):
            if not made.round():
                break
    return made.assigned(), made.centroids


def op12_centroid_clustering(embeddings: DataFrame) -> DataFrame:
    spark = embeddings.sparkSession
    rows, centroids = cluster(integer_vectors(embeddings))
    sums = {r.cluster: int(r.s) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    facts = spark.createDataFrame(
        [(c, sums.get(c, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, v.tolist())).encode()).hexdigest())
         for c, v in enumerate(centroids)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # one row for each centroid
    return rows.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
