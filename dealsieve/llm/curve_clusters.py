"""Centroid clustering over space-filling-curve zone maps.

Vectors are scaled to integers, ordered along a Hilbert curve over the
``CURVE_DIMS`` components that vary most, and cut into blocks of consecutive
vectors.  A block is one row: its vectors and the smallest and largest value
of every component (its box).  A round reads the blocks only: the centroid
nearest to the box's middle is the reference, and a centroid whose distance,
less the reference's, is positive everywhere in the box cannot be nearest to
any vector of the block.  The others are the block's candidates, and exact
distances are computed to them for all vectors of the block at once.

A task adds up its blocks and returns one row of sums a cluster; Spark adds
the tasks' rows, and the driver sees ``clusters`` x components numbers a
round.  Equal vectors are dealt over tasks by the order in which they were
read, so no value of the curve fills one task.

All arithmetic is on integers.  In blocks and centroids within ``EXACT`` the
products are sums below 2 ** 53, which float matrix products hold exactly;
wider blocks use 64-bit integers and compare all centroids.

Defined results: rows whose vector is null, has another number of components,
or a null or non-finite component are left out; a scaled component beyond
2 ** 27 counts as 2 ** 27; a null id hashes as the empty text; repeated rows
are vectors of their own, equal hashes are ordered by components; with fewer
vectors than clusters there are as many clusters as vectors; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealsieve.llm.common import materialise, ship_by_value, small_batches

COMPONENTS = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = 2
BLOCK_ROWS = 128
CURVE_DIMS, CURVE_BITS = 16, 4      # 64 bits of Hilbert key
WIDEST = 1 << 27
EXACT = 1 << 22


def kept_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and x, the scaled integer components, of every row with a whole finite vector."""
    raw = F.col(f"`{vector_col}`").cast("array<double>")
    whole = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    scaled = F.transform(raw, lambda x: F.greatest(F.least(F.floor(x * SCALE), F.lit(WIDEST)), F.lit(-WIDEST)).cast("int"))
    return df.where((F.size(raw) == COMPONENTS) & whole) \
        .select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), scaled.alias("x"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest hashes of their id, in ascending order of the hash."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("h"), "x").orderBy("h", "x").limit(clusters).collect()
    return np.array([r.x for r in rows], np.int64).reshape(len(rows), COMPONENTS)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), COMPONENTS)


def spreads(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of every component, from one row of sums a batch."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0)).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(COMPONENTS, dtype=np.int32)), pa.array(np.full(COMPONENTS, len(x), np.int64)),
                 pa.array(x.sum(0)), pa.array((x * x).sum(0))], ["j", "n", "s", "q"])

    total = vectors.select("x").mapInArrow(add, "j int, n long, s double, q double") \
        .groupBy("j").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).collect()
    mean, deviation = np.zeros(COMPONENTS), np.zeros(COMPONENTS)
    for r in total:
        if r.n:
            mean[r.j] = r.s / r.n
            deviation[r.j] = max(r.q / r.n - mean[r.j] ** 2, 0.0) ** 0.5
    return mean, deviation


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of every row of cell numbers, at most 64 bits in all.

    From the top bit down each axis is reflected or exchanged with the first
    one, as the sub-cube that the bits above chose asks for; the axes' Gray
    code, bit by bit over all axes, is then the position.
    """
    axes = [cells[:, i].astype(np.uint64) for i in range(cells.shape[1])]
    for b in range(bits - 1, 0, -1):
        below = np.uint64((1 << b) - 1)
        for i in range(len(axes)):
            reflect = (axes[i] >> np.uint64(b)) & np.uint64(1) == 1
            swap = np.where(reflect, np.uint64(0), (axes[0] ^ axes[i]) & below)
            axes[0] = np.where(reflect, axes[0] ^ below, axes[0] ^ swap)
            if i:
                axes[i] = axes[i] ^ swap
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    flip = np.zeros(len(cells), np.uint64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((axes[-1] >> np.uint64(b)) & np.uint64(1) == 1, np.uint64((1 << b) - 1), np.uint64(0))
    key = np.zeros(len(cells), np.uint64)
    for b in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << np.uint64(1)) | (((axis ^ flip) >> np.uint64(b)) & np.uint64(1))
    return key


def curve_blocks(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row a block: ids, vectors (int32, row by row), and the box's corners.

    Vectors are range-partitioned and sorted by their place on the curve.
    """
    mean, deviation = spreads(vectors)
    axes = np.sort(np.argsort(-deviation, kind="stable")[:CURVE_DIMS])
    cells = 1 << CURVE_BITS
    step = np.where(deviation[axes] > 0, deviation[axes] * 4 / cells, 1.0)     # the cells span two deviations each way

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            cell = np.clip(np.floor((x[:, axes] - mean[axes]) / step) + cells // 2, 0, cells - 1)
            key = (hilbert_keys(cell, CURVE_BITS) ^ np.uint64(1 << 63)).view(np.int64)
            packed = pa.array([row.tobytes() for row in np.ascontiguousarray(x, np.int32)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed, pa.array(key), batch.column(2)],
                                             ["vec_id", "x", "key", "nth"])

    def block(ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary()),
             pa.array([x.min(0).tobytes()], pa.binary()), pa.array([x.max(0).tobytes()], pa.binary())],
            ["ids", "x", "low", "high"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, x = pa.array([], pa.int64()), np.zeros((0, COMPONENTS), np.int32)
        for batch in batches:
            ids = pa.concat_arrays([ids, batch.column(0)])
            x = np.concatenate([x, np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int32).reshape(-1, COMPONENTS)])
            whole = len(x) // block_rows * block_rows
            for i in range(0, whole, block_rows):
                yield block(ids[i:i + block_rows], x[i:i + block_rows])
            ids, x = ids[whole:], x[whole:]
        if len(x):
            yield block(ids, x)

    spread = small_batches(vectors).withColumn("nth", F.monotonically_increasing_id()) \
        .mapInArrow(keyed, "vec_id long, x binary, key long, nth long")
    ordered = spread.repartitionByRange("key", "nth").sortWithinPartitions("key", "nth")
    return ordered.select("vec_id", "x").mapInArrow(cut, "ids array<long>, x binary, low binary, high binary")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers, ascending, of the centroids that may be nearest to a vector between ``low`` and ``high``.

    For the reference r and a centroid c, d(x, r) - d(x, c) is linear in x, so
    its largest value in the box is taken at a corner, component by component.
    If even that is below zero, c is farther than r from every vector.
    """
    middle = (low + high) / 2
    reference = centroids[((centroids - middle) ** 2).sum(1).argmin()]
    apart = centroids - reference
    corner = np.where(apart > 0, high, low)
    most = 2 * (corner * apart).sum(1) + (reference ** 2).sum() - (centroids ** 2).sum(1)
    return np.flatnonzero(most >= 0)


def nearest(x: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: the smaller number) and squared distance of every vector, and the number of candidates."""
    if max(-low.min(), high.max(), np.abs(centroids).max()) <= EXACT:
        near = candidates(low.astype(np.float64), high.astype(np.float64), centroids.astype(np.float64))
        v, c = x.astype(np.float64), centroids[near].astype(np.float64)
        distance = (v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)
    else:
        near = np.arange(len(centroids))
        distance = np.stack([((x.astype(np.int64) - c) ** 2).sum(1) for c in centroids], 1)
    first = distance.argmin(1)
    return near[first], distance[np.arange(len(x)), first].astype(np.int64), len(near)


def _read(blocks: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Scalar, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in blocks:
        for ids, x, low, high in zip(*batch.columns):
            yield (ids, np.frombuffer(x.as_py(), np.int32).reshape(-1, COMPONENTS),
                   np.frombuffer(low.as_py(), np.int32), np.frombuffer(high.as_py(), np.int32))


def move_centroids(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid replaced by floor(sum / count) of the vectors nearest to it; one without vectors stays."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centroids), np.int64)
        total = np.zeros((len(centroids), COMPONENTS), np.int64)
        for _, x, low, high in _read(batches):
            cluster, _, _ = nearest(x, low, high, centroids)
            for k in np.unique(cluster):
                own = x[cluster == k]
                count[k] += len(own)
                total[k] += own.sum(0, dtype=np.int64)
        for k in np.flatnonzero(count):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(COMPONENTS, k, np.int32)), pa.array(np.arange(COMPONENTS, dtype=np.int32)),
                 pa.array(np.full(COMPONENTS, count[k])), pa.array(total[k])], ["k", "j", "n", "s"])

    wide = "decimal(38,0)"
    rows = blocks.mapInArrow(add, "k int, j int, n long, s long") \
        .groupBy("k", "j").agg(F.sum(F.col("n").cast(wide)).alias("n"), F.sum(F.col("s").cast(wide)).alias("s")).collect()
    moved = centroids.copy()
    for r in rows:
        moved[r.k, r.j] = int(r.s) // int(r.n)
    return moved


def assign(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance and n_candidates (centroids its block was compared with) of every vector."""
    kinds = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64()), ("n_candidates", pa.int32())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x, low, high in _read(batches):
            cluster, distance, near = nearest(x, low, high, centroids)
            yield pa.RecordBatch.from_arrays(
                [ids.values, pa.array(cluster.astype(np.int32)), pa.array(distance),
                 pa.array(np.full(len(x), near, np.int32))], schema=kinds)

    return blocks.mapInArrow(compare, "vec_id long, cluster int, distance long, n_candidates int")


def cluster_vectors(df: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED,
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row a kept vector: cluster, squared distance, inertia of its cluster and of all, its centroid and the centroid's hash."""
    spark = df.sparkSession
    vectors = kept_vectors(df, id_col, vector_col)
    centroids = first_centroids(vectors, clusters, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, n_candidates int, cluster_inertia long, "
                                         "inertia long, centroid array<long>, centroid_sha256 string")
    blocks = materialise(curve_blocks(vectors), "blocks")
    for _ in range(rounds):
        centroids = move_centroids(blocks, centroids)
    assigned = materialise(assign(blocks, centroids), "assigned")
    inertia = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    largest = (1 << 63) - 1
    total = min(sum(int(r.s) for r in inertia), largest)
    rows = [(r.cluster, min(int(r.s), largest), total, centroids[r.cluster].tolist(),
             hashlib.sha256(",".join(map(str, centroids[r.cluster].tolist())).encode()).hexdigest()) for r in inertia]
    table = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<long>, "
                                        "centroid_sha256 string")
    # One row a cluster: at most ``clusters`` rows are broadcast.
    return assigned.join(F.broadcast(table), "cluster") \
        .select("vec_id", "cluster", "distance", "n_candidates", "cluster_inertia", "inertia", "centroid", "centroid_sha256")


ship_by_value(__name__)
