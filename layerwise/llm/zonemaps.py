"""Centroid clustering of vectors over space-filling-curve zone maps.

Vectors become whole numbers, ``floor(scale * x)`` per component, and are put in the order of a
Hilbert curve through all their dimensions, so that neighbours in the order are near each other.
Runs of ``BLOCK`` vectors are stored as one row with the box of their smallest and largest
components.  A round reads the blocks only: from a block's box follow, per centroid, the least and
the largest distance that any of its vectors can have; a centroid whose least distance exceeds
another's largest cannot be nearest to any of them.  The centroids that are left, the block's
candidates, are compared with its vectors exactly, in whole numbers.

A task adds up its vectors per centroid and gives one row each, so a centroid that a third of all
vectors choose costs one row a task.  The driver holds the centroids (``k`` times ``dims`` numbers)
and nothing else.  Equal vectors are spread over blocks by their place in the input.

Kept are vectors with exactly ``dims`` components, none of them null or non-finite; the others give
no row.  The first centroids are the ``k`` kept vectors with the smallest SHA-256 of
``<seed>:<vec_id>``; rows without an id come last, equal hashes in the order of their vectors; fewer
than ``k`` kept vectors make fewer centroids.  Repeated rows each count.  An empty table gives an
empty result; other columns are not read.  Components beyond 2**27 after scaling would not leave
room for exact distances in 64 bits and are refused with an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

K, ROUNDS, DIMS, SCALE, SEED = 16, 3, 64, 64, "1"
BLOCK = 512
#: Bits of each component that the order along the curve looks at.
CURVE_BITS = 5
_LARGEST = 1 << 27


def hilbert_keys(points: np.ndarray, bits: int) -> list[bytes]:
    """Places of ``points`` (rows; components under ``2**bits``) along the Hilbert curve, as strings of bytes
    that sort like them: rotate and reflect from the highest bit down, then Gray code, then interleave."""
    x = points.astype(np.int64).T.copy()
    for level in range(bits - 1, 0, -1):
        below = (1 << level) - 1
        for i in range(len(x)):
            high = (x[i] >> level) & 1 == 1
            swapped = np.where(high, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(high, below, swapped)
            if i:
                x[i] ^= swapped
    x = np.bitwise_xor.accumulate(x, axis=0)
    turn = np.zeros(x.shape[1], dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= turn
    planes = [(x >> level) & 1 for level in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def _whole_numbers(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """``vec_id, spot, vector, low, high`` of every kept vector; ``spot`` is its place in the input."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spot = TaskContext.get().partitionId() << 36
        for batch in batches:
            column = batch.column("embedding")
            fits = pc.fill_null(pc.equal(pc.list_value_length(column), dims), False)
            ids, column = batch.column("vec_id").filter(fits), column.filter(fits)
            values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)  # null: nan
            whole = np.floor(scale * values)
            kept = np.isfinite(values).all(axis=1)
            if (np.abs(whole[kept]) > _LARGEST).any():
                raise ValueError(f"a component exceeds {_LARGEST} after scaling")
            numbers = whole[kept].astype("<i4")
            yield pa.RecordBatch.from_arrays([
                ids.filter(pa.array(kept)), pa.array(spot + np.arange(len(numbers))),
                pa.array([row.tobytes() for row in numbers], pa.binary()),
                pa.array(numbers.min(axis=1, initial=_LARGEST)), pa.array(numbers.max(axis=1, initial=-_LARGEST))],
                ["vec_id", "spot", "vector", "low", "high"])
            spot += len(numbers)

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>")) \
        .mapInArrow(read, "vec_id long, spot long, vector binary, low int, high int")


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dims).astype(np.int64)


def _blocks(rows: DataFrame, dims: int, bits: int, block: int) -> DataFrame:
    """``ids, vectors, low, high``: runs of ``block`` vectors along the curve and their boxes."""
    span = rows.agg(F.min("low"), F.max("high")).first()
    least, width = (span[0], span[1] - span[0] + 1) if span[0] is not None else (0, 1)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = ((_matrix(batch.column("vector"), dims) - least) << bits) // width
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(hilbert_keys(cells, bits), pa.binary())], [*batch.schema.names, "key"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def rows_of(table: pa.Table) -> pa.RecordBatch:
            numbers = _matrix(table.column("vector"), dims)
            return pa.RecordBatch.from_arrays([
                pa.array([table.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([numbers.astype("<i4").tobytes()], pa.binary()),
                pa.array([numbers.min(axis=0).astype("<i4").tobytes()], pa.binary()),
                pa.array([numbers.max(axis=0).astype("<i4").tobytes()], pa.binary())], ["ids", "vectors", "low", "high"])

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            whole = len(table) // block * block
            for begin in range(0, whole, block):
                yield rows_of(table.slice(begin, block))
            held = table.slice(whole).to_batches()
        if sum(map(len, held)):
            yield rows_of(pa.Table.from_batches(held))

    ordered = rows.select("vec_id", "spot", "vector").mapInArrow(
        keyed, "vec_id long, spot long, vector binary, key binary").repartitionByRange("key", "spot") \
        .sortWithinPartitions("key", "spot")
    return ordered.select("vec_id", "vector").mapInArrow(
        cut, "ids array<long>, vectors binary, low binary, high binary")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to some vector of the box, ascending."""
    near = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    far = np.maximum(centroids - low, high - centroids)
    return np.flatnonzero((near * near).sum(axis=1) <= (far * far).sum(axis=1).min())


def _nearest(batch: pa.RecordBatch, row: int, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """A block's vectors, their nearest centroids (of equal ones the smallest number), distances, candidates."""
    dims = centroids.shape[1]
    low, high, vectors = (np.frombuffer(batch.column(c)[row].as_py(), "<i4").astype(np.int64)
                          for c in ("low", "high", "vectors"))
    vectors = vectors.reshape(-1, dims)
    chosen = candidates(low, high, centroids)
    middle = centroids[chosen]
    # |v|^2 is left out of the comparison; added back it makes the distance
    scores = (middle * middle).sum(axis=1) - 2 * (vectors @ middle.T)
    best = scores.argmin(axis=1)
    distance = (vectors * vectors).sum(axis=1) + scores[np.arange(len(vectors)), best]
    return vectors, chosen[best], distance, len(chosen)


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after a round: whole-number means of their vectors; those without any stay."""
    k, dims = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dims + 1), dtype=np.int64)  # last column: vectors
        for batch in batches:
            for row in range(batch.num_rows):
                vectors, cluster, _, _ = _nearest(batch, row, centroids)
                for c in np.unique(cluster):
                    mine = vectors[cluster == c]
                    sums[c, :dims] += mine.sum(axis=0)
                    sums[c, dims] += len(mine)
        used = np.flatnonzero(sums[:, dims])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(sums[used].tolist(), pa.list_(pa.int64()))], ["cluster", "sums"])

    parts = blocks.select("vectors", "low", "high").mapInArrow(add, "cluster int, sums array<long>")
    totals = parts.select("cluster", F.posexplode("sums").alias("place", "value")).groupBy("cluster", "place") \
        .agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("total")).collect()  # k times (dims + 1) rows
    found = {(r["cluster"], r["place"]): int(r["total"]) for r in totals}
    moved = centroids.copy()
    for c in range(k):
        count = found.get((c, dims), 0)
        if count:
            moved[c] = [found[c, d] // count for d in range(dims)]
    return moved


def clustered(vectors: DataFrame, *, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE,
              seed: str = SEED, bits: int = CURVE_BITS, block: int = BLOCK) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance, candidates`` of every kept vector, and the final centroids (rows).

    ``candidates``: centroids that its block had to compare."""
    rows = stored(_whole_numbers(vectors, dims, scale), "zone-vectors")
    ranked = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select("vector", ranked.alias("hash")).orderBy(F.col("hash").asc_nulls_last(), "vector").limit(k).collect()
    centroids = np.array([np.frombuffer(r["vector"], "<i4") for r in first], dtype=np.int64).reshape(-1, dims)
    blocks = stored(_blocks(rows, dims, bits, block), "zone-blocks")
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(blocks, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                _, cluster, distance, compared = _nearest(batch, row, centroids)
                yield pa.RecordBatch.from_arrays([
                    batch.column("ids").slice(row, 1).flatten(), pa.array(cluster.astype(np.int32)), pa.array(distance),
                    pa.array(np.full(len(cluster), compared, dtype=np.int32))],
                    ["vec_id", "cluster", "distance", "candidates"])

    placed = blocks.mapInArrow(assign, "vec_id long, cluster int, distance long, candidates int")
    return stored(placed, "zone-assigned"), centroids


def digest(vectors: DataFrame) -> DataFrame:
    """Cluster and distance of every kept vector, the inertia of its cluster and of all, its centroid's SHA-256."""
    placed, centroids = clustered(vectors)
    spark = vectors.sparkSession
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("inertia")).collect()
    total = sum(int(r["inertia"]) for r in sums)  # at most k rows
    rows = [(r["cluster"], int(r["inertia"]), total, hashlib.sha256(
        ",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()) for r in sums]
    clusters = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(clusters), "cluster") \
        .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
