"""Near copies of embeddings by randomised-rotation binary codes.

A unit vector is turned by fixed random rotations; the signs of the turned coordinates are its
binary code.  Groups of code bits are bucket keys, and per vector the correction factor of the
first rotation's code is stored: the inner product of the turned vector and its own code.  Within
a bucket the inner product of two vectors is first estimated from the code of one, divided by its
factor, and the turned other, which is unbiased over rotations.  Its confidence bound decides: a
pair whose upper bound is under the threshold is dropped, every other pair is recomputed exactly
in double precision, and only exact cosines make links.

Bits per key follow the number of vectors, and the number of keys follows from the bits such that
a pair right at the threshold shares none with probability ``MISS``.  A pair is counted in the
first key that it shares.  Exact copies are one weighted class from the start.  A bucket of more
than ``CHUNK`` classes is dealt into chunks, and pairs of chunks are handled apart, so no task
holds a whole bucket; tasks give a row per class, not per pair.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and
vectors of different lengths never link.  Rows without an id take part but name no component;
repeated rows link with each other like any copies.  Empty tables give an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks
from .components import components, named, with_nodes
from .shared import stored

THRESHOLD = 0.95
MISS = 0.01
CHUNK = 256
#: Half-width of the estimate's confidence interval in standard deviations.
SIGMAS = 4.0
PAIRS_AT_ONCE = 200_000


def plan_keys(vectors: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Bits per key and number of keys for so many vectors."""
    bits = min(30, max(6, math.ceil(math.log2(vectors + 2)) + 2))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - agree))


@lru_cache(maxsize=16)
def _rotation(size: int, number: int) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng([20_240, size, number]).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def _unit(vector: np.ndarray) -> np.ndarray | None:
    if not vector.size or not np.isfinite(vector).all():
        return None
    most = np.abs(vector).max()
    if most == 0:
        return None
    scaled = vector / most
    return scaled / np.sqrt(scaled @ scaled)


def _codes(units: np.ndarray, bits: int, keys: int) -> tuple[np.ndarray, np.ndarray]:
    """Key numbers (rows x keys) and first-rotation factors of unit vectors of one length."""
    size = units.shape[1]
    signs, factor = [], None
    for number in range(-(-bits * keys // size)):
        turned = units @ _rotation(size, number)
        if factor is None:
            factor = np.abs(turned).sum(axis=1) / math.sqrt(size)
        signs.append(turned >= 0)
    flat = np.concatenate(signs, axis=1)[:, :bits * keys].reshape(len(units), keys, bits)
    return flat @ (1 << np.arange(bits, dtype=np.int64)), factor


def _read(vectors: DataFrame) -> DataFrame:
    """``vec_id, unit, digest``: unit vectors as doubles; null for vectors that link with nothing."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, digests = [], []
            for values in batch.column("embedding").to_pylist():
                unit = None if values is None or None in values else _unit(np.array(values, dtype=np.float64))
                units.append(None if unit is None else unit.astype("<f8").tobytes())
                digests.append(None if unit is None else hashlib.md5(
                    np.array(values, dtype="<f8").tobytes(), usedforsecurity=False).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(units, pa.binary()), pa.array(digests, pa.binary())],
                ["vec_id", "unit", "digest"])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding") \
        .mapInArrow(read, "vec_id long, unit binary, digest binary")


def _coded(classes: DataFrame, bits: int, keys: int) -> DataFrame:
    """``node, weight, unit, numbers, factor`` of every class."""
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("unit").to_pylist()
            numbers: list = [None] * len(raw)
            factors = np.zeros(len(raw))
            for size in {len(r) for r in raw}:
                rows = [i for i, r in enumerate(raw) if len(r) == size]
                found, factor = _codes(np.frombuffer(b"".join(raw[i] for i in rows), "<f8").reshape(len(rows), -1),
                                       bits, keys)
                for i, values in zip(rows, found):
                    numbers[i] = values
                factors[rows] = factor
            yield pa.RecordBatch.from_arrays([
                batch.column("node"), batch.column("weight"), batch.column("unit"),
                pa.array(numbers, pa.list_(pa.int64())), pa.array(factors)],
                ["node", "weight", "unit", "numbers", "factor"])

    return classes.select("node", "weight", "unit").mapInArrow(
        code, "node long, weight long, unit binary, numbers array<bigint>, factor double")


class _Blocks:
    """Links inside consecutive complete blocks of rows of one vector length."""

    def __init__(self, threshold: float):
        self.threshold = threshold

    def links(self, rows: dict[str, np.ndarray], left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        numbers, band = rows["numbers"], rows["band"][left]
        # of the keys that two rows share, only the first counts the pair
        shared = numbers[left] == numbers[right]
        keep = (rows["side"][left] != rows["side"][right]) | (rows["split"][left] == 0)
        keep &= shared.argmax(axis=1) == band
        left, right = left[keep], right[keep]
        units, size = rows["units"], rows["units"].shape[1]
        turned = units @ _rotation(size, 0)
        factor = rows["factor"][left]
        estimate = np.einsum("ij,ij->i", np.where(turned >= 0, 1.0, -1.0)[left], turned[right]) / math.sqrt(size) / factor
        spread = np.sqrt(np.maximum(1 - factor ** 2, 0)) / factor / math.sqrt(max(size - 1, 1))
        open_pairs = estimate + SIGMAS * spread >= self.threshold
        left, right = left[open_pairs], right[open_pairs]
        near = np.einsum("ij,ij->i", units[left], units[right]) >= self.threshold
        return left[near], right[near]

    def summary(self, rows: dict[str, np.ndarray], left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
        """A row per linked class: weight of the classes it links with, and the smallest class it is connected with here."""
        node, weight = rows["node"], rows["weight"]
        total = np.zeros(len(node), np.int64)
        np.add.at(total, left, weight[right])
        np.add.at(total, right, weight[left])
        label = blocks.lowest(node, left, right)
        used = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays(
            [pa.array(node[used]), pa.array(total[used]), pa.array(label[used])], ["node", "links", "low"])


def _linked(rows: DataFrame, threshold: float) -> DataFrame:
    """``node, links, low`` from rows sorted by block."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = _Blocks(threshold)
        for batch in (part for held in blocks.whole_blocks(batches) for part in _one_length(held)):
            raw = batch.column("unit").to_pylist()
            table = {
                "units": np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1),
                "numbers": np.asarray(batch.column("numbers").flatten()).reshape(len(raw), -1),
                **{c: batch.column(c).to_numpy() for c in ("node", "weight", "factor", "band", "side", "split")},
            }
            for left, right in blocks.pair_slices(*blocks.runs(batch.column("block").to_pylist()), PAIRS_AT_ONCE):
                left, right = worker.links(table, left, right)
                if len(left):
                    yield worker.summary(table, left, right)

    return rows.mapInArrow(compare, "node long, links long, low long")


def _one_length(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.compute as pc

    batch = blocks.one_batch(pa.Table.from_batches(held))
    sizes = pc.binary_length(batch.column("unit"))
    for size in pc.unique(sizes).to_pylist():
        yield batch.filter(pc.equal(sizes, size))


def near_vectors(vectors: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every vector."""
    table = stored(_read(vectors), "units")
    classes = table.filter("digest is not null").groupBy("digest").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"), F.first("unit").alias("unit"))
    classes = stored(with_nodes(classes, "digest"), "vector-classes")
    bits, keys = plan_keys(classes.count(), threshold)
    coded = stored(_coded(classes, bits, keys), "codes")

    rows = coded.select("node", F.octet_length("unit").alias("size"), F.posexplode("numbers").alias("band", "number"))
    dealt = blocks.dealt(rows, ["size", "band", "number"], CHUNK).drop("size", "number")
    met = dealt.join(coded, "node").repartition("block").sortWithinPartitions("block", "node")
    found = stored(_linked(met.select("block", "node", "weight", "unit", "numbers", "factor", "band", "side", "split"),
                           threshold), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    connected = stored(components(found.select(F.col("node").alias("a"), F.col("low").alias("b"))), "components")
    places = named(classes, connected, "digest") \
        .join(classes.select("digest", "node", "weight").join(links, "node", "left"), "digest") \
        .select("digest", "name", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    out = table.select("vec_id", "digest").join(places, "digest", "left")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("name")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
