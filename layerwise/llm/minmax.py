"""Near copies by min-max hashing: both extremes under each permutation make the signature.

A document's set is that of its distinct word shingles (lower-case A-Z, words between ASCII white
space).  Every permutation is evaluated once over the set, and both its minimum and its maximum
are kept: twice the values for the same number of hash evaluations, each agreeing between two
documents with probability equal to their Jaccard similarity.  ``BAND`` values make a band.  A pair
at the threshold or over it is missed with probability ``MISS`` at most, under random permutations:
half of that for sharing no band, half for failing the signature test (``band_count``, ``SLACK``).

Documents with equal sets are one class from the start, so groups of exact copies cost one row.
In each bucket every class is paired with the bucket's smallest class only.  Pairs are tested by
signature (a pair whose estimate is below the threshold by over ``SLACK`` goes) and then on the full
sets of their texts.  Confirmed pairs give components.  In buckets whose classes are then still in
several components the pairs between different components are tested likewise, in blocks of at most
``CHUNK`` classes against ``CHUNK``, which give a row per class: no link between components goes
unseen, and pairs are never listed.

A text without words has no shingles and is linked with nothing.  Null texts count as empty.
``doc_id`` is a whole number; rows without one take part, but give no component its name: a
component of such rows only has a null ``component_id``.  Repeated rows each give a row.  Empty
tables give empty results.  ``classify`` reads no other columns, ``deduplicated`` keeps them all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks
from .components import components, named, with_nodes
from .shared import slices, stored, whole_text

BAND = 6
MISS = 1e-6
#: How far below the threshold the signatures' estimate must be for a pair to be dropped untested.  By
#: Chernoff's bound a pair at the threshold is dropped with 1.1e-7 at 0.85 and under 1e-10 at 0.8; that
#: extremes of small sets depend on one another only makes it rarer.
SLACK = 0.16
CHUNK = 512
PAIRS_AT_ONCE = 50_000
_WORDS_KEPT = 200_000
_U = np.uint64


class _WordHashes(dict):
    """64-bit hashes of words; starts anew when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def forget_words() -> None:
    """At the end of a task: a worker lives on; what it remembers should not."""
    _HASHES.clear()


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of ``size`` words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if len(_HASHES) > _WORDS_KEPT:
        _HASHES.clear()
    hashes = np.fromiter(map(_HASHES.__getitem__, words), _U, len(words))
    width = min(size, len(words))
    if not width:
        return hashes
    total = np.full(len(words) - width + 1, width, _U)
    for i in range(width):
        total = _stir(total + hashes[i:len(words) - width + 1 + i] + _U(0x9E3779B97F4A7C15))
    return np.unique(total)


def both_agree(threshold: float) -> float:
    """Least probability that minimum and maximum of a permutation both agree, over unions of all sizes.

    They depend on one another in small sets: with ``m`` of ``n`` shingles in common both are among
    them with ``m (m - 1) / (n (n - 1))``, which tends to the square of the similarity.
    """
    common = ((n, math.ceil(threshold * n - 1e-9)) for n in range(2, 2000))
    return min(threshold ** 2, *(m * (m - 1) / (n * (n - 1)) for n, m in common))


def band_count(threshold: float) -> int:
    """Bands of which a pair at the threshold shares none with half of ``MISS``, whatever its sets' sizes."""
    return math.ceil(math.log(MISS / 2) / math.log(1 - both_agree(threshold) ** (BAND // 2)))


class Sketcher:
    """Signatures (16 bits of each extreme) and band keys of shingle sets."""

    def __init__(self, threshold: float):
        self.bands = band_count(threshold)
        count = self.bands * BAND // 2
        seeds = _stir(np.arange(1, 2 * count + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
        self._factor, self._shift = seeds[:count, None] | _U(1), seeds[count:, None]
        self._salt = _stir(np.arange(self.bands, dtype=_U) + _U(77))

    def sketch(self, values: np.ndarray) -> tuple[bytes, np.ndarray]:
        low = high = None
        for begin in range(0, len(values), 4096):
            image = self._factor * values[None, begin:begin + 4096] + self._shift
            least, most = image.min(axis=1), image.max(axis=1)
            low = least if low is None else np.minimum(low, least)
            high = most if high is None else np.maximum(high, most)
        both = _stir(np.stack([low, high], axis=1).reshape(-1))
        keys = self._salt.copy()
        for column in both.reshape(self.bands, BAND).T:
            keys = _stir(keys + column)
        return (both >> _U(48)).astype("<u2").tobytes(), keys.view(np.int64)


def sketches(docs: DataFrame, size: int, threshold: float) -> DataFrame:
    """Every document's set size, fingerprint of the set, text digest, signature and band keys."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(threshold)
        for whole in batches:
            for batch in slices(whole, "text"):
                sizes, prints, signatures, keys = [], [], [], []
                for text in batch.column("text").to_pylist():
                    values = shingles(text, size)
                    sizes.append(len(values))
                    if not len(values):
                        prints.append(None), signatures.append(None), keys.append(None)
                        continue
                    signature, bands = sketcher.sketch(values)
                    prints.append(xxhash.xxh3_128_digest(values.astype("<u8").tobytes()))
                    signatures.append(signature)
                    keys.append(bands)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), batch.column("text_md5"), pa.array(sizes, pa.int64()),
                    pa.array(prints, pa.binary()), pa.array(signatures, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ], ["doc_id", "text_md5", "n_shingles", "print", "signature", "bands"])
        forget_words()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")) \
        .withColumn("text_md5", F.md5(F.col("text").cast("binary")))
    return texts.mapInArrow(sketch, "doc_id long, text_md5 string, n_shingles long, print binary, "
                                    "signature binary, bands array<bigint>")


def _likely(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs that set sizes and signatures do not rule out."""
    side = classes.select("node", "n_shingles", "signature")
    joined = pairs.join(side.toDF("b", "n_b", "sig_b"), "b").join(side.toDF("a", "n_a", "sig_a"), "a") \
        .filter(F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b") - 1e-6)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1)
                    for c in ("sig_a", "sig_b"))
            near = pa.array((a == b).mean(axis=1) >= threshold - SLACK)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(near)

    return joined.select("a", "b", "sig_a", "sig_b").mapInArrow(test, "a long, b long")


def _texts(nodes: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``node, text``: the text of one document of each class."""
    wanted = nodes.join(classes.select("node", "text_md5"), "node")
    return docs.select(whole_text().alias("text")).withColumn("text_md5", F.md5(F.col("text").cast("binary"))) \
        .join(wanted, "text_md5").select("node", "text").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs whose full sets have ``100 * intersection >= percent * union``."""
    joined = pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, first = None, None  # rows of one ``a`` come together
        for batch in batches:
            links = []
            for row, a in enumerate(batch.column("a").to_pylist()):
                if a != last:
                    last, first = a, shingles(batch.column("text_a")[row].as_py(), size)
                second = shingles(batch.column("text_b")[row].as_py(), size)
                common = len(np.intersect1d(first, second, assume_unique=True))
                links.append(100 * common >= percent * (len(first) + len(second) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]) \
                .filter(pa.array(links, pa.bool_()))
        forget_words()

    return joined.select("a", "b", "text_a", "text_b").mapInArrow(test, "a long, b long")


def _linked(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """``node, component`` of all classes that are linked with another."""
    threshold = percent / 100
    rows = classes.select("node", F.posexplode("bands").alias("band", "key")).repartition("key")
    buckets = rows.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("last")).filter("lead < last")
    shared = stored(rows.join(buckets.select("key", "lead"), "key"), "shared-buckets")
    texts = stored(_texts(shared.select("node").distinct(), docs, classes), "candidate-texts")
    stars = shared.filter("node > lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    edges = stored(_confirmed(_likely(stars, classes, threshold), texts, size, percent), "links")
    found = stored(components(edges), "components")

    placed = shared.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = stored(placed, "placed")
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")) \
        .filter("low < high").select("key")
    open_rows = stored(placed.filter("node > lead").join(mixed, "key").select("key", "band", "node", "component"),
                       "mixed-buckets")
    more = stored(_across(open_rows, classes, texts, size, percent), "links")
    if more.isEmpty():
        return found
    return stored(components(edges.union(more)), "components")


def _across(open_rows: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between different components inside buckets, as ``a`` (a class) and ``b`` (the smallest
    class it is connected with in a block): rows per class and block, not per pair."""
    threshold = percent / 100

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = [shingles(t, size).astype("<u8").tobytes() for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "values"])
        forget_words()

    sets = texts.join(open_rows.select("node").distinct(), "node", "left_semi").mapInArrow(
        values, "node long, values binary")
    known = stored(classes.select("node", "signature", "bands").join(sets, "node"), "open-sets")
    dealt = blocks.dealt(open_rows, ["key"], CHUNK).drop("key")
    met = dealt.join(known, "node").repartition("block").sortWithinPartitions("block", "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in blocks.whole_blocks(batches):
            batch = blocks.one_batch(pa.Table.from_batches(held))
            table = _SetTable(batch)
            for left, right in blocks.pair_slices(*blocks.runs(batch.column("block").to_pylist()), PAIRS_AT_ONCE):
                left, right = table.links(left, right, threshold, percent)
                if len(left):
                    low = blocks.lowest(table.node, left, right)
                    moved = np.flatnonzero(low < table.node)
                    yield pa.RecordBatch.from_arrays([pa.array(table.node[moved]), pa.array(low[moved])], ["a", "b"])

    return met.select("block", "node", "component", "band", "side", "split", "signature", "bands", "values") \
        .mapInArrow(compare, "a long, b long")


class _SetTable:
    """Classes of some blocks with their signatures and full sets."""

    def __init__(self, batch: pa.RecordBatch):
        n = batch.num_rows
        for name in ("node", "component", "band", "side", "split"):
            setattr(self, name, batch.column(name).to_numpy())
        self.bands = np.asarray(batch.column("bands").flatten()).reshape(n, -1)
        self.signature = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u2").reshape(n, -1)
        raw = batch.column("values").to_pylist()
        self.size = np.array([len(r) // 8 for r in raw], np.int64)
        self.first = np.cumsum(self.size) - self.size
        # shingles as numbers from 0, so that a set can be marked in an array
        self.number = np.unique(np.frombuffer(b"".join(raw), "<u8"), return_inverse=True)[1]
        self.mark = np.zeros(int(self.number.max(initial=-1)) + 1, np.int64)

    def links(self, left: np.ndarray, right: np.ndarray, threshold: float, percent: int) -> tuple[np.ndarray, np.ndarray]:
        keep = self.component[left] != self.component[right]
        keep &= (self.side[left] != self.side[right]) | (self.split[left] == 0)
        small, large = np.minimum(self.size[left], self.size[right]), np.maximum(self.size[left], self.size[right])
        keep &= 100 * small >= percent * large
        left, right = left[keep], right[keep]
        # of the buckets that two classes share, only the first tests them
        keep = (self.bands[left] == self.bands[right]).argmax(axis=1) == self.band[left]
        left, right = left[keep], right[keep]
        keep = (self.signature[left] == self.signature[right]).mean(axis=1) >= threshold - SLACK
        left, right = left[keep], right[keep]
        linked = np.zeros(len(left), bool)
        begins = np.concatenate([[0], np.flatnonzero(left[1:] != left[:-1]) + 1]) if len(left) else []
        for begin, end in zip(begins, [*begins[1:], len(left)]):  # the pairs of one left row
            a, others = left[begin], right[begin:end]
            own = self.number[self.first[a]:self.first[a] + self.size[a]]
            self.mark[own] = 1
            sizes = self.size[others]
            offset = np.cumsum(sizes) - sizes
            at = np.arange(sizes.sum()) + np.repeat(self.first[others] - offset, sizes)
            common = np.add.reduceat(self.mark[self.number[at]], offset)
            linked[begin:end] = 100 * common >= percent * (len(own) + sizes - common)
            self.mark[own] = 0
        return left[linked], right[linked]


def _classes(table: DataFrame) -> DataFrame:
    """One row per distinct set: ``node`` (its smallest document id where that names no other class)."""
    classes = table.filter("n_shingles > 0").groupBy("print").agg(
        F.min("doc_id").alias("least"), *[F.first(c).alias(c) for c in ("text_md5", "n_shingles", "signature", "bands")])
    return with_nodes(classes, "print")


def classify(docs: DataFrame, *, size: int, percent: int) -> DataFrame:
    """``doc_id, text_md5, n_shingles, component, component_id, kept`` of every document.

    ``component`` tells components apart even where they have no document id to be named by; it is
    null for documents without shingles.
    """
    table = stored(sketches(docs, size, percent / 100), "sketches")
    classes = stored(_classes(table), "classes")
    linked = _linked(docs, classes, size, percent)
    out = table.select("doc_id", "text_md5", "n_shingles", "print").join(named(classes, linked, "print"), "print", "left")
    return out.select("doc_id", "text_md5", "n_shingles", "component", F.when(
        F.col("n_shingles") > 0, F.col("name")).otherwise(F.col("doc_id")).alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_copies(docs: DataFrame, *, size: int = 3, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``."""
    return classify(docs, size=size, percent=percent).select("doc_id", "n_shingles", "component_id", "kept")


def deduplicated(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near copies: that with the smallest id, all columns as they were.

    Of documents with one id, and of those without any, that with the smallest text digest stays; of
    rows equal in both, one.  Documents without words all stay.
    """
    found = stored(classify(docs, size=size, percent=percent).filter("n_shingles > 0")
                   .select("doc_id", "text_md5", "component"), "classified")
    rank = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id"), F.col("text_md5"))
    first = found.groupBy("component").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    members = found.join(first, "component").withColumn("stays", rank == F.col("first"))
    gone = members.filter(~F.col("stays")).select(F.col("doc_id").alias("_id"), F.col("text_md5").alias("_md5")).distinct()
    repeated = members.filter("stays").groupBy(F.col("doc_id").alias("_id"), F.col("text_md5").alias("_md5")) \
        .agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").drop("_rows")
    digest = F.md5(whole_text().cast("binary"))
    number = docs["doc_id"].cast("long")

    def same(keys: DataFrame):
        return number.eqNullSafe(keys["_id"]) & (digest == keys["_md5"])

    kept = docs.join(gone, same(gone), "left_anti")
    repeated = stored(repeated, "repeated")
    if repeated.isEmpty():
        return kept
    one_each = kept.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, same(repeated), "left_anti").union(one_each)
