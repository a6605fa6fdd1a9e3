"""Comparing the rows of buckets in blocks of bounded size.

A bucket of more than ``chunk`` rows is dealt into chunks by a hash of the row; a block is a chunk,
or a pair of chunks, so that every two rows of a bucket meet in exactly one block and no task holds
a whole bucket.  Inside a task, rows sorted by block arrive as tables that are cut between blocks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dealt(rows: DataFrame, bucket: Sequence[str], chunk: int) -> DataFrame:
    """``rows`` (with ``node``) of buckets of two rows or more, once per block: ``block`` (16 bytes),
    ``split`` (1 in a block of two chunks) and ``side`` (which of them the row is from)."""
    sizes = rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    placed = rows.join(sizes, list(bucket)).withColumn("_chunks", F.ceil(F.col("_rows") / chunk).cast("int")) \
        .withColumn("_chunk", F.pmod(F.xxhash64("node"), F.col("_chunks")).cast("int")) \
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    name = F.concat_ws(",", *bucket, F.least("_chunk", "_other"), F.greatest("_chunk", "_other"))
    return placed.withColumn("block", F.unhex(F.md5(name.cast("binary")))) \
        .withColumn("side", (F.col("_chunk") > F.col("_other")).cast("int")) \
        .withColumn("split", (F.col("_chunk") != F.col("_other")).cast("int")) \
        .drop("_rows", "_chunks", "_chunk", "_other")


def whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """The rows again, in groups of batches that are cut only between blocks."""
    held: list[pa.RecordBatch] = []

    def last(batch: pa.RecordBatch) -> bytes:
        return batch.column("block")[batch.num_rows - 1].as_py()

    for batch in batches:
        if not batch.num_rows:
            continue
        blocks, end = batch.column("block"), last(batch)
        cut = batch.num_rows
        while cut and blocks[cut - 1].as_py() == end:
            cut -= 1
        if held and (cut or last(held[-1]) != end):  # the held block ends in this batch, or before it
            if blocks[0].as_py() != last(held[-1]):
                yield held
                held = []
        if cut:
            yield [*held, batch.slice(0, cut)]
            held = []
        held.append(batch.slice(cut))
    if held:
        yield held


def one_batch(table: pa.Table) -> pa.RecordBatch:
    """All rows of ``table`` as one batch; its binary columns get offsets that hold for over 2 GB."""
    large = pa.schema([f.with_type(pa.large_binary()) if pa.types.is_binary(f.type) else f for f in table.schema])
    batches = table.cast(large).combine_chunks().to_batches()
    if len(batches) != 1:
        raise ValueError(f"{table.num_rows} rows make {len(batches)} batches, not one")
    return batches[0]


def runs(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """First row and number of rows of each block."""
    names = np.frombuffer(b"".join(blocks), "V16")
    first = np.concatenate([[0], np.flatnonzero(names[1:] != names[:-1]) + 1]).astype(np.int64)
    return first, np.diff(np.concatenate([first, [len(names)]]))


def pairs(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows i < j inside runs that begin at ``first`` and hold ``size`` rows."""
    shift = np.repeat(first - (np.cumsum(size) - size), size)
    row = np.arange(size.sum()) + shift
    after = np.repeat(first + size, size) - 1 - row  # rows of the run that follow
    left = np.repeat(row, after)
    step = np.arange(after.sum()) - np.repeat(np.cumsum(after) - after, after)
    return left, left + 1 + step


def pair_slices(first: np.ndarray, size: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of all runs, about ``limit`` at a time; a larger run is cut by its left rows."""
    begin = 0
    while begin < len(first):
        made = np.cumsum(size[begin:] * (size[begin:] - 1) // 2)
        end = begin + int(np.searchsorted(made, limit, side="right"))
        if end > begin:
            yield pairs(first[begin:end], size[begin:end])
            begin = end
            continue
        stop = first[begin] + size[begin]
        row = first[begin]
        while row < stop - 1:
            upto = min(stop - 1, row + max(1, limit // int(size[begin])))
            after = stop - 1 - np.arange(row, upto)
            left = np.repeat(np.arange(row, upto), after)
            yield left, left + 1 + np.arange(after.sum()) - np.repeat(np.cumsum(after) - after, after)
            row = upto
        begin += 1


def lowest(node: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Per row the smallest node that it is connected with through the links left-right."""
    label = node.copy()
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        if (label == before).all():
            break
    return label
