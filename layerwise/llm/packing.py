"""Best-fit packing of token sequences by exact-complement hashing.

Only lengths decide a packing, so the plan is made from the histogram of piece lengths, which has
at most ``capacity`` rows however many documents there are.  ``plan`` takes the lengths from the
longest on; the gap that a piece leaves is looked up among single lengths, sums of two and sums of
three, and a combination that fills it exactly is consumed as often as the available counts allow.
What then remains is packed best-fit, longest first, into the tightest gap that is left open.

The plan is a list of patterns with a number of copies.  Each takes a range of ranks of every
length it holds, so a piece finds its sequence and offset from (length, rank among the pieces of
that length).  Ranks are counted inside each task and shifted by per-task sums, so a length that a
third of all pieces share is never gathered anywhere.

A null text counts as empty: a piece of the end id alone.  A null ``doc_id`` is kept; repeated
rows are packed like any others; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .encode import encoder
from .shared import slices, stored, whole_text

CAPACITY = 2048
END_ID = 0
_RANK_BITS = 44


class Complements:
    """Available lengths, indexed by the sums that one, two or three of them make.

    Counts only fall, so a smallest member that is used up stays used up: each index keeps, per
    sum, the first smallest member that is still alive, and moves it forward only.  One piece, the
    one whose gap is to be filled, may be held back while a combination is looked up.
    """

    def __init__(self, counts: dict[int, int]):
        self.left = Counter(counts)
        self._sizes = sorted(self.left)
        self._pair_at: dict[int, int] = {}
        self._triple_at: dict[int, int] = {}

    def copies(self, lengths: tuple[int, ...]) -> int:
        """How often the combination can still be taken."""
        return min(self.left[n] // k for n, k in Counter(lengths).items())

    def _fits(self, lengths: tuple[int, ...]) -> bool:
        return all(self.left[n] >= lengths.count(n) for n in lengths)

    def single(self, total: int, held: tuple[int, ...] = ()) -> tuple[int, ...] | None:
        return (total,) if total in self.left and self._fits((total, *held)) else None

    def pair(self, total: int, held: tuple[int, ...] = ()) -> tuple[int, ...] | None:
        sizes, left = self._sizes, self.left
        i = start = self._pair_at.get(total, 0)
        while i < len(sizes) and 2 * sizes[i] <= total:
            a, b = sizes[i], total - sizes[i]
            if b in left and left[a] and left[b] and self._fits((a, b)):
                if self._fits((a, b, *held)):
                    break
            elif i == start:
                start += 1  # dead for good
            i += 1
        else:
            a = 0
        self._pair_at[total] = start
        return (a, total - a) if a else None

    def triple(self, total: int, held: tuple[int, ...] = ()) -> tuple[int, ...] | None:
        sizes = self._sizes
        i = start = self._triple_at.get(total, 0)
        found = None
        while i < len(sizes) and 3 * sizes[i] <= total:
            if self._fits((sizes[i], *held)):
                rest = self.pair(total - sizes[i], (sizes[i], *held))
                if rest:
                    found = (sizes[i], *rest)
                    break
            elif i == start and not self.left[sizes[i]]:
                start += 1
            i += 1
        self._triple_at[total] = start
        return found

    def take(self, lengths: tuple[int, ...], copies: int) -> None:
        for n in lengths:
            self.left[n] -= copies


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths of one sequence, copies) that hold exactly ``counts`` pieces per length."""
    index = Complements(counts)
    patterns: list[tuple[tuple[int, ...], int]] = []
    if index.left.get(capacity):
        patterns.append(((capacity,), index.left[capacity]))
        index.left[capacity] = 0
    for find in (index.single, index.pair, index.triple):
        for length in sorted(counts, reverse=True):
            while index.left[length] and length < capacity:
                rest = find(capacity - length, (length,))
                if not rest:
                    break
                whole = (length, *sorted(rest, reverse=True))
                copies = index.copies(whole)
                index.take(whole, copies)
                patterns.append((whole, copies))
    return patterns + _best_fit(index.left, capacity)


def _best_fit(left: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts: classes of equal open sequences, by the gap they leave."""
    open_by_gap: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    gaps: list[int] = []

    def add(lengths: tuple[int, ...], copies: int) -> None:
        gap = capacity - sum(lengths)
        if gap not in open_by_gap:
            open_by_gap[gap] = []
            gaps.append(gap)
        open_by_gap[gap].append((lengths, copies))

    for length in sorted((n for n, c in left.items() if c), reverse=True):
        count = left[length]
        while count:
            fits = [g for g in gaps if g >= length and open_by_gap[g]]
            if not fits:
                break
            lengths, copies = open_by_gap[min(fits)].pop()
            each = (capacity - sum(lengths)) // length
            full = min(copies, count // each)
            if full:
                add(lengths + (length,) * each, full)
                count -= full * each
                copies -= full
            if copies and count:  # fewer than one sequence's worth is left
                add(lengths + (length,) * count, 1)
                count, copies = 0, copies - 1
            if copies:
                add(lengths, copies)
        each = capacity // length
        if count // each:
            add((length,) * each, count // each)
        if count % each:
            add((length,) * (count % each), 1)
    return [entry for entries in open_by_gap.values() for entry in entries]


class Placement:
    """Patterns as arrays: from (length, rank) to (sequence, offset)."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]]):
        taken: Counter[int] = Counter()
        rows = []
        sequence = 0
        for lengths, copies in patterns:
            offset = 0
            for length, each in sorted(Counter(lengths).items(), reverse=True):
                rows.append(((length << _RANK_BITS) + taken[length], sequence, offset, each, length))
                taken[length] += copies * each
                offset += length * each
            sequence += copies
        self.sequences = sequence
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
        self.key, self.sequence, self.offset, self.each, self.length = table.T.copy()

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (length << _RANK_BITS) + rank
        at = np.searchsorted(self.key, key, side="right") - 1
        within = key - self.key[at]
        each = self.each[at]
        return self.sequence[at] + within // each, self.offset[at] + within % each * self.length[at]


def pieces(docs: DataFrame, path: str, *, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece with its ids (little-endian unsigned 32-bit), and its rank in (task, length)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    end = end_id.to_bytes(4, "little")
    width = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, ranks = encoder(path), TaskContext.get().partitionId(), Counter()
        for whole in batches:
            for batch in slices(whole, "text"):
                owner, number, chunks, rank = [], [], [], []
                for row, ids in enumerate(encode.ids(batch.column("text").to_pylist())):
                    ids += end
                    for k in range(0, len(ids), width):
                        piece = ids[k:k + width]
                        owner.append(row)
                        number.append(k // width)
                        chunks.append(piece)
                        rank.append(ranks[len(piece)])
                        ranks[len(piece)] += 1
                ids_column = pa.array(chunks, pa.binary())
                number_column = np.array(number, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(pa.array(owner, pa.int32())),
                    pa.array(number_column), pa.array(number_column.astype(np.int64) * capacity),
                    pa.array([len(c) // 4 for c in chunks], pa.int64()),
                    pa.array([zlib.crc32(c) for c in chunks], pa.int64()),
                    pa.array([part] * len(chunks), pa.int32()), pa.array(rank, pa.int64()), ids_column,
                ], ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank", "ids"])
        encode.forget()

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        cut, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, part int, rank long, ids binary")


def pack(docs: DataFrame, path: str, *, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece of every document with its ``sequence_id`` and ``offset``; ids stay in the stored pieces."""
    table = stored(pieces(docs, path, capacity=capacity, end_id=end_id), "pieces")
    per_task = stored(table.groupBy("part", "length").agg(F.count(F.lit(1)).alias("rows")), "piece-lengths")
    counts = {r["length"]: r["rows"] for r in per_task.groupBy("length").agg(F.sum("rows").alias("rows")).collect()}
    place = Placement(plan(counts, capacity))  # counts: at most ``capacity`` rows
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = per_task.select("part", "length", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("shift"))
    ranked = table.drop("ids").join(shift, ["part", "length"])
    fields = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy() + batch.column("shift").to_numpy()
            sequence, offset = place.find(length, rank)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f) for f in fields), pa.array(sequence), pa.array(offset)],
                [*fields, "sequence_id", "offset"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return ranked.select(*fields, "rank", "shift").mapInArrow(
        assign, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
