"""Mixture-controlled packing: deficit round-robin over one queue of tokens per source.

Every window of ``capacity`` tokens takes from each queue its target share.  A queue whose quantum
is no whole number of tokens gets the whole part of quantum and deficit, the tokens still free go
to the largest fractions, and what a queue got too little or too much is its deficit in the next
window, always under one token.  Documents are cut where a window ends, so every window but the
last of all is full.

Served this way, the tokens that a queue has given before window ``k`` depend on ``k`` alone
(whole part of ``k`` quanta, plus one for the largest fractions).  So a task computes the deficits
it carries in from the window number: windows that span two partitions continue exactly, and no
task waits for another.  A document finds its windows from its place in its queue, which is a
running sum of tokens inside its task shifted by per-task sums; nothing is sorted or gathered.

Targets default to the token shares of the corpus, which every queue keeps to the end.  With other
targets a queue may run dry: one window then takes what it has left, and the remaining queues go
on with their targets in proportion.  Sources with a share of under two tokens a window cannot be held
to it window by window; they, or the sources that ``targets`` does not name, share one queue (whose
target is what the others lack to 1; if that is under two tokens by default, the smallest other
source joins it), so the number of queues is bounded by ``capacity`` or by ``targets``, however many
sources there are.  Targets of under two tokens are refused.

A null text counts as empty: a piece of the end id alone.  A null source counts as the empty one.
A null ``doc_id`` is kept; repeated rows are packed like any others; texts of any length are cut
into as many windows as they span; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .encode import bulk_ids
from .shared import gathered, slices, stored, whole_text

CAPACITY = 2048
END_ID = 1
#: Weights are whole numbers that add up to at most this, so that products stay exact in 64 bits.
_SCALE = 1 << 30
#: Running sums, one row per task and source, are broadcast up to so many rows (some tens of MB); beyond, ids are
#: shuffled to them by task and source, a group that is never larger than a task's input.
BROADCAST_ROWS = 500_000
#: Texts are encoded so many bytes at a time, of which a row takes some besides its text.
TEXT_BYTES = 8 << 20
ROW_BYTES = 64
#: Windows times queues that are worked out at once.
_CELLS = 1 << 20


def _apportion(total: int, weights: np.ndarray) -> np.ndarray:
    """``total`` in whole parts in proportion to ``weights``; the largest fractions get what is left."""
    whole = sum(int(w) for w in weights)
    exact = [total * int(w) for w in weights]
    parts = [e // whole for e in exact]
    left = total - sum(parts)
    for i in sorted(range(len(parts)), key=lambda i: (-(exact[i] % whole), i))[:left]:
        parts[i] += 1
    return np.array(parts, dtype=np.int64)


@dataclass
class Phase:
    """Windows ``first`` to ``first + windows`` of ``length`` tokens, all served by the same weights."""

    first: int
    windows: int
    length: int
    base: np.ndarray  # tokens that each queue gave before this phase
    weights: np.ndarray

    def served(self, k: np.ndarray) -> np.ndarray:
        """Tokens that each queue (columns) has given in this phase before its window ``k`` (rows)."""
        total = int(self.weights.sum())
        n = k * self.length
        rounds, rest = np.divmod(n[:, None], total)
        product = rest * self.weights
        given = rounds * self.weights + product // total
        owed = product % total
        order = np.argsort(-owed, axis=1, kind="stable")
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), axis=1)
        return given + (place < (n - given.sum(axis=1))[:, None])


class Schedule:
    """The round-robin over queues that hold ``totals`` tokens, aiming at ``weights``."""

    def __init__(self, totals: list[int], weights: list[int], capacity: int = CAPACITY):
        self.phases: list[Phase] = []
        left, base = np.array(totals, dtype=np.int64), np.zeros(len(totals), dtype=np.int64)
        aim = np.array(weights, dtype=np.int64)
        first = 0
        while left.sum():
            active = np.where(left > 0, aim, 0)
            if not active.any():
                active = left
            if sum(int(w) for w in active) > _SCALE:
                active = np.where(active > 0, np.maximum(_apportion(_SCALE - len(left), active), 1), 0)
            phase = Phase(first, 0, capacity, base, active)
            phase.windows = self._lasts(phase, left)
            if not phase.windows:  # one window takes what the queue that runs dry has left
                phase = Phase(first, 1, int(min(capacity, left.sum())), base, self._last_share(active, left, capacity))
            given = phase.served(np.array([phase.windows]))[0]
            self.phases.append(phase)
            left, base, first = left - given, base + given, first + phase.windows
        self.queues, self.windows = len(totals), first
        self._ends = np.array([p.base for p in self.phases] + [base]).reshape(-1, len(totals))

    @staticmethod
    def _lasts(phase: Phase, left: np.ndarray) -> int:
        """Whole windows that every queue can serve."""
        total = sum(int(w) for w in phase.weights)
        bound = min(int(n) * total // (phase.length * int(w)) for n, w in zip(left, phase.weights) if w)
        while bound and (phase.served(np.array([bound]))[0] > left).any():
            bound -= 1
        return bound

    @staticmethod
    def _last_share(weights: np.ndarray, left: np.ndarray, capacity: int) -> np.ndarray:
        take = np.minimum(_apportion(capacity, weights), left)
        room = int(min(capacity, left.sum()) - take.sum())
        for i in sorted(range(len(left)), key=lambda i: (-weights[i], i)):
            more = min(room, int(left[i] - take[i]))
            take[i] += more
            room -= more
        return take

    def _windows(self, queue: int, begin: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows that hold tokens ``begin`` to ``end`` of a queue: their numbers, the place in the queue of
        the first token each takes (and of the end), and where in the window the queue starts."""
        numbers, edges, starts = [], [], []
        close = begin
        for i, phase in enumerate(self.phases):
            low, high = int(self._ends[i, queue]), int(self._ends[i + 1, queue])
            if high <= begin or low >= end or low == high:
                continue
            rate = phase.length * float(phase.weights[queue]) / float(phase.weights.sum())
            k = max(0, int((begin - low) / rate) - 2)
            stop = min(phase.windows, int((min(end, high) - low) / rate) + 3)
            while k < stop:
                upto = min(stop, k + max(1, _CELLS // len(phase.weights)))
                served = phase.served(np.arange(k, upto + 1))
                taken = np.diff(served, axis=0)
                numbers.append(phase.first + np.arange(k, upto))
                edges.append(low + served[:-1, queue])
                starts.append(taken[:, :queue].sum(axis=1))
                close = low + int(served[-1, queue])
                k = upto
        return np.concatenate(numbers), np.append(np.concatenate(edges), close), np.concatenate(starts)

    def cut(self, queue: int, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
        """Pieces of documents that lie at ``begin`` in a queue: document, start in it, length, window, offset."""
        end = begin + length
        number, edge, start = self._windows(queue, int(begin.min()), int(end.max()))
        first = np.searchsorted(edge, begin, side="right") - 1
        count = np.searchsorted(edge, end, side="left") - first
        owner = np.repeat(np.arange(len(begin)), count)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + first[owner]
        low = np.maximum(begin[owner], edge[at])
        size = np.minimum(end[owner], edge[at + 1]) - low
        real = size > 0  # a window may take nothing from a queue
        owner, at, low, size = owner[real], at[real], low[real], size[real]
        return owner, low - begin[owner], size, number[at], start[at] + low - edge[at]


def token_rows(docs: DataFrame, path: str, *, source: str = "source", end_id: int = END_ID) -> DataFrame:
    """Ids of every document (little-endian unsigned 32-bit), with its place among those of its source in the task."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, given = bulk_ids(path), TaskContext.get().partitionId(), Counter()
        for batch in gathered(batches, "text", TEXT_BYTES, ROW_BYTES):
            ids, sizes = tokens(batch.column("text").cast(pa.string()))
            data = np.insert(ids, np.cumsum(sizes), end_id).astype("<u4", copy=False)
            sizes += 1
            before = []
            for name, n in zip(batch.column("source").to_pylist(), sizes.tolist()):
                before.append(given[name])
                given[name] += n
            begins = pa.array(4 * np.concatenate([[0], np.cumsum(sizes)]), pa.int32())  # an error beyond 2 GB
            chunks = pa.BinaryArray.from_buffers(
                pa.binary(), len(sizes), [None, begins.buffers()[1], pa.py_buffer(data)])
            yield from slices(pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("source"), pa.array(np.full(len(sizes), part, np.int32)),
                pa.array(before, pa.int64()), pa.array(sizes), chunks],
                ["doc_id", "source", "part", "before", "doc_tokens", "ids"]), "ids")

    names = F.coalesce(F.col(source).cast("string"), F.lit("")) if source in docs.columns else F.lit("")
    return docs.select("doc_id", names.alias("source"), whole_text().alias("text")).mapInArrow(
        encode, f"doc_id {id_type}, source string, part int, before long, doc_tokens long, ids binary")


def _queues(sums: DataFrame, targets: Mapping[str, float] | None, capacity: int) -> tuple[DataFrame, Schedule]:
    """``source, queue`` of the sources with a queue of their own, and the schedule, whose last queue is shared."""
    spark = sums.sparkSession
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    by_source = sums.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    # half of ``capacity`` sources at most hold two tokens of every window; as many as ``targets`` are named
    own = by_source.filter(F.col("tokens") * capacity >= 2 * total) if targets is None else \
        by_source.filter(F.col("source").isin(list(targets)))
    tokens = {r["source"]: r["tokens"] for r in own.collect()}
    rest = total - sum(tokens.values())
    if targets is None:
        if tokens and 0 < rest * capacity < 2 * total:  # too little for a queue: the smallest source joins it
            rest += tokens.pop(min(tokens, key=lambda name: (tokens[name], name)))
        weights = [*(tokens[name] for name in sorted(tokens)), rest]
    else:
        shares = [*(float(targets[name]) for name in sorted(tokens)), max(0.0, round(1 - sum(targets.values()), 9))]
        if any(0 < share * capacity < 2 for share in shares) or not all(shares[:-1]):
            raise ValueError(f"a target is under two tokens in {capacity}")
        weights = [round(share * (1 << 24)) for share in shares]
    names = sorted(tokens)
    table = spark.createDataFrame([(name, i) for i, name in enumerate(names)], "source string, queue int")
    return table, Schedule([*(tokens[name] for name in names), rest], weights, capacity)


def mixed(docs: DataFrame, path: str, *, source: str = "source", targets: Mapping[str, float] | None = None,
          capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece of every document with its window (``sequence_id``), ``offset`` and ``ids``.

    ``targets``: token share of some sources in a window (default: every source's share of the corpus)."""
    table = stored(token_rows(docs, path, source=source, end_id=end_id), "mixture-ids")
    sums = stored(table.groupBy("part", "source").agg(F.sum("doc_tokens").alias("tokens")), "mixture-sums")
    named, schedule = _queues(sums, targets, capacity)
    queued = sums.join(F.broadcast(named), "source", "left") \
        .withColumn("queue", F.coalesce("queue", F.lit(schedule.queues - 1)))  # ``named``: see ``_queues``
    earlier = (Window.unboundedPreceding, -1)
    parts = queued.groupBy("queue", "part").agg(F.sum("tokens").alias("tokens")).select("queue", "part", F.coalesce(
        F.sum("tokens").over(Window.partitionBy("queue").orderBy("part").rowsBetween(*earlier)), F.lit(0)).alias("earlier"))
    within = F.sum("tokens").over(Window.partitionBy("queue", "part").orderBy("source").rowsBetween(*earlier))
    places = queued.withColumn("inner", F.coalesce(within, F.lit(0))).join(parts, ["queue", "part"]) \
        .select("part", "source", "queue", (F.col("earlier") + F.col("inner")).alias("shift"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "ids", 1 << 23):
                begin = batch.column("before").to_numpy() + batch.column("shift").to_numpy()
                queue, part = batch.column("queue").to_numpy(), batch.column("part").to_numpy()
                order = np.lexsort((begin, part, queue))
                length = batch.column("doc_tokens").to_numpy()
                news = np.flatnonzero(np.diff(queue[order]) | np.diff(part[order])) + 1
                found = []
                for rows in np.split(order, news):
                    owner, *rest = schedule.cut(int(queue[rows[0]]), begin[rows], length[rows])
                    found.append((rows[owner], *rest))
                owner, start, size, window, offset = (np.concatenate(c) for c in zip(*found))
                # the pieces of a document follow each other, so the ids of all, one after the other, are the data
                data = batch.column("ids").take(pa.array(order))
                begins = np.zeros(len(size) + 1, dtype=np.int32)
                np.cumsum(4 * size, out=begins[1:])
                ids = pa.BinaryArray.from_buffers(
                    pa.binary(), len(size), [None, pa.py_buffer(begins), data.buffers()[2]])
                of = pa.array(owner)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(of), batch.column("source").take(of), pa.array(start), pa.array(size),
                    batch.column("doc_tokens").take(of), pa.array(window), pa.array(offset), ids],
                    ["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    if sums.count() <= BROADCAST_ROWS:
        places = F.broadcast(places)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return table.join(places, ["part", "source"]).select(
        "doc_id", "source", "part", "before", "shift", "queue", "doc_tokens", "ids").mapInArrow(
        place, f"doc_id {id_type}, source string, start long, length long, doc_tokens long, sequence_id long, "
               "offset long, ids binary")


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a CRC-32 in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")
