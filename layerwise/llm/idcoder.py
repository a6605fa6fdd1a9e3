"""Token ids in compressed binary blocks: an adaptive context-mixing range coder.

A block holds whole documents and is coded on its own: models start afresh, and checksums of the
coded bytes and of the ids are verified on reading, so any block can be decoded, checked or
rewritten alone.  Within a block the ids are dealt to up to ``LANES`` consecutive lanes that are
coded in step, one id of each lane at a time, under one shared model.

Per id the model predicts

* order 2: the id last seen after the two before it, with a confidence from 0 to 7;
* order 1: the id last seen after the one before it, likewise;
* order 0: adaptive counts of the ids that neither foretold.

Three experts give the chance that the order-2 id, else the order-1 id, else neither is right:
one sees the order-2 confidence, one the order-1 confidence and whether both agree, one all of
these.  Their chances are mixed with weights that follow how well each has done, and the event
is coded; after "neither", the id is coded by the order-0 counts.  All arithmetic is in integers,
so encoder and decoder agree on any machine.

Events and ids are coded by ranges of totals that are powers of two, with a state of 64 bits per
lane (range variant of asymmetric numeral systems): reading needs no division, and an event and
the id after it take one step.  The encoder goes through the ids to learn the ranges, then back
through the ranges, so that the words come out in the order in which the decoder asks for them.

File format: Parquet rows of one block each, in ascending order (``shard``, ``block``), with the
block's document ids and lengths and ``payload``, which is: magic, version, lanes, vocabulary
size, number of ids, CRC-32 of the ids, the lanes' 64-bit states, their common 32-bit words, CRC-32
of all that.  A null text counts as empty (the end id alone); null document ids come first; documents
with one id are ordered by a hash of their texts; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .encode import bulk_ids
from .shared import gathered, new_path, whole_text

MAGIC = b"IDCM"
VERSION = 2
LANES = 4096
LANE_IDS = 64
#: A block is closed before it would hold more ids than this; one longer document is a block of its own.
BLOCK_IDS = 1 << 20
END_ID = 0
#: Texts tokenised at once hold about this many bytes: words are made distinct over all of them.
TEXT_BYTES = 16 << 20
_HEAD = struct.Struct("<4sHHIQI")
_CONTEXTS = 1 << 18
_EVENT_BITS, _ID_BITS = 12, 20  # of the totals; a state must have room for both in its upper 32 bits
_STATES = 8 * 8 * 2  # order-2 confidence, order-1 confidence, whether both agree
_FIRST_STATE = np.uint64(1 << 32)
_EVENT_SHIFT, _ID_SHIFT, _WORD = np.uint64(_EVENT_BITS), np.uint64(_ID_BITS), np.uint64(32)
_EVENT_MASK, _ID_MASK = np.uint64((1 << _EVENT_BITS) - 1), np.uint64((1 << _ID_BITS) - 1)


class BlockDamaged(ValueError):
    """A block's bytes or ids do not have the checksum stored with them."""


def _to_total(size: np.ndarray, total: int) -> np.ndarray:
    """Counts scaled along the last axis to sizes of at least 1 that add up to ``total``."""
    scaled = 1 + size * (total - size.shape[-1]) // np.maximum(size.sum(-1, keepdims=True), 1)
    most = scaled.argmax(-1)[..., None]
    rest = total - scaled.sum(-1, keepdims=True)
    np.put_along_axis(scaled, most, np.take_along_axis(scaled, most, -1) + rest, -1)
    return scaled


class _Model:
    """The shared adaptive model; encoder and decoder drive it with the same ids in the same order."""

    def __init__(self, vocabulary: int, lanes: int):
        self.after1 = np.zeros(vocabulary, np.int64)  # id << 3 | confidence
        self.after2 = np.zeros(_CONTEXTS, np.int64)
        self.seen = np.zeros(vocabulary, np.int64)
        self.events = np.ones((8, 8, 2, 3), np.int64)  # order-2 confidence, order-1 confidence, agree, event
        self.weights = np.ones(3, np.int64)
        self.chances: list[np.ndarray] = []
        self.last1 = np.zeros(lanes, np.int64)
        self.last2 = np.zeros(lanes, np.int64)
        self.step = 0
        self.coded: list[np.ndarray] = []  # since the events were last counted
        self.missed: list[np.ndarray] = []  # since the ids were last counted

    def _mix(self) -> None:
        events = self.events
        if self.coded:
            fresh = np.bincount(np.concatenate(self.coded), minlength=4 * _STATES).reshape(8, 8, 2, 4)[..., :3]
            self.coded.clear()
            hits = np.array([int((fresh * c).sum()) for c in self.chances], np.int64)
            self.weights = (self.weights * 7 + (hits << 10) // (int(fresh.sum()) + 1)) // 8 + 1
            events += fresh
        experts = [events.sum((1, 2), keepdims=True), events.sum(0, keepdims=True), events]
        self.chances = [np.broadcast_to((e << 12) // e.sum(3, keepdims=True) + 1, events.shape) for e in experts]
        w = self.weights
        mixed = w[0] * self.chances[0] + w[1] * self.chances[1] + w[2] * self.chances[2]
        size = np.zeros((_STATES, 4), np.int64)  # four to a state, so that its place is state << 2 | event
        size[:, :3] = _to_total(mixed.reshape(_STATES, 3), 1 << _EVENT_BITS)
        begin = (np.cumsum(size, 1) - size).astype(np.uint64)
        self.event_size, self.event_begin = size.astype(np.uint64).ravel(), begin.ravel()
        self.second, self.third = begin[:, 1].copy(), begin[:, 2].copy()

    def _count(self) -> None:
        if self.missed:
            self.seen += np.bincount(np.concatenate(self.missed), minlength=len(self.seen))
            self.missed.clear()
        size = _to_total(self.seen, 1 << _ID_BITS)
        self.id_size, self.id_begin = size.astype(np.uint32), (np.cumsum(size) - size).astype(np.uint32)
        self._slots = None

    def id_at(self, slot: np.ndarray) -> np.ndarray:
        """The ids whose ranges hold ``slot``."""
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.id_size), dtype=np.int32), self.id_size.astype(np.int64))
        return self._slots.take(slot.astype(np.int64)).astype(np.int64)

    def predict(self, active: int) -> None:
        """Predictions and event chances for the next id of the first ``active`` lanes."""
        if self.step < 8 or self.step % 8 == 0:
            self._mix()
        if self.step in (0, 1, 2, 4, 8, 16) or self.step % 32 == 0:
            self._count()
        self.place1 = self.last1[:active]
        self.place2 = (self.place1 * 40503 + self.last2[:active] * 30011 + (self.place1 >> 5)) & (_CONTEXTS - 1)
        self.entry1, self.entry2 = self.after1.take(self.place1), self.after2.take(self.place2)
        self.guess1, self.guess2 = self.entry1 >> 3, self.entry2 >> 3
        agree = self.guess1 == self.guess2
        self.state = ((self.entry2 & 7) << 4) | ((self.entry1 & 7) << 1) | agree

    def update(self, ids: np.ndarray, coded: np.ndarray, missed: np.ndarray, hit2: np.ndarray) -> None:
        """``coded``: state << 2 | event of each lane; ``missed``: the ids that neither foretold."""
        self.coded.append(coded)
        self.missed.append(missed)
        doubted = ids << 3
        for table, place, entry, hit in ((self.after1, self.place1, self.entry1, self.guess1 == ids),
                                         (self.after2, self.place2, self.entry2, hit2)):
            trust = entry & 7
            table[place] = np.where(hit, entry + (trust < 7), np.where(trust, entry - 1, doubted))
        active = len(ids)
        self.last2[:active] = self.place1
        self.last1[:active] = ids
        self.step += 1


def _lengths(n: int, lanes: int) -> np.ndarray:
    return np.full(lanes, n // lanes, np.int64) + (np.arange(lanes) < n % lanes)


def _checked(vocabulary: int) -> int:
    if not 0 < vocabulary <= 1 << (_ID_BITS - 1):
        raise ValueError(f"a vocabulary has 1 to {1 << (_ID_BITS - 1)} ids, not {vocabulary}")
    return vocabulary


def encode_block(ids: np.ndarray, vocabulary: int, lanes: int = LANES) -> bytes:
    """``ids`` (0 <= id < vocabulary) as one self-contained block."""
    n = len(ids)
    ids = np.ascontiguousarray(ids, np.uint32)
    lanes = max(1, min(lanes, n // LANE_IDS))
    length = _lengths(n, lanes)
    first = np.cumsum(length) - length
    model = _Model(_checked(vocabulary), lanes)
    ranges = []
    for t in range(int(length.max(initial=0))):
        active = lanes if t < length[-1] else int((length > t).sum())
        x = ids.take(first[:active] + t).astype(np.int64)
        model.predict(active)
        hit2 = x == model.guess2
        event = np.where(hit2, 0, 2 - (x == model.guess1))
        coded = (model.state << 2) | event
        missed = np.flatnonzero(event == 2)
        y = x.take(missed)
        # narrow types: the ranges of a whole block, however long its document, wait here
        ranges.append((model.event_begin, model.event_size, coded.astype(np.uint16),
                       missed.astype(np.uint16), model.id_begin.take(y), model.id_size.take(y)))
        model.update(x, coded, y, hit2)

    states = np.full(lanes, _FIRST_STATE, np.uint64)
    words = []
    while ranges:
        event_begin, event_size, coded, missed, id_begin, id_size = ranges.pop()
        coded, missed, id_size = coded.astype(np.int64), missed.astype(np.int64), id_size.astype(np.uint64)
        size = event_size.take(coded)
        state = states[:len(size)]
        bound = size << (_ID_SHIFT + _WORD)
        bound[missed] = (size.take(missed) * id_size) << _WORD
        over = np.flatnonzero(state >= bound)
        full = state.take(over)
        words.append(full.astype("<u4"))
        state[over] = full >> _WORD
        rest = state.take(missed)
        part = rest // id_size
        state[missed] = (part << _ID_SHIFT) + (rest - part * id_size) + id_begin
        part = state // size
        state -= part * size
        state += event_begin.take(coded)
        state += part << _EVENT_SHIFT
    body = _HEAD.pack(MAGIC, VERSION, lanes, vocabulary, n, zlib.crc32(ids.astype("<u4").tobytes())) \
        + states.astype("<u8").tobytes() + b"".join(w.tobytes() for w in reversed(words))
    return body + zlib.crc32(body).to_bytes(4, "little")


def decode_block(block: bytes) -> np.ndarray:
    """The ids of a block; raises ``BlockDamaged`` unless both checksums hold."""
    if len(block) < _HEAD.size + 4 or zlib.crc32(block[:-4]) != int.from_bytes(block[-4:], "little"):
        raise BlockDamaged("the checksum of the block's bytes does not hold")
    magic, version, lanes, vocabulary, n, ids_crc = _HEAD.unpack_from(block)
    if magic != MAGIC or version != VERSION:
        raise BlockDamaged("not a block of this format")
    states = np.frombuffer(block, "<u8", lanes, _HEAD.size).astype(np.uint64)
    words = np.frombuffer(block[_HEAD.size + 8 * lanes:-4], "<u4").astype(np.uint64)
    used = 0
    length = _lengths(n, lanes)
    steps = int(length.max(initial=0))
    model = _Model(_checked(vocabulary), lanes)
    dealt = np.zeros((steps, lanes), np.uint32)
    for t in range(steps):
        active = lanes if t < length[-1] else int((length > t).sum())
        model.predict(active)
        state = states[:active]
        slot = state & _EVENT_MASK
        hit2 = slot < model.second.take(model.state)
        event = np.where(hit2, 0, 1 + (slot >= model.third.take(model.state)))
        coded = (model.state << 2) | event
        state >>= _EVENT_SHIFT
        state *= model.event_size.take(coded)
        state += slot - model.event_begin.take(coded)
        x = np.where(hit2, model.guess2, model.guess1)
        missed = np.flatnonzero(event == 2)
        rest = state.take(missed)
        slot = rest & _ID_MASK
        y = model.id_at(slot)
        state[missed] = (rest >> _ID_SHIFT) * model.id_size.take(y) + slot - model.id_begin.take(y)
        x[missed] = y
        under = np.flatnonzero(state < _FIRST_STATE)
        state[under] = (state.take(under) << _WORD) | words[used:used + len(under)]
        used += len(under)
        dealt[t, :active] = x
        model.update(x, coded, y, hit2)
    ids = dealt.T[np.arange(steps) < length[:, None]]
    if used != len(words) or zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc:
        raise BlockDamaged("the checksum of the block's ids does not hold")
    return ids


def _block_schema(id_type: str) -> str:
    return f"shard int, block int, n_ids long, doc_ids array<{id_type}>, lengths array<bigint>, payload binary"


def write_ids(docs: DataFrame, path: str, tokenizer: str, vocabulary: int, *, end_id: int = END_ID,
              block_ids: int = BLOCK_IDS) -> None:
    """Encode the texts, append ``end_id`` to each, and write the id blocks in ascending document order."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, number = bulk_ids(tokenizer), TaskContext.get().partitionId(), 0
        id_arrow = None
        doc_ids: list = []
        waiting: list[np.ndarray] = []
        total = 0

        def close() -> pa.RecordBatch:
            lengths = [len(w) + 1 for w in waiting]
            ids = np.full(total, end_id, np.uint32)
            inside = np.ones(total, bool)
            inside[np.cumsum(lengths) - 1] = False
            ids[inside] = np.concatenate(waiting)
            return pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([total], pa.int64()),
                pa.array([doc_ids], pa.list_(id_arrow)), pa.array([lengths], pa.list_(pa.int64())),
                pa.array([encode_block(ids, vocabulary)], pa.binary()),
            ], ["shard", "block", "n_ids", "doc_ids", "lengths", "payload"])

        for batch in gathered(batches, "text", TEXT_BYTES):
            id_arrow = batch.schema.field("doc_id").type
            ids, sizes = encode(batch.column("text").cast(pa.string()))
            ends = np.cumsum(sizes)
            for doc_id, begin, end in zip(batch.column("doc_id").to_pylist(), (ends - sizes).tolist(), ends.tolist()):
                if waiting and total + end - begin + 1 > block_ids:
                    yield close()
                    doc_ids, waiting, total, number = [], [], 0, number + 1
                doc_ids.append(doc_id)
                waiting.append(ids[begin:end])
                total += end - begin + 1
        if waiting:
            yield close()

    ordered = docs.select("doc_id", whole_text().alias("text")) \
        .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(blocks, _block_schema(id_type)).write.parquet(path)


def read_ids(blocks: DataFrame, *, with_ids: bool = True) -> DataFrame:
    """Every document of the blocks with its start in the block, the CRC-32 of its ids and, unless not
    asked for, the ids themselves (little-endian unsigned 32-bit)."""
    element = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    names = ["shard", "block", "doc_id", "start_in_block", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = decode_block(batch.column("payload")[row].as_py()).astype("<u4").tobytes()
                docs = batch.column("doc_ids")[row].values
                lengths = np.asarray(batch.column("lengths")[row].values)
                ends = np.cumsum(lengths)
                if int(ends[-1]) * 4 != len(ids):
                    raise BlockDamaged("the documents' lengths do not add up to the block's ids")
                begins = ends - lengths
                n = len(lengths)
                parts = [ids[4 * a:4 * b] for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column("shard")[row].as_py()] * n, pa.int32()),
                    pa.array([batch.column("block")[row].as_py()] * n, pa.int32()),
                    docs, pa.array(begins), pa.array(lengths),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                    *([pa.array(parts, pa.binary())] if with_ids else []),
                ], names)

    schema = f"shard int, block int, doc_id {element}, start_in_block long, n_tokens long, ids_crc32 long"
    return blocks.select("shard", "block", "doc_ids", "lengths", "payload").mapInArrow(
        decode, schema + ", ids binary" if with_ids else schema)


def open_ids(spark, path: str, id_type: str = "bigint") -> DataFrame:
    return spark.read.schema(_block_schema(id_type)).parquet(path)


def block_starts(blocks: DataFrame) -> DataFrame:
    """``shard, block, first``: ids before each block.  Reads no payload; one driver row per file."""
    index = blocks.select("shard", "block", "n_ids")
    begin, total = [], 0
    for row in sorted(index.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()):
        begin.append((row["shard"], total))
        total += row["n"]
    shards = blocks.sparkSession.createDataFrame(begin, "shard int, shard_first long")
    earlier = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return index.join(shards, "shard").select("shard", "block", (
        F.col("shard_first") + F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))).alias("first"))


def round_trip(docs: DataFrame, tokenizer: str, vocabulary: int) -> DataFrame:
    """Write the ids of ``docs`` to the shared folder and describe every document from the files."""
    spark, id_type = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    path = new_path(spark, "ids")
    write_ids(docs, path, tokenizer, vocabulary)
    blocks = open_ids(spark, path, id_type)
    return read_ids(blocks, with_ids=False).join(block_starts(blocks), ["shard", "block"]).select(
        "doc_id", (F.col("first") + F.col("start_in_block")).alias("start"), "n_tokens", "ids_crc32")
