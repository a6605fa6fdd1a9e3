"""Cross-tokenizer alignment of a byte-level vocabulary (A) and a sentencepiece one (B).

The texts are shuffled by their full text, so each distinct text is tokenised and aligned once and
carries the number of its copies.  Byte offsets at which a token of A and a token of B both end cut
them into groups; every A token of a group is linked with every B token of it.  The count of an id
pair is the number of documents, copies included, that hold it linked.

A text is first cut before single spaces between plain characters (printable ASCII, Latin-1
letters).  Both vocabularies start a token there, and none of their tokens reaches across, so the
groups of a text are the groups of its chunks, one after the other, and a worker aligns each new
chunk once, several joined by spaces in one call of the library.  What cannot be cut so (other scripts, runs of spaces) is one chunk, aligned like any.

About ``BLOCK_BYTES`` of distinct texts make a stored block: the chunk numbers of each text, the
links of each distinct chunk, and every distinct id pair once with the documents of the block that
hold it.  Pair counts are sums over blocks.  The counts come back to a block as one row per
distinct pair, bounded by the block's bytes, and are added up along its chunks and texts there.
Measures are joined to ``doc_id`` by SHA-256 of the text; texts with over 1/``HOT`` of all copies,
of which there are at most ``HOT``, are broadcast instead, so no copy group lands in one task.

Null and empty texts, and texts whose joined token bytes differ from space + text, have no tokens:
zeros and an empty ``groups_sha256``.  Texts of any length are aligned whole.  A null ``doc_id`` is
kept; repeated rows each give a row and count as documents; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encode import byte_letters
from .shared import slices, stored

BLOCK_BYTES = 4 << 20
HOT = 1000
#: Chunks and characters of them that a worker remembers; beyond either it starts anew.
CACHE_CHUNKS, CACHE_CHARS = 200_000, 1 << 23
#: Chunks that are encoded as one line of text.
LINE = 500
_SAFE = "!-~À-ÖØ-öø-ÿ"
_CUT = re.compile(rf" (?<=[{_SAFE}] )(?=[{_SAFE}])")
_MARK = "▁"
_BYTE = re.compile(r"<0x([0-9A-F]{2})>\Z")
_MEASURES = ("n_a", "n_b", "n_groups", "n_links")


def _spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers ``starts[i] .. starts[i] + counts[i]`` of every i, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts) + np.repeat(starts, counts)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``, ``counts`` long each (none: 0)."""
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return upto[ends] - upto[ends - counts]


def _flat(lists: Iterable[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64)


def _distinct(codes: np.ndarray) -> np.ndarray:
    """Distinct codes, ascending."""
    ordered = np.sort(codes)
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered


def _packed(values: np.ndarray) -> bytes:
    """Counts or places in the narrowest width that holds them; the first byte is that width."""
    width = next(w for w in (1, 2, 4, 8) if not len(values) or int(values.max()) < 1 << (8 * w))
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _tallied(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, and the sum of ``times`` over each."""
    distinct, at = np.unique(codes, return_inverse=True)
    return distinct, np.bincount(at, weights=times, minlength=len(distinct)).astype(np.int64)


class Aligner:
    """Chunks and their alignment, remembered from text to text."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True  # their strings inside a text are ordinary text
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        vocabulary = self._a.get_vocab()
        shown = {c: b for b, c in byte_letters().items()}
        self._bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            # a special token's string may hold characters that stand for no byte; it never comes from a text
            self._bytes_a[i] = bytes(shown[c] for c in token) if all(c in shown for c in token) else token.encode()
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self._bytes_b = [bytes.fromhex(m[1]) if (m := _BYTE.match(p)) else p.replace(_MARK, " ").encode() for p in pieces]
        self._length_a = np.array([len(t) for t in self._bytes_a])
        self._length_b = np.array([len(t) for t in self._bytes_b])
        self.width = len(pieces)
        #: Ids as text: after it the next id of the side, or the end of the side.
        self._names = [f"{i}{end}" for ends in (",|", ",;") for i in range(max(len(self._bytes_a), self.width))
                       for end in ends]
        self.forget()

    def forget(self) -> None:
        self._number: dict[str, int] = {}
        self._chars = 0
        self.groups: list[str] = []
        self.measures = np.zeros((0, 5), dtype=np.int64)  # _MEASURES, then 1 if the bytes agree
        self.pairs = np.zeros(0, dtype=np.int64)  # codes: A id times ``width`` plus B id
        self.times = np.zeros(0, dtype=np.int64)
        self.pair_counts = np.zeros(0, dtype=np.int64)

    def numbers(self, texts: list[str]) -> list[list[int]]:
        """The chunk numbers of every text."""
        if len(self._number) > CACHE_CHUNKS or self._chars > CACHE_CHARS:
            self.forget()
        cut = [_CUT.split(text) for text in texts]
        new = [c for c in dict.fromkeys(chain.from_iterable(cut)) if c not in self._number]
        if new:
            gc.disable()  # many small lists, none of them in a cycle
            self._learn(new)
            gc.enable()
        return [list(map(self._number.__getitem__, chunks)) for chunks in cut]

    def _ids_a(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, a space in front of each, and how many belong to each."""
        lines = [" " + " ".join(chunks[i:i + LINE]) for i in range(0, len(chunks), LINE)]
        ids = _flat(e.ids for e in self._a.encode_batch_fast(lines, add_special_tokens=False))
        ends = np.cumsum(self._length_a[ids])
        stops = np.cumsum([len(chunk.encode()) + 1 for chunk in chunks])
        upto = np.searchsorted(ends, stops, side="right")
        if len(ends) and ends[-1] == stops[-1] and (ends[upto - 1] == stops).all():
            return ids, np.diff(upto, prepend=0)
        each = [e.ids for e in self._a.encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)]
        return _flat(each), np.array([len(ids) for ids in each])

    def _agree(self, chunks: list[str], sides: list[tuple[list[bytes], np.ndarray, np.ndarray]]) -> np.ndarray:
        """Whether both sides spell out space + chunk."""
        wholes = [b" " + chunk.encode() for chunk in chunks]
        sizes = np.array([len(w) for w in wholes])
        agree = np.ones(len(chunks), dtype=bool)
        for table, ids, counts in sides:
            spelt = list(map(table.__getitem__, ids.tolist()))
            agree &= _sums(np.array([len(t) for t in spelt], dtype=np.int64), counts) == sizes
            if not agree.all() or b"".join(spelt) != b"".join(wholes):
                ends = np.cumsum(counts).tolist()
                agree &= np.array([b"".join(spelt[i:j]) == w for i, j, w in zip([0, *ends], ends, wholes)], dtype=bool)
        return agree

    def _learn(self, chunks: list[str]) -> None:
        ids_a, count_a = self._ids_a(chunks)
        lists = self._b.encode(chunks, num_threads=1)
        count_b = np.array([len(ids) for ids in lists])
        ids_b = _flat(lists)
        agree = self._agree(chunks, [(self._bytes_a, ids_a, count_a), (self._bytes_b, ids_b, count_b)])
        ids_a, ids_b = ids_a[np.repeat(agree, count_a)], ids_b[np.repeat(agree, count_b)]
        count_a, count_b = np.where(agree, count_a, 0), np.where(agree, count_b, 0)
        # both sides spell the same bytes, chunk by chunk, so ends may be counted from the first chunk on
        ends_a, ends_b = np.cumsum(self._length_a[ids_a]), np.cumsum(self._length_b[ids_b])
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        size_a, size_b = (np.bincount(g, minlength=len(cuts)) for g in (group_a, group_b))
        count_groups = np.diff(np.concatenate([[0], np.searchsorted(
            cuts, np.concatenate([[0], ends_a])[np.cumsum(count_a)], side="right")]))
        links = _sums(size_a * size_b, count_groups)

        # distinct ids of a group on each side, then every combination of them
        left, times_a = _tallied(group_a * len(self._bytes_a) + ids_a, np.ones(len(ids_a)))
        right, times_b = _tallied(group_b * self.width + ids_b, np.ones(len(ids_b)))
        kinds_b = np.bincount(right // self.width, minlength=len(cuts))
        group = left // len(self._bytes_a)
        first = np.cumsum(kinds_b) - kinds_b
        of_a = np.repeat(np.arange(len(left)), kinds_b[group])
        of_b = _spans(first[group], kinds_b[group])
        code = left[of_a] % len(self._bytes_a) * self.width + right[of_b] % self.width
        chunk = np.repeat(np.arange(len(chunks)), count_groups)[group[of_a]] if len(group) else group
        order = np.lexsort((code, chunk))
        code, chunk, times = code[order], chunk[order], (times_a[of_a] * times_b[of_b])[order]
        news = np.flatnonzero(np.concatenate([[True], (np.diff(code) != 0) | (np.diff(chunk) != 0)])) if len(code) else code
        times = np.add.reduceat(times, news) if len(code) else times

        last_a, last_b = np.isin(ends_a, cuts), np.isin(ends_b, cuts)
        names = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        names[np.arange(len(ids_a)) + (np.cumsum(size_b) - size_b)[group_a]] = 2 * ids_a + last_a
        names[np.arange(len(ids_b)) + np.cumsum(size_a)[group_b]] = len(self._names) // 2 + 2 * ids_b + last_b
        shown = list(map(self._names.__getitem__, names.tolist()))
        stops = np.cumsum(count_a + count_b).tolist()

        self._number.update(zip(chunks, range(len(self.groups), len(self.groups) + len(chunks))))
        self._chars += sum(map(len, chunks))
        self.groups += ["".join(shown[i:j]) for i, j in zip([0, *stops], stops)]
        self.measures = np.concatenate([self.measures, np.stack(
            [count_a, count_b, count_groups, links, agree], axis=1).astype(np.int64)])
        self.pairs = np.concatenate([self.pairs, code[news]])
        self.times = np.concatenate([self.times, times])
        self.pair_counts = np.concatenate([self.pair_counts, np.bincount(chunk[news], minlength=len(chunks))])


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner for two vocabulary files."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


_BLOCK = ("block long, keys array<binary>, copies array<long>, hashes array<string>, measures binary, words binary, "
          "word_counts binary, slots binary, times binary, slot_counts binary, pairs binary, documents binary")


def _block(known: Aligner, texts: list[str], copies: np.ndarray) -> dict[str, object]:
    """The arrays of one block: per text its chunks, per chunk its pairs, per pair the documents that hold it."""
    numbers = known.numbers(texts)
    counts = np.array([len(n) for n in numbers])
    flat = np.array(list(chain.from_iterable(numbers)), dtype=np.int64)
    whole = _sums(known.measures[flat, 4], counts) == counts  # bytes agree in every chunk
    hashes = [hashlib.sha256("".join(map(known.groups.__getitem__, n))[:-1].encode()).hexdigest() if good else ""
              for n, good in zip(numbers, whole)]
    flat, counts = flat[np.repeat(whole, counts)], np.where(whole, counts, 0)
    chunks, words = np.unique(flat, return_inverse=True)
    measures = np.stack([_sums(known.measures[flat, i], counts) for i in range(4)], axis=1)

    starts = np.cumsum(known.pair_counts) - known.pair_counts
    slot_counts = known.pair_counts[chunks]
    at = _spans(starts[chunks], slot_counts)
    pairs, slots = np.unique(known.pairs[at], return_inverse=True)
    # distinct chunks of each text, then distinct pairs of each text
    held = _distinct(np.repeat(np.arange(len(texts)), counts) * max(1, len(chunks)) + words)
    text, chunk = np.divmod(held, max(1, len(chunks)))
    slot = slots[_spans((np.cumsum(slot_counts) - slot_counts)[chunk], slot_counts[chunk])]
    held = _distinct(np.repeat(text, slot_counts[chunk]) * max(1, len(pairs)) + slot)
    text, slot = np.divmod(held, max(1, len(pairs)))
    documents = np.bincount(slot, weights=copies[text], minlength=len(pairs)).astype(np.int64)
    return {"hashes": hashes, "measures": measures, "words": words, "word_counts": counts, "slots": slots,
            "times": known.times[at], "slot_counts": slot_counts, "pairs": pairs, "documents": documents}


def aligned_blocks(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Blocks of distinct texts (``text, key, copies``), tokenised and aligned."""
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, block = aligner(path_a, path_b), TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in slices(whole, "text", BLOCK_BYTES):
                made = _block(known, batch.column("text").to_pylist(), batch.column("copies").to_numpy())
                row = {"block": block, "keys": batch.column("key").to_pylist(), "copies": batch.column("copies").to_pylist(),
                       **{name: _packed(v.ravel()) if isinstance(v, np.ndarray) else v for name, v in made.items()}}
                yield pa.RecordBatch.from_pylist([row], schema=_arrow_block())
                block += 1
        known.forget()  # a worker lives on; what it remembers should not

    return texts.select("text", "key", "copies").mapInArrow(align, _BLOCK)


def _arrow_block() -> pa.Schema:
    lists = {"keys": pa.list_(pa.binary()), "copies": pa.list_(pa.int64()), "hashes": pa.list_(pa.string())}
    names = [field.split()[0] for field in _BLOCK.split(", ")]
    return pa.schema([(n, pa.int64() if n == "block" else lists.get(n, pa.binary())) for n in names])


def block_pairs(blocks: DataFrame, width: int) -> DataFrame:
    """``block, slot, a, b, documents``: every distinct pair of every block."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, documents in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "documents"))):
                codes = _unpacked(pairs)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(codes), block)), pa.array(np.arange(len(codes), dtype=np.int32)),
                    pa.array((codes // width).astype(np.int32)), pa.array((codes % width).astype(np.int32)),
                    pa.array(_unpacked(documents))], ["block", "slot", "a", "b", "documents"])

    return blocks.select("block", "pairs", "documents").mapInArrow(
        explode, "block long, slot int, a int, b int, documents long")


def _measured(blocks: DataFrame, counted: DataFrame) -> DataFrame:
    """``key, copies`` and the measures of every distinct text, from its block and the counts of its pairs."""
    names = ["key", "copies", *_MEASURES, "n_best", "count_sum", "groups_sha256"]

    def measure(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {c: left.column(c)[0].as_py() for c in left.column_names}
        arrays = {c: _unpacked(row[c]) for c in ("measures", "words", "word_counts", "slots", "times", "slot_counts")}
        count, best = np.zeros(len(right), dtype=np.int64), np.zeros(len(right), dtype=np.int64)
        slot = right.column("slot").to_numpy()
        count[slot], best[slot] = right.column("count").to_numpy(), right.column("best").to_numpy()
        found = []
        for value in (best, count):
            by_chunk = _sums(value[arrays["slots"]] * arrays["times"], arrays["slot_counts"])
            found.append(_sums(by_chunk[arrays["words"]], arrays["word_counts"]))
        columns = [*arrays["measures"].reshape(-1, 4).T, *found]
        return pa.Table.from_arrays(
            [pa.array(row["keys"], pa.binary()), pa.array(row["copies"], pa.int64()),
             *(pa.array(np.ascontiguousarray(c)) for c in columns), pa.array(row["hashes"], pa.string())], names=names)

    longs = ", ".join(f"{c} long" for c in names[1:-1])
    return blocks.drop("pairs", "documents").groupBy("block").cogroup(counted.groupBy("block")) \
        .applyInArrow(measure, f"key binary, {longs}, groups_sha256 string")


def align(docs: DataFrame, path_a: str, path_b: str) -> tuple[DataFrame, DataFrame]:
    """Measures of every document, and ``a, b, documents`` of every linked id pair."""
    keyed = docs.select("doc_id", "text").withColumn("key", F.unhex(F.sha2("text", 256)))
    present = F.col("text").isNotNull() & (F.col("text") != "")
    texts = keyed.filter(present).groupBy("text", "key").agg(F.count(F.lit(1)).alias("copies"))
    blocks = stored(aligned_blocks(texts, path_a, path_b), "alignment-blocks")
    width = len_b(path_b)
    pairs = stored(block_pairs(blocks, width), "alignment-pairs")
    counts = stored(pairs.groupBy("a", "b").agg(F.sum("documents").alias("count")), "alignment-counts")
    best = counts.groupBy("a").agg(F.max("count").alias("most"))
    # ``best`` has a row per id of A at most
    flagged = counts.join(F.broadcast(best), "a").select("a", "b", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))
    counted = pairs.select("block", "slot", "a", "b").join(flagged, ["a", "b"]).select("block", "slot", "count", "best")
    measures = stored(_measured(blocks, counted), "alignment-measures")

    columns = [*_MEASURES, "n_best", "count_sum", "groups_sha256"]
    total = measures.agg(F.sum("copies")).first()[0] or 0
    hot = F.broadcast(measures.filter(F.col("copies") * HOT > total).select("key", *columns, F.lit(True).alias("hot")))
    told = keyed.filter(present).drop("text").join(hot, "key", "left")
    common = told.filter("hot").select("doc_id", *columns)
    rare = told.filter("hot is null").select("key", "doc_id").join(
        measures.filter(F.col("copies") * HOT <= total), "key").select("doc_id", *columns)
    none = keyed.filter(~present | F.col("text").isNull()).select(
        "doc_id", *[F.lit(0).cast("long").alias(c) for c in columns[:-1]], F.lit("").alias(columns[-1]))
    return common.union(rare).union(none), counts.withColumnRenamed("count", "documents")


def len_b(path: str) -> int:
    """Number of pieces of a sentencepiece vocabulary."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()
