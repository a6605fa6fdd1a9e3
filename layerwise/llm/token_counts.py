"""Token counts: batch encoding in an Arrow function that returns lengths only.

Each Arrow batch is cut into sub-batches of about equal bytes, so one library call never holds
more than a bounded amount of text.  A text longer than ``piece_chars`` is split at safe
boundaries first.  A boundary is a single space between two non-space characters: the vocabulary
has no piece with the word mark after another character, so no merge crosses the start of a word,
and the library puts the same mark before a text that it puts in place of the space.  That is
read from the vocabulary file; a vocabulary for which it does not hold is never split.

Nulls and empty texts have 0 bytes and 0 tokens; a null ``doc_id`` is kept; repeated rows each give a row; other columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import BATCH_BYTES, sub_batches, whole_text

PIECE_CHARS = 32_768
LIMIT = 4096
_MARK = "▁"
_SAFE = re.compile(r"(?<=[!-~]) (?=[!-~])")


class LengthCounter:
    """Lengths of texts under one sentencepiece model."""

    def __init__(self, path: str, piece_chars: int = PIECE_CHARS):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self._piece_chars = piece_chars
        pieces = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        marks_open_words = not any(_MARK in p.lstrip(_MARK) for p in pieces)
        # one space becomes one mark, and a text gets one mark in front
        one_mark = [p for p in self._model.encode("a b", out_type=str) if p.startswith(_MARK)]
        self._splittable = marks_open_words and len(one_mark) == 2

    def split(self, text: str) -> list[str]:
        """``text`` in pieces whose token counts add up to its own; the separating spaces are left out."""
        if len(text) <= self._piece_chars or not self._splittable:
            return [text]
        parts, begin = [], 0
        while len(text) - begin > self._piece_chars:
            cut = _SAFE.search(text, begin + self._piece_chars)
            if not cut:
                break
            parts.append(text[begin:cut.start()])
            begin = cut.end()
        parts.append(text[begin:])
        return parts

    def lengths(self, texts: list[str]) -> list[int]:
        pieces: list[str] = []
        owner: list[int] = []
        for i, text in enumerate(texts):
            parts = self.split(text)
            pieces += parts
            owner += [i] * len(parts)
        counts = [0] * len(texts)
        for begin, end in sub_batches([len(p) for p in pieces], BATCH_BYTES):
            for i, ids in zip(owner[begin:end], self._model.encode(pieces[begin:end], num_threads=1)):
                counts[i] += len(ids)
        return counts


_COUNTERS: dict[tuple[str, int], LengthCounter] = {}


def _counter(path: str, piece_chars: int) -> LengthCounter:
    if (path, piece_chars) not in _COUNTERS:
        _COUNTERS[path, piece_chars] = LengthCounter(path, piece_chars)
    return _COUNTERS[path, piece_chars]


def token_counts(docs: DataFrame, path: str, *, limit: int = LIMIT, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document; one scan, no shuffle."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, piece_chars)
        for batch in batches:
            sizes = batch.column("n_bytes").to_pylist()
            for begin, end in sub_batches(sizes):
                part = batch.slice(begin, end - begin)
                lengths = counter.lengths(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_bytes"), pa.array(lengths, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"])

    texts = docs.select("doc_id", whole_text().alias("text")) \
        .withColumn("n_bytes", F.octet_length("text").cast("long"))
    return texts.mapInArrow(count, f"doc_id {id_type}, n_bytes long, n_tokens long") \
        .withColumn("over_limit", F.col("n_tokens") > limit)
