"""Token ids exactly as the tokenizers library gives them, with every distinct word encoded once.

A text is cut before each space that a non-space character follows.  Both vocabularies split a
text there in any case (the byte-level pattern joins such a space to the next token, the
word-level one drops it), normalise nothing across it and have no special string with a space,
so the ids of the chunks, joined, are the ids of the text.

A chunk of plain characters (printable ASCII, line feeds, Latin-1 letters), for which Python's
``re`` and the library's patterns agree, is split into words here and each new word goes to the
library's BPE model.  Every other new chunk goes to the library whole.  Known chunks come from a
cache bounded in size, which ``forget`` empties: workers live on, and what they keep is memory that
the executor's next tasks lack.

``ChunkEncoder`` does that text by text; ``BulkEncoder`` over the Arrow column of many texts: chunks
and words are made distinct there and only new words, many at a time, go to the library's BPE model.
Where a vocabulary marks the end of a word by a suffix, the model gets it again (same ids, same
merges) with one letter in place of each last letter and its suffix, since by itself it would mark
only the last of many words.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Callable
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .shared import sub_batches

_CUT = re.compile(r" (?=\S)")
_LOOSE = re.compile(r" (?:\s|\Z)")
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"[\x21-\x7e\n{_LETTER}]*")
_PLAIN_CHUNKS = re.compile(rf"[\x20-\x7e\n{_LETTER}]*")
_SPECIAL = "<|"
#: Split patterns of the two vocabularies over plain characters (fixed values).
_BYTE_WORDS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\s{_LETTER}0-9]+|\s+(?!\S)|\s+")
_LOWER_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^\s{_LETTER}0-9]+")
#: The same, a space that opens a chunk included.
_OPENING_WORDS = re.compile(rf" ?(?:{_LOWER_WORDS.pattern})")
#: Chunks and words that a worker remembers; beyond it the cache starts anew.
CACHE_ENTRIES = 900_000
#: Words that ``BulkEncoder`` gives to the BPE model in one string, parted by a byte that UTF-8 never uses.
WORDS_AT_ONCE = 50
_PARTING = 0xC0
#: From the letter of a byte to the letter of the same byte at the end of a word.
_CLOSING = 0x1000
#: Settings of a BPE model that neither vocabulary has.
_OTHER_SETTINGS = ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
_RUNS_AT_ONCE = 1 << 18


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte: itself where printable, else the next code from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(shown))
    return table


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class ChunkEncoder:
    """``ids(texts)``: per text its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._lower = self._tokenizer.normalizer is not None
        self._letters = byte_letters()
        self._limit = cache_entries
        self.forget()

    def forget(self) -> None:
        self._known: dict[str, bytes] = {}  # a chunk after its space
        self._first: dict[str, bytes] = {}  # a chunk that opens a text
        self._words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        shown = word.encode().decode("latin-1").translate(self._letters)
        ids = self._words[word] = _packed([t.id for t in self._model.tokenize(shown)])
        return ids

    def _learn(self, known: dict[str, bytes], chunks: set[str], lead: str) -> None:
        whole = []
        words, pattern = self._words, _LOWER_WORDS if self._lower else _BYTE_WORDS
        for chunk in chunks:
            if chunk in known:
                continue
            if _PLAIN.fullmatch(chunk) and _SPECIAL not in chunk:
                text = chunk.lower() if self._lower else lead + chunk
                if chunk.isalpha():
                    known[chunk] = words.get(text) or self._word(text)
                else:
                    known[chunk] = b"".join([words.get(w) or self._word(w) for w in pattern.findall(text)])
            else:
                whole.append(chunk)
        if whole:
            encoded = self._tokenizer.encode_batch([lead + c for c in whole], add_special_tokens=False)
            for chunk, e in zip(whole, encoded):
                known[chunk] = _packed(e.ids)

    def ids(self, texts: list[str]) -> list[bytes]:
        if len(self._known) + len(self._first) + len(self._words) > self._limit:
            self.forget()
        cut = [_CUT.split(t) if _LOOSE.search(t) else t.split(" ") for t in texts]
        self._learn(self._first, {c[0] for c in cut}, "")
        self._learn(self._known, set(chain.from_iterable(islice(c, 1, None) for c in cut)), " ")
        first, known = self._first, self._known
        return [first[c[0]] + b"".join(map(known.__getitem__, islice(c, 1, None))) for c in cut]

    def bulk(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts as one array, and how many each text has."""
        found, sizes = [], []
        for begin, end in sub_batches(pc.binary_length(texts).to_pylist()):
            parts = self.ids(texts.slice(begin, end - begin).to_pylist())
            found += parts
            sizes += [len(p) // 4 for p in parts]
        return np.frombuffer(b"".join(found), "<u4").astype(np.uint32), np.array(sizes, np.int64)


def _joined(ids: np.ndarray, begin: np.ndarray, size: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The runs of ``ids`` at ``places``, one after the other; run i has size[i] ids from begin[i] on."""
    parts = []
    for i in range(0, len(places), _RUNS_AT_ONCE):
        some = places[i:i + _RUNS_AT_ONCE]
        n = size.take(some)
        end = np.cumsum(n)
        parts.append(ids.take(np.repeat(begin.take(some) - end + n, n) + np.arange(int(end[-1]))))
    return np.concatenate(parts)


class _Known:
    """Distinct strings in the order in which they came, and the ids of each."""

    def __init__(self):
        self.names = pa.array([], pa.string())
        self.ids = np.zeros(0, np.uint32)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.names)

    def look_up(self, names: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``names``, and which of them are new (their places are to be set)."""
        at = pc.index_in(names, value_set=self.names)
        new = at.is_null().to_numpy(zero_copy_only=False)
        return at.fill_null(0).to_numpy().astype(np.int64), new

    def add(self, names: pa.StringArray, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The places given to the new ``names``, with ``size`` of ``ids`` each."""
        places = np.arange(len(self), len(self) + len(names))
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, ids])
        self.names = pa.concat_arrays([self.names, names])
        return places


def _join(names: pa.StringArray, by: str, many: int | None = None) -> pa.StringArray:
    """Every ``many`` consecutive strings (all, if None) as one."""
    n = len(names)
    ends = pa.array([*range(0, n, many or max(n, 1)), n], pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(ends, names), by)


class NotInBulk(ValueError):
    """The byte that is to part words is no id of the vocabulary or in a merge, or the model has other settings."""


def _closed(token: str, suffix: str) -> str:
    """The token, with one letter in place of its last one and the suffix."""
    if not token.endswith(suffix):
        return token
    stem = token[:-len(suffix)]
    return stem[:-1] + chr(ord(stem[-1]) + _CLOSING)


def _without_suffix(tokenizer):
    """The tokenizer's BPE model with letters of their own for the ends of words."""
    from tokenizers.models import BPE

    model = json.loads(tokenizer.to_str())["model"]
    suffix = model["end_of_word_suffix"]
    if suffix in model["vocab"] or any(model.get(other) for other in _OTHER_SETTINGS):
        raise NotInBulk("the model has settings that this leaves out")
    vocabulary = {_closed(token, suffix): i for token, i in model["vocab"].items()}
    return BPE(vocabulary, [(_closed(a, suffix), _closed(b, suffix)) for a, b in model["merges"]]), vocabulary


class BulkEncoder:
    """``ids(texts)``: the ids of all texts as one array, and how many each text has."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model, vocabulary = self._tokenizer.model, self._tokenizer.get_vocab()
        self._lower = self._tokenizer.normalizer is not None
        self._closing = 0
        if self._model.end_of_word_suffix:
            self._model, vocabulary = _without_suffix(self._tokenizer)
            self._closing = _CLOSING
        letters = byte_letters()
        parting = letters[_PARTING]
        self._parting = vocabulary.get(parting)
        if self._parting is None or any(parting in t for t in vocabulary if t != parting):
            raise NotInBulk(path)
        self._shown = np.array([ord(letters[b]) for b in range(256)], "<u2")
        self._shown[0], self._shown[1] = ord(parting), 0xFFFF  # between words, between strings of words
        self._limit = cache_entries
        self.forget()

    def forget(self) -> None:
        self._chunks, self._words = _Known(), _Known()

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(ids), np.uint32), np.array([len(i) for i in ids], np.int64)

    def _word_places(self, words: pa.StringArray) -> np.ndarray:
        places, new = self._words.look_up(words)
        if new.any():
            words = words.filter(pa.array(new))
            raw = np.frombuffer(_join(_join(words, "\0", WORDS_AT_ONCE), "\1")[0].as_buffer(), np.uint8)
            shown = self._shown[raw]
            shown[np.append(raw[1:] < 2, True)] += self._closing
            ids: list[int] = []
            for some in shown.tobytes().decode("utf-16-le").split("\uffff"):
                ids += [t.id for t in self._model.tokenize(some)]
                ids.append(self._parting)
            found = np.array(ids, np.uint32)
            ends = np.flatnonzero(found == self._parting)
            places[new] = self._words.add(words, found[found != self._parting], np.diff(ends, prepend=-1) - 1)
        return places

    def _chunk_places(self, chunks: pa.StringArray) -> np.ndarray:
        """Places of distinct chunks, each of which follows a space."""
        places, new = self._chunks.look_up(chunks)
        if not new.any():
            return places
        new = np.flatnonzero(new)
        fresh = chunks.take(pa.array(new))
        text = _join(fresh, " ")[0].as_py()
        if text.count(" ") >= len(new) or not _PLAIN_CHUNKS.fullmatch(text) or _SPECIAL in text:
            plain = np.array([bool(_PLAIN.fullmatch(c)) and _SPECIAL not in c for c in fresh.to_pylist()])
            others = fresh.filter(pa.array(~plain))
            places[new[~plain]] = self._chunks.add(others, *self._whole([" " + c for c in others.to_pylist()]))
            new, fresh = new[plain], fresh.filter(pa.array(plain))
            text = _join(fresh, " ")[0].as_py() if len(new) else ""
        if len(new):
            split = _OPENING_WORDS.findall(" " + text.lower()) if self._lower else _BYTE_WORDS.findall(" " + text)
            words = pa.array(split, pa.string())
            opens = np.flatnonzero(pc.starts_with(words, " ").to_numpy(zero_copy_only=False))
            if self._lower:
                words = pc.ascii_ltrim(words, " ")
            coded = words.dictionary_encode()
            at = self._word_places(coded.dictionary).take(coded.indices.to_numpy())
            known = self._words
            places[new] = self._chunks.add(
                fresh, _joined(known.ids, known.begin, known.size, at), np.add.reduceat(known.size.take(at), opens))
        return places

    def ids(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(self._chunks) + len(self._words) > self._limit:
            self.forget()
        if any(_LOOSE.search(t.as_py()) for t in texts):
            cut = [_CUT.split(t.as_py()) for t in texts]
            counts = np.array([len(c) for c in cut], np.int64)
            chunks = pa.array(list(chain.from_iterable(cut)), pa.string())
            del cut
        else:
            chunks = pc.split_pattern(texts, " ")
            counts = pc.list_value_length(chunks).to_numpy()
            chunks = chunks.flatten()
        opens = np.cumsum(counts) - counts  # a chunk that opens a text follows no space
        first_ids, first_size = self._whole(chunks.take(pa.array(opens)).to_pylist())
        later = np.ones(len(chunks), bool)
        later[opens] = False
        coded = chunks.filter(pa.array(later)).dictionary_encode()
        del chunks
        places = np.empty(len(later), np.int32)
        places[later] = self._chunk_places(coded.dictionary).take(coded.indices.to_numpy())
        del coded
        known = self._chunks
        places[opens] = np.arange(len(known), len(known) + len(opens))
        begin = np.concatenate([known.begin, len(known.ids) + np.cumsum(first_size) - first_size])
        size = np.concatenate([known.size, first_size])
        ids = _joined(np.concatenate([known.ids, first_ids]), begin, size, places)
        return ids, np.add.reduceat(size.take(places), opens)


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for a vocabulary file; loaded once per Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


_BULK: dict[str, Callable[[pa.StringArray], tuple[np.ndarray, np.ndarray]]] = {}


def bulk_ids(path: str) -> Callable[[pa.StringArray], tuple[np.ndarray, np.ndarray]]:
    """The worker's way from texts to all their ids and how many each has; loaded once per Python worker."""
    if path not in _BULK:
        try:
            _BULK[path] = BulkEncoder(path).ids
        except NotInBulk:
            _BULK[path] = encoder(path).bulk
    return _BULK[path]
