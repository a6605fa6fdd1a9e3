"""Token counts, packing and id blocks against the tokenizers themselves."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from layerwise.llm import idcoder, packing, shared, token_counts
from layerwise.llm.encode import BulkEncoder, ChunkEncoder, byte_letters

from tests.llm.util import documents, empty

BYTE, LOWER = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PIECE = public_tokenizers.path("piece_bpe_32k.model")
ENCODERS = {p: ChunkEncoder(p) for p in (BYTE, LOWER)}
PLAIN = {p: Tokenizer.from_file(p) for p in (BYTE, LOWER)}
COUNTER = token_counts.LengthCounter(PIECE, piece_chars=16)
MODEL = sentencepiece.SentencePieceProcessor(model_file=PIECE)
TEXTS = st.text(alphabet=st.one_of(
    st.sampled_from(" \n\t'.,!sStTdDaAbB09éÉßñ<|endoftext|> \x1c\x85 ́Σς"), st.characters()), max_size=60)

BULK = BulkEncoder(BYTE)
BULK_TEXTS = st.one_of(st.text(alphabet=" \n'.,sa0é", max_size=60), st.text(alphabet=st.one_of(
    st.sampled_from(" \n\t'.,!sStTdDaAbB09éÉßñ<|endoftext|> \x1c\x85 ́Σς"), st.characters(codec="utf-8")), max_size=60))


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_chunks_give_the_librarys_ids(texts):
    for path in (BYTE, LOWER):
        expected = [e.ids for e in PLAIN[path].encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(b, "<u4").tolist() for b in ENCODERS[path].ids(texts)] == expected


def test_cache_starts_anew_without_changing_ids():
    small = ChunkEncoder(BYTE, cache_entries=3)
    for text in ("one two three four five", "six seven eight", "one two"):
        assert np.frombuffer(small.ids([text])[0], "<u4").tolist() == PLAIN[BYTE].encode(text).ids


def _in_bulk(encoder, texts):
    ids, sizes = encoder.ids(pa.array(texts, pa.string()))
    assert len(sizes) == len(texts) and sizes.sum() == len(ids)
    return [part.tolist() for part in np.split(ids, np.cumsum(sizes))[:-1]]


@settings(max_examples=300, deadline=None)
@given(st.lists(BULK_TEXTS, min_size=1, max_size=5))
def test_bulk_gives_the_librarys_ids(texts):
    expected = [e.ids for e in PLAIN[BYTE].encode_batch(texts, add_special_tokens=False)]
    assert _in_bulk(BULK, texts) == expected
    assert _in_bulk(BulkEncoder(BYTE) if len(texts) == 3 else BULK, texts) == expected


def test_bulk_takes_every_plain_letter_and_starts_anew():
    letters = [chr(c) for c in range(0x20, 0x250)]
    texts = ["", *letters, *(f"a {c}b {c}{c} c{c}\n'{c} {c}'s" for c in letters), "x <|endoftext|> <|y|> z", "", "ç ç", "ш ш我"]
    expected = [e.ids for e in PLAIN[BYTE].encode_batch(texts, add_special_tokens=False)]
    small = BulkEncoder(BYTE, cache_entries=3)
    assert _in_bulk(small, texts) == expected and _in_bulk(small, texts[::-1]) == expected[::-1]
    assert _in_bulk(BULK, []) == []
    for text, ids in zip(texts, expected):
        assert _in_bulk(BULK, [text]) == [ids]


BULK_LOWER = BulkEncoder(LOWER)


@settings(max_examples=300, deadline=None)
@given(st.lists(BULK_TEXTS, min_size=1, max_size=5))
def test_bulk_gives_the_librarys_ids_of_the_lower_case_vocabulary(texts):
    expected = [e.ids for e in PLAIN[LOWER].encode_batch(texts, add_special_tokens=False)]
    assert _in_bulk(BULK_LOWER, texts) == expected


def test_bulk_lower_case_takes_every_letter_and_starts_anew():
    letters = [chr(c) for c in [*range(0x250), 0x301, 0x3A3, 0x2028, 0x3000, 0xFF21]]
    texts = ["", " ", *letters, *(f"a {c}B {c}{c} C{c}\n'{c} {c}'S 1{c}2</w> {c}\n\n {c}</w>" for c in letters),
             "x <|endoftext|> <|startoftext|>y <|ENDOFTEXT|> z", "", "Ç ç", "ш Ш我", "ΟΔΟΣ ΟΔΟΣ. Σ", "it's ' s 'stop '\ns"]
    expected = [e.ids for e in PLAIN[LOWER].encode_batch(texts, add_special_tokens=False)]
    small = BulkEncoder(LOWER, cache_entries=3)
    assert _in_bulk(small, texts) == expected and _in_bulk(small, texts[::-1]) == expected[::-1]
    assert _in_bulk(BULK_LOWER, []) == []
    for text, ids in zip(texts, expected):
        assert _in_bulk(BULK_LOWER, [text]) == [ids]


def test_bulk_gives_every_token_of_the_lower_case_vocabulary():
    letters = {shown: byte for byte, shown in byte_letters().items()}
    words = []
    for token in PLAIN[LOWER].get_vocab():
        raw = bytes(letters[c] for c in token.removesuffix("</w>") if c in letters)
        words.append(raw.decode("utf-8", "ignore").replace(" ", ""))
    texts = [" ".join(["one", *words[i:i + 500]]) for i in range(0, len(words), 500)]
    assert _in_bulk(BULK_LOWER, texts) == [e.ids for e in PLAIN[LOWER].encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, max_size=4).map(" ".join))
def test_pieces_of_long_texts_add_up(text):
    assert COUNTER.lengths([text]) == [len(MODEL.encode(text))]


def test_token_counts(spark):
    docs = documents(spark)
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit)
                  for r in token_counts.token_counts(docs, PIECE, piece_chars=500).collect())
    expected = Counter()
    for r in docs.collect():
        n = len(MODEL.encode(r.text or ""))
        expected[r.doc_id, len((r.text or "").encode()), n, n > 4096] += 1
    assert got == expected
    assert token_counts.token_counts(empty(spark), PIECE).count() == 0


def _pieces(docs, capacity):
    expected = Counter()
    for r in docs.collect():
        ids = PLAIN[LOWER].encode(r.text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), capacity):
            part = np.array(ids[k:k + capacity], "<u4").tobytes()
            expected[r.doc_id, k // capacity, k, len(part) // 4, zlib.crc32(part)] += 1
    return expected


@pytest.mark.parametrize("capacity", [2048, 50])
def test_packing(spark, capacity):
    docs = documents(spark)
    rows = packing.pack(docs, LOWER, capacity=capacity).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == _pieces(docs, capacity)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(r.length for r in rows) // capacity)
    assert len(sequences) <= least * 1.02 + 2
    assert packing.pack(empty(spark), LOWER).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=25))
def test_plan_holds_every_piece_once(counts):
    held = Counter()
    for lengths, copies in packing.plan(counts, 40):
        assert copies > 0 and sum(lengths) <= 40
        for n in lengths:
            held[n] += copies
    assert held == Counter(counts)


def test_plan_fills_gaps_exactly():
    assert sorted(packing.plan({60: 2, 40: 2}, 100)) == [((60, 40), 2)]
    assert sorted(packing.plan({50: 1, 30: 1, 20: 1}, 100)) == [((50, 30, 20), 1)]
    assert sorted(packing.plan({40: 1, 30: 1, 20: 1, 10: 1}, 100)) == [((40, 30, 20, 10), 1)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=400), st.integers(1, 9))
def test_id_blocks_round_trip(ids, lanes):
    block = idcoder.encode_block(np.array(ids, np.uint32), 301, lanes)
    assert idcoder.decode_block(block).tolist() == ids


def test_id_blocks_compress_and_detect_damage():
    ids = np.tile(np.arange(50, dtype=np.uint32), 4000)
    block = idcoder.encode_block(ids, 50_257)
    assert len(block) < len(ids) // 4 and (idcoder.decode_block(block) == ids).all()
    for at in (0, 20, len(block) // 2, len(block) - 1):
        broken = bytearray(block)
        broken[at] ^= 1
        with pytest.raises(idcoder.BlockDamaged):
            idcoder.decode_block(bytes(broken))


def test_id_files(spark):
    docs = documents(spark)
    got = idcoder.round_trip(docs, BYTE, 50_257).collect()
    expected, total = Counter(), 0
    for r in docs.collect():
        ids = np.array(PLAIN[BYTE].encode(r.text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        expected[r.doc_id, len(ids) // 4, zlib.crc32(ids)] += 1
        total += len(ids) // 4
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    order = [-10**9 if r.doc_id is None else r.doc_id for r in got]  # null ids first
    assert order == sorted(order) and got[-1].start + got[-1].n_tokens == total
    assert idcoder.round_trip(empty(spark), BYTE, 50_257).count() == 0


def test_small_blocks_hold_whole_documents(spark, tmp_path):
    docs = documents(spark)
    idcoder.write_ids(docs, str(tmp_path / "ids"), BYTE, 50_257, block_ids=300)
    blocks = idcoder.open_ids(spark, str(tmp_path / "ids"))
    assert blocks.count() > 50 and idcoder.read_ids(blocks).count() == docs.count()


def test_id_files_of_the_lower_case_vocabulary(spark):
    docs = documents(spark)
    expected = Counter()
    for r in docs.collect():
        ids = np.array(PLAIN[LOWER].encode(r.text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        expected[r.doc_id, len(ids) // 4, zlib.crc32(ids)] += 1
    got = idcoder.round_trip(docs, LOWER, PLAIN[LOWER].get_vocab_size())
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got.collect()) == expected


def test_batches_are_gathered_whole():
    batches = [pa.RecordBatch.from_pydict({"n": [i], "text": ["x" * i]}) for i in range(40)]
    for limit in (1, 50, 10_000):
        got = list(shared.gathered(iter(batches), "text", limit))
        assert [n for b in got for n in b.column("n").to_pylist()] == list(range(40))
        assert all(b.num_rows < 3 or sum(map(len, b.column("text").to_pylist())) <= limit for b in got)
    assert list(shared.gathered(iter([]), "text", 5)) == []
    assert len(got) == 1


def test_gathered_rows_without_texts_are_bounded():
    empty_texts = pa.RecordBatch.from_pydict({"n": list(range(1000)), "text": [""] * 1000})
    got = list(shared.gathered(iter([empty_texts] * 8), "text", 2000 * 64, 64))
    assert [b.num_rows for b in got] == [2000] * 4
