"""What operators must not do twice, or keep: comparisons of a hit, caches of a task that is over, large batches."""

import re
import shutil

import numpy as np
import pyarrow as pa

from layerwise.llm import encode, idcoder, minmax, mixture, packing, shared, spaced_seed

from tests.llm.test_tokens import BYTE, LOWER, PLAIN


def test_words_of_a_hit_are_compared_once(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l"), (2, "x y z")], "doc_id long, text string")
    items = spark.createDataFrame([(5, "b c d e f g h i j k")], "item_id long, text string")
    found = spaced_seed.overlaps(docs, items)
    assert [(r.doc_id, r.item_id, r.doc_word, r.matched, r.share) for r in found.collect()] == [(1, 5, 1, 10, 1.0)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("transform(item_words") == 1


def _kept(spark, path, word):
    """Most that a worker still holds of the chunks of the vocabulary at ``path`` and of ``word``."""
    def count(batches):
        from layerwise.llm import encode

        for batch in batches:
            own = encode._ENCODERS.get(path)
            chunks = len(own._known) + len(own._first) + len(own._words) if own else 0
            yield pa.RecordBatch.from_arrays([pa.array([chunks + (word in minmax._HASHES)], pa.int64())], ["n"])

    return max(r.n for r in spark.range(0, 64, 1, 16).mapInArrow(count, "n long").collect())


def test_workers_keep_nothing_of_a_task(spark, tmp_path):
    path = shutil.copy(LOWER, tmp_path)  # other tests' workers know it not
    docs = spark.createDataFrame([(i, f"unheardofword and number {i}") for i in range(40)], "doc_id long, text string")
    assert packing.pieces(docs, path).count() == 40
    assert _kept(spark, path, b"unheardofword") == 0
    assert minmax.deduplicated(docs).count() == 40
    assert _kept(spark, path, b"unheardofword") == 0


def test_batches_are_bounded_in_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    import corpus_pipeline

    spark.conf.unset(shared._ARROW_BYTES)
    texts = spark.range(0, 4000, 1, 1).selectExpr("id as doc_id", "repeat('word ', 2000) as text")
    corpus_pipeline.drop_near_copies(spark, texts.limit(3), "")
    most = max(r.n for r in texts.mapInArrow(sizes, "n long").collect())
    assert most < 2 * shared.ARROW_BYTES
    spark.conf.set(shared._ARROW_BYTES, 1 << 16)  # a session's own size stays
    shared.small_batches(spark)
    assert spark.conf.get(shared._ARROW_BYTES) == str(1 << 16)
    spark.conf.unset(shared._ARROW_BYTES)


class _Counted:
    """A BPE model that counts how often it is called."""

    def __init__(self, model):
        self.model, self.calls = model, 0

    def tokenize(self, text):
        self.calls += 1
        return self.model.tokenize(text)


def test_new_words_reach_the_model_many_at_a_time():
    bulk = encode.BulkEncoder(BYTE)
    bulk._model = counted = _Counted(bulk._model)
    texts = [" ".join(f"{'bcdfghjklm'[i % 10]}{'aeiou'[i % 5]}w{'xyz' * (i % 7)}q{i}." for i in range(n, n + 50))
             for n in range(0, 2000, 50)]
    ids, sizes = bulk.ids(pa.array(texts))
    expected = [e.ids for e in PLAIN[BYTE].encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(e) for e in expected] and ids.tolist() == [i for e in expected for i in e]
    assert 0 < counted.calls < 100  # 2,000 chunks of several words each
    calls = counted.calls
    assert bulk.ids(pa.array(texts))[0].tolist() == ids.tolist() and counted.calls == calls


def test_new_lower_case_words_reach_the_model_many_at_a_time():
    bulk = encode.BulkEncoder(LOWER)
    bulk._model = counted = _Counted(bulk._model)
    texts = [" ".join(f"{'bcdfghjklm'[i % 10]}{'aeiou'[i % 5]}W{'xyz' * (i % 7)}q{i}." for i in range(n, n + 50))
             for n in range(0, 2000, 50)]
    ids, sizes = bulk.ids(pa.array(texts))
    expected = [e.ids for e in PLAIN[LOWER].encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(e) for e in expected] and ids.tolist() == [i for e in expected for i in e]
    assert 0 < counted.calls < 100  # 2,000 chunks of several words each


def test_mixture_encodes_in_bulk(spark, tmp_path):
    path = shutil.copy(LOWER, tmp_path)  # other tests' workers know it not

    def ways(batches):
        from layerwise.llm import encode

        for _ in batches:
            own = encode._BULK.get(path)
            bulk = own is not None and isinstance(own.__self__, encode.BulkEncoder)
            yield pa.RecordBatch.from_arrays([pa.array([bulk]), pa.array([path in encode._ENCODERS])], ["bulk", "single"])

    docs = spark.createDataFrame([(i, f"text number {i}", "a") for i in range(40)], "doc_id long, text string, source string")
    assert mixture.token_rows(docs, path).count() == 40
    seen = spark.range(0, 64, 1, 16).mapInArrow(ways, "bulk boolean, single boolean").collect()
    assert any(r.bulk for r in seen) and not any(r.single for r in seen)


def test_places_in_a_source_go_on_from_batch_to_batch(spark):
    docs = spark.range(0, 3000, 1, 1).selectExpr("id as doc_id", "repeat('word ', 4000 * int(id % 2)) as text",
                                                 "string(id % 3) as source")
    rows = mixture.token_rows(docs, LOWER).selectExpr("doc_id", "source", "before", "doc_tokens", "length(ids) as n").collect()
    given = {"0": 0, "1": 0, "2": 0}
    for r in sorted(rows):  # 30 MB of texts in one task, more than are encoded at once
        assert (r.before, r.doc_tokens, r.n) == (given[r.source], 4000 * (r.doc_id % 2) + 1, 4 * r.doc_tokens)
        given[r.source] += r.doc_tokens
    assert len(rows) == 3000


def test_a_block_of_a_million_ids_takes_few_steps(monkeypatch):
    steps = []
    predict = idcoder._Model.predict
    monkeypatch.setattr(idcoder._Model, "predict", lambda model, active: steps.append(active) or predict(model, active))
    ids = np.random.default_rng(7).integers(0, 3000, 1 << 20).astype(np.uint32)
    block = idcoder.encode_block(ids, 50_257)
    assert len(steps) <= 256 and sum(steps) == len(ids)
    assert (idcoder.decode_block(block) == ids).all() and len(steps) <= 512


def test_ids_that_nobody_asks_for_stay_in_the_worker(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(40)], "doc_id long, text string")
    idcoder.write_ids(docs, str(tmp_path / "ids"), BYTE, 50_257)
    blocks = idcoder.open_ids(spark, str(tmp_path / "ids"))
    with_ids, without = idcoder.read_ids(blocks), idcoder.read_ids(blocks, with_ids=False)
    assert "ids" not in without.columns
    assert sorted(with_ids.drop("ids").collect()) == sorted(without.collect())
    plan = idcoder.round_trip(docs, BYTE, 50_257)._jdf.queryExecution().optimizedPlan().toString()
    assert "decode(" in plan and re.search(r"(?<!_)\bids#", plan) is None
