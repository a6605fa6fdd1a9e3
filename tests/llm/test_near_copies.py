"""Near copies of texts and of vectors, and the components under them, against brute force."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from layerwise.llm import blocks
from layerwise.llm import components as cc
from layerwise.llm import minmax, rotcodes

from tests.llm.util import SF, components, documents, empty, smallest


def _sets(texts, size):
    out = []
    for text in texts:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        out.append({tuple(words[i:i + size]) for i in range(len(words) - size + 1)}
                   if len(words) >= size else {tuple(words)} - {()})
    return out


def _groups(sets, percent):
    links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i])
             if a and b and 100 * len(a & b) >= percent * len(a | b)]
    return components(len(sets), links)


def _variants(spark):
    """Near copies at all distances of one text, beside the edge rows."""
    words = [f"word{i}" for i in range(120)]
    rows = []
    for k in range(40):
        changed = list(words)
        for i in range(k % 8):
            changed[(7 * k + 17 * i) % 120] = f"other{k}x{i}"
        rows.append((1000 + k, " ".join(changed)))
    rows += [(2000, "A b C d"), (2001, "a  B\nc\td"), (2002, "a b"), (2003, "A B"), (3, "shares an id with a real document")]
    return documents(spark).union(spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1", "2", "'x'", "3", "4", "5", "6", "7", "8", "9"))


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_components_of_texts(spark, size, percent):
    docs = _variants(spark)
    table = docs.collect()
    sets = _sets([r.text for r in table], size)
    expected = Counter()
    for group in _groups(sets, percent):
        name = smallest(table[i].doc_id for i in group)
        for i in group:
            own = name if sets[i] else table[i].doc_id
            expected[table[i].doc_id, len(sets[i]), own, own == table[i].doc_id] += 1
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept)
                  for r in minmax.near_copies(docs, size=size, percent=percent).collect())
    assert got == expected


def test_one_document_of_each_group_stays(spark):
    docs = _variants(spark)
    table = docs.collect()
    sets = _sets([r.text for r in table], 5)
    kept = minmax.deduplicated(docs)
    rows = kept.collect()
    assert kept.columns == docs.columns
    groups = _groups(sets, 80)
    wordless = sum(1 for s in sets if not s)
    assert len(rows) == len([g for g in groups if sets[g[0]]]) + wordless
    stayed = Counter(r.doc_id for r in rows)
    for group in groups:
        if sets[group[0]]:
            assert stayed[smallest(table[i].doc_id for i in group)] >= 1
    assert minmax.deduplicated(empty(spark)).count() == 0
    assert minmax.near_copies(empty(spark)).count() == 0


def test_a_large_group_makes_no_pairs(spark):
    """Two thousand exact copies are one class, two hundred near copies one component."""
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(base)) for i in range(2000)]
    rows += [(5000 + i, " ".join([*base[:i % 100], f"n{i}", *base[i % 100 + 1:]])) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minmax.near_copies(docs).collect()
    assert {r.component_id for r in got} == {0} and sum(r.kept for r in got) == 1


def test_signatures_estimate_similarity():
    sketcher = minmax.Sketcher(0.8)
    rng = np.random.default_rng(3)
    common, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (600, 200, 200))
    first, second = (np.frombuffer(sketcher.sketch(np.unique(np.concatenate([common, x])))[0], "<u2") for x in (a, b))
    assert abs((first == second).mean() - 0.6) < 0.12


@pytest.mark.parametrize("percent", [80, 85])
def test_links_at_the_threshold_are_missed_as_rarely_as_stated(percent):
    """Bands and signature test together, for unions of ``n`` shingles of which ``m`` are common."""
    bands = minmax.band_count(percent / 100)
    rounds = bands * minmax.BAND // 2
    for n in range(2, 300):
        m = -(-percent * n // 100)
        both = m * (m - 1) / (n * (n - 1))
        one = 2 * (m / n - both)
        no_band = (1 - both ** (minmax.BAND // 2)) ** bands
        agreeing = np.ones(1)  # chances of 0, 1, 2, ... values of the signature that agree
        for _ in range(rounds):
            agreeing = np.convolve(agreeing, [max(0.0, 1 - one - both), one, both])
        least = (percent / 100 - minmax.SLACK) * 2 * rounds
        assert no_band + agreeing[:int(np.ceil(least - 1e-9))].sum() <= minmax.MISS, (n, m)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), min_size=1, max_size=30))
def test_components(spark, links):
    got = {r.node: r.component for r in cc.components(spark.createDataFrame(links, "a long, b long")).collect()}
    for group in components(26, links):
        if len(group) > 1:
            assert {got[i] for i in group} == {min(group)}


def test_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    assert {r.component for r in cc.components(chain).collect()} == {0}


def test_no_row_is_lost_in_more_than_two_gigabytes():
    size = 1_100_000_000
    raw, ends = pa.py_buffer(np.zeros(size, np.uint8)), pa.py_buffer(np.array([0, size], np.int32))
    unit = pa.Array.from_buffers(pa.binary(), 1, [None, ends, raw])
    held = [pa.RecordBatch.from_arrays([pa.array([node]), unit], ["node", "unit"]) for node in (1, 2)]
    assert blocks.one_batch(pa.Table.from_batches(held)).column("node").to_pylist() == [1, 2]
    assert [n for b in rotcodes._one_length(held) for n in b.column("node").to_pylist()] == [1, 2]


VECTORS = [
    (-1, None), (-2, []), (-3, [0.0, 0.0]), (-4, [1.0, None]), (-5, [float("nan"), 1.0]), (-6, [float("inf"), 1.0]),
    (None, [1.0, 2.0]), (None, [1.0, 2.0]), (-7, [2.0, 4.0]), (-8, [1.0]), (-9, [-1.0]), (-10, [3.0]), (5, [1.0, 2.0, 3.0]),
]


def _vectors(spark):
    rng = np.random.default_rng(11)
    rows = list(VECTORS)
    for g in range(6):  # groups of near copies, one of them larger than a chunk
        centre = rng.standard_normal(32)
        for k in range(350 if g == 0 else 12):
            rows.append((10_000 + 1000 * g + k, (centre + 0.03 * g * rng.standard_normal(32)).astype("f4").tolist()))
    real = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").union(real).selectExpr("*", "1 as node", "2 as label")


def _links(table):
    by_size = {}
    for i, r in enumerate(table):
        v = r.embedding
        if v and None not in v and np.isfinite(v).all() and np.any(v):
            by_size.setdefault(len(v), []).append(i)
    links = []
    for rows in by_size.values():
        x = np.array([table[i].embedding for i in rows], dtype=np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        links += [(rows[i], rows[j]) for i, j in zip(*np.nonzero(x @ x.T >= 0.95)) if i < j]
    return links


def test_components_of_vectors(spark):
    vectors = _vectors(spark)
    table = vectors.collect()
    links = _links(table)
    degree = Counter(i for pair in links for i in pair)
    got = rotcodes.near_vectors(vectors).collect()
    assert len(got) == len(table)
    found = sum(r.n_links for r in got)
    assert 0.98 * 2 * len(links) <= found <= 2 * len(links)  # recall; never a pair below the threshold
    expected = Counter()
    for group in components(len(table), links):
        name = smallest(table[i].vec_id for i in group)
        for i in group:
            expected[table[i].vec_id, name] += 1
    assert Counter((r.vec_id, r.component_id) for r in got) == expected
    exact = Counter((table[i].vec_id, degree[i]) for i in range(len(table)))
    assert sum((Counter((r.vec_id, r.n_links) for r in got) - exact).values()) <= 0.1 * len(table)


def test_no_vectors(spark):
    assert rotcodes.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_pairs_inside_runs():
    expected = [
        (0, 1), (0, 2), (1, 2), (4, 5), (4, 6), (4, 7), (5, 6), (5, 7), (6, 7)]
    runs = np.array([0, 3, 4]), np.array([3, 1, 4])
    left, right = blocks.pairs(*runs)
    assert sorted(zip(left.tolist(), right.tolist())) == expected
    for limit in (1, 3, 4, 100):
        made = [p for l, r in blocks.pair_slices(*runs, limit) for p in zip(l.tolist(), r.tolist())]
        assert sorted(made) == expected


def test_estimates_are_unbiased_over_rotations():
    rng = np.random.default_rng(5)
    a, b = (v / np.linalg.norm(v) for v in rng.standard_normal((2, 24)))
    estimates = []
    for number in range(1500):
        turn = rotcodes._rotation.__wrapped__(24, number)
        x, y = a @ turn, b @ turn
        factor = np.abs(x).sum() / np.sqrt(24)
        estimates.append(np.sign(x) @ y / np.sqrt(24) / factor)
    assert abs(np.mean(estimates) - a @ b) < 0.02
