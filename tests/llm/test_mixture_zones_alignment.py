"""Mixture packing, zone-map clustering and tokenizer alignment against plain versions of the same rules."""

import hashlib
import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from layerwise.llm import alignment, mixture, zonemaps

from tests.llm.util import EDGE, SF, documents, empty

BYTE, LOWER = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PIECE = public_tokenizers.path("piece_bpe_32k.model")
TOKENS = Tokenizer.from_file(LOWER)


# --- mixture packing ---------------------------------------------------------------

def _round_robin(totals, weights, capacity):
    """Windows one after the other: what each queue owes is carried; the largest fractions are served first."""
    total = sum(weights)
    owed = [0] * len(totals)  # in units of 1 / total of a token
    for _ in range(sum(totals) // capacity):
        owed = [d + capacity * w for d, w in zip(owed, weights)]
        take = [d // total for d in owed]
        rest = capacity - sum(take)
        for q in sorted(range(len(totals)), key=lambda q: (-(owed[q] % total), q))[:rest]:
            take[q] += 1
        owed = [d - t * total for d, t in zip(owed, take)]
        yield take


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(200, 900), min_size=1, max_size=6))
def test_windows_from_their_number_are_those_of_the_loop(totals):
    schedule = mixture.Schedule(totals, totals, 32)
    phase = schedule.phases[0]
    loop = np.array(list(_round_robin(totals, totals, 32)))
    closed = np.diff(phase.served(np.arange(len(loop) + 1)), axis=0)
    assert (closed == loop).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 900), st.integers(20, 90)), min_size=1, max_size=6), st.integers(0, 2**32 - 1))
def test_every_place_is_taken_once(queues, seed):
    totals, weights = zip(*queues)
    schedule = mixture.Schedule(list(totals), list(weights), 50)
    taken = Counter()
    rng = np.random.default_rng(seed)
    for queue, total in enumerate(totals):
        if not total:
            continue
        cuts = np.unique([0, total, *rng.integers(0, total, 4)])
        owner, start, size, window, offset = schedule.cut(queue, cuts[:-1], np.diff(cuts))
        for o, s, n in zip(owner, start, size):
            assert 0 <= s and s + n <= np.diff(cuts)[o]
        for w, f, n in zip(window, offset, size):
            taken.update((int(w), int(f) + i) for i in range(n))
    assert taken == Counter((i // 50, i % 50) for i in range(sum(totals)))


def _check_pieces(docs, rows, capacity):
    """Every id of every document once, places gapless, all windows but the last full."""
    held = defaultdict(list)
    for r in rows:
        held[r.doc_id, r.doc_tokens].append((r.start, r.length, np.frombuffer(r.ids, "<u4")))
    expected, got = Counter(), Counter()
    for r in docs.collect():
        expected[r.doc_id, tuple([*TOKENS.encode(r.text or "", add_special_tokens=False).ids, 1])] += 1
    repeated = Counter(key for key, _ in expected.elements())
    for (doc_id, tokens), pieces in held.items():
        if repeated[doc_id] > 1:
            continue  # pieces of repeated rows cannot be told apart by their columns
        pieces.sort(key=lambda p: p[0])
        assert [p[0] for p in pieces] == np.cumsum([0, *(p[1] for p in pieces)])[:-1].tolist()
        ids = np.concatenate([p[2] for p in pieces])
        assert len(ids) == tokens
        got[doc_id, tuple(ids.tolist())] += 1
    assert got == Counter({k: n for k, n in expected.items() if repeated[k[0]] == 1})
    assert sum(r.length for r in rows) == sum(len(ids) * n for (_, ids), n in expected.items())
    windows = defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
    for places in windows.values():
        assert [o for o, _ in sorted(places)] == np.cumsum([0, *(n for _, n in sorted(places))])[:-1].tolist()
    sizes = [sum(n for _, n in windows[w]) for w in sorted(windows)]
    assert sorted(windows) == list(range(len(windows))) and all(n == capacity for n in sizes[:-1]) and sizes[-1] <= capacity


def test_mixture(spark):
    docs = documents(spark).selectExpr("*", "concat('s', abs(doc_id) % 5) as source")  # null for null ids
    rows = mixture.mixed(docs, LOWER, capacity=256).collect()
    _check_pieces(docs, rows, 256)
    totals, share = Counter(), defaultdict(Counter)
    for r in rows:
        totals[r.source] += r.length
        share[r.sequence_id][r.source] += r.length
    total, given_so_far = sum(totals.values()), Counter()
    own = [s for s in totals if totals[s] * 256 >= 2 * total]
    own.remove(min(own, key=totals.get))  # shares its queue with the few rows without a source
    assert len(own) == 4
    for k in range(total // 256):
        given_so_far.update(share[k])
        for s in own:
            assert abs(given_so_far[s] - (k + 1) * 256 * totals[s] / total) < 1
    digest = mixture.digest(mixture.mixed(docs, LOWER, capacity=256)).collect()
    assert Counter((r.doc_id, r.start, r.ids_crc32) for r in digest) == Counter(
        (r.doc_id, r.start, zlib.crc32(r.ids)) for r in rows)


def test_targets_hold_until_a_queue_runs_dry(spark):
    docs = documents(spark).selectExpr("*", "concat('s', abs(doc_id) % 5) as source")
    targets = {"s0": 0.5, "s1": 0.3}
    rows = mixture.mixed(docs, LOWER, capacity=200, targets=targets).collect()
    _check_pieces(docs, rows, 200)
    first = Counter()
    for r in rows:
        if r.sequence_id < 20:
            first[r.source if r.source in targets else "rest"] += r.length
    assert first == {"s0": 2000, "s1": 1200, "rest": 800}
    with pytest.raises(ValueError):
        mixture.mixed(docs, LOWER, targets={"s0": 0.0001})


def test_mixture_of_many_small_sources_and_none(spark):
    docs = spark.createDataFrame([(i, f"text of a row {i}", f"one {i}") for i in range(3000)] + [(None, None, None)],
                                 "doc_id long, text string, source string")
    _check_pieces(docs, mixture.mixed(docs, LOWER, capacity=128).collect(), 128)
    assert mixture.mixed(empty(spark), LOWER).count() == 0
    _check_pieces(docs.drop("source"), mixture.mixed(docs.drop("source"), LOWER).collect(), 2048)


# --- zone maps ---------------------------------------------------------------------

@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 3), (3, 2), (5, 1)])
def test_curve_visits_neighbours(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = zonemaps.hilbert_keys(cells, bits)
    path = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert len(set(keys)) == len(cells) and (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 2**32 - 1))
def test_candidates_hold_every_nearest_centroid(seed):
    rng = np.random.default_rng(seed)
    vectors, middle = rng.integers(-9, 9, (30, 3)) + rng.integers(-20, 20, 3), rng.integers(-30, 30, (7, 3))
    distance = ((vectors[:, None] - middle) ** 2).sum(axis=2)
    nearest = {int(c) for row in distance for c in np.flatnonzero(row == row.min())}
    assert nearest <= set(zonemaps.candidates(vectors.min(axis=0), vectors.max(axis=0), middle).tolist())


def _clusters(rows, k, rounds, dims):
    kept = [(i, [int(np.floor(64 * np.float64(x))) for x in e]) for i, e in rows
            if e is not None and len(e) == dims and all(x is not None and np.isfinite(x) for x in e)]
    ranked = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest()))
    middle = [list(v) for _, v in ranked[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(middle))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for c, vs in groups.items():
            middle[c] = [sum(column) // len(vs) for column in zip(*vs)]
    return Counter((i, nearest(v)[1], nearest(v)[0]) for i, v in kept), middle


def test_clusters(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rows += [(-1, None), (-2, []), (-3, [0.0] * 63), (-4, [float("nan")] * 64), (-5, [None] + [0.5] * 63), (-6, [0.0] * 64),
             (-6, [0.0] * 64), (None, [0.25] * 64), (-7, [-0.01] * 64)] + [(100_000 + i, [0.1] * 64) for i in range(300)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as spot", "2 as key")
    rows = [(r.vec_id, r.embedding) for r in vectors.select("vec_id", "embedding").collect()]
    for block in (512, 16):
        placed, middle = zonemaps.clustered(vectors, block=block)
        expected, centroids = _clusters(rows, 16, 3, 64)
        assert Counter((r.vec_id, r.cluster, r.distance) for r in placed.collect()) == expected
        assert middle.tolist() == centroids
    got = zonemaps.digest(vectors).collect()
    inertia = Counter()
    for _, c, d in expected.elements():
        inertia[c] += d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    assert Counter((r.vec_id, r.cluster, r.distance) for r in got) == expected
    assert all((r.cluster_inertia, r.inertia, r.centroid_sha256) == (
        inertia[r.cluster], sum(inertia.values()), names[r.cluster]) for r in got)


def test_boxes_leave_centroids_out(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(0, 0.02, 64) + (i % 8)).tolist()) for i in range(2000)]
    placed, _ = zonemaps.clustered(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=50)
    assert placed.agg({"candidates": "avg"}).first()[0] < 8


def test_few_no_and_too_large_vectors(spark):
    few = spark.createDataFrame([(1, [1.0] * 64), (2, [2.0] * 64)], "vec_id long, embedding array<double>")
    assert sorted(r.distance for r in zonemaps.digest(few).collect()) == [0, 0]
    assert zonemaps.digest(few.limit(0)).count() == 0
    assert zonemaps.digest(few.selectExpr("vec_id", "cast(null as array<double>) as embedding")).count() == 0
    with pytest.raises(Exception, match="exceeds"):
        zonemaps.digest(spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")).count()


# --- alignment ---------------------------------------------------------------------

PLAIN_A = Tokenizer.from_file(BYTE)
PLAIN_A.encode_special_tokens = True
PLAIN_B = sentencepiece.SentencePieceProcessor(model_file=PIECE)
NAMES_A = {i: t for t, i in PLAIN_A.get_vocab().items()}


def _byte_of():
    """Byte that a printable stand-in of the byte-level vocabulary means."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    table.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)})
    return table


BYTE_OF = _byte_of()


def _groups(text):
    """The groups of a text, each a pair of id lists; none if there are no tokens."""
    if not text:
        return []
    a = PLAIN_A.encode(" " + text, add_special_tokens=False).ids
    b = PLAIN_B.encode(text)
    spelt_a = [bytes(BYTE_OF[c] for c in NAMES_A[i]) for i in a]
    pieces = [PLAIN_B.id_to_piece(i) for i in b]
    spelt_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in pieces]
    if not b"".join(spelt_a) == b"".join(spelt_b) == (" " + text).encode():
        return []
    ends_a, ends_b = np.cumsum([len(t) for t in spelt_a]), np.cumsum([len(t) for t in spelt_b])
    shared, groups = set(ends_a) & set(ends_b), [([], [])]
    for side, ids, ends in ((0, a, ends_a), (1, b, ends_b)):
        at = 0
        for i, end in zip(ids, ends):
            if at == len(groups):
                groups.append(([], []))
            groups[at][side].append(i)
            at += end in shared
    return groups


def _measures(texts):
    """One tuple per text: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    groups = [_groups(t) for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    count = Counter(pair for link in links for pair in link)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for g, link in zip(groups, links):
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(link.values()),
                    sum(n for p, n in link.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in link.items()),
                    hashlib.sha256(shown.encode()).hexdigest() if g else ""))
    return out, count


FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = [(-20, "▁ mark"), (-21, "plain ▁ mark inside"), (-22, "<s> </s> <unk> <0x41> <|endoftext|>"), (-23, " lead"),
       (-24, "trail "), (-25, "你好 世界 こんにちは"), (-26, "😀😀 🏳️‍🌈 flag"), (-27, "a\x00b \x1c c"), (-28, "ﬁ ｆｕｌｌ Å é"),
       (-29, "=" * 700 + " " + "ab" * 300), (-30, "x　y z w"), (-31, "don't I'll we've 1234567 3.14")]


def test_alignment(spark):
    copies = [(1000 + i, "the very same text, many times over") for i in range(400)]
    docs = documents(spark, [*EDGE, *ODD, *copies])
    rows = docs.collect()
    expected, count = _measures([r.text for r in rows])
    found, pairs = alignment.align(docs, BYTE, PIECE)
    assert Counter((r.doc_id, *(r[f] for f in FIELDS)) for r in found.collect()) == Counter(
        (r.doc_id, *e) for r, e in zip(rows, expected))
    assert {(r.a, r.b): r.documents for r in pairs.collect()} == dict(count)


def test_alignment_in_small_blocks(spark, monkeypatch):
    texts = [t for _, t in ODD] + ["one two", "two three one", "three one two three"]
    known = alignment.Aligner(BYTE, PIECE)
    for i, text in enumerate(texts):
        made = alignment._block(known, [text], np.array([i + 1]))
        groups = _groups(text)
        links = Counter((x, y) for a, b in groups for x in a for y in b)
        assert made["measures"][0].tolist() == [sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(links.values())]
        assert {divmod(int(p), known.width) for p in made["pairs"]} == set(links)
        assert (made["documents"] == i + 1).all()


@given(st.lists(st.integers(0, 2**62), max_size=5))
def test_packed_numbers(values):
    assert alignment._unpacked(alignment._packed(np.array(values, dtype=np.int64))).tolist() == values


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("  abcé.,'▁ß1\n\t<>|"), st.characters(codec="utf-8")), max_size=40), min_size=1, max_size=4))
def test_any_text_aligns_like_the_whole(texts):
    made = alignment._block(KNOWN, texts, np.ones(len(texts), dtype=np.int64))
    expected = [_groups(t) for t in texts]
    assert made["measures"][:, 2].tolist() == [len(g) for g in expected]
    assert made["hashes"] == [e[6] for e in _measures(texts)[0]]


KNOWN = alignment.Aligner(BYTE, PIECE)


def test_no_texts_to_align(spark):
    assert alignment.align(empty(spark), BYTE, PIECE)[0].count() == 0
    none = spark.createDataFrame([(1, None), (2, ""), (None, None)], "doc_id long, text string")
    assert Counter(tuple(r) for r in alignment.align(none, BYTE, PIECE)[0].collect()) == Counter(
        (i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, None))
