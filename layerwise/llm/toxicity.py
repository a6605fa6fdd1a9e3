"""Toxicity by multiple-instance learning: document labels train a model of sentences.

A document is a bag of sentences.  A sentence's probability is logistic in its words and their
first three to six letters, so that inflected forms share weight; a document is toxic if any sentence
is, so its probability is the noisy-or of its sentences'.  Only documents carry labels; the gradient of
the document's likelihood shares each label out among its sentences, and the sentences that explain it
are found on the way (``locate``).

The noisy-or starts from harmless sentences and stays below the truth where toxic documents are few, so
its log-odds are calibrated: ``CALIBRATION_FOLDS`` further models, each trained without one fold of the
sample, rate the fold they have not seen, and a scale and an offset are fitted to these ratings, a
missed toxic document counting ``MISS_COST`` times as much as a clean one flagged.

Training takes at most ``PER_CLASS`` labelled documents of each label, those with the smallest hash of
their id, less those with which the words to collect would pass ``PER_CLASS_BYTES``: the documented
bounds of the fit.  Documents whose id's CRC-32 is divisible by ``FOLDS`` are never among them, neither
for the weights nor for the calibration.  Their words, by sentence, come to the driver, sorted by id, so a
run repeated gives the same model.  Scoring is one pass over all documents without a shuffle.

Sentences end at ``.``, ``!``, ``?`` or a line feed, and after ``LONGEST`` words.  Texts that are
null or without words score 0.0.  Labels repeated for a document count once, the highest, and of documents
with one id the smallest text is trained on; null labels are ignored.  Without labelled documents of both
kinds every document scores 0.0; without enough of both for every fold the score is not calibrated.
Repeated rows each give a row, and a null ``doc_id`` is kept and counts as held out.  Other
columns are not read by ``score`` and are kept by ``accepted``; empty tables give empty results.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import slices, stored, whole_text

FOLDS = 5
PER_CLASS = 3_000
PER_CLASS_BYTES = 1 << 25
CALIBRATION_FOLDS = 3
MISS_COST = 3.0
#: Cut-off above which a document counts as toxic.
CUT = 0.5
BUCKETS = 1 << 18
PREFIXES = (3, 4, 5, 6)
LEAST_DOCUMENTS = 8  # a bucket seen in fewer training documents has no weight
LONGEST = 64
ROUNDS = 160
FIRST_BIAS = -8.0  # a sentence is taken for harmless until its words say otherwise
RATE = 0.6
SHRINK = 1e-4
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")
_WORDS_KEPT = 500_000


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def features(word: str) -> list[int]:
    """Hash buckets of a word and of its beginnings."""
    parts = {word, *(f"{n}<{word[:n]}" for n in PREFIXES if len(word) >= n)}
    return sorted({zlib.crc32(p.encode("utf-8", "surrogatepass")) & (BUCKETS - 1) for p in parts})


def sentences(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Start, end and lower-case words of every sentence that has words."""
    for found in _SENTENCE.finditer(text):
        words = _WORD.findall(found.group().lower())
        if len(words) <= LONGEST:
            if words:
                yield found.start(), found.end(), words
            continue
        places = list(_WORD.finditer(found.group()))
        for k in range(0, len(places), LONGEST):
            part = places[k:k + LONGEST]
            yield found.start() + part[0].start(), found.start() + part[-1].end(), [p.group().lower() for p in part]


@dataclass
class Model:
    bias: float
    weights: np.ndarray
    scale: float = 1.0
    offset: float = 0.0

    def __post_init__(self) -> None:
        self._known: dict[str, float] = {}

    def weight(self, word: str) -> float:
        value = self._known.get(word)
        if value is None:
            if len(self._known) > _WORDS_KEPT:
                self._known.clear()
            value = self._known[word] = float(sum(self.weights[b] for b in features(word)))
        return value

    def logits(self, text: str) -> list[tuple[float, int, int]]:
        """Logit, start and end of every sentence."""
        weight = self.weight
        return [(self.bias + sum(map(weight, set(words))), start, end) for start, end, words in sentences(text)]

    def chance(self, logit: float) -> float:
        """Calibrated probability for the log-odds of a noisy-or, or of a sentence on its own."""
        return float(np.exp(-np.logaddexp(0, -(self.scale * logit + self.offset))))

    def score(self, text: str) -> tuple[float, int | None, int | None]:
        """Calibrated noisy-or of the sentences, and where the most suspicious one lies."""
        found = self.logits(text)
        if not found:
            return 0.0, None, None
        z = np.array([f[0] for f in found])
        worst = int(z.argmax())
        return self.chance(noisy_or(z)), found[worst][1], found[worst][2]


def noisy_or(z: np.ndarray) -> float:
    """Log-odds of "some sentence is toxic" from the sentences' log-odds."""
    none = max(float(np.logaddexp(0, z).sum()), 1e-300)  # -log of "no sentence is toxic"
    return none + float(np.log(-np.expm1(-none)))


def likelihood(label: np.ndarray, document: np.ndarray, z: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean log-likelihood of the documents' labels, and its slope in each sentence's log-odds ``z``."""
    none = np.bincount(document, np.logaddexp(0, z), len(label))  # -log of "no sentence is toxic"
    some = np.maximum(-np.expm1(-none), 1e-12)
    share = np.where(label == 1, np.exp(-none) / some, -1.0)
    value = np.where(label == 1, np.log(some), -none).mean()
    return float(value), share[document] / (1 + np.exp(-z)) / len(label)


def train(bags: list[tuple[int, list[str]]]) -> Model | None:
    """Fit the sentence model to ``(label, sentences as distinct words)`` by gradient steps."""
    label = np.array([y for y, _ in bags], dtype=np.float64)
    if not len(bags) or label.min() == label.max() or not any(bag for _, bag in bags):
        return None
    document = np.repeat(np.arange(len(bags)), [len(s) for _, s in bags])
    number: dict[str, int] = {}
    word, sentence, documents = [], [], Counter()
    at = 0
    for _, bag in bags:
        for part in bag:
            for w in part.split(" "):
                word.append(number.setdefault(w, len(number)))
                sentence.append(at)
            at += 1
        documents.update({w for part in bag for w in part.split(" ")})
    word, sentence = np.array(word, np.int32), np.array(sentence, np.int32)
    owner, bucket = [], []
    for w, i in number.items():
        for f in features(w):
            owner.append(i)
            bucket.append(f)
    owner, bucket = np.array(owner, np.int32), np.array(bucket, np.int32)
    spread = np.array([documents[w] for w in number])  # documents that hold a word
    seen = np.bincount(bucket, spread[owner], BUCKETS)
    keep = seen[bucket] >= LEAST_DOCUMENTS
    names, bucket = np.unique(bucket[keep], return_inverse=True)
    owner = owner[keep]
    weights, bias = np.zeros(len(names)), FIRST_BIAS
    grown, bias_grown = np.full(len(names), 1e-10), 1e-10
    for _ in range(ROUNDS):
        of_word = np.bincount(owner, weights[bucket], len(number))
        z = bias + np.bincount(sentence, of_word[word], at)
        _, slope = likelihood(label, document, z)
        step = np.bincount(bucket, np.bincount(word, slope[sentence], len(number))[owner], len(names)) - SHRINK * weights
        grown += step ** 2
        weights += RATE * step / np.sqrt(grown)
        bias_step = slope.sum()
        bias_grown += bias_step ** 2
        bias += RATE * bias_step / np.sqrt(bias_grown)
    whole = np.zeros(BUCKETS, np.float32)
    whole[names] = weights
    return Model(float(bias), whole)


def calibration(label: np.ndarray, logit: np.ndarray, cost: float = MISS_COST) -> tuple[float, float]:
    """Scale and offset that make ``logit`` the log-odds of ``label``; labels smoothed by one of each kind, the
    scale drawn to 1 with the strength of one document.  Damped Newton steps on a convex loss."""
    toxic = label == 1
    aim = np.where(toxic, 1 - 1 / (toxic.sum() + 2), 1 / ((~toxic).sum() + 2))
    weight = np.where(toxic, cost, 1.0)
    known = np.stack([logit, np.ones(len(logit))], 1)

    def loss(at: np.ndarray) -> float:
        z = known @ at
        return float((weight * (np.logaddexp(0, z) - aim * z)).sum() + (at[0] - 1) ** 2 / 2)

    at = np.array([1.0, 0.0])
    for _ in range(60):
        p = np.exp(-np.logaddexp(0, -(known @ at)))
        slope = known.T @ (weight * (p - aim)) + [at[0] - 1, 0]
        curve = (known * (weight * p * (1 - p))[:, None]).T @ known + np.diag([1.0, 1e-9])
        step, part = np.linalg.solve(curve, slope), 1.0
        while part > 1e-9 and loss(at - part * step) > loss(at):
            part /= 2
        if part <= 1e-9 or np.abs(step).max() < 1e-9:
            break
        at = at - part * step
    return (float(at[0]), float(at[1])) if at[0] > 0 else (1.0, 0.0)


def train_calibrated(sample: list[tuple[str, int, list[str]]]) -> Model | None:
    """Model of ``(doc_id, label, sentences as distinct words)``, calibrated on documents not trained on."""
    bags = [(label, bag) for _, label, bag in sample]
    model = train(bags)
    if model is None:
        return None
    fold = np.array([zlib.crc32(doc_id.encode()) // FOLDS % CALIBRATION_FOLDS for doc_id, _, _ in sample])
    label, logit = [], []
    for k in range(CALIBRATION_FOLDS):
        other = train([bag for bag, f in zip(bags, fold) if f != k])
        if other is None:
            return model
        for (y, bag), f in zip(bags, fold):
            if f == k and bag:
                label.append(y)
                logit.append(noisy_or(np.array([other.bias + sum(map(other.weight, part.split(" "))) for part in bag])))
    if len(set(label)) == 2:
        model.scale, model.offset = calibration(np.array(label), np.array(logit))
    return model


def _within(sizes: list, limit: int) -> list[tuple[int, str]]:
    """``(label, doc_id)`` in order of hash while their bytes, by label, stay in ``limit``; what passes it is left out."""
    used: Counter[int] = Counter()
    kept = []
    for r in sorted(sizes, key=lambda r: (r["label"], r["rank"], r["doc_id"])):
        if used[r["label"]] + r["bytes"] <= limit:
            used[r["label"]] += r["bytes"]
            kept.append((r["label"], r["doc_id"]))
    return kept


def fit(docs: DataFrame, labels: DataFrame, *, per_class: int = PER_CLASS,
        per_class_bytes: int = PER_CLASS_BYTES) -> Model | None:
    """Train on at most ``per_class`` documents and ``per_class_bytes`` of words of each label, none held out."""
    known = labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1)) \
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    chosen = None
    for value in (0, 1):
        part = known.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                bags = []
                for text in batch.column("text").to_pylist():
                    bags.append([" ".join(sorted(set(w))) for _, _, w in sentences(text)])
                size = [sum(len(part.encode("utf-8", "surrogatepass")) for part in bag) for bag in bags]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("label"), batch.column("rank"), pa.array(size, pa.int64()),
                     pa.array(bags, pa.list_(pa.string()))], ["doc_id", "label", "rank", "bytes", "bag"])

    # at most twice ``per_class`` ids and labels are broadcast
    sample = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id") \
        .groupBy("doc_id", "label").agg(F.min("text").alias("text")) \
        .select(F.col("doc_id").cast("string").alias("doc_id"), "label", F.xxhash64("doc_id").alias("rank"), "text") \
        .mapInArrow(words, "doc_id string, label int, rank long, bytes long, bag array<string>")
    table = stored(sample, "toxicity-sample")
    kept = _within(table.select("doc_id", "label", "rank", "bytes").collect(), per_class_bytes)
    if not kept:
        return None
    # kept: at most twice ``per_class`` rows
    rows = table.join(F.broadcast(docs.sparkSession.createDataFrame(kept, "label int, doc_id string")),
                      ["label", "doc_id"]).select("doc_id", "label", "bag").collect()
    return train_calibrated(sorted((r["doc_id"], r["label"], r["bag"]) for r in rows))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, held_out, score, predicted, worst_start, worst_end`` of every document."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                found = [model.score(t) if model else (0.0, None, None) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), batch.column("held_out"),
                    pa.array([f[0] for f in found], pa.float64()),
                    pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.int32()),
                ], ["doc_id", "held_out", "score", "worst_start", "worst_end"])

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), whole_text().alias("text")).mapInArrow(
        rate, f"doc_id {id_type}, held_out boolean, score double, worst_start int, worst_end int") \
        .withColumn("predicted", (F.col("score") >= CUT).cast("int")) \
        .select("doc_id", "held_out", "score", "predicted", "worst_start", "worst_end")


def locate(docs: DataFrame, model: Model | None, *, least: float = CUT) -> DataFrame:
    """``doc_id, start, end, chance, sentence`` of every sentence whose own probability reaches ``least``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = []
                for i, text in enumerate(batch.column("text").to_pylist()):
                    for z, start, end in (model.logits(text) if model else ()):
                        chance = model.chance(z)
                        if chance >= least:
                            rows.append((i, start, end, chance, text[start:end].strip()))
                owner, start, end, chance, sentence = zip(*rows) if rows else ((),) * 5
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(pa.array(owner, pa.int32())), pa.array(start, pa.int32()),
                    pa.array(end, pa.int32()), pa.array(chance, pa.float64()), pa.array(sentence, pa.string())],
                    ["doc_id", "start", "end", "chance", "sentence"])

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        find, f"doc_id {id_type}, start int, end int, chance double, sentence string")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` less those that score ``CUT`` or more; all columns kept."""
    model = fit(docs, labels)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = batch.column("text").to_pylist()
                yield batch.filter(pa.array([not model or model.score(t or "")[0] < CUT for t in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
