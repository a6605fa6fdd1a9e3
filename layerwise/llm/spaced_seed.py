"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

Texts become lower-case words (runs of letters and digits).  A seed is the hash of the words that
a fixed mask selects from a window; the positions the mask ignores may hold any words, so a
substituted word leaves the seeds intact that skip it.  Every window of every document is hashed
under every mask and looked up among the seeds of the benchmark items.  A hit fixes how item and
document align; the words of the whole item are then compared along that alignment.  A document
overlaps an item if, in some stretch of ``WINDOW`` words (all of a shorter item), at least
``SHARE`` of the words agree.  The masks leave no such overlap without a hit: whichever words a
stretch may have substituted (or cut off by the document's begin or end), some mask selects only
others; ``tests/llm`` enumerates all cases.

Long items are searched in overlapping segments of ``SEGMENT`` words, any stretch lying whole in
one of them.  Windows are hashed inside one scan of the documents, however large the benchmark is.  Up
to ``PART_SEGMENTS`` segments, these and their seeds are broadcast and looked up right there.  Beyond,
what is broadcast is a bit set of the seeds, of ``FILTER_BITS`` bits at any size: windows whose bit is
set are shuffled to the seeds by hash, without their texts, and the hits that remain are joined with
their segments and documents.  Either way the same hits are compared word by word.

An item of one to four words has no stretch of which ``SHARE`` of the words, but not all, agree: it is
found where the document holds the whole item, word for word.  Documents of any length are searched
whole.

Null and empty texts, and items without a word, overlap nothing.  Equal items are reported under the
smallest ``item_id``.  Documents are told apart by ``doc_id`` and text; repeated rows give one
result row.  Empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

#: Fixed values, found by search over all masks: together they hit every overlap with a segment of eleven words or more.
MASKS = ("1101111", "11111001", "1100010111", "11010100011")
#: The same for shorter segments, by their length.
SHORT_MASKS = {
    **{n: ("1" * n,) for n in range(1, 5)},  # all words have to agree
    5: ("1111", "11101", "11011", "10111"),
    6: ("11111", "111101", "111011", "110111", "101111"),
    7: ("111011", "101111", "1111001"),
    8: ("110111", "1111001"),
    9: ("1101111", "11011011"),
    10: ("110111", "11001011", "110100101"),
}
WINDOW = 20
SHARE = 0.8
SEGMENT = 60
#: Segments up to which they are broadcast with their seeds: at most 60 words and 205 seeds each, some 40 MB in all.
PART_SEGMENTS = 6_000
#: Bits of the filter of a larger benchmark's seeds: 128 MB.
FILTER_BITS = 1 << 30


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def _seed(tokens: Column, at: Column, mask: str) -> Column:
    return F.xxhash64(*[F.get(tokens, at + i) for i, use in enumerate(mask) if use == "1"], F.lit(mask))


def _segments(benchmark: DataFrame) -> DataFrame:
    """``segment, item_id, first, item_words``: the distinct items in segments; ``first`` counts words from 0."""
    step = SEGMENT - WINDOW
    size = F.size("all_words")
    last = F.greatest(F.lit(0), F.ceil((size - SEGMENT) / step).cast("int"))
    return benchmark.select("item_id", words(F.col("text")).alias("all_words")) \
        .filter(size > 0) \
        .groupBy("all_words").agg(F.min("item_id").alias("item_id")) \
        .select("item_id", "all_words", F.explode(F.sequence(F.lit(0), last)).alias("number")) \
        .select("item_id", (F.col("number") * step).alias("first"),
                F.slice("all_words", F.col("number") * step + 1, F.lit(SEGMENT)).alias("item_words")) \
        .withColumn("segment", F.xxhash64("item_id", "first", "item_words"))


def _at(count: Column) -> Column:
    return F.explode(F.when(count > 0, F.sequence(F.lit(0), count - 1)))


def _seeds(segments: DataFrame, masks: list[str]) -> DataFrame:
    """``seed, item_at, segment``: every window of every segment under each of ``masks`` that is for its length."""
    parts = []
    size = F.size("item_words")
    for mask in masks:
        short = size.isin([n for n, own in SHORT_MASKS.items() if mask in own])
        parts.append(segments.filter(short | (size > max(SHORT_MASKS)) if mask in MASKS else short)
                     .select("*", _at(size - len(mask) + 1).alias("item_at"))
                     .select(_seed(F.col("item_words"), F.col("item_at"), mask).alias("seed"), "item_at", "segment",
                             size.alias("item_size")))
    return reduce(DataFrame.union, parts)


def _bit(seed: Column) -> tuple[Column, Column]:
    """Bucket of 32,768 bits and the bit there that stand for ``seed`` in the filter."""
    number = F.pmod(seed, F.lit(FILTER_BITS)) + 1
    return F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).cast("int").alias("bit")


def _shuffled_hits(windows: DataFrame, seeds: DataFrame, docs: DataFrame) -> DataFrame:
    """Hits with their documents' words, found by a shuffle of the windows that pass a filter of the seeds."""
    seeds = stored(seeds, "seeds")
    bits = seeds.select(*_bit(F.col("seed"))).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", F.shiftright("bit", 3) + 1, F.lit(1))), 16, 10).cast("int")
    hits = windows.select("doc_id", "text_hash", "at", "window_seed", *_bit(F.col("window_seed"))) \
        .join(F.broadcast(bits), "bucket") \
        .filter(F.getbit(byte, F.col("bit").bitwiseAND(7)) == 1) \
        .join(seeds, F.col("window_seed") == F.col("seed")) \
        .select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), "segment", "item_size",
                (F.col("at") - F.col("item_at")).alias("start")).distinct()
    return docs.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")))


def _best_window(marks: Column) -> Column:
    """The largest number of agreeing words in a stretch of ``WINDOW`` words, as share of the stretch."""
    size = F.length(marks)
    width = F.least(size, F.lit(WINDOW))
    return F.array_max(F.transform(
        F.sequence(F.lit(1), size - width + 1),
        lambda s: F.length(F.replace(F.substring(marks, s, width), F.lit("0"), F.lit(""))))) / width


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, text_hash, item_id, doc_word, matched, share``: each overlap of a document with an item.

    ``doc_word`` is the word of the document at which the item's first word lies (negative if the
    document begins inside the item), ``matched`` the agreeing words, ``share`` that of the best stretch.
    """
    segments = stored(_segments(benchmark), "segments")
    lengths = [r[0] for r in segments.select(F.size("item_words").alias("n")).filter(F.col("n") <= max(SHORT_MASKS))
               .distinct().collect()]
    masks = list(dict.fromkeys([*MASKS, *(m for n in sorted(lengths) for m in SHORT_MASKS[n])]))
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("doc_words"))
    windows = texts \
        .select("*", _at(F.size("doc_words") - min(map(len, masks)) + 1).alias("at")) \
        .select("*", F.explode(F.array(*[
            F.when(F.col("at") + len(m) <= F.size("doc_words"), _seed(F.col("doc_words"), F.col("at"), m))
            for m in masks])).alias("window_seed")).filter(F.col("window_seed").isNotNull())
    seeds = _seeds(segments, masks)
    few = segments.count() <= PART_SEGMENTS
    if few:
        hits = windows.join(F.broadcast(seeds), F.col("window_seed") == F.col("seed")) \
            .withColumn("start", F.col("at") - F.col("item_at"))
    else:
        hits = _shuffled_hits(windows, seeds, texts)
    # only the words along the segment go on with a hit: a long document isn't repeated with each of its hits
    begin = F.greatest(F.col("start"), F.lit(0))
    hits = hits.select("doc_id", "text_hash", "segment", "start", (begin - F.col("start")).alias("skipped"),
                       F.slice("doc_words", begin + 1, F.col("item_size")).alias("near"))
    marks = F.array_join(F.transform(F.col("item_words"), lambda w, i: F.when(
        (i >= F.col("skipped")) & (i - F.col("skipped") < F.size("near"))
        & F.get(F.col("near"), i - F.col("skipped")).eqNullSafe(w), "1").otherwise("0")), "")
    # exploded: no filter passes that, so the words of a hit are compared once, not once for each use of the marks
    matched = F.length(F.replace("marks", F.lit("0"), F.lit("")))
    return hits.join(F.broadcast(segments) if few else segments, "segment") \
        .select("doc_id", "text_hash", "item_id", "first", F.col("start").alias("segment_word"),
                F.explode(F.array(marks)).alias("marks")) \
        .filter(matched / F.least(F.length("marks"), F.lit(WINDOW)) >= SHARE) \
        .withColumn("share", F.element_at(F.transform(F.array("marks"), _best_window), 1)) \
        .filter(F.col("share") >= SHARE) \
        .distinct() \
        .select("doc_id", "text_hash", "item_id", (F.col("segment_word") - F.col("first")).alias("doc_word"),
                matched.alias("matched"), "share")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document that overlaps an item: ``doc_id, text_hash, item_ids, matched``."""
    return overlaps(docs, benchmark).groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("matched").alias("matched"))


def without_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` less those that overlap an item; all columns kept."""
    found = contaminated(docs, benchmark).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    same = docs["doc_id"].eqNullSafe(found["_id"]) & (F.xxhash64(docs["text"]) == found["_hash"])
    return docs.join(found, same, "left_anti")
