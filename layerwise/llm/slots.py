"""Sharding by fixed virtual slots.

A record's slot is a hash of its identity modulo ``SLOTS`` and never changes.  Which shard holds
a slot is data: a versioned slot-to-shard map, a table of ``SLOTS`` rows per version.  Version 1
deals the slots out in turn.  ``rebalanced`` edits a version from the bytes per slot - it moves
slots from shards above the mean to shards below it, and only those - and the edited map is
stored as the next version beside the earlier ones.  Readers of an older version keep finding
their records through it.

The law is ``bytes``: shard sizes near equal, as near as one slot's size allows.  Bytes per slot
come from one aggregate with ``SLOTS`` rows whatever the input, which is all the driver sees.
Within a shard records are ordered by slot, ``doc_id`` and text.  They are parted by ranges of that
order, which cut a slot of any size between tasks, and written as (task, number in the task); an index
of one row per task and shard tells how many records of the shard lie before the task's.  A record's
place is the sum of the two, so neither a shard nor a slot passes through one task.

The hash takes ``doc_id`` and the text, so copies of one text and rows without an id spread over
the slots; only rows equal in both stay together.  Null texts have no bytes and count 8 like any
other record's overhead; an empty table gives an empty result; other columns are kept in the
written shards and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import new_path

SLOTS = 4096
SHARDS = 24
OVERHEAD = 8


def slot_of(doc_id: Column, text: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(doc_id.cast("string"), text), F.lit(slots)).cast("int")


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def first_map(slots: int = SLOTS, shards: int = SHARDS) -> dict[int, int]:
    """Version 1: slots dealt out in turn."""
    return {slot: slot % shards for slot in range(slots)}


def rebalanced(current: dict[int, int], weight: dict[int, int], shards: int = SHARDS) -> dict[int, int]:
    """``current`` edited until no single move or exchange of two slots narrows the widest gap.

    Shards over the mean give up their lightest sufficient slots, largest first, and each goes to
    the lightest shard; then the heaviest and the lightest shard exchange slots while that helps.
    """
    target = dict(current)
    held: list[set[int]] = [set() for _ in range(shards)]
    for slot, shard in target.items():
        held[shard].add(slot)
    load = [sum(weight.get(s, 0) for s in slots) for slots in held]
    mean = sum(load) / shards
    spare: list[int] = []
    for shard in range(shards):
        for slot in sorted(held[shard], key=lambda s: (weight.get(s, 0), s)):
            if load[shard] - mean <= 0:
                break
            if weight.get(slot, 0):
                held[shard].discard(slot)
                spare.append(slot)
                load[shard] -= weight[slot]
    for slot in sorted(spare, key=lambda s: (-weight[s], s)):
        shard = min(range(shards), key=lambda i: (load[i], i))
        held[shard].add(slot)
        load[shard] += weight[slot]
    for _ in range(64 * shards):
        high = max(range(shards), key=lambda i: (load[i], -i))
        low = min(range(shards), key=lambda i: (load[i], i))
        gap = load[high] - load[low]
        best = None
        lows = sorted(((weight.get(s, 0), s) for s in held[low])) + [(0, None)]
        for mine in held[high]:
            for other, slot in lows:
                moved = weight.get(mine, 0) - other
                if 0 < moved < gap and (best is None or abs(gap - 2 * moved) < best[0]):
                    best = (abs(gap - 2 * moved), mine, slot, moved)
        if best is None:
            break
        _, mine, slot, moved = best
        held[high].discard(mine)
        held[low].add(mine)
        if slot is not None:
            held[low].discard(slot)
            held[high].add(slot)
        load[high] -= moved
        load[low] += moved
    return {slot: shard for shard, slots in enumerate(held) for slot in slots}


def slot_bytes(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``slot, bytes, rows`` over all documents: at most ``slots`` rows."""
    return docs.select(slot_of(F.col("doc_id"), F.col("text"), slots).alias("slot"),
                       record_size(F.col("text")).alias("size")) \
        .groupBy("slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def store_map(spark: SparkSession, path: str, version: int, shard_of: dict[int, int]) -> None:
    """Write one version of the map beside the earlier ones; a version is never written twice."""
    spark.createDataFrame(sorted(shard_of.items()), "slot int, shard int") \
        .coalesce(1).write.parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema("slot int, shard int").parquet(f"{path}/version={version}")


def write_shards(docs: DataFrame, path: str, *, slots: int = SLOTS, shards: int = SHARDS) -> DataFrame:
    """Store map versions 1 and 2, the documents by shard and their index under ``path``; returns ``read_shards``."""
    spark = docs.sparkSession
    weight = {r["slot"]: r["bytes"] for r in slot_bytes(docs, slots).collect()}  # <= slots rows
    start = first_map(slots, shards)
    store_map(spark, f"{path}/map", 1, start)
    store_map(spark, f"{path}/map", 2, rebalanced(start, weight, shards))
    # ``slots`` rows of 8 bytes, fixed by the parameter: small enough to broadcast at any input size
    shard_of = load_map(spark, f"{path}/map", 2).withColumnRenamed("slot", "virtual_slot")
    order = ["shard", "virtual_slot", "record.doc_id", F.xxhash64("record.text")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record")) \
        .withColumn("virtual_slot", slot_of(F.col("record.doc_id"), F.col("record.text"), slots)) \
        .withColumn("size", record_size(F.col("record.text"))) \
        .join(F.broadcast(shard_of), "virtual_slot") \
        .repartitionByRange(*order).sortWithinPartitions(*order) \
        .withColumn("number", F.monotonically_increasing_id())  # task << 33, plus the row's number in the task
    rows.write.partitionBy("shard").parquet(f"{path}/shards")
    stored_rows = spark.read.schema(rows.schema).parquet(f"{path}/shards")
    earlier = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    stored_rows.groupBy("shard", _task().alias("task")) \
        .agg(F.count(F.lit(1)).alias("rows"), F.min("number").alias("first")) \
        .withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).write.parquet(f"{path}/index")
    return read_shards(stored_rows, path)


def _task() -> Column:
    return F.shiftright("number", 33)


def read_shards(stored_rows: DataFrame, path: str) -> DataFrame:
    """Rows of ``path``/shards with their places.

    Columns: those of the documents under ``record``, and ``shard``, ``virtual_slot``, ``slot`` (place in
    the shard, gapless from 0), ``size``.
    """
    index = stored_rows.sparkSession.read.schema("shard int, task long, rows long, first long, before long") \
        .parquet(f"{path}/index").drop("rows")
    # at most one row per writing task and one more per shard: some 20 MB after 400,000 tasks
    return stored_rows.withColumn("task", _task()).join(F.broadcast(index), ["shard", "task"]) \
        .select("record", "virtual_slot", "size", (F.col("before") + F.col("number") - F.col("first")).alias("slot"), "shard")


def sharded(docs: DataFrame, *, slots: int = SLOTS, shards: int = SHARDS) -> DataFrame:
    """Shard the documents into the shared folder and describe every record from the written files."""
    written = write_shards(docs.select("doc_id", "text"), new_path(docs.sparkSession, "shards"),
                           slots=slots, shards=shards)
    return written.select(
        F.col("record.doc_id").alias("doc_id"), "size",
        F.crc32(F.coalesce(F.col("record.text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot")
