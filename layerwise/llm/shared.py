"""Where the operators keep intermediate tables, and small helpers they share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A sub-batch of texts handled at once inside a task holds about this many bytes.
BATCH_BYTES = 1 << 20
#: What Spark sends a Python worker at once, where the session sets no size itself.  By rows alone (10,000) a
#: batch of texts takes tens of MB, several times: in the JVM's Arrow buffers, their copies and the worker.
ARROW_BYTES = 4 << 20
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``; a scratch one only where unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="layerwise-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def small_batches(spark: SparkSession) -> None:
    """From now on the session's batches for Python workers hold about ``ARROW_BYTES``."""
    if spark.conf.get(_ARROW_BYTES, None) is None:
        spark.conf.set(_ARROW_BYTES, ARROW_BYTES)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, a lost executor rereads files."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(name: str = "text") -> Column:
    """The text itself; a null text counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def sub_batches(sizes: list[int], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows of about ``limit`` bytes each (one larger row stands alone)."""
    begin = total = 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > limit:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


def slices(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in zero-copy pieces whose ``column`` holds about ``limit`` bytes each."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for begin, end in sub_batches(sizes, limit):
        yield batch.slice(begin, end - begin)


def gathered(batches: Iterator[pa.RecordBatch], column: str, limit: int, row_bytes: int = 0) -> Iterator[pa.RecordBatch]:
    """``batches`` anew, so that ``column``, and ``row_bytes`` a row, hold up to ``limit`` bytes in each (one larger
    row stands alone)."""
    import pyarrow.compute as pc

    held: list[pa.RecordBatch] = []
    total = 0
    for whole in batches:
        for piece in slices(whole, column, limit):
            n = (pc.sum(pc.binary_length(piece.column(column))).as_py() or 0) + row_bytes * piece.num_rows
            if held and total + n > limit:
                yield pa.concat_batches(held)
                held, total = [], 0
            held.append(piece)
            total += n
    if held:
        yield pa.concat_batches(held)
