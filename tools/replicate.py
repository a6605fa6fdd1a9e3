"""Scale experiment helper: write ``copies`` copies of a benchmark scale with every key shifted
per copy, so joins stay consistent and the data grows ``copies``-fold (nation and region stay
as they are, being fixed-size dimensions).  Each copy becomes its own Parquet file, so scans
also split into several tasks, as they would on a real cluster.

    python tools/replicate.py /root/testdata/sf0.1 /tmp/run-x/sf0.1x10 10
"""

from __future__ import annotations

import sys

from pyspark.sql import functions as F

sys.path.insert(0, ".")
from layerwise.plans.fixtures import TABLES  # noqa: E402
from layerwise.session import get_session  # noqa: E402

# key columns and the table whose key range they belong to
KEYS = {
    "customer": {"c_custkey": "customer"},
    "supplier": {"s_suppkey": "supplier"},
    "part": {"p_partkey": "part"},
    "orders": {"o_orderkey": "orders", "o_custkey": "customer"},
    "lineitem": {"l_orderkey": "orders", "l_partkey": "part", "l_suppkey": "supplier"},
    "events": {"event_id": "events", "user_id": "users"},
    "documents": {"doc_id": "documents"},
    "labels": {"doc_id": "documents"},
}
RANGE_OF = {"customer": ("customer", "c_custkey"), "supplier": ("supplier", "s_suppkey"),
            "part": ("part", "p_partkey"), "orders": ("orders", "o_orderkey"),
            "events": ("events", "event_id"), "users": ("events", "user_id"),
            "documents": ("documents", "doc_id")}


def main() -> None:
    src, dst, copies = sys.argv[1], sys.argv[2], int(sys.argv[3])
    spark = get_session("replicate", master="local[8]", shuffle_partitions=8)
    span = {}
    for name, (table, col) in RANGE_OF.items():
        span[name] = spark.read.parquet(f"{src}/{table}.parquet").agg(F.max(col)).first()[0] + 1
    for table in TABLES:
        df = spark.read.parquet(f"{src}/{table}.parquet")
        if table in ("nation", "region"):
            df.coalesce(1).write.mode("overwrite").parquet(f"{dst}/{table}.parquet")
            continue
        for k in range(copies):  # one file per copy
            cols = [
                (F.col(c) + F.lit(k * span[KEYS[table][c]])).cast(df.schema[c].dataType).alias(c)
                if c in KEYS.get(table, {}) else F.col(c)
                for c in df.columns
            ]
            df.select(*cols).coalesce(1).write.mode("overwrite" if k == 0 else "append") \
                .parquet(f"{dst}/{table}.parquet")
    spark.stop()


if __name__ == "__main__":
    main()
