"""Small tables and brute-force versions that the tests compare against."""

from collections import Counter, defaultdict

SF = "/root/testdata/sf0.001"

#: Rows every operator over documents has to take: nulls, empty and long texts, repeats.
EDGE = [
    (-1, None), (-2, ""), (-3, " \t\n"), (-4, "one"), (-5, "two words"), (-6, "w " * 30_000), (-7, "x" * 50_000),
    (None, "no id at all here"), (None, "no id at all here"), (None, None), (-8, "same row twice here"),
    (-8, "same row twice here"), (-9, "Ünïcode 😀 tëxt ３４ <|endoftext|> a  b\r\n c d é"),
]


def documents(spark, extra=EDGE, rows=True):
    """The smallest documents table plus edge rows, with columns whose names clash with those of the operators."""
    docs = spark.createDataFrame(extra, "doc_id long, text string")
    if rows:
        docs = docs.union(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    return docs.selectExpr("doc_id", "text", "1 as node", "2 as part", "'x' as score", "3 as n_tokens", "4 as base",
                           "5 as record", "6 as shard", "7 as size", "8 as component", "9 as _id")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")


def components(count, links):
    """Smallest member of every row's component."""
    parent = list(range(count))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        parent[find(a)] = find(b)
    groups = defaultdict(list)
    for i in range(count):
        groups[find(i)].append(i)
    return list(groups.values())


def smallest(ids):
    known = [i for i in ids if i is not None]
    return min(known) if known else None


def rows(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())
