"""WARC archive and virtual slots."""

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from layerwise.llm import slots, warc

from tests.llm.util import documents, empty

PAGES = [
    (5, "http://a/", "<p>same</p>"), (3, "http://b/\r\nX: y", "<p>same</p>"), (9, None, "<p>same</p>"), (1, "u", None),
    (2, "u", ""), (7, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nünï"), (None, "u", "only nameless"),
    (None, "u", "<p>same</p>"), (4, "u", "twice"), (4, "u", "twice"), (8, "u", "x" * 200_000),
]


def _pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr(
        "*", "1 as address", "2 as payload", "3 as record_type")


def test_archive_describes_every_record(spark):
    got = Counter(tuple(r) for r in warc.archive_digest(_pages(spark)).collect())
    first = {}
    for page, _, html in PAGES:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    expected = Counter()
    for page, _, html in PAGES:
        body = (html or "").encode()
        response = page == first.get(html or "")
        expected[page, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                 "response" if response else "revisit", None if response else first[html or ""]] += 1
    assert got == expected


def test_records_are_restored_byte_by_byte(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write(_pages(spark), path)
    records, payloads = warc.read(spark, path)
    assert payloads.count() == len({h or "" for _, _, h in PAGES}) and records.count() == len(PAGES)
    for r in warc.restore(spark, path).collect():
        record = bytes(r.record)
        header, _, block = record.partition(b"\r\n\r\n")
        length = int(header.rsplit(b"Content-Length: ", 1)[1])
        assert record[len(header) + 4 + length:] == b"\r\n\r\n"
        http, _, body = block[:length].partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK")
        assert body == (b"" if r.record_type == "revisit" else bytes(r.payload))


def test_small_payloads_are_always_responses(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write(_pages(spark), path, least_bytes=100)
    assert {r.record_type for r in warc.restore(spark, path).collect()} == {"response"}


def test_damage_is_found(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write(_pages(spark), path)
    _, payloads = warc.read(spark, path)
    payloads.selectExpr("address", "cast('other' as binary) as payload").write.parquet(str(tmp_path / "bad" / "payloads"))
    warc.read(spark, path)[0].write.parquet(str(tmp_path / "bad" / "records"))
    with pytest.raises(Exception, match="damaged payload"):
        warc.restore(spark, str(tmp_path / "bad")).collect()


def test_empty_archive(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_digest(pages).count() == 0


def test_shards(spark):
    docs = documents(spark)
    rows = slots.sharded(docs).collect()
    expected = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode()))
                       for r in docs.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected
    places, load = defaultdict(list), Counter()
    for r in rows:
        places[r.shard].append(r["slot"])
        load[r.shard] += r["size"]
        assert 0 <= r.shard < 24 and r.law == "bytes" and r.grown_shard is None
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    rest = [v for v in load.values() if v < 45_000]  # two edge texts alone outweigh a mean shard
    assert max(rest) <= 1.3 * min(rest)
    assert slots.sharded(empty(spark)).count() == 0


def test_near_equal_bytes_on_a_real_table(spark):
    load = Counter()
    for r in slots.sharded(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect():
        load[r.shard] += r["size"]
    assert len(load) == 24 and max(load.values()) <= 1.01 * min(load.values())


def test_rebalancing_moves_few_slots_and_keeps_versions(spark, tmp_path):
    start = slots.first_map(64, 4)
    weight = {s: 10 for s in range(64)} | {0: 50}
    edited = slots.rebalanced(start, weight, 4)
    load = Counter()
    for s, shard in edited.items():
        load[shard] += weight[s]
    assert max(load.values()) - min(load.values()) <= 10
    assert sum(edited[s] != start[s] for s in start) <= 8
    slots.store_map(spark, str(tmp_path / "map"), 1, start)
    slots.store_map(spark, str(tmp_path / "map"), 2, edited)
    assert {r.slot: r.shard for r in slots.load_map(spark, str(tmp_path / "map"), 1).collect()} == start
    with pytest.raises(Exception, match="exists"):
        slots.store_map(spark, str(tmp_path / "map"), 2, start)


def test_written_shards_keep_all_columns(spark, tmp_path):
    docs = documents(spark)
    written = slots.write_shards(docs, str(tmp_path / "s"))
    assert written.select("record.*").columns == docs.columns and written.count() == docs.count()


def test_a_slot_is_cut_between_tasks(spark, tmp_path):
    """Two slots hold all rows; places follow slot, id and text whatever the tasks."""
    docs = spark.range(4000).selectExpr("id % 1000 as doc_id", "concat('text ', id) as text", "id as shard")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = slots.write_shards(docs, str(tmp_path / "s"), slots=2, shards=2).collect()
        index = spark.read.parquet(str(tmp_path / "s" / "index")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert Counter((r.record.doc_id, r.record.text) for r in rows) == Counter((r.doc_id, r.text) for r in docs.collect())
    assert len(index) > 4 and sum(r["rows"] for r in index) == 4000  # several tasks a slot
    for shard in {r.shard for r in rows}:
        own = sorted((r for r in rows if r.shard == shard), key=lambda r: r["slot"])
        assert [r["slot"] for r in own] == list(range(len(own)))
        keys = [(r.virtual_slot, r.record.doc_id) for r in own]
        assert keys == sorted(keys)
