"""Archives: exact round trip, ownership of records by ranges, damage and false magic."""

from __future__ import annotations

import base64
import hashlib
import zlib

from zonepulse.llm import warc
from pyspark.sql import functions as F

from zonepulse.llm.warc import MAGIC, archive_pages, owned_records, read_archives, record, write_archives


class Bytes:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at : at + n]


def test_every_record_has_one_owner():
    rows = [record({"WARC-Type": "response", "N": str(i)}, bytes(range(256)) * (i % 5)) for i in range(40)]
    data = b"".join(rows)
    for step in (7, 64, 1000, len(data)):
        found = [f["n"] for s in range(0, len(data), step) for _, f, _ in owned_records(Bytes(data), s, min(s + step, len(data)), len(data))]
        assert found == [str(i) for i in range(40)]


def test_false_magic_is_no_record():
    """A stored (not packed) member that holds the magic and a whole inner record."""
    inner = record({"WARC-Type": "response", "N": "inner"}, b"inner")
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    block = MAGIC + b"noise" + inner + b" and more"
    head = f"WARC/1.1\r\nWARC-Type: response\r\nN: outer\r\nContent-Length: {len(block)}\r\n\r\n".encode()
    outer = packer.compress(head + block + b"\r\n\r\n") + packer.flush()
    data = record({"WARC-Type": "response", "N": "a"}, b"a") + outer + record({"WARC-Type": "response", "N": "z"}, b"z")
    for step in (5, 50, len(data)):
        found = [f["n"] for s in range(0, len(data), step) for _, f, _ in owned_records(Bytes(data), s, min(s + step, len(data)), len(data))]
        assert found == ["a", "outer", "z"]


def test_damage_costs_its_own_record_only():
    rows = [record({"WARC-Type": "response", "N": str(i)}, b"x" * 500) for i in range(5)]
    rows[2] = rows[2][:20] + b"\0\0\0" + rows[2][23:]
    data = b"".join(rows)
    assert [f["n"] for _, f, _ in owned_records(Bytes(data), 0, len(data), len(data))] == ["0", "1", "3", "4"]


def expected(rows):
    first, out = {}, []
    for page, _, html in rows:
        if page is not None:
            data = (html or "").encode()
            first[data] = min(first.get(data, page), page)
    for page, _, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        again = page is not None and first[data] < page
        out.append((page, len(data), digest, "revisit" if again else "response", first[data] if again else None))
    return sorted(out, key=repr)


PAGES = [
    (5, "http://a", "<p>same</p>"), (2, "http://b\r\nX: y", "<p>same</p>"), (9, None, "<p>same</p>"), (2, "http://b", "<p>same</p>"), (1, "u", None), (3, "u", ""),
    (4, "u", "é日本😀" * 1000), (7, "u", "x" * 3_000_000), (8, "u", "WARC/1.1\r\n\r\n"), (None, "u", "<p>same</p>"),
] + [(100 + i, "u", "hot") for i in range(60)]
KINDS = "page_id long, url string, html string"


def rows_of(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, KINDS).repartition(3)
    manifest = write_archives(pages, str(tmp_path / "warc"))
    assert sum(r.records for r in manifest.collect()) == len(PAGES)
    for split in (16 << 20, 700):
        read = read_archives(manifest, str(tmp_path / "warc"), split)
        assert rows_of(read) == expected(PAGES)
        payloads = {r.page_id: r.payload.decode() for r in read.filter("record_type = 'response'").collect()}
        assert payloads[4] == "é日本😀" * 1000 and payloads[1] == "" and len(payloads[7]) == 3_000_000


def test_hot_digests_take_the_broadcast(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame(PAGES, KINDS)
    monkeypatch.setattr(warc, "HOT_SHARE", 3)  # only "hot" has more than a third of the rows
    assert rows_of(archive_pages(spark, pages, str(tmp_path / "w"))) == expected(PAGES)


def test_short_payloads_are_all_responses(spark, tmp_path):
    got = rows_of(archive_pages(spark, spark.createDataFrame(PAGES, KINDS), str(tmp_path / "w"), least_bytes=5))
    assert {r[3] for r in got if r[1] < 5} == {"response"} and any(r[3] == "revisit" for r in got)


def test_no_pages(spark, tmp_path):
    assert archive_pages(spark, spark.createDataFrame([], KINDS + ", payload string"), str(tmp_path / "w")).count() == 0


def test_ranges_are_read_by_as_many_tasks(spark, tmp_path):
    """64 ranges are not one task, though their rows are a few bytes."""
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.sha2(F.col("id").cast("string"), 512).alias("html"))
    pages = pages.withColumn("html", F.concat(*(F.sha2(F.concat("html", F.lit(i)), 512) for i in range(20))))
    manifest = write_archives(pages.coalesce(1), str(tmp_path / "w"), 0)
    size = manifest.agg(F.sum("bytes")).first()[0]
    read = read_archives(manifest, str(tmp_path / "w"), split_bytes=-(-size // 64))
    used = read.select(F.spark_partition_id().alias("p")).distinct().count()
    assert read.count() == 400 and used >= 16
