import base64
import glob
import hashlib
import io
import os
import random
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from riverbend.llm import warc

SCHEMA = "page_id long, url string, html string"


def b32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def some_pages(n, seed=1):
    rng = random.Random(seed)
    words = [f"<p class='c{i % 7}'>word{i} é</p>\n" for i in range(300)]
    return [(i, f"http://a.test/{i}", f"<html><h1>{seed} {i}</h1>" + "".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(n)]


def write(spark, rows, folder, **options):
    return warc.archive(spark.createDataFrame(rows, SCHEMA).repartition(2), folder, options=options)


def test_hard_pages(spark, scratch):
    rows = [(5, "u5", "same"), (3, None, "same"), (9, "u9\r\nX: y", "same"), (1, "ü", None), (2, "u2", ""), (2, "u2", ""),
            (None, "n", "same"), (None, "n", "none has an id"), (None, "m", "none has an id"), (-4, "u", "\x00\r\n\r\n"),
            (7, "u7", "é" * 2_000_000), (8, "u8", "WARC/1.1\r\nContent-Length: 5\r\n\r\n")]
    pages = spark.createDataFrame(rows, SCHEMA)
    for name in ("payload", "row", "sha1", "record_id", "n", "first"):
        pages = pages.withColumn(name, F.lit("x"))
    got = warc.records(spark, warc.archive(pages, f"{scratch}/w")).collect()
    assert len(got) == len(rows)
    whole = sorted((str(r["page_id"]), str(r["url"]), r["payload_bytes"], r["payload_digest"]) for r in got)
    assert whole == sorted((str(i), str(u).replace("\r\n", "%0D%0A").replace(" ", "%20"), len((h or "").encode()), b32(h))
                           for i, u, h in rows)
    groups = {}
    for r in got:
        groups.setdefault(r["payload_digest"], []).append(r)
    texts = {b32(h): (h or "").encode() for _, _, h in rows}
    for digest, members in groups.items():
        first = [m for m in members if m["record_type"] == "response"]
        ids = [m["page_id"] for m in members if m["page_id"] is not None]
        assert len(first) == 1 and bytes(first[0]["payload"]) == texts[digest] and first[0]["refers_to"] is None
        assert first[0]["page_id"] == (min(ids) if ids else None)
        assert all(m["refers_to"] == first[0]["page_id"] and m["payload"] is None for m in members if m is not first[0])


def test_small_payloads_and_empty_table(spark, scratch):
    rows = [(1, "a", "abc"), (2, "b", "abc"), (3, "c", "abcd"), (4, "d", "abcd")]
    pages = spark.createDataFrame(rows, SCHEMA)
    got = warc.records(spark, warc.archive(pages, f"{scratch}/w", min_bytes=4)).collect()
    assert {r["page_id"]: r["refers_to"] for r in got} == {1: None, 2: None, 3: None, 4: 3}
    empty = warc.archive(spark.createDataFrame([], SCHEMA), f"{scratch}/e")
    assert warc.records(spark, empty).collect() == []


def test_archives_have_a_dictionary_and_single_records(spark, scratch):
    rows = some_pages(400)
    folder = write(spark, rows, f"{scratch}/w", archiveBytes=60_000, trainBytes=20_000, date="2024-05-06T07:08:09Z")
    files = glob.glob(f"{folder}/*.warc.zst")
    assert len(files) >= 8
    found = 0
    for name in files:
        data = open(name, "rb").read()
        magic, size = struct.unpack("<II", data[:8])
        assert magic == 0x184D2A5D
        trained = zstandard.ZstdDecompressor().decompress(data[8:8 + size])
        assert trained[:4] == b"\x37\xa4\x30\xec"  # a Zstandard dictionary
        opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained))
        rest = data[8 + size:]
        while rest:  # each frame alone is one whole record
            one = opener.decompressobj()
            text = one.decompress(rest)
            rest = one.unused_data
            assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and text.endswith(b"\r\n\r\n")
            assert b"WARC-Date: 2024-05-06T07:08:09Z\r\n" in text and text.count(b"WARC/1.1") == 1
            found += 1
    assert found == len(rows)
    got = warc.records(spark, folder).collect()
    assert {(r["page_id"], r["url"], bytes(r["payload"]).decode()) for r in got} == set(rows)


def test_dictionary_pays():
    records = [warc.record(dict(record_id="x", record_type="response", target_uri=u, refers_to=None, payload_digest="A",
                                payload_bytes=len(h.encode()), payload=h.encode()), "d") for _, u, h in some_pages(300)]
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    class Held(io.BytesIO):
        def close(self):
            self.size = len(self.getvalue())
    out = Held()
    archive = warc.Archive(out)
    for r in records:
        archive.add(r)
    archive.close()
    assert out.size < 0.8 * plain
    assert warc.dictionary([b""]) is None and warc.dictionary([]) is None


def test_only_listed_archives_count(spark, scratch):
    folder = write(spark, some_pages(20), f"{scratch}/w")
    stray = f"{folder}/left-by-a-lost-task.warc.zst"
    open(stray, "wb").write(b"half a record")
    assert warc.records(spark, folder).count() == 20
    write(spark, some_pages(5, seed=2), folder)  # a second write adds
    assert warc.records(spark, folder).count() == 25


def test_damage_is_noticed(spark, scratch):
    folder = write(spark, some_pages(20), f"{scratch}/w")
    name = max(glob.glob(f"{folder}/*.warc.zst"), key=os.path.getsize)
    data = open(name, "rb").read()
    for bad in (data[:-9], data[: len(data) // 2] + bytes([data[len(data) // 2] ^ 255]) + data[len(data) // 2 + 1:]):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            rows = list(warc.read_archive(io.BytesIO(bad)))
            assert len(rows) == 20
    changed = io.BytesIO(zstandard.ZstdCompressor().compress(warc.record(
        dict(record_id="x", record_type="response", target_uri="u", refers_to=None, payload_digest=b32("other"),
             payload_bytes=4, payload=b"text"), "d")))
    with pytest.raises(ValueError, match="differs"):
        list(warc.read_archive(changed))
