import base64
import hashlib
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from igarape.llm.warc import DICTIONARY_FRAME, archive, payload_digest, read_archives, records_of, write_archives


def pages():
    random.seed(1)
    bodies = ["", "<p>é</p>", "x" * 3_000_000, "<html>" + "text " * 200, "a\r\n\r\nb\r\nContent-Length: 3\r\n\r\n"]
    rows = [(i, f"http://h/{i}", random.choice(bodies), "x") for i in range(60)]
    rows += [(None, "http://null", bodies[1], "x"), (None, None, "only without id", "x"), (61, None, None, "x")]
    rows += [(62, "u\nv", "twice", "x"), (62, "u\nv", "twice", "x"), (99, "w", "twice", "x")]
    return rows


def expected(rows, least=0):
    low = {}
    for i, _, html, _ in rows:
        if i is not None:
            low[html or ""] = min(low.get(html or "", i), i)
    for i, _, html, _ in rows:
        data = (html or "").encode()
        first = low.get(html or "")
        again = len(data) >= least and first is not None and first != i
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        yield i, len(data), digest, "revisit" if again else "response", first if again else None


@pytest.mark.parametrize(("least", "archive_bytes"), [(0, 1 << 20), (100, 2000)])
def test_round_trip(spark, tmp_path, least, archive_bytes):
    rows = pages()
    table = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    path = f"file://{tmp_path}/archives"
    write_archives(table, path, least_bytes=least, archive_bytes=archive_bytes)
    found = read_archives(spark, path, with_payload=True).collect()
    got = [tuple(r)[:1] + tuple(r)[2:6] for r in found]
    assert sorted(map(str, got)) == sorted(map(str, expected(rows, least)))
    texts = {r["id"]: bytes(r["payload"]).decode() for r in found if r["record_type"] == "response" and r["id"] is not None}
    assert all(texts[i] == (html or "") for i, _, html, _ in rows if i in texts)
    assert {r["url"] for r in found if r["id"] == 62} == {"u%0Av"}


def test_files_are_archives_that_plain_zstandard_reads(spark, tmp_path):
    table = spark.createDataFrame([(i, "u", f"page {i} " * 50) for i in range(200)], "page_id long, url string, html string")
    write_archives(table.repartition(2), f"file://{tmp_path}/a", archive_bytes=20_000)
    files = sorted((tmp_path / "a").glob("part-*"))
    assert len(files) > 4
    for file in files:
        data = file.read_bytes()
        assert int.from_bytes(data[:4], "little") == DICTIONARY_FRAME
        size = int.from_bytes(data[4:8], "little")
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
        whole = reader.stream_reader(data, read_across_frames=True).read()
        assert whole.startswith(b"WARC/1.1\r\n") and whole.count(b"WARC/1.1\r\n") == len(list(records_of(data)))


def test_dictionary_helps_and_damage_shows():
    records = [f"<html><body class='page'><nav>menu</nav><p>number {i}</p></body></html>".encode() * 3 for i in range(400)]
    data = archive(records) + b"\n"
    assert list(records_of(data)) == records
    alone = sum(len(zstandard.compress(x)) for x in records)
    assert len(data) < 0.7 * alone
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(records_of(data[:-60]))
    assert list(records_of(archive([b"one"]) + b"\n")) == [b"one"]
    assert payload_digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"


def test_a_payload_that_most_pages_share(spark, tmp_path):
    same = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.lit("same").alias("html"))
    write_archives(same, f"file://{tmp_path}/a")
    found = read_archives(spark, f"file://{tmp_path}/a")
    assert found.count() == 3000 and found.filter("refers_to = 0").count() == 2999


def test_empty_table(spark, tmp_path):
    write_archives(spark.createDataFrame([], "page_id long, url string, html string"), f"file://{tmp_path}/a")
    assert read_archives(spark, f"file://{tmp_path}/a").count() == 0
