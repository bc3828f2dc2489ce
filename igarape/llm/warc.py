"""WARC archives with a Zstandard dictionary in front.

An archive is a skippable frame that holds a dictionary, then one Zstandard frame per record. The
dictionary is built from all records of the archive, so nothing is gathered beyond one archive.
Archives are closed at about `archive_bytes` of records, which bounds a task's memory by that and
the largest record. They are files in a folder of any file system that Spark writes to: a row of
Spark's text sink is an archive, and the line end that the sink adds is the content of a last
skippable frame. Tasks that are repeated after a loss go through the sink's commit.

Of records with equal payloads, those with the smallest id are responses and the others revisits
of it; payloads below `least_bytes` are always responses. Equal digests are counted in two steps
by (digest, salt) before pages are joined, so a payload shared by a third of all pages is spread
over `salts` keys. Null payloads are empty. Null urls have no target line. Rows with a null id are
written without id and revisit a row that has one, if there is one; repeated rows, with equal id
and payload, are alike.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Frame numbers of the Zstandard and WARC formats.
DICTIONARY_FRAME = 0x184D2A5D
PADDING_FRAME = 0x184D2A50

_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(key: int | None, url: str | None, payload: bytes, first: int | None, date: str) -> bytes:
    """One record; `first` is the id of the response that it revisits, or None."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if first is None:
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}"]
    if key is not None:
        head.append(f"WARC-Record-ID: <urn:page:{key}>")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if first is not None:
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <urn:page:{first}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _frame(number: int, content: bytes) -> bytes:
    return number.to_bytes(4, "little") + len(content).to_bytes(4, "little") + content


def archive(records: list[bytes], dictionary_bytes: int = 1 << 15, level: int = 3) -> bytes:
    """Bytes of an archive, up to the line end that the text sink adds.

    The dictionary has at most `dictionary_bytes`, and a twentieth of the records' size.
    """
    size = min(dictionary_bytes, max(1024, sum(map(len, records)) // 20))
    try:
        words = zstandard.train_dictionary(size, records, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # too few records to build one: their beginning serves as raw content
        words = b"".join(x[:size] for x in records)[:size]
    trained = zstandard.ZstdCompressionDict(words)
    press = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True)
    parts = [_frame(DICTIONARY_FRAME, words), *[press.compress(x) for x in records]]
    parts.append(PADDING_FRAME.to_bytes(4, "little") + (1).to_bytes(4, "little"))
    return b"".join(parts)


def records_of(data: bytes, chunk: int = 1 << 16) -> Iterator[bytes]:
    """The records of an archive, one at a time."""
    view, at, words = memoryview(data), 0, None
    while at < len(view):
        number = int.from_bytes(view[at : at + 4], "little")
        if PADDING_FRAME <= number < PADDING_FRAME + 16:
            size = int.from_bytes(view[at + 4 : at + 8], "little")
            if number == DICTIONARY_FRAME:
                words = zstandard.ZstdCompressionDict(bytes(view[at + 8 : at + 8 + size]))
                reader = zstandard.ZstdDecompressor(dict_data=words)
            at += 8 + size
            continue
        if words is None:
            reader = zstandard.ZstdDecompressor()
        frame, parts = reader.decompressobj(), []
        while not frame.eof:
            if at >= len(view):
                raise ValueError("the archive ends within a record")
            piece = view[at : at + chunk]
            parts.append(frame.decompress(piece))
            at += len(piece) - len(frame.unused_data)
        yield b"".join(parts)


def parse(data: bytes) -> tuple:
    """(id, url, payload bytes, digest, type, id of the response, payload) of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length:"))
    number = lambda name: int(fields[name][10:-1]) if name in fields else None
    kind = fields["WARC-Type"]
    return (
        number("WARC-Record-ID"),
        fields.get("WARC-Target-URI"),
        length,
        fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        kind,
        number("WARC-Refers-To"),
        payload if kind == "response" else None,
    )


def with_originals(
    pages: DataFrame, page_id: str, url: str, html: str, least_bytes: int = 0, salts: int = 32
) -> DataFrame:
    """(id, url, payload, first): `first` is the response's id for revisits, else null."""
    payload = F.coalesce(F.col(html).cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(page_id).cast("long").alias("id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload"))).withColumn(
        "salt", F.pmod(F.xxhash64("id", "url"), F.lit(salts)).cast("int")
    )
    parts = rows.groupBy("digest", "salt").agg(F.min("id").alias("low"))
    least = parts.groupBy("digest").agg(F.min("low").alias("low"), F.collect_set("salt").alias("salts"))
    spread = least.select("digest", "low", F.explode("salts").alias("salt"))
    first = F.when(
        (F.octet_length("payload") >= least_bytes) & F.col("low").isNotNull() & ~F.col("id").eqNullSafe(F.col("low")),
        F.col("low"),
    )
    return rows.join(spread, ["digest", "salt"]).select("id", "url", "payload", first.alias("first"))


def write_archives(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 0,
    archive_bytes: int = 8 << 20,
    date: str = "2000-01-01T00:00:00Z",
) -> None:
    """Write a record per row into archives below `path`. `date` is every record's date."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for key, target, first, payload in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                held.append(record(key, target, payload.as_py(), first, date))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([archive(held)], pa.binary())], ["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([archive(held)], pa.binary())], ["value"])

    rows = with_originals(pages, page_id, url, html, least_bytes).select("id", "url", "first", "payload")
    found = rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    found.write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """(id, url, payload_bytes, payload_digest, record_type, refers_to[, payload]) of all records below `path`."""
    names = ["id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    width = 7 if with_payload else 6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for data in records_of(content.as_py()):
                    found = parse(data)
                    if found[4] == "response" and payload_digest(found[6]) != found[3]:
                        raise ValueError(f"digest of record {found[0]} does not fit its payload")
                    rows.append(found[:width])
                if rows:
                    columns = [pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)]
                    yield pa.RecordBatch.from_arrays(columns, names[:width])

    schema = "id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, schema + (", payload binary" if with_payload else ""))
