"""WARC archives: writing records from rows, and reading them back as a chunked record table.

Writing is a text write whose line separator is the record separator, so the files are WARC/1.1, each
compressed as a whole (offsets are those of the plain bytes), and Spark's own committer makes retried
tasks safe. Of records with equal payloads the one with the
smallest key is the response, the others are revisits that name it.

Reading streams each archive in small reads and makes a row for each chunk: record identifier, chunk
number, bytes. The payload's size and SHA-1 are carried along from chunk to chunk and are there with
the last one. No record is held whole, neither as a value nor in a batch.

Defined results: a null payload counts as empty. Every row is written; rows that repeat the response's
key and payload are responses as well. Rows without a key are responses if no row with a key has their
payload. White space and control characters in a URL are written as %20; it has any length. An empty table gives archives
without records.
"""

from __future__ import annotations

import hashlib
import re
from base64 import b32encode
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

END = "\r\n\r\n"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
SAME = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payload bytes of a chunk, bytes of one read, and records of a file.
CHUNK, READ, FILE_RECORDS = 1 << 20, 1 << 16, 20_000
#: A header block longer than this, its target's line apart, is not a header.
HEADER = 1 << 20
TARGET = re.compile(rb"\r\nwarc-target-uri:", re.IGNORECASE)

CHUNKS = (
    "archive string, offset bigint, record_id string, record_type string, url string, refers_to string, "
    "chunk_no int, data binary, last boolean, payload_bytes bigint, payload_digest string"
)


def base32(hexadecimal: Column) -> Column:
    """Base32 of 20 bytes given as hexadecimal digits: five digits are four letters."""
    letters = []
    for k in range(8):
        bits = F.conv(F.substring(hexadecimal, 5 * k + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(ALPHABET), F.shiftright(bits, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def roles(df: DataFrame, key: str, payload: str, least: int) -> DataFrame:
    """Add ``digest``, ``size`` and ``first``: the key of the response with this payload, null if the row is one itself."""
    known = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = df.withColumns({"digest": base32(F.sha1(known)), "size": F.octet_length(known).cast("bigint")})
    large = rows.where(F.col("size") >= least)
    # Only payloads that come more than once are joined; counts are combined before the shuffle.
    per_payload = large.groupBy("digest", "size").agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias("_least"))
    again = per_payload.where(F.col("_n") > 1).select("digest", "size", "_least")
    joined = rows.join(again, ["digest", "size"], "left")
    return joined.withColumn("first", F.when(~F.col(key).eqNullSafe(F.col("_least")), F.col("_least"))).drop("_least")


def record(key: Column, url: Column, payload: Column, digest: Column, size: Column, first: Column, date: str) -> Column:
    """The bytes of one record, without the separator that ends it."""
    safe = F.regexp_replace(F.coalesce(url, F.lit("")), "[\\x00-\\x20\\x7f]", "%20")
    revisit = first.isNotNull()
    body = F.when(revisit, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), F.coalesce(payload, F.lit(""))))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(key.cast("string"), F.lit("none")), F.lit(">")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), safe),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), digest),
        F.concat(F.lit("X-Payload-Length: "), size.cast("string")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), first.cast("string"), F.lit(">"))),
        F.when(revisit, F.lit(f"WARC-Profile: {SAME}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), body)


def write(
    df: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    compression: str = "gzip",
) -> None:
    """Write a record for each row to archives below ``path``; payloads under ``least`` bytes are never revisits.

    ``compression`` is that of the text writer; ``none`` gives plain files.
    """
    rows = df.select(F.col(key).alias("k"), F.col(url).alias("u"), F.col(payload).alias("p"))
    placed = roles(rows, "k", "p", least)
    text = record(F.col("k"), F.col("u"), F.col("p"), F.col("digest"), F.col("size"), F.col("first"), date)
    out = placed.select(text.alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", FILE_RECORDS)
    out.text(path, compression=compression)


class Stream:
    """Reads lines and counted bytes from a file in reads of bounded size."""

    def __init__(self, file: BinaryIO):
        self.file, self.held, self.at = file, bytearray(), 0

    def _more(self) -> bool:
        got = self.file.read(READ)
        self.held += got
        return bool(got)

    def header(self) -> list[str] | None:
        """Lines up to an empty one; none at the end of the file. The target's line has any length."""
        seen, target, stop = 0, -1, -1
        while (end := self.held.find(b"\r\n\r\n", seen)) < 0:
            if len(self.held) > HEADER:
                if target < 0 and (found := TARGET.search(self.held, 0, HEADER)):
                    target = found.start()
                if target >= 0 and stop < 0:
                    stop = self.held.find(b"\r\n", max(seen, target + 2))
                long = 0 if target < 0 else (len(self.held) if stop < 0 else stop) - target
                if len(self.held) - long > HEADER:
                    raise ValueError(f"no header at byte {self.at}")
            seen = max(0, len(self.held) - 3)
            if not self._more():
                if self.held.strip():
                    raise ValueError(f"the archive ends inside a header at byte {self.at}")
                return None
        lines = self.held[:end].decode("utf-8", "replace").split("\r\n")
        self._drop(end + 4)
        return lines

    def _drop(self, n: int) -> None:
        del self.held[:n]
        self.at += n

    def part(self, n: int) -> bytes:
        """At most ``n`` bytes, at least one."""
        if not self.held and not self._more():
            raise ValueError(f"the archive ends inside a record at byte {self.at}")
        out = bytes(self.held[:n])
        self._drop(len(out))
        return out

    def skip(self, text: bytes) -> None:
        while len(self.held) < len(text) and self._more():
            pass
        if not self.held.startswith(text):
            raise ValueError(f"no record separator at byte {self.at}")
        self._drop(len(text))


def _identifier(text: str) -> str:
    return re.sub(r"^<urn:page:|>$", "", text)


def chunks(archive: str, file: BinaryIO, size: int, with_data: bool) -> Iterator[tuple]:
    """The chunk rows of one archive."""
    stream = Stream(file)
    while True:
        offset = stream.at
        lines = stream.header()
        if lines is None:
            return
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"{archive}: no record at byte {offset}")
        fields = {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:])}
        left = int(fields["content-length"])
        kind = fields.get("warc-type", "")
        named = (archive, offset, _identifier(fields.get("warc-record-id", "")), kind, fields.get("warc-target-uri"))
        refers = _identifier(fields["warc-refers-to"]) if "warc-refers-to" in fields else None
        if fields.get("content-type", "").startswith("application/http"):
            before = stream.at
            stream.header()
            left -= stream.at - before
        sha, total, number = hashlib.sha1(), 0, 0
        while True:
            data, want = [], min(left, size)
            while want:
                got = stream.part(want)
                sha.update(got)
                data.append(got)
                want, left, total = want - len(got), left - len(got), total + len(got)
            last = left == 0
            digest = b32encode(sha.digest()).decode() if last else None
            given = fields.get("warc-payload-digest", "").removeprefix("sha1:")
            bytes_ = total
            if last and kind == "revisit":
                digest, bytes_ = given, int(fields.get("x-payload-length", total))
            elif last and given and given != digest:
                raise ValueError(f"{archive}: payload digest differs in the record at byte {offset}")
            yield (*named, refers, number, b"".join(data) if with_data else None, last, bytes_, digest)
            number += 1
            if last:
                break
        stream.skip(END.encode())


def read(spark: SparkSession, path: str, size: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunk table of all archives below ``path``; ``with_data=False`` leaves the bytes out."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path")
    schema = CHUNKS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for uri in batch.column("path").to_pylist():
                store, name = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))
                with store.open_input_stream(name, compression="detect") as file:
                    rows, held = [], 0
                    for row in chunks(uri, file, size, with_data):
                        rows.append(row)
                        held += len(row[7] or b"") + len(row[4] or "") + 200
                        if held >= 4 * CHUNK:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

    n = max(1, spark.sparkContext.defaultParallelism)
    return files.repartition(4 * n).mapInArrow(run, schema)


_TYPES = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.binary(), pa.bool_(), pa.int64(), pa.string())
_NAMES = [f.split(" ")[0] for f in CHUNKS.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)


def records(table: DataFrame) -> DataFrame:
    """One row a record: what its last chunk carries."""
    return table.where("last").select("archive", "offset", "record_id", "record_type", "url", "refers_to", "payload_bytes", "payload_digest")
