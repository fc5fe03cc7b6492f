"""WARC archives of pages: a writer, and a reader that splits files anywhere.

Writing: each page becomes a record, a gzip member of its own. Of pages with equal payloads of
``LEAST_BYTES`` or more, the one with the smallest page_id is a response and the others are revisits
that refer to it and carry no payload. Which they are is settled over narrow rows (id, digest), so
that copies never meet in one task with their payloads. A task writes files of up to ``FILE_BYTES`` under
names of its own and returns them as rows; only files of successful tasks are listed, so that a repeated
task leaves nothing in the archive. The number of records read from a file must be the number written to it.

Reading: a file is dealt out in byte ranges. A task looks for the gzip magic from its range's
start, inflates the front of each candidate and takes it for a member if it begins with a WARC header that
can be decoded; from there members must follow one another to the file's end. It owns the records that start in its range,
and reads on over the range's end to finish the last.

A null html is an empty payload. Rows that repeat a page_id with an equal payload are all responses if
theirs is the smallest id; a null page_id comes after all others and is read back as null. Texts of
any length are one record. An empty table makes no file and reads as no rows. Only ``page_id``, ``url`` and
``html`` are read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotline.llm.common import new_path, small_batches, staged

LEAST_BYTES = 100
FILE_BYTES = 64 << 20
RANGE_BYTES = 8 << 20
READ_BYTES = 1 << 20
FRONT_BYTES = 1 << 16
MAGIC = b"\x1f\x8b\x08"
WARC = b"WARC/1."
_PAGE_URI = "urn:page:"
FILES = "path string, bytes long, records long"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "payload binary, member_start long, path string"
)


def with_kinds(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, html, digest and ``first``: for a revisit, the page_id of its response."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html"), 256))
    large = rows.filter(F.octet_length("html") >= least_bytes).select("page_id", "digest")
    firsts = staged(
        large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1").select("digest", "first"),
        "payload-firsts",
    )
    # Narrow rows: the planner splits a digest that is very common.
    revisits = (
        large.join(firsts, "digest").filter(~F.equal_null("page_id", "first"))
        .select(F.col("page_id").alias("own_id"), F.col("digest").alias("own_digest"), "first").distinct()
    )
    return rows.join(
        revisits, F.equal_null("page_id", "own_id") & (F.col("digest") == F.col("own_digest")), "left"
    ).select("page_id", "url", "html", "digest", "first")


def _uri(page_id) -> str:
    return f"<{_PAGE_URI}{'' if page_id is None else page_id}>"


def member(page_id: int | None, url: str | None, html: str, digest: str, first: int | None, date: str) -> bytes:
    """The gzip member of a page's record."""
    payload = html.encode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {_uri(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url:
        # A header is one line.
        lines.append("WARC-Target-URI: " + "".join("%%%02X" % ord(c) if ord(c) < 32 else c for c in url))
    if first is None:
        block += payload
    else:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_uri(first)}",
        ]
    lines.append(f"Content-Length: {len(block)}")
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def write(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES, date: str = "2025-01-01T00:00:00Z") -> DataFrame:
    """Write the rows of ``with_kinds`` to files under a folder, and return the stored list of files."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, name, size, records, done = None, "", 0, 0, []
        for batch in batches:
            # Numbers with nulls travel as text, as pandas has no null integers.
            for page_id, url, html, digest, first in batch.itertuples(index=False):
                if out is None:
                    name, size, records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                packed = member(
                    None if page_id is None else int(page_id), url, html, digest, None if first is None else int(first), date
                )
                out.write(packed)
                size, records = size + len(packed), records + 1
                if size >= file_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", size, records))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", size, records))
        yield pd.DataFrame(done, columns=["path", "bytes", "records"])

    small_batches(rows.sparkSession, 500)
    text = rows.select(F.col("page_id").cast("string"), "url", "html", "digest", F.col("first").cast("string"))
    return staged(text.mapInPandas(pack, FILES), "warc-files")


class Members:
    """The members of a gzip file from a place on, one after the other."""

    def __init__(self, stream, size: int, start: int):
        self.stream, self.size = stream, size
        self.base, self.held = start, b""

    def at(self, place: int, count: int) -> bytes:
        """Up to so many bytes from a place at or behind the last one asked for."""
        if place > self.base:
            skip = min(place - self.base, len(self.held))
            self.held, self.base = self.held[skip:], self.base + skip
            if place > self.base:
                self.held, self.base = b"", place
        while len(self.held) < count and self.base + len(self.held) < self.size:
            self.stream.seek(self.base + len(self.held))
            piece = self.stream.read(max(READ_BYTES, count - len(self.held)))
            if not piece:
                raise ValueError(f"the file ends before its {self.size} bytes")
            self.held += piece
        return self.held[:count]

    def candidate(self, place: int, stop: int) -> int | None:
        """The next place before ``stop`` where a member with a WARC header starts."""
        while place < stop:
            piece = self.at(place, READ_BYTES)
            found = piece.find(MAGIC)
            if found < 0:
                if len(piece) < len(MAGIC):
                    return None
                place += len(piece) - len(MAGIC) + 1
                continue
            place += found
            if place >= stop:
                return None
            if self.begins(place):
                return place
            place += 1
        return None

    def begins(self, place: int) -> bool:
        """Whether the bytes there inflate to a WARC record's header, of whatever length."""
        unpack, text, fed = zlib.decompressobj(31), b"", 0
        while b"\r\n\r\n" not in text:
            # What was read stays held from the place on, as the member is read from there.
            piece = unpack.unconsumed_tail or self.at(place, fed + FRONT_BYTES)[fed:]
            if unpack.eof or not piece or not (fed or piece.startswith(MAGIC)):
                return False
            fed += 0 if unpack.unconsumed_tail else len(piece)
            try:
                text += unpack.decompress(piece, max(1 << 13, len(text)))
            except zlib.error:
                return False
            if not text.startswith(WARC) and not WARC.startswith(text):
                return False
        head = text[: text.index(b"\r\n\r\n") + 2]
        return text.startswith(WARC) and b"\r\nContent-Length:" in head and b"\r\nWARC-Type:" in head

    def member(self, place: int) -> tuple[bytes, int]:
        """The member's content and where it ends; checked against its CRC."""
        unpack, parts, at = zlib.decompressobj(31), [], place
        while not unpack.eof:
            piece = self.at(at, READ_BYTES)
            if not piece:
                raise ValueError(f"a member that starts at {place} is cut off")
            parts.append(unpack.decompress(piece))
            at += len(piece) - len(unpack.unused_data)
        return b"".join(parts), at


def record(content: bytes) -> dict:
    """Headers and block of a record's bytes, and the payload of its HTTP block."""
    head, _, rest = content.partition(b"\r\n\r\n")
    headers = {}
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(":")
        headers[name.strip().lower()] = value.strip()
    block = rest[: int(headers["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    number = lambda uri: int(uri[1:-1].removeprefix(_PAGE_URI)) if uri and uri[1:-1] != _PAGE_URI else None
    response = headers["warc-type"] == "response"
    digest = hashlib.sha256(payload).hexdigest() if response else headers["warc-payload-digest"].removeprefix("sha256:")
    if headers["warc-payload-digest"] != f"sha256:{digest}":
        raise ValueError(f"the payload of {headers['warc-record-id']} doesn't have its digest")
    return {
        "page_id": number(headers["warc-record-id"]),
        "url": headers.get("warc-target-uri"),
        "record_type": headers["warc-type"],
        "refers_to": number(headers.get("warc-refers-to")),
        "payload_bytes": len(payload) if response else int(told[0]),
        "payload_digest": digest,
        "payload": payload if response else None,
    }


def records_in(path: str, start: int, stop: int, size: int) -> Iterator[dict]:
    """The records of a file that start in a byte range."""
    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_file(name) as stream:
        members = Members(stream, size, start)
        place = members.candidate(start, stop)
        if start == 0 and place != 0:
            raise ValueError(f"{path} doesn't begin with a record")
        while place is not None and place < stop:
            content, end = members.member(place)
            yield record(content) | {"member_start": place, "path": path}
            # The next member follows, in this range or a later one: no record is passed over.
            if end < size and not members.begins(end):
                raise ValueError(f"what follows the record at {place} of {path} is no record")
            place = end


def read(spark: SparkSession, files: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """The records of the listed files (path, bytes), a row each; ``RECORDS`` names the columns."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
    ranges = files.filter("bytes > 0").select("path", "bytes", starts.alias("start"))
    columns = [x.split()[0] for x in RECORDS.split(", ")]

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, size, start in batch[["path", "bytes", "start"]].itertuples(index=False):
                held, weight = [], 0
                for found in records_in(path, start, min(start + range_bytes, size), size):
                    if not payloads:
                        found["payload"] = None
                    held.append(found)
                    weight += len(found["payload"] or b"") + 500
                    if weight > 8 << 20:
                        yield frame(held)
                        held, weight = [], 0
                yield frame(held)

    def frame(held: list[dict]) -> pd.DataFrame:
        out = pd.DataFrame(held, columns=columns)
        for name in ("page_id", "refers_to"):
            out[name] = pd.array(out[name].tolist(), dtype="Int64")
        return out

    small_batches(spark, 500)
    # A range is a tiny row and a lot of work. A stated number of tasks is kept; without one adaptive
    # execution would merge the rows, by their size, into one task.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = ranges.repartition(tasks, F.xxhash64("path", "start"))
    return dealt.mapInPandas(unpack, RECORDS)


def counted(found: DataFrame, files: DataFrame) -> DataFrame:
    """The records read, if they are as many from each listed file (path, records) as were written to it."""
    held = found.groupBy("path").agg(F.count(F.lit(1)).alias("held"))
    wrong = files.join(held, "path", "left").filter(F.coalesce("held", F.lit(0)) != F.col("records"))
    for row in wrong.limit(1).collect():
        raise ValueError(f"{row['held'] or 0} records were read from {row['path']}, {row['records']} written")
    return found


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive the pages in the shared folder, and read the archives back."""
    spark = pages.sparkSession
    files = write(with_kinds(pages), new_path(spark, "warc"))
    return counted(staged(read(spark, files, payloads=False), "warc-records"), files)
