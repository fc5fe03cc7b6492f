import gzip
import hashlib

import pytest

from slotline.llm import warc
from slotline.llm.common import new_path

PAGES = "page_id long, url string, html string, digest string, first string, path string"


def html(seed, size):
    return "".join(chr(0x61 + (seed * 31 + i * i) % 26) if i % 7 else "é\n" for i in range(size))


@pytest.fixture
def pages():
    same = html(9, 400)
    rows = [(i, f"http://a.example/{i}", html(i, 50 + 97 * i)) for i in range(40)]
    rows += [(i, "u\r\nX: y", same) for i in (77, 50, 60)] + [(90, None, None), (91, "x", ""), (92, "x", "short"), (93, "x", "short")]
    return rows + [(None, "n", same), (50, "again", same), (94, "x", html(1, 200_000))]


def expected(rows):
    first = {}
    for page_id, _, text in rows:
        if len((text or "").encode()) >= 100 and page_id is not None:
            first[text] = min(first.get(text, page_id), page_id)
    out = []
    for page_id, _, text in rows:
        body, to = (text or "").encode(), first.get(text)
        to = None if to is None or to == page_id else to
        out.append((page_id, len(body), hashlib.sha256(body).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def written(spark, rows, **how):
    frame = spark.createDataFrame([(*r, None, None, None) for r in rows], PAGES).repartition(3)
    return warc.write(warc.with_kinds(frame), new_path(spark, "warc"), **how)


@pytest.mark.parametrize("range_bytes", [1 << 23, 5000, 777])
def test_records_come_back_whatever_the_ranges(spark, pages, range_bytes):
    files = written(spark, pages, file_bytes=4000)
    found = warc.read(spark, files, range_bytes).collect()
    keys = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[k] for k in keys) for r in found), key=str) == expected(pages)
    texts = {(r["page_id"], r["payload"].decode()) for r in found if r["payload"] is not None}
    assert texts <= {(i, t or "") for i, _, t in pages}
    assert files.count() > 1


def test_files_are_gzip_members_that_others_can_read(spark, pages):
    for row in written(spark, pages).collect():
        with gzip.open(row["path"].removeprefix("file:")) as file:
            content = file.read()
        assert content.count(b"WARC/1.1\r\n") == row["records"]


def test_a_magic_inside_a_payload_starts_no_member(spark, tmp_path):
    """Stored, not deflated, payloads: the magic and even a gzip header stand in the file."""
    import zlib

    fake = gzip.compress(b"no record at all")
    body = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nWARC-Payload-Digest: sha256:%s\r\nContent-Length: %d\r\n\r\n"
    path, data = tmp_path / "x.warc.gz", b""
    for i in range(5):
        payload = (b"\x1f\x8b\x08" + fake) * 20
        block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
        content = body % (i, hashlib.sha256(payload).hexdigest().encode(), len(block)) + block + b"\r\n\r\n"
        pack = zlib.compressobj(0, zlib.DEFLATED, 31)
        data += pack.compress(content) + pack.flush()
    path.write_bytes(data)
    files = spark.createDataFrame([(str(path), len(data), 5)], warc.FILES)
    assert sorted(r["page_id"] for r in warc.read(spark, files, 100).collect()) == list(range(5))


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("range_bytes", [1 << 23, 5000])
def test_long_urls_are_read(spark, range_bytes):
    """Headers longer than what is inflated at once, well and badly compressed."""
    noise = "".join(hashlib.sha256(b"%d" % i).hexdigest() for i in range(2000))
    urls = ["http://a/", "http://b/?q=" + "x" * 20_000, "http://c/?q=" + noise[:20_000], "http://d/?q=" + noise, "http://e/"]
    rows = [(i, url, html(i, 300)) for i, url in enumerate(urls)]
    found = warc.read(spark, written(spark, rows), range_bytes).collect()
    assert {(r["page_id"], r["url"]) for r in found} == set(enumerate(urls)) and len(found) == len(urls)


def test_records_that_are_missing_end_the_run(spark, pages):
    files = written(spark, pages)
    found = warc.read(spark, files, payloads=False)
    assert warc.counted(found, files).count() == len(pages)
    with pytest.raises(ValueError, match="written"):
        warc.counted(found.filter("page_id <> 5"), files)
    path = files.first()["path"].removeprefix("file:")
    with open(path, "ab") as file:
        file.write(b"no record")
    with pytest.raises(ValueError, match="is no record"):
        list(warc.records_in(path, 0, (size := __import__("os").path.getsize(path)), size))


def test_ranges_are_read_by_many_tasks(spark, monkeypatch):
    """A range is a tiny row; adaptive execution must not merge them into one task."""
    pages = spark.range(200).selectExpr("id AS page_id", "concat('http://h.example/', id) AS url", "repeat(sha2(string(id), 512), 40) AS html")
    files = warc.write(warc.with_kinds(pages), warc.new_path(spark, "warc"))
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    found = warc.read(spark, files, payloads=False)
    assert found.rdd.getNumPartitions() > 1 and found.count() == 200
