import gzip
import hashlib

import pytest

from qloom.llm import archives as q
from qloom.llm.shared import open_out, shared_folder


def write(folder, data, name="x.arc.gz", members=None):
    path, out = open_out(f"file://{folder}", name)
    with out:
        out.write(members if members is not None else gzip.compress(data))
    return path


OLD = (
    b"filedesc://old.arc 0.0.0.0 19970102030405 text/plain 78\n"
    b"1 0 Someone\nURL IP-address Archive-date Content-type Archive-length\n\n\n\n\n\n\n"
)


@pytest.mark.parametrize("version", [1, 2])
def test_records_of_both_versions(tmp_path, version):
    block = b"HTTP/1.0 200 OK\r\nX: 1\r\n\r\n<p>\n\r\n\nhttp://fake 1 2 3 4\n"
    data = q.arc_version_block("a", "19960101000000", version)
    data += q.arc_record("http://a/ b c", "20010203040506", "text/html", block, version, "a", len(data))
    data += q.arc_record("dns:a", "2001", "text/dns", b"", version, "a", len(data))
    found = list(q.read_arc(write(tmp_path, data)))
    assert [f["URL"] for _, f, _ in found] == ["filedesc://a", "http://a/ b c", "dns:a"]
    assert [b for _, _, b in found][1:] == [block, b""]
    assert len(found[1][1]) == (5 if version == 1 else 10)


def test_spare_newlines_and_pieces(tmp_path):
    body = OLD.split(b"\n", 1)[1]
    head = b"filedesc://old.arc 0.0.0.0 19970102030405 text/plain %d\n" % len(body.rstrip(b"\n") + b"\n")
    data = head + body + q.arc_record("http://x/", "19970102030405", "text/html", b"z" * 3_000_000, 1, "", 0)
    members = b"".join(gzip.compress(data[k : k + 100_000]) for k in range(0, len(data), 100_000))
    found = list(q.read_arc(write(tmp_path, b"", members=members)))
    assert [len(b) for _, _, b in found][1:] == [3_000_000]


@pytest.mark.parametrize("change", [lambda d: d[:-40], lambda d: d.replace(b"\n2 0 ", b"\n3 0 "), lambda d: d.replace(b"http://x/ ", b"")])
def test_damaged_files_are_noticed(tmp_path, change):
    data = q.arc_version_block("a", "19960101000000", 2) + q.arc_record("http://x/", "1997", "text/html", b"y" * 100, 2, "a", 1)
    with pytest.raises(ValueError):
        list(q.read_arc(write(tmp_path, change(data))))


def test_conversion_of_one_record():
    block = b"HTTP/1.0 200 OK\r\nX: 1\r\n\r\npayload"
    fields = {"URL": "http://x/", "IP-address": "1.2.3.4", "Archive-date": "19970102", "Content-type": "text/html"}
    text = q.converted("n", 9, fields, block, None).decode()
    assert "WARC-Type: response" in text and "WARC-Date: 1997-01-02T00:00:00Z" in text and "WARC-IP-Address: 1.2.3.4" in text
    assert f"WARC-Payload-Digest: sha256:{hashlib.sha256(b'payload').hexdigest()}" in text
    assert f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}" in text
    assert text.split("\r\n")[2] == f"WARC-Record-ID: {q.record_id('n', 9, 'http://x/')}"
    again = q.converted("n", 9, fields, block, {"id": "<urn:uuid:1>", "url": "http://y/", "date": "d"}).decode()
    assert "WARC-Type: revisit" in again and "payload" not in again.split("\r\n\r\n", 1)[1] and "WARC-Refers-To: <urn:uuid:1>" in again
    assert "WARC-Type: resource" in q.converted("n", 9, {**fields, "URL": "dns:x"}, b"1.2.3.4", None).decode()
    assert "WARC-Type: warcinfo" in q.converted("n", 0, fields, block, None).decode()


BIG = "<html>" + "wörd " * 50


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, key string, name string, path string")


def run(spark, frame, **settings):
    folder = shared_folder(spark, "archives")
    arc = q.write_arc(frame, f"{folder}/arc", **settings)
    return q.resolved(q.convert(arc, f"{folder}/warc")), arc


def test_odd_rows(spark):
    rows = [
        (5, "http://a b/\nc", BIG, None, "n", "p"),
        (3, None, BIG, "k", None, "p"),
        (9, "", BIG, "k", "n", None),
        (9, "http://x", BIG, "k", "n", None),
        (1, "http://x", None, None, None, None),
        (2, "http://x", "", None, None, None),
        (4, "http://x", "short", None, None, None),
        (6, "http://x", "short", None, None, None),
        (None, "http://x", BIG, None, None, None),
        ((1 << 60) + 1, "http://x", "é\r\n\r\nWARC/1.0\r\n" * 9000, None, None, None),
        (-7, "http://x", "x" * 99, None, None, None),
        (-6, "http://x", "x" * 99, None, None, None),
        (11, "http://x", "x" * 100, None, None, None),
        (12, "http://x", "x" * 100, None, None, None),
    ]
    out, arc = run(spark, pages(spark, rows), file_records=2)
    assert arc.count() > 4
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out.collect()), key=repr)
    want = []
    for i, _, html, *_ in rows:
        data = (html or "").encode()
        same = [j for j, _, h, *_ in rows if h == html and j is not None]
        again = len(data) >= 100 and i != min(same)
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", min(same) if again else None))
    assert got == sorted(want, key=repr)


def test_empty_table(spark):
    out, arc = run(spark, pages(spark, []))
    assert arc.count() == 0 and out.count() == 0


def test_damaged_places_are_passed_over_and_listed(spark, tmp_path):
    good = lambda k: q.arc_record(f"http://x/{k}", "19970102000000", "text/html", b"HTTP/1.0 200 OK\r\n\r\n" + bytes([97 + k]) * 150, 1, "a", 1)
    head = q.arc_version_block("a", "19960101000000", 1)
    whole = head + good(0) + b"torn header line\n<p>some html</p>\n\n" + good(1) + good(2)
    paths = {"torn": whole, "cut": (head + good(0) + good(1))[:-60], "odd": head.replace(b"\n1 0 ", b"\n7 0 ") + good(0), "fine": head + good(0)}
    files = []
    for name, data in paths.items():
        folder = tmp_path / name
        folder.mkdir()
        files.append((f"{name}.arc.gz", write(folder, data)))
    frame = spark.createDataFrame([(n, p, 0) for n, p in files], "name string, path string, n_records long")
    found = {(r["name"], r["reason"][:14]) for r in q.damage(frame).collect()}
    assert found == {("torn.arc.gz", "no header line"), ("cut.arc.gz", "a record is cu"), ("odd.arc.gz", "ARC version 7 ")}
    indexed = {}
    for r in q.index_arc(frame).collect():
        indexed.setdefault(r["name"], []).append(r["url"])
    assert {k: sorted(v) for k, v in indexed.items()} == {
        "torn.arc.gz": ["http://x/0", "http://x/1", "http://x/2"], "cut.arc.gz": ["http://x/0"], "fine.arc.gz": ["http://x/0"]
    }


def test_a_piece_that_unpacks_to_very_much(tmp_path):
    data = q.arc_version_block("a", "19960101000000", 1) + q.arc_record("http://x/", "1997", "text/html", b"y" * 60_000_000, 1, "a", 1)
    path = write(tmp_path, data)
    source = q.Unpacked(path, 1 << 16)
    assert source._fill() and len(source.buffer) <= 16 << 16
    source.close()
    assert [len(b) for _, _, b in q.read_arc(path)][1:] == [60_000_000]
