"""WARC archives: format, verification, revisits and odd rows."""

import gzip
import hashlib
import io

import pytest

from dossierlake.llm import warc

LONG = "<p>" + "é" * 600 + "</p>"


def pages(spark, rows):
    return spark.createDataFrame(
        [(*r, "?", "?") for r in rows], "page_id bigint, url string, html string, digest string, stored string"
    ).repartition(3)


def test_round_trip(spark):
    rows = [
        (1, "http://a/", LONG), (2, "http://b/\r\nX: y", LONG), (3, None, LONG), (4, "u", None), (5, "u", ""),
        (6, "u", "short"), (7, "u", "short"), (8, "u", "y" * 3_000_000), (None, "u", LONG), (3, "u", LONG),
        (9, "u", "z" * 999), (10, "u", "z" * 999), (11, "u", "z" * 1000), (12, "u", "z" * 1000),
    ]
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        top = max(same) if len(data) >= 1000 and same else page
        again = page != top
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response",
                     top if again else None))
    got = [tuple(r) for r in warc.warc_round_trip(pages(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert warc.warc_round_trip(pages(spark, [])).count() == 0


def archive():
    parts = []
    for i, data in enumerate((b"", b"abc\r\n\r\nabc", b"x" * 2_500_000)):
        parts.append(warc.record(i, "http://x/", data, hashlib.sha1(data).hexdigest(), None, False))
    sha = hashlib.sha1(b"abc").hexdigest()
    parts.append(warc.record(9, "http://x/", b"abc", sha, 1, True))
    return parts


def test_members_are_plain_gzip_and_read_in_sequence(monkeypatch):
    parts = archive()
    text = gzip.decompress(b"".join(parts))
    assert text.count(b"WARC/1.1\r\n") == 4
    for chunk in (7, 1000, 1 << 20):
        monkeypatch.setattr(warc, "CHUNK", chunk if chunk > 7 else 64)
        rows = list(warc.read_archive(io.BytesIO(b"".join(parts)), with_payload=True))
        assert [r["page_id"] for r in rows] == [0, 1, 2, 9]
        assert [r["payload"] for r in rows] == [b"", b"abc\r\n\r\nabc", b"x" * 2_500_000, None]
        assert rows[3]["record_type"] == "revisit" and rows[3]["refers_to"] == 1
        assert rows[3]["payload_bytes"] == 3


def test_damage_is_noticed():
    whole = b"".join(archive())
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(whole[:-20])))
    data = b"hello"
    wrong = warc.record(1, "u", data, hashlib.sha1(b"other").hexdigest(), None, False)
    with pytest.raises(ValueError, match="payload's digest"):
        list(warc.read_archive(io.BytesIO(wrong)))
    good = gzip.decompress(warc.record(1, "u", data, hashlib.sha1(data).hexdigest(), None, False))
    for bad in (good.replace(b"hello", b"hellO"), good.replace(b"hello", b"hello!"), good.replace(b"hello", b"hell")):
        with pytest.raises(ValueError):
            list(warc.read_archive(io.BytesIO(gzip.compress(bad))))


def test_a_url_of_several_megabytes(spark):
    rows = [(1, "http://a.net/" + "x" * 3_000_000, "<p>long</p>"), (2, "http://a.net/", "<p>short</p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r.page_id: (r.payload_bytes, r.record_type) for r in warc.warc_round_trip(pages).collect()}
    assert found == {1: (11, "response"), 2: (12, "response")}
