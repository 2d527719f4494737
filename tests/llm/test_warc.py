import hashlib
import random

import pytest

from backlog.llm import warc as W

BIG = "<p>" + "x" * 200


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def want(rows):
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if i is not None and len(data) >= 100:
            first[data] = min(first.get(data, i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        to = first.get(data)
        revisit = to is not None and to != i
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


ROWS = [
    (5, "http://b.example/x", BIG), (3, "http://a.example/", BIG), (9, "http://a.example/", BIG), (3, "http://a.example/", BIG),
    (7, None, None), (8, "", ""), (10, "http://x\r\nWARC-Type: evil", "short"), (11, "http://y/ü?b=2&a=1", "short"), (None, "http://n", BIG), (None, None, "\r\n\r\nWARC/1.1\r\n\r\n" * 9),
    (12, "http://c", "é🙂\r\n\r\n" * 40), (13, "http://[bad", "Content-Length: 5\r\n\r\n" + "y" * 100), (10**17, "http://far", "z" * 120),
]


@pytest.mark.parametrize("settings", [W.Settings(), W.Settings(records=2, slice_rows=3)])
def test_round_trip(spark, with_clashes, settings):
    index = W.archived(with_clashes(pages(spark, ROWS)), settings)
    rows = index.collect()
    assert got(index) == want(ROWS)
    lines = [W.order_of(tuple(r)) for r in sorted(rows, key=lambda r: r.position)]
    assert lines == sorted(lines) and sorted(r.position for r in rows) == list(range(len(ROWS)))


def test_hot_payload_and_url(spark):
    rows = [(k, "http://hot.example/", BIG if k % 3 else f"{BIG}{k}") for k in range(400)]
    index = W.archived(pages(spark, rows), W.Settings(records=50, slice_rows=40))
    assert got(index) == want(rows)
    assert [r.page_id for r in sorted(index.collect(), key=lambda r: r.position)] == list(range(400))


def test_archives_are_read_by_the_format(spark, tmp_path):
    W.write(pages(spark, ROWS), str(tmp_path / "w"))
    records = [r for f in (tmp_path / "w").glob("*.gz") for r in W.parsed(W.unpacked(f.read_bytes()))]
    assert len(records) == len(ROWS)
    for headers, block in records:
        assert int(headers["content-length"]) == len(block) and block.startswith(b"HTTP/1.1 200 OK\r\n")
        if headers["warc-type"] == "revisit":
            assert block.endswith(b"\r\n\r\n") and headers["warc-profile"] == W.REVISIT_PROFILE


@pytest.mark.parametrize("seed", range(20))
def test_loser_tree(seed):
    rnd = random.Random(seed)
    runs = [sorted(((f"u{rnd.randint(0, 3)}", str(rnd.randint(0, 3)), rnd.choice([None, 1, 2])) for _ in range(rnd.randint(0, 9))), key=W.order_of) for _ in range(rnd.randint(0, 9))]
    assert list(W.LoserTree([iter(r) for r in runs])) == sorted((x for r in runs for x in r), key=W.order_of)


def test_url_keys():
    assert W.url_key("HTTPS://www.Example.com:443/A?b=2&a=1#f") == "com,example)/a?a=1&b=2"
    assert W.url_key("http://u@m.example.org:8080") == "org,example,m:8080)/" and W.url_key(None) == ""


def test_damage_is_noticed():
    headers = {"warc-type": "response", "warc-payload-digest": "sha256:00", "warc-payload-length": "1", "warc-record-id": "<urn:page:1>", "warc-date": ""}
    with pytest.raises(ValueError):
        W.index_line(headers, b"HTTP/1.1 200 OK\r\n\r\nx")


def test_empty_table(spark):
    assert W.archived(pages(spark, [])).count() == 0
