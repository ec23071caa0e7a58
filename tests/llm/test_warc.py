import gzip
import hashlib
import random

import pytest

from tickloom.llm import warc
from tickloom.session import work_folder


@pytest.fixture(scope="module")
def pages(spark):
    rng, rows = random.Random(4), []
    for i in range(400):
        size = rng.choice([0, 20, 99, 100, 101, 400])
        html = chr(97 + rng.randrange(3)) * size
        rows.append((i, f"https://www{rng.randrange(2)}.s{rng.randrange(3)}.example.com/p{rng.randrange(4)}?x=é", html))
    rows += [(400, "http://hot.example/", "r\r\n\r\nWARC/1.1\r\n" * 30), (401, None, None), (402, "", ""),
             (None, "http://x.example/", "p" * 200), (5, rows[5][1], rows[5][2])]
    return rows


def expected(pages):
    first = {}
    for page, _, html in pages:
        data = (html or "").encode()
        if len(data) >= 100 and page is not None:
            first[data] = min(page, first.get(data, page))
    out = []
    for page, _, html in pages:
        data = (html or "").encode()
        to = first.get(data)
        to = to if to is not None and page is not None and to < page else None
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "response" if to is None else "revisit", to))
    return out


def order(rows):
    return sorted(rows, key=repr)


def test_written_and_read_back(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3000)
    monkeypatch.setattr(warc, "RANGE_LINES", 50)
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(6)
    rows = warc.capture_history(df).collect()
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert order([tuple(r[c] for c in names) for r in rows]) == order(expected(pages))
    rows.sort(key=lambda r: r["position"])
    assert [r["position"] for r in rows] == list(range(len(rows)))
    keys = [(r["url_key"], r["captured_at"]) for r in rows]
    assert keys == sorted(keys)
    last, n = None, 0
    for r in rows:
        n = n + 1 if r["url_key"] == last else 1
        last = r["url_key"]
        assert r["capture"] == n


def test_archives_are_gzip_members_sorted_by_run(spark, pages):
    folder = f"{work_folder(spark)}/warc"
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    index = warc.write_archives(df, folder)
    lines = index.collect()
    for name in {r["archive"] for r in lines}:
        own = [r for r in lines if r["archive"] == name]
        assert [(r["url_key"], r["captured_at"]) for r in own] == sorted((r["url_key"], r["captured_at"]) for r in own)
        files, base = warc._files(folder)
        with files.open_input_file(f"{base}/{name}") as source:
            whole = gzip.decompress(source.read())
            assert whole.count(b"WARC-Record-ID: ") == len(own)
            for r in own:
                source.seek(r["offset"])
                fields, _ = warc.parse(gzip.decompress(source.read(r["length"])))
                assert fields["WARC-Type"] == r["record_type"]


def test_loser_tree_merges():
    rng = random.Random(6)
    for k in (0, 1, 2, 3, 7, 20):
        runs = [sorted((rng.randrange(50), i, j) for j in range(rng.randrange(0, 9))) for i in range(k)]
        merged = list(warc.LoserTree(runs, lambda x: x))
        assert merged == sorted(x for r in runs for x in r)


@pytest.mark.parametrize("url, key", [
    ("http://www.A.example.com:80/X?b#frag", "com,example,a)/x?b"), ("https://u@b.example:8080", "example,b:8080)/"),
    (None, ")/"), ("b.example?q=1", "example,b)/?q=1")])
def test_url_key(url, key):
    assert warc.url_key(url) == key


def test_damage_is_found():
    good = warc.record({"WARC-Type": "response"}, b"abc")
    assert warc.parse(good)[1] == b"abc"
    for bad in (good[:-1], b"x" + good, good.replace(b"abc", b"ab")):
        with pytest.raises(ValueError):
            warc.parse(bad)


def test_no_pages(spark):
    assert warc.capture_history(spark.createDataFrame([], "page_id long, url string, html string, archive string")).collect() == []
