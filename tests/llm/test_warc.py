import base64
import gzip
import hashlib
from pathlib import Path

import pytest
from helpers_llm import FOLDER, ordered
from rosterlane.llm import warc


@pytest.fixture
def pages(spark):
    plain = spark.read.parquet(str(FOLDER / "pages.parquet"))
    rows = [
        (100_000, None, None),
        (100_001, "http://a.b/c d", "x"),
        (100_001, "http://a.b/c d", "x"),
        (100_002, "https://a.b/c d", "x"),
        (100_003, "http://[bad", "é\r\n\r\nz"),
        (100_004, "", ""),
        (None, "u\nv", "x"),
        (None, "u", "alone"),
        (-5, "u", "dd" * 100_000),
    ]
    odd = spark.createDataFrame(rows, "page_id long, url string, html string")
    copies = plain.selectExpr("page_id + 200000 as page_id", "'http://one.example/' as url", "html")
    hot = spark.range(300_000, 300_300).selectExpr("id as page_id", "'http://hot.example/' as url", "'hot' as html")
    return plain.unionByName(odd).unionByName(copies.limit(20)).unionByName(hot)


def brute(rows, min_bytes):
    largest = {}
    for r in rows:
        body = (r["html"] or "").encode()
        if r["page_id"] is not None and len(body) >= min_bytes:
            largest[body] = max(largest.get(body, r["page_id"]), r["page_id"])
    out = []
    for r in rows:
        body = (r["html"] or "").encode()
        best = largest.get(body)
        refers = best if best is not None and best != r["page_id"] and len(body) >= min_bytes else None
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((r["page_id"], len(body), digest, "response" if refers is None else "revisit", refers))
    return ordered(out)


@pytest.mark.parametrize("min_bytes", [0, 3])
def test_round_trip(pages, tmp_path, min_bytes):
    rows = pages.collect()
    found = warc.archived(pages, str(tmp_path), min_bytes)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    back = found.collect()
    assert ordered(tuple(r[n] for n in names) for r in back) == brute(rows, min_bytes)
    payloads = {(r["page_id"], r["html"] or "") for r in rows}
    for r in back:
        if r["record_type"] == "response":
            assert (r["page_id"], bytes(r["payload"]).decode()) in payloads


def test_archives_are_whole_files(pages, tmp_path):
    warc.archived(pages, str(tmp_path)).count()
    records = 0
    for path in Path(tmp_path, "archives").iterdir():
        data = gzip.decompress(path.read_bytes())
        assert data.startswith(b"WARC/1.0\r\nWARC-Type: warcinfo") and data.endswith(b"\r\n\r\n")
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            size = int(head.rpartition(b"Content-Length: ")[2])
            assert rest[size : size + 4] == b"\r\n\r\n"
            records += b"WARC-Type: warcinfo" not in head
            data = rest[size + 4 :]
    assert records == pages.count()


def test_index_finds_what_it_holds(spark, tmp_path):
    rows = [(i % 40, f"http://h{i % 7}.example/p{i % 11}", "x") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = warc.qualified(spark, str(tmp_path))
    captures = warc.write_archives(pages.selectExpr("page_id", "url", "html as payload", "'d' as digest", "cast(null as long) as refers_to"), f"{folder}/a")
    index = warc.write_index(captures, f"{folder}/i", block_lines=3)
    files = sorted((r["first"], r["last"], r["file"]) for r in index.collect())
    lookup = warc.Index(f"{folder}/i", files)
    places = {}
    for r in captures.collect():
        places.setdefault(r["key"], set()).add((r["file"], r["offset"], r["length"]))
    for key, want in places.items():
        assert set(lookup.find(key)) == want
    for key in ("", "zzz", "example,h0)/p0", "example,h3)/p9 99999999999999999999"):
        assert list(lookup.find(key)) == []


def test_look_ups_go_through_the_index_in_its_order(spark, tmp_path, monkeypatch):
    """Every block is read once by a task, whatever order the pages come in."""
    rows = [(i, f"{'https' if i % 2 else 'http'}://h{i * 7 % 50}.example{i % 3}.org/p{i}", "x") for i in range(600)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    folder = warc.qualified(spark, str(tmp_path))
    captures = warc.write_archives(pages.selectExpr("page_id", "url", "html as payload", "'d' as digest", "cast(null as long) as refers_to"), f"{folder}/a")
    index = warc.write_index(captures, f"{folder}/i", block_lines=10)
    assert warc.find_captures(captures, index, f"{folder}/i").count() == 600
    lookup = warc.Index(f"{folder}/i", sorted((r["first"], r["last"], r["file"]) for r in index.collect()))
    blocks = []
    for key in sorted(warc.reversed_key(u, i) for i, u, _ in rows):
        assert len(list(lookup.find(key))) == 1
        blocks.append((lookup.name, lookup.block))
    assert len(set(blocks)) == 1 + sum(a != b for a, b in zip(blocks, blocks[1:]))


def test_keys_sort_hosts_together():
    keys = [warc.reversed_key(u, 1) for u in ("http://b.a.com/x", "https://a.com/", "http://A.com:8080/", "http://c.org")]
    assert [k.split(" ")[0] for k in keys] == ["com,a,b)/x", "com,a)/", "com,a:8080)/", "org,c)/"]
    assert warc.reversed_key("u", -2) < warc.reversed_key("u", -1) < warc.reversed_key("u", 3)


def test_urls_without_host(spark, tmp_path):
    urls = ["a\tb", "a%09b", "a%2509b", "mailto:x\ty@z", "\t/p\tq\t", "http://a.b:99999/\tx", "http://[a\tb", "a b", "a\r\n\tb"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("page_id", "url", "concat('p', page_id) as html")
    found = warc.archived(pages, str(tmp_path)).collect()
    assert sorted(bytes(r["payload"]).decode() for r in found) == [f"p{i}" for i in range(len(urls))]
    keys = [warc.reversed_key(u, 1) for u in urls if u.strip() == u]
    assert len(set(keys)) == len(keys) and not any("\t" in k for k in keys)


def test_lost_record_is_an_error(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://a.b/{i}", "x") for i in range(9)], "page_id long, url string, html string")
    find = warc.find_captures
    monkeypatch.setattr(warc, "find_captures", lambda wanted, *rest: find(wanted.where("page_id <> 4"), *rest))
    with pytest.raises(ValueError, match="9 records archived, but 8 found"):
        warc.archived(pages, str(tmp_path))


def test_empty_table(pages, tmp_path):
    assert warc.archived(pages.where("page_id = -99"), str(tmp_path)).count() == 0
