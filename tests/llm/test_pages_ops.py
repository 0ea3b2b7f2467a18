"""WARC round trips and the temporal list join."""

import gzip
import hashlib
from collections import Counter
from datetime import date, timedelta

from pyspark.sql import functions as F

from maskwright.llm import url_lists, warc


def test_archives(spark, tmp_path):
    big = "x" * 1500
    pages = [(1, "http://a.org/ü?q=1", big), (2, None, big), (9, "http://c.org\r\nEvil: 1", big), (3, "http://d.org", "small"), (4, "http://e.org", "small"), (5, "u", None), (5, "u", None), (None, "n", big), (7, "http://z.org", "é \x00" * 400), (7, "http://z.org", "é \x00" * 400)]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, payload_digest string").repartition(3)
    got = Counter(tuple(r) for r in warc.round_trip(df, str(tmp_path / "w")).collect())
    want = Counter()
    for i, _, html in pages:
        raw = (html or "").encode()
        keep = max((j for j, _, h in pages if (h or "") == (html or "") and j is not None), default=None)
        visit = len(raw) >= 1000 and i is not None and i != keep
        want[i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if visit else "response", keep if visit else None] += 1
    assert got == want
    records = warc.read_warc(spark, str(tmp_path / "w"))
    assert records.where("record_type = 'revisit'").count() == 2 and records.where("record_id = 'urn:maskwright:page:9'").count() == 1
    assert records.where("target_uri like 'http://c%'").first().payload == big.encode()
    headers = warc.read_warc(spark, str(tmp_path / "w"), payload=False)
    assert headers.where("payload is not null").count() == 0 and headers.count() == len(pages)
    plan = records.where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("PushedFilters", "") or "record_type" in plan
    files = list((tmp_path / "w").glob("*.gz"))
    whole = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert whole.count(b"WARC/1.1\r\n") == len(pages) and b"\r\nEvil" not in whole
    # archives of others: no manifest, no skip lengths, or not compressed at all
    other = tmp_path / "o"
    other.mkdir()
    (other / "a.warc").write_bytes(whole)
    (other / "b.warc.gz").write_bytes(b"".join(gzip.compress(b"WARC/1.1" + part) for part in whole.split(b"WARC/1.1")[1:]))
    assert warc.read_warc(spark, str(other)).groupBy("record_type").count().orderBy("record_type").collect()[0]["count"] == 2 * (len(pages) - 2)
    assert warc.read_warc(spark, str(other)).where("record_type = 'response'").agg(F.sum("payload_bytes")).first()[0] == 2 * records.where("record_type = 'response'").agg(F.sum("payload_bytes")).first()[0]


def test_damaged_records(spark, tmp_path):
    good = warc.record_bytes(1, "http://a.org", "t", "response", None, "00" * 20, 2, b"ok")
    no_length = b"WARC/1.1\r\nWARC-Type: response\r\n\r\nabc\r\n\r\n"
    bare = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:no base 32\r\nContent-Type: application/http\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    broken = bytearray(warc._member(good))
    broken[30:60] = b"\xff" * 30
    (tmp_path / "a.warc.gz").write_bytes(warc._member(good) + bytes(broken) + warc._member(no_length) + warc._member(b"WARC/1.1\r\nno end") + warc._member(bare))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(good) + gzip.compress(good)[:-20])
    (tmp_path / "c.warc").write_bytes(good + b"\r\n" + bare + no_length + good)
    (tmp_path / "d.warc").write_bytes(b"")
    rows = warc.read_warc(spark, str(tmp_path))
    assert {r.record_type: r["count"] for r in rows.groupBy("record_type").count().collect()} == {"response": 5, "damaged": 5}
    assert Counter(r.payload for r in rows.where("record_type = 'response'").collect()) == {b"ok": 3, b"hello": 2}
    assert rows.where("record_type = 'damaged'").count() == 5


def test_large_files_are_split(spark, tmp_path, monkeypatch):
    reader = warc._WarcReader(str(tmp_path / "w"), True)
    monkeypatch.setattr(warc, "SPLIT_BYTES", 1000)
    writer = warc._WarcWriter(str(tmp_path / "w"))
    import pyarrow as pa

    rows = {"page_id": list(range(50)), "url": ["u"] * 50, "fetched": ["t"] * 50, "record_type": ["response"] * 50, "refers_to": [None] * 50, "payload_digest": ["00" * 20] * 50, "payload_bytes": [90] * 50, "payload": [hashlib.sha256(bytes([k])).hexdigest() for k in range(50)]}
    writer.commit([writer.write(iter([pa.RecordBatch.from_pydict(rows)]))])
    parts = reader.partitions()
    assert len(parts) > 5
    ids = [i for p in parts for b in reader.read(p) for i in b.column("record_id").to_pylist()]
    assert ids == [f"urn:maskwright:page:{k}" for k in range(50)]


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


DAY = date(2024, 1, 1)


def brute_filter(captures, entries):
    out = Counter()
    for i, url, day in captures:
        host = url.split("://")[1].split("/")[0].split("@")[-1].split(":")[0].lower() if url and "://" in url else None
        best = None
        if host and day is not None:
            labels = host.split(".")
            for k in range(max(1, len(labels) - 1)):
                key = ".".join(labels[k:])
                past = [(d, a == "add", c) for p, c, a, d in entries if p == key and d <= day]
                if past and max(past)[1]:
                    best = (key, max(past)[2])
                    break
        out[i, host, day, best is not None, best and best[0], best and best[1]] += 1
    return out


def test_lists_as_of_the_fetch(spark):
    import random

    rnd = random.Random(8)
    hosts = ["a.b.org", "b.org", "c.b.org", "x.com", "localhost", "deep.er.x.com"]
    entries = [(rnd.choice(hosts), "one", rnd.choice(["add", "add", "remove"]), DAY + timedelta(rnd.randrange(30))) for _ in range(40)]
    captures = [(k, f"http://user@{rnd.choice(hosts).upper()}:80/p?x", DAY + timedelta(rnd.randrange(40))) for k in range(300)]
    captures += [(900, None, DAY), (901, "no url", DAY), (902, "http://a.b.org/", None), (0, captures[0][1], captures[0][2])]
    frame = spark.createDataFrame([(*c, "clash", "clash") for c in captures], "page_id long, url string, fetched date, host string, pattern string")
    lists = spark.createDataFrame(entries, "pattern string, category string, action string, day date")
    assert Counter(tuple(r) for r in url_lists.filter_captures(frame, lists).collect()) == brute_filter(captures, entries)
    assert url_lists.filter_captures(frame, lists.limit(0)).where("blocked").count() == 0
    assert url_lists.filter_captures(frame.limit(0), lists).count() == 0


def test_addresses_and_null_ids(spark):
    captures = [(None, "http://a.b.org/", DAY), (None, "http://ok.org/", DAY), (1, "http://10.2.3.4/x", DAY), (2, "http://[2001:DB8::1]:8080/x", DAY), (3, "http://9.3.4/", DAY)]
    lists = [(p, "c", "add", DAY) for p in ("b.org", "3.4", "[2001:db8::1]")]
    frame = spark.createDataFrame(captures, "page_id long, url string, fetched date")
    got = {(r.page_id, r.host): r.pattern for r in url_lists.filter_captures(frame, spark.createDataFrame(lists, "pattern string, category string, action string, day date")).collect()}
    assert got == {(None, "a.b.org"): "b.org", (None, "ok.org"): None, (1, "10.2.3.4"): None, (2, "[2001:db8::1]"): "[2001:db8::1]", (3, "9.3.4"): "3.4"}
