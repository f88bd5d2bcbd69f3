import base64
import hashlib

from pyspark.sql import functions as F

from lendspark.llm.common import scratch_dir, ship
from lendspark.llm.op2_warc import (
    PLACE, lookup, parse, plan_records, read_records, record, url_key, write_archives, write_index,
)
from tests_llm_helpers import crowd


def test_url_key():
    assert url_key("http://WWW.Example.com:80/a/b?x=1#f") == "com,example)/a/b?x=1"
    assert url_key("https://m.shop.example.org:8443") == "org,example,shop,m:8443)/"
    assert url_key("not a url") == "not a url" and url_key("http://[bad") == "http://[bad" and url_key("") == ""


def brute(rows):
    largest = {}
    for i, _, h in rows:
        key = (h or "").encode()
        if i is not None and (largest.get(key) is None or i > largest[key]):
            largest[key] = i
    count = {}
    for _, _, h in rows:
        count[(h or "").encode()] = count.get((h or "").encode(), 0) + 1
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        to = largest.get(p)
        again = count[p] > 1 and to is not None and i != to
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a.example.com/x", "same"), (9, "http://b.example.com/y", "same"), (4, None, "same"), (2, "http://a.example.com/x", None),
    (3, "", ""), (7, "http://c.example.com/ü\t\n", "ünïcode \r\n\r\n text"), (7, "http://c.example.com/ü\t\n", "ünïcode \r\n\r\n text"),
    (None, "http://d.example.com/", "same"), (None, None, "alone"), (11, "http://e.example.com/", "big " * 500_000),
]


def chain(spark, df, block_lines=3):
    folder = scratch_dir(spark, "warc-test")
    captures = write_archives(plan_records(df), folder)
    index = write_index(captures, folder, block_lines)
    return captures, index, lookup(captures, index, folder), folder


def test_archives_equal_brute_force(spark):
    df = crowd(spark.createDataFrame(ROWS, "page_id long, url string, html string")).repartition(3)
    captures, _, places, folder = ship(lambda s: chain(s, df))(spark)
    assert sorted(places.collect(), key=repr) == sorted(captures.select("key", "file", "offset", "length").collect(), key=repr)
    got = read_records(places, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(ROWS)


def test_lookup_of_few_and_unknown_keys(spark):
    rows = [(i, f"http://h{i % 7}.example.com/p{i}", f"page {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    captures, index, _, folder = ship(lambda s: chain(s, df, 10))(spark)
    some = captures.where(F.col("page_id") % 50 == 0).select("key")
    asked = some.union(some).union(spark.createDataFrame([("zz,none)/ x",), ("",)], "key string"))
    found = read_records(lookup(asked, index, folder), folder)
    assert sorted(r["page_id"] for r in found.collect()) == list(range(0, 300, 50))


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    _, index, places, folder = ship(lambda s: chain(s, df))(spark)
    assert index.count() == 0 and places.count() == 0
    assert read_records(spark.createDataFrame([], PLACE), folder).count() == 0


def test_smaller_payloads_are_never_revisits(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    got = {r["page_id"]: r["revisit"] for r in plan_records(df, revisit_bytes=3).collect()}
    assert got == {1: False, 2: False, 3: True, 4: False}


def test_a_damaged_payload_is_found():
    import gzip

    import pytest

    row = {"page_id": 1, "n": 0, "url": "u", "payload": b"abc", "sha1": hashlib.sha1(b"abc").hexdigest(), "revisit": False, "resp": None}
    member = record(row)
    assert parse(member)["payload_bytes"] == 3
    with pytest.raises(ValueError):
        parse(gzip.compress(gzip.decompress(member).replace(b"\r\n\r\nabc", b"\r\n\r\nabd")))
