import hashlib

from wardgrid.llm import queries, warc


def test_round_trip(spark, tables):
    long = "é" * 700
    inner = "x" * 50 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + "y" * 20
    pages = [(1, "http://a", long), (5, "http://b", long), (3, "http://c\r\nX: 1", long), (7, None, "short"), (8, "http://d", "short"), (9, "http://e", None), (10, "http://f", ""), (11, "http://g", inner), (12, "http://h", "a b\r\n" * 40000)]
    pages += [(13, "u", "z" * 1000), (13, "u", "z" * 1000), (2, "v", "z" * 1000), (None, "w", "z" * 1000), (14, "q", "z" * 999), (15, "q", "z" * 999)]
    found = queries.op5_warc(spark, tables(pages=pages)).collect()
    assert sorted((r.page_id or -1, r.payload_digest) for r in found) == sorted((p or -1, hashlib.sha1((h or "").encode()).hexdigest()) for p, _, h in pages)
    kinds = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in found}
    assert kinds[1] == ("revisit", 5, 1400) and kinds[3] == ("revisit", 5, 1400) and kinds[5] == ("response", None, 1400)
    assert kinds[2] == ("revisit", 13, 1000) and kinds[None] == ("revisit", 13, 1000) and kinds[13][0] == "response"
    assert all(kinds[k][0] == "response" for k in (7, 8, 9, 10, 11, 12, 14, 15))
    assert all(r.metadata_id for r in found)
    assert queries.op5_warc(spark, tables()).count() == 0


def test_payloads_come_back(spark, tables):
    pages = spark.createDataFrame([(1, "u", "<p>\r\n\r\n</p> é"), (2, "v", None)], "page_id long, url string, html string")
    records = warc.read(spark, warc.archive(pages))
    assert {(r.page_id, bytes(r.payload).decode()) for r in warc.assemble(records).collect()} == {(1, "<p>\r\n\r\n</p> é"), (2, "")}
    assert sorted(r.record_type for r in records.collect()) == ["metadata"] * 2 + ["request"] * 2 + ["response"] * 2


def test_broken_bytes_and_members():
    import gzip

    one = b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    content = gzip.compress(one) + gzip.compress(b"WARC/1.1\r\nWARC-Type: metadata\r\n\r\n junk" + one)
    assert [r[8] for r in warc.parsed(warc._unpacked(content))] == [b"ab", b"ab"]
    assert list(warc.parsed(b"")) == []
