import random
import zlib
from collections import defaultdict

from wardgrid.llm import queries, sharding


def best(sizes, shards):
    low, high = max([*sizes, 0]), sum(sizes)
    while low < high:
        middle, used, room = (low + high) // 2, 1, 0
        room = middle
        for x in sizes:
            if x > room:
                used, room = used + 1, middle
            room -= x
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


def test_capacity_is_the_smallest(spark):
    source = random.Random(2)
    for many, top, resolution in ((300, 50, 8), (300, 5000, 16), (5, 9, 4), (1, 7, 4), (2000, 3, 40)):
        sizes = [source.randint(1, top) for _ in range(many)] + [0]
        rows, end = [], 0
        for x in sizes:
            end += x
            rows.append((x, end))
        frame = spark.createDataFrame(rows, "bytes long, bytes_end long")
        for shards in (1, 7, 40):
            capacity, cuts = sharding.minimax(frame, "bytes_end", "bytes", shards, resolution)
            assert capacity == best(sizes, shards)
            borders = {e for _, e in rows}
            assert set(cuts) <= borders and cuts[-1] == end and len(cuts) <= shards
            assert all(b - a <= capacity for a, b in zip([0, *cuts], cuts, strict=False))
    assert sharding.minimax(spark.createDataFrame([], "bytes long, bytes_end long"), "bytes_end", "bytes", 4) == (0, [])


def test_query(spark, tables):
    source = random.Random(4)
    rows = [(k, f"text {source.randrange(400)} " * source.randint(1, 30)) for k in range(900)]
    rows += [(k, "copied") for k in range(1000, 1600)] + [(3000, None), (3001, None), (3002, ""), (None, "é"), (5007, "again"), (5007, "again")]
    found = queries.op4_sharding(spark, tables(documents=rows)).collect()
    assert len(found) == len(rows)
    slots, shard_of, texts = defaultdict(list), defaultdict(set), {}
    for doc_id, text in rows:
        texts.setdefault(doc_id, text)
    for r in found:
        slots[r.shard].append(r.slot)
        shard_of[texts[r.doc_id]].add(r.shard)
        assert r.size == len((texts[r.doc_id] or "").encode()) + 16
        assert r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode())
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 40
    assert all(len(x) == 1 for x in shard_of.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert queries.op4_sharding(spark, tables()).count() == 0


def test_hot_group_is_numbered_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_TOGETHER", 50)
    rows = spark.createDataFrame([(k, "hot") for k in range(1000)] + [(2000, "x")], "doc_id long, text string")
    found, capacity = sharding.shard(rows, 3)
    assert capacity == 1000 * 19
    assert sorted(r.slot for r in found.collect() if r.size == 19) == list(range(1000))
