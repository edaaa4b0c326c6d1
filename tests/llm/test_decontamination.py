import hashlib
import random
import re

from wardgrid.llm import decontamination, queries


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(text, items):
    w, hit, named = words(text), set(), set()
    for item, other in items:
        x = words(other)
        if item is None or not x:
            continue
        n = min(13, len(x))
        for window in (tuple(x[k : k + n]) for k in range(len(x) - n + 1)):
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) == window:
                    hit |= set(range(s, s + n))
                    named.add(str(item))
    joined = ",".join(sorted(named)).encode()
    return len(w), len(hit), len(named), hashlib.sha256(joined).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def test_against_brute_force(spark, tables, monkeypatch):
    source = random.Random(8)
    vocabulary = [f"w{k}" for k in range(60)] + ["É", "É", "x"]
    prose = lambda n: " ".join(source.choice(vocabulary) for _ in range(n))
    items = [(k, prose(source.choice([1, 2, 5, 12, 13, 14, 30]))) for k in range(30)] + [(100, None), (101, " .!"), (None, prose(3)), (9, prose(20)), (102, "a a a a a a a a a a a a a")]
    texts = [prose(source.randint(0, 80)) for _ in range(60)]
    texts += [f"{prose(300)} {source.choice(items)[1]}, {prose(4)}" for _ in range(40)] + [None, "", " -- ", "A-a " * 40, prose(30000), items[4][1].upper()]
    rows = [(k, x) for k, x in enumerate(texts)] + [(0, texts[0]), (None, texts[3]), (5, texts[7])]
    path = tables(documents=rows, benchmark=items)
    expected = sorted((d if d is not None else -1, *brute(x, items)) for d, x in rows)
    key = lambda r: (r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
    assert sorted(map(key, queries.op6_decontamination(spark, path).collect())) == expected
    monkeypatch.setattr(decontamination, "PART_BYTES", 20000)
    assert sorted(map(key, queries.op6_decontamination(spark, path).collect())) == expected


def test_empty_tables_and_other_columns(spark, tables):
    assert queries.op6_decontamination(spark, tables()).count() == 0
    docs = spark.createDataFrame([(1, "a b", 9, "x")], "doc_id long, text string, n_hit int, token string")
    items = spark.createDataFrame([], "item_id long, text string")
    row = decontamination.decide(docs, items).first()
    assert (row.n_hit, row.n_items, row.token, row.contaminated) == (0, 0, "x", False)
