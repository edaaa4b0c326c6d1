import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from wardgrid.llm import common, pitmanyor, queries


def words(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").split() + ["</s>"]


def held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 == 2


def corpus(n):
    source = random.Random(6)
    common = [f"c{k}" for k in range(30)]
    rows = []
    for k in range(n):
        text, last = [], 0
        for _ in range(source.randint(1, 80)):
            last = (last * 7 + source.randint(0, 2)) % 30  # words depend on those before
            text.append(common[last] if source.random() < 0.8 else f"r{int(source.paretovariate(0.7))}")
        rows.append((k, " ".join(text)))
    return rows


def test_counts_base_and_held_out_gain(spark, tables):
    rows = corpus(400) + [(1000, None), (1001, ""), (None, "C1 c2"), (5, "again again"), (1002, "c1 " * 30000)]
    found = queries.op8_language_model(spark, tables(documents=rows)).collect()
    seen = Counter(w for d, x in rows if not held_out(d) for w in words(x))
    total, kinds = sum(seen.values()), len(seen)
    expected = sorted(
        (-1 if d is None else d, held_out(d), len(words(x)), sum(seen[w] > 0 for w in words(x)), total, round(sum(math.log10((seen[w] + 1) / (total + kinds + 1)) for w in words(x)), 5)) for d, x in rows
    )
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found) == expected
    unseen = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 1000]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen) and all(r.score < 0 for r in found)


def test_probabilities_sum_to_one(spark):
    source = random.Random(2)
    counts = Counter((source.randrange(50), source.randrange(pitmanyor.CLASSES + 1)) for _ in range(3000))
    model, shared = pitmanyor.train(spark.createDataFrame([(w, c, n) for (w, c), n in counts.items()], "word long, class int, n long"))
    kinds = spark.range(pitmanyor.CLASSES + 1).select(F.col("id").cast("int").alias("class"))
    asked = spark.createDataFrame([(w,) for w in [*range(50), 999]], "word long").crossJoin(kinds).select(F.lit(0).alias("block"), F.col("class").alias("pair"), "word", "class")
    sums = pitmanyor.answers(asked, model, shared).groupBy("pair").agg(F.sum("p").alias("p")).collect()
    assert len(sums) == pitmanyor.CLASSES + 1 and all(abs(r.p - 1) < 1e-9 for r in sums)


def test_nothing_learned(spark, tables):
    assert queries.op8_language_model(spark, tables()).count() == 0
    lone = [r for r in queries.op8_language_model(spark, tables(documents=[(None, "a b")])).collect()]
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in lone] == [(3, 0, 0, 0.0, 0.0)]


def test_seating():
    source = np.random.default_rng(1)
    customers = np.array([0, 1, 2, 50, 100000])
    tables = pitmanyor.seated(customers, np.full(5, 2.0), 0.8, source)
    assert tables[0] == 0 and tables[1] == 1 and all(1 <= t <= c for t, c in zip(tables[1:], customers[1:], strict=True))
    assert pitmanyor.unpacked(pitmanyor.packed(np.array([0, 65535, 65536, 10**6]))).tolist() == [0, 65535, 65536, 10**6]


def test_what_follows_each_long_word_is_learned(spark, tables):
    """Two long words decide the next one; a model without them gives both followers the same chance."""
    source = random.Random(4)
    texts = [" ".join(w for _ in range(40) for w in source.choice([("alphabet", "follower"), ("boulevard", "successor")])) for _ in range(60)]
    turned = "alphabet successor boulevard follower " * 20
    kept = next(k for k in range(1000, 2000) if held_out(k))
    other = next(k for k in range(kept + 1, 2000) if held_out(k))
    rows = [(k, x) for k, x in enumerate(texts)] + [(kept, "alphabet follower boulevard successor " * 20), (other, turned)]
    found = {r.doc_id: r.score for r in queries.op8_language_model(spark, tables(documents=rows)).collect()}
    # of 80 tokens 40 are followers: right ones nearly certain, wrong ones never seen after their word
    assert found[kept] - found[other] > 40


def test_any_number_of_contexts(spark):
    source = random.Random(3)
    counts = Counter((source.randrange(200), int(source.paretovariate(0.5)) % 10**12) for _ in range(4000))
    model, shared = pitmanyor.train(spark.createDataFrame([(w, c, n) for (w, c), n in counts.items()], "word long, class long, n long"))
    assert model[2].count() == len({c for _, c in counts}) > 100
    kinds = spark.createDataFrame([(k, c) for k, c in enumerate([*sorted({c for _, c in counts})[:40], -5])], "pair int, class long")
    asked = spark.createDataFrame([(w,) for w in [*range(200), 999]], "word long").crossJoin(kinds).select(F.lit(0).alias("block"), "pair", "word", "class")
    known = {w for w, _ in counts}
    asked = asked.filter(F.col("word").isin([*known, 999]))
    sums = pitmanyor.answers(asked, model, shared).groupBy("pair").agg(F.sum("p").alias("p")).collect()
    assert len(sums) == 41 and all(abs(r.p - 1) < 1e-9 for r in sums)


def test_no_step_outlives_the_next(spark, tables):
    """Of all steps only the texts and the answers are left, which the result reads: pairs, seats, words and contexts
    of each sweep go, as do questions that are answered."""
    folder = Path(spark.conf.get("spark.checkpoint.dir")) / "wardgrid"
    settings = {key: spark.conf.get(key) for key in common.TIDY}
    before = set(folder.glob("*"))
    found = queries.op8_language_model(spark, tables(documents=corpus(50)))
    left = set(folder.glob("*")) - before
    assert sorted(x.name.rsplit("-", 1)[0] for x in left) == ["answers"] * pitmanyor.TURNS + ["tokens"]
    assert [y.name for x in left for y in x.glob("turn=*")] == ["turn=-1"]
    assert found.count() == 50 and {key: spark.conf.get(key) for key in common.TIDY} == settings
