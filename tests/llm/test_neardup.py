import random

import numpy as np
from pyspark.sql import functions as F

from wardgrid.llm import neardup, queries
from wardgrid.llm.components import connected


def sets_of(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows, percent):
    sets = [sets_of(x) for _, x in rows]
    label = list(range(len(rows)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * len(sets[a] | sets[b]):
                label[root(a)] = root(b)
    smallest = {}
    for k, (doc_id, _) in enumerate(rows):
        smallest[root(k)] = min(smallest.get(root(k), doc_id), doc_id)
    return sorted((d, len(sets[k]), smallest[root(k)], smallest[root(k)] == d) for k, (d, _) in enumerate(rows))


def corpus(seed):
    source = random.Random(seed)
    prose = lambda n: [f"w{source.randrange(3000)}" for _ in range(n)]
    rows = []
    for _ in range(12):  # an original with edited copies, and copies of copies
        base = prose(source.randint(20, 400))
        for _ in range(source.randint(1, 9)):
            copy = list(base)
            for _ in range(source.randint(0, 6)):
                copy[source.randrange(len(copy))] = f"x{source.randrange(10**6)}"
            rows.append(" ".join(copy))
            if source.random() < 0.3:
                base = copy
    rows += [" ".join(prose(source.randint(0, 60))) for _ in range(40)]
    rows += [rows[0], rows[0].upper(), rows[3], None, None, "", " \t", "one two", "One  two", "one two three", " ".join(prose(30000))]
    source.shuffle(rows)
    return list(enumerate(rows))


def test_against_brute_force(spark, tables):
    for seed in (1, 2):
        rows = corpus(seed)
        found = queries.op7_near_duplicates(spark, tables(documents=rows)).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == brute(rows, 85)


def test_empty_repeated_and_unnamed_rows(spark, tables):
    assert queries.op7_near_duplicates(spark, tables()).count() == 0
    docs = spark.createDataFrame([(1, "a b", 5), (1, "a b", 6), (None, "a b", 7), (None, None, 8)], "doc_id long, text string, kept int")
    found = sorted(map(tuple, neardup.marked(docs).fillna({"doc_id": -1, "component_id": -1, "text": ""}).collect()))
    assert found == [(-1, "", 0, -1, True), (-1, "a b", 1, 1, False), (1, "a b", 1, 1, True), (1, "a b", 1, 1, True)]


def test_estimate_follows_jaccard(spark):
    source, rows = np.random.default_rng(3), []
    for size in (150, 4000):
        for share in (0.0, 0.3, 0.7, 0.85, 1.0):
            for _ in range(30):
                joint = np.unique(source.integers(0, 2**64, size, dtype=np.uint64))
                kind = source.random(len(joint))
                a, b = joint[kind < (1 + share) / 2], joint[(kind < share) | (kind >= (1 + share) / 2)]
                true = len(np.intersect1d(a, b)) / len(joint)
                rows.append((true, neardup.packed(a), neardup.packed(b)))
    found = spark.createDataFrame(rows, "share double, a array<long>, b array<long>").select("share", neardup.estimate(F.col("a"), F.col("b"))[0].alias("e")).collect()
    assert all(abs(r.share - r.e) < (0.057 if r.share > 0.8 else 0.12) for r in found)
    assert abs(sum(r.share - r.e for r in found) / len(found)) < 0.01


def test_components_of_a_long_path(spark):
    pairs = [(k, k + 1) for k in range(60)] + [(100, 99), (100, 101), (7, 7)]
    found = {r.node: r.component for r in connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(61)} | {99: 99, 100: 99, 101: 99}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_sets_pass_the_estimates_and_distant_ones_do_not(spark):
    source, rows = np.random.default_rng(5), []
    for size in (1, 6, 12, 60, 170, 900, 5000):
        for share in (0.6, 0.72, 0.85, 0.95, 1.0):
            for _ in range(40):
                joint = np.unique(source.integers(0, 2**64, size, dtype=np.uint64))
                source.shuffle(joint)
                shared, left = int(np.ceil(share * size)), int(source.integers(0, size - np.ceil(share * size) + 1))
                a, b = np.sort(joint[: shared + left]), np.sort(np.concatenate([joint[:shared], joint[shared + left :]]))
                rows.append((shared / size, size, len(a), len(b), neardup.packed(a), neardup.packed(b)))
    frame = spark.createDataFrame(rows, "share double, size int, n_a int, n_b int, bits_a array<long>, bits_b array<long>")
    found = frame.select("share", "size", neardup.likely(0.85).alias("likely")).collect()
    assert all(r.likely for r in found if r.share >= 0.85)
    assert sum(r.likely for r in found if r.share < 0.75 and 100 < r.size < 1000) <= 2


def test_bands_miss_less_than_stated():
    for percent in (80, 85, 90):
        bands, rows = neardup.banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= neardup.MISSED


def test_one_row_of_each_group_stays(spark):
    text = " ".join(f"w{k}" for k in range(40))
    other, third = text + " more", " ".join(f"x{k}" for k in range(30))
    rows = [(5, text, 1), (5, text, 1), (5, other, 2), (9, text, 3), (None, text, 4)] + [(None, third, 5)] * 3 + [(7, None, 6), (7, None, 6), (8, "", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int").repartition(3)
    found = neardup.one_of_each(docs, 80)
    assert found.columns == docs.columns
    got = [tuple(r) for r in found.collect()]
    assert sorted(x[2] for x in got if x[2] >= 5) == [5, 6, 6, 7]
    assert len([x for x in got if x[2] < 5]) == 1 and [x[0] for x in got if x[2] < 5] == [5]
    assert neardup.one_of_each(docs.limit(0)).count() == 0


def test_a_crowded_bucket_of_copies_that_are_not_near_each_other(spark, tables):
    source = random.Random(9)
    base = [f"w{k}" for k in range(170)]
    rows = []
    for k in range(120):  # each at about 0.8 to the original, in many of its buckets
        copy = list(base)
        for at in source.sample(range(0, 170, 5), 4):
            copy[at] = f"e{k}_{at}"
        rows.append(" ".join(copy))
    rows = list(enumerate([*rows, " ".join(base), rows[7] + " x"]))
    found = queries.op7_near_duplicates(spark, tables(documents=rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == brute(rows, 85)
