import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from wardgrid.llm import fingerprints, queries
from wardgrid.llm.shingles import shingles, words


def prose(source, n):
    return " ".join(f"w{source.randrange(4000)}" for _ in range(n))


def sets_of(text):
    tokens = (text or "").lower().split()
    return {tuple(tokens[k : k + 5]) for k in range(max(1, len(tokens) - 4))} if tokens else set()


def test_edited_texts_and_likeness(spark, tables):
    source = random.Random(3)
    texts = [prose(source, n) for n in (900, 3, 400, 1, 700)] + [None, "", "Ünïcode 中文 " * 50, "x " * 30000]
    rows = [(7 * k + 1, x) for k, x in enumerate(texts)] + [(None, "no id here " * 9)]
    found = {r.doc_id: r for r in queries.op10_fingerprints(spark, tables(documents=rows)).collect()}
    assert len(found) == len(rows)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for k, (doc_id, text) in enumerate(ordered):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        row = found[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for near, other in ((row.near_edited, edited), (row.near_next, following)):
            a, b = sets_of(text), sets_of(other)
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(near - true) < 0.17


def test_equal_texts_have_equal_fingerprints_and_one_row_follows_itself(spark, tables):
    found = queries.op10_fingerprints(spark, tables(documents=[(1, "a b c d e f"), (2, "a b c d e f")])).collect()
    assert len({r.fingerprint for r in found}) == 1 and all(r.near_next == 1.0 for r in found)
    one = queries.op10_fingerprints(spark, tables(documents=[(5, "only one")])).collect()
    assert [r.near_next for r in one] == [1.0]
    assert queries.op10_fingerprints(spark, tables()).count() == 0


def test_words_follow_text_borders():
    import pyarrow as pa

    texts = ["ab CD", "", None, " x\ty\n", "ab cd"]
    hashes, first = words(pa.array(texts, pa.string()))
    counts = np.diff(first)
    assert counts.tolist() == [2, 0, 0, 2, 2]
    assert hashes[:2].tolist() == hashes[4:].tolist() and len(set(hashes.tolist())) == 4
    assert len(shingles(hashes[:0], 5)) == 0 and len(shingles(hashes[:2], 5)) == 1


def test_near_pairs_are_verified(spark):
    source = random.Random(9)
    base = prose(source, 300).split()
    near = [*base[:150], "changed", *base[151:]]
    far = [*base[:150], *prose(source, 150).split()]
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far)), (4, " ".join(base)), (5, None), (6, ""), (7, None)]
    members, pairs = fingerprints.near_pairs(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.class_id) for r in members.collect()} == {(1, 1), (2, 2), (3, 3), (4, 1)}
    assert [(r.left_id, r.right_id, round(r.jaccard, 6)) for r in pairs.collect()] == [(1, 2, round(291 / 301, 6))]
    assert members.filter(F.lit(False)).count() == 0
