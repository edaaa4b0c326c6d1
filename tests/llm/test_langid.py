import hashlib
import random

import numpy as np
import pytest

from wardgrid.llm import langid, queries

SYLLABLES = {"aa": "ka to mi ne ru".split(), "bb": "sch ung ver ß ü".split(), "cc": "eau oui ç lle é".split()}


def text(source, lang, n):
    return " ".join("".join(source.choices(SYLLABLES[lang], k=3)) for _ in range(n))


def test_held_out_accuracy_and_odd_rows(spark, tables):
    source = random.Random(1)
    rows = [(k, text(source, lang, source.randint(3, 60)), lang) for k, lang in enumerate(sorted(SYLLABLES) * 60)]
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "123 ... \n 4", None), (903, text(source, "cc", 30000), None), (None, "kato kato mine", None), (1, rows[1][1], "bb")]
    found = {r.doc_id: r for r in queries.op9_language_id(spark, tables(documents=rows)).collect()}
    import zlib

    for doc_id, _, lang in rows[:180]:
        assert found[doc_id].lang_pred == lang and 0 < found[doc_id].score <= 1
        assert found[doc_id].held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
    assert [(found[k].lang_pred, found[k].score) for k in (900, 901, 902)] == [("und", 0.0)] * 3
    assert found[903].lang_pred == "cc" and found[None].lang_pred == "aa" and found[None].held_out


def test_nothing_or_one_language_learned(spark, tables):
    assert queries.op9_language_id(spark, tables()).count() == 0
    unlabelled = queries.op9_language_id(spark, tables(documents=[(1, "some text"), (2, None)])).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}
    one = queries.op9_language_id(spark, tables(documents=[(1, "some text", "xx"), (2, "other", None)])).collect()
    assert {(r.lang_pred, r.score) for r in one} == {("xx", 1.0)}


@pytest.mark.parametrize("k", [2, 3, 5, 7, 12, 40])
def test_codewords_differ(k):
    code = langid.code_of(k)
    apart = (code[:, None, :] != code[None, :, :]).sum(axis=2) + 1000 * np.eye(k)
    assert apart.min() >= max(1, 2 ** (k - 2) if k <= 7 else code.shape[1] // 5)
    assert all(len(set(column)) == 2 for column in code.T)


def plainly(rows):
    """Weights and trust of each bit by dictionaries of n-gram counts, language by language."""
    from collections import Counter, defaultdict

    import pyarrow as pa

    counts = defaultdict(Counter)
    for text, lang in rows:
        counts[lang].update(langid.grams(pa.array([text]))[0].tolist())
    names = sorted(counts)
    code = langid.code_of(len(names))
    share = {n: (langid.SMOOTHING + np.array([counts[n][b] for b in range(langid.BUCKETS)])) / (sum(counts[n].values()) + langid.SMOOTHING * langid.BUCKETS) for n in names}
    weights = []
    for bit in range(code.shape[1]):
        one, other = (np.mean([share[n] for k, n in enumerate(names) if code[k, bit] == side], axis=0) for side in (1, -1))
        weights.append((np.log(one / other), ((one - other) * np.log(one / other)).sum()))
    return names, np.array([w for w, _ in weights]), np.array([t for _, t in weights])


@pytest.mark.parametrize("k", [3, 12])
def test_weights_by_brute_force(spark, k):
    source = random.Random(k)
    rows = [(" ".join("".join(source.choices("abcdefgh"[j % 5 :], k=4)) for _ in range(20)), f"l{j}") for j in range(k) for _ in range(3)]
    docs = spark.createDataFrame([(a, b, n) for n, (a, b) in enumerate(rows)], "text string, lang string, bucket long").repartition(4)
    model = langid.train(docs)
    names, weights, trust = plainly(rows)
    assert model.languages == names
    np.testing.assert_allclose(model.weights, weights, rtol=1e-4, atol=1e-5)
    np.testing.assert_allclose(model.trust, trust / trust.sum() * 4, rtol=1e-6)
    margins = np.random.default_rng(1).normal(size=(5, len(trust)))
    plain = (np.logaddexp(0, -margins[:, None, :] * model.code[None]) * model.trust).sum(axis=2)
    np.testing.assert_allclose(model.losses(margins), plain)


def test_two_thousand_labels(spark, tables):
    labels = [f"l{k:04d}" for k in range(2000)]
    letters = "bcdfghjklmnpqrst"
    word = {x: "".join(letters[int(c, 16)] for c in hashlib.md5(x.encode()).hexdigest()[:10]) for x in labels}
    rows = [(j * 2000 + k, " ".join([word[x]] * 6), x) for j in range(2) for k, x in enumerate(labels)]
    found = queries.op9_language_id(spark, tables(documents=rows)).collect()
    assert len(found) == 4000 and {r.lang_pred for r in found} <= set(labels)
    right = {r.doc_id: r.lang_pred for r in found}
    assert sum(right[d] == x for d, _, x in rows) > 0.8 * len(rows)  # both rows of 4 % are held out
