import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wardgrid.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counts(docs):
    n = Counter()
    for i, text in docs:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(docs):
    n = counts(docs)
    near = defaultdict(set)
    words = sorted(n)
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w in words:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= 2 * n[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in words)


def found(df):
    assert tuple(df.columns) == spelling.RESULT
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, alphabet="abé", sizes=(4, 9), texts=60):
    """Texts of short words over few letters, which have many near words."""
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice(alphabet) for _ in range(draw.randint(*sizes))) for _ in range(400)]
    vocabulary += ["stem" + w for w in vocabulary[:200]] + [w + "ness" for w in vocabulary[:200]]
    docs = [(i, " ".join(vocabulary[int(len(vocabulary) * draw.random() ** 3)] for _ in range(80))) for i in range(texts)]
    return [*docs, (None, docs[0][1].upper()), (1, None), (2, ""), docs[3], docs[3]]


@pytest.mark.parametrize(("limit", "few"), [(spelling.LIMIT, 100), (8, 100), (8, 0)], ids=["whole lists", "dealt again", "no broadcast"])
def test_equals_brute_force(spark, limit, few):
    docs = corpus(limit)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumns({c: F.lit("x") for c in ("word", "n", "m", "near")})
    want = brute(docs)
    assert sum(r[1] is not None for r in want) > 50 and max(r[4] for r in want) > 5
    assert found(spelling.group(table, limit, few)) == want


def test_the_walk_equals_comparison():
    draw = random.Random(4)
    for _ in range(30):
        m = draw.randint(1, 6)
        lists = []
        for owner in range(4):
            words = {"".join(draw.choice("abcÿ") for _ in range(m + draw.randint(0, 1))) for _ in range(draw.randint(1, 60))}
            lists += [(m + 5, 3, 2, f"p{owner}", "s", 1 << 30, w, 1) for w in sorted(words)]
        a, b = spelling.compared(lists)
        got = sorted(zip(a.tolist(), b.tolist(), strict=True))
        assert len(set(got)) == len(got)
        short = [len(x[6]) == m for x in lists]
        assert got == sorted((i, j) for i, x in enumerate(lists) for j, y in enumerate(lists) if x[3] == y[3] and (short[i] or short[j]) and one_edit(x[6], y[6]))


def test_a_chain_of_forms_ends_in_its_root(spark):
    words = ["letter", "lettre", "lettrex", "lettrexy", "lettrexyz"]
    docs = [(1, " ".join(w for k, w in enumerate(words[1:]) for _ in range(3 * 2 ** (3 - k)))), (2, "unrelated " * 5)]
    rows = {r["word"]: r for r in spelling.group(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found(spelling.group(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)
    assert {r["root"] for w, r in rows.items() if w.startswith("lettre")} == {"lettre"} and rows["unrelated"]["root"] == "unrelated"


def test_letters_and_hashes_follow_the_rule(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 2)
    text = "ÀÉÎõÿ àéîõÿ a×b÷cd straße Ābcdef zażółć ABCDE abcde aBcDe 中文abcde_fghij-klmno " * 3
    docs = [(i, text) for i in range(40)]
    assert found(spelling.group(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)


def test_no_words(spark):
    for docs in ([], [(1, None), (2, "ab cd"), (3, "rare words only")]):
        assert spelling.group(spark.createDataFrame(docs, "doc_id long, text string")).collect() == []


def test_query_over_a_table(spark, tables):
    docs = corpus(11, texts=30)
    folder = tables(documents=docs)
    assert found(queries.QUERIES["op13_spelling_variants"](spark, folder)) == brute(docs)
