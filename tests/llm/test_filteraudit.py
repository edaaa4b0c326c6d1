from fractions import Fraction
from itertools import permutations
from math import factorial

from pyspark.sql import functions as F

from wardgrid.llm import filteraudit

WORDS = " ".join(f"w{i}" for i in range(200))
DOCS = [
    (1, WORDS, "en"),
    (2, WORDS, "fr"),
    (2, WORDS, "fr"),
    (3, WORDS, "en"),
    (4, "one two two two x", "en"),
    (5, "same same same same same", None),
    (6, None, None),
    (7, "", ""),
    (8, "É ÀB CD" + " ok" * 300, "en"),
    (9, "A$ b|c", "de"),
    (None, WORDS, "en"),
    (None, "", "en"),
    (10, " \t\x0b\x0c\r\n ", "en"),
    (11, "# " + "long " * 60000 + WORDS, "de"),
]
LABELS = [(1, 1, 0), (3, 1, 1), (3, 0, 0), (4, None, 1), (9, 0, 1), (99, 1, 1), (None, 1, 1)]


def brute(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    parts = {}
    for i, text, lang in docs:
        text = text or ""
        words = text.encode().split()
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and first[text] < i,
        }
        parts.setdefault(lang or "", []).append(({f for f in fails if fails[f]}, i in good, i in toxic))
    rows = []
    for part, members in parts.items():
        removed_by = dict.fromkeys("ABCDE", 0)
        found = []
        for order in permutations("ABCDE"):
            left = members
            for step, f in enumerate(order, 1):
                out = [m for m in left if f in m[0]]
                left = [m for m in left if f not in m[0]]
                removed_by[f] += len(out)
                redundant = sum(f in m[0] for m in members) - len(out)
                found.append((part, "".join(order), step, len(left), len(out), redundant, sum(m[0] == {f} for m in members), sum(m[1] for m in out), sum(m[2] for m in out), f))
        rows += [(*r[:-1], removed_by[r[-1]]) for r in found]
    return sorted(rows)


def frames(spark, docs, labels):
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    # names that the operator uses for its own columns
    table = table.withColumns({c: F.lit("x") for c in ("part", "bits", "n", "digest", "first", "good", "step")})
    return table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("n", F.lit(5))


def test_equals_filters_applied_in_turn(spark):
    out = filteraudit.audit(*frames(spark, DOCS, LABELS))
    assert tuple(out.columns) == filteraudit.RESULT
    assert sorted(tuple(r) for r in out.collect()) == brute(DOCS, LABELS)


def test_empty_tables(spark):
    assert filteraudit.audit(*frames(spark, [], LABELS)).count() == 0
    assert sorted(tuple(r) for r in filteraudit.audit(*frames(spark, DOCS[:3], [])).collect()) == brute(DOCS[:3], [])


def test_the_solution_is_the_shapley_value():
    table = filteraudit.shapley_table()
    for k in range(5):
        for s in range(1, 32):  # the empty coalition removes nothing
            size = bin(s).count("1")
            rest = size - (s >> k & 1)
            share = Fraction(factorial(rest) * factorial(4 - rest), factorial(5))
            assert table[k][s] == 120 * (share if s >> k & 1 else -share)


def test_copies_are_spread(spark):
    """A large group of copies is not dealt by its text alone."""
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("copy").alias("text"), F.lit("en").alias("lang"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = {(r["bits"], r["n"]) for r in filteraudit.failures(docs, labels).collect()}
    assert rows == {(1, 1), (17, 4999)}
