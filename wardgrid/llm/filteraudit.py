"""How five filters of documents interact: what each removes in each order, and its Shapley share.

A document's failures are five bits, one a filter, so everything follows from the number of documents by part
and bits. From these all 32 coalitions of filters are tabulated: how many documents a coalition removes, and of
those how many are good or toxic. In an order of filters each step removes what its coalition removes beyond
the coalition before, which gives all counts of all 120 orders as differences.

The Shapley values are the solution of a constrained least squares problem: of all additive scores (one number
a filter) that give the whole coalition its exact removals, that which is nearest to the removals of the others,
a coalition of s of 5 filters weighing 4 / (C(5, s) s (5 - s)). Its normal equations, with a multiplier for the
constraint, are solved in rationals, once for each coalition as right-hand side, since the matrix is the same for
every part. 120 times the solution is a table of whole numbers, applied to each part's removals by whole sums.

Failures: A fewer than `LEAST_WORDS` words; B distinct words under half of all words; C over three capitals A-Z
in a hundred code points; D one of `#$%&*|`; E the same text has a smaller doc_id anywhere in the table.
Words are maximal runs without ASCII white space and case counts.

A null text is the empty text (and equal to it), a null language the part ''. A row without doc_id never fails
E and has no label; rows alike in doc_id and text count one by one and do not make each other fail E. A document
with several labels is good or toxic if one of them says so. An empty table gives no parts and no rows. Other
columns are not read.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
N = len(FILTERS)
COALITIONS = 1 << N
ORDERS = ["".join(p) for p in permutations(FILTERS)]
BIT = {name: 1 << k for k, name in enumerate(FILTERS)}

LEAST_WORDS = 200
SPACES = r"[\x20\x09-\x0D]+"
COUNTS = ("n", "good", "toxic")
RESULT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


# --- documents ---------------------------------------------------------------


def own_failures(text: Column) -> Column:
    """The bits of the filters that look at one text only."""
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    # one array for both counts
    few = F.transform(F.array(words), lambda w: F.size(w) < LEAST_WORDS)[0]
    repetitive = F.transform(F.array(words), lambda w: 100 * F.size(F.array_distinct(w)) < 50 * F.size(w))[0]
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    tests = {"A": few, "B": repetitive, "C": 100 * capitals > 3 * F.length(text), "D": text.rlike(r"[#$%&*|]")}
    bits = F.lit(0)
    for name, fails in tests.items():
        bits = bits + F.when(fails, BIT[name]).otherwise(0)
    return bits


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, n, good, toxic): documents by language and failed filters; a few rows a language.

    Copies share their digest but not their id: rows are dealt by both, so a large group of copies is spread,
    and of its digest alone only the least id is sought, with a map-side minimum.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.coalesce("lang", F.lit("")).alias("part"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(text, 256).alias("digest"),
        own_failures(text).alias("bits"),
    )
    # without an id: no label, no smaller id, and no join in which all of them would meet
    nameless = rows.filter("doc_id is null").groupBy("part", "bits").agg(F.count("*").alias("n"))
    named = rows.filter("doc_id is not null").groupBy("digest", "doc_id", "part", "bits").agg(F.count("*").alias("n"))
    first = rows.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    known = named.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
    known = known.withColumn("bits", F.col("bits") + F.when(F.col("first"), 0).otherwise(BIT["E"]))
    held = [F.col("n"), *[F.when(F.col(c) == 1, F.col("n")).otherwise(0) for c in COUNTS[1:]]]
    counted = known.select("part", "bits", *[v.alias(c) for v, c in zip(held, COUNTS, strict=True)])
    zeros = [F.lit(0).cast("long").alias(c) for c in COUNTS[1:]]
    return counted.unionByName(nameless.select("part", "bits", "n", *zeros)).groupBy("part", "bits").agg(*[F.sum(c).alias(c) for c in COUNTS])


# --- coalitions --------------------------------------------------------------


def coalitions(counts: DataFrame) -> DataFrame:
    """(part, n, good, toxic, all): what each of the 32 coalitions removes, as arrays by coalition, and all
    documents of the part."""
    each = counts.select("part", "bits", *COUNTS, F.explode(F.sequence(F.lit(0), F.lit(COALITIONS - 1))).alias("coalition"))
    hit = F.col("bits").bitwiseAND(F.col("coalition")) != 0
    sums = each.groupBy("part", "coalition").agg(*[F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(c) for c in COUNTS], F.sum("n").alias("all"))
    # 32 entries a part
    table = sums.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("coalition", *COUNTS))).alias("t"), F.max("all").alias("all"))
    return table.select("part", "all", *[F.col(f"t.{c}").alias(c) for c in COUNTS])


def solved(matrix: list[list[Fraction]], sides: list[list[Fraction]]) -> list[list[Fraction]]:
    """The rational solutions of matrix @ x = side, for each column of `sides`, by elimination."""
    size = len(matrix)
    rows = [list(map(Fraction, a)) + list(map(Fraction, b)) for a, b in zip(matrix, sides, strict=True)]
    for k in range(size):
        pivot = next(r for r in range(k, size) if rows[r][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for r in range(size):
            if r != k and rows[r][k]:
                rows[r] = [x - rows[r][k] * y for x, y in zip(rows[r], rows[k], strict=True)]
    return [row[size:] for row in rows]


def weight(size: int) -> Fraction:
    """What a coalition of `size` filters, not none and not all, counts in the least squares."""
    return Fraction(N - 1, comb(N, size) * size * (N - size))


def shapley_table() -> list[list[int]]:
    """For each filter, `N`! times the weight of each coalition's removals in its Shapley value."""
    inner = range(1, COALITIONS - 1)
    member = [[s >> k & 1 for k in range(N)] for s in range(COALITIONS)]
    heft = {s: weight(sum(member[s])) for s in inner}
    # normal equations of the weighted squares, bordered by the constraint that all shares sum to the whole
    matrix = [[sum((heft[s] * member[s][i] * member[s][j] for s in inner), Fraction(0)) for j in range(N)] + [Fraction(1)] for i in range(N)]
    matrix.append([Fraction(1)] * N + [Fraction(0)])
    sides = [[heft[s] * member[s][i] if s in heft else Fraction(0) for s in range(COALITIONS)] for i in range(N)]
    sides.append([Fraction(int(s == COALITIONS - 1)) for s in range(COALITIONS)])
    whole = [[x * factorial(N) for x in row] for row in solved(matrix, sides)[:N]]
    if any(x.denominator != 1 for row in whole for x in row):
        raise ArithmeticError("the weights of removals are no multiples of 1 / N!")
    return [[int(x) for x in row] for row in whole]


def steps() -> Column:
    """All steps of all orders: the order, the step, its filter's place, the coalitions before and after it."""
    out = []
    for order in ORDERS:
        before = 0
        for step, name in enumerate(order, 1):
            out.append(f"named_struct('filter_order', '{order}', 'step', {step}, 'place', {FILTERS.index(name)}, 'before', {before}, 'after', {before | BIT[name]})")
            before |= BIT[name]
    return F.expr(f"array({', '.join(out)})")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`RESULT`: a row for each part, order and step; counts of documents within the part, at or after the step.

    `shapley` is the filter's removals summed over all 120 orders, the same in each of its rows.
    """
    table = coalitions(failures(docs, labels))
    shares = []
    for row in shapley_table():
        used = [F.col("n")[s] * c for s, c in enumerate(row) if c]
        shares.append(sum(used[1:], used[0]))
    wide = table.withColumn("shares", F.array(*shares))
    each = wide.select("*", F.inline(steps()))
    gained = {c: F.expr(f"{c}[after] - {c}[before]") for c in COUNTS}
    alone = F.expr("n[shiftleft(1, place)]")
    others = F.expr(f"n[{COALITIONS - 1} - shiftleft(1, place)]")
    return each.select(
        "part",
        "filter_order",
        "step",
        (F.col("all") - F.expr("n[after]")).alias("kept"),
        gained["n"].alias("removed"),
        (alone - gained["n"]).alias("redundant"),
        (F.expr(f"n[{COALITIONS - 1}]") - others).alias("unique_fails"),
        gained["good"].alias("good_lost"),
        gained["toxic"].alias("toxic_lost"),
        F.expr("shares[place]").alias("shapley"),
    )
