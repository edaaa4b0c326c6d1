import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from wardgrid.llm import mixing


def targets(sizes):
    """Source sizes in order -> targets, by resharing the excess as the rule says."""
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sizes)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = {s: w for s, w in weights.items() if s not in capped}
        level = (total - sum(capped.values())) / sum(free.values()) if free else 0.0
        above = [s for s in free if level * weights[s] > 2 * sizes[s]]
        if not above:
            return {s: capped.get(s, level * weights[s]) for s in sizes}
        capped |= {s: 2.0 * sizes[s] for s in above}


def corpus(spark, count=6000, seed=3):
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        source = draw.choices(["hot", "b", "é", "", None, "z", "a", "Z"], [33, 9, 9, 1, 9, 20, 5, 14])[0]
        rows.append((i, " ".join("w" for _ in range(min(int(draw.paretovariate(1.1)), 400))) if i % 50 else None, source))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def sums(rows):
    out = {}
    for r in rows:
        out.setdefault(r["source"], []).append(r)
    return out


@pytest.mark.parametrize(("block", "few", "off"), [(mixing.BLOCK, mixing.FEW_SOURCES, 2), (40, 0, 200)], ids=["one block", "many blocks, no broadcast"])
def test_targets_are_met(spark, block, few, off):
    rows, docs = corpus(spark)
    out = mixing.mix(docs.withColumns({c: F.lit(1) for c in ("size", "draw", "prob", "block")}), block, few)
    assert tuple(out.columns) == mixing.RESULT
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == len(rows)
    by_source = {}
    for i, text, source in rows:
        r = got[i]
        assert r["size"] == len((text or "").split()) and r["taken"] in ({0} | {k * r["size"] for k in (1, 2)})
        by_source.setdefault(source, []).append(r)
    names = sorted([s for s in by_source if s is not None]) + [None]
    sizes = {s: sum(r["size"] for r in by_source[s]) for s in names}
    wanted = targets(sizes)
    for s in names:
        mean = wanted[s] / sizes[s]
        assert all(r["source_size"] == sizes[s] and r["target"] == pytest.approx(wanted[s]) for r in by_source[s])
        # every document is taken as often as the whole part says, or once more
        assert all(r["size"] == 0 or int(mean - 1e-9) <= r["taken"] / r["size"] <= int(mean + 1) for r in by_source[s])
        assert abs(sum(r["taken"] for r in by_source[s]) - wanted[s]) <= off, (s, wanted[s])
        more = sum(r["taken"] / r["size"] for r in by_source[s] if r["size"])
        assert abs(more - mean * sum(r["size"] > 0 for r in by_source[s])) <= 0.03 * len(by_source[s]) + 2


def test_runs_agree_however_the_table_lies(spark):
    _, docs = corpus(spark, 1500)
    first = sorted(map(tuple, mixing.mix(docs.repartition(7), 100).collect()))
    assert first == sorted(map(tuple, mixing.mix(docs.repartition(2, "source").orderBy(F.desc("doc_id")), 100, 0).collect()))


def test_flight_keeps_both_sums_and_every_expectation():
    draw = random.Random(5)
    units = [[k, draw.randint(0, 30), 0, 0.0, 0, draw.choice([0.25, 0.5, 0.8]), 0, 0, 0, True] for k in range(40)]
    taken = [0.0] * 40
    for run in range(3000):
        flight = mixing.Flight()
        for u in units:
            flight.add([*u[:6], run * 1000 + u[0], *u[7:]])
        flight.end(False)
        probs = {u[0]: u[5] for u in flight.done}
        assert sum(0 < p < 1 for p in probs.values()) <= 2
        assert sum(probs.values()) == pytest.approx(sum(u[5] for u in units), abs=1e-6)
        assert sum(probs[u[0]] * u[1] for u in units) == pytest.approx(sum(u[5] * u[1] for u in units), abs=1e-6)
        for k, p in probs.items():
            taken[k] += p / 3000
    assert all(abs(t - u[5]) < 0.05 for t, u in zip(taken, units, strict=True))


def test_landing_takes_the_nearest_outcome():
    assert sorted(mixing.landed([0.5, 0.5], [10, 10])) == [0.0, 1.0]
    assert mixing.landed([0.4], [7]) == [0.0] and mixing.landed([], []) == []
    draw = random.Random(8)
    for _ in range(50):
        probs, sizes = [draw.random() for _ in range(7)], [draw.randint(0, 40) for _ in range(7)]

        def miss(outcome, values):
            return abs(sum((z - p) * v for z, p, v in zip(outcome, probs, values, strict=True)))

        near = [o for o in product((0, 1), repeat=7) if miss(o, [1] * 7) <= mixing.OFF_BY]
        assert miss(mixing.landed(probs, sizes), sizes) == pytest.approx(min(miss(o, sizes) for o in near), abs=1e-5)


def test_empty_repeated_and_wordless_rows(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).collect() == []
    none = mixing.mix(spark.createDataFrame([(1, None, "a"), (2, " \t", None)], schema)).collect()
    assert sorted((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in none) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    same = mixing.mix(spark.createDataFrame([(None, "x y", "s")] * 300 + [(7, "long " * 70000, "t")], schema)).collect()
    assert len(same) == 301 and {r["taken"] for r in same if r["doc_id"] is None} <= {0, 2, 4}
    alone = mixing.mix(spark.createDataFrame([(1, "a b", "s")], schema)).collect()
    assert alone[0]["target"] == 3.0 and alone[0]["taken"] in (2, 4)
