"""Mixing sources to target weights by balanced sampling with the cube method.

Sources, in code-point order with the null source last, weigh `WEIGHTS` in turn and share a token budget. A
source's target stops at `MOST` times its tokens, and the excess goes to the others by weight, until none is
above: every target is the lesser of its cap and one common level times its weight, and the level is found by
raising it over sums of the sources until no more of them are capped.

A document is taken target / tokens of its source times in the mean: as often as the whole part says, and once
more with the fractional part as its inclusion probability. The cube method draws those once-more documents so
that the tokens and the number of documents of each source come out as expected. Flight phase: of three
documents still between 0 and 1 the probabilities move along the direction that changes neither sum (the null
space of the two constraints), forwards or backwards at random so that each one's expectation stays, until one
of them reaches 0 or 1; the next document takes its place. Only two documents are open at any time, so a block
of any size streams through constant memory. Blocks of about `BLOCK` documents fly on their own, then the two
that each leaves open are dealt to fewer blocks, until a source is one block. Landing phase: the last block of a source
keeps back `KEPT_BACK` documents at most, at places that grow by a quarter (from 1 to 8, then 10, 12, 15 and so on) by falling size,
from large to small like coins. Of all outcomes of these and the two left open, the one nearest to the expected tokens is taken, among
those whose count is off by `OFF_BY` at most. A source of one block and more than a few documents so meets its
target almost to the word, one of a few as near as whole documents allow, and one of many blocks misses it by
a document's size at most.

Blocks, order and random numbers come from hashes of the row, so runs agree however the table is stored. Rows
alike are separate documents that may fare differently, in an order that cannot be told from outside.

Words are maximal runs without ASCII white space; a null or empty text has none, is open to the count only and
takes nothing. A source without words has the target 0. A row without doc_id is a document like others. An
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.llm import common

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # tokens of the mix to tokens of all sources
MOST = 2
BLOCK = 20_000
FEW_SOURCES = common.FEW
SETTLED = 1e-9
KEPT_BACK = 18
OFF_BY = 3

WORD = r"[^\x20\x09-\x0D]+"
RESULT = ("doc_id", "size", "source_size", "target", "taken")
UNIT = "doc_id long, size long, source_size long, target double, base long, prob double, draw long, source_no long, block long, last boolean"


# --- targets -----------------------------------------------------------------


def numbered(sources: DataFrame) -> DataFrame:
    """Sources (source, size, docs) with source_no, their place in code-point order, null last.

    Sorted over ranges; only the number of rows of each range is gathered.
    """
    ordered = sources.orderBy(F.col("source").asc_nulls_last()).withColumns(
        {"_range": F.spark_partition_id(), "_row": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}
    )
    ordered = common.stored(ordered, "sources", together=False)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ordered.groupBy("_range").count().select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    return ordered.join(ranges, "_range").select(*sources.columns, (F.col("_before") + F.col("_row")).alias("source_no"))


def with_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """`sources` with weight and target. A round adds up the capped and the other sources and raises the level;
    capped ones stay capped, so it ends when their number does not grow."""
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1).cast("int"))
    table = common.stored(numbered(sources).withColumn("weight", turn), "weighted")
    total, level, capped = table.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0], 0.0, -1
    while True:
        above = F.lit(most) * F.col("size") < F.lit(level) * F.col("weight")
        held, free, count = table.agg(
            F.coalesce(F.sum(F.when(above, most * F.col("size"))), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)), F.count_if(above)
        ).first()
        if count == capped or not free:
            break
        capped, level = count, (share * total - held) / free
    return table.withColumn("target", F.least(most * F.col("size").cast("double"), F.lit(level) * F.col("weight")))


# --- the cube method ---------------------------------------------------------


def uniform(draw: int) -> float:
    """A number from 0 to below 1, spread from a 64-bit hash."""
    x = (draw + 0x9E3779B97F4A7C15) % 2**64
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB % 2**64
    return ((x ^ (x >> 31)) >> 11) / 2**53


def direction(a: float, b: float, c: float) -> tuple[float, float, float]:
    """A move of three probabilities that changes neither their sum nor that of their sizes."""
    if a == b == c:
        return 1.0, -1.0, 0.0
    return float(b - c), float(c - a), float(a - b)


def moved(probs: list[float], along: tuple[float, ...], chance: float) -> list[float]:
    """Probabilities moved until one is 0 or 1: forwards or backwards, each in proportion to the other's way."""
    ahead = min((1 - p) / u if u > 0 else p / -u for p, u in zip(probs, along, strict=True) if u)
    back = min(p / u if u > 0 else (1 - p) / -u for p, u in zip(probs, along, strict=True) if u)
    step = ahead if chance * (ahead + back) < back else -back
    out = [p + step * u for p, u in zip(probs, along, strict=True)]
    return [0.0 if p < SETTLED else 1.0 if p > 1 - SETTLED else p for p in out]


def landed(probs: list[float], sizes: list[int]) -> list[float]:
    """The outcome of the last documents that is nearest to the expected tokens and not far off the expected count.
    With n documents there are 2^n outcomes, tried all."""
    tokens, count = np.zeros(1), np.zeros(1)
    for p, size in zip(probs, sizes, strict=True):
        tokens = np.concatenate([tokens - p * size, tokens + (1 - p) * size])
        count = np.concatenate([count - p, count + (1 - p)])
    # rounded, so that which of two equally near outcomes is taken does not hang on the last digit
    far = np.round(np.abs(tokens), 6) + np.where(np.abs(count) <= OFF_BY, 0, np.abs(tokens).sum() + 1)
    best = int(np.lexsort((np.round(np.abs(count), 6), far))[0])
    return [float(best >> k & 1) for k in range(len(probs))]


class Flight:
    """One block's documents in turn; at most two are open between them. A unit is a list as in `UNIT`."""

    SIZE, PROB, DRAW = 1, 5, 6

    def __init__(self) -> None:
        self.open: list[list] = []
        self.back: list[list] = []
        self.done: list[list] = []
        self.seen, self.coin = 0, 1

    def _put(self, probs: list[float]) -> None:
        for unit, p in zip(self.open, probs, strict=True):
            unit[self.PROB] = p
        self.done += [u for u in self.open if u[self.PROB] in (0.0, 1.0)]
        self.open = [u for u in self.open if u[self.PROB] not in (0.0, 1.0)]

    def add(self, unit: list, last: bool = False) -> None:
        self.seen += 1
        if last and self.seen == self.coin and len(self.back) < KEPT_BACK:
            self.back.append(unit)
            self.coin += max(1, self.coin // 4)
            return
        self.open.append(unit)
        if len(self.open) == 3:
            along = direction(*[u[self.SIZE] for u in self.open])
            self._put(moved([u[self.PROB] for u in self.open], along, uniform(unit[self.DRAW])))

    def end(self, last: bool) -> None:
        """The block is over: land, if it is the whole of its source, else hand on what is open."""
        if last:
            self.open += self.back
            self._put(landed([u[self.PROB] for u in self.open], [u[self.SIZE] for u in self.open]))
        self.done += self.open
        self.open, self.back, self.seen, self.coin = [], [], 0, 1


def _flown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flight, at, last, schema = Flight(), None, False, None
    for batch in batches:
        schema = batch.schema
        for unit in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if unit[7:9] != at:
                flight.end(last)
                at, last = unit[7:9], unit[9]
            flight.add(list(unit), last)
        if flight.done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*flight.done, strict=True), schema, strict=True)], schema=schema)
            flight.done = []
    flight.end(last)
    if flight.done:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*flight.done, strict=True), schema, strict=True)], schema=schema)


def between(prob: Column) -> Column:
    return (prob > SETTLED) & (prob < 1 - SETTLED)


def flown(units: DataFrame, block: int = BLOCK, few: int = FEW_SOURCES) -> DataFrame:
    """Units (`UNIT` without block and last) with every prob 0 or 1, after as many rounds of flights as it takes
    for each source to be one block."""
    settled, left = [units.filter(~between(F.col("prob")))], units.filter(between(F.col("prob")))
    level = 0
    while True:
        blocks = left.groupBy("source_no").agg(F.ceil(F.count("*") / block).alias("blocks"))
        blocks = common.stored(blocks, "blocks")
        most = blocks.agg(F.max("blocks")).first()[0]
        if not most:
            break
        dealt = common.beside(left, blocks, ["source_no"], "draw", few)
        dealt = dealt.withColumn("block", F.pmod(F.xxhash64("draw", F.lit(level)), F.col("blocks"))).withColumn("last", F.col("blocks") == 1)
        names = [x.split()[0] for x in UNIT.split(", ")]
        ordered = dealt.select(*names).repartition("source_no", "block").sortWithinPartitions("source_no", "block", F.desc("size"), "draw", "doc_id")
        out = common.stored(ordered.mapInArrow(_flown, UNIT), "flight").drop("block", "last")
        settled.append(out.filter(~between(F.col("prob"))))
        left, level = out.filter(between(F.col("prob"))), level + 1
        if most == 1:
            break
    return reduce(DataFrame.unionByName, settled)


def mix(docs: DataFrame, block: int = BLOCK, few: int = FEW_SOURCES) -> DataFrame:
    """`RESULT` for every document (doc_id, text, source): the words it has and those that the mix takes."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("doc_id", "source", "text").alias("draw"),
    )
    rows = common.stored(rows, "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs"))
    targets = with_targets(sources).select("source", F.col("size").alias("source_size"), "target", "source_no")
    often = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    units = common.beside(rows, targets, ["source"], "draw", few).withColumn("_often", often)
    units = units.withColumn("base", F.floor("_often").cast("long")).withColumn("prob", F.col("_often") - F.col("base"))
    done = flown(units.select("doc_id", "size", "source_size", "target", "base", "prob", "draw", "source_no"), block, few)
    return done.select("doc_id", "size", "source_size", "target", ((F.col("base") + F.round("prob")) * F.col("size")).cast("long").alias("taken"))
