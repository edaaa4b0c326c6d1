"""Cutting an ordered run of atomic groups into shards so that the largest shard is as small as can be.

Groups (equal texts) are ordered by a digest of their text and never split. The smallest feasible capacity is
found by binary search; a capacity is checked greedily: each shard takes whole groups until the next would
not fit. Both need only the running sums at group borders, and of those only few: a round knows the borders
at `RESOLUTION` places, which bounds the capacity from both sides and bounds where each cut can lie; the next
round reads the borders between those bounds only, and so on until every border that matters is known. What
reaches the driver is about `RESOLUTION` numbers a round, however many groups there are (twice as many after a
round that narrows little). All work on rows is DataFrame operations.

Sizes are non-negative whole numbers. A null text has no bytes, and rows without a text are one group, apart
from the empty text. Rows that are alike each get a slot of their own. More shards than groups leave the last
shards empty. An empty table gives an empty result. A group larger than all else is a shard by itself, and
the capacity is its size. Other columns pass through; those named like the result's are replaced.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.llm import common

RESOLUTION = 8192
BUCKETS = 1 << 14
ROWS_TOGETHER = 1 << 12


def running(groups: DataFrame, *values: str) -> DataFrame:
    """`groups` (key: hex digest) with `<value>_end`, the running sum in key order, for each value.

    Keys are spread over `BUCKETS` consecutive ranges of digests; sums of ranges are added up first.
    """
    bucketed = groups.withColumn("_bucket", F.conv(F.substring("key", 1, 4), 16, 10).cast("int").bitwiseAND(0xFFFF) / (65536 // BUCKETS))
    bucketed = bucketed.withColumn("_bucket", F.floor("_bucket").cast("int"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = bucketed.groupBy("_bucket").agg(*[F.sum(v).alias(f"_{v}") for v in values])
    sums = sums.select("_bucket", *[F.coalesce(F.sum(f"_{v}").over(before), F.lit(0)).alias(f"_{v}_before") for v in values])
    inside = Window.partitionBy("_bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = bucketed.join(sums, "_bucket")
    return joined.select(*groups.columns, *[(F.col(f"_{v}_before") + F.sum(v).over(inside)).alias(f"{v}_end") for v in values])


def greedy(ends: list[int], capacity: int, shards: int) -> list[int] | None:
    """The ends of shards that take as much as fits, or None if `shards` are not enough. `ends`: rising
    running sums at the borders between groups."""
    cuts, at = [], 0
    while at < ends[-1]:
        fits = ends[bisect_right(ends, at + capacity) - 1] if ends[0] <= at + capacity else 0
        if fits <= at or len(cuts) == shards:
            return None
        cuts.append(fits)
        at = fits
    return cuts


def hopeful(ends: list[int], blind: set[int], capacity: int, shards: int) -> list[int] | None:
    """As `greedy`, but a shard may also end wherever unknown borders lie: below the known borders `blind`.
    The furthest each shard can end; None if even so `shards` are not enough."""
    cuts, at = [], 0
    while at < ends[-1]:
        k = bisect_right(ends, at + capacity)
        fits = at + capacity if k < len(ends) and ends[k] in blind else ends[k - 1] if k else 0
        if fits <= at or len(cuts) == shards:
            return None
        cuts.append(fits)
        at = fits
    return cuts


def smallest(low: int, high: int, feasible) -> int:
    """The smallest feasible capacity from low to high, where high is feasible."""
    while low < high:
        middle = (low + high) // 2
        if feasible(middle):
            high = middle
        else:
            low = middle + 1
    return low


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], high)
        else:
            out.append((low, high))
    return out


def minimax(groups: DataFrame, end: str, size: str, shards: int, resolution: int = RESOLUTION) -> tuple[int, list[int]]:
    """The smallest capacity and the running sums at which shards end.

    `groups` has the running sum `end` after each group and its `size`; groups of no size do not matter.
    """
    sized = groups.filter(F.col(size) > 0)
    total, largest, many = sized.agg(F.max(end), F.max(size), F.count("*")).first()
    if not many:
        return 0, []
    low, high = max(largest, -(-total // shards)), total
    spans, known, blind = [(0, total)], {total}, set()
    while True:
        inside = F.exists(F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for a, b in spans]), lambda s: (F.col(end) > s["a"]) & (F.col(end) <= s["b"]))
        wide = sum(b - a for a, b in spans)
        step = max(1, -(-wide // resolution))
        cells = sized.filter(inside).groupBy(F.expr(f"{end} div {step}").alias("cell")).agg(F.max(end).alias("last"), F.count("*").alias("n")).collect()
        known |= {c["last"] for c in cells}
        ends, unknown = sorted(known), {c["cell"]: c["n"] for c in cells}
        looked_at = [x for a, b in spans for x in ends[bisect_right(ends, a) : bisect_right(ends, b)]]
        for x in looked_at:
            unknown[x // step] -= 1
        blind = blind - set(looked_at) | {x for x in looked_at if unknown[x // step]}
        # to cut at known borders only is one way to cut: its best capacity is feasible; what fails even with
        # borders wherever some are unknown is not
        high = smallest(low, high, lambda c: greedy(ends, c, shards))
        low = smallest(low, high, lambda c: hopeful(ends, blind, c, shards))
        if low == high:
            return high, greedy(ends, high, shards)
        # under any capacity from low to high, a shard ends no earlier than with the least capacity and known
        # borders, and no later than with the greatest and hoped-for borders
        latest = hopeful(ends, blind, high, shards)
        spans, early = [], 0
        for late in [*latest, *[total] * (shards - len(latest))]:
            reach = bisect_right(ends, early + low)
            early = max(early, ends[reach - 1] if reach else 0)
            if early < late:
                spans.append((early, ends[bisect_left(ends, late)]))  # whole gaps between known borders
        narrowed = _merged(spans)
        if 2 * sum(b - a for a, b in narrowed) > wide:
            resolution *= 2  # too coarse to tell the shards' cuts apart
        spans = narrowed


def shard(docs: DataFrame, shards: int, text: str = "text", order: str = "doc_id") -> tuple[DataFrame, int]:
    """`docs` with size, text_crc32, shard and slot; and the capacity, the largest shard's bytes.

    A row's size is the UTF-8 bytes of its text and 16 more. Slots count from 0 in each shard, group after
    group; inside a group rows are numbered by ranges of hashes of `order`, each of about `ROWS_TOGETHER`
    rows, so that a group of any size is numbered by many tasks.
    """
    base = docs.drop("size", "text_crc32", "shard", "slot").select(
        "*",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.md5(F.col(text).cast("binary")), F.lit("0" * 32)).alias("key"),
        F.xxhash64(F.col(order).cast("string")).alias("_spread"),
    )
    base = base.drop(text)
    groups = base.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    groups = common.stored(running(groups, "bytes", "rows"), "groups")
    capacity, cuts = minimax(groups, "bytes_end", "bytes", shards)
    borders = F.array(*[F.lit(c).cast("long") for c in cuts[:-1]]).cast("array<long>")
    groups = groups.withColumn("shard", F.size(F.filter(borders, lambda c: c < F.col("bytes_end"))))
    starts = groups.groupBy("shard").agg(F.min(F.col("rows_end") - F.col("rows")).alias("_shard_start"))
    groups = groups.join(starts, "shard").select("key", "shard", "rows", (F.col("rows_end") - F.col("rows") - F.col("_shard_start")).alias("_group_start"))
    rows = base.join(groups, "key").withColumn("_part", F.pmod(F.col("_spread"), F.ceil(F.col("rows") / ROWS_TOGETHER)).cast("long"))
    parts = rows.filter(F.col("rows") > ROWS_TOGETHER).groupBy("key", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("key", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_part_start"))
    inside = Window.partitionBy("key", "_part").orderBy("_spread", order)
    rows = rows.withColumn("_place", F.row_number().over(inside) - 1).join(parts, ["key", "_part"], "left")
    slot = F.col("_group_start") + F.coalesce("_part_start", F.lit(0)) + F.col("_place")
    kept = [c for c in docs.columns if c not in ("size", "text_crc32", "shard", "slot", text)]
    return rows.select(*kept, "size", "text_crc32", "shard", slot.cast("long").alias("slot")), capacity
