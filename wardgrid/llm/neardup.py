"""Near-duplicate documents by b-bit MinHash.

Each text's set is its distinct shingles of five words (the whole of a shorter text). Equal sets are one
class, so exact copies cost one row each and no comparison. Of each class's minima, bands of `ROWS` minima
name buckets. For the estimate the range of hashes is cut into `BINS` parts, and the low `BITS` bits of the
minimum in each part are packed into words of 64 bits, beside a bit that says whether the part holds anything.
The share of equal minima among parts that hold something, counted with bit_count and corrected for chance
matches (two different minima agree in b bits with probability 2^-b), estimates the Jaccard similarity. A second
signature of `PARITY` bits, one flipped by each shingle, counts in the same way by how many shingles two sets differ,
which is sharp where sets are small or nearly alike. A pair goes on if both estimates are within `ERRORS` standard
errors of the threshold. Classes that share a bucket and are estimated near are verified on their full sets, read
from their texts again.

Links are found in two steps, so that a bucket of many copies does not become all its pairs:
1. In each bucket all classes are compared with the one that shares most buckets with others: in a group of
   edited copies, the original or whatever is nearest to it.
2. Components of the verified links are formed. Only classes of the same bucket that are still in
   different components are compared with each other, all of them. Whatever was left out joins classes that
   are connected anyway, so components are those of all links between candidates.

Bands are as many as it takes (`banding`) for two texts at the threshold to miss each other in all of them in less than
`MISSED` of pairs; an estimate six standard errors off is rarer than that.

A null text, or one without words, has an empty set and is linked with nothing. Equal rows are in one class;
rows without an id are placed by their text's class (a class of such rows only has a null component_id, and
they are kept). `one_of_each` keeps a single row of each group, of repeated rows and of rows without an id as well.
Empty tables give empty results. Texts are used whole. `component_id` and the other result
columns replace columns of those names; other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardgrid.llm import common
from wardgrid.llm.components import connected
from wardgrid.llm.shingles import MinHash, runs, shingles, words

SHINGLE = 5
MISSED = 3e-7
BINS, BITS = 1024, 4
HELD, WORDS = BINS // 64, BINS * BITS // 64
PARITY = 2048
ERRORS = 6

SIGNED = "doc_id long, text_hash long, n_shingles long, class binary, bands array<long>, bits array<long>"
SIGNED_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
RESULT = ("n_shingles", "component_id", "kept")


def sets_of(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of each text."""
    for begin, end in runs(texts):
        hashes, first = words(texts.slice(begin, end - begin))
        for k in range(end - begin):
            yield shingles(hashes[first[k] : first[k + 1]], SHINGLE)


def banding(percent: int) -> tuple[int, int]:
    """Bands and minima a band for texts at a similarity of `percent`: rows so that a bucket holds few others."""
    rows = 6 if percent >= 85 else 5
    return ceil(log(MISSED) / log(1 - (percent / 100) ** rows)), rows


def packed(found: np.ndarray) -> list[int]:
    """From sorted hashes: a bit for each part of their range that holds one, then the low bits of the least
    hash in each part, `64 // BITS` to a signed 64-bit integer, then the bits that each hash flips."""
    part = (found >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(part, prepend=-1))
    held, fields = np.zeros(BINS, np.uint64), np.zeros(BINS, np.uint64)
    held[part[first]] = 1
    fields[part[first]] = found[first] & np.uint64((1 << BITS) - 1)
    bits = np.bitwise_or.reduce(held.reshape(HELD, 64) << np.arange(64, dtype=np.uint64), axis=1)
    shifts = np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)
    low = np.bitwise_or.reduce(fields.reshape(WORDS, -1) << shifts, axis=1)
    # a middle part of the hash, as the minima are chosen by the upper bits and show the lower
    odd = (np.bincount((found >> np.uint64(16) & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY) & 1).astype(np.uint64)
    flipped = np.bitwise_or.reduce(odd.reshape(-1, 64) << np.arange(64, dtype=np.uint64), axis=1)
    return np.concatenate([bits, low, flipped]).view(np.int64).tolist()


def band_keys(minima: np.ndarray, bands: int) -> list[int]:
    rows = np.ascontiguousarray(minima.reshape(bands, -1))
    return [int.from_bytes(hashlib.blake2b(bytes([k]) + r.tobytes(), digest_size=8).digest(), "little", signed=True) for k, r in enumerate(rows)]


def _signed(bands: int, size: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions, names = MinHash(bands * size), [x.split()[0] for x in SIGNED.split(", ")]
        for batch in batches:
            rows = []
            for found in sets_of(batch.column(2)):
                if len(found):
                    minima = functions.minima(found)
                    rows.append((len(found), hashlib.blake2b(found.tobytes(), digest_size=16).digest(), band_keys(minima, bands), packed(found)))
                else:
                    rows.append((0, None, None, None))
            columns = [batch.column(0), batch.column(1), *([x[k] for x in rows] for k in range(4))]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, kind) for c, kind in zip(columns, SIGNED_TYPES, strict=True)], names=names)

    return sign


def signed(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, text_hash, n_shingles, class, bands, bits) for each row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(_signed(*banding(percent)), SIGNED)


def _counted(left: Column, right: Column, begin: int, size: int, differ) -> Column:
    """The bits set in `differ` of two words, over `size` words of both signatures from `begin`."""
    words = F.zip_with(F.slice(left, begin + 1, size), F.slice(right, begin + 1, size), lambda x, y: F.bit_count(differ(x, y)))
    return F.aggregate(words, F.lit(0), lambda sum_, n: sum_ + n)


def _unequal_fields(x: Column, y: Column) -> Column:
    # a field differs if any of its four bits does; empty parts have the field 0
    off = x.bitwiseXOR(y)
    off = off.bitwiseOR(F.shiftrightunsigned(off, 1))
    return off.bitwiseOR(F.shiftrightunsigned(off, 2)).bitwiseAND(F.lit(int("0001" * 16, 2)))


def estimate(left: Column, right: Column) -> tuple[Column, Column]:
    """Jaccard similarity from two signatures, equal minima by bit counts less those equal by chance; and the
    number of parts it rests on."""
    either = _counted(left, right, 0, HELD, lambda x, y: x.bitwiseOR(y))
    both = _counted(left, right, 0, HELD, lambda x, y: x.bitwiseAND(y))
    differing = _counted(left, right, HELD, WORDS, _unequal_fields)
    # parts that one side holds differ for sure, and show in the fields unless theirs is 0
    alone, chance = either - both, 2.0**-BITS
    unequal = (differing - alone * (1 - chance)) / (1 - chance)
    return (both - unequal) / F.greatest(either, F.lit(1)), either


def flips(shingles: Column) -> Column:
    """How many parity bits may differ, at most, of sets that differ in so many shingles: that number itself, or
    the mean and `ERRORS` standard deviations of shingles that fall on bits at random."""
    once, twice = F.pow(F.lit(1 - 2 / PARITY), shingles), F.pow(F.lit(1 - 4 / PARITY), shingles)
    variance = PARITY / 4 * (1 - once * once) + PARITY * (PARITY - 1) / 4 * (twice - once * once)
    return F.least(shingles, PARITY / 2 * (1 - once) + ERRORS * F.sqrt(F.greatest(variance, F.lit(0.0))) + 1)


def likely(least: float) -> Column:
    """Whether sizes n and signatures bits of the sides a and b allow a similarity of `least`."""
    a, b, larger = F.col("bits_a"), F.col("bits_b"), F.greatest("n_a", "n_b")
    odd = _counted(a, b, HELD + WORDS, PARITY // 64, lambda x, y: x.bitwiseXOR(y))
    apart = F.floor((1 - least) / (1 + least) * (F.col("n_a") + F.col("n_b")) + 1e-6)
    similar, parts = estimate(a, b)
    chance = least + (1 - least) * 2.0**-BITS
    error = sqrt(chance * (1 - chance)) / (1 - 2.0**-BITS) / F.sqrt(F.greatest(parts, F.lit(1)))
    return (F.least("n_a", "n_b") >= larger * least) & (odd <= flips(apart)) & (similar >= least - ERRORS * error - 1 / larger)


def _verified(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for a, b in zip(sets_of(batch.column(2)), sets_of(batch.column(3)), strict=True):
                shared = len(np.intersect1d(a, b, assume_unique=True))
                near.append(100 * shared >= percent * (len(a) + len(b) - shared))
            keep = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return verify


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are near enough."""
    sides = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("_a")), "a")
    sides = sides.join(texts.select(F.col("node").alias("b"), F.col("text").alias("_b")), "b")
    return sides.select("a", "b", "_a", "_b").mapInArrow(_verified(percent), "a long, b long")


def classes_of(rows: DataFrame) -> DataFrame:
    """(node, class, doc_id, text_hash, n, bands, bits): a row for each class with words, with one of its rows."""
    row = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash", F.col("n_shingles").alias("n"), "bands", "bits")
    chosen = rows.filter("class is not null").groupBy("class").agg(F.min(row).alias("r"))
    return chosen.select("class", "r.doc_id", "r.text_hash", "r.n", "r.bands", "r.bits").withColumn("node", F.monotonically_increasing_id())


def links(docs: DataFrame, classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b) between classes, and the components (node, component) they make."""
    least = percent / 100
    bands = classes.select("node", F.explode("bands").alias("band"))
    crowded = bands.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1")
    shared = common.stored(bands.join(crowded, "band"), "buckets")
    weight = shared.groupBy("node").agg(F.sum("members").alias("weight"))
    signatures = common.stored(weight.join(classes, "node").select("node", "weight", "doc_id", "text_hash", "n", "bits"), "signatures")
    # texts only of classes that share a bucket, read once; both sides grow with the documents
    source = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").alias("d")
    wanted = signatures.select("node", "doc_id", "text_hash").alias("s").hint("merge")
    texts = source.join(wanted, common.same("d", "s", "doc_id", "text_hash")).select("s.node", "d.text")
    texts = common.stored(texts, "texts").dropDuplicates(["node"])

    def near(pairs: DataFrame) -> DataFrame:
        """Pairs that sizes and signatures allow."""
        for side in ("a", "b"):
            pairs = pairs.join(signatures.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")), side)
        return pairs.filter(likely(least)).select("a", "b")

    ranked = shared.join(weight, "node").select("band", F.struct("weight", "node").alias("by_weight"))
    leaders = ranked.groupBy("band").agg(F.max("by_weight")["node"].alias("leader"))
    stars = shared.join(leaders, "band").filter("node <> leader")
    stars = stars.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    found = common.stored(_confirmed(near(stars), texts, percent), "links")
    parts = connected(found)
    labelled = shared.join(parts, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    open_buckets = labelled.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("band")
    still = common.stored(labelled.join(open_buckets, "band").join(signatures.select("node", "n", "bits"), "node"), "open")
    left, right = (still.select("band", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "component", "n", "bits")]) for side in ("a", "b"))
    across = (F.col("component_a") < F.col("component_b")) & likely(least)
    rest = left.withColumnRenamed("band", "band_a").join(right.withColumnRenamed("band", "band_b"), (F.col("band_a") == F.col("band_b")) & across)
    rest = rest.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()
    more = common.stored(_confirmed(rest.join(found, ["a", "b"], "left_anti"), texts, percent), "links")
    if more.isEmpty():
        return found, parts
    found = found.unionByName(more)
    return found, connected(found)


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, class, component, component_id, copies): a row for all that are alike in
    doc_id and text, `copies` of them."""
    rows = common.stored(signed(docs, percent), "signed")
    classes = common.stored(classes_of(rows), "classes")
    _, parts = links(docs, classes, percent)
    named = classes.select("node", "class", "doc_id").join(parts, "node", "left").select("class", "doc_id", F.coalesce("component", "node").alias("component"))
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_class = named.join(smallest, "component").select("class", "component", "component_id")
    return rows.groupBy("doc_id", "text_hash", "n_shingles", "class").agg(F.count("*").alias("copies")).join(by_class, "class", "left")


def cluster(docs: DataFrame, percent: int = 80) -> DataFrame:
    """`docs` (doc_id, text, ...) with n_shingles, component_id and kept: texts are linked if a hundred times
    their shared shingles are at least `percent` times their joint shingles."""
    component_id = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    by_row = _grouped(docs, percent).select("doc_id", "text_hash", "n_shingles", component_id)
    return by_row.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of `docs`, without all but one of each group of near duplicates: that with the smallest id, of
    several texts under it that with the smallest hash, and one of repeated rows. A group without any id keeps the
    one with the smallest hash. Rows without words are in no group and stay."""
    grouped = common.stored(_grouped(docs, percent), "grouped")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
    members = grouped.filter("class is not null")
    first = members.groupBy("component").agg(F.min(F.struct(place.alias("place"), "copies")).alias("r"))
    chosen = first.select("r.place.doc_id", "r.place.text_hash", "r.copies")
    chosen = chosen.unionByName(grouped.filter("class is null").select("doc_id", "text_hash", F.lit(1).cast("long").alias("copies")))
    source = docs.withColumn("_row_hash", F.xxhash64("text"))
    at = F.col("d.doc_id").cast("long").eqNullSafe(F.col("c.doc_id")) & (F.col("d._row_hash") == F.col("c.text_hash"))
    found = source.alias("d").join(chosen.alias("c"), at).select("d.*", F.col("c.copies").alias("_row_copies"))
    # of rows alike in id and text one is taken, with a map-side aggregation and only where there are several
    several = found.filter("_row_copies > 1").dropDuplicates(["doc_id", "_row_hash"])
    return found.filter("_row_copies = 1").unionByName(several).select(*[F.col(f"`{c}`") for c in docs.columns])


def marked(docs: DataFrame, percent: int = 80) -> DataFrame:
    """All of `docs` and its columns, with n_shingles, component_id and kept."""
    found = cluster(docs, percent)
    source = docs.drop(*RESULT, "text_hash").withColumn("text_hash", F.xxhash64("text"))
    joined = source.alias("d").join(found.alias("f"), common.same("d", "f", "doc_id", "text_hash"), "left")
    return joined.select(*[F.col(f"d.`{c}`") for c in source.columns if c != "text_hash"], *[f"f.{c}" for c in RESULT])
