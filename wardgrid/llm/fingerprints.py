"""MinHash fingerprints of documents.

A fingerprint is the list of minima of `HASHES` universal hash functions over the shingles of five words, 16
bits each; the share of equal places estimates the Jaccard similarity of two texts' shingles. Minima are
computed in numpy, some texts at a time; everything that moves rows is Spark's.

`near_pairs` joins bands of the signatures and verifies Jaccard on the full sets. `with_edits` sorts the
documents into ranges of ids, where each row meets the next one as the rows stream by; only the last row of a
range is joined with the first of the following range.

Nulls are empty texts; a text without words has the fingerprint of the empty set, which is like itself only
(likeness 1) and in no pair; a text of fewer than five words is one shingle. Equal texts have equal
fingerprints. Rows that tie on the id are ordered by their text, rows without an id come first, and each row
counts. The only row of a table is its own successor. An empty table gives an empty result. Other columns do
not pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.llm import common
from wardgrid.llm.shingles import MinHash, runs, shingles, words

HASHES = 128
SHINGLE = 5
BANDS = 32
SIMILARITY = 0.8

PAIRED = "kind int, part int, doc_id long, text string, n_chars long, edited_sha256 string, signature binary, edited_signature binary, near_edited double, near_next double"
DONE, HEAD, TAIL = 0, 1, 2


def minima_of(texts: pa.Array, functions: MinHash, size: int = SHINGLE) -> np.ndarray:
    """A row of 16-bit minima for each text."""
    out = np.empty((len(texts), functions.count), np.uint16)
    for begin, end in runs(texts):
        hashes, first = words(texts.slice(begin, end - begin))
        for k in range(end - begin):
            # the low bits, which differ where the minima do; the high ones are alike in long texts
            out[begin + k] = functions.minima(shingles(hashes[first[k] : first[k + 1]], size)) & 0xFFFF
    return out


def binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())


def _edited(functions: MinHash, texts: list[str], following: list[str], own: np.ndarray, after: np.ndarray) -> dict[str, pa.Array]:
    """Columns for texts whose last quarter is replaced by the beginning of the text that follows."""
    cuts = [len(x) // 4 for x in texts]
    edits = pa.array([x[: len(x) - n] + y[:n] for x, y, n in zip(texts, following, cuts, strict=True)], pa.string())
    minima = minima_of(edits, functions)
    return {
        "n_chars": pa.array([len(x) for x in texts], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edits.to_pylist()], pa.string()),
        "signature": binary(own),
        "edited_signature": binary(minima),
        "near_edited": pa.array((own == minima).mean(axis=1) if len(texts) else [], pa.float64()),
        "near_next": pa.array((own == after).mean(axis=1) if len(texts) else [], pa.float64()),
    }


def _rows(n: int, columns: dict[str, object]) -> pa.RecordBatch:
    names = [x.split()[0] for x in PAIRED.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}
    types = [kinds[x.split()[1]] for x in PAIRED.split(", ")]
    arrays = []
    for name, kind in zip(names, types, strict=True):
        value = columns.get(name)
        arrays.append(value.cast(kind) if isinstance(value, (pa.Array, pa.ChunkedArray)) else pa.array([value] * n, kind))
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted range (doc_id, text): each with its successor, the first and last marked."""
    functions, part = MinHash(HASHES), TaskContext.get().partitionId()
    last: tuple[int | None, str, np.ndarray] | None = None
    for whole in batches:
        for begin, end in runs(whole.column(1)):
            batch = whole.slice(begin, end - begin)
            ids, column = batch.column(0).to_pylist(), batch.column(1).fill_null("")
            texts, minima = column.to_pylist(), minima_of(column, functions)
            if last is None:
                yield _rows(1, {"kind": HEAD, "part": part, "text": texts[0], "signature": binary(minima[:1])})
            else:
                ids, texts, minima = [last[0], *ids], [last[1], *texts], np.vstack([last[2], minima])
            n = len(ids) - 1
            if n:
                yield _rows(n, {"kind": DONE, "part": part, "doc_id": pa.array(ids[:n], pa.int64())} | _edited(functions, texts[:n], texts[1:], minima[:n], minima[1:]))
            last = ids[n], texts[n], minima[n : n + 1]
    if last is not None:
        yield _rows(1, {"kind": TAIL, "part": part, "doc_id": last[0], "text": last[1], "signature": binary(last[2])})


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last row of a range (doc_id, text, signature) with the text and signature that follow."""
    functions = MinHash(HASHES)
    for batch in batches:
        for k in range(batch.num_rows):
            doc_id, text, own, following, after = (batch.column(c)[k].as_py() for c in range(5))
            own, after = (np.frombuffer(x, np.uint16)[None, :] for x in (own, after))
            yield _rows(1, {"kind": DONE, "doc_id": doc_id} | _edited(functions, [text], [following], own, after))


def with_edits(docs: DataFrame) -> DataFrame:
    """For (doc_id, text): the fingerprint of each text and of its edited text, and how like they and the
    next document's are."""
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), "_tie")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_tie")
        .select("doc_id", "text")
    )
    rows = common.stored(ordered.mapInArrow(_in_order, PAIRED), "fingerprints", together=False)
    tails = rows.filter(F.col("kind") == TAIL).select("part", "doc_id", "text", "signature")
    heads = rows.filter(F.col("kind") == HEAD).select(F.col("part").alias("_next"), F.col("text").alias("_text"), F.col("signature").alias("_signature"))
    # one row a range: its number and the number of the one that follows, the first after the last
    ring = Window.orderBy("_next")
    everything = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select("_next").select(F.col("_next").alias("part"), F.coalesce(F.lead("_next").over(ring), F.min("_next").over(everything)).alias("_next"))
    across = tails.join(after, "part").join(heads, "_next").select("doc_id", "text", "signature", "_text", "_signature")
    done = rows.filter(F.col("kind") == DONE).unionByName(across.mapInArrow(_across, PAIRED))
    return done.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("signature")).alias("fingerprint"),
        F.lower(F.hex("edited_signature")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text with words: a digest of its shingles, and the hash of each band of its minima."""
    functions, width = MinHash(HASHES), HASHES // BANDS
    for whole in batches:
        for begin, end in runs(whole.column(1)):
            batch = whole.slice(begin, end - begin)
            hashes, first = words(batch.column(1))
            sets = [shingles(hashes[first[k] : first[k + 1]], SHINGLE) for k in range(batch.num_rows)]
            full = [k for k, x in enumerate(sets) if len(x)]
            bands = [[int.from_bytes(hashlib.blake2b(bytes([b]) + r.tobytes(), digest_size=8).digest(), "little", signed=True) for b, r in enumerate(functions.minima(sets[k]).reshape(BANDS, width))] for k in full]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(full, pa.int64())),
                    pa.array([hashlib.blake2b(sets[k].tobytes(), digest_size=16).digest() for k in full], pa.binary()),
                    pa.array([sets[k].astype("<u8").view("<i8").tolist() for k in full], pa.list_(pa.int64())),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "set_key", "hashes", "bands"],
            )


def near_pairs(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Classes of equal shingle sets, and verified pairs between them.

    Returns (doc_id, class_id) for all documents with words, and (left_id, right_id, jaccard) between class
    ids, `jaccard >= similarity`. A class is named by its smallest doc_id; repeated ids should not occur here.
    """
    signed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_banded, "doc_id long, set_key binary, hashes array<long>, bands array<long>")
    signed = common.stored(signed, "bands")
    classes = signed.groupBy("set_key").agg(F.min("doc_id").alias("class_id"))
    members = signed.select("doc_id", "set_key").join(classes, "set_key").select("doc_id", "class_id")
    leaders = signed.join(classes.select(F.col("class_id").alias("doc_id"), F.col("set_key").alias("_key")), "doc_id", "left_semi")
    bands = leaders.select("doc_id", F.size("hashes").alias("n"), F.explode("bands").alias("band"))
    left, right = (bands.select(F.col("doc_id").alias(f"{side}_id"), F.col("n").alias(f"{side}_n"), "band") for side in ("left", "right"))
    sized = (F.least("left_n", "right_n") >= F.greatest("left_n", "right_n") * similarity) & (F.col("left_id") < F.col("right_id"))
    pairs = left.join(right, "band").filter(sized).select("left_id", "right_id").distinct()
    sets = leaders.select("doc_id", "hashes")
    both = pairs.join(sets.toDF("left_id", "_left"), "left_id").join(sets.toDF("right_id", "_right"), "right_id")
    shared = F.size(F.array_intersect("_left", "_right"))
    jaccard = shared / (F.size("_left") + F.size("_right") - shared)
    return members, both.select("left_id", "right_id", jaccard.alias("jaccard")).filter(F.col("jaccard") >= similarity)
