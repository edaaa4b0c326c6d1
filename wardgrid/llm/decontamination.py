"""Benchmark decontamination by a prefix-filtered join with exact containment.

A window is 13 consecutive words of a benchmark item, or the whole of a shorter item. A document contains a
window only if it contains each of its words, so one word decides the candidates: words are ordered by how
rare they are in the documents, and the rarest of each window is its prefix. Document words are joined with
those; the word's place in the window gives the only place where the window can lie, which must be within the
document (positional and length bound), and the words there are compared one by one.

Windows are broadcast in parts of at most `PART_BYTES`, measured before; more parts mean more passes over the
documents, never a shuffle of their words. All work is DataFrame operations.

Null texts have no words. Items without an id or without words are no items. Equal rows (id and text) are one
document and get equal results; rows without a doc_id are documents too. Empty tables give no items and an
empty result. Other columns pass through `decide`; those named like the result's are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.llm import common

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
PART_BYTES = 32 << 20
RESULT = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def words_of(text: Column) -> Column:
    """Words of A-Z lower-cased text: runs of digits, a-z and all beyond ASCII."""
    return F.array_remove(F.split(common.lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def windows_of(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """Distinct windows: (window, words, items)."""
    worded = items.filter("item_id is not null").select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    cut = worded.select("item_id", F.explode(F.transform(starts, lambda s: F.slice(F.col("w"), s, F.least(F.lit(width), F.size("w"))))).alias("words"))
    return cut.groupBy("words").agg(F.collect_set("item_id").alias("items")).select(F.monotonically_increasing_id().alias("window"), "words", "items")


def _parts(windows: DataFrame, words: Column) -> list[DataFrame]:
    """The windows in parts that may be broadcast."""
    size = windows.agg(F.sum(F.aggregate(words, F.lit(64), lambda n, x: n + F.octet_length(x) + 24))).first()[0] or 0
    many = max(1, -(-size // PART_BYTES))
    return [windows if many == 1 else windows.filter(F.pmod(F.xxhash64("window"), F.lit(many)) == k) for k in range(many)]


def rarest(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """`windows` with its rarest word, and that word's place: (window, words, token, place)."""
    tokens = windows.select("window", F.posexplode("words").alias("place", "token"))
    counts = None
    for part in _parts(windows, F.col("words")):
        wanted = part.select(F.explode("words").alias("token")).distinct()
        found = docs.select(F.explode(words_of(F.col("text"))).alias("token")).join(F.broadcast(wanted), "token").groupBy("token").agg(F.count("*").alias("n"))
        counts = found if counts is None else counts.unionByName(found)
    counts = counts.groupBy("token").agg(F.max("n").alias("n"))
    first = tokens.join(counts, "token", "left").groupBy("window").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "place")).alias("first"))
    return windows.join(first, "window").select("window", "words", F.col("first.token").alias("token"), F.col("first.place").alias("place"))


def occurrences(docs: DataFrame, probes: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, n, window) for each occurrence of a window in a document."""
    placed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("w"))
    placed = placed.select("doc_id", "text_hash", "w", F.posexplode("w").alias("at", "token"))
    out = None
    for part in _parts(probes, F.col("words")):
        start = F.col("at") - F.col("place")
        fits = (start >= 0) & (start + F.size("words") <= F.size("w"))
        met = placed.join(F.broadcast(part), "token").filter(fits)
        # slices of the few candidates are compared, and only those travel on
        met = met.filter(F.slice("w", F.greatest(start + 1, F.lit(1)), F.size("words")) == F.col("words"))
        met = met.select("doc_id", "text_hash", start.alias("start"), F.size("words").alias("n"), "window")
        out = met if out is None else out.unionByName(met)
    return out


def decide(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """`docs` (doc_id, text, ...) with `RESULT`: a document is contaminated if at least a twentieth of its
    words lie in occurrences of windows."""
    windows = common.stored(windows_of(items, width), "windows")
    probes = common.stored(rarest(docs, windows), "probes")
    found = common.stored(occurrences(docs, probes), "occurrences")
    key = ["doc_id", "text_hash"]
    # spans in order; each adds the words past those already counted
    spans = F.array_sort(F.collect_set(F.struct("start", "n")))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit")),
        lambda a, x: F.struct(
            F.greatest(a["end"], x["start"] + x["n"]).alias("end"),
            (a["hit"] + F.greatest(F.lit(0), x["start"] + x["n"] - F.greatest(a["end"], x["start"]))).alias("hit"),
        ),
    )["hit"]
    hits = found.groupBy(*key).agg(spans.alias("spans")).select(*key, covered.cast("long").alias("n_hit"))
    named = found.select(*key, "window").distinct().join(windows.select("window", F.explode("items").alias("item")), "window")
    named = named.groupBy(*key).agg(F.array_sort(F.collect_set("item")).alias("items")).select(*key, F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"))
    both = hits.alias("h").join(named.alias("n"), common.same("h", "n", *key)).select("h.*", "n.n_items", "n.items_sha256")
    left = docs.drop(*RESULT, "text_hash").withColumns({"text_hash": F.xxhash64("text"), "n_words": F.size(words_of(F.col("text"))).cast("long")})
    joined = left.alias("d").join(both.alias("b"), common.same("d", "b", *key), "left")
    n_hit = F.coalesce("b.n_hit", F.lit(0).cast("long"))
    return joined.select(
        *[F.col(f"d.`{c}`") for c in left.columns if c != "text_hash"],
        n_hit.alias("n_hit"),
        F.coalesce("b.n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("b.items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("d.n_words"))).alias("contaminated"),
    )
