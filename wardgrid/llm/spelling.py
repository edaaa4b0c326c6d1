"""Spelling variants: words of a corpus at one edit from each other, and the form each one stands for.

Words are counted over all texts in Python by partition: a document's runs of letters are cut and counted in C, a
run is altered where its hash says so, and partial counts go to Spark whenever `HELD` words are held.

Near words are found by dynamic programming over sorted lists. A word is compared with a whole sorted list at once:
the list is walked by its shared prefixes, the row of the edit matrix that belongs to a prefix is computed once for
all words that begin with it (the longest common prefix with the word before says how far rows can be kept), rows
are as narrow as one edit allows, and a range of the list is left as soon as its prefix is beyond one edit. All
words of a list go down together, a depth at a time, in numpy. Since words are compared with words as long or one
letter longer, a row has two entries: the word's prefix as long as the list's, and the one a letter shorter.

Lists are short because one edit spares half of a word. Words of length m and m + 1 at one edit share their first
m // 2 letters or the other m - m // 2 letters at the end; so the vocabulary is dealt into lists by (m, first half)
and by (m, last half), and only what lies between the shared ends is compared. A list of more than `LIMIT` words is
dealt again by halves of what its words don't share, until all lists are short; where a single letter is left, the
alphabet bounds them. A pair belongs to one list only: by the place where the two words first differ.

A null text has no words. A null doc_id counts as no text before the colon of the hashed name. Rows alike count
each. An empty table, or one without words that are long and frequent enough, gives no rows; other columns are not
read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.llm import common

ALTERED = 97
SHORTEST, RAREST = 5, 3
TIMES = 2  # a form is so many times as frequent
HELD = 200_000
LIMIT = 20_000
TOGETHER = 20_000  # rows of lists that are walked at once
RESULT = ("word", "form", "root", "n", "n_near", "form_n")

LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


# --- words -------------------------------------------------------------------


def altered(name: bytes, word: bytes) -> bytes:
    """A run (Latin-1) as it counts in the document `name`: without one letter if its hash is a multiple."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), zlib.crc32(name))
    if h % ALTERED:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1 :]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[bytes] = Counter()

    def rows() -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        for number, text in zip(batch.column(0), batch.column(1), strict=True):
            if not text.is_valid:
                continue
            name = b":" if not number.is_valid else b"%d:" % number.as_py()
            # a letter is one byte; whatever is not Latin-1 is no letter
            found = Counter(text.as_py().encode("latin-1", "replace").translate(LETTERS).split())
            for word, n in found.items():
                word = altered(name, word)
                if len(word) >= SHORTEST:
                    held[word] += n
            if len(held) > HELD:
                yield rows()
                held.clear()
    yield rows()


def vocabulary(docs: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(word, n) of all words that are long and frequent enough."""
    parts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_counted, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= rarest)


# --- lists -------------------------------------------------------------------

LIST = ["m", "front", "back", "prefix", "suffix"]
ENTRY = [*LIST, "before", "middle", "n"]


def _entries(words: DataFrame, front: Column, back: Column, before: Column) -> DataFrame:
    """Rows (word, m, n) filed by their first `front` and last `back` letters; a pair counts if the words first
    differ before the place `before`."""
    filed = words.select("word", "m", "n", front.cast("int").alias("front"), back.cast("int").alias("back"), before.cast("int").alias("before"))
    rest = F.length("word") - F.col("front") - F.col("back")
    return filed.select(
        "m", "front", "back",
        F.substring("word", F.lit(1), F.col("front")).alias("prefix"),
        F.substring("word", F.col("front") + rest + 1, F.col("back")).alias("suffix"),
        "before",
        F.substring("word", F.col("front") + 1, rest).alias("middle"),
        "n",
    )


def _halves(words: DataFrame, front: Column, back: Column, before: Column) -> DataFrame:
    half = F.floor((F.col("m") - front - back) / 2)
    ahead = _entries(words, front + half, back, before)
    return ahead.unionByName(_entries(words, front, F.col("m") - front - half, front + half))


def lists(vocabulary: DataFrame, limit: int = LIMIT, few: int = common.FEW) -> DataFrame:
    """The vocabulary dealt into lists of at most `limit` rows (`ENTRY`), or of one letter between shared ends."""
    length = F.length("word")
    # a word meets those as long or a letter longer under its own length, and shorter ones under theirs
    lengths = F.when(length > SHORTEST, F.array(length, length - 1)).otherwise(F.array(length))
    words = vocabulary.select("word", "n", F.explode(lengths).alias("m"))
    rows = _halves(words, F.lit(0), F.lit(0), F.lit(1 << 30))
    done: DataFrame | None = None
    while True:
        crowded = rows.filter(F.col("m") - F.col("front") - F.col("back") > 1).groupBy(*LIST).count().filter(F.col("count") > limit)
        crowded = common.stored(crowded.select(*LIST), "crowded")
        if crowded.isEmpty():
            return rows if done is None else done.unionByName(rows)
        drawn = rows.withColumn("draw", F.xxhash64("middle"))
        short = common.beside(drawn, crowded, LIST, "draw", few, "left_anti").drop("draw")
        done = short if done is None else done.unionByName(short)
        long = common.beside(drawn, crowded, LIST, "draw", few, "left_semi")
        again = long.select(F.concat("prefix", "middle", "suffix").alias("word"), "m", "n", "front", "back", "before")
        rows = common.stored(_halves(again.select("word", "m", "n", *[F.col(c).alias(f"_{c}") for c in ("front", "back", "before")]), F.col("_front"), F.col("_back"), F.col("_before")), "halves")


# --- the walk ----------------------------------------------------------------


def walk(letters: np.ndarray, lengths: np.ndarray, owner: np.ndarray, asking: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (asking row, other row of its list) at one edit, the other as long or one letter longer.

    `letters`: a row of code points a word, filled up with 0; rows are sorted by list (`owner`) and word.
    """
    rows, width = letters.shape
    unequal = np.ones((rows, width + 1), bool)
    unequal[1:, :width] = letters[1:] != letters[:-1]
    shared = unequal.argmax(axis=1)  # with the row before
    shared[np.flatnonzero(np.diff(owner, prepend=-1))] = -1
    starts = np.flatnonzero(shared < 0)
    query, node = asking, np.searchsorted(starts, asking, "right") - 1
    equal, shorter = np.zeros(len(query), np.int8), np.full(len(query), 2, np.int8)
    left, right = [], []
    for depth in range(width + 1):
        # a word that ends here is the first of its range
        first = starts[node]
        over = lengths[first] == depth
        gap = lengths[query] - depth
        hit = over & np.where(gap == 0, equal == 1, (gap == -1) & (shorter == 1))
        left.append(query[hit])
        right.append(first[hit])
        if depth == width:
            break
        below = np.flatnonzero((shared <= depth) & (lengths > depth))
        begin, end = np.searchsorted(below, starts), np.searchsorted(below, np.append(starts[1:], rows))
        many = (end - begin)[node]
        at = np.repeat(np.arange(len(node)), many)
        child = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many) + begin[node][at]
        query, letter = query[at], letters[below[child], depth]
        here = letters[query, depth]
        back = letters[query, depth - 1] if depth else np.zeros(len(query), letters.dtype)
        one_less = np.minimum(shorter[at] + (back != letter), equal[at] + 1)
        as_long = equal[at] + (here != letter)
        alive = (one_less <= 1) | (as_long <= 1)
        query, node, equal, shorter = query[alive], child[alive], as_long[alive], one_less[alive]
        starts = below
    return np.concatenate(left), np.concatenate(right)


def compared(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places in `rows` (`ENTRY`, whole lists, sorted) of words at one edit."""
    owner = np.cumsum([k == 0 or rows[k][:5] != rows[k - 1][:5] for k in range(len(rows))]) - 1
    m, front, back, before = (np.array([r[k] for r in rows], np.int64) for k in (0, 1, 2, 5))
    middles = [r[6] for r in rows]
    lengths = np.array([len(x) for x in middles], np.int64)
    width = max(1, int(lengths.max()))
    letters = np.array(middles, dtype=f"U{width}").view(np.uint32).reshape(len(rows), width)
    asking = np.flatnonzero((lengths == m - front - back) & (np.bincount(owner)[owner] > 1))
    a, b = walk(letters, lengths, owner, asking)
    longer = lengths[b] > lengths[a]
    differ = (letters[a] != letters[b]).argmax(axis=1)
    mine = ~longer | (differ < (before - front)[a])
    a, b, longer = a[mine], b[mine], longer[mine]
    # words as long ask each other, longer ones do not ask
    return np.concatenate([a, b[longer]]), np.concatenate([b, a[longer]])


def best(rows: list[tuple], a: np.ndarray, b: np.ndarray) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, most of their counts, the first such word) for the words a with near words b."""
    words = np.array([r[3] + r[6] + r[4] for r in rows])
    counts = np.array([r[7] for r in rows], np.int64)
    place = np.empty(len(rows), np.int64)
    place[np.argsort(words, kind="stable")] = np.arange(len(rows))
    order = np.lexsort((place[b], -counts[b], a))
    a, b = a[order], b[order]
    heads = np.flatnonzero(np.diff(a, prepend=-1))
    for head, many in zip(heads, np.diff(np.append(heads, len(a))), strict=True):
        yield str(words[a[head]]), int(many), int(counts[b[head]]), str(words[b[head]])


NEAR = "word string, n_near long, near_n long, near string"


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found(rows: list[tuple]) -> pa.RecordBatch:
        out = list(best(rows, *compared(rows))) if rows else []
        columns = list(zip(*out, strict=True)) or [[]] * 4
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["word", "n_near", "near_n", "near"])

    held: list[tuple] = []
    for batch in batches:
        held += zip(*[c.to_pylist() for c in batch.columns], strict=True)
        if len(held) >= TOGETHER:
            # whole lists; the last one may go on
            cut = len(held) - 1
            while cut and held[cut - 1][:5] == held[-1][:5]:
                cut -= 1
            if cut:
                yield found(held[:cut])
                held = held[cut:]
    yield found(held)


def near_words(vocabulary: DataFrame, limit: int = LIMIT, few: int = common.FEW) -> DataFrame:
    """`NEAR` for the words of a vocabulary that have near words in one list; a word may have several rows."""
    filed = lists(vocabulary, limit, few).select(*ENTRY)
    return filed.repartition(*LIST).sortWithinPartitions(*LIST, "middle").mapInArrow(_near, NEAR)


# --- forms -------------------------------------------------------------------


def roots(forms: DataFrame, most: int, rarest: int = RAREST) -> DataFrame:
    """(word, root) for words (word, form, ...) with a form: the end of the chain of forms.

    Each round doubles the way a word looks ahead. A form is `TIMES` as frequent, so a chain is no longer than
    the logarithm of the counts, and rounds are its logarithm.
    """
    ahead = common.stored(forms.filter("form is not null").select("word", F.col("form").alias("root")), "forms")
    depth = max(1, int(log2(max(most, rarest) / rarest)))
    for _ in range(ceil(log2(depth)) if depth > 1 else 0):
        onward = ahead.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        ahead = common.stored(ahead.join(onward, "root", "left").select("word", F.coalesce("_further", "root").alias("root")), "forms")
    return ahead


def group(docs: DataFrame, limit: int = LIMIT, few: int = common.FEW, rarest: int = RAREST) -> DataFrame:
    """`RESULT`: every word of `docs` (doc_id, text) that is long and frequent enough."""
    words = common.stored(vocabulary(docs, rarest), "vocabulary")
    least = F.struct((-F.col("near_n")).alias("minus_n"), F.col("near").alias("near"))
    own = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("near_n"), F.lit(None).cast("string").alias("near"))
    found = near_words(words, limit, few).withColumn("n", F.lit(0).cast("long")).select(*own.columns)
    joint = own.unionByName(found).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min(F.when(F.col("near").isNotNull(), least)).alias("b")
    )
    standing = -F.col("b.minus_n") >= TIMES * F.col("n")
    forms = joint.select("word", "n", "n_near", F.when(standing, F.col("b.near")).alias("form"), F.when(standing, -F.col("b.minus_n")).alias("form_n"))
    forms = common.stored(forms, "near-words")
    most = words.agg(F.max("n")).first()[0] or 0
    joined = forms.join(roots(forms, most, rarest), "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
