"""Language identification by error-correcting output codes.

Each language gets a codeword; each bit of the code has a binary classifier over hashed n-grams of letters
(two and three bytes, within and across word borders), which tells the languages with that bit from the
others. The classifiers are multinomial: a weight is the log of the ratio of an n-gram's share in the two
sides, from n-gram counts over all training texts, which Spark sums by language and bucket, and then by bit
and bucket. The driver gets the bits' sums (bits x `BUCKETS` numbers; bits grow with the logarithm of the
languages), the languages' names and their codewords, whatever the size of the corpus and however many labels
it has. Sums are of whole numbers, so that they don't depend on their order. A text's margins are summed weights over the
square root of its n-grams; decoding picks the codeword of least loss, each bit's logistic loss weighted by
how well its two sides differ. `score` is that word's share among all (softmax of the losses); a text whose
best two languages are within `MARGIN` of each other, or whose best score is below `LEAST_SCORE`, is flagged
ambiguous.

Training reads text and label only, prediction reads text only. Rows without text or label teach nothing; a
text that is null or without a letter is `und` with score 0, as is every text when nothing was learned. With
one language learned, every text with letters is of that language. Whole texts are used, whatever their
length; repeated rows count as often as they occur; other columns pass through, and those named like the
result's are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardgrid.llm import common
from wardgrid.llm.shingles import runs, text_bytes

BUCKETS = 1 << 15
SMOOTHING = 0.5
AT_ONCE = 1 << 20
TOGETHER = 64  # languages counted in a task before it hands them on
UNIT = 2.0**48  # shares are summed as whole numbers of such parts
LEAST_SCORE = 0.5
MARGIN = 0.1
UNKNOWN = "und"

_class = np.full(256, 32, np.uint8)  # all that is no letter is a blank
_class[65:91] = np.arange(97, 123)
_class[97:123] = np.arange(97, 123)
_class[128:] = np.arange(128, 256)


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every n-gram of the texts, none across two texts, none of blanks only."""
    data, offsets = text_bytes(texts)
    letters = _class[data].astype(np.uint32)
    rows = np.repeat(np.arange(len(texts)), np.diff(offsets))
    found, owner = [], []
    for n in (2, 3):
        if len(letters) < n:
            continue
        code = letters[: len(letters) - n + 1].copy()
        for k in range(1, n):
            code = code * np.uint32(257) + letters[k : len(letters) - n + 1 + k]
        blanks = sum(32 * 257**k for k in range(n))
        whole = (rows[: len(code)] == rows[n - 1 :]) & (code != blanks)
        code = (code + np.uint32(n)) * np.uint32(2654435761)
        found.append((code[whole] >> np.uint32(17)).astype(np.int32))
        owner.append(rows[: len(code)][whole])
    if not found:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    return np.concatenate(found), np.concatenate(owner)


def counted(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, bucket, n) over all rows with a text and a label."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for whole in batches:
            for begin, end in runs(whole.column(0), AT_ONCE):
                names = whole.column(1).slice(begin, end - begin).dictionary_encode()
                which = names.indices.to_numpy(zero_copy_only=False)
                buckets, rows = grams(whole.column(0).slice(begin, end - begin))
                for k, name in enumerate(names.dictionary.to_pylist()):
                    sums = np.bincount(buckets[which[rows] == k], minlength=BUCKETS)
                    counts[name] = counts[name] + sums if name in counts else sums
                    if len(counts) >= TOGETHER:
                        yield from rows_of(counts)
                        counts = {}
        yield from rows_of(counts)

    def rows_of(counts: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, sums in counts.items():
            buckets = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(buckets), pa.string()), pa.array(buckets, pa.int32()), pa.array(sums[buckets], pa.int64())], names=["lang", "bucket", "n"])

    taught = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    return taught.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def code_of(k: int) -> np.ndarray:
    """Codewords of -1 and 1, a row a language: all splits of few languages, else the best of some random
    codes of ten bits for each doubling of the languages: of 50 up to a thousand languages, of fewer the more
    there are, as comparing codewords grows with the square of the languages."""
    if k < 2:
        return np.ones((k, 0))
    if k <= 7:
        splits = np.arange(2 ** (k - 1) - 1)
        others = (splits[None, :] >> np.arange(k - 1)[:, None] & 1) * 2 - 1
        return np.vstack([np.ones(len(splits)), others]).astype(float)
    bits, best, apart = int(np.ceil(10 * np.log2(k))), None, -1
    tries = min(50, max(1, 50_000_000 // k**2))
    for seed in range(1000):
        code = np.random.default_rng(seed).choice([-1.0, 1.0], (k, bits))
        if (np.abs(code.sum(axis=0)) == k).any():
            continue
        if tries == 1:
            return code
        distance = (bits - code @ code.T) / 2 + bits * np.eye(k)
        if distance.min() > apart:
            best, apart = code, distance.min()
        if seed + 1 >= tries and best is not None:
            break
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # bits x buckets
    trust: np.ndarray  # a weight for each bit

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Texts x languages: the weighted loss of each codeword."""
        one = np.logaddexp(0, -margins) @ (self.trust * (self.code > 0)).T
        return one + np.logaddexp(0, margins) @ (self.trust * (self.code < 0)).T

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Texts x languages, each row summing to one."""
        buckets, rows = grams(texts)
        sums = np.empty((len(texts), self.code.shape[1]))
        for bit in range(self.code.shape[1]):
            sums[:, bit] = np.bincount(rows, self.weights[bit][buckets], minlength=len(texts))
        seen = np.maximum(np.bincount(rows, minlength=len(texts)), 1)
        losses = self.losses(sums / np.sqrt(seen)[:, None])
        shares = np.exp(losses.min(axis=1, keepdims=True) - losses)
        return shares / shares.sum(axis=1, keepdims=True)


def side_sums(table: DataFrame, names: list[str], code: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Bits + 1 x buckets: the n-gram counts of `table` (lang, bucket, n), each times its language's part in
    `parts`, summed over the languages with that bit; the last row sums over all languages."""
    bits = code.shape[1]
    place = {name: k for k, name in enumerate(names)}
    counted_in = np.hstack([code > 0, np.ones((len(names), 1), bool)])
    shared = table.sparkSession.sparkContext.broadcast((place, counted_in, parts))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, counted_in, parts = shared.value
        sums = np.zeros((bits + 1, BUCKETS), np.int64)
        for batch in batches:
            labels = batch.column(0).dictionary_encode()
            which = np.array([place[x] for x in labels.dictionary.to_pylist()], int)[labels.indices.to_numpy(zero_copy_only=False)]
            buckets = batch.column(1).to_numpy()
            added = np.rint(batch.column(2).to_numpy() * parts[which] * UNIT).astype(np.int64)
            for bit in range(bits + 1):
                on = counted_in[which, bit]
                np.add.at(sums[bit], buckets[on], added[on])
        for bit in range(bits + 1):
            found = np.flatnonzero(sums[bit])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), bit, np.int32)), pa.array(found, pa.int32()), pa.array(sums[bit][found])], names=["bit", "bucket", "s"])

    rows = table.select("lang", "bucket", "n").mapInArrow(add, "bit int, bucket int, s long").groupBy("bit", "bucket").agg(F.sum("s").alias("s")).toPandas()
    sums = np.zeros((bits + 1, BUCKETS))
    sums[rows["bit"].to_numpy(int), rows["bucket"].to_numpy(int)] = rows["s"].to_numpy() / UNIT
    return sums


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Classifiers from the n-gram counts of all labelled rows: for each bit the mean share of an n-gram over
    the languages with that bit against that over the others. A label whose rows hold no letter isn't learned."""
    table = common.stored(counted(docs, text, lang), "ngrams")
    totals = sorted((r["lang"], r["n"]) for r in table.groupBy("lang").agg(F.sum("n").alias("n")).collect())
    names = [name for name, _ in totals]
    code = code_of(len(names))
    bits = code.shape[1]
    weights, trust = np.zeros((bits, BUCKETS), np.float32), np.zeros(bits)
    if not bits:
        return Model(names, code, weights, trust)
    parts = 1 / (np.array([n for _, n in totals], float) + SMOOTHING * BUCKETS)
    sums = side_sums(table, names, code, parts)
    for bit in range(bits):
        on = code[:, bit] > 0
        one = (sums[bit] + SMOOTHING * parts[on].sum()) / on.sum()
        other = (sums[bits] - sums[bit] + SMOOTHING * parts[~on].sum()) / (~on).sum()
        ratio = np.log(one / other)
        weights[bit], trust[bit] = ratio, ((one - other) * ratio).sum()
    return Model(names, code, weights, trust / trust.sum() * 4 if trust.sum() else trust)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with lang_pred, score and ambiguous."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bits x (buckets + languages)
    source = docs.drop("lang_pred", "score", "ambiguous")
    columns = source.columns
    schema = T.StructType([*source.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        for whole in batches:
            for begin, end in runs(whole.column(columns.index(text)), AT_ONCE):
                batch = whole.slice(begin, end - begin)
                if learned.languages:
                    ranked = learned.scores(batch.column(columns.index(text)))
                    best = ranked.argmax(axis=1)
                    score = ranked[np.arange(len(best)), best]
                    second = np.partition(ranked, -2, axis=1)[:, -2] if ranked.shape[1] > 1 else np.zeros(len(best))
                    names, close = [learned.languages[k] for k in best], (score - second < MARGIN) | (score < LEAST_SCORE)
                else:
                    names, score, close = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(close, pa.bool_())], names=[*columns, "lang_pred", "score", "ambiguous"])

    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return source.mapInArrow(named, schema).withColumns(
        {
            "lang_pred": F.when(lettered, F.col("lang_pred")).otherwise(UNKNOWN),
            "score": F.when(lettered, F.col("score")).otherwise(0.0),
            "ambiguous": F.when(lettered, F.col("ambiguous")).otherwise(True),
        }
    )


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text, modulo 5, is 0. A row without an
    id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))
