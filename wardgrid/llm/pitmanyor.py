"""A hierarchical Pitman-Yor language model over words, sampled and applied by Spark.

Tokens are the words of a text and one end. A token's context is the word before it, or the beginning. Each
context is a restaurant whose customers are the training tokens after it; all share the root as parent, whose
customers are their tables; the root's base gives `UNSEEN` to all unseen words together and the rest evenly to
the `V` known ones. So the model is a distribution over the known tokens and one outcome for any other.

Seating is sampled in sweeps. Dishes meet only in a restaurant's totals, so a sweep seats each pair's
customers anew, one after another by the Chinese-restaurant rule given the last sweep's totals and parent
probabilities (a blocked Gibbs move; after the first customers a few at a time, by binomial draws with the
chance of a new table), then each word's tables at the root. A pair seen once has one table in any seating, so
sweeps go over the pairs seen more often and add the others by their count. Totals of contexts and of words are
tables, summed by Spark between sweeps and joined to the pairs; the driver has the root's two totals only.
Probabilities are averaged over the sweeps from number `BURN_IN` on.

Texts are read once, in blocks of about `BLOCK_BYTES`: a block keeps its texts as numbers of its own pairs of
word and context, and asks for each pair once. Counts are summed over all blocks, the questions joined with the
model's pairs, words and contexts, and the answers sent to their block; nothing of the corpus reaches the driver, and no
table that grows with it is broadcast.

Null texts are empty: the end alone. Without any training token nothing is known, and the base and the model give
every token probability 1. Rows without an id are held out. Equal rows are rows of their
own. Empty tables give empty results. Other columns do not pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.llm import common
from wardgrid.llm.shingles import runs, words

CLASSES = 12  # so many contexts, and one more, are summed over by the test; any number is served
BLOCK_BYTES = 24 << 20
TURNS = 8  # questions are answered in so many turns, by word: those of a turn and its shuffle files go with it
DISCOUNT, STRENGTH = 0.8, 5.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.75, 1.0
UNSEEN = 0.5
SWEEPS, BURN_IN = 4, 2
END = 1  # the end's hash
BEGINNING = 0  # the beginning's, as a context

READ = "block long, doc_id long, held_out boolean, tokens binary, pair int, word long, class long, n long"
READ_TYPES = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
READ_NAMES = [x.split()[0] for x in READ.split(", ")]


def tokens_of(texts: pa.Array) -> list[np.ndarray]:
    """Hashes of each text's tokens."""
    hashes = []
    for begin, end in runs(texts):
        found, first = words(texts.slice(begin, end - begin))
        hashes += [np.append(found[first[k] : first[k + 1]], np.uint64(END)) for k in range(end - begin)]
    return hashes


def packed(numbers: np.ndarray) -> bytes:
    """Numbers as their low 16 bits, then their high 16 bits."""
    return (numbers & 0xFFFF).astype("<u2").tobytes() + (numbers >> 16).astype("<u2").tobytes()


def unpacked(content: bytes) -> np.ndarray:
    halves = np.frombuffer(content, "<u2").astype(np.int64)
    return halves[: len(halves) // 2] | halves[len(halves) // 2 :] << 16


def _batch(rows: int, /, **columns: object) -> pa.RecordBatch:
    arrays = [pa.array(columns[c], k) if c in columns else pa.nulls(rows, k) for c, k in zip(READ_NAMES, READ_TYPES, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=READ_NAMES)


def _block(block: int, ids: list, held: list, hashes: list) -> Iterator[pa.RecordBatch]:
    """A block's texts as numbers of pairs, and its pairs with their training counts."""
    lengths = [len(x) for x in hashes]
    ends = np.cumsum([0, *lengths])
    whole = np.concatenate(hashes)
    vocabulary, inverse = np.unique(whole, return_inverse=True)
    del whole
    contexts = np.append(vocabulary, np.uint64(BEGINNING))
    before = np.empty_like(inverse)
    before[1:] = inverse[:-1]
    before[ends[:-1]] = len(vocabulary)
    code = inverse * len(contexts) + before
    del inverse, before
    pairs, inverse, seen = np.unique(code, return_inverse=True, return_counts=True)
    number = np.empty(len(pairs), np.int64)
    number[np.argsort(-seen, kind="stable")] = np.arange(len(pairs))  # frequent pairs have small numbers
    del code
    numbers = number[inverse].astype(np.int32)
    taught = np.repeat(~np.array(held, bool), lengths)
    counts = np.bincount(inverse[taught], minlength=len(pairs))
    del inverse
    for at in range(0, len(ids), 256):
        some = range(at, min(at + 256, len(ids)))
        yield _batch(len(some), block=[block] * len(some), doc_id=[ids[k] for k in some], held_out=[held[k] for k in some], tokens=[packed(numbers[ends[k] : ends[k + 1]]) for k in some])
    for at in range(0, len(pairs), 50_000):
        part = slice(at, at + 50_000)
        here = pairs[part]
        yield _batch(len(here), block=np.full(len(here), block), pair=number[part].astype(np.int32), word=vocabulary[here // len(contexts)].view(np.int64), **{"class": contexts[here % len(contexts)].view(np.int64)}, n=counts[part].astype(np.int64))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number, size = TaskContext.get().partitionId(), 0, 0
    ids, held, hashes = [], [], []
    for batch in batches:
        ids += batch.column(0).to_pylist()
        held += batch.column(1).to_pylist()
        hashes += tokens_of(batch.column(2))
        size += batch.column(2).nbytes
        if size >= BLOCK_BYTES:
            yield from _block(part << 24 | number, ids, held, hashes)
            number, size = number + 1, 0
            ids, held, hashes = [], [], []
    if ids:
        yield from _block(part << 24 | number, ids, held, hashes)


def seated(customers: np.ndarray, pull: np.ndarray, discount: float, source: np.random.Generator) -> np.ndarray:
    """Tables of each dish when its customers sit down one after another, then a few at a time; `pull` is the
    weight of a new table, (strength + discount * tables) * parent's probability."""
    tables, there = np.minimum(customers, 1), np.minimum(customers, 1)
    active = np.flatnonzero(customers > 1)
    while len(active):
        n, t, a = there[active], tables[active], pull[active]
        coming = np.minimum(np.maximum(n // 8, 1), customers[active] - n)
        chance = a / (a + np.maximum(n - discount * t, 1e-9))
        tables[active] = t + source.binomial(coming, chance)
        there[active] = n + coming
        active = active[there[active] < customers[active]]
    return tables


def _seat(sweep: int, discount: float):
    """Tables anew for rows that end with customers and pull, which are replaced by them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy()
            source = np.random.default_rng([sweep, int(key[0]) & 0xFFFFFFFF, int(key[-1]) & 0xFFFFFFFF, len(key)])
            kept = batch.schema.names[:-1]
            tables = seated(batch.column(len(kept) - 1).to_numpy(), batch.column(len(kept)).to_numpy(), discount, source)
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(len(kept))], pa.array(tables.astype(np.int64))], names=[*kept, "tables"])

    return run


PAIRS = "word long, class long, summed long, n long, tables long"
WORDS = "word long, total long, once long, roots array<double>, customers long, tables long"


def train(counts: DataFrame) -> tuple[tuple[DataFrame, DataFrame, DataFrame], dict]:
    """From (word, class, n), a class being a context: the seen pairs (word, class, n, tables), the words (word,
    total, roots), the contexts (class, customers, tables), and what unseen words need. `roots` and a context's
    `tables` have one value a sample, a pair's `tables` is their mean."""
    none = F.lit(0).cast("long")
    pairs = common.tidily_stored(counts.select("word", F.col("class").cast("long").alias("class"), "n").repartition("word", "class").sortWithinPartitions("word", "class"), "pairs")
    once = F.sum((F.col("n") == 1).cast("long")).alias("once")
    words = common.tidily_stored(pairs.groupBy("word").agg(F.sum("n").alias("total"), once, F.count("*").alias("customers")), "words")
    contexts = common.tidily_stored(pairs.groupBy("class").agg(F.sum("n").alias("served"), once, F.count("*").alias("now")), "contexts")
    known, tokens, root_customers = words.agg(F.count("*"), F.coalesce(F.sum("total"), none), F.coalesce(F.sum("customers"), none)).first()
    root_tables, samples, unseen = known, 0, []
    words = words.withColumn("root", F.col("total") / max(tokens, 1)).withColumn("roots", F.array().cast("array<double>"))
    contexts = contexts.withColumn("tables", F.array().cast("array<long>"))
    often = pairs.filter("n > 1").withColumn("summed", none)
    for sweep in range(SWEEPS):
        root_pull = (ROOT_STRENGTH + ROOT_DISCOUNT * root_tables) * (1 - UNSEEN) / max(known, 1)
        pull = (STRENGTH + DISCOUNT * F.col("now")) * F.col("root")
        placed = often.select("word", "class", "summed", "n").join(words.select("word", "root"), "word").join(contexts.select("class", "now"), "class")
        placed = placed.select("word", "class", "summed", "n", pull.alias("pull")).sortWithinPartitions("word", "class")
        often = placed.mapInArrow(_seat(sweep, DISCOUNT), PAIRS)
        if sweep >= BURN_IN:
            often = often.withColumn("summed", F.col("summed") + F.col("tables"))
        often = common.tidily_stored(often, "seats")
        last = [words, contexts, *([seats] if sweep else [])]
        seats = often
        by_word = often.groupBy("word").agg(F.sum("tables").alias("more"))
        at_root = words.select("word", "total", "once", "roots").join(by_word, "word", "left")
        at_root = at_root.select("word", "total", "once", "roots", (F.col("once") + F.coalesce("more", none)).alias("customers"), F.lit(root_pull).alias("pull"))
        words = common.tidily_stored(at_root.sortWithinPartitions("word").mapInArrow(_seat(sweep, ROOT_DISCOUNT), WORDS), "words")
        by_class = often.groupBy("class").agg(F.sum("tables").alias("more"))
        contexts = contexts.select("class", "served", "once", "tables").join(by_class, "class", "left")
        contexts = contexts.withColumn("now", F.col("once") + F.coalesce("more", none)).drop("more")
        if sweep >= BURN_IN:
            contexts = contexts.withColumn("tables", F.concat("tables", F.array("now")))
        contexts = common.tidily_stored(contexts, "contexts")
        common.discard(*last)
        root_customers, root_tables = words.agg(F.coalesce(F.sum("customers"), none), F.coalesce(F.sum("tables"), none)).first()
        root_pull = (ROOT_STRENGTH + ROOT_DISCOUNT * root_tables) * (1 - UNSEEN) / max(known, 1)
        words = words.withColumn("root", (F.col("customers") - ROOT_DISCOUNT * F.col("tables") + root_pull) / (ROOT_STRENGTH + root_customers))
        if sweep >= BURN_IN:
            samples += 1
            words = words.withColumn("roots", F.concat("roots", F.array("root")))
            # without any training token, all is unseen
            unseen.append((ROOT_STRENGTH + ROOT_DISCOUNT * root_tables) * (UNSEEN if known else 1.0) / (ROOT_STRENGTH + root_customers))
    seen = often.select("word", "class", "n", (F.col("summed") / samples).alias("tables"))
    seen = seen.unionByName(pairs.filter("n = 1").withColumn("tables", F.lit(1.0)))
    model = seen, words.select("word", "total", "roots"), contexts.select("class", F.col("served").alias("customers"), "tables")
    return model, {"known": known, "tokens": tokens, "unseen": unseen}


def answers(asked: DataFrame, model: tuple[DataFrame, DataFrame, DataFrame], shared: dict) -> DataFrame:
    """(asker, pair, p, n): the averaged probability of each pair that a block asks for, and the word's count."""
    seen, words, contexts = model
    own = (F.col("n") - DISCOUNT * F.col("tables")).alias("own")
    joined = asked.select("block", "pair", "word", F.col("class").cast("long").alias("class")).join(seen.select("word", "class", own), ["word", "class"], "left")
    joined = joined.join(words, "word", "left").drop("word").join(contexts, "class", "left")
    samples, rest = len(shared["unseen"]), F.lit(0.0)
    for s, lost in enumerate(shared["unseen"]):
        rest = rest + (STRENGTH + DISCOUNT * F.coalesce(F.col("tables")[s], F.lit(0))) * F.coalesce(F.col("roots")[s], F.lit(float(lost)))
    p = (F.coalesce("own", F.lit(0.0)) + rest / samples) / (STRENGTH + F.coalesce("customers", F.lit(0)))
    return joined.select(F.col("block").alias("asker"), "pair", p.alias("p"), F.coalesce("total", F.lit(0)).alias("n"))


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _scored(known: int, tokens: int):
    def score(texts: pa.Table, given: pa.Table) -> pa.Table:
        order = given.column("pair").to_numpy()
        p, n = np.empty(len(order)), np.empty(len(order), np.int64)
        p[order] = np.log10(given.column("p").to_numpy().astype(float))
        n[order] = given.column("n").to_numpy()
        base = np.log10((n + 1) / (tokens + known + 1))
        rows = [unpacked(x.as_py()) for x in texts.column("tokens")]
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "held_out": texts.column("held_out"),
                "n_tokens": pa.array([len(x) for x in rows], pa.int64()),
                "n_known": pa.array([int((n[x] > 0).sum()) for x in rows], pa.int64()),
                "base_score": pa.array([float(base[x].sum()) for x in rows], pa.float64()),
                "score": pa.array([float(p[x].sum()) for x in rows], pa.float64()),
            }
        )

    return score


def score(docs: DataFrame) -> DataFrame:
    """For (doc_id, text): held_out, n_tokens, n_known, train_tokens, base_score and score, learned from the
    documents that are not held out."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(True))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    read = source.mapInArrow(_read, READ).withColumn("turn", F.coalesce(F.pmod("word", F.lit(TURNS)).cast("int"), F.lit(-1)))
    texts, *asked = common.stored_by(read, "tokens", "turn", range(-1, TURNS))
    counts = reduce(DataFrame.unionByName, asked).filter("n > 0").groupBy("word", "class").agg(F.sum("n").alias("n"))
    model, shared = train(counts)
    seen, words, contexts = model
    given = []
    for turn, questions in enumerate(asked):
        of_turn = [x.filter(F.pmod("word", F.lit(TURNS)) == turn) for x in (seen, words)]
        # single precision is enough for a logarithm, and half the bytes
        told = answers(questions, (*of_turn, contexts), shared).withColumn("p", F.col("p").cast("float"))
        given.append(common.tidily_stored(told, "answers"))
        common.discard(questions)
    common.discard(*model)
    given = reduce(DataFrame.unionByName, given)
    texts = texts.select(F.col("block").alias("home"), "doc_id", "held_out", "tokens")
    done = texts.groupBy("home").cogroup(given.groupBy("asker")).applyInArrow(_scored(shared["known"], shared["tokens"]), SCORED)
    return done.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(shared["tokens"]).cast("long").alias("train_tokens"), "base_score", "score")
