"""Removal of repeated runs of lines, by a suffix array over line numbers.

Every document is a sequence of its non-blank lines. Lines that occur once stand in no repeated run, so only
the others are ranked: the rank of a suffix by its first line is the line's place among all repeated lines,
and prefix doubling ranks suffixes by their first 2, 4, 8, ... lines from pairs of ranks (rank of the first
half, rank of the second), sorted and numbered by Spark; suffixes that are alone with their prefix drop out
at each step. Suffixes with one rank are an interval of the suffix array whose longest common prefix is at
least that long.

A run counts if it has `MIN_WORDS` words or more. In the array at that depth, each interval's members are
copies of one run: of the shortest run that begins at a line, or ends at it, and has the words. The earliest
member, by doc_id and line, stays and the lines of all later ones are deleted. Overlapping deleted runs add
up to the maximal repeated runs, whatever their length, so no rank beyond that depth is needed: deeper doubling
would rank a run that repeats as a whole, all of whose lines are in shorter repeated runs already.

Words are runs of characters other than white space; Chinese and Japanese characters (Han, kana, bopomofo),
which stand without blanks, count one by one. Lines are cut at line feeds; a line is compared whole, blanks and
case included. A line without a character other than white space is blank. A null text has no lines and
stays null. Equal rows (id and text) are one document and get equal results. Rows without an id come after
the others. Runs that repeat within a document are deleted too, and may overlap. Blank lines stay. Empty
tables give empty results. Other columns pass through; those named like the result's are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.llm import common

MIN_WORDS = 13
# white space of Unicode, and characters that are words of their own
SPACE = r"\s\x1c-\x1f\x85\p{Z}"
LONE = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsBopomofo}"
FILLED = f"[^{SPACE}]"
WORD = f"[{LONE}]|[^{SPACE}{LONE}]+"
RESULT = ("n_lines", "n_deleted", "deleted", "kept_text")


def _document():
    """A digest that names a document: its id and text."""
    named = F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.xxhash64("text").cast("string"), F.octet_length("text").cast("string"))
    return F.unhex(F.md5(named.cast("binary")))


def words_in(line: Column, enough: int = MIN_WORDS) -> Column:
    """The number of words, `enough` for any number from there on: runs need no more, and what reads the first few
    words of a line does not pay for the rest. A run of other than white space is one word or more."""
    many = f"^[{SPACE}]*+(?:[^{SPACE}]++[{SPACE}]++){{{enough - 1}}}+[^{SPACE}]"
    return F.when(line.rlike(many), F.lit(enough)).otherwise(F.least(F.regexp_count(line, F.lit(WORD)), F.lit(enough)))


def lines_of(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, doc_id, pos, line, words, key): the non-blank lines; `pos` counts them, `line` counts all."""
    numbered = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line"), x.alias("x")))
    filled = F.filter(numbered, lambda s: s["x"].rlike(FILLED))
    # the document is named before its lines are rows: what stands beside a generator is evaluated for each row
    named = docs.filter("text is not null").select(_document().alias("doc"), "doc_id", filled.alias("lines"))
    rows = named.select("doc", "doc_id", F.posexplode("lines").alias("pos", "s"))
    return rows.select("doc", "doc_id", "pos", "s.line", words_in(F.col("s.x"), min_words).alias("words"), F.unhex(F.md5(F.col("s.x").cast("binary"))).alias("key"))


def ranked(rows: DataFrame, *keys: str) -> DataFrame:
    """`rows` whose keys occur more than once, with `rank`, which rises with the keys."""
    repeated = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").select(*keys)
    numbered = common.stored(repeated.orderBy(*keys).withColumn("rank", F.monotonically_increasing_id()), "ranks")
    return rows.join(numbered, list(keys))


def doubled(ranks: DataFrame, reach: int) -> DataFrame:
    """From ranks by the first `reach` lines, (doc, pos, rank) by twice as many."""
    halves = ranks.select("doc", "pos", F.col("rank").alias("head")).join(ranks.select("doc", (F.col("pos") - reach).alias("pos"), F.col("rank").alias("tail")), ["doc", "pos"])
    return ranked(halves, "head", "tail").select("doc", "pos", "rank")


def windows(lines: DataFrame, min_words: int) -> DataFrame:
    """(doc, doc_id, pos, n): the shortest runs with `min_words` words that begin or end at a line, inside
    stretches of repeated lines."""
    by_doc = Window.partitionBy("doc").orderBy("pos")
    stretches = lines.withColumn("_run", F.col("pos") - F.row_number().over(by_doc))
    upto = Window.partitionBy("doc", "_run").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = stretches.withColumn("_end", F.sum("words").over(upto)).withColumn("_begin", F.col("_end") - F.col("words"))
    ahead = Window.partitionBy("doc", "_run").orderBy("_begin").rangeBetween(0, min_words - 1)
    behind = Window.partitionBy("doc", "_run").orderBy("_end").rangeBetween(1 - min_words, 0)
    spans = summed.withColumns(
        {
            "_n": F.count("*").over(ahead),
            "_words": F.max("_end").over(ahead) - F.col("_begin"),
            "_back_pos": F.min("pos").over(behind),
            "_back_words": F.col("_end") - F.min("_begin").over(behind),
        }
    )
    forward = F.struct("pos", F.col("_n").alias("n"), F.col("_words").alias("words"))
    backward = F.struct(F.col("_back_pos").alias("pos"), (F.col("pos") - F.col("_back_pos") + 1).cast("long").alias("n"), F.col("_back_words").alias("words"))
    both = spans.select("doc", "doc_id", F.explode(F.array(forward, backward)).alias("w"))
    return both.filter(F.col("w.words") >= min_words).select("doc", "doc_id", "w.pos", F.col("w.n").cast("int").alias("n")).distinct()


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, line) of the lines to delete."""
    lines = ranked(lines_of(docs, min_words), "key").select("doc", "doc_id", "pos", "line", "words", "rank").dropDuplicates(["doc", "pos"])
    lines = common.stored(lines, "lines")
    runs = common.stored(windows(lines, min_words), "windows")
    longest = runs.agg(F.max("n")).first()[0] or 0
    found, ranks, reach = None, lines.select("doc", "pos", "rank"), 1
    while reach <= longest:
        # runs of `reach` to twice as many lines: alike if their first and last `reach` lines are
        here = runs.filter((F.col("n") >= reach) & (F.col("n") < 2 * reach))
        named = here.join(ranks.select("doc", "pos", F.col("rank").alias("head")), ["doc", "pos"])
        named = named.withColumn("_last", F.col("pos") + F.col("n") - reach).join(ranks.select("doc", F.col("pos").alias("_last"), F.col("rank").alias("tail")), ["doc", "_last"])
        named = named.select("doc", "doc_id", "pos", "n", "head", "tail")
        place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "doc", "pos")
        first = named.groupBy("n", "head", "tail").agg(F.min(place).alias("first"), F.count("*").alias("copies")).filter("copies > 1")
        later = named.join(first, ["n", "head", "tail"]).filter((F.col("doc") != F.col("first.doc")) | (F.col("pos") != F.col("first.pos")))
        later = later.select("doc", F.explode(F.sequence("pos", F.col("pos") + F.col("n") - 1)).alias("pos"))
        found = later if found is None else found.unionByName(later)
        if 2 * reach <= longest:
            ranks = common.stored(doubled(ranks, reach), "ranks")
        reach *= 2
    if found is None:
        return lines.select("doc", "line").limit(0)
    return found.distinct().join(lines.select("doc", "pos", "line"), ["doc", "pos"]).select("doc", "line")


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` (doc_id, text, ...) with n_lines, n_deleted, deleted (runs of line numbers from 0, as text
    "first-last" joined by commas) and kept_text."""
    gone = later_copies(docs, min_words).groupBy("doc").agg(F.array_sort(F.collect_set("line")).alias("gone"))
    source = docs.drop(*RESULT).withColumn("_doc", _document())
    joined = source.join(gone, source["_doc"] == gone["doc"], "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    lines = F.split("text", "\n")
    # each in one pass over the deleted places
    first = F.filter("gone", lambda x, i: (i == 0) | (F.get("gone", i - 1) != x - 1))
    last = F.filter("gone", lambda x, i: (i == F.size("gone") - 1) | (F.get("gone", i + 1) != x + 1))

    def left(text: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(text) - 1), F.col("gone"))
        return F.transform(places, lambda i: F.get(text, i))

    # bound as a variable, so that the text is cut once
    kept = F.array_join(F.transform(F.array(lines), left)[0], "\n")
    spans = F.zip_with(first, last, lambda a, b: F.concat_ws("-", a.cast("string"), b.cast("string")))
    return joined.select(
        *[F.col(f"`{c}`") for c in source.columns if c != "_doc"],
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_deleted"),
        F.array_join(spans, ",").alias("deleted"),
        F.when(F.size("gone") == 0, F.col("text")).otherwise(kept).alias("kept_text"),
    )
