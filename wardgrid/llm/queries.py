"""The registered query of each operator of this folder, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.llm import common, decontamination, filteraudit, fingerprints, langid, linededup, mixing, neardup, pitmanyor, sentencepieces, sharding, spelling, toolcalls, warc


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later copies of repeated runs of lines."""
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    return linededup.dedup(docs).select("doc_id", "n_lines", "n_deleted", "deleted", F.col("kept_text").alias("text"))


# what a message says about itself when it is handed on as a call of its role's tool
MESSAGE_SCHEMA = {"properties": {"text": {"type": "string"}, "turn": {"type": "integer"}, "words": {"type": "integer"}}, "required": ["text", "turn"], "additionalProperties": False}


def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message with a conversation and a turn as a call of the tool named like its role, beside the calls
    that messages state as JSON: it rests on the message at half its turn and is answered by the next turn. A
    message without a conversation is no row; one without a turn is none either, but calls it states are. Stated
    calls without an identifier are rows of their own, pending."""
    messages = common.table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    named = messages.filter("conv_id is not null and turn is not null")
    words = F.size(F.split("text", " "))
    calls = named.select(
        "conv_id",
        F.col("turn").cast("string").alias("call_id"),
        "turn",
        F.col("role").alias("tool"),
        F.to_json(F.struct(F.when(F.col("text").isNotNull(), words).alias("words"), "turn", "text")).alias("arguments"),
        F.when(F.col("turn") > 0, F.array(F.expr("turn div 2").cast("string"))).otherwise(F.array().cast("array<string>")).alias("depends_on"),
    )
    results = named.select("conv_id", (F.col("turn") - 1).cast("string").alias("call_id"), "turn", F.coalesce("text", F.lit("")).alias("text"))
    stated, answered = toolcalls.calls_of(messages)
    schemas = {role: MESSAGE_SCHEMA for role in ("system", "user", "assistant", "tool")}
    done = toolcalls.linked(calls.unionByName(stated.select(*calls.columns)), results.unionByName(answered), schemas)
    done = done.unionByName(toolcalls.unnamed(stated, schemas))
    return done.select("conv_id", "call_id", "turn", "tool", "arguments", "error", "level", "result_turn", F.sha2("result", 256).alias("result_sha256"), "status")


TOOL_CALLS_SQL = """
SELECT c.conv_id, CAST(c.turn AS VARCHAR) AS call_id, c.turn, c.role AS tool,
       '{"text":' || to_json(c.text) || ',"turn":' || c.turn || ',"words":' || len(string_split(c.text, ' ')) || '}' AS arguments,
       CAST(NULL AS VARCHAR) AS error,
       CASE WHEN c.turn = 0 THEN 0 ELSE CAST(floor(log2(c.turn)) AS INT) + 1 END AS level,
       r.turn AS result_turn, sha256(r.text) AS result_sha256,
       CASE WHEN r.turn IS NULL THEN 'pending' ELSE 'linked' END AS status
FROM conversations c LEFT JOIN conversations r ON r.conv_id = c.conv_id AND r.turn = c.turn + 1
"""


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and the text decoded from them, as digests."""
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    done = sentencepieces.encode(docs, model_path())
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sentencepieces.ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


SHARDS = 40


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of nearly equal bytes; equal texts stay together."""
    docs, _ = sharding.shard(common.table(spark, sf_dir, "documents", "doc_id", "text"), SHARDS)
    return docs.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document, and which documents are contaminated."""
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    items = common.table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontamination.decide(docs, items).select("doc_id", *decontamination.RESULT)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives as request, response or revisit, and metadata records; read back."""
    path = warc.archive(common.table(spark, sf_dir, "pages", "page_id", "url", "html"))
    # kept without payloads: assembly uses the records several times
    captures = warc.assemble(common.stored(warc.read(spark, path, keep_payload=False), "records"))
    return captures.select(
        "page_id",
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.col("refers_to_page").alias("refers_to"),
        F.col("request.target").alias("request_target"),
        F.col("metadata.record_id").alias("metadata_id"),
    )


# the same by plain comparison of every window of every length
DECONTAMINATION_SQL = r"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
         unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1), lambda s: array_to_string(w[s : s + least(len(w), 13) - 1], ' '))) AS words
  FROM item WHERE len(w) > 0),
doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
place AS (
  SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
hit AS (
  SELECT DISTINCT r, s, place.n AS n, item_id FROM place JOIN win ON win.n = place.n AND win.words = array_to_string(w[s : s + place.n - 1], ' ')),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of documents at a Jaccard similarity of 0.85."""
    return neardup.cluster(common.table(spark, sf_dir, "documents", "doc_id", "text"), 85).select("doc_id", *neardup.RESULT)


# the same by counting the shared shingles of every pair that shares one
NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] ELSE list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda s: array_to_string(w[s : s + 4], ' ')) END) AS g FROM doc),
one AS (SELECT doc_id, unnest(g) AS g FROM shingle),
link AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM one x JOIN one y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN shingle p ON p.doc_id = a JOIN shingle q ON q.doc_id = b
  WHERE 100 * n >= 85 * (len(p.g) + len(q.g) - n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM doc UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT a AS doc_id, CAST(any_value(len(g)) AS BIGINT) AS n_shingles, min(b) AS component_id, a = min(b) AS kept
FROM reach JOIN shingle ON shingle.doc_id = a GROUP BY a
"""


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log10 probability of every document under a model of those that are not held out."""
    return pitmanyor.score(common.table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", langid.held_out())
    model = langid.train(docs.filter(~F.col("held_out")))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.with_edits(common.table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their 120 orders, by language."""
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return filteraudit.audit(docs, common.table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


# the same by applying the filters of each order one after another
FILTER_AUDIT_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT coalesce(lang, '') AS part, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
fail AS (
  SELECT part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * len(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * len(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e,
         coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM doc LEFT JOIN (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
                      FROM labels GROUP BY doc_id) USING (doc_id)),
kind AS (
  SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END,
                      CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS failed,
         count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fail GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (SELECT '' AS o UNION ALL SELECT o || f FROM orders, letter WHERE NOT contains(o, f)),
place AS (SELECT o, s, o[s] AS f, o[1 : s - 1] AS earlier FROM orders, (SELECT unnest(range(1, 6)) AS s) WHERE len(o) = 5),
state AS (
  SELECT part, o, s, f, failed, n, good, toxic, contains(failed, f) AS fails,
         len(translate(failed, earlier, '')) < len(failed) AS gone FROM kind, place),
step AS (
  SELECT part, o, s, f, sum(CASE WHEN gone OR fails THEN 0 ELSE n END) AS kept, sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN failed = f THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM state GROUP BY part, o, s, f)
SELECT part, o AS filter_order, CAST(s AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM step
"""


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of each document that a mix of all sources to target weights takes."""
    return mixing.mix(common.table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with the near word it stands for and the root of its forms."""
    return spelling.group(common.table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_tool_calls": op2_tool_calls,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_sharding": op4_sharding,
    "op5_warc": op5_warc,
    "op6_decontamination": op6_decontamination,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_language_model": op8_language_model,
    "op9_language_id": op9_language_id,
    "op10_fingerprints": op10_fingerprints,
    "op11_filter_audit": op11_filter_audit,
    "op12_source_mixing": op12_source_mixing,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {
    "op2_tool_calls": TOOL_CALLS_SQL,
    "op6_decontamination": DECONTAMINATION_SQL,
    "op7_near_duplicates": NEAR_DUPLICATES_SQL,
    "op11_filter_audit": FILTER_AUDIT_SQL,
}
