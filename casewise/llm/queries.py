"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewise.llm import chat, cws, encoding, filter_audit, jaccard, langid, lm, mixing, negatives, prefix_counts, recipes, shards, simhash
from casewise.llm.common import Tables, short_shuffles

#: Folder of the tokenizer files on all machines; unset, that of the installed package.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "")


def tokenizer(name: str) -> str:
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


#: Ids in a record of the training order (with 256, nine tenths of the ids' places are filled), and bytes of an id: the
#: tokenizer has less than 65,536 of them.
SEQUENCE, ID_BYTES = 256, 2


def op1_training_order(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids in shards: doc_id, part, slot, shard, row, n_ids, ids_sha256, all of them read back from the shard files."""
    held, written = Tables(spark), Tables(spark)
    docs = _documents(spark, sf).select("doc_id", "text")
    how = {"length": SEQUENCE, "width": ID_BYTES, "shard": 4 * shards.SHARD}
    folder = f"{written.folder}/shards"
    with short_shuffles(spark):
        ids = encoding.encoded(docs, tokenizer("word_bpe_49k.json"), decoded=False, width=ID_BYTES).select("doc_id", "ids")
        shards.write_shards(shards.materialised(ids, tables=held, **how), folder)
    held.drop()
    return shards.read_shards(spark, folder, **how).select(
        "doc_id", "part", "slot", "shard", "row", "n_ids",
        F.sha2(F.substring(F.col("record"), F.lit(5), ID_BYTES * F.col("n_ids")), 256).alias("ids_sha256"),
    )


def op2_chat(spark: SparkSession, sf: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(hard).alias("text"))
    parts = chat.read_back(chat.format_parts(turns.unionByName(extra)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    whole = parts.select(
        "conv_id", F.struct("part", said.alias("said"), F.array_join("loss", "").alias("loss")).alias("p"),
        F.size("turns").cast("long").alias("n"), F.length("formatted").cast("long").alias("chars"),
    ).groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sort_array(F.collect_list("p")).alias("p"), F.sum("chars").alias("formatted_chars"))
    loss = F.array_join(F.col("p.loss"), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join(F.col("p.said"), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )


SQL_OP2 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, 4 + 2 + 9 + length(replace(replace(replace(role, '%', '%25'), ':', '%3A'), '<', '%3C')) AS frame,
         length(CASE WHEN regexp_matches(text, '\\(###|</turn>)') OR contains(text, E' </turn>\n')
                     THEN regexp_replace(text, '(\\*(###|</turn>))', '\\\1', 'g') ELSE text END) AS body
  FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || E'\n' || text || E'\n', '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(frame + body) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


def op3_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf)).select("doc_id", "size", "source_size", "target", "taken")


def op4_lm(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    out = langid.held_out(F.col("doc_id"), 7, 2)
    model = lm.train(docs.where(~out))
    found = lm.scored(docs, model, out)
    model.drop()
    return found


def op5_bpe(spark: SparkSession, sf: str) -> DataFrame:
    found = encoding.encoded(_documents(spark, sf).select("doc_id", "text"), tokenizer("word_bpe_49k.json"))
    return found.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def op6_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf).select("doc_id", "text", "lang")
    out = langid.held_out(F.col("doc_id"), 3, 1)
    labels, weights = langid.fit(docs.where(~out))
    return langid.predicted(docs.select("doc_id", "text", out.alias("held_out")), labels, weights).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def op7_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.joined(_documents(spark, sf), n=4, threshold=(17, 20))


def op8_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return cws.fingerprints(_documents(spark, sf))


def op9_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    found = prefix_counts.prefix_tables(_documents(spark, sf).select("doc_id", "text"), tokenizer("byte_bpe_50k.json"))
    return found.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > 512).alias("over_limit"),
    )


def op10_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return recipes.duplicates(_documents(spark, sf)).drop("recipe")


SQL_OP10 = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM d WINDOW same AS (PARTITION BY text_sha256)"""

def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    unfit = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~unfit)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vector = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    rows = rows.select("vec_id", label.alias("label"), vector.alias("vector"))
    return negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0, "vec_id")


SQL_OP11 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT a.vec_id AS anchor_id, a.label AS label, a.e AS e, o.vec_id AS positive_id,
         CAST(list_inner_product(a.e, o.e) AS BIGINT) AS positive_score
  FROM v a JOIN v o ON a.label = o.label AND a.vec_id <> o.vec_id WHERE a.vec_id % 50 = 0
  QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY positive_score DESC, o.vec_id) <= 5),
n AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS negative_id, CAST(list_inner_product(a.e, o.e) AS BIGINT) AS negative_score
  FROM v a JOIN v o ON a.label <> o.label WHERE a.vec_id % 50 = 0)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, negative_id, positive_score, negative_score
FROM p JOIN n USING (anchor_id)
WHERE 50 * positive_score <= 100 * negative_score AND 100 * negative_score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id)
QUALIFY row_number() OVER w <= 3"""


def op12_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf))


def op13_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit(_documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))


SQL_OP13 = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS low
  FROM documents),
l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
    CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
    + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS INT)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT)
    + 16 * CAST(coalesce(d.doc_id > low, low IS NOT NULL) AS INT) AS mask
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
g AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM m GROUP BY part, mask),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(letter, bit)),
o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
         [a.letter, b.letter, c.letter, d.letter, e.letter] AS letters, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
s AS (
  SELECT filter_order, k.step, letters[k.step] AS letter, bits[k.step] AS bit, coalesce(list_sum(bits[1:k.step - 1]), 0)::INT AS before
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step) k),
r AS (
  SELECT part, filter_order, step, letter,
    CAST(coalesce(sum(n) FILTER ((mask & (before + bit)) = 0), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER ((mask & bit) > 0 AND (mask & before) = 0), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER ((mask & bit) > 0 AND (mask & before) > 0), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (mask = bit), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER ((mask & bit) > 0 AND (mask & before) = 0), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER ((mask & bit) > 0 AND (mask & before) = 0), 0) AS BIGINT) AS toxic_lost
  FROM g, s GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, CAST(step AS INT) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM r"""

QUERIES = {
    f.__name__: f
    for f in (
        op1_training_order, op2_chat, op3_mix, op4_lm, op5_bpe, op6_language, op7_ngram_join, op8_fingerprints, op9_token_counts,
        op10_exact_dedup, op11_hard_negatives, op12_simhash, op13_filter_audit,
    )
}
SQL = {"op2_chat": SQL_OP2, "op10_exact_dedup": SQL_OP10, "op11_hard_negatives": SQL_OP11, "op13_filter_audit": SQL_OP13}
