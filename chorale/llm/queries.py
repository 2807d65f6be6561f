"""One query per operator over the whole tables, and the SQL that gives the same rows where SQL can.

The queries only read tables, call an operator and derive the columns that are asked for.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.llm import bpe, chat, line_dedup, minhash, mtree, packing, quality, sharding, substring, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _quality(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return quality.quality_rules(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quality(spark, _table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "chars_per_token", "fallback_share", "token_entropy", "reject_reason",
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), frequent AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5
)
SELECT doc_id, count(*)::BIGINT AS n_lines,
       count(*) FILTER (WHERE keeper IS NOT NULL AND keeper <> doc_id)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                       FILTER (WHERE keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent USING (k) GROUP BY doc_id
"""


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False
    )


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_table(spark, sf_dir, "documents"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(_table(spark, sf_dir, "embeddings"))


OP6_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20
"""


OP5_SQL = r"""
WITH t AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
), b AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents
), c AS (
  SELECT doc_id, n + 1 AS size, xor(list_reduce(
           list_transform(range(n), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
           lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS crc FROM b, t
), p AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id, crc, size ROWS UNBOUNDED PRECEDING)::BIGINT - size AS start, sum(size) OVER ()::BIGINT AS total FROM c
), s AS (SELECT *, least((2 * start + size) * 16 // (2 * total), 15) AS shard FROM p)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, crc, size) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM s
"""

#: The contract's threshold for the query; the pipeline's stage takes the operator's own 80.
NEAR_PERCENT = 85


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"), percent=NEAR_PERCENT)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), d AS (
  SELECT doc_id, count(*) AS n, md5(string_agg(sh, chr(10) ORDER BY sh)) AS k FROM s GROUP BY doc_id
), c AS (SELECT k, min(doc_id) AS rep, any_value(n) AS n FROM d GROUP BY k
), r AS (SELECT s.* FROM s JOIN c ON doc_id = rep
), p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM r x JOIN r y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN c x ON a = x.rep JOIN c y ON b = y.rep WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), reach(node, comp) AS (
  SELECT rep, rep FROM c UNION SELECT l.b, reach.comp FROM reach JOIN l ON reach.node = l.a
), low AS (SELECT node, min(comp) AS comp FROM reach GROUP BY node)
SELECT documents.doc_id, coalesce(d.n, 0)::BIGINT AS n_shingles, coalesce(low.comp, documents.doc_id) AS component_id,
       coalesce(low.comp, documents.doc_id) = documents.doc_id AS kept
FROM documents LEFT JOIN d USING (doc_id) LEFT JOIN c USING (k) LEFT JOIN low ON low.node = c.rep
"""


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    formatted = chat.format_conversations(turns)
    # every column is read back from the examples' strings, and from the turns that are in none
    rows = chat.with_strings(formatted).unionByName(chat.unanswered(formatted))
    reply = F.substring("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    # the last example of a conversation and what follows it are the whole of it
    read = rows.select("conv_id", "example", chat.unescape(reply).alias("reply"), F.concat("text", "after").alias("whole")).select(
        "conv_id",
        F.when(F.col("example").isNotNull(), F.struct("example", "reply")).alias("e"),
        F.char_length("whole").cast("long").alias("formatted_chars"),
        chat.read_text(F.col("whole")).alias("turns"),
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    # replies and rows of fixed width move, no context
    return (
        read.select("conv_id", "e", "formatted_chars", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"))
        .groupBy("conv_id")
        .agg(
            F.max("n_turns").alias("n_turns"),
            F.max("turns_sha256").alias("turns_sha256"),
            F.array_join(F.transform(F.sort_array(F.collect_list("e")), lambda e: e["reply"]), "").alias("loss"),
            F.max("formatted_chars").alias("formatted_chars"),
        )
        .select(
            "conv_id",
            "n_turns",
            "turns_sha256",
            F.char_length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )


OP8_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length(replace(replace(role || text, '&', '&amp;'), '<', '&lt;')) + 23)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.substring_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"), joined=True)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)
), bad AS (
  SELECT doc_id, i FROM s JOIN (SELECT win, min(doc_id) AS low FROM s GROUP BY win) USING (win) WHERE low < doc_id
), gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM bad, (SELECT unnest(range(0, 13)) AS k)
), words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w
), kept AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE g.i IS NOT NULL) AS r,
         string_agg(word, ' ' ORDER BY words.i) FILTER (WHERE g.i IS NULL) AS t
  FROM words LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(r, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.learn(docs, _table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    out = toxicity.score_texts(docs, lexicon)
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


QUERIES = {
    "op1_quality": op1_quality,
    "op2_line_dedup": op2_line_dedup,
    "op3_packing": op3_packing,
    "op4_bpe": op4_bpe,
    "op5_sharding": op5_sharding,
    "op6_top_k": op6_top_k,
    "op7_minhash": op7_minhash,
    "op8_chat": op8_chat,
    "op9_substring": op9_substring,
    "op10_toxicity": op10_toxicity,
}

ORACLE_SQL = {
    "op2_line_dedup": OP2_SQL,
    "op5_sharding": OP5_SQL,
    "op6_top_k": OP6_SQL,
    "op7_minhash": OP7_SQL,
    "op8_chat": OP8_SQL,
    "op9_substring": OP9_SQL,
}
