"""The queries of this subpackage and, where SQL can express them, their equivalents for DuckDB."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import ann, fingerprints, jaccard, langid, mixing, packing, sharding, tokenfile, toolcalls, toxicity
from ._shared import table


def op1_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op2_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.histogram_sort_shards(table(spark, sf_dir, "documents"), 16)
    return out.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_prefix_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


#: The tools of op4: their parameters' JSON types, and whether they are required.
TOOLS: toolcalls.Schemas = {
    "answer": {"text": ("string", True), "turn": ("integer", True)},
    "summarise": {"text": ("string", True), "turn": ("integer", True), "style": ("string", False)},
}


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations read as tool use: a user's turn calls `answer` and needs the user's turn before it, a system
    turn calls `summarise` and needs the last user's turn, and so all of them, and an assistant's turn is the result
    of the call of the turn before it. Other roles call a tool that is not known."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ident = lambda turn: F.concat(F.lit("call_"), turn.cast("string"))
    asks = rows.where("role is null or role <> 'assistant'")
    name = F.when(F.col("role") == "user", "answer").when(F.col("role") == "system", "summarise").otherwise(F.col("role"))
    arguments = F.to_json(F.struct("turn", "text"))
    # The user's turns of a conversation, two at a time: each needs the one before it, and the system's the last.
    turns = rows.where("role = 'user'").select("conv_id", "turn").distinct()
    before = turns.withColumn("before", F.lag("turn").over(Window.partitionBy("conv_id").orderBy("turn")))
    users = before.where("before is not null").select("conv_id", "turn", F.array(ident(F.col("before"))).alias("needs"))
    systems = rows.where("role = 'system'").select("conv_id", "turn").distinct()
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("last"))
    systems = systems.join(last, "conv_id").select("conv_id", "turn", F.array(ident(F.col("last"))).alias("needs"))
    needs = users.withColumn("role", F.lit("user")).unionByName(systems.withColumn("role", F.lit("system")))
    calls = asks.join(needs, ["conv_id", "turn", "role"], "left").select("conv_id", ident(F.col("turn")).alias("call_id"), "turn", name.alias("name"), arguments.alias("arguments"), "needs")
    results = rows.where("role = 'assistant'").select("conv_id", ident(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    linked = toolcalls.link(calls, results, TOOLS)
    return linked.withColumn("errors", F.array_join("errors", "; "))


OP4_SQL = """
WITH calls AS (
  SELECT DISTINCT ON (conv_id, turn) conv_id, turn, role, text, count(*) OVER (PARTITION BY conv_id, turn) AS repeats
  FROM conversations WHERE (role IS NULL OR role <> 'assistant') AND conv_id IS NOT NULL AND turn IS NOT NULL
  ORDER BY conv_id, turn, CASE role WHEN 'user' THEN 'answer' WHEN 'system' THEN 'summarise' ELSE role END, text
), results AS (
  SELECT DISTINCT ON (conv_id, turn) conv_id, turn, text FROM conversations WHERE role = 'assistant' ORDER BY conv_id, turn, text
), placed AS (
  SELECT *, max(turn) FILTER (role = 'user') OVER (PARTITION BY conv_id) AS last_turn FROM calls
), leveled AS (
  SELECT *, CASE WHEN role = 'system' AND last_turn >= turn THEN last_turn ELSE turn END AS place, (role IS NOT NULL AND role = 'system' AND last_turn IS NOT NULL AND last_turn >= turn)::INTEGER AS level FROM placed
)
SELECT l.conv_id, 'call_' || l.turn AS call_id, l.turn,
  CASE role WHEN 'user' THEN 'answer' WHEN 'system' THEN 'summarise' ELSE role END AS name,
  row_number() OVER (PARTITION BY l.conv_id ORDER BY place, level, l.turn) - 1 AS position, level,
  CASE WHEN role IN ('user', 'system') THEN CASE WHEN l.text IS NULL THEN 'missing text' ELSE '' END ELSE 'unknown tool' END AS errors, repeats, r.turn AS result_turn,
  '{"arguments":{"text":' || to_json(l.text) || ',"turn":' || l.turn || '},"id":"call_' || l.turn || '","name":"' ||
    CASE role WHEN 'user' THEN 'answer' WHEN 'system' THEN 'summarise' ELSE role END || '","result":' || coalesce(to_json(r.text)::VARCHAR, 'null') || '}' AS canonical
FROM leveled l LEFT JOIN results r ON r.conv_id = l.conv_id AND r.turn = l.turn + 1
"""


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a null id's does not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts == part, F.lit(False))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    return toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out("doc_id", 5, 0))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


OP7_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), by_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight, source_size * 3.0::DOUBLE AS cap FROM by_source
), filled AS (
  SELECT *,
    coalesce(sum(cap) OVER w, 0.0::DOUBLE) AS used,
    sum(weight) OVER () - coalesce(sum(weight) OVER w, 0.0::DOUBLE) AS remaining,
    (sum(source_size) OVER ())::DOUBLE AS total
  FROM weighed
  WINDOW w AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT *, (total - used) / remaining AS level FROM filled
), chosen AS (
  SELECT min_by(level, cap / weight) AS level FROM levels WHERE level * weight <= cap
), targets AS (
  SELECT source, source_size, CASE WHEN source_size = 0 THEN 0.0::DOUBLE ELSE least(cap, chosen.level * weight) END AS target
  FROM levels, chosen
), rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), copied AS (
  SELECT *, (floor(rate) + CASE WHEN ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE
    < rate - floor(rate) THEN 1 ELSE 0 END)::INTEGER AS copies FROM rated
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM copied
"""


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_classes(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokenfile.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def language_model(spark: SparkSession, sf_dir: str) -> langid.Model:
    return langid.fit(table(spark, sf_dir, "documents"), ~held_out("doc_id", 3, 1))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(table(spark, sf_dir, "documents"), language_model(spark, sf_dir))
    return found.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score", "rejected")


QUERIES = {
    "op1_posting_lists": op1_posting_lists,
    "op2_histogram_sort": op2_histogram_sort,
    "op3_prefix_hashes": op3_prefix_hashes,
    "op4_tool_calls": op4_tool_calls,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_toxicity": op6_toxicity,
    "op7_mix_sources": op7_mix_sources,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_token_files": op9_token_files,
    "op10_language": op10_language,
}

ORACLES = {"op4_tool_calls": OP4_SQL, "op7_mix_sources": OP7_SQL}
