"""The registered queries over the synthetic tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldkpi.llm import (chat, codes, decontaminate, hnsw, langid, mixing, near_dup, oracles, prefix_trie, quality, secrets, suffix_dedup, toxicity,
                          warc)
from fieldkpi.llm.common import crc_mod, documents


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out(mod: int, rest: int):
    return F.coalesce(crc_mod("doc_id", mod) == rest, F.lit(False))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    """Learned from the labelled rows of ``docs`` that aren't held out."""
    return quality.train(docs.where(~_held_out(4, 2)), _table(spark, sf_dir, "labels"), "quality")


def op1_source_mixing(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir))


# a conversation whose texts hold marks, added to the table
_MARKED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op2_chat_format(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = ", ".join(f"({c}L, {t}L, '{r}', '{x}')" for c, t, r, x in _MARKED)
    more = spark.sql(f"SELECT * FROM VALUES {rows} AS v(conv_id, turn, role, text)")
    return chat.digest(chat.format_turns(turns.unionByName(more)))


def _op2_sql() -> str:
    values = ", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in _MARKED)
    return chat.digest_sql(f"(SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT * FROM (VALUES {values}) v)")


def op3_hnsw_neighbours(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    return hnsw.nearest(vectors.where(F.col("vec_id") % 20 == 0), vectors, 20)


def op4_quality_classifier(spark, sf_dir):
    docs = documents(spark, sf_dir)
    scored = quality.score(docs, quality_model(spark, docs, sf_dir))
    return scored.select("doc_id", _held_out(4, 2).alias("held_out"), "score",
                         F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op5_suffix_array_dedup(spark, sf_dir):
    got = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return got.select("doc_id", "n_bytes", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_decontamination(spark, sf_dir):
    return decontaminate.contamination(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op7_minhash_near_dedup(spark, sf_dir):
    return near_dup.near_duplicates(documents(spark, sf_dir))


def op8_secret_scan(spark, sf_dir):
    got = secrets.scan(documents(spark, sf_dir))
    return got.withColumn("base_sha256", F.sha2("base", 256)).drop("base")


def op9_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = langid.learn(docs.where(~_held_out(3, 1)))
    return langid.predict(docs, model).select("doc_id", _held_out(3, 1).alias("held_out"), "lang_pred", "score", "langs")


def op10_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs.where(~_held_out(3, 1)), _table(spark, sf_dir, "labels"), "toxic")
    return toxicity.score(docs, model).select("doc_id", _held_out(3, 1).alias("held_out"), "score",
                                              F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op11_vector_codes(spark, sf_dir):
    return codes.digest(spark, _table(spark, sf_dir, "embeddings"))


def op12_warc_revisits(spark, sf_dir):
    return warc.digest(spark, _table(spark, sf_dir, "pages"))


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_source_mixing": op1_source_mixing,
    "op2_chat_format": op2_chat_format,
    "op3_hnsw_neighbours": op3_hnsw_neighbours,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_secret_scan": op8_secret_scan,
    "op9_language_id": op9_language_id,
    "op10_toxicity": op10_toxicity,
    "op11_vector_codes": op11_vector_codes,
    "op12_warc_revisits": op12_warc_revisits,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES = {
    "op1_source_mixing": mixing.mix_sql(),
    "op2_chat_format": _op2_sql(),
    "op5_suffix_array_dedup": oracles.suffix_dedup_sql(),
    "op6_decontamination": oracles.contamination_sql(),
    "op7_minhash_near_dedup": oracles.near_duplicates_sql(),
    "op8_secret_scan": oracles.secret_scan_sql(),
    "op11_vector_codes": codes.digest_sql(),
    "op12_warc_revisits": warc.digest_sql(),
    "op13_prefix_trie": prefix_trie.trie_sql(),
}
