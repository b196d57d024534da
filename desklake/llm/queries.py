"""The operators as registered queries over whole tables, and their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from desklake.llm import (bpe_codec, chat_format, decontaminate, jaccard_join, language_id, lexical_search, line_dedup,
                          packing, periodic_runs, quality_rules, sharding, suffix_dedup, url_filter)
from desklake.llm.common import let, table, words

RULES = [url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "example.net", "/en/"),
         url_filter.Rule("block", "example.com", "/de/"), url_filter.Rule("allow", "org", "/fr/")]
VOCABULARY, WORD_VOCABULARY = "byte_bpe_50k", "word_bpe_49k"


def vocabulary_files() -> tuple[str, str]:
    """The vocabulary for ``tokenizers`` and the same as ranks, where the installed package has them."""
    import public_tokenizers
    return public_tokenizers.path(f"{VOCABULARY}.json"), public_tokenizers.path(f"{VOCABULARY}.tiktoken")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
    model = language_id.fit(docs.where(~held_out).select("doc_id", "text", "lang"))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), sharding.balanced_tree(regions=3, racks=2, shards=4))
    return placed.withColumn("law", F.lit("key"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), *vocabulary_files())


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES).drop("trust", "distrust")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    quoted = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(quoted).alias("text"))
    everything = turns.select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.digests(chat_format.format_conversations(everything))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup(table(spark, sf_dir, "documents"), least_chars=1, least_documents=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("lost_chars")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    found = bpe_codec.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(f"{WORD_VOCABULARY}.json"))
    return found.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; where the checksum of the id divides by ten, the words from some word on repeat with some period."""
    checksum = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rest = F.floor(checksum / 10)

    def repeated(w: Column) -> Column:
        def from_word(a: Column) -> Column:
            return let(1 + F.floor((F.size(w) - a) / (3 + rest % 8)), lambda p: F.transform(
                F.sequence(F.lit(0), F.size(w) - 1),
                lambda i: w[F.when(i >= a, a + (i - a) % p).otherwise(i).cast("int")]))
        return F.when(F.size(w) > 0, F.array_join(let(rest % F.size(w), from_word), " ")).otherwise("")
    return docs.select("doc_id", F.when(checksum % 10 == 0, let(words(F.col("text")), repeated)).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {query.__name__: query for query in (
    op1_suffix_dedup, op2_language_id, op3_jaccard_join, op4_sharding, op5_best_fit_packing, op6_url_filter, op7_chat_format,
    op8_decontaminate, op9_line_dedup, op10_quality_rules, op11_lexical_search, op12_bpe_codec,
    op13_periodic_runs)}
