"""The subpackage's queries (name -> function of a session and a folder of tables) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import collocations, decontaminate, html_extract, mixing, ngram_join, pii, quality_rules, sharding, spelling, token_store, topk, url_filter, window_dedup
from folioscope.session import table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return sharding.place(docs, slot_col="slot").select("doc_id", "source", "slot", "shard")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"), spark)


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), spark)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), spark).select("doc_id", "size", "source_size", "target", "taken", "shards")


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), spark).select("doc_id", "n_shingles", "component_id")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.score(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), spark)


def op9_token_bitplanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_store.scratch_path(spark)
    token_store.write_store(table(spark, sf_dir, "documents"), path)
    return token_store.digest_store(spark, path)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), spark)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), spark)


def op12_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = window_dedup.without_repeats(table(spark, sf_dir, "documents"), spark)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), spark)


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sized(table(spark, sf_dir, "documents"))


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.ruled(table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_sharding": op2_sharding,
    "op3_pii": op3_pii,
    "op4_exact_topk": op4_exact_topk,
    "op5_mixing": op5_mixing,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_quality_rules": op7_quality_rules,
    "op8_url_filters": op8_url_filters,
    "op9_token_bitplanes": op9_token_bitplanes,
    "op10_decontamination": op10_decontamination,
    "op11_collocations": op11_collocations,
    "op12_window_dedup": op12_window_dedup,
    "op13_spelling_variants": op13_spelling_variants,
    "mix_targets": mix_targets,
    "url_rules": url_rules,
}
ORACLE_SQL = {
    "op2_sharding": sharding.sql(),
    "op4_exact_topk": topk.SQL,
    "op6_ngram_jaccard_join": ngram_join.SQL,
    "op10_decontamination": decontaminate.SQL,
    "op11_collocations": collocations.SQL,
    "op12_window_dedup": window_dedup.SQL,
    "op13_spelling_variants": spelling.SQL,
    "mix_targets": mixing.SIZED_SQL,
    "url_rules": url_filter.RULES_SQL,
}
