"""The registered queries of this package, with their production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from repopulse.llm import chat, decontaminate, jaccard, lm_score, mixing, packing, pii, quality, ranking, repair, substrings, toxicity, urls
from repopulse.llm.textops import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_sentence_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), extend=True)


def op2_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.stupid_backoff(table(spark, sf_dir, "documents"))


def op3_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op4_likelihood_ratio_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_hashed_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"), urls.rule_table(spark))


def op6_seeded_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_token_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def op8_grouping_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_prefix_target_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = "conv_id long, turn long, role string, text string"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = chat.formatted(rows.unionByName(spark.createDataFrame(list(chat.ADDED), columns)))
    return chat.read_back(turns, chat.examples(turns))


def op10_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_weighted_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(mixing.schedule(table(spark, sf_dir, "documents")))


def op12_grammar_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair.summaries(repair.planned(repair.damaged(rows), rows))


def op13_impact_ordered_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    return {
        "op1_sentence_span_dedup": op1_sentence_span_dedup,
        "op2_stupid_backoff": op2_stupid_backoff,
        "op3_contextual_pii": op3_contextual_pii,
        "op4_likelihood_ratio_quality": op4_likelihood_ratio_quality,
        "op5_hashed_url_rules": op5_hashed_url_rules,
        "op6_seeded_alignment": op6_seeded_alignment,
        "op7_token_group_join": op7_token_group_join,
        "op8_grouping_genetic_packing": op8_grouping_genetic_packing,
        "op9_prefix_target_chat": op9_prefix_target_chat,
        "op10_kneser_ney_toxicity": op10_kneser_ney_toxicity,
        "op11_weighted_fair_mix": op11_weighted_fair_mix,
        "op12_grammar_structure_repair": op12_grammar_structure_repair,
        "op13_impact_ordered_search": op13_impact_ordered_search,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_hashed_url_rules": urls.oracle(),
        "op9_prefix_target_chat": chat.ORACLE,
        "op11_weighted_fair_mix": mixing.ORACLE,
        "op12_grammar_structure_repair": repair.ORACLE,
        "op13_impact_ordered_search": ranking.ORACLE,
    }
