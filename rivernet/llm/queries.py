"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rivernet.llm import decontaminate, jaccard_join
from rivernet.llm.common import scratch, table


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivernet.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"),
                        scratch(spark, "token-cache"))


def op2_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivernet.llm.bpe_automaton import bpe_round_trip

    return bpe_round_trip(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivernet.llm.langid import identify_language

    return identify_language(table(spark, sf_dir, "documents"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivernet.llm.html_text import extract_main_text

    return extract_main_text(table(spark, sf_dir, "pages"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivernet.llm.suffix_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivernet.llm.quality_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivernet.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivernet.llm.lm_score import score_texts

    return score_texts(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivernet.llm.periodic_runs import find_runs, plant_runs, run_digests

    return run_digests(find_runs(plant_runs(table(spark, sf_dir, "documents"))))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivernet.llm.conversation_repair import find_edits, plant_damage, repair_report

    conversations = table(spark, sf_dir, "conversations")
    turns = plant_damage(conversations)
    return repair_report(conversations, turns, find_edits(turns))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rivernet.llm.token_files import store_tokens, token_digests

    return token_digests(store_tokens(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"),
                                      scratch(spark, "token-file")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_bpe_automaton": op2_bpe_automaton,
    "op3_language_id": op3_language_id,
    "op4_html_text": op4_html_text,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_decontaminate": op6_decontaminate,
    "op7_quality_rules": op7_quality_rules,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_toxicity": op9_toxicity,
    "op10_lm_score": op10_lm_score,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_token_files": op13_token_files,
}

ORACLE: dict[str, str] = {
    "op6_decontaminate": decontaminate.ORACLE,
    "op8_jaccard_join": jaccard_join.ORACLE,
}
