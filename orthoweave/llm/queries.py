"""The registered queries of the operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orthoweave.llm import (
    decontamination, line_dedup, merkle, mixing, ngram_model, oracles, packing, quality_classifier, quality_rules, ranked_search, simhash, suffix_dedup, token_output,
    warc)
from orthoweave.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function
    return register


@query("op1_quality_rules", oracles.QUALITY_RULES)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.clean_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_removed_lines", "n_lost_words")


@query("op2_decontamination")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_warc")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


@query("op4_mixing", oracles.MIXING)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_summary(table(spark, sf_dir, "documents"))


@query("op5_lm_scoring")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_model.held_out_scores(spark, table(spark, sf_dir, "documents"), ngram_model.EVERY)


@query("op6_simhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op7_line_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.decisions(table(spark, sf_dir, "documents"), whole=True).drop("text_key")


@query("op8_quality_classifier")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_suffix_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("kept")


@query("op10_token_output")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_output.token_digest(table(spark, sf_dir, "documents"), path)


@query("op11_packing")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op12_merkle_manifest", oracles.MERKLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proof_digest(table(spark, sf_dir, "documents"))


@query("op13_ranked_search", oracles.RANKED_SEARCH)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
