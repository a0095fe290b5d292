"""The registered queries of the operators and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterloom.llm import (
    chat, decontam, langid, lmscore, neardup, packing, phrases, pii, quality, sharding, toxicity, variants, warc,
)
from meterloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def word_tokenizer() -> str:
    """The lower-casing word tokenizer of 49k ids; it is read in place."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op1(table(spark, sf_dir, "documents"), word_tokenizer())


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op2(table(spark, sf_dir, "conversations"))


def op3_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op3(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op4(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op5(table(spark, sf_dir, "documents"))


def op6_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.op6(table(spark, sf_dir, "documents"))


def op7_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op7(table(spark, sf_dir, "documents"))


def op8_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op8(table(spark, sf_dir, "pages"))


def op9_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.op9(table(spark, sf_dir, "documents"))


def op10_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.op10(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op11(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.op12(table(spark, sf_dir, "documents"))


def op13_spelling_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.op13(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_packing, op2_chat_format, op3_quality_mcd, op4_pii, op5_language_id, op6_setsketch, op7_lpt_shards,
        op8_arc_to_warc, op9_bloom_lm, op10_spaced_seeds, op11_kneser_ney_toxicity, op12_phrase_automata, op13_spelling_tiles,
    )
}
ORACLES: dict[str, str] = {
    "op2_chat_format": chat.ORACLE_OP2,
    "op6_setsketch": neardup.ORACLE_OP6,
    "op8_arc_to_warc": warc.ORACLE_OP8,
    "op12_phrase_automata": phrases.ORACLE_OP12,
    "op13_spelling_tiles": variants.ORACLE_OP13,
}
