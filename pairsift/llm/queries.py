"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from pairsift.llm import (
    byte_bpe,
    exact_dedup,
    fingerprints,
    language,
    lexical,
    licenses,
    main_text,
    merkle,
    mixing,
    sharding,
    simhash,
    sql,
    substrings,
    word_pieces,
)
from pairsift.llm.common import table

SHARDS = {shard: 1.0 for shard in range(8)}
RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
GROWN = {shard: 1.0 for shard in range(9)}


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder))


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.place(documents(spark, folder), SHARDS, GROWN)


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.dedup(documents(spark, folder))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(documents(spark, folder))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder))


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    return byte_bpe.encode_digests(documents(spark, folder), path, public_tokenizers.PATTERN)


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))
    numbers = range(model.get_piece_size())
    plain = [i for i in numbers if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    vocabulary = [model.id_to_piece(i) for i in plain]
    return word_pieces.count_pieces(documents(spark, folder), vocabulary, PIECES)


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_with_edits(documents(spark, folder))


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.dedup(documents(spark, folder)).drop("kept_text")


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(documents(spark, folder))


def op11_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.extract(table(spark, folder, "pages"))


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(documents(spark, folder), table(spark, folder, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(documents(spark, folder))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_sharding,
        op3_exact_dedup,
        op4_language_id,
        op5_mixing,
        op6_byte_bpe,
        op7_token_counts,
        op8_fingerprints,
        op9_substring_dedup,
        op10_license_scan,
        op11_html_extraction,
        op12_lexical_search,
        op13_merkle_manifest,
    )
}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_sharding": sql.sharding(list(SHARDS), list(GROWN)),
        "op3_exact_dedup": sql.EXACT_DEDUP,
        "op5_mixing": sql.mixing(),
        "op9_substring_dedup": sql.SUBSTRINGS,
        "op10_license_scan": sql.licenses(),
        "op12_lexical_search": sql.SEARCH,
        "op13_merkle_manifest": sql.manifest(),
    }
