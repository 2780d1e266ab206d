"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventide.llm import decontam, language, lines, merkle, mixing, neardup, prefixjoin, quality, secrets, tokens, trie, urls, warc
from eventide.llm.common import table
from eventide.llm.links import similar_sets_sql


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.warc_round_trip(table(spark, sf_dir, "pages"), min_revisit_bytes=0)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_lines", "n_removed", "text")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = language.identify(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "held_out", "lang_pred", "score")


def op10_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), ngram=4)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered_documents(table(spark, sf_dir, "documents")).drop("copied")


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op13_prefixjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixjoin.prefix_join(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_decontamination, op2_warc, op3_lines, op4_mixing, op5_quality, op6_tokens, op7_secrets, op8_urls, op9_language, op10_neardup, op11_merkle, op12_trie, op13_prefixjoin)
    return {f.__name__: f for f in found}


def oracles() -> dict[str, str]:
    return {
        "op2_warc": warc.oracle(),
        "op8_urls": urls.oracle(),
        "op10_neardup": similar_sets_sql(4, 80, ", min(other) = doc_id AS kept"),
        "op11_merkle": merkle.oracle(),
        "op12_trie": trie.oracle(),
        "op13_prefixjoin": similar_sets_sql(5, 80),
    }
