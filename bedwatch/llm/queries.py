"""The registered queries of these operators, each over its whole table, and their SQL where there is one."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from bedwatch.llm import byte_merges, compression_quality, mixing, periodic_runs, resharding, secrets, segment_bounds, simhash
from bedwatch.llm.common import table
from bedwatch.llm.epsilon_join import near_vectors
from bedwatch.llm.license_spans import scan_licenses
from bedwatch.llm.merge_dropout import encode_documents
from bedwatch.llm.multi_index import nearest
from bedwatch.llm.token_files import read_token_files, write_token_files


def vocabulary(name: str) -> str:
    """The path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), least=0.95)


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From shards by source, which are as uneven as the sources, to eight of equal bytes."""
    docs = table(spark, sf_dir, "documents")
    path = resharding.reshard(docs, F.pmod(F.xxhash64(F.coalesce("source", F.lit(""))), F.lit(8)), shards=8)
    return resharding.read_shards(spark, path).withColumns({
        "law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def sentencepiece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_token_files(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, path)


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), top=10, every=100)


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_secrets(
        table(spark, sf_dir, "documents"), repo=F.concat_ws("/", "source", "lang"), owner=F.col("source")))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), tau=2)


def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return compression_quality.score_documents(docs, compression_quality.fit(docs, table(spark, sf_dir, "labels")))


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return segment_bounds.mine_negatives(table(spark, sf_dir, "embeddings").withColumn("label", turned))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = vocabulary("byte_bpe_50k.json")
    encoded = byte_merges.encode_documents(table(spark, sf_dir, "documents"), file)
    return byte_merges.digest(byte_merges.decode_documents(encoded, file))


def repeat_tail(doc_id: int | None, words: list) -> list:
    """The words that `op13` looks at: in one document of ten the tail repeats its first words; a null id changes nothing."""
    hashed, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or hashed % 10 or not n:
        return words
    turn = hashed // 10
    first = turn % n
    period = 1 + (n - first) // (3 + turn % 8)
    return words[:first] + [words[first + k % period] for k in range(n - first)]


def run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.find_runs(table(spark, sf_dir, "documents"), least=12, change=repeat_tail))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": license_scan,
    "op2_embedding_near_dedup": embedding_near_dedup,
    "op3_sharding": sharding,
    "op4_source_mix": source_mix,
    "op5_sentencepiece": sentencepiece_dropout,
    "op6_token_output": token_output,
    "op7_nearest_vectors": nearest_vectors,
    "op8_secret_scan": secret_scan,
    "op9_simhash_near_dedup": simhash_near_dedup,
    "op10_quality_score": quality_score,
    "op11_hard_negatives": hard_negatives,
    "op12_byte_bpe": byte_bpe,
    "op13_periodic_runs": run_detection,
    "pipeline": pipeline,
}

ORACLE: dict[str, str] = {
    "op4_source_mix": mixing.ORACLE,
    "op11_hard_negatives": segment_bounds.ORACLE,
}
