"""From documents to token ids: quality, near-duplicates, secrets, mix, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's rows as Parquet to the shared
folder and reads them again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from bedwatch.llm import compression_quality, mixing, secrets, simhash
from bedwatch.llm.common import stage, table
from bedwatch.llm.merge_dropout import encode_documents
from bedwatch.llm.queries import vocabulary


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not reject; it learns from the labels of the documents it is given."""
    return compression_quality.keep_good(docs, compression_quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate component."""
    return simhash.keep_first(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the credentials that belong to few owners."""
    return secrets.redact(docs, repo=F.concat_ws("/", "source", "lang"), owner=F.col("source"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeated(docs, mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    return encode_documents(docs, vocabulary("piece_bpe_32k.model")).select(
        "doc_id", "n_tokens", "n_chars", "text_crc32", "lossless", "ids")


STAGES = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding", encode),
]

#: No SQL: the classifier, fingerprints and segmentation cannot be written in it; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
