"""A corpus from raw documents to packed sequences: each stage works on what the one before kept.

1. toxicity: documents scored 0.5 or more go.
2. exact dedup: of texts equal but for white space one row stays.
3. near dedup: of documents linked by five-word shingles with a similarity of 0.8 or more
   the one with the smallest doc_id stays.
4. secrets: found secrets are replaced by a mark; every document stays.
5. packing: pieces of at most 4096 tokens, placed in sequences of balanced cost.

All but the last return the columns of `documents`, whatever further ones those have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mapflow.llm import exact_dedup, near_dedup, packing, secrets, toxicity
from mapflow.llm.common import stored, table, tokenizer_path


REMEMBERED = 150_000


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicate(docs, words=5, percent=80)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, path="source" if "source" in docs.columns else None)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Executors have grown by the stages before: workers remember fewer encoded pieces here.
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), table_size=REMEMBERED)


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: Classifiers, MinHash and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
