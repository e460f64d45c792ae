"""From documents to token ids: five stages, each on all that the one before kept.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir), and all but the last return the columns of
docs. ``run`` writes each stage's result to the shared folder as Parquet and reads it again as the next one's docs, so a
lost executor costs a stage's unfinished tasks at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm import bpe, jaccard, mixing, pii, quality_model
from loomgraph.llm.common import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_model.good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity of 0.8."""
    return jaccard.keep_one(docs, jaccard.Measure(words=5, percent=80))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Private values in text are replaced; n_chars follows the text."""
    out = pii.pseudonymize(docs, key=pii.key_of(spark))
    if "n_chars" in docs.columns:
        changed = F.size(out.columns[-1]) > 0
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources get their weights: a document comes as often as the mix takes it, or goes."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256 and decoded_sha256 of each row."""
    return bpe.encode_ids(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality),
    ("n-gram jaccard join", near_duplicates),
    ("pii", pseudonyms),
    ("mixing", mixing_weights),
    ("byte-level bpe", token_ids),
]

#: A trained classifier and a tokenizer can't be written in SQL; tests/llm hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
