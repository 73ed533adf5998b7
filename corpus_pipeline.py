"""Documents to packed training sequences, in stages that are written as Parquet and read again.

Each stage takes all that the one before kept and returns the columns of its input, but for the last, which returns
pieces of sequences. Extra columns are carried along; null and empty texts fail the quality rules.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.llm import language, packing, quality, simhash
from duebook.llm.common import cut, delete, prepare, shared_folder

TOKENIZER = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of the standard policy."""
    prepare(spark)
    ledger = quality.with_ledger(docs)
    return ledger.filter(quality.kept()).select(*[f"`{c}`" for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are surely in a language that the labelled ones among them teach; those in none go.

    A table without languages, or without any label, teaches none, so that there is nothing to go by and all stay.
    """
    prepare(spark)
    if "lang" not in docs.columns:
        return docs
    model = language.fit(docs.filter(~language.held_out(F.col("doc_id"))))
    if not model.languages:
        return docs
    return docs.filter(language.sure(language.predicted(docs["text"], model, docs), model))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by fingerprints of 3-word shingles at 3 or fewer differing bits."""
    prepare(spark)
    return simhash.one_of_each(docs, words_in_shingle=3)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("SimHash near-dedup", near_duplicates),
    ("best-fit packing", packed_sequences),
]
#: No SQL expresses the later stages; tests hold run() against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents. What lies between two stages is kept in the shared folder until the end."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for n, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
    done = cut(STAGES[-1][1](spark, docs, sf_dir))
    delete(spark, folder)
    return done
