"""From raw documents to token files: five stages, each reading what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tremorline.llm.common import saved
from tremorline.llm.decontaminate import clean_documents
from tremorline.llm.jaccard_join import one_of_each_group
from tremorline.llm.language_ppm import readable_documents
from tremorline.llm.mixing import mixed_documents
from tremorline.llm.queries import tokenizer_path
from tremorline.llm.token_files import token_index
from tremorline.llm.words import SLICE_BYTES

# Words that a token file's writer remembers here: executors still hold what the stages before left.
_REMEMBERED = 1 << 18


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents in no recognisable language."""
    return readable_documents(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: the one with the smallest id."""
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove documents that hold a copy of a benchmark item."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources meet their target weights."""
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token files and return their index as read back, one row per document written."""
    return token_index(docs, tokenizer_path(), slice_bytes=SLICE_BYTES, remembered=_REMEMBERED)


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_output", token_output),
]

# Language models, alignments and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read back by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
