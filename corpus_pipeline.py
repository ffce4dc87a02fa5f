"""The corpus pipeline: every stage is written as Parquet and read again as the next one's documents.

A stage takes (spark, docs, sf_dir) and works on all of `docs`; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.llm import decontaminate, mixing, quality_rules, simhash, tokens
from wardlight.llm.common import read, stage
from wardlight.llm.queries import WEIGHTS
from wardlight.workspace import stage_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the decision list learned from the labelled ones go on."""
    return quality_rules.keep(docs, quality_rules.learn_rules(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest id: links of three bits or fewer over three-word shingles."""
    return simhash.one_of_each(docs, shingle=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or a whole shorter item, go."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"), remove="documents")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: the files, by name, and the rows in each follow the schedule."""
    return mixing.in_order(docs, WEIGHTS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in the order of the mix, written and read back; doc_id, start, n_tokens, ids_crc32.

    The order is that of the part files, by their numbers, and of the rows in them: `docs` are files that Spark wrote. Where
    a name holds no part number the job fails.
    """
    part = F.nullif(F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1), F.lit("")).cast("long")
    placed = docs.select("doc_id", "text", F.struct(
        F.coalesce(part, F.raise_error(F.concat(F.lit("no part number: "), F.col("_metadata.file_name"))).cast("long")).alias("part"),
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")).alias("place"))
    path = stage_path(spark, "token-shards")
    tokens.write_shards(placed, path, public_tokenizers.path(tokens.TOKENIZER), order="place")
    return (tokens.documents(tokens.read_shards(spark, path))
            .select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
    ("token_ids", token_ids),
]
#: Learned rules, connected components and a tokenizer are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the rows of the last one."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
