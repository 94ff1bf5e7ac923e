"""The stages of the corpus pipeline: each applies one operator to all that the one before it kept.

toxicity drops the documents that the models reject; near duplicates keeps one document of each group, the
one with the smallest doc_id (null last; of rows that repeat it, the first); decontamination drops documents
that hold benchmark passages; mixing repeats and orders documents for the target weights of their sources; token output encodes them.
Both decide on each row by its number, whatever its doc_id. All but the last return the columns of `documents`. Empty tables pass through every stage.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.common import discard, read_table, stored, stored_paths
from eventmart.llm.decontaminate import contamination
from eventmart.llm.jaccard_join import near_duplicates
from eventmart.llm.mixing import mixed_stream
from eventmart.llm.token_output import token_output
from eventmart.llm.toxicity import without_toxic

#: Setting of the session that names a new folder for the token corpus; without it, it lies in the shared folder.
CORPUS = "eventmart.corpus.folder"
#: Column of a row's number within a stage.
ROW = "pipeline_row"


_left: dict[str, list[str]] = {}


def stage(function):
    """A stage that first deletes what the stage before it had stored: by then that one's result is written and reread."""

    @wraps(function)
    def begun(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        discard(spark, *_left.pop(application, []))
        before = set(stored_paths(spark))
        out = function(spark, docs, sf_dir)
        _left[application] = [p for p in stored_paths(spark) if p not in before]
        return out

    return begun


@stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, read_table(spark, sf_dir, "labels"))


def numbered(docs: DataFrame) -> DataFrame:
    """docs with a number of its own for each row, stored so that it stays the same."""
    return stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows", compression="zstd")


@stage
def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = numbered(docs)
    group = near_duplicates(rows, key=ROW).select(ROW, "component_id").join(rows.select(ROW, "doc_id"), ROW)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)).alias("first")
    kept = group.groupBy("component_id").agg(first).select(F.col(f"first.{ROW}").alias(ROW))
    return rows.join(kept, ROW, "left_semi").select(*docs.columns)


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = numbered(docs)
    found = contamination(rows, read_table(spark, sf_dir, "benchmark"), key=ROW).filter("contaminated").select(ROW)
    return rows.join(found, ROW, "left_anti").select(*docs.columns)


@stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_stream(docs, in_files=True)  # a stage's documents are the files of the one before


@stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_output(docs, public_tokenizers.path("word_bpe_49k.json"), folder=spark.conf.get(CORPUS, None))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicate), ("decontamination", decontamination), ("mixing", mixing), ("token_output", tokens)]

#: The models, the join and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; the corpus itself is in the folder that CORPUS names (see token_output.read_blocks)."""
    docs = read_table(spark, sf_dir, "documents")
    for n, (name, step) in enumerate(STAGES):
        before, docs = docs, stored(step(spark, docs, sf_dir), name)
        if n:
            discard(spark, before)
    discard(spark, *_left.pop(spark.sparkContext.applicationId, []))
    return docs
