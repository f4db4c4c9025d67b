"""A corpus pipeline over ``documents``: each stage's output is written as Parquet and read again as the next one's input.

Toxic documents go, then exact copies, then all but one of each group of near copies. The sources are mixed to target weights (no
source above a quarter); what a source has beyond its quota follows after that mix. The mix is the order of the rows in the files of
that stage. All of it is packed into sequences, documents of one length in the order of the mix.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.llm.common import materialize, small_batches
from offerloom.llm.exact_dedup import drop_exact_copies
from offerloom.llm.mixing import mixed
from offerloom.llm.ngram_join import drop_near_copies
from offerloom.llm.packing import pack_documents
from offerloom.llm.queries import table, tokenizer_path
from offerloom.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return drop_near_copies(docs, width=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs, cap=0.25, surplus=True)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    try:  # the row's place in the files that the stage before wrote: number of the file, then of the row
        part = F.regexp_extract("_metadata.file_name", "part-([0-9]+)", 1).try_cast("long")
        placed = docs.select("doc_id", "text", (F.coalesce(part, F.lit(0)) * (1 << 32) + F.col("_metadata.row_index")).alias("place"))
    except AnalysisException:  # not read from files
        return pack_documents(docs, tokenizer_path(), capacity=4096)
    return pack_documents(placed, tokenizer_path(), capacity=4096, place_col="place")


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL can express neither the learned scores nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, applied to the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
