"""The corpus pipeline: quality rules, line dedup, MinHash near-dedup, mixing to target weights, best-fit packing.

STAGES are applied in order; the rows of each are written as Parquet and read again as the next one's documents. All but
the last return the columns of documents. Mixing repeats a document's row as often as the mix takes it; packing treats
such rows as documents each on its own.

Results for odd input: documents without words (null and empty texts too) fail the quality rules and go. Rows that are
equal stay together through the first two stages; in near-dedup all rows of a component's smallest doc_id stay, and the
next stages count each. Null lang and source are a group, and a source, of their own; a null doc_id is an id like others,
but for near-dedup, where its row stays only if no row with an id is in its component. Very long texts pass whole, and are
cut only into sequences. Other columns pass all stages but the last. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import stage as written
from tessera.llm.op1_mixing import mix
from tessera.llm.op2_minhash import near_dedup
from tessera.llm.op5_lines import dedup_lines
from tessera.llm.op8_packing import pack_documents
from tessera.llm.op10_quality import quality_filter


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = dedup_lines(docs).select(*docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mixing", mixing), ("packing", packing)]
#: SQL expresses neither the links by chosen paths nor the rounding nor the packing; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
