"""Written intermediate tables: they end a lineage that several consumers would otherwise each run again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder of spark.checkpoint.dir. Where that is unset a local master gets a temporary folder; a
    cluster must name one, since no folder of one machine is seen by all of it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = spark._tessera_tables = getattr(spark, "_tessera_tables", None) or "file://" + tempfile.mkdtemp(prefix="tessera-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """df as a Parquet table in the shared folder."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
