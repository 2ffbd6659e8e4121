"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postloom.session import scratch_path


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    The copy cuts the lineage, survives a lost executor, and lets adaptive execution split
    its skewed partitions in later joins.
    """
    path = scratch_path(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
