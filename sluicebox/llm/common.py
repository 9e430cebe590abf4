"""Helpers shared by the operators: tables, shared folders, cut lineage, learning folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.session import shared_folder


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: lineage ends here, and a lost executor repeats nothing before it.

    The folder belongs to the job's shared area (``spark.checkpoint.dir``), as results are read lazily after the call.
    """
    spark = frame.sparkSession
    path = shared_folder(spark, f"llm-{purpose}")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fold(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % of
