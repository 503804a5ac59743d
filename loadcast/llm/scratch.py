"""Written intermediate tables: lineage ends at a Parquet table in the shared checkpoint folder.

A lost executor then costs the tasks it ran, not the whole upstream plan, and a table that
feeds several consumers is computed once. Files stay until the folder is emptied by its owner,
because the returned frames are lazy and may be read at any later time."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from loadcast.session import ensure_checkpoint_dir


def folder(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """ACTION: write ``df`` as Parquet below the checkpoint folder and return the written table."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
