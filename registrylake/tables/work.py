"""Intermediate tables in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then uses a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        shared = tempfile.mkdtemp(prefix="registrylake-")
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"


def staged(df: DataFrame, path: str | None = None) -> DataFrame:
    """The same rows read back from a written table, in a new folder unless one is named.

    Cuts the lineage with files that outlive an executor, and gives the planner the
    measured size of the result.
    """
    spark = df.sparkSession
    path = path or work_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
