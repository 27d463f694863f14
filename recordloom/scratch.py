"""Written intermediate tables, kept in the folder the session names in `spark.checkpoint.dir`."""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The folder named in `spark.checkpoint.dir`, or else one in the warehouse. A warehouse on local disks is
    refused unless driver and executors are one process: the others would not see what one of them wrote."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        if urlparse(root).scheme in ("", "file") and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return root.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/recordloom/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and read it back: later uses neither recompute it nor depend on its lineage."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
