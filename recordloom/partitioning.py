"""Where to cut the work when the size of the rows does not tell how much of it there is."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Deal rows evenly into the session's full number of shuffle partitions, before a step that does much work on
    each. Joins before it keep their adaptive sizes and skew handling."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
