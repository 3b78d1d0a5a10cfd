"""Batch result writers.

``append_jdbc`` is Spark's JDBC writer in append mode (one row set per task, batched inserts);
``save_table`` replaces a managed table. A ``task_id`` column (B19) can be attached so several
runs share one result table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_task_id(df: DataFrame, task_id: str) -> DataFrame:
    """Tag every result row with the task id (a parameter, so reruns are reproducible)."""
    return df.select(F.lit(task_id).alias("task_id"), *df.columns)


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
                batch_size: int = 1000) -> None:
    props = dict(properties or {})
    (df.write.format("jdbc").mode("append")
     .option("url", url).option("dbtable", table).option("batchsize", batch_size)
     .options(**props).save())


def save_table(df: DataFrame, name: str, partition_by: list[str] | None = None,
               bucket_by: tuple[int, list[str]] | None = None, path: str | None = None) -> None:
    """Replace table ``name`` (external if ``path`` is given)."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1])
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
