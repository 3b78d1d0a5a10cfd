"""Managed or external tables of actions, users and products.

``save_actions`` writes ``user_visit_action`` as production should keep it: one folder per date, so a task's date range
prunes folders, and rows bucketed and sorted by session, so that an aggregate by session reads its buckets and shuffles
nothing. The readers check the columns, and take dates and times as text as well as typed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.functions.scalar import parse_time
from shoplens.schema import PRODUCT_INFO, USER_INFO, USER_VISIT_ACTION
from shoplens.sinks.jdbc import save_table

#: Numbers that may be kept narrower than they are worked with.
_WIDENED = {T.LongType(): (T.IntegerType(), T.ShortType(), T.ByteType()), T.IntegerType(): (T.ShortType(), T.ByteType())}


def _as(df: DataFrame, field: T.StructField) -> Column:
    have, want, c = df.schema[field.name].dataType, field.dataType, F.col(field.name)
    if have == want:
        return c
    if isinstance(want, T.TimestampNTZType) and isinstance(have, T.StringType):
        return parse_time(c).cast(want).alias(field.name)
    if isinstance(want, T.TimestampNTZType) and isinstance(have, T.TimestampType):
        return c.cast(want).alias(field.name)  # the session zone's clock, as the text form holds
    if isinstance(want, T.StringType) and isinstance(have, T.DateType) or have in _WIDENED.get(want, ()):
        return c.cast(want).alias(field.name)
    raise TypeError(f"column {field.name} is {have.simpleString()}, not {want.simpleString()}")


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` with its types; missing columns and other types are errors. Stored types are kept as
    they are, so predicates on them still reach the files."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {sorted(df.columns)}")
    return df.select(*[_as(df, f) for f in schema.fields])


def read_actions(spark: SparkSession, table: str) -> DataFrame:
    return typed(spark.table(table), USER_VISIT_ACTION)


def read_users(spark: SparkSession, table: str) -> DataFrame:
    return typed(spark.table(table), USER_INFO)


def read_products(spark: SparkSession, table: str) -> DataFrame:
    return typed(spark.table(table), PRODUCT_INFO)


def save_actions(actions: DataFrame, table: str, buckets: int = 64, path: str | None = None) -> None:
    """Replace ``table``: partitioned by date, bucketed and sorted by session (external if ``path`` is given).

    One shuffle by (date, bucket) before the write gives each date and bucket one file, whatever the number of tasks; a date or
    bucket that holds a large share of the rows is one file, as bucketing wants it.
    """
    bucket = F.pmod(F.hash("session_id"), F.lit(buckets))  # the bucket that Spark writes a row to
    save_table(actions.repartition(F.col("date"), bucket), table, ["date"], (buckets, ["session_id"]), path)
