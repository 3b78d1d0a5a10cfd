"""Top-k per group.

``row_number() <= k`` with a literal ``k`` is planned by Spark as a partial ``WindowGroupLimit``
before the shuffle and a final one after it, so each map task forwards at most ``k`` rows per
group: a group holding a third of all rows costs no more shuffle than any other group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order_by: Sequence[Column], k: int,
                    rank_col: str | None = None) -> DataFrame:
    """Rows ranked 1..k inside each group by ``order_by`` (which must be a total order)."""
    w = Window.partitionBy(*group_cols).orderBy(*order_by)
    name = rank_col or "_rank"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= F.lit(k))
    return out if rank_col else out.drop(name)


def top_k(df: DataFrame, order_by: Sequence[Column], k: int) -> DataFrame:
    """Global top-k: ``TakeOrderedAndProject`` keeps k rows per task, then merges."""
    return df.orderBy(*order_by).limit(k)
