"""Scans of the action / user / product tables with their task constraints.

Production layout: ``user_visit_action`` partitioned by ``date``; the inclusive date range then
prunes whole partitions and the remaining predicates are pushed into the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.params import TaskParams


def in_date_range(date_col: str, params: TaskParams):
    # yyyy-MM-dd strings compare lexically in date order, so the predicate stays a plain
    # string range that Parquet statistics and partition pruning can use.
    bounds = F.lit(True)
    if params.start_date:
        bounds = bounds & (F.col(date_col) >= F.lit(params.start_date))
    if params.end_date:
        bounds = bounds & (F.col(date_col) <= F.lit(params.end_date))
    return bounds


def scan_actions(actions: DataFrame, params: TaskParams) -> DataFrame:
    """A2/B1: actions whose ``date`` lies in [start_date, end_date]."""
    return actions.where(in_date_range("date", params))


def scan_clicks(actions: DataFrame, params: TaskParams) -> DataFrame:
    """A3/B2: (city_id, click_product_id) of product clicks in the date range."""
    return (scan_actions(actions, params)
            .where(F.col("click_product_id") != -1)
            .select("city_id", "click_product_id"))
