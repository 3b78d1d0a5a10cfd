"""Lazily built input tables for one (session, data folder) pair."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from shoplens.sources import testdata
from shoplens.sources.city_area import city_area


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return testdata.read_table(self.spark, self.sf_dir, name)

    @cached_property
    def actions(self) -> DataFrame:
        return testdata.user_visit_action(self.spark, self.sf_dir)

    @cached_property
    def users(self) -> DataFrame:
        return testdata.user_info(self.spark, self.sf_dir)

    @cached_property
    def products(self) -> DataFrame:
        return testdata.product_info(self.spark, self.sf_dir)

    @cached_property
    def cities(self) -> DataFrame:
        return city_area(self.spark)

    @cached_property
    def ad_log(self) -> DataFrame:
        return testdata.ad_log(self.spark, self.sf_dir)
