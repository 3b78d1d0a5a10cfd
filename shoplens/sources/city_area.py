"""The fixed city -> area dimension (ten rows) and the area -> level mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplens.schema import CITY_AREA

# Fixed values: (city_id, city_name, area), as the task defines them.
CITY_AREA_ROWS = [
    (0, "北京", "华北"), (1, "上海", "华东"), (2, "南京", "华东"),
    (3, "广州", "华南"), (4, "三亚", "华南"), (5, "武汉", "华中"),
    (6, "长沙", "华中"), (7, "西安", "西北"), (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
]

# Area level per area; any other area is D_Level.
AREA_LEVELS = [
    ("华北", "A_Level"), ("华东", "A_Level"),
    ("华中", "B_Level"), ("华南", "B_Level"),
    ("西南", "C_Level"), ("西北", "C_Level"),
]
DEFAULT_AREA_LEVEL = "D_Level"


def city_area(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITY_AREA_ROWS, CITY_AREA)
