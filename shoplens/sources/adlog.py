"""The advertisement click log -- ``<epoch ms> <province> <city> <userid> <adid>`` lines.

Parsing is ``split`` + ``try_cast``; a line with fewer than five fields, a non-numeric number, a time outside the years
1 to 9999 or an inner extra blank goes (blanks at the end and further fields are ignored) to the quarantine output instead of failing the task. The same function serves
batch DataFrames and streaming DataFrames (any source with a string ``value`` column -- Kafka in
production, files in tests).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.scalar import format_date_key
from shoplens.schema import AD_LOG_RAW


def millis_to_ntz(ms: Column) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ (UTC wall clock), independent of the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MILLISECOND", ms, epoch)


def _fields(lines: DataFrame) -> DataFrame:
    """Split each line once: (value, ms, province, city, userid, adid, ok). The split stands behind a generator of one
    row, as the optimiser would otherwise copy it into every field and every test that uses one."""
    once = lines.select("value", F.explode(F.array(F.split(F.rtrim("value"), " "))).alias("p"))
    p = F.col("p")
    f = once.select("value", F.size(p).alias("_n"), p[0].try_cast("bigint").alias("ms"),
                    p[1].alias("province"), p[2].alias("city"),
                    p[3].try_cast("bigint").alias("userid"), p[4].try_cast("bigint").alias("adid"))
    # years 1 to 9999; other times are no clicks, and some do not fit a timestamp
    ok = (F.col("_n") >= 5) & F.col("ms").between(F.lit(-62135596800000), F.lit(253402300799999)) & (F.col("province") != "") \
        & (F.col("city") != "") & F.col("userid").isNotNull() & F.col("adid").isNotNull()
    return f.withColumn("ok", F.coalesce(ok, F.lit(False)))


def parse_ad_log(lines: DataFrame, zone: str = "UTC") -> DataFrame:
    """Well-formed lines as (ts, date, province, city, userid, adid); ``ts``, and with it every day, hour and minute key, is the
    wall clock of ``zone``."""
    ts = millis_to_ntz(F.col("ms"))
    ts = ts if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)
    return _fields(lines).where("ok").select(ts.alias("ts"), format_date_key(ts).alias("date"),
                                            "province", "city", "userid", "adid")


def quarantine(lines: DataFrame) -> DataFrame:
    """The malformed lines, unchanged."""
    return _fields(lines).where(~F.col("ok")).select("value")


def read_ad_log_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                       fmt: str = "text") -> DataFrame:
    """A stored log: one line per text line (or a parquet ``value`` column)."""
    reader = spark.readStream.format(fmt)
    if fmt != "text":
        reader = reader.schema(AD_LOG_RAW)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(F.col("value").cast("string").alias("value"))


def kafka_options(brokers: str, topics: str, starting: str | dict = "latest", max_per_trigger: int | None = None,
                  group: str | None = None, **more: str) -> dict[str, str]:
    """Options of the Kafka source. ``starting`` holds for a first start only -- later the checkpoint's offsets do -- and is
    ``latest``, ``earliest`` or offsets ``{topic: {partition: offset}}`` (-2 earliest, -1 latest)."""
    if not brokers.strip() or not topics.strip():
        raise ValueError("brokers and topics are needed")
    if isinstance(starting, dict):
        unknown = set(starting) - {t.strip() for t in topics.split(",")}
        if unknown:
            raise ValueError(f"offsets for topics that are not read: {sorted(unknown)}")
        starting = json.dumps({t: {str(p): int(o) for p, o in of.items()} for t, of in starting.items()})
    elif starting not in ("latest", "earliest"):
        raise ValueError("starting is latest, earliest or a dictionary of offsets")
    out = {"kafka.bootstrap.servers": brokers, "subscribe": topics, "startingOffsets": starting, "failOnDataLoss": "true", **more}
    if max_per_trigger:
        out["maxOffsetsPerTrigger"] = str(int(max_per_trigger))
    if group:
        out["groupIdPrefix"] = group
    return out


def read_ad_log_kafka(spark: SparkSession, brokers: str, topics: str, **options) -> DataFrame:
    """The live log (``kafka_options``); needs Spark's Kafka connector on the class path."""
    return (spark.readStream.format("kafka").options(**kafka_options(brokers, topics, **options)).load()
            .select(F.col("value").cast("string").alias("value")))
