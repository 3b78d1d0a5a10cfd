"""Scalar and aggregate helpers, all as Catalyst expressions (no Python workers).

Each helper returns a ``Column`` so it composes into projections, aggregations and windows and
stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def int_div(a, b) -> Column:
    """Integral division of longs (SQL ``div``), no double round trip."""
    return F.call_function("div", _c(a), _c(b))


# ---- H12: ratio n/d rounded half-up to ``digits`` decimals, computed exactly in integers ----
def half_up_ratio(num, den, digits: int = 2) -> Column:
    """round_half_up(n / d, digits) for non-negative integer n and positive d; null when d = 0.

    ((2*10^digits*n + d) div (2*d)) / 10^digits is exact where a double division followed by
    rounding can land on the wrong side of .5.
    """
    n, d = _c(num).cast("bigint"), _c(den).cast("bigint")
    scale = 10 ** digits
    return F.when(d != 0, int_div(n * (2 * scale) + d, d * 2) / F.lit(float(scale)))


def half_up_ratio_sql(num: str, den: str, digits: int = 2) -> str:
    """The same as ``half_up_ratio`` as a SQL expression over two long columns."""
    scale = 10 ** digits
    return (f"CASE WHEN {den} <> 0 THEN "
            f"(({num} * {2 * scale} + {den}) div ({den} * 2)) / {float(scale)}D END")


# ---- H15: comma-separated id list -> array<bigint>, empty items dropped ----
def ids_array(text) -> Column:
    """'5,6,' -> [5, 6]. Regex split + ``array_remove`` + array cast: no lambda, so the
    expression stays inside whole-stage code generation."""
    parts = F.split(F.trim(_c(text)), r"\s*,\s*")
    return F.array_remove(parts, "").cast("array<bigint>")


# ---- J3: group_concat_distinct -- exact distinct, nulls ignored, sorted, comma joined ----
def group_concat_distinct(value, sep: str = ",") -> Column:
    """Aggregate: distinct non-null values sorted by their own type and joined; null when none."""
    joined = F.array_join(F.array_sort(F.collect_set(_c(value))), sep)
    return F.when(joined != "", joined)


def join_list(values, sep: str = ",") -> Column:
    """Render an array as a ``sep``-joined string; null for an empty or null array."""
    joined = F.array_join(_c(values), sep)
    return F.when(joined != "", joined)


# ---- J1 / H16 ----
def concat_long_string(v1, v2, sep: str = ":") -> Column:
    """'<v1><sep><v2>'; null when either part is null (so a missing city adds nothing to a list)."""
    return F.concat(_c(v1).cast("string"), F.lit(sep), _c(v2))


# ---- J2 / H17 ----
def get_json_field(json_text, field: str) -> Column:
    return F.get_json_object(_c(json_text), f"$.{field}")


# ---- H1-H5, H7-H11: time and text helpers ----
def parse_time(text) -> Column:
    """H1: 'yyyy-MM-dd H:mm:ss' (hour possibly unpadded) -> TIMESTAMP_NTZ."""
    return F.to_timestamp_ntz(_c(text), F.lit("yyyy-MM-dd H:mm:ss"))


def format_time(ts) -> Column:
    """H2: 'yyyy-MM-dd HH:mm:ss'."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")


def format_date(ts) -> Column:
    """H3: 'yyyy-MM-dd'."""
    return F.date_format(_c(ts).cast("date"), "yyyy-MM-dd")


def format_date_key(ts) -> Column:
    """H3: 'yyyyMMdd'."""
    return F.date_format(_c(ts).cast("date"), "yyyyMMdd")


def parse_date_key(text) -> Column:
    """H3: 'yyyyMMdd' -> DATE."""
    return F.to_date(_c(text), "yyyyMMdd")


def format_time_minute(ts) -> Column:
    """H4: 'yyyyMMddHHmm'."""
    return F.date_format(_c(ts), "yyyyMMddHHmm")


def date_hour_key(ts) -> Column:
    """H5: 'yyyy-MM-dd_HH'."""
    return F.date_format(_c(ts), "yyyy-MM-dd_HH")


def seconds_between(start, end) -> Column:
    """H7: whole seconds from ``start`` to ``end`` (truncated)."""
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def yesterday_of(day) -> Column:
    """H8: the day before ``day`` (``yesterday_of(today())`` for the current date)."""
    return F.date_sub(_c(day), 1)


def today() -> Column:
    return F.current_date()


def minute_key_parts(minute_key) -> tuple[Column, Column, Column]:
    """H9: (date yyyyMMdd, hour HH, minute mm) of a 'yyyyMMddHHmm' key."""
    k = _c(minute_key)
    return F.substring(k, 1, 8), F.substring(k, 9, 2), F.substring(k, 11, 2)


def is_empty(text) -> Column:
    """H10."""
    t = _c(text)
    return t.isNull() | (t == "")


def trim_comma(text) -> Column:
    """Strip leading and trailing commas."""
    return F.regexp_replace(_c(text), "^,+|,+$", "")


def pad2(value) -> Column:
    """Left-pad to two characters with '0'."""
    return F.lpad(_c(value).cast("string"), 2, "0")


def field_of_packed(text, field: str) -> Column:
    """Value of ``field`` in a 'k=v|k=v' string (the first if repeated, null when absent)."""
    hits = F.filter(F.split(_c(text), r"\|"), lambda part: part.startswith(f"{field}="))
    return F.substr(F.get(hits, F.lit(0)), F.lit(len(field) + 2))


def set_field_in_packed(text, field: str, value: str) -> Column:
    """Replace the value of ``field`` in a 'k=v|k=v' string."""
    parts = F.transform(F.split(_c(text), r"\|"), lambda part: F.when(
        part.startswith(f"{field}="), F.lit(f"{field}={value}")).otherwise(part))
    return F.array_join(parts, "|")


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``concat_long_string`` and ``get_json_field`` callable from SQL.

    SQL-bodied temporary functions are inlined by the analyzer, so no Python worker runs. The
    aggregate ``group_concat_distinct`` is written in SQL as
    ``listagg(DISTINCT c, ',') WITHIN GROUP (ORDER BY c)``.
    """
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string(v1 BIGINT, v2 STRING, sep STRING)
                 RETURNS STRING RETURN concat(CAST(v1 AS STRING), sep, v2)""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION get_json_field(json STRING, field STRING)
                 RETURNS STRING RETURN get_json_object(json, concat('$.', field))""")


def scalar_showcase(events):
    """H1-H18 applied to the ``events`` table: one output column per helper."""
    ts = F.col("ts")
    k = F.regexp_extract("props", "([0-9]+)", 1)
    unpadded = F.concat(F.date_format(ts, "yyyy-MM-dd "), F.hour(ts).cast("string"),
                        F.date_format(ts, ":mm:ss"))
    minute_key = format_time_minute(ts)
    mk_date, mk_hour, mk_minute = minute_key_parts(minute_key)
    text = F.when(F.col("event_type") == "error", F.lit(None).cast("string")) \
        .when(F.col("event_type") == "click", F.lit("")).otherwise(F.col("event_type"))
    packed = F.concat(F.lit("event="), F.col("event_id").cast("string"), F.lit("|type="),
                      F.col("event_type"), F.lit("|k="), k)
    ratio = half_up_ratio(F.col("event_id") % 200, F.col("user_id") % 17 + 1)
    pair = F.concat_ws("_", (F.col("event_id") % 10).cast("string"),
                       ((F.col("event_id") + 1) % 10).cast("string"))
    cutoff = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return events.select(
        "event_id",
        parse_time(unpadded).alias("parsed_time"),
        format_time(ts).alias("time_text"),
        format_date(ts).alias("date_text"),
        format_date_key(ts).alias("date_key"),
        parse_date_key(format_date_key(ts)).cast("string").alias("date_from_key"),
        minute_key.alias("minute_key"),
        date_hour_key(ts).alias("date_hour"),
        (ts < cutoff).alias("is_before"),
        (ts > cutoff).alias("is_after"),
        seconds_between(F.to_date(ts).cast("timestamp_ntz"), ts).alias("seconds_of_day"),
        yesterday_of(F.to_date(ts)).cast("string").alias("yesterday"),
        mk_date.alias("mk_date"), mk_hour.alias("mk_hour"), mk_minute.alias("mk_minute"),
        is_empty(text).alias("text_is_empty"),
        trim_comma(F.concat(F.lit(","), k, F.lit(",,"))).alias("trimmed"),
        pad2(F.hour(ts)).alias("hour_padded"),
        ratio.alias("ratio"),
        field_of_packed(packed, "type").alias("packed_type"),
        set_field_in_packed(packed, "type", "x").alias("packed_set"),
        join_list(ids_array(F.concat(k, F.lit(",,"), (k.cast("bigint") * 2).cast("string"), F.lit(","))))
        .alias("id_list"),
        concat_long_string("user_id", "event_type", ":").alias("user_label"),
        get_json_field("props", "k").alias("json_k"),
        F.concat_ws("=", pair, ratio.cast("string")).alias("rate_text"),
    )
