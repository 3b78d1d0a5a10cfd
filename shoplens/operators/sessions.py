"""Session analytics: per-session summary, user enrichment, constraint filters, length histograms
and bucket ratios.

Plan shape: one shuffle on ``session_id`` builds the summary with a partial + final aggregate
(min/max/count, flags and ``collect_set`` all combine map-side, so a session holding a huge share of the
rows is reduced before the shuffle); the user join is a plain equi-join that AQE turns into a
broadcast when the filtered user side is small and otherwise splits skewed partitions; the user
predicates (age, sex, profession, city) are pushed below the join into the user scan. The
histogram and ratios are single aggregations -- no accumulators, no driver round trip.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.scalar import half_up_ratio_sql
from shoplens.params import TaskParams

# Visit-length buckets in seconds, (name, lowest, highest), inclusive; None = open.
VISIT_BUCKETS = [
    ("1s_3s", 1, 3), ("4s_6s", 4, 6), ("7s_9s", 7, 9), ("10s_30s", 10, 30),
    ("30s_60s", 31, 60), ("1m_3m", 61, 180), ("3m_10m", 181, 600), ("10m_30m", 601, 1800),
    ("30m", 1801, None),
]
# Step-length buckets in actions, (name, lowest, highest), inclusive; None = open.
STEP_BUCKETS = [
    ("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_30", 10, 30), ("30_60", 31, 60),
    ("60", 61, None),
]

SUMMARY_COLUMNS = ["session_id", "user_id", "start_time", "visit_length", "step_length",
                   "search_keywords", "click_category_ids"]
USER_COLUMNS = ["age", "professional", "sex", "city"]


FLAGS = ["has_keyword", "has_category"]


def session_summary(actions: DataFrame, p: TaskParams = TaskParams()) -> DataFrame:
    """One row per session, and for constraints of ``p`` on keywords or clicked categories (B9) the flags ``has_keyword``,
    ``has_category``: whether any of its actions meets them. The lists are for showing; where they are not shown they are not built."""
    flags = []
    if p.keywords:
        flags.append(F.bool_or(F.col("search_keyword").isin(list(p.keywords))).alias("has_keyword"))
    if p.category_ids:
        wanted = F.col("click_category_id").isin([int(c) for c in p.category_ids])
        flags.append(F.bool_or((F.col("click_category_id") != -1) & wanted).alias("has_category"))
    agg = actions.groupBy("session_id").agg(
        F.expr("min(user_id) AS user_id"),
        F.expr("min(action_time) AS start_time"),
        F.expr("max(action_time) AS end_time"),
        F.expr("count(1) AS step_length"),
        F.expr("array_sort(collect_set(CASE WHEN search_keyword <> '' THEN search_keyword END)) AS kw_list"),
        F.expr("array_sort(collect_set(CASE WHEN click_category_id <> -1 THEN click_category_id END)) AS cat_list"),
        *flags,
    )
    return agg.selectExpr(
        "session_id", "user_id", "start_time",
        "timestampdiff(SECOND, start_time, end_time) AS visit_length",
        "step_length",
        "nullif(array_join(kw_list, ','), '') AS search_keywords",
        "nullif(array_join(cat_list, ','), '') AS click_category_ids",
        *[c for c in FLAGS if c in agg.columns])


def public(df: DataFrame) -> DataFrame:
    """Drop the internal flags."""
    return df.drop(*FLAGS)


def one_user_each(actions: DataFrame) -> bool:
    """Whether every action has a session and no session has actions of two users (or of a user and of none): one
    aggregate over two columns."""
    users = actions.groupBy("session_id").agg(F.min("user_id").alias("a"), F.max("user_id").alias("z"),
                                              F.count("user_id").alias("n"), F.count(F.lit(1)).alias("all"))
    return users.where(F.col("session_id").isNull() | (F.col("a") != F.col("z")) | (F.col("n") != F.col("all")) & (F.col("n") > 0)).isEmpty()


def enrich(summary: DataFrame, users: DataFrame) -> DataFrame:
    """Attach age/profession/sex/city; sessions of unknown users drop (inner join)."""
    u = users.select("user_id", *USER_COLUMNS)
    return summary.join(u, "user_id").select(*SUMMARY_COLUMNS, *USER_COLUMNS, *[c for c in FLAGS if c in summary.columns])


def age_predicate(p: TaskParams) -> Column | None:
    """Inclusive age range, applied only when both bounds are given."""
    if p.start_age is None or p.end_age is None:
        return None
    return F.col("age").between(F.lit(p.start_age), F.lit(p.end_age))


def in_predicates(p: TaskParams) -> list[Column]:
    """Profession / city membership."""
    out = []
    if p.professionals:
        out.append(F.col("professional").isin(list(p.professionals)))
    if p.cities:
        out.append(F.col("city").isin(list(p.cities)))
    return out


def sex_predicate(p: TaskParams) -> Column | None:
    """B8."""
    return None if p.sex is None else (F.col("sex") == F.lit(p.sex))


def overlap_predicates(p: TaskParams) -> list[Column]:
    """Any of the session's keywords / clicked categories is in the given list (flags of a ``session_summary`` for ``p``)."""
    return [F.col(flag) for flag, values in zip(FLAGS, (p.keywords, p.category_ids)) if values]


def session_predicate(p: TaskParams) -> Column | None:
    """Conjunction of every constraint that is present."""
    parts = [c for c in [age_predicate(p), *in_predicates(p), sex_predicate(p),
                         *overlap_predicates(p)] if c is not None]
    return reduce(and_, parts) if parts else None


def user_predicate(p: TaskParams) -> Column | None:
    """The constraints that are attributes of the user (age, profession, city, sex)."""
    parts = [c for c in [age_predicate(p), *in_predicates(p), sex_predicate(p)] if c is not None]
    return reduce(and_, parts) if parts else None


def has_session_constraints(p: TaskParams) -> bool:
    """True when a constraint needs the session's own actions (keywords, clicked categories)."""
    return bool(p.keywords or p.category_ids)


def filter_sessions(enriched: DataFrame, p: TaskParams) -> DataFrame:
    cond = session_predicate(p)
    return enriched if cond is None else enriched.where(cond)


def bucket_sql(col: str, buckets) -> str:
    """CASE expression naming the bucket of ``col`` (NULL when none applies)."""
    arms = " ".join(f"WHEN {col} >= {lo} THEN '{name}'" if hi is None
                    else f"WHEN {col} BETWEEN {lo} AND {hi} THEN '{name}'" for name, lo, hi in buckets)
    return f"CASE {arms} END"


def visit_bucket(col="visit_length") -> Column:
    return F.expr(bucket_sql(col, VISIT_BUCKETS))


def step_bucket(col="step_length") -> Column:
    return F.expr(bucket_sql(col, STEP_BUCKETS))


def length_histogram(sessions: DataFrame) -> DataFrame:
    """(kind, bucket, cnt) for visit and step buckets in one aggregation.

    A zero-second session has no visit bucket (it still counts as a session in the ratios).
    """
    pairs = F.array(
        F.struct(F.lit("visit_length").alias("kind"), visit_bucket().alias("bucket")),
        F.struct(F.lit("step_length").alias("kind"), step_bucket().alias("bucket")))
    return (sessions.select(F.inline(pairs))
            .where(F.col("bucket").isNotNull())
            .groupBy("kind", "bucket").agg(F.count(F.lit(1)).alias("cnt")))


def ratio_columns() -> list[str]:
    return ([f"visit_length_{n}_ratio" for n, _, _ in VISIT_BUCKETS]
            + [f"step_length_{n}_ratio" for n, _, _ in STEP_BUCKETS])


def stat_ratio(sessions: DataFrame) -> DataFrame:
    """Session count and the share of every bucket, half-up to 2 decimals (0 when empty)."""
    b = sessions.selectExpr(f"{bucket_sql('visit_length', VISIT_BUCKETS)} AS vb",
                            f"{bucket_sql('step_length', STEP_BUCKETS)} AS sb")
    counts = [f"count_if(vb = '{n}') AS v_{n}" for n, _, _ in VISIT_BUCKETS]
    counts += [f"count_if(sb = '{n}') AS s_{n}" for n, _, _ in STEP_BUCKETS]
    agg = b.selectExpr("count(1) AS session_count", *counts)
    ratios = [f"coalesce({half_up_ratio_sql(f'v_{n}', 'session_count')}, 0.0D) AS visit_length_{n}_ratio"
              for n, _, _ in VISIT_BUCKETS]
    ratios += [f"coalesce({half_up_ratio_sql(f's_{n}', 'session_count')}, 0.0D) AS step_length_{n}_ratio"
               for n, _, _ in STEP_BUCKETS]
    return agg.selectExpr("session_count", *ratios)
