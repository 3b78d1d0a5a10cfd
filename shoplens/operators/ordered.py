"""Neighbours within a key's rows in order, however many rows a key has.

Rows are shuffled by key, but the rows of a hot key by (key, piece), a piece being a range of its order. A seeded
sample finds the hot keys -- those with the share of one task or more -- and, sorted, the borders of their pieces, about two
pieces a task's share; both come as one table of at most a row per task, which is broadcast. Rows that are equal in all order columns are
told apart by a row number, so not even one instant of one key stays in one task. What the sample holds decides how even
the pieces are, never the result. ``followers`` pairs each row with the next: within a piece by a window, which
the shuffle serves, and from piece to piece over the first and last row of each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of the sample that make a task's share.
SAMPLED = 32
SEED = 42


def _share(df: DataFrame, rows: int) -> float:
    """Share of ``df`` that is about ``rows`` rows, by the planner's size of it (files' sizes, so nothing is read), or by a
    count where that is not known."""
    plan = df._jdf.queryExecution().optimizedPlan()
    size = int(str(plan.stats().sizeInBytes()))
    there = df.count() if size >= 1 << 60 else size / (8 + plan.schema().defaultSize())
    return min(1.0, rows / max(1, there))


def in_pieces(df: DataFrame, key: str, order: Sequence[str], tasks: int | None = None) -> DataFrame:
    """``df`` with ``_piece``: 0, 1, ... in ascending order of a hot key's rows, null for all rows of other keys."""
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.withColumn("_tie", F.monotonically_increasing_id())
    at = F.struct(*order, "_tie")
    sample = rows.select(F.col(key).alias("_key"), at.alias("k")).sample(_share(df.select(key, *order), SAMPLED * tasks), SEED)
    found = sample.groupBy("_key").agg(F.sort_array(F.collect_list("k")).alias("s")).where(F.size("s") >= SAMPLED)
    step = SAMPLED // 2
    hot = found.select("_key", F.transform(F.sequence(F.lit(step), F.size("s") - 1, F.lit(step)), lambda i: F.get("s", i)).alias("_borders"))
    told = rows.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_key")), "left")

    def halve(x: Column, _: Column) -> Column:
        middle = F.floor((x["lo"] + x["hi"]) / 2).cast("int")
        above = at >= F.get("_borders", middle)
        return F.when(x["lo"] >= x["hi"], x).otherwise(F.struct(
            F.when(above, middle + 1).otherwise(x["lo"]).alias("lo"), F.when(above, x["hi"]).otherwise(middle).alias("hi")))

    bits = (4 * tasks).bit_length() + 2  # a sample may come out larger than asked for
    search = F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(bits), F.ceil(F.log2(F.size("_borders") + 1)).cast("int") + 1)),
                         F.struct(F.lit(0).alias("lo"), F.size("_borders").alias("hi")), halve)
    return told.withColumn("_piece", F.when(F.col("_key").isNotNull() | F.col("_borders").isNotNull(), search["lo"])).drop("_tie", "_key", "_borders")


def followers(df: DataFrame, key: str, order: Sequence[str], value: str, tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with ``_next``, the value of the next row of the same key and piece, and ``_followed``, whether there is
    one; the pairs ``key, value, next_<value>`` from one piece to the next). Ties in ``order`` and ``value`` are interchangeable."""
    placed = in_pieces(df, key, order, tasks)
    full = [*order, *([value] if value not in order else [])]
    window = Window.partitionBy(key, "_piece").orderBy(*full)
    rows = placed.withColumns({"_after": F.lead(F.struct(F.col(value).alias("v"))).over(window), "_nth": F.row_number().over(window)})
    # the test needs the window, so it is not made before the shuffle, which serves both results
    end = F.when((F.col("_nth") == 1) | F.col("_after").isNull(), F.col("_piece")).isNotNull()
    ends = rows.where(end).groupBy(key, "_piece").agg(F.min(F.struct(*full)).alias("first"), F.max(F.struct(*full)).alias("last"))
    rows = rows.withColumns({"_next": F.col("_after.v"), "_followed": F.col("_after").isNotNull()})
    along = Window.partitionBy(key).orderBy("_piece")  # a few pieces a task's share of rows
    across = ends.withColumn("then", F.lead("first").over(along)).where(F.col("then").isNotNull())
    return rows, across.select(key, F.col(f"last.{value}").alias(value), F.col(f"then.{value}").alias(f"next_{value}"))
