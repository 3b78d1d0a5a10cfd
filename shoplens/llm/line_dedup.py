"""Operator 8: line dedup with keep bitmaps (DataFrame functions only).

Lines are keyed by a 128-bit hash of their stripped, A-Z-lowered text. The (hash, document, position) rows
are range-partitioned by hash, documents descending behind each hash, and position, so that a hash with very
many lines spreads over several tasks, and sorted: a run of equal hashes begins with its first occurrence, the
largest doc_id. One pass over the runs gives each its first document and, by comparing neighbours, its number of
documents. Only a task's first and last run can go on in another task: their parts (two rows a task) are put together
in a small table, which corrects them. Lines of a hash found in at least ``min_docs``
documents are dropped outside its first document. What comes back per document is not text but a
bitmap, as the gaps between dropped lines (and, to apply it without adding them up, their positions).

Defined results: null or empty text is one empty line; a null doc_id counts as a document of its own below
all others; rows with one doc_id are one document, each keeping its own lines; repeated rows get the
same result each; an empty table gives no rows; columns of the input named like a result are replaced, all others pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shoplens.llm.common import WS_CHARS, in_ranges, stored

MIN_CHARS, MIN_DOCS = 40, 5
MADE = ["n_lines", "n_dropped", "kept_text", "kept_sha256"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(line: Column) -> Column:
    """A-Z lowered; plain lower() is the same, and faster, on ASCII."""
    ascii_only = F.octet_length(line) == F.length(line)
    return F.when(ascii_only, F.lower(line)).otherwise(F.translate(line, _UPPER, _LOWER))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def keyed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Lines long enough to count: doc_id, _t (hash of the row's text), _pos, _h1, _h2."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("_t"), F.posexplode(_lines(F.col("text"))).alias("_pos", "_line"))
    lines = lines.withColumn("_line", F.btrim("_line", F.lit(WS_CHARS))).where(F.length("_line") >= min_chars)
    key = _lowered(F.col("_line"))
    return lines.select("doc_id", "_t", "_pos", F.xxhash64(key).alias("_h1"), F.xxhash64(F.lit("second"), key).alias("_h2"))


def counted_runs(docs: DataFrame, min_chars: int = MIN_CHARS, ranges: int | None = None) -> DataFrame:
    """``keyed_lines`` with _docs and _first (in a struct): the number of documents of the line's hash and the largest one."""
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # ascending in these: null documents last, the others from the largest on
    lines = stored(keyed_lines(docs, min_chars).withColumns({"_null": F.col("doc_id").isNull(), "_down": F.bitwise_not("doc_id")}))
    placed = in_ranges(lines, ["_h1", "_h2", "_null", "_down", "_pos"], ranges)
    run = Window.partitionBy("_range", "_h1", "_h2").orderBy("_null", "_down", "_pos")
    before = F.lag(F.struct("doc_id")).over(run)
    new = (before.isNull() | ~before["doc_id"].eqNullSafe(F.col("doc_id"))).cast("long")
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = placed.withColumn("_new", new).withColumns({
        "_docs": F.sum("_new").over(whole), "_first": F.first(F.struct("doc_id")).over(whole)})
    # the hashes at the ends of ranges, and what each range has of them
    key = F.struct("_h1", "_h2")
    ends = placed.groupBy("_range").agg(F.array(F.min(key), F.max(key)).alias("k")).select(F.explode("k").alias("k"))
    ends = ends.select("k.*").distinct()  # at most two rows a range
    row = F.struct("_null", "_down", "doc_id")
    parts = placed.join(F.broadcast(ends), ["_h1", "_h2"], "left_semi").groupBy("_range", "_h1", "_h2").agg(
        (F.count_distinct("doc_id") + F.max(F.col("_null").cast("int"))).alias("n"), F.min(row).alias("lo"), F.max(row).alias("hi"))
    along = Window.partitionBy("_h1", "_h2").orderBy("_range")
    split = F.coalesce((F.lag("hi.doc_id").over(along).eqNullSafe(F.col("lo.doc_id")) & F.lag("hi").over(along).isNotNull()).cast("int"), F.lit(0))
    joined = parts.withColumn("_more", F.col("n") - split).groupBy("_h1", "_h2").agg(
        F.sum("_more").alias("_all"), F.min("lo").alias("_lo"))
    out = seen.join(F.broadcast(joined), ["_h1", "_h2"], "left")
    return out.withColumns({"_docs": F.coalesce("_all", "_docs"), "_first": F.when(F.col("_all").isNull(), F.col("_first.doc_id")).otherwise(
        F.col("_lo.doc_id"))})


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, ranges: int | None = None) -> DataFrame:
    """Per row with dropped lines: doc_id, _t, gaps (numbers of kept lines before each dropped one), _at (the
    dropped lines' positions, which are the gaps added up)."""
    rows = counted_runs(docs, min_chars, ranges)
    dropped = rows.where((F.col("_docs") >= min_docs) & ~F.col("doc_id").eqNullSafe(F.col("_first")))
    at = dropped.groupBy("doc_id", "_t").agg(F.sort_array(F.collect_set("_pos")).alias("_at"))
    before = F.concat(F.array(F.lit(-1)), F.slice("_at", F.lit(1), F.size("_at") - 1))
    return at.select("doc_id", "_t", F.zip_with("_at", before, lambda x, y: x - y - 1).alias("gaps"), "_at")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept_text: the lines that stay, joined by \\n."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text", F.xxhash64("text").alias("_t"))
    b = bitmaps.select(F.col("doc_id").alias("_d"), F.col("_t").alias("_u"), "gaps", "_at")
    out = rows.join(b, rows["doc_id"].eqNullSafe(b["_d"]) & (rows["_t"] == b["_u"]), "left").withColumn(
        "_lines", _lines(F.col("text")))
    # the kept lines run by run: those before each dropped line, then those behind the last
    runs = F.zip_with("_at", "gaps", lambda at, gap: F.slice(F.col("_lines"), at - gap + 1, gap))
    kept = F.concat(F.flatten(runs), F.slice("_lines", F.get("_at", F.size("_at") - 1) + 2, F.size("_lines")))
    text = F.when(F.col("gaps").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(kept, "\n"))
    keep = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in MADE]
    return out.select(*keep, F.size("_lines").cast("long").alias("n_lines"),
                      F.coalesce(F.size("gaps"), F.lit(0)).cast("long").alias("n_dropped"), text.alias("kept_text"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` (doc_id, text, any other columns) with n_lines, n_dropped and kept_text."""
    return apply_bitmaps(docs, stored(keep_bitmaps(docs, min_chars, min_docs)))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS first FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.r, k.doc_id, k.line, k.pos, (f.key IS NOT NULL AND k.doc_id <> f.first) AS gone
      FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""
