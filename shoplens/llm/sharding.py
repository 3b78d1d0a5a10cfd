"""Operator 4: sharding by histogram sort (DataFrame functions only).

Rows are ordered by a text key: 32 hex digits of the text's md5, then 16 of the doc_id, so equal texts
lie together. The boundaries between shards are found by probing: rounds of exact byte counts per key
prefix, each round refining only the few prefixes in which a boundary falls, until each boundary is
exact. Only counts per probed prefix reach the driver (at most 4096 per boundary and round). Then the rows
are exchanged once.

Law ``bytes``: boundary j is where the bytes before it reach j / shards of all. A group of equal texts
of at most ``tolerance`` of a shard stays whole, below the boundary that falls inside it; a larger one
is cut by doc_id. Rows alike in text and doc_id cannot be told apart and stay together.

Slots number each shard's rows from 0 in the pseudorandom order of md5(text digest : doc_id): rows are
counted per (shard, leading hex digits), so no shard is numbered by one task.

Defined results: a null text counts as empty (size 1, crc32 0); null doc_ids come before all others of
their text; an empty table gives no rows; columns of the input named like a result are replaced, all others pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shoplens.llm.common import stored

SHARDS = 8
#: Share of a shard up to which a group of equal texts is kept whole.
TOLERANCE = 0.01
#: Hex digits that one round of probing refines.
STEP = 3
MADE = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def sort_key(text: Column, doc_id: Column) -> Column:
    """Digest of the text, then the id as 16 hex digits in numeric order (none for a null id)."""
    shifted = F.lpad(F.hex(doc_id.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.concat(F.md5(F.coalesce(text, F.lit("")).cast("binary")), F.coalesce(shifted, F.lit("")))


def _common_prefix(a: str, b: str) -> str:
    return a[:next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))]


def splitters(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[str]:
    """Key prefixes p_1 to p_(shards-1) from ``rows`` (_key, size): a row lies beyond boundary j if the
    first len(p_j) characters of its key are above p_j."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total:
        return [""] * (shards - 1)
    found: dict[int, str] = {}
    probe = {j: ("", 0) for j in range(1, shards)}  # boundary: prefix it falls in, bytes below that prefix
    while probe:
        prefixes = sorted({p for p, _ in probe.values()})
        inside = F.coalesce(*[F.when(F.col("_key").startswith(p), F.lit(p)) for p in prefixes])
        counts = rows.withColumn("_in", inside).where(F.col("_in").isNotNull()).groupBy(
            "_in", F.substring("_key", F.lit(1), F.length("_in") + STEP).alias("_bin")
        ).agg(F.sum("size").alias("n"), F.min("_key").alias("lo"), F.max("_key").alias("hi"))
        bins: dict[str, list] = {p: [] for p in prefixes}
        for r in counts.collect():
            bins[r["_in"]].append(r)
        following = {}
        for j, (prefix, below) in probe.items():
            for r in sorted(bins[prefix], key=lambda r: r["_bin"]):
                if shards * (below + r["n"]) >= j * total:
                    break
                below += r["n"]
            one_text = len(r["_bin"]) <= 32 and r["lo"][:32] == r["hi"][:32]
            if r["lo"] == r["hi"]:
                found[j] = r["lo"]
            elif one_text and r["n"] * shards <= tolerance * total:
                found[j] = r["lo"][:32]
            else:
                following[j] = (_common_prefix(r["lo"], r["hi"]), below)
        probe = following
    return [found[j] for j in range(1, shards)]


def shard_of(key: Column, prefixes: list[str]) -> Column:
    out = F.lit(0)
    for p in prefixes:
        out = out + F.when(F.substring(key, 1, len(p)) > F.lit(p), 1).otherwise(0) if p else out
    return out


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, keep_text: bool = True) -> DataFrame:
    """``docs`` (doc_id, text, any other columns) with size, text_crc32, law, shard, slot, grown_shard;
    the text itself crosses the one exchange only if ``keep_text``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = [c for c in docs.columns if c not in MADE and (keep_text or c != "text")]
    rows = docs.select(  # the input in a struct, so no column of it can clash with those made here
        F.struct(*kept, F.lit(0).alias("_always")).alias("_row"), "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), sort_key(F.col("text"), F.col("doc_id")).alias("_key"))
    narrow = stored(rows.select("_key", "size", "doc_id"))
    count = narrow.count()
    digits = next((d for d in (2, 3) if shards * 16 ** d * 1000 >= count), 4)
    placed = lambda df: df.withColumns({
        "shard": shard_of(F.col("_key"), prefixes),
        "_mixed": F.md5(F.concat(F.substring("_key", 1, 32), F.lit(":"),
                                 F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")),
    }).withColumn("_bin", F.substring("_mixed", 1, digits))
    prefixes = splitters(narrow, shards, tolerance)
    order = Window.partitionBy("shard").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    # at most shards * 16 ** 4 narrow rows: a proven bound for the broadcast
    before = placed(narrow).groupBy("shard", "_bin").agg(F.count("*").alias("_n")).select(
        "shard", "_bin", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_before"))
    out = placed(rows).join(F.broadcast(before), ["shard", "_bin"])
    number = F.row_number().over(Window.partitionBy("shard", "_bin").orderBy("_mixed", "_key"))
    return out.select(*[F.col("_row").getField(c).alias(c) for c in kept], "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      (F.col("_before") + number - 1).cast("long").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))


#: The law in closed form; crc32 byte by byte over a table of remainders, as DuckDB has no such function.
ORACLE = r"""
WITH x AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS remainders),
d AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, md5(coalesce(text, '')) AS h,
         xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
           lambda b: ('0x' || b)::BIGINT)), lambda c, b: xor(c >> 8, remainders[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, x),
g AS (SELECT *, sum(size) OVER (ORDER BY h, doc_id NULLS FIRST) - sum(size) OVER (PARTITION BY h, doc_id) AS row_at,
         sum(size) OVER (ORDER BY h) - sum(size) OVER (PARTITION BY h) AS text_at,
         sum(size) OVER (PARTITION BY h) AS text_bytes, sum(size) OVER () AS total FROM d),
s AS (SELECT *, least(7, 8 * (CASE WHEN text_bytes * 8 <= 0.01 * total THEN text_at ELSE row_at END) // total)::INT AS shard FROM g)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard, NULL::INT AS grown_shard,
       (row_number() OVER (PARTITION BY shard ORDER BY md5(h || ':' || coalesce(doc_id::VARCHAR, '')), doc_id NULLS FIRST) - 1)::BIGINT AS slot
FROM s
"""
