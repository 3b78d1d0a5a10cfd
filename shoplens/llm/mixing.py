"""Operator 5: mixing sources to target weights (DataFrame functions only).

The words of each source, its documents in a pseudorandom order, form one stream that is packed into
blocks of ``block`` words. Targets: weights 5, 2, 1, repeating over the sources by code point (null last),
share all words; none above 3 times its source's size, the excess reshared by weight. A source's
blocks in the mix are its expected number, rounded; each of ``shards`` output shards takes the whole part of its share,
and what remains is drawn multinomially over the shards, so the counts per shard are random and the
source's total lies within a block of its target, at the cap as well. The drawn slots of a source, numbered over all shards, are mapped through a pseudorandom
permutation of its block indices (a new one each time around), and the blocks are joined by index.
A source's slots end at 3 rounds, so no block, hence no document, is taken more than 3 times.

Hot sources: word offsets come from counts per (source, hash bin), slots are dealt out in runs, and joins
run on (source, block); nothing holds a source in one task. Reruns agree: all draws are hashes of a
seed.

Defined results: null text has size 0; documents of size 0 get taken 0; rows alike in doc_id and text are
interchangeable; a null source is a source of its own; an empty table gives no rows; columns of the input
with names made here are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shoplens.llm.common import n_words, small, stored, words

BLOCK, SHARDS, SEED, MOST = 32, 8, 7, 3
WEIGHTS = (5, 2, 1)
ROUNDS = 8
RUN = 1 << 14
MADE = ["size", "source_size", "target", "taken"]


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sizes`` (source, source_size; a row per source) with _sid (rank from 0) and target.

    With caps c and weights w the targets are min(c, w * level); the level is the largest of (all words
    - caps of the sources that fill up earlier) / (weights of the others) over the order of c / w."""
    everything = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*map(F.lit, weights)), F.col("_sid") % len(weights)).cast("double")
    earlier = Window.orderBy("_fill", "_sid").rowsBetween(Window.unboundedPreceding, -1)
    s = sizes.withColumn("_sid", rank).withColumn("_w", weight).withColumn("_cap", (most * F.col("source_size")).cast("double"))
    s = s.withColumn("_fill", F.col("_cap") / F.col("_w"))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(earlier), F.lit(0.0))
    s = s.withColumn("_level", left / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(earlier), F.lit(0.0))))
    s = s.withColumn("target", F.least("_cap", F.col("_w") * F.max("_level").over(everything)))
    return s.select("source", "source_size", "_sid", "target")


def draws(sources: DataFrame, block: int = BLOCK, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Blocks that each output shard takes of each source: _sid, _blocks, shard, n, first (number of the
    source's first slot in the shard). One row per source and shard.

    A source's slots over all shards are its expected number, rounded up or down at random by its fraction; every shard
    gets the whole part of its share, and the rest, fewer than there are shards, is drawn over the shards multinomially."""
    unit = F.pmod(F.xxhash64(F.lit(seed), F.lit("round"), "_sid"), F.lit(1 << 30)) / float(1 << 30)
    s = sources.where(F.col("source_size") > 0).select("_sid", F.ceil(F.col("source_size") / block).cast("long").alias("_blocks"),
                                                       (F.ceil(F.col("source_size") / block) * F.col("target") / F.col("source_size")).alias("_wanted"))
    whole = F.floor(F.col("_wanted") + 1e-9)
    s = s.withColumn("_all", (whole + (unit < F.col("_wanted") - whole).cast("int")).cast("long"))
    drawn = s.select("_sid", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(shards).cast("long"))).alias("_d"), F.pmod("_all", F.lit(shards)).alias("_rest"))
    drawn = drawn.where(F.col("_d") <= F.col("_rest")).select("_sid", F.pmod(F.xxhash64(F.lit(seed), F.lit("draw"), "_sid", "_d"), F.lit(shards)).cast("int").alias("shard"))
    drawn = drawn.groupBy("_sid", "shard").agg(F.count("*").alias("_drawn"))
    out = s.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).join(drawn, ["_sid", "shard"], "left")
    out = out.withColumn("n", F.floor(F.col("_all") / shards) + F.coalesce("_drawn", F.lit(0)))
    before = Window.partitionBy("_sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    return out.select("_sid", "_blocks", "shard", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))


def permuted(index: Column, size: Column, keys: list[Column], rounds: int = ROUNDS) -> Column:
    """Image of ``index`` (0 to size - 1) under a pseudorandom permutation chosen by ``keys``: each round
    pairs x with (k - x) mod size and swaps the pair or not by a hash of its larger member, which is
    one-to-one for any size."""
    def turn(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(r, F.lit("pivot"), *keys), size) - x, size)
        return F.when(F.xxhash64(r, *keys, F.greatest(x, other)).bitwiseAND(F.lit(1)) == 1, other).otherwise(x)
    return F.aggregate(F.array(*map(F.lit, range(rounds))), index.cast("long"), turn)


def slots(drawn: DataFrame, seed: int = SEED) -> DataFrame:
    """A row per drawn slot: shard, _slot (within the shard and source), _sid, _block."""
    runs = drawn.where("n > 0").withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN).cast("long"))))
    # a hot source is one row here; its runs are dealt out before they become slots. The number of tasks is given,
    # as adaptive execution would join the few small rows to one
    runs = runs.repartition(int(drawn.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_sid", "shard", "_run")
    s = runs.withColumn("_slot", F.explode(F.sequence("_run", F.least(F.col("_run") + (RUN - 1), F.col("n") - 1))))
    i = F.col("first") + F.col("_slot")
    s = s.select("shard", "_slot", "_sid", "_blocks", F.floor(i / F.col("_blocks")).alias("_round"),
                 F.pmod(i, F.col("_blocks")).alias("_i"))
    return s.select("shard", "_slot", "_sid", permuted(
        F.col("_i"), F.col("_blocks"), [F.lit(seed), F.col("_sid"), F.col("_round")]).alias("_block"))


def _rows(docs: DataFrame) -> DataFrame:
    return stored(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("_t")))


def _streams(rows: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """Rows with _sid, source_size, target and _start (their first word in the source's stream); sources."""
    sources = stored(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))))
    biggest = rows.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    bits = min(max(4, (biggest // 1000).bit_length()), 18)
    rows = rows.join(small(sources), rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    rows = rows.withColumn("_hash", F.xxhash64(F.lit(seed), "doc_id", "_t")).withColumn(
        "_bin", F.shiftrightunsigned("_hash", 64 - bits))
    bins = rows.groupBy("_sid", "_bin").agg(F.sum("size").alias("_n")).select("_sid", "_bin", F.coalesce(F.sum("_n").over(
        Window.partitionBy("_sid").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_sid", "_bin").orderBy("_hash", "doc_id", "_t", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = rows.join(bins, ["_sid", "_bin"]).withColumn(
        "_start", F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return rows.drop("_bin", "_before", "_hash"), sources


def _pieces(rows: DataFrame, block: int) -> DataFrame:
    """A row per document and block that it reaches into: _block, _offset (in the document), _words."""
    last = F.col("_start") + F.col("size") - 1
    p = rows.where("size > 0").withColumn("_block", F.explode(F.sequence(
        F.expr(f"_start div {block}"), F.floor(last / block).cast("long"))))
    begin = F.greatest(F.col("_start"), F.col("_block") * block)
    return p.withColumn("_offset", begin - F.col("_start")).withColumn(
        "_words", F.least(last + 1, (F.col("_block") + 1) * block) - begin)


def times_drawn(sources: DataFrame, block: int, shards: int, seed: int) -> DataFrame:
    """_sid, _block, _times of the blocks that are taken; never broadcast, as it grows with the words."""
    found = slots(stored(draws(sources, block, shards, seed)), seed).groupBy("_sid", "_block").agg(F.count("*").alias("_times"))
    return found.hint("merge")


def mix_digest(docs: DataFrame, block: int = BLOCK, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: a row per document."""
    rows, sources = _streams(_rows(docs), seed)
    rows = stored(rows)
    drawn = times_drawn(sources, block, shards, seed)
    # a word's place in the stream names its document's row
    taken = _pieces(rows, block).join(drawn, ["_sid", "_block"]).groupBy("_sid", "_start").agg(
        F.sum(F.col("_words") * F.col("_times")).alias("taken"))
    full = rows.where("size > 0").join(taken, ["_sid", "_start"], "left").unionByName(
        rows.where("size = 0").withColumn("taken", F.lit(0).cast("long")))
    return full.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix(docs: DataFrame, block: int = BLOCK, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mix itself, a row per slot's piece: shard, source rank, slot, block, doc_id, source, offset, n_words (the
    words of the document from ``offset`` on)."""
    rows, sources = _streams(_rows(docs), seed)
    taken = slots(stored(draws(sources, block, shards, seed)), seed).join(
        _pieces(rows, block).hint("merge"), ["_sid", "_block"])
    return taken.select("shard", F.col("_sid").alias("source_rank"), F.col("_slot").alias("slot"), F.col("_block").alias("block"),
                        "doc_id", "source", F.col("_offset").alias("offset"), F.col("_words").alias("n_words"))


def mix_documents(docs: DataFrame, block: int = BLOCK, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mix as documents, columns as in ``docs``: copy 1, 2 and 3 of a document hold its words taken at least once,
    twice, three times. A copy of all its words is the row as it was; another one has the taken words, joined by
    spaces, as text (and their length as n_chars, if there is such a column)."""
    own = docs.columns
    rows, sources = _streams(_rows(docs), seed)
    rows = stored(rows)
    drawn = times_drawn(sources, block, shards, seed)
    piece = F.struct(F.col("_offset").alias("at"), F.col("_words").alias("n"), F.col("_times").alias("times"))
    plan = _pieces(rows, block).join(drawn, ["_sid", "_block"]).groupBy("doc_id", "source", "_t", "_sid", "_start", "size").agg(
        F.sort_array(F.collect_list(piece)).alias("_pieces"))
    # rows alike in id, source and text are told apart by a number only
    same = ["_d", "_o", "_t"]
    keys = lambda df: df.withColumns({
        "_d": F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
        "_o": F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))})
    plan = keys(plan).withColumn("_k", F.row_number().over(Window.partitionBy(*same).orderBy("_start")))
    plan = plan.select(*same, "_k", "size", "_pieces")
    inside = keys(docs.select(F.struct(*own).alias("_row"), "doc_id", "source", F.xxhash64("text").alias("_t"))).select(*same, "_row")
    inside = inside.withColumn("_k", F.row_number().over(Window.partitionBy(*same).orderBy("_t")))
    copies = inside.join(plan, [*same, "_k"]).withColumn("_c", F.explode(F.sequence(
        F.lit(1).cast("long"), F.array_max(F.transform("_pieces", lambda p: p["times"])))))
    copies = copies.withColumn("_taken", F.filter("_pieces", lambda p: p["times"] >= F.col("_c")))
    whole = F.aggregate("_taken", F.lit(0).cast("long"), lambda s, p: s + p["n"]) == F.col("size")
    copies = copies.withColumn("_whole", whole)
    # the words are bound to a variable: written in the inner function, they would be split again for each piece
    cut = F.get(F.transform(F.array(words(F.col("_row.text"))), lambda w: F.array_join(F.flatten(F.transform(
        "_taken", lambda p: F.slice(w, p["at"].cast("int") + 1, p["n"].cast("int")))), " ")), F.lit(0))
    copies = copies.withColumn("_text", F.when(F.col("_whole"), F.col("_row.text")).otherwise(cut))
    column = lambda c: F.col(f"_row.{c}") if c not in ("text", "n_chars") else F.col("_text") if c == "text" else F.when(
        F.col("_whole"), F.col("_row.n_chars")).otherwise(F.length("_text")).cast(docs.schema[c].dataType)
    return copies.select(*[column(c).alias(c) for c in own])
