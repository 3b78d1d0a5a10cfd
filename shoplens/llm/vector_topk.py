"""Exact top-k search by inner product: vectors in order of descending length, rotated partial sums, residual bounds.

Every vector becomes whole numbers. Their second moments, summed over all rows, give the singular directions; a
vector turned into these directions has most of its length in its first components. The vectors are ranged by
descending length into blocks. A first job holds every query against the leading block, whose k-th score bounds
from below what the answer must reach; by Cauchy-Schwarz a block whose longest vector times the query's length
stays below that cannot hold an answer, and the query is not sent there. A task holds one block, in order of
descending length, and lets queries stream by: partial sums over the first turned components plus the product of
the lengths of both rests bound a score from above, so most vectors are given up after a part of their components,
and a block's scan ends at the first vector that is too short. What survives is scored in whole numbers.

A query travels to the blocks it may find answers in, a vector to one task per million queries; nothing is
broadcast but the rotation (at most 256 x 256) and one number per block.

Defined cases: null vectors and vectors with null or non-finite components take no part, nor do those with a
squared length over 2^62, whose scores no long holds. Vectors of different lengths are compared as if the shorter
one were filled up with zeros; the empty vector scores 0. Rows with equal vec_id are different rows, and each is
a candidate of the other. A null vec_id is a candidate, last among ties, and never a query. Equal rows tie and
come in any order. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shoplens.llm.common import stored
from shoplens.llm.vectors import integer_vectors, matrix

#: Components a task holds at most, vectors a block has at least (where there are as many), queries a task answers.
BLOCK_VALUES, BLOCK_ROWS, CHUNK = 1 << 24, 1024, 1 << 20
#: Leading components that are turned; any further ones follow as they are.
ROTATED = 256
LONGEST = 2.0 ** 62
#: Queries and vectors of one step in a task, pairs scored at once.
QUERIES, SLAB, PAIRS = 256, 2048, 1 << 16
#: Rounding of the turned sums, as a share of the product of both lengths (far above what doubles lose).
ROUNDING = 1e-10

FOUND = "q_row long, q_id long, row long, id long, score long"


def _moments(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros((width, width))
    for b in batches:
        x = matrix(b.column("v"), max(width, int(max([0, *np.diff(b.column("v").offsets.to_numpy())]))))[:, :width].astype(float)
        total += x.T @ x
    i, j = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "g"])


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Singular directions of all vectors' first ``width`` components, strongest first."""
    sums = vectors.select("v").mapInArrow(lambda it: _moments(it, width), "i long, j long, g double")
    g = np.zeros((width, width))
    for i, j, x in sums.groupBy("i", "j").agg(F.sum("g")).collect():  # at most 256 x 256 numbers
        g[i, j] = x
    return np.linalg.eigh(g)[1][:, ::-1]


class _Side:
    """Vectors of one side: whole numbers, turned components, lengths, lengths of the rest after each cut."""

    def __init__(self, lists: pa.Array, n2: np.ndarray, width: int, turn: np.ndarray, cuts: list[int]):
        self.whole = matrix(lists, width)
        real = self.whole.astype(float)
        self.turned = np.hstack([real[:, :len(turn)] @ turn, real[:, len(turn):]])
        self.length = np.sqrt(n2)
        rest = np.cumsum((self.turned ** 2)[:, ::-1], axis=1)[:, ::-1]
        self.rest = {z: np.sqrt(rest[:, z]) if z < width else np.zeros(len(real)) for z in cuts}


class _Block:
    """One block's vectors in order of descending length."""

    def __init__(self, parts: list[pa.RecordBatch], width: int, turn: np.ndarray, k: int):
        t = pa.Table.from_batches(parts).combine_chunks()
        self.width, self.turn, self.k = width, turn, k
        self.cuts = sorted({max(1, width // n) for n in (8, 4, 2, 1)}) if width else []
        self.v = _Side(t["v"].chunk(0), t["n2"].to_numpy(), width, turn, self.cuts)
        self.row = t["row"].to_numpy()
        self.no_id = t["id"].is_null().to_numpy()
        self.id = t["id"].fill_null(0).to_numpy()

    def search(self, queries: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for a in range(0, queries.num_rows, QUERIES):
            yield self._search(queries.slice(a, QUERIES))

    def _search(self, queries: pa.RecordBatch) -> pa.RecordBatch:
        k, v = self.k, self.v
        q = _Side(queries.column("v"), queries.column("n2").to_numpy(), self.width, self.turn, self.cuts)
        q_row = queries.column("row").to_numpy()
        least = queries.column("least").to_numpy(zero_copy_only=False).astype(float)  # to reach; null: NaN
        least = np.where(np.isnan(least), -np.inf, least)
        hits = np.zeros((0, 3), np.int64)  # query, position, score
        for s in range(0, len(self.row), SLAB):
            slack = q.length * v.length[s] * ROUNDING + 0.5
            on = np.flatnonzero(q.length * v.length[s] + slack >= least)
            if not len(on):
                break  # all further vectors are shorter still
            at, bound, slack = np.arange(s, min(s + SLAB, len(self.row))), least[on][:, None], slack[on][:, None]
            sums, done = np.zeros((len(on), len(at))), 0
            live = np.ones(sums.shape, bool)
            for z in self.cuts:
                sums += q.turned[on, done:z] @ v.turned[at, done:z].T
                live = sums + q.rest[z][on][:, None] * v.rest[z][at][None, :] + slack >= bound
                some = live.any(axis=0)
                at, sums, live, done = at[some], sums[:, some], live[:, some], z
            if len(at) > k:  # the k-th best of this slab (one more, as one may be the query itself)
                live &= sums >= np.partition(sums, len(at) - k - 1, axis=1)[:, len(at) - k - 1][:, None] - 2 * slack
            i, j = np.nonzero(live)
            i, j = on[i], at[j]
            other = q_row[i] != self.row[j]
            i, j = i[other], j[other]
            score = np.empty(len(i), np.int64)
            for a in range(0, len(i), PAIRS):
                score[a:a + PAIRS] = np.einsum("ij,ij->i", q.whole[i[a:a + PAIRS]], v.whole[j[a:a + PAIRS]])
            hits = np.vstack([hits, np.column_stack([i, j, score])])
            j = hits[:, 1]
            hits = hits[np.lexsort((self.row[j], self.id[j], self.no_id[j], -hits[:, 2], hits[:, 0]))]
            first = np.searchsorted(hits[:, 0], np.arange(len(q_row) + 1))
            rank = np.arange(len(hits)) - first[hits[:, 0]]
            full = np.flatnonzero(np.diff(first) >= k)
            least[full] = np.maximum(least[full], hits[first[full] + k - 1, 2])
            hits = hits[rank < k]
        i, j, score = hits.T
        return pa.RecordBatch.from_arrays(
            [pa.array(q_row[i]), queries.column("id").take(pa.array(i)), pa.array(self.row[j]),
             pa.array(self.id[j], mask=self.no_id[j]), pa.array(score)], ["q_row", "q_id", "row", "id", "score"])


def _scan(batches: Iterator[pa.RecordBatch], width: int, turn: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """Rows come by block and chunk of queries, first the block's vectors, then the queries."""
    here, parts, block = None, [], None
    for b in batches:
        key = np.column_stack([b.column(n).to_numpy() for n in ("block", "chunk", "kind")])
        edges = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1), len(key)] if len(key) else [0]
        for a, z in zip(edges, edges[1:]):
            if here != tuple(key[a, :2]):
                here, parts, block = tuple(key[a, :2]), [], None
            if key[a, 2] == 0:
                parts.append(b.slice(a, z - a))
            elif parts:
                block = block or _Block(parts, width, turn, k)
                yield from block.search(b.slice(a, z - a))


def _held(queries: DataFrame, blocks: DataFrame, chunks: int, tasks: int, width: int, turn: np.ndarray, k: int) -> DataFrame:
    """The k best of its block for each query row (with the block it is sent to)."""
    sides = (blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), F.lit(0).alias("kind"),
                           "row", "id", "v", "n2", F.lit(None).cast("long").alias("least"))
             .unionByName(queries.select("block", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int").alias("chunk"),
                                         F.lit(1).alias("kind"), "row", "id", "v", "n2", "least")))
    dealt = sides.repartition(tasks, "block", "chunk").sortWithinPartitions("block", "chunk", "kind", F.col("n2").desc(), "row")
    return dealt.mapInArrow(lambda it: _scan(it, width, turn, k), FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q_row").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the ``k`` vectors with the highest inner product with each query row."""
    spark = vectors.sparkSession
    rows = stored(integer_vectors(vectors, vector_col, scale, LONGEST, row=F.monotonically_increasing_id(),
                                  id=F.col(id_col).cast("long"), is_query=F.coalesce(is_query, F.lit(False))))
    n, width, n_queries = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0)),
                                   F.count_if("is_query")).first()
    turn = rotation(rows, min(width, ROTATED))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_blocks = max(1, -(-n * width // BLOCK_VALUES), min(tasks, n // BLOCK_ROWS))
    ranged = rows.repartitionByRange(n_blocks, F.col("n2").desc(), F.col("row"))
    blocks = stored(ranged.select(F.spark_partition_id().alias("block"), "row", "id", "v", "n2", "is_query"))
    longest = sorted(blocks.groupBy("block").agg(F.sqrt(F.max("n2"))).collect())  # one number per block
    queries = blocks.where("is_query").drop("is_query", "block")
    if not longest:
        longest = [(0, 0.0)]
    lead = longest[0][0]
    chunks = max(1, min(tasks, n_queries // QUERIES), n_queries // CHUNK)
    first = stored(_held(queries.withColumns({"block": F.lit(lead), "least": F.lit(None).cast("long")}),
                         blocks.where(F.col("block") == lead), chunks, chunks, width, turn, k))
    least = first.groupBy("q_row").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least"))
    rest = np.array([b for b, _ in longest[1:]], np.int32)
    reach = np.array([x for _, x in longest[1:]])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bound = b.column("least").to_numpy(zero_copy_only=False).astype(float)
            length = np.sqrt(b.column("n2").to_numpy())[:, None]
            sent = length * reach[None, :] * (1 + ROUNDING) + 0.5 >= np.where(np.isnan(bound), -np.inf, bound)[:, None]
            i, j = np.nonzero(sent)
            for a in range(0, len(i), 1 << 14):
                part = b.take(pa.array(i[a:a + (1 << 14)]))
                yield pa.RecordBatch.from_arrays([pa.array(rest[j[a:a + (1 << 14)]]), *part.columns], ["block", *part.schema.names])

    found = first
    if len(rest):
        told = queries.join(least.withColumnRenamed("q_row", "row"), "row", "left")
        sent = told.select("row", "id", "v", "n2", "least").mapInArrow(
            route, "block int, row long, id long, v array<bigint>, n2 double, least long")
        chunks = max(1, n_queries // CHUNK)
        found = first.unionByName(_held(sent, blocks.where(F.col("block") != lead), chunks, max(tasks, len(rest) * chunks),
                                        width, turn, k))
    return _best(found, k).select(F.col("q_id").alias("query_id"), F.col("rank").cast("int").alias("rank"),
                                  F.col("id").alias("vec_id"), "score")


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, c.r AS cr,
    list_sum(list_transform(list_zip(q.e, c.e), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0)))::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 100 = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, cr) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM o WHERE rank <= 10
"""
