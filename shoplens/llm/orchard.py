"""Centroid clustering (Lloyd's rounds) whose nearest centroids are found by Orchard's search.

For each centroid all others are listed by their distance from it. A vector starts at centroid 0 and walks that
list; each centroid met is marked visited, a visited one costs nothing, and when one is closer the walk jumps to
the beginning of its list. It stops strictly beyond twice the current distance: by the triangle inequality no
centroid that is as near can come later, so ties are met too and go to the smaller number. A task moves all
vectors of a batch one step at a time. All numbers are whole; squares are compared (gap > 4 * distance).

The vectors are stored once and read once a round. Each task adds up its own vectors by centroid, so ``k`` rows a
task are shuffled however unevenly the vectors fall to the clusters, and ``k * (dims + 1)`` sums are the only thing
that reaches the driver.

Defined cases: vectors that are null, have null or non-finite components or not exactly ``dims`` components are
left out, as are those with a squared length over 2^58 (their distances would not fit a long). Rows with equal ids
count each; a null id is kept and comes last among the seeds. With fewer than ``k`` vectors each is a centroid. Equal
centroids tie, so the smaller number takes the vectors and the other one stays. Other columns are ignored; an empty
table gives no rows. A sum of distances that no long holds is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shoplens.llm.common import stored
from shoplens.llm.vectors import integer_vectors, matrix

LONGEST = 2.0 ** 58
#: Vectors that walk at a time.
STEP = 4096


class Orchard:
    """Sorted neighbour lists of some centroids."""

    def __init__(self, centroids: list[list[int]]):
        self.at = np.array(centroids, np.int64)
        gap = np.array([((self.at - c) ** 2).sum(axis=1) for c in self.at])
        np.fill_diagonal(gap, -1)  # a centroid heads its own list, which is then left out
        self.near = np.argsort(gap, axis=1, kind="stable")[:, 1:]
        self.gap = np.take_along_axis(gap, self.near, axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid (the smallest of several) and the squared distance, for each row."""
        ends = len(self.at) - 1
        here = np.zeros(len(x), np.int64)  # whose list is walked
        found = here.copy()
        least = ((x - self.at[0]) ** 2).sum(axis=1)
        place = np.zeros(len(x), np.int64)
        visited = np.zeros((len(x), ends + 1), bool)
        visited[:, 0] = True
        walking = np.arange(len(x)) if ends else np.zeros(0, np.int64)
        while len(walking):
            c, p = here[walking], place[walking]
            on = (p < ends) & (self.gap[c, np.minimum(p, ends - 1)] <= 4 * least[walking])
            walking, c, p = walking[on], c[on], p[on]
            place[walking] += 1
            j = self.near[c, p]
            new = ~visited[walking, j]
            who, j = walking[new], j[new]
            visited[who, j] = True
            d = ((x[who] - self.at[j]) ** 2).sum(axis=1)
            tie = (d == least[who]) & (j < found[who])
            found[who[tie]] = j[tie]
            closer = d < least[who]
            who, j = who[closer], j[closer]
            here[who], found[who], least[who], place[who] = j, j, d[closer], 0
        return found, least


def _walk(batches: Iterator[pa.RecordBatch], lists: Orchard) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for b in batches:
        for a in range(0, b.num_rows, STEP):
            part = b.slice(a, STEP)
            x = matrix(part.column("v"), lists.at.shape[1])
            yield part, x, *lists.nearest(x)


def _sums(vectors: DataFrame, centroids: list[list[int]]) -> dict[int, list[int]]:
    """Sum of the vectors of each non-empty cluster, their count last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Orchard(centroids)
        k, dims = lists.at.shape
        total = np.zeros((k, dims + 1), np.int64)
        for _, x, found, _ in _walk(batches, lists):
            order = np.argsort(found, kind="stable")
            own, start = np.unique(found[order], return_index=True)
            total[own, :dims] += np.add.reduceat(x[order], start, axis=0)
            total[:, dims] += np.bincount(found, minlength=k)
        own = np.flatnonzero(total[:, dims])
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own].tolist(), pa.list_(pa.int64()))], ["cluster", "s"])

    parts = vectors.select("v").mapInArrow(run, "cluster long, s array<bigint>").select("cluster", F.posexplode("s").alias("i", "x"))
    sums: dict[int, dict[int, int]] = {}
    for c, i, x in parts.groupBy("cluster", "i").agg(F.sum(F.col("x").cast("decimal(38,0)"))).collect():
        sums.setdefault(c, {})[i] = int(x)
    return {c: [s[i] for i in range(len(s))] for c, s in sums.items()}


def cluster(vectors: DataFrame, k: int = 40, dims: int = 64, rounds: int = 5, scale: int = 256, salt: str = "2:",
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col``, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 of each vector. The first centroids are the
    ``k`` vectors with the smallest sha256 of ``salt`` and the id."""
    spark = vectors.sparkSession
    whole = vectors.where(F.size(F.col(vector_col)) == dims)
    rows = stored(integer_vectors(whole, vector_col, scale, LONGEST, id=F.col(id_col)))
    order = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256).asc_nulls_last()
    centroids = [list(r.v) for r in rows.orderBy(order, "v").limit(k).select("v").collect()]
    if not centroids:
        return rows.select(F.col("id").alias(id_col), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"),
                           F.lit(0).cast("long").alias("cluster_inertia"), F.lit(0).cast("long").alias("inertia"),
                           F.lit("").alias("centroid_sha256"))
    for _ in range(rounds):
        for c, (*s, n) in _sums(rows, centroids).items():
            centroids[c] = [x // n for x in s]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, found, least in _walk(batches, Orchard(centroids)):
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found.astype(np.int32)), pa.array(least)],
                                             ["id", "cluster", "distance"])

    kind = dict(rows.dtypes)["id"]
    assigned = stored(rows.select("id", "v").mapInArrow(assign, f"id {kind}, cluster int, distance long"))
    inertia = {c: int(s) for c, s in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}
    fit = lambda x: x if x < 1 << 63 else None
    facts = [(c, fit(s), fit(sum(inertia.values())), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
             for c, s in inertia.items()]  # k rows at most
    told = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(told), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(rounds: int = 5) -> str:
    assign = ("a{0} AS (SELECT r, arg_min({{n: n, d: d}}, d * 64 + n) AS b FROM (SELECT v.r, c.n, (v.n2 + c.n2 - 2 * "
              "list_dot_product(v.e, c.e))::BIGINT AS d FROM v, c{0} c) GROUP BY r)")
    steps = ["""v AS (SELECT *, list_dot_product(e, e) AS n2 FROM (
      SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
      WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))))""",
             """c0 AS (SELECT n, e, n2 FROM (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, e) - 1 AS n, e, n2 FROM v)
      WHERE n < 40)"""]
    for i in range(rounds):
        steps += [assign.format(i), f"""s{i} AS (SELECT b.n AS n, i, sum(e[i])::BIGINT AS s, count(*) AS m
      FROM a{i} JOIN v USING (r), unnest(range(1, 65)) AS t(i) GROUP BY 1, 2)""",
                  f"""m{i} AS (SELECT n, list(((s - ((s % m) + m) % m) // m)::DOUBLE ORDER BY i) AS e FROM s{i} GROUP BY n)""",
                  f"""c{i + 1} AS MATERIALIZED (SELECT n, e, list_dot_product(e, e) AS n2
      FROM (SELECT c.n, coalesce(m.e, c.e) AS e FROM c{i} c LEFT JOIN m{i} m USING (n)))"""]
    return "WITH " + ",\n".join([*steps, assign.format(rounds)]) + f"""
SELECT vec_id, b.n::INTEGER AS cluster, b.d AS distance, sum(b.d) OVER (PARTITION BY b.n)::BIGINT AS cluster_inertia,
  sum(b.d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(list_transform(c.e, lambda x: x::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} c ON c.n = b.n"""


ORACLE = _oracle()
