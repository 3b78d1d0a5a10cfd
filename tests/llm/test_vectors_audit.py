"""Vector search, clustering and the source audit against brute force, with edge cases."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shoplens.llm import orchard, perfect_hash, source_audit, vector_topk

NAN, INF = float("nan"), float("inf")
FLOATS = "vec_id long, embedding array<float>, row long, score string, _t int"


def f32(x):
    return float(np.float32(x))


def whole(v, scale):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(scale * f32(x)) for x in v]


def brute_top(vectors, k, every):
    rows = [(i, w) for i, v in vectors if (w := whole(v, 1024)) is not None and sum(x * x for x in w) <= 2 ** 62]
    out = []
    for a, (qi, q) in enumerate(rows):
        if qi is not None and qi % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(q, w)), i is None, i or 0) for b, (i, w) in enumerate(rows) if b != a)
            out += [(qi, r + 1, None if no else i, -s) for r, (s, no, i) in enumerate(scored[:k])]
    return sorted(out, key=str)


def vector_rows(n, seed, lengths=True):
    r = random.Random(seed)
    out = [(i, [r.gauss(0, 1) * (r.choice([0.1, 1, 30]) if lengths else 1) for _ in range(64)]) for i in range(n)]
    out += [(n + i, out[7][1]) for i in range(25)]  # ties
    return out + [(n + 30, None), (n + 31, [1.0] * 63 + [None]), (n + 32, [NAN] * 64), (n + 33, [INF] + [0.0] * 63), (n + 34, []),
                  (n + 35, [0.5, 0.25]), (7, out[7][1]), (None, out[5][1]), (None, [0.0] * 64), (n + 36, [3e38] * 64), (n + 37, [1e5] * 64)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], FLOATS)


@pytest.mark.parametrize("rows", [64, 1 << 20])
def test_top_k_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(vector_topk, "BLOCK_ROWS", rows)  # several blocks, or one
    monkeypatch.setattr(vector_topk, "SLAB", 32)
    vectors = vector_rows(400, 3)
    got = vector_topk.top_k(frame(spark, vectors), F.col("vec_id") % 20 == 0, k=7).collect()
    assert sorted(map(tuple, got), key=str) == brute_top(vectors, 7, 20)


def test_top_k_many_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(vector_topk, "BLOCK_VALUES", 64 * 40)
    monkeypatch.setattr(vector_topk, "CHUNK", 16)
    vectors = vector_rows(300, 4, lengths=False)
    got = vector_topk.top_k(frame(spark, vectors), F.col("vec_id") % 5 == 0, k=3).collect()
    assert sorted(map(tuple, got), key=str) == brute_top(vectors, 3, 5)


def test_top_k_small_tables(spark):
    query = F.col("vec_id") % 100 == 0
    assert vector_topk.top_k(frame(spark, []), query).count() == 0
    assert vector_topk.top_k(frame(spark, [(0, [1.0])]), query).count() == 0
    assert vector_topk.top_k(frame(spark, [(0, None), (1, [2.0])]), query).count() == 0
    got = vector_topk.top_k(frame(spark, [(0, []), (100, []), (3, [2.0])]), query).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 3, 0), (0, 2, 100, 0), (100, 1, 0, 0), (100, 2, 3, 0)]


def test_top_k_prunes(monkeypatch):
    """Vectors too short to be found are not looked at."""
    monkeypatch.setattr(vector_topk, "SLAB", 32)
    long, short = np.eye(64)[:20] * 5 + 50, np.random.default_rng(1).normal(size=(2000, 64)) / 8
    seen = []
    x = np.floor(np.vstack([long, short]) * 1024).astype(int)
    n2 = (x.astype(float) ** 2).sum(axis=1)
    order = np.argsort(-n2, kind="stable")
    lists = pa.array([list(map(int, r)) for r in x[order]], pa.list_(pa.int64()))
    ids = pa.array(order)
    part = pa.RecordBatch.from_arrays([ids, ids, lists, pa.array(n2[order])], ["row", "id", "v", "n2"])
    queries = pa.RecordBatch.from_arrays([*part.columns, pa.nulls(part.num_rows, pa.int64())], [*part.schema.names, "least"]).slice(0, 10)
    block = vector_topk._Block([part], 64, np.eye(64), 5)
    turned = block.v.turned

    class Watched:
        def __getitem__(self, key):
            seen.append(len(key[0]) if isinstance(key, tuple) else 0)
            return turned[key]

    block.v.turned = Watched()
    found = block._search(queries)
    assert found.num_rows == 50 and sum(seen) <= 4 * 64


def brute_clusters(vectors, k, rounds, dims=64):
    rows = [(i, w) for i, v in vectors if v is not None and len(v) == dims and (w := whole(v, 256)) is not None and sum(x * x for x in w) <= 2 ** 58]
    head = sorted((i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "", w) for i, w in rows)
    cs = [w for _, _, w in head[:k]]
    near = lambda w: min((sum((x - y) ** 2 for x, y in zip(w, c)), n) for n, c in enumerate(cs))
    for _ in range(rounds):
        own = [near(w)[1] for _, w in rows]
        cs = [[sum(col) // len(col) for col in zip(*m)] if (m := [w for (_, w), o in zip(rows, own) if o == n]) else c for n, c in enumerate(cs)]
    found = [(i, *near(w)) for i, w in rows]
    total = Counter()
    for _, d, n in found:
        total[n] += d
    return sorted(((i, n, d, total[n], sum(total.values()), hashlib.sha256(",".join(map(str, cs[n])).encode()).hexdigest()) for i, d, n in found), key=str)


@pytest.mark.parametrize("n,k", [(400, 40), (10, 40), (60, 1), (100, 2)])
def test_cluster_brute_force(spark, n, k):
    vectors = vector_rows(n, n)
    got = orchard.cluster(frame(spark, vectors), k=k, rounds=3).collect()
    assert sorted(map(tuple, got), key=str) == brute_clusters(vectors, k, 3)


def test_cluster_ties_and_empty(spark):
    r = random.Random(5)
    vectors = [(i, [float(r.randint(-1, 1)) / 256 for _ in range(4)]) for i in range(300)]  # few places, many ties
    got = orchard.cluster(frame(spark, vectors), k=30, dims=4).collect()
    assert sorted(map(tuple, got), key=str) == brute_clusters(vectors, 30, 5, 4)
    assert orchard.cluster(frame(spark, [])).count() == 0
    assert orchard.cluster(frame(spark, [(1, None), (2, [1.0])])).count() == 0


def test_orchard_visits_fewer():
    """Distances to far centroids are not computed."""
    rng = np.random.default_rng(2)
    centroids = rng.integers(-10_000, 10_000, (50, 3))
    lists = orchard.Orchard(centroids.tolist())
    x = centroids[rng.integers(0, 50, 500)] + rng.integers(-20, 20, (500, 3))
    rows = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                rows.append(len(key))
            return np.asarray(super().__getitem__(key))

    lists.at = lists.at.view(Watched)
    found, _ = lists.nearest(x)
    assert (found == ((x[:, None] - centroids[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert sum(rows) < 500 * 49 * 0.7


def brute_audit(docs, least):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = [(lang or "", s or "", [t.translate(low) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for lang, s, text in docs]
    df, n, out = Counter(), Counter(), []
    for lang, s, ts in rows:
        df.update({(lang, t) for t in ts})
        n.update((lang, s, t) for t in ts)
    for lang in {x[0] for x in rows}:
        kept = sorted(t for (la, t), c in df.items() if la == lang and c >= least)
        sources = sorted({x[1] for x in rows if x[0] == lang})
        def shares(own):
            counts = [sum(n[lang, s, t] for s in own) for t in kept]
            return [1 + 10 ** 9 * (c + 2) // (sum(counts) + 2 * len(kept)) for c in counts]
        p, q = {s: shares([s]) for s in sources}, shares(sources)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(map(f, p[s], p[o])), o.encode(), o) for o in sources if o != s]
            terms = [(-f(a, b), t.encode(), t) for t, a, b in zip(kept, p[s], q) if n[lang, s, t] and a > b]
            for part, items, most in (("pair", pairs, None), ("term", terms, 10)):
                out += [(lang, s, part, item, -v, r + 1) for r, (v, _, item) in enumerate(sorted(items)[:most])]
    return sorted(out)


def corpus():
    r = random.Random(9)
    words = [f"{r.choice('abcdeéßжя漢')}{r.choice('xyzÄ')}{'qrstuvw'[i % 7]}{'hijkl'[i % 5]}{'mnop'[i % 4]}" for i in range(300)]
    docs = [(r.choice(["en", "de", None, "", "a\0b"]), r.choice(["s1", "s2", None, "", "b\0c", *(f"t{i}" for i in range(9))]),
             " ".join(r.choice(words[:r.choice([10, 300])]) for _ in range(r.randint(0, 60)))) for _ in range(500)]
    docs += [("en", "hot", "Same SAME same1same-Éé\nx_y\tz")] * 200 + [("xx", "lone", "only here"), ("xx", "other", None), ("yy", None, "")]
    return docs + [("en", "s1", "word " * 40_000 + "漢" * 30_000)]


@pytest.mark.parametrize("hashed,counters,sources", [(1 << 21, 1 << 23, 256), (100, 60, 3), (0, 1, 1)])
def test_audit_brute_force(spark, monkeypatch, hashed, counters, sources):
    monkeypatch.setattr(source_audit, "SHARD", 16)
    monkeypatch.setattr(source_audit, "TEXT", 2000)
    docs = corpus()
    df = spark.createDataFrame([(i, *d, 1, "x") for i, d in enumerate(docs)], "doc_id long, lang string, source string, text string, n int, term string")
    got = source_audit.audit(df, hashed=hashed, counters=counters, sources=sources).collect()
    assert sorted(map(tuple, got)) == brute_audit(docs, 10)


def test_audit_empty(spark):
    df = spark.createDataFrame([], "doc_id long, lang string, source string, text string")
    assert source_audit.audit(df).count() == 0


def test_perfect_hash_is_minimal_and_verified():
    rng = random.Random(1)
    keys = sorted({f"k{rng.randrange(10 ** 9)}" for _ in range(3000)})
    h1, h2 = perfect_hash.paired(tuple(x.repeat(len(keys)) for x in perfect_hash.digests([b"en"])), perfect_hash.digests([k.encode() for k in keys]))
    slot, how = perfect_hash.build(h1, h2)
    assert sorted(slot) == list(range(len(keys)))
    stored = pa.array([k.encode() for k in keys], pa.large_binary()).take(pa.array(np.argsort(slot)))
    hashes = perfect_hash.Hashes(np.array([len(keys)]), how, ["en"], np.zeros(len(keys), np.int32), stored)
    probe = keys + [f"absent{i}" for i in range(3000)]
    found = hashes.find(np.zeros(len(probe), np.int64), perfect_hash.digests([k.encode() for k in probe]), pa.array([k.encode() for k in probe], pa.large_binary()))
    assert (found[:len(keys)] == slot).all() and (found[len(keys):] == -1).all()
