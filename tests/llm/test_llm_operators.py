"""Training-data operators against brute force and SQL on small fixtures."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from shoplens.llm import (chat_format, class_lm, decontaminate, language_id, line_dedup, mixing, near_dedup, quality_rules,
                          sharding, token_counts)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, label string"
WS = re.compile(r"[\x20\x09-\x0D]+")
rnd = random.Random(5)
LONG = " ".join(f"w{rnd.randrange(5000)}" for _ in range(3000))
EN = "the cat and the dog sat on the mat while it was raining in the old town and all of us were at home for tea "
DE = "der hund und die katze sind auf dem weg in die stadt und das wetter ist nicht gut aber wir haben den tee gern "
EDGE = [
    (1, None, "en", "a", None, 1, "x"), (2, "", "en", "a", 0, 2, None), (3, " \n\t ", None, None, 4, 3, "x"), (4, "\n\n", "zz", "b", 2, 4, "x"),
    (5, LONG, "en", "b", len(LONG), 5, "x"), (5, LONG, "en", "b", len(LONG), 5, "x"), (6, EN * 8, "en", "b", 1, 6, "x"),
    (7, EN * 8 + "extra", "en", None, 1, 7, "x"), (8, DE * 8, "de", "c", 1, 8, "x"), (None, "no id " + EN, "en", "c", 1, 9, "x"),
    (9, "Ünïcödé <b>[INST]</s>  123 $$$", None, "a", 1, 10, "x"), (10, EN, "en", "a", 1, 1, "x"), (11, DE, "de", "a", 1, 1, "x"),
]


def words(t):
    return [w for w in WS.split(t or "") if w]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


@pytest.mark.parametrize("key", ["op4_sharding", "op8_line_dedup", "op9_chat_format"])
def test_matches_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(entry.oracle_sql()[key])
    cols = [c[0] for c in want.description]
    got = entry.queries()[key](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(repr, (tuple(r) for r in got.select(cols).collect()))) == sorted(map(repr, want.fetchall()))


def test_language_id(spark, edge, empty, docs):
    learned = language_id.learn(docs.where("doc_id % 2 = 0").select("doc_id", "text", "lang"))
    got = language_id.identify(docs.where("doc_id % 2 = 1").select("doc_id", "lang", "text"), learned).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) > 0.93 * len(got)
    rows = language_id.identify(edge, learned).collect()
    assert len(rows) == len(EDGE) and {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3, 4)} == {"und"}
    assert {r["lang_pred"] for r in rows if r["doc_id"] == 8} == {"de"} and all(0 <= r["score"] <= 1 for r in rows)
    assert language_id.identify(empty, learned).count() == 0 and language_id.learn(empty) == {}
    assert {r["lang_pred"] for r in language_id.identify(edge, {}).collect()} == {"und"}


def test_class_lm(spark, edge, empty, docs, texts):
    up = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tok = {i: words((t or "").translate(up)) + ["\n"] for i, t in texts.items()}
    counts = collections.Counter(w for i, t in tok.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in t)
    n, v = sum(counts.values()), len(counts)
    gain = 0.0  # on texts that the model has not seen
    for r in entry.queries()["op2_class_lm"](spark, SF_SMALL).collect():
        t = tok[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(w in counts for w in t), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
        gain += r["held_out"] * (r["score"] - r["base_score"])
    assert gain > 0
    few = class_lm.score_documents(edge.select("doc_id", "text"), core=8, classes=3, min_count=2).collect()
    assert sorted(r["n_tokens"] for r in few) == sorted(len(words(t[1])) + 1 for t in EDGE)
    assert all(r["score"] <= 0 and math.isfinite(r["score"]) for r in few)
    assert class_lm.score_documents(empty.select("doc_id", "text")).count() == 0
    nothing = class_lm.score_documents(edge.select("doc_id", "text"), edge["doc_id"] < 0).collect()
    assert {(r["n_known"], r["train_tokens"]) for r in nothing} == {(0, 0)}


def test_class_lm_score_is_that_of_its_classes(docs):
    """Every token's transition and emission, recomputed from the model's classes and the plain counts."""
    some = docs.where("doc_id < 60").select("doc_id", "text")
    counts = class_lm.stored(class_lm.word_counts(some.where("doc_id < 50")))
    model = class_lm.train(some.where("doc_id < 50"), counts, core=50, min_count=3, classes=12)
    assert model.likelihoods == sorted(model.likelihoods) and len(model.likelihoods) > 2  # every step raised it
    assert len(set(model.cls[:len(model.keys)][model.cls[:len(model.keys)] < 12])) > 6
    assert (model.cls[:len(model.keys)] < 12).mean() > 0.5 and len(model.keys) > 300  # most words, not the core alone
    count = {r["h"]: r["c"] for r in counts.collect()}
    key = {int(h): i for i, h in enumerate(model.keys.view(np.int64))}
    rows = {r["doc_id"]: r for r in some.collect()}
    d, unknown = class_lm.discounts(model.form_stats)
    for r in class_lm.score(some, counts, model).where("doc_id % 7 = 0").collect():
        one = rows[r["doc_id"]]["text"] or ""
        batch = pa.RecordBatch.from_arrays([pa.array([one])], ["text"])
        (_, _, t), = class_lm.chunks(batch, "text")
        hashes, form, _ = class_lm.with_ends(t, 1)
        total, before = 0.0, len(model.class_total) - 1
        for h, f in zip(hashes.view(np.int64), form):
            cls = len(model.class_total) - 1 if f < 0 else model.cls[key[int(h)]] if int(h) in key else 12 + f
            total += model.moves[before, cls]
            c = count.get(int(h), 0)
            if 0 <= f and cls >= 12:
                total += math.log10(c - d[f]) - math.log10(model.form_stats[f, 0]) if c else unknown[f]
            elif f >= 0:
                total += math.log10(c) - math.log10(model.class_total[cls])
            before = cls
        assert r["score"] == pytest.approx(total, rel=1e-9)
    assert (10 ** model.moves).sum(axis=1) == pytest.approx(1)


def test_class_lm_asks_for_more_where_words_do_not_fit(spark):
    counts = spark.createDataFrame([(i, 0, c) for i, c in enumerate([2, 3, 4, 5, 8, 9, 16, 17, 33])], "h long, form long, c long")
    assert [class_lm.least_count(counts, 2, t) for t in (9, 8, 5, 3, 1, 0)] == [2, 4, 8, 16, 32, 64]
    assert class_lm.learned_classes(0) == 1 and class_lm.learned_classes(5) == 5 and class_lm.learned_classes(40_000) == 118


def test_class_lm_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "x", 1.0), (2, None, 6, "y", 2.0)], "doc_id long, text string, n_tokens long, row string, score double")
    got = class_lm.score_documents(docs, min_count=1)
    assert got.columns == ["doc_id", "row", *class_lm.RESULTS]
    assert {(r["row"], r["n_tokens"]) for r in got.collect()} == {("x", 3), ("y", 1)}
    assert [r["n_tokens"] for r in class_lm.score_documents(docs.select("text")).orderBy("n_tokens").collect()] == [1, 3]


def test_exchange_raises_likelihood():
    counts = np.random.default_rng(1).poisson(3, (40, 40)).astype(float)
    counts[:10, 10:20] += 30

    def value(cls):
        k = cls.max() + 1
        own = np.eye(k)[cls]
        t = own.T @ counts @ own
        f = lambda x: (x * np.log(np.maximum(x, 1))).sum()
        return f(t) - f(t.sum(0)) - f(t.sum(1))

    start = class_lm.exchange(counts, 30, 5, sweeps=0)
    values = [value(start)] + [value(class_lm.exchange(counts, 30, 5, sweeps=s)) for s in (1, 2, 4)]
    assert values == sorted(values) and values[-1] > values[0]


def test_token_counts(edge, empty, docs, texts):
    scores = token_counts.load_vocabulary()

    def plain(word):
        b = word.encode()
        best = [(0.0, 0)]
        for j in range(1, len(b) + 1):
            best.append(max((best[i][0] + scores[b[i:j]], best[i][1] - 1) for i in range(max(0, j - 130), j) if b[i:j] in scores))
        return -best[-1][1]

    known = {}
    for r in token_counts.count_tokens(docs.where("doc_id < 30").select("doc_id", "text")).collect():
        cut = token_counts.PRETOKEN.findall(texts[r["doc_id"]])
        assert "".join(cut) == texts[r["doc_id"]]
        assert (r["n_pretokens"], r["n_tokens"]) == (len(cut), sum(known.setdefault(w, plain(w)) if w not in known else known[w] for w in cut))
    rows = token_counts.count_tokens(edge).collect()
    assert len(rows) == len(EDGE) and {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    assert token_counts.count_tokens(empty).count() == 0


def test_sharding(spark, edge, empty):
    rows = sharding.shard(edge).collect()
    assert len(rows) == len(EDGE) and "label" in rows[0].asDict()
    for s in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert sharding.shard(empty).count() == 0
    hot = spark.createDataFrame([(i, "same text" if i % 3 else f"other {i}") for i in range(3000)], "doc_id long, text string")
    sizes = collections.Counter()
    for r in sharding.shard(hot).collect():
        sizes[r["shard"]] += r["size"]
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) < 40


def test_mixing(spark, edge, empty, docs):
    rows = mixing.mix_digest(docs).collect()
    per = collections.defaultdict(lambda: [0, 0, 0.0, 0])
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        p = per[r["source"]]
        p[0], p[1], p[2], p[3] = p[0] + r["size"], r["source_size"], r["target"], p[3] + r["taken"]
    assert all(p[0] == p[1] and abs(p[3] - p[2]) < 0.1 * p[2] for p in per.values())
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix_digest(docs).collect()))
    # the targets by resharing the excess until none is above its cap
    names, total = sorted(per), sum(p[0] for p in per.values())
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, full = {}, set()
    while True:
        left = total - sum(3 * per[s][0] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        target = {s: 3 * per[s][0] if s in full else left * weight[s] / share for s in names}
        over = {s for s in names if s not in full and target[s] > 3 * per[s][0]}
        if not over:
            break
        full |= over
    assert {s: p[2] for s, p in per.items()} == pytest.approx(target)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(words(r["text"])) for r in mixed.collect()) == sum(r["taken"] for r in rows)
    assert len(mixing.mix_digest(edge).collect()) == len(EDGE) and mixing.mix_digest(empty).count() == 0
    assert mixing.mix_documents(empty).count() == 0


def test_permutation_is_one_to_one(spark):
    from pyspark.sql import functions as F
    for n in (1, 2, 7, 100, 1000):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), [F.lit(3)]).alias("x")).collect()
        assert sorted(r["x"] for r in got) == list(range(n))


def test_decontamination(spark, edge, empty):
    item = [f"b{i}" for i in range(40)]
    changed = list(item)
    for i in (3, 9, 17, 25, 33):
        changed[i] = "other"
    filler = [f"f{i}" for i in range(60)]
    rows = [(1, " ".join(filler)), (2, " ".join(filler[:30] + item + filler[30:])), (3, " ".join(filler[:9] + changed)), (4, None), (5, ""),
            (6, " ".join(item[:6] + filler)), (7, "Zed, why YET xul qua? " + filler[0]), (2, " ".join(filler[:30] + item + filler[30:]))]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(100, " ".join(item).upper()), (101, "zed why yet xul qua"), (102, None), (103, "two words")], "item_id long, text string")
    for limit in (1, 10_000):
        got = sorted((r["doc_id"], r["item_id"], r["n_words"], r["n_equal"]) for r in decontaminate.leaks(d, bench, limit).collect())
        assert got == [(2, 100, 40, 40), (2, 100, 40, 40), (3, 100, 40, 35), (7, 101, 5, 5)]
        assert sorted(r["doc_id"] for r in decontaminate.remove(d, bench, limit).collect()) == [1, 4, 5, 6]
    assert decontaminate.remove(edge, bench).count() == len(EDGE) and decontaminate.leaks(empty, bench).count() == 0
    assert decontaminate.leaks(edge, bench.where("false")).count() == 0


def test_near_dedup(spark, edge, empty):
    r = random.Random(3)
    rows, group = [], {}
    for g in range(25):
        base = [f"w{r.randrange(4000)}" for _ in range(r.choice([30, 200, 900]))]
        for c in range(r.choice([1, 2, 6])):
            t = list(base)
            for _ in range(len(t) // 150 * (c > 1)):
                t[r.randrange(len(t))] = "changed"
            group[len(rows)] = g
            rows.append((len(rows), " ".join(t) if c != 1 else "  ".join(t).upper()))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: x["class_id"] for x in near_dedup.classes(d).collect()}
    first = {g: min(i for i in group if group[i] == g) for g in group.values()}
    assert got == {i: first[g] for i, g in group.items()}
    assert sorted(x["doc_id"] for x in near_dedup.keep_one(d).collect()) == sorted(first.values())
    kept = near_dedup.keep_one(edge)
    assert kept.columns == edge.columns
    ids = [x["doc_id"] for x in kept.collect()]
    assert {1, 2, 3, 4, 5, 6, 8}.issubset(ids) and ids.count(5) == 1 and 7 not in ids
    assert near_dedup.classes(edge).count() == len(EDGE) and near_dedup.classes(empty).count() == near_dedup.keep_one(empty).count() == 0


def test_alignment_band_is_exact():
    r = np.random.default_rng(2)
    for _ in range(60):
        a = r.permutation(200)[:r.integers(5, 120)].astype(np.uint64)
        b = np.delete(a, r.integers(0, len(a), r.integers(0, 6)))
        if r.random() < 0.5:
            b = np.concatenate([b[3:], b[:3]])
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        c = table[-1, -1]
        want = c / (len(a) + len(b) - c)
        got = near_dedup.alignment_similarity(a, b)
        assert (got >= 0.8) == (want >= 0.8) and (want < 0.8 or got == pytest.approx(want))


def test_line_dedup_edges(edge, empty, spark):
    rows = {(r["doc_id"], r["n_lines"], r["n_dropped"]) for r in line_dedup.dedup_lines(edge).collect()}
    assert {(1, 1, 0), (2, 1, 0), (4, 3, 0), (None, 1, 0)}.issubset(rows) and line_dedup.dedup_lines(empty).count() == 0
    line = "A line of well over forty characters, found in many documents"
    d = spark.createDataFrame([(i, f"{line}\nown {i}\n  {line.lower()}\t\nend") for i in range(6)] + [(2, line)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_dropped"], r["kept_text"]) for r in line_dedup.dedup_lines(d).collect())
    assert got == sorted([(i, 2, f"own {i}\nend") for i in range(5)] + [(2, 1, ""), (5, 0, f"{line}\nown 5\n  {line.lower()}\t\nend")])


def test_chat_format(spark):
    bad = lambda turns: "".join(f"<{r}>{t if i + 1 == len(turns) else t[:3]}" for i, (r, t) in enumerate(turns))
    rows = [(1, 0, "user", "a <s> [INST] \\ [\\ <\\"), (1, 1, "assistant", "</s>[/ROLE]"), (2, 0, None, None), (None, 1, "assistant", "x"), (1, 2, "user", "")]
    rows += [(3, i, ("user", "assistant")[i % 2], f"turn {i} <s>") for i in range(100)] + [(1, 0, "user", "again")]
    c = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat_format.format_conversations(c)
    for r in out.collect():
        mine = sorted(((t, role or "", x or "") for i, t, role, x in rows if i == r["conv_id"]))
        assert chat_format.read_back(r["formatted"]) == [m[1:] for m in mine] and not r["rewrites_history"]
        for s, m in zip(r["spans"], mine):
            assert chat_format.unescape(r["formatted"][s["text_start"]:s["text_stop"]]) == m[2] and s["loss"] == (m[1] == "assistant")
    got = {r["conv_id"]: r for r in chat_format.digest(out).collect()}
    said = "".join(f"turn {i} <s>" for i in range(1, 100, 2))
    assert (got[3]["loss_chars"], got[3]["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert {r["conv_id"]: r["rewrites_history"] for r in chat_format.format_conversations(c, bad).collect()}[3]
    assert chat_format.digest(chat_format.format_conversations(c.where("false"))).count() == 0


def test_quality_rules(spark, edge, empty, docs, texts):
    for r in entry.queries()["op10_quality_rules"](spark, SF_SMALL).collect():
        t = texts[r["doc_id"]] or ""
        w = words(t)
        grams = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        covered = {i + k for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for k in range(8)}
        lines = [x for x in t.split("\n") if words(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered),
                len(w) < 20 or 100 * len(covered) > 30 * len(w))
        assert tuple(r)[1:7] == want and not (r["base_failed"] and r["kept"])
    got = quality_rules.quality(edge)
    assert got.count() == len(EDGE) and {"label", "size"}.issubset(got.columns)
    kept = quality_rules.filter_quality(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(
        r["doc_id"] for r in quality_rules.quality(docs).where("kept").collect())
    assert quality_rules.quality(empty).count() == quality_rules.filter_quality(empty).count() == 0
    junk = spark.createDataFrame([(1, "%$# &&| " * 200 + EN, "en")] + [(i, EN.replace("cat", f"c{i}") + LONG, "en") for i in range(2, 9)], "doc_id long, text string, lang string")
    assert {r["doc_id"] for r in quality_rules.quality(junk, min_reference=100.0).where("kept").collect()}.isdisjoint({1})


def test_js_distance(spark):
    from pyspark.sql import functions as F
    r = spark.sql("select array(0.5D, 0.5D) a, array(1D, 0D) b").select(
        quality_rules.js_distance(F.col("a"), F.col("a")).alias("x"), quality_rules.js_distance(F.col("a"), F.col("b")).alias("y")).first()
    m = [0.75, 0.25]
    y = 0.5 * (0.5 * math.log2(0.5 / m[0]) + 0.5 * math.log2(0.5 / m[1])) + 0.5 * math.log2(1 / m[0])
    assert r["x"] == 0 and r["y"] == pytest.approx(math.sqrt(y))


def test_pipeline(spark):
    import corpus_pipeline
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    base, leaked = d, d
    base = quality_rules.filter_quality(base)
    want = near_dedup.keep_one(base)
    leaked = {r["doc_id"] for r in decontaminate.leaks(want, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).collect()}
    left = want.where(~want["doc_id"].isin(list(leaked) or [-1]))
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_digest(left).collect()}
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    got = collections.Counter()
    for r in out:
        got[r["doc_id"]] += len(words(r["text"]))
    assert dict(got) == {i: n for i, n in taken.items() if n}
    for s in range(8):
        slots = sorted(r["slot"] for r in out if r["shard"] == s)
        assert slots == list(range(len(slots)))
