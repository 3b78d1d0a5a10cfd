"""Benchmark passages found, against laying every item over every offset."""

import collections
import itertools
import random

import numpy as np

from shoplens.llm import decontaminate


def found_anywhere(doc, item):
    least = min(decontaminate.MIN_WORDS, len(item))
    for offset in range(least - len(item), len(doc) - least + 1):
        a = max(0, -offset)
        equal = np.array([doc[offset + i] == item[i] for i in range(a, min(len(item), len(doc) - offset))], int)
        sums = np.concatenate([[0], np.cumsum(equal)])
        for i in range(len(sums)):
            for j in range(i + least, len(sums)):
                if 10 * (sums[j] - sums[i]) >= 8 * (j - i):
                    return True
    return False


def test_recall_is_that_of_all_offsets(spark):
    benchmark, docs, want = [], [], {}
    for n in (5, 6, 8, 11, 12, 15, 20, 30, 700):
        r = random.Random(n)
        item = [f"b{n}x{i}" for i in range(n)]
        benchmark.append((n, " ".join(item)))
        for _ in range(150 if n < 100 else 20):
            part = item if n < 100 else item[(at := r.randrange(n - 40)):at + r.randrange(10, 40)]
            text = list(part)
            for i in r.sample(range(len(part)), min(len(part), len(part) // 5 + r.choice([-1, 0, 0, 0, 1]))):
                text[i] = r.choice(["other", r.choice(item)])
            doc = [f"f{i}" for i in range(r.randrange(9))] + text[:len(text) - r.choice([0, 0, 3])] + [f"f{i}" for i in range(r.randrange(9))]
            want[len(docs)] = (n, item, doc)
            docs.append((len(docs), " ".join(doc)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(x["doc_id"], x["item_id"]): x for x in decontaminate.leaks(d, spark.createDataFrame(benchmark, "item_id long, text string")).collect()}
    outcomes = set()
    for i, (n, item, doc) in want.items():
        expected = found_anywhere(doc, item)
        assert ((i, n) in got) == expected, doc
        outcomes.add((n, expected))
        if expected:
            x = got.pop((i, n))
            words, equal, at, start = x["n_words"], x["n_equal"], x["doc_word"], x["item_word"]
            assert words >= min(12, n) and equal >= 0.8 * words - 1e-9
            assert equal == sum(a == b for a, b in zip(doc[at:at + words], item[start:start + words]))
    assert not got and {(n, True) for n in (5, 6, 8, 11, 12, 15, 20, 30, 700)} <= outcomes


def test_fewest_hits_of_a_stretch_that_counts():
    def hits(n, out):
        found = [(s, s + len(m)) for m in decontaminate.MASKS for s in range(n - len(m) + 1) if not any(s + i in out for i, c in enumerate(m) if c == "1")]
        return len(found), max((b for _, b in found), default=0) - min((a for a, _ in found), default=0)

    tried = [hits(n, out) for n in range(12, 24) for out in itertools.combinations(range(n), n // 5)]
    assert min(k for k, _ in tried) == decontaminate.LEAST_HITS and min(s for _, s in tried) == decontaminate.LEAST_SPAN
    assert all(hits(n, out)[0] for n in range(5, 12) for out in itertools.combinations(range(n), n // 5))


def test_large_benchmark_and_hot_rows(spark):
    """Twenty thousand items, a text that holds a third of all rows, a phrase in every text and in three hundred items."""
    r = random.Random(1)
    phrase = "which one of these is the right answer"
    items = [(i, f"{phrase if i < 300 else i} " + " ".join(f"q{r.randrange(10**6)}" for _ in range(14))) for i in range(20_000)]
    docs = [(i, f"{phrase} " + " ".join(f"t{r.randrange(10**6)}" for _ in range(30))) for i in range(200)]
    docs += [(1000 + i, f"before {items[7][1]} behind") for i in range(150)] + [(2000 + i, f"{items[i][1]} and {items[i + 50][1]}") for i in range(100, 110)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    for lot in (1, 200):
        found = decontaminate.leaks(d, spark.createDataFrame(items, "item_id long, text string"), lot)
        got = {(x["doc_id"], x["item_id"], x["n_words"]) for x in found.collect()}
        assert got == {(1000 + i, 7, 22) for i in range(150)} | {(2000 + i, j, 22) for i in range(100, 110) for j in (i, i + 50)}


def test_unspaced_scripts_short_items_and_names(spark):
    item = "\u4eca\u5929\u5929\u6c14\u5f88\u597d\u6211\u4eec\u4e00\u8d77\u53bb\u516c\u56ed\u6563\u6b65\u5427"
    assert decontaminate.tokens("Ab_1 " + item[:2] + "c,\u0e01\u0e02") == ["ab_1", item[0], item[1], "c", "\u0e01", "\u0e02"]
    rows = [(1, "x " + item[:5] + "\u4ed6" + item[6:] + " y", 1, 2), (2, item[:6], 3, 4), (None, item, 5, 6), (3, "w " * 300_000 + item, 7, 8), (4, None, 9, 9)]
    d = spark.createDataFrame(rows, "doc_id long, text string, digest long, _leaked long")
    bench = spark.createDataFrame([(1, item, "a"), (1, item, "a"), (2, "two words", "b"), (None, None, None)], "item_id long, text string, digest string")
    got = [tuple(x) for x in decontaminate.report(d, bench).select("doc_id", "item_id", "n_words", "n_equal").collect()]
    assert collections.Counter(got) == {(1, 1, 16, 15): 2, (None, 1, 16, 16): 2, (3, 1, 16, 16): 2, (None, 2, 2, None): 1, (None, None, 0, None): 1}
    left = decontaminate.remove(d, bench)
    assert left.columns == d.columns and sorted(tuple(x) for x in left.collect()) == [(2, item[:6], 3, 4), (4, None, 9, 9)]
    assert decontaminate.report(d.where("false"), bench).count() == 2 and decontaminate.remove(d, bench.where("false")).count() == 5
