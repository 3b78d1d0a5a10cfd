"""Near-duplicates of one template: classes against all pairs."""

import functools
import random

import pytest

from shoplens.llm import near_dedup


@pytest.mark.parametrize("size", [16, near_dedup.BLOCK])
def test_template_family_is_like_all_pairs(spark, monkeypatch, size):
    monkeypatch.setattr(near_dedup, "untried", functools.partial(near_dedup.untried, size=size))
    r = random.Random(11)
    base = [f"t{i}" for i in range(200)]

    def changed(words, places):
        words = list(words)
        for i in places:
            words[i] = f"x{r.randrange(10**9)}"
        return words

    texts = [changed(base, r.sample(range(200), 4)) for _ in range(240)]  # like each other, mostly below the threshold
    texts += [changed(t, r.sample(range(200), 3)) for t in r.sample(texts, 60)]
    r.shuffle(texts)
    shingles = [near_dedup.labelled(near_dedup._word_hashes(" ".join(t))) for t in texts]
    label = list(range(len(texts)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    failed = 0
    for i in range(len(texts)):
        for j in range(i):
            if near_dedup.alignment_similarity(shingles[i], shingles[j]) >= near_dedup.SIMILARITY:
                x, y = sorted((top(i), top(j)))
                label[y] = x
            else:
                failed += 1
    want = {i: top(i) for i in range(len(texts))}
    assert failed > 40_000 and 150 < len(set(want.values())) < 300
    d = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    assert {x["doc_id"]: x["class_id"] for x in near_dedup.classes(d).collect()} == want
