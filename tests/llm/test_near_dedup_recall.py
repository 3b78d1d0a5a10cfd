"""Near-duplicates of the documents table: classes against the links among all pairs of texts."""

import os

import numpy as np

from shoplens.llm import near_dedup

SF = "/root/testdata/sf0.01"


def links(texts):
    """(i, j, similarity) of all pairs that share a shingle, by brute force over an inverted index."""
    shingles = [near_dedup.labelled(near_dedup._word_hashes(" ".join(t.lower().split()))) for t in texts]
    at = np.concatenate([np.full(len(s), i) for i, s in enumerate(shingles)])
    value = np.concatenate(shingles)
    order = np.lexsort((at, value))
    at, value = at[order], value[order]
    sizes = np.array([len(s) for s in shingles])
    ends = np.searchsorted(value, value, side="right")
    for i, own in enumerate(shingles):
        first = np.searchsorted(value, own)
        common = np.zeros(len(texts), np.int64)
        for a in first:
            common[at[a:ends[a]]] += 1
        common[:i + 1] = 0
        for j in np.flatnonzero(common >= 0.5 * (sizes[i] + sizes - common)):
            yield i, int(j), near_dedup.alignment_similarity(own, shingles[j], 0.5)


def test_no_link_of_the_documents_is_lost(spark):
    docs = spark.read.parquet(os.path.join(SF, "documents.parquet")).select("doc_id", "text")
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs).collect()}
    rows = [r for r in rows if r[1].strip(" \t\n\x0b\x0c\r")]
    label = {d: d for d, _ in rows}

    def top(d):
        while label[d] != d:
            d = label[d]
        return d

    made = 0
    for i, j, similarity in links([t for _, t in rows]):
        if similarity >= near_dedup.SIMILARITY:
            x, y = sorted((top(rows[i][0]), top(rows[j][0])))
            label[y] = x
            made += 1
    assert made >= 20
    assert {d: top(d) for d in label} == {d: c for d, c in found.items() if d in label}
