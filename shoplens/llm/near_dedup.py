"""Operator 7: near-duplicates by Order MinHash, verified by banded alignment.

Documents become lower-case words; equal word sequences form one text, by digest, and only one row per text
goes on. A text's shingles of five words are labelled with their occurrence (second time, third time), so
each is unique in it. Each of ``SKETCHES`` sketches takes the ``PICK`` labelled shingles with the smallest hashes under
its own hash function and keeps them in the order of the text: equal sketches mean equal picks in equal order, which is
sensitive to edit similarity, not only to shared content. (Texts of fewer than five words are one
shingle; of fewer picks than ``PICK``, all are taken.)

Candidates share a bucket (sketch number, value, length band; each text is in its band and the next, so texts
within the similarity's length ratio meet); pairs that share fewer than ``SHARED`` sketches go. First, rounds of few
pairs: in each bucket all are paired with its smallest member of each component found so far. Verification
aligns the two sequences of labelled shingles: their longest common subsequence within the band of offsets that the
threshold allows, c; similarity c / (n1 + n2 - c). The shingles of the texts that can be in a pair (those with
``SHARED`` shared buckets of a band) are stored once, so documents are read twice, whatever the number of rounds; a
leader's pairs are dealt out in lots of ``LOT``, to each of which its shingles go once. Links of at least ``SIMILARITY`` are merged into
components by label propagation; the rounds end when they find none. What they left out follows in one pass: in
the buckets that still hold more than one component, every pair of texts of different components is verified, so
no candidate is left untried but those inside a component. Buckets are compared there in blocks of ``BLOCK`` texts,
each pair of blocks on its own, so a crowded bucket is spread over many tasks and a text is moved once for
all its pairs in two blocks.

Defined results: texts without words are not compared, each is a class of its own; repeated rows fall in one class;
a null doc_id counts above all ids when the class id, the smallest doc_id, is chosen (null if all are null); an empty table
gives no rows; columns of the input with names made here are replaced.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shoplens.llm.common import WORD, Tokens, chunks, mix64, narrow, scratch, small, stored, words

SHINGLE, SIMILARITY = 5, 0.8
SKETCHES, PICK, SHARED = 16, 2, 3
BLOCK, LOT = 256, 64
MADE = ["class_id", "class_size", "is_kept"]


def labelled(hashes: np.ndarray) -> np.ndarray:
    """Hashes of a text's labelled shingles, in its order; ``hashes``: those of its words."""
    k = min(SHINGLE, len(hashes))
    n = len(hashes) - k + 1 if k else 0
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + n])
    order = np.argsort(out, kind="stable")
    ranked = out[order]
    same = np.concatenate([[False], ranked[1:] == ranked[:-1]]) if n else np.zeros(0, bool)
    if same.any():
        starts = np.maximum.accumulate(np.where(same, 0, np.arange(n)))
        label = np.empty(n, np.uint64)
        label[order] = (np.arange(n) - starts).astype(np.uint64)
        out = np.where(label > 0, mix64(out + label * np.uint64(0xD1B54A32D192ED03)), out)
    return out


_SEEDS = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def picks(shingles: np.ndarray, sketches: int = SKETCHES, pick: int = PICK) -> np.ndarray:
    """Per sketch the hashes of the ``pick`` smallest shingles, in the order of the text; a short text's are
    padded with zeros."""
    n, take = len(shingles), min(pick, len(shingles))
    out = np.zeros((sketches, pick), np.uint64)
    group = max(1, min(sketches, (1 << 20) // n))  # sketches at a time, to bound memory for long texts
    for s in range(0, sketches, group):
        seeds = np.arange(s, min(s + group, sketches))
        h = (shingles ^ _SEEDS[2 * seeds][:, None]) * (_SEEDS[2 * seeds + 1] | np.uint64(1))[:, None]
        h ^= h >> np.uint64(32)
        at = np.sort(np.argpartition(h, take - 1, axis=1)[:, :take], axis=1)
        out[s:s + len(seeds), :take] = np.take_along_axis(h, at, axis=1)
    return out


def sketch(chosen: np.ndarray) -> np.ndarray:
    """One value per sketch from ``picks`` (any number of texts: the last two axes are sketch, pick)."""
    value = np.broadcast_to(np.arange(chosen.shape[-2], dtype=np.uint64), chosen.shape[:-1])
    for i in range(chosen.shape[-1]):
        value = mix64(value * np.uint64(0x9E3779B97F4A7C15) + chosen[..., i])
    return value


def alignment_similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """c / (len(a) + len(b) - c) for the longest common subsequence c of two arrays of distinct
    values, aligned within the band that ``least`` allows; exact if the result reaches ``least``."""
    n = len(a) + len(b)
    if not n:
        return 0.0
    spare = int(n - 2 * least / (1 + least) * n + 1e-9)  # shingles that both may lack together
    _, x, y = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(x - y) <= spare
    x, y = x[near], y[near]
    if n - 2 * len(x) > spare:
        return 0.0
    tails: list[int] = []
    for v in y[np.argsort(x)].tolist():  # longest increasing run of places in b
        i = bisect_left(tails, v)
        if i == len(tails):
            tails.append(v)
        else:
            tails[i] = v
    return len(tails) / (n - len(tails))


def _word_hashes(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return Tokens(data, np.array([0, len(data)])).hash


def normal(text: Column) -> Column:
    """Lower-case words joined by single spaces."""
    return F.array_join(words(F.lower(text)), " ")


def raw_digest() -> Column:
    return F.md5(F.col("text").cast("binary"))


def has_words(text: Column) -> Column:
    return F.coalesce(text.rlike(WORD), F.lit(False))


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, digest (of the words), raw (digest of the text as it is), n (shingles), sketch (array) of the rows with words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, t in chunks(batch, "_norm"):
                ends = np.searchsorted(t.row, np.arange(b - a + 1))
                sizes, values = [], []
                for i in range(b - a):
                    s = labelled(t.hash[ends[i]:ends[i + 1]])
                    sizes.append(len(s))
                    values.append(picks(s))
                flat = pa.array(np.ascontiguousarray(sketch(np.stack(values))).reshape(-1).view(np.int64))
                offsets = pa.array(np.arange(b - a + 1, dtype=np.int32) * SKETCHES)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(a, b - a) for c in ("doc_id", "_digest", "_raw")]
                    + [pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, flat)],
                    ["doc_id", "digest", "raw", "n", "sketch"])

    # the test for words reads up to the first one; a test of _norm would make the words once more
    rows = docs.where(has_words(F.col("text"))).select(
        F.col("doc_id").cast("long"), raw_digest().alias("_raw"), normal(F.col("text")).alias("_norm"))
    return rows.select("doc_id", F.md5(F.col("_norm").cast("binary")).alias("_digest"), "_raw", "_norm").mapInArrow(
        run, "doc_id long, digest string, raw string, n long, sketch array<long>")


def _verify(pairs: DataFrame, shingles: DataFrame, least: float, size: int = LOT) -> DataFrame:
    """The pairs (a, b: numbers of texts) whose ``shingles`` (id, _h) align well enough. Of each pair, the text with more
    pairs leads; its others are dealt to lots of about ``size``, each lot beginning with the leader's shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, left = None, None
        for batch in batches:
            one, other = [], []
            for top, x, h in zip(batch.column("_top").to_pylist(), batch.column("id").to_pylist(), batch.column("_h")):
                held = np.frombuffer(h.as_buffer(), np.uint64)
                if top == x:
                    lead, left = x, held.copy()
                elif alignment_similarity(left, held, least) >= least:
                    one.append(min(lead, x))
                    other.append(max(lead, x))
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(other, pa.int64())], ["a", "b"])

    counts = pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("_c"))
    one, other = (counts.select(F.col("id").alias(x), F.col("_c").alias(f"_c{x}")) for x in "ab")
    top = F.col("_ca") >= F.col("_cb")
    dealt = stored(pairs.join(one, "a").join(other, "b").select(
        F.when(top, F.col("a")).otherwise(F.col("b")).alias("_top"), F.when(top, F.col("b")).otherwise(F.col("a")).alias("id"),
        F.ceil(F.greatest("_ca", "_cb") / size).alias("_lots")).select(
        "_top", F.pmod(F.xxhash64("id"), "_lots").alias("_lot"), "id"))
    leaders = dealt.select("_top", "_lot").distinct().select("_top", "_lot", F.col("_top").alias("id"))
    rows = dealt.unionByName(leaders).join(shingles, "id")
    return rows.repartition("_top", "_lot").sortWithinPartitions("_top", "_lot", F.col("id") != F.col("_top")).select(
        "_top", "id", "_h").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """id, label (smallest id of its component) of all ids in ``links`` (a, b): labels spread along links and jump
    ahead until none changes."""
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.min(F.least("a", "b")).alias("label")))
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("_m"))
        step = labels.join(near, labels["id"] == near["a"]).select("id", "label", F.least("label", "_m").alias("_l"))
        jump = labels.select(F.col("id").alias("_l"), F.col("label").alias("_j"))
        target = F.least("_l", F.coalesce("_j", "_l"))
        following = stored(step.join(jump, "_l", "left").select(
            "id", target.alias("label"), (F.col("label") != target).alias("_c")))
        labels = following.drop("_c")
        if following.where("_c").isEmpty():
            return labels


def merged(labels: DataFrame, new: DataFrame) -> DataFrame:
    """id, label after the links ``new`` (a, b) joined components of ``labels``: only the links between
    components are followed, with a component as one node."""
    ends = new
    for x in "ab":
        of = labels.select(F.col("id").alias(x), F.col("label").alias(f"_l{x}"))
        ends = ends.join(of, x, "left").withColumn(x, F.coalesce(f"_l{x}", x)).drop(f"_l{x}")
    joined = components(ends.where("a != b")).select(F.col("id").alias("_id"), F.col("label").alias("_to"))
    kept = labels.join(joined, F.col("label") == F.col("_id"), "left").select("id", F.coalesce("_to", "label").alias("label"))
    fresh = joined.join(labels, F.col("_id") == F.col("id"), "left_anti").select(F.col("_id").alias("id"), F.col("_to").alias("label"))
    return stored(kept.unionByName(fresh))


def _open(buckets: DataFrame) -> DataFrame:
    """The rows of ``buckets`` (key, label, ...) whose bucket holds more than one component."""
    mixed = buckets.groupBy("key").agg(F.min("label").alias("_l"), F.max("label").alias("_m"), F.count("*").alias("_c"))
    return buckets.drop("_c").join(mixed.where("_l != _m").select("key", "_c"), "key")


DEAL = ["key", "_i", "_j"]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows, which lie group by group (``DEAL``), in tables of whole groups; few at a time, as they have many pairs."""
    rest = None
    for batch in (b.slice(k, 4 * BLOCK) for b in batches for k in range(0, b.num_rows, 4 * BLOCK)):
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        start = int(np.logical_and.reduce([(v := rest.column(c).to_numpy()) == v[-1] for c in DEAL]).argmax())
        if start:
            yield rest.slice(0, start)
            rest = rest.slice(start)
    if rest is not None:
        yield rest


def _pairs(table: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows a, b of the candidates of different components in the groups of ``table``, sorted by a; where groups start."""
    key, i, j, block, number, band, label, ids, n = (
        table.column(c).to_numpy() for c in ("key", "_i", "_j", "_b", "_s", "_band", "label", "id", "n"))
    sketch_ = table.column("sketch").combine_chunks().flatten().to_numpy().reshape(-1, SKETCHES)
    new = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
    starts = np.concatenate([[0], new])
    end = np.repeat(np.append(new, len(key)), np.diff(np.append(starts, len(key))))
    own = np.floor(np.log(n) / -np.log(least) + 1e-9)
    left, right = [], []
    x = np.arange(len(key))
    for shift in range(1, len(key)):
        x = x[x + shift < end[x]]
        if not len(x):
            break
        y = x + shift
        # a pair counts where its blocks are this group's, and in its lower common band only
        fits = ((block[x] != block[y]) | (i[x] == j[x])) & (label[x] != label[y]) & (band[x] == np.maximum(own[x], own[y]))
        fits &= np.minimum(n[x], n[y]) >= least * np.maximum(n[x], n[y])
        a, b = x[fits], y[fits]
        same = sketch_[a] == sketch_[b]
        good = (same.sum(1) >= SHARED) & (same.argmax(1) == number[a])  # and at its first common sketch only
        left.append(a[good])
        right.append(b[good])
    a, b = (np.concatenate([np.zeros(0, np.int64), *s]) for s in (left, right))
    order = np.argsort(a, kind="stable")
    return a[order], b[order], starts


def _links(table: pa.Table, least: float) -> pa.RecordBatch:
    """a, b: ids of the pairs of ``_pairs`` whose shingles (_h) align well enough; those with too few in common are not
    aligned."""
    a, b, starts = _pairs(table, least)
    ids, h, keep = table.column("id").to_numpy(), table.column("_h").to_pylist(), np.zeros(len(a), bool)
    group = np.searchsorted(starts, a, side="right") - 1
    first = np.flatnonzero(np.diff(a, prepend=-1))
    now = -1
    for s, e in zip(first.tolist(), [*first[1:].tolist(), len(a)]):
        if group[s] != now:
            now = group[s]
            start, end = starts[now], starts[now + 1] if now + 1 < len(starts) else len(ids)
            held = [np.frombuffer(x, np.uint64) for x in h[start:end]]
            sizes = np.array([len(x) for x in held])
            begin = np.cumsum(sizes) - sizes
            values, where = np.unique(np.concatenate(held), return_inverse=True)
        x, y = a[s] - start, b[s:e] - start
        mark = np.zeros(len(values), np.int64)
        mark[where[begin[x]:begin[x] + sizes[x]]] = 1
        common = np.add.reduceat(mark[where], begin)[y]
        enough = common >= least * (sizes[x] + sizes[y] - common) - 1e-9
        for k in np.flatnonzero(enough).tolist():
            keep[s + k] = alignment_similarity(held[x], held[y[k]], least) >= least
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[a], ids[b])[keep]), pa.array(np.maximum(ids[a], ids[b])[keep])], ["a", "b"])


def untried(buckets: DataFrame, reps: DataFrame, labels: DataFrame | None, least: float, size: int = BLOCK) -> DataFrame:
    """The texts of two blocks of a bucket (``DEAL``) that share ``SHARED`` sketches with one of a different component
    there: all candidate pairs between components lie in one of these groups each."""
    if labels is None:
        member = buckets.withColumn("label", F.col("id"))
    else:
        member = buckets.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    member = _open(member.select("key", "_s", "_band", "id", "label"))
    enough = member.groupBy("id", "_band").agg(F.count("*").alias("_n")).where(F.col("_n") >= SHARED).drop("_n")
    member = stored(_open(member.join(enough, ["id", "_band"])))
    blocks = F.ceil(F.col("_c") / size).cast("int")
    dealt = member.withColumn("_b", F.pmod(F.xxhash64("id"), blocks).cast("int")).join(
        reps.select("id", "n", "sketch"), "id").withColumn("_o", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("key", F.least("_b", "_o").alias("_i"), F.greatest("_b", "_o").alias("_j"), "_b", "_s", "_band",
                         "label", "id", "n", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            a, b, _ = _pairs(table, least)
            has = np.zeros(len(table), bool)
            has[a] = has[b] = True
            yield from table.filter(pa.array(has)).to_batches()

    return dealt.repartition(*DEAL).sortWithinPartitions(*DEAL).mapInArrow(run, dealt.schema)


def _verify_blocks(groups: DataFrame, shingles: DataFrame, least: float) -> DataFrame:
    """a, b: the candidate pairs in the groups of ``untried`` whose ``shingles`` (id, _h) align well enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            yield _links(table, least)

    return groups.join(shingles, "id").repartition(*DEAL).sortWithinPartitions(*DEAL).mapInArrow(run, "a long, b long")


def _shingles(docs: DataFrame, reps: DataFrame, buckets: DataFrame) -> DataFrame:
    """id, _h (labelled shingles) of the texts that can be in a pair: a pair shares ``SHARED`` buckets of one band."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, t in chunks(batch, "_norm"):
                ends = np.searchsorted(t.row, np.arange(b - a + 1))
                made = [labelled(t.hash[ends[i]:ends[i + 1]]).tobytes() for i in range(b - a)]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), pa.array(made, pa.binary())], ["id", "_h"])

    enough = buckets.groupBy("id", "_band").agg(F.count("*").alias("_n")).where(F.col("_n") >= SHARED).select("id").distinct()
    needed = stored(enough.join(reps, "id").select("id", "raw"))
    # the texts are found again by the digest of one row each; only those are normalised and moved
    texts = docs.select("text", raw_digest().alias("raw")).join(small(needed), "raw").dropDuplicates(["id"])
    return texts.select("id", normal(F.col("text")).alias("_norm")).mapInArrow(run, "id long, _h binary")


def text_classes(docs: DataFrame, least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(rows, labels): doc_id, digest and raw of each row with words; digest and label of each text."""
    with scratch(docs.sparkSession), narrow(docs.sparkSession):
        rows = stored(sketches(docs), keep=True)
        reps = stored(rows.groupBy("digest").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("raw").alias(
            "raw")).withColumn("id", F.monotonically_increasing_id()))
        labels, found = _labels(docs, reps, least), reps.select("digest", "id")
        if labels is None:
            found = found.select("digest", F.col("id").alias("label"))
        else:
            found = found.join(labels, "id", "left").select("digest", F.coalesce("label", "id").alias("label"))
        return rows.select("doc_id", "digest", "raw"), stored(found, keep=True)


def _labels(docs: DataFrame, reps: DataFrame, least: float) -> DataFrame | None:
    """id, label of the linked texts of ``reps`` (None: no links). Texts go by a number, so that buckets, pairs and links
    are pairs of longs."""
    band = F.floor(F.log("n") / float(-np.log(least)) + 1e-9)
    buckets = reps.select("id", "sketch", F.explode(F.array(band, band + 1)).alias("_band")).select(
        "id", "_band", F.posexplode("sketch").alias("_s", "_v")).select("id", "_s", "_band", F.xxhash64("_s", "_v", "_band").alias("key"))
    crowded = buckets.groupBy("key").agg(F.min("id").alias("_first"), F.count("*").alias("_c")).where("_c > 1").drop("_c")
    buckets = stored(buckets.join(crowded, "key"))
    shingles = stored(_shingles(docs, reps, buckets))
    tried, labels = None, None

    while True:
        if labels is None:
            pairs = buckets.where("id != _first").select(F.col("_first").alias("a"), F.col("id").alias("b"))
        else:
            # one member per component in each bucket, the last component's paired with the others'
            member = buckets.join(labels, "id", "left").groupBy("key", F.coalesce("label", "id").alias("label")).agg(
                F.min("id").alias("id"))
            lead = member.groupBy("key").agg(F.max("label").alias("_top"), F.max_by("id", "label").alias("_lead"),
                                             F.count("*").alias("_c")).where("_c > 1")
            pairs = member.join(lead, "key").where("label != _top").select(
                F.least("_lead", "id").alias("a"), F.greatest("_lead", "id").alias("b"))
        pairs = pairs.distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        one, other = (reps.select(F.col("id").alias(x), F.col("n").alias(f"_n{x}"), F.col("sketch").alias(f"_s{x}")) for x in "ab")
        alike = F.size(F.filter(F.zip_with("_sa", "_sb", lambda x, y: x == y), lambda e: e))
        near = F.least("_na", "_nb") >= F.lit(least) * F.greatest("_na", "_nb")
        pairs = stored(pairs.join(one, "a").join(other, "b").where(near & (alike >= SHARED)).select("a", "b"))
        if pairs.isEmpty():
            break
        new = stored(_verify(pairs, shingles, least))
        tried = pairs if tried is None else tried.union(pairs)
        if new.isEmpty():
            break
        labels = components(new) if labels is None else merged(labels, new)
    groups = stored(untried(buckets, reps, labels, least))
    if not groups.isEmpty():
        new = stored(_verify_blocks(groups, shingles, least))
        if not new.isEmpty():
            labels = components(new) if labels is None else merged(labels, new)
    return labels


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class), class_size (rows), is_kept: a row per row of ``docs``."""
    rows, labels = text_classes(docs, least)
    sizes = rows.groupBy("digest").agg(F.min("doc_id").alias("_m"), F.count("*").alias("_c")).join(labels, "digest").groupBy("label").agg(
        F.min("_m").alias("class_id"), F.sum("_c").alias("class_size"))
    found = rows.join(labels.join(sizes, "label"), "digest").select("doc_id", "class_id", "class_size")
    blank = docs.where(~has_words(F.col("text"))).select(F.col("doc_id").cast("long")).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return found.unionByName(blank).withColumn("is_kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def keep_one(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: one of each class, and all without words."""
    with scratch(docs.sparkSession):
        rows, labels = text_classes(docs, least)
        first = rows.join(labels, "digest").groupBy("label").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id"), F.col("digest"), F.col("raw"))).alias("k"))
        first = stored(first.select(F.col("k.doc_id").alias("_d"), F.col("k.raw").alias("_g")), keep=True)
    # the row is found again by its id and the digest of its text, without making its words once more
    every = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_id"),
                        raw_digest().alias("_t"), has_words(F.col("text")).alias("_worded"))
    one = every.where("_worded").join(first, (F.col("_t") == F.col("_g")) & F.col("_id").eqNullSafe(F.col("_d"))).dropDuplicates(["_t", "_id"])
    return one.select("_row.*").unionByName(every.where("NOT _worded").select("_row.*"))
