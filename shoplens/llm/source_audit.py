"""Source divergence audit: how the words of each source of a language differ from the other sources and from the language.

First pass: each task counts, chunk by chunk, in how many documents a term occurs; the sums by (language, term) are
exact, and the terms in enough documents are kept. The kept terms are dealt into shards of about a thousand keys, a
task builds each shard's minimal perfect hash, and the hashes are broadcast with their keys, which verify a lookup.
Second pass: a document's terms become slots, and dense counters of its (language, source) group are incremented;
a task gives out its counters that are not zero when they would exceed a bound, and at its end.

The broadcast is bounded: the hashes take the kept terms in most documents, ``HASHED`` at most; all rarer kept
terms are counted in the same pass by the term itself, summed in each chunk and task before they are shuffled and
joined with the kept ones. The divergences are whole numbers: a task takes the groups of two blocks of a language's sources
and the terms of some shards, and adds up what the terms found there differ by; terms found in neither of two
sources all add the same, which is multiplied out.

Defined cases: null text, lang and source count as ''. A group without terms has all counts 0. A language without
kept terms has the value 0 for every pair and no terms. Rows with equal doc_id are different documents. Texts are read whole, a few megabytes of documents at
a time (a longer text by itself: it needs about twenty times its size). Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from shoplens.llm.common import small, stored
from shoplens.llm.perfect_hash import SLOT_BITS, Hashes, buckets_of, build, digests, paired, shard_of

#: Kept terms in broadcast hashes at most; keys a shard has on average; bytes of text at a time; counters of a task at most.
HASHED, SHARD, TEXT, COUNTERS = 1 << 21, 1024, 4 << 20, 1 << 23
#: Sources of a block, shards (a power of two) whose terms one task compares, about 8,192; ranks of the terms given.
SOURCES, SHARDS, TOP = 256, 8, 10
SHARE = 1_000_000_000

_TERM = np.zeros(256, bool)
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _chunks(batch: pa.RecordBatch, limit: int = TEXT) -> Iterator[tuple[int, int, pa.Array, np.ndarray, np.ndarray]]:
    """(first row, row after the last, distinct terms, number of the term and row of each occurrence)."""
    text = batch.column("text").cast(pa.large_string())
    if not len(text):
        return
    ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    raw = text.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    a = 0
    while a < len(text):
        z = max(a + 1, int(np.searchsorted(ends, ends[a] + limit, side="right")) - 1)
        part, at = data[ends[a]:ends[z]], ends[a:z + 1] - ends[a]
        inside = _TERM[part]
        new = inside.copy()
        new[1:] &= ~inside[:-1]
        edge = at[(at > 0) & (at < len(part))]
        new[edge] |= inside[edge]
        start = np.flatnonzero(new)
        letters = _LOWER[part[inside]]
        cuts = np.concatenate([(np.cumsum(inside) - 1)[start], [len(letters)]]).astype(np.int64)
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(cuts), pa.py_buffer(letters)])
        coded = found.dictionary_encode()
        yield a, z, coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.searchsorted(at, start, side="right") - 1
        a = z


def _coded(column: pa.Array) -> tuple[list[str], np.ndarray]:
    d = column.dictionary_encode()
    return d.dictionary.to_pylist(), d.indices.to_numpy().astype(np.int64)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of the chunk that each (language, term) is in."""
    for b in batches:
        langs, lang = _coded(b.column("lang"))
        for a, _, terms, code, row in _chunks(b):
            once = np.unique(row * max(1, len(terms)) + code)
            pair, n = np.unique(lang[a + once // max(1, len(terms))] * max(1, len(terms)) + once % max(1, len(terms)), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()).take(pa.array(pair // max(1, len(terms)))),
                 terms.take(pa.array(pair % max(1, len(terms)))).cast(pa.large_string()).cast(pa.string()), pa.array(n)], ["lang", "term", "n"])


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """lang, term, n (documents) of the terms in at least ``least`` documents of the language."""
    parts = docs.select("lang", "text").mapInArrow(_documents, "lang string, term string, n long")
    return parts.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _numbered(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        langs, lang = _coded(b.column("lang"))
        l1, l2 = digests([x.encode() for x in langs])
        h1, h2 = paired((l1[lang], l2[lang]), digests([x.encode() for x in b.column("term").to_pylist()]))
        yield pa.RecordBatch.from_arrays([pa.array(shard_of(h1, shards)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)),
                                          b.column("lang"), b.column("term")], ["shard", "h1", "h2", "lang", "term"])


def _built(table: pa.Table) -> pa.Table:
    """One shard's row: seeds, and its keys by slot."""
    table = table.sort_by([("lang", "ascending"), ("term", "ascending")])
    slot, how = build(*(table[c].to_numpy().view(np.uint64) for c in ("h1", "h2")))
    keys = table.take(pa.array(np.argsort(slot)))
    lists = lambda a, t: pa.array([a], pa.list_(t))
    return pa.table({"shard": table["shard"].slice(0, 1), "how": lists(how, pa.int32()),
                     "langs": lists(keys["lang"].to_pylist(), pa.string()), "terms": lists(keys["term"].to_pylist(), pa.string())})


def hash_shards(terms: DataFrame, n: int) -> tuple[DataFrame, int]:
    """The shards' hashes of ``n`` (lang, term) rows, as a stored table, and the number of shards."""
    shards = max(1, n // SHARD)
    numbered = terms.select("lang", "term").mapInArrow(lambda it: _numbered(it, shards),
                                                       "shard long, h1 long, h2 long, lang string, term string")
    return stored(numbered.groupBy("shard").applyInArrow(_built, "shard long, how array<int>, langs array<string>, terms array<string>")), shards


def _joined(table: pa.Table, shards: int) -> tuple:
    """What ``Hashes`` is made of, from the rows of all shards that have keys."""
    table = table.sort_by("shard").combine_chunks()
    column = lambda c: pa.concat_arrays(table[c].chunks) if table[c].num_chunks else pa.array([], table[c].type)
    sizes = np.zeros(shards, np.int64)
    sizes[table["shard"].to_numpy()] = pc.list_value_length(column("terms")).to_numpy()
    seeds = column("how").flatten().to_numpy()
    buckets = buckets_of(sizes)  # one, unused, for a shard without keys
    how = np.zeros(buckets.sum(), np.int32)
    how[np.repeat(sizes > 0, buckets)] = seeds
    langs, lang_of = _coded(column("langs").flatten())
    return sizes, how, langs, lang_of.astype(np.int32), column("terms").flatten().cast(pa.large_binary())


def _count(batches: Iterator[pa.RecordBatch], hashes: Hashes, rest: bool, counters: int) -> Iterator[pa.RecordBatch]:
    """Occurrences of the hashed terms by slot; if there is a ``rest`` of kept terms, those of all others by term."""
    dense: dict[tuple[str, str], np.ndarray] = {}
    room = counters

    def given(lang, source, slot, term, n):
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(slot, pa.int64()),
                                           pa.array(term, pa.string()), pa.array(n, pa.int64())], ["lang", "source", "slot", "term", "n"])

    def flush():
        for (lang, source), counts in dense.items():
            at = np.flatnonzero(counts)
            if len(at):
                yield given([lang] * len(at), [source] * len(at), hashes.ids[hashes.own[hashes.langs[lang]][at]], [None] * len(at), counts[at])
        dense.clear()

    for b in batches:
        pairs: dict[tuple[str, str], int] = {}
        group = np.array([pairs.setdefault(p, len(pairs)) for p in zip(b.column("lang").to_pylist(), b.column("source").to_pylist())], np.int64)
        cut = list(pairs)
        lang_no = np.array([hashes.langs.get(lang, -1) for lang, _ in cut], np.int64)
        for a, _, terms, code, row in _chunks(b):
            m = max(1, len(terms))
            pair, n = np.unique(group[a + row] * m + code, return_counts=True)
            g, t = pair // m, pair % m
            h1, h2 = digests(terms.to_pylist())
            known = np.flatnonzero(lang_no[g] >= 0)
            slot = np.full(len(g), -1)
            slot[known] = hashes.find(lang_no[g[known]], (h1[t[known]], h2[t[known]]), terms.take(pa.array(t[known])))
            for one in np.unique(g[slot >= 0]):
                mine = (g == one) & (slot >= 0)
                if (key := cut[one]) not in dense:
                    size = len(hashes.own[lang_no[one]])
                    if size > room and dense:
                        yield from flush()
                        room = counters
                    dense[key], room = np.zeros(size, np.int64), room - size
                dense[key][hashes.place[slot[mine]]] += n[mine]  # a pair comes once
            if rest and len(other := np.flatnonzero(slot < 0)):
                yield given([cut[x][0] for x in g[other]], [cut[x][1] for x in g[other]], [None] * len(other),
                            terms.take(pa.array(t[other])).cast(pa.large_string()).cast(pa.string()), n[other])
    yield from flush()


def _apart(key: tuple, counts: pa.Table, groups: pa.Table) -> pa.Table:
    """For each pair of sources of two blocks: what the terms found in these shards add beyond terms found in neither."""
    i, j = key[2].as_py(), key[3].as_py()
    sources, block = groups["source"].to_pylist(), groups["block"].to_numpy()
    base = groups["p0"].to_numpy()
    slots, column = np.unique(counts["slot"].to_numpy(), return_inverse=True)
    p = np.repeat(base[:, None], len(slots), axis=1)
    number = {s: x for x, s in enumerate(sources)}
    d = counts["source"].combine_chunks().dictionary_encode()
    own = np.array([number[s] for s in d.dictionary.to_pylist()], np.int64)
    if len(counts):
        p[own[d.indices.to_numpy()], column] = counts["p"].to_numpy()
    out: list[tuple[str, str, int]] = []
    for x in np.flatnonzero(block == i):
        y = np.flatnonzero(block == j) if i != j else np.arange(x + 1, len(sources))
        if len(y):
            each = (p[x][None, :] - p[y]) ** 2 // (p[x][None, :] + p[y])
            none = (base[x] - base[y]) ** 2 // (base[x] + base[y])
            out += [(sources[x], sources[k], int(v)) for k, v in zip(y, each.sum(axis=1) - none * len(slots))]
    a, b, v = zip(*out) if out else ((), (), ())
    return pa.table({"lang": pa.array([key[0].as_py()] * len(out), pa.string()), "a": pa.array(a, pa.string()),
                     "b": pa.array(b, pa.string()), "more": pa.array(v, pa.int64())})


def _part(n: Column, total: Column, terms: Column) -> Column:
    """p of a count, exact (the product has up to 31 digits)."""
    whole = lambda c: c.cast("decimal(20,0)")
    product = (whole(n) + 2) * F.lit(SHARE).cast("decimal(10,0)")
    return F.call_function("div", product, whole(total) + 2 * whole(terms)).cast("long") + 1


def _term_value(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _ranked(rows: DataFrame, part: str, most: int | None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    out = rows.withColumn("rank", F.row_number().over(order))
    out = out.where(F.col("rank") <= most) if most else out
    return out.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))


def audit(documents: DataFrame, least: int = 10, hashed: int = HASHED, counters: int = COUNTERS, sources: int = SOURCES) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank; see the module text."""
    spark = documents.sparkSession
    docs = documents.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    kept = stored(kept_terms(docs, least))
    # documents a term must be in to be hashed: the smallest power of two that leaves at most ``hashed`` terms
    by_size = kept.groupBy(F.floor(F.log2("n")).cast("int").alias("b")).count().orderBy(F.col("b").desc()).collect()  # 64 rows at most
    total, floor, n_hashed = sum(r["count"] for r in by_size), None, 0
    for r in by_size:
        if n_hashed + r["count"] > hashed:
            break
        n_hashed, floor = n_hashed + r["count"], 1 << r.b
    top = kept.where(F.col("n") >= floor) if floor is not None else kept.where(F.lit(False))
    rest = n_hashed < total
    shards, n_shards = hash_shards(top, n_hashed)
    slots = shards.select("shard", F.posexplode(F.arrays_zip("langs", "terms")).alias("at", "key"))
    slots = slots.select(((F.col("shard") * (1 << SLOT_BITS)) + F.col("at")).alias("slot"), F.col("key.langs").alias("lang"),
                         F.col("key.terms").alias("term"))

    sent = spark.sparkContext.broadcast(_joined(shards.toArrow(), n_shards))  # ``hashed`` keys at most

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _count(batches, Hashes(*sent.value), rest, counters)

    found = docs.mapInArrow(count, "lang string, source string, slot long, term string, n long")
    if rest:
        found = stored(found)
        left = kept.where(F.col("n") < floor) if floor is not None else kept
        # slots past those of the shards, written once so that they stay
        at = F.monotonically_increasing_id()  # partition << 33 | row: a thousand rows are taken for a shard
        left = left.select(((F.lit(n_shards) + F.shiftright(at, 33) * (1 << 22) + F.shiftright(at.bitwiseAND((1 << 33) - 1), 10))
                            * (1 << SLOT_BITS) + at.bitwiseAND(1023)).alias("slot"), "lang", "term")
        left = stored(left)
        slots = slots.unionByName(left)
        rare = found.where(F.col("slot").isNull()).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
        by_term = rare.join(left, ["lang", "term"]).select("lang", "source", "slot", "n")
        found = found.where(F.col("slot").isNotNull()).select("lang", "source", "slot", "n").unionByName(by_term)
    counts = stored(found.groupBy("lang", "source", "slot").agg(F.sum("n").alias("n")))

    of_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    of_group = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (docs.select("lang", "source").distinct().join(of_lang, "lang", "left").join(of_group, ["lang", "source"], "left")
              .fillna(0, ["terms", "total"]))
    by_lang = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.ceil(F.count(F.lit(1)) / sources).cast("int").alias("blocks"))
    groups = stored(groups.join(by_lang, "lang").withColumns({
        "p0": F.when(F.col("terms") > 0, _part(F.lit(0), F.col("total"), F.col("terms"))),
        "block": F.pmod(F.xxhash64("source"), "blocks").cast("int")}))
    near = small(groups)

    shares = counts.join(near, ["lang", "source"]).withColumn("p", _part(F.col("n"), F.col("total"), F.col("terms")))
    q = _part(F.sum("n").over(Window.partitionBy("lang", "slot")), F.col("lang_total"), F.col("terms"))
    above = shares.withColumn("q", q).where(F.col("p") > F.col("q")).join(slots, ["lang", "slot"])
    terms = above.select("lang", "source", F.col("term").alias("item"), _term_value(F.col("p"), F.col("q")).alias("value"))

    tile = F.shiftright("slot", SLOT_BITS + SHARDS.bit_length() - 1).alias("tile")
    with_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    blocks = (F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    left = shares.select("lang", "source", "slot", "p", "block", tile, with_block).select("lang", "source", "slot", "p", "tile", *blocks)
    tiles = counts.select("lang", tile).distinct()
    right = (near.where(F.col("terms") > 0).join(tiles, "lang").select("lang", "source", "p0", "block", "tile", with_block)
             .select("lang", "source", "p0", "block", "tile", *blocks))
    on = ("lang", "tile", "i", "j")
    more = (left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(_apart, "lang string, a string, b string, more long")
            .groupBy("lang", "a", "b").agg(F.sum("more").alias("more")))
    both = more.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                 F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "more")
    both = both.select("lang", "x.source", "x.item", "more")
    mine = groups.select("lang", "source", "terms", "p0")
    pairs = mine.join(groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0")), "lang").where("source <> item")
    pairs = pairs.join(both, ["lang", "source", "item"], "left").select(
        "lang", "source", "item", F.coalesce(F.col("terms") * _term_value(F.col("p0"), F.col("q0")) + F.coalesce(F.col("more"), F.lit(0)),
                                             F.lit(0)).cast("long").alias("value"))
    return _ranked(pairs, "pair", None).unionByName(_ranked(terms, "term", TOP))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT r, lang, source, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
  FROM (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM d)),
k AS (SELECT lang, w FROM t GROUP BY 1, 2 HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY 1),
c AS (SELECT lang, source, w, count(*) AS n FROM t JOIN k USING (lang, w) GROUP BY 1, 2, 3),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT lang, source, coalesce(sum(n), 0) AS m FROM g LEFT JOIN c USING (lang, source) GROUP BY 1, 2),
p AS (SELECT lang, source, w, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (m + 2 * v) AS p
  FROM gn JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, w)),
q AS (SELECT lang, w, 1 + (1000000000::HUGEINT * (sum(n) + 2)) // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * any_value(v)) AS q
  FROM p JOIN v USING (lang) GROUP BY lang, w),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.w = b.w AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, w AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
  FROM p JOIN q USING (lang, w) WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM o WHERE part = 'pair' OR rank <= 10
"""
