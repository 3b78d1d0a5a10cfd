"""Operator 6: benchmark decontamination by spaced-seed hashing.

Texts become lower-case words: runs of letters, digits and underscores, and each letter of a script that is written without
spaces (``UNSPACED``). Fixed masks select four of each window of four or five words and ignore the other, so a passage with
substituted words still shares selected words at some offset: every stretch of five words or more with a share
of ``MIN_EQUAL`` equal is hit. (With k substituted words, k > 3, some run of equal words has four; the masks with a
gap find the stretches with fewer.) The item is laid over the document at the hit's offset, and the stretch
with the best sum (+1 an equal word, -``PENALTY`` a substituted one) is taken. It counts if it has ``MIN_WORDS``
words (or the whole item if that is shorter) with a share of ``MIN_EQUAL`` equal; if not, the longest stretch
at that offset which does is taken.

Both sides are tables: the benchmark's seeds (hash, place) are joined with those of the documents, so a benchmark of any size
costs one pass for hits and one for the texts that have candidates. Of the documents only hashes that pass a Bloom filter of the
benchmark's are shuffled; the filter has at most ``FILTER_BITS`` bits (32 MB, 64 MB while the driver gathers it), and a
larger benchmark only lets more hashes through. Hits are counted by (text, item, offset). A stretch
that counts in an item of ``MIN_WORDS`` words or more holds one of 12 to 23 words that counts too (a longer one is halved), and
each of those has at least ``LEAST_HITS`` hits that span ``LEAST_SPAN`` words, so offsets with less are left out without loss (a
phrase of six words that every document and item share costs its join, but no verification). What remains is verified in lots of
at most about ``lot`` offsets of a text. Equal texts are one text (MD5 of their bytes) until the ids are put back; words are compared by
64-bit hashes. Items of more than ``PIECE`` words are looked up in pieces that overlap by ``OVERLAP`` words, more than 23, so
none is lost; an overlap is reported by its best piece.

Defined results: null and empty texts match nothing; repeated rows match each; repeated items are found under the id
of each; items under ``SHORTEST`` words are no evidence of a leak, match nothing and are listed by ``report`` with a null
document; null ids are carried through; an empty table gives no rows; other columns, whatever their names, are kept by ``remove``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from shoplens.llm.common import mix64, small, stored

#: Fixed masks: 1 selects a word of the window, 0 ignores it.
MASKS = ("1111", "11011", "10111", "11101")
MIN_WORDS, MIN_EQUAL, PENALTY, SHORTEST = 12, 0.8, 2, 5
#: Fewest (mask, place) hits, and words they span, of a stretch of 12 to 23 words of which 80 % are equal (a test tries them all).
LEAST_HITS, LEAST_SPAN = 6, 7
PIECE, OVERLAP, LOT = 256, 24, 200
FILTER_BITS = 1 << 28
#: Pieces of items that are broadcast (2 KB each), and words whose hashes a task keeps.
BROADCAST_PIECES, KEPT_WORDS = 5_000, 1_000_000
#: Characters of text whose windows are hashed together.
STRETCH = 1 << 20
#: Thai to Myanmar, Khmer, kana, Han.
UNSPACED = r"\u0e00-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_UNSPACED = re.compile(rf"[{UNSPACED}]")
_WORD = re.compile(r"\w+")
_WORD_OR_LETTER = re.compile(rf"[^\W{UNSPACED}]+|(?=\w)[{UNSPACED}]")
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)

_HITS = "digest binary, d int, h long"
_SEEDS = "h long, item binary, at int, p int, w int, n int"
_PIECES = "item binary, at int, words array<long>"
_FOUND = "digest binary, item binary, n_words long, n_equal long, doc_word long, item_word long"


def tokens(text: str | None) -> list[str]:
    if not text:
        return []
    return (_WORD_OR_LETTER if _UNSPACED.search(text) else _WORD).findall(text.lower())


class _WordHashes(dict):
    """Hashes of words, kept for those seen."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def seeds(words: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(words spanned, hash of each window) of each mask."""
    for k, mask in enumerate(MASKS):
        n = max(0, len(words) - len(mask) + 1)
        h = np.full(n, k + 1, np.uint64)
        for i, c in enumerate(mask):
            if c == "1":
                h += words[i:i + n] * _FACTORS[i]
        yield len(mask), mix64(h)


def stretch(words: np.ndarray, item: np.ndarray, offset: int) -> tuple[int, int, int, int] | None:
    """(words, equal words, first word in the document, in the item) of the best stretch with ``item`` laid over
    ``words`` from ``offset`` on."""
    d, p = max(0, offset), max(0, -offset)
    n = min(len(words) - d, len(item) - p)
    least = min(MIN_WORDS, len(item))
    if n < least:
        return None
    equal = words[d:d + n] == item[p:p + n]
    if equal.sum() < MIN_EQUAL * least:
        return None
    sums = np.concatenate([[0], np.cumsum(np.where(equal, 1, -PENALTY))])
    b = int(np.argmax(sums - np.minimum.accumulate(sums)))
    a = int(np.argmin(sums[:b + 1]))
    if b - a < least or equal[a:b].sum() < MIN_EQUAL * (b - a):
        # the longest stretch with enough equal words: of each end, the first start with no larger surplus
        surplus = np.concatenate([[0], np.cumsum(equal - MIN_EQUAL)])
        start = np.searchsorted(-np.minimum.accumulate(surplus), -surplus - 1e-9)
        b = int(np.argmax(np.arange(n + 1) - start))
        a = int(start[b])
        if b - a < least:
            return None
    return b - a, int(equal[a:b].sum()), d + a, p + a


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _texts(rows: DataFrame) -> DataFrame:
    return rows.where(F.length("text") > 0).select(_digest(F.col("text")).alias("digest"), "text")


def _cut_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of items (digest, text) with at least SHORTEST words."""
    hashes = _WordHashes()
    for batch in batches:
        for item, text in zip(batch.column("digest"), batch.column("text")):
            words = hashes.of(tokens(text.as_py())).view(np.int64)
            if len(words) < SHORTEST:
                continue
            starts = [0]
            while starts[-1] + PIECE < len(words):
                starts.append(starts[-1] + PIECE - OVERLAP)
            yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(starts), pa.binary()), pa.array(starts, pa.int32()),
                                              pa.array([words[s:s + PIECE] for s in starts], pa.list_(pa.int64()))], ["item", "at", "words"])


def _seed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, at, words in zip(*(batch.column(c) for c in ("item", "at", "words"))):
            words = np.array(words.as_py(), np.int64).view(np.uint64)
            found = [(w, h.view(np.int64)) for w, h in seeds(words)]
            n = sum(len(h) for _, h in found)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([h for _, h in found])), pa.array([item.as_py()] * n, pa.binary()),
                pa.array(np.full(n, at.as_py(), np.int32)), pa.array(np.concatenate([np.arange(len(h), dtype=np.int32) for _, h in found])),
                pa.array(np.repeat(np.array([w for w, _ in found], np.int32), [len(h) for _, h in found])),
                pa.array(np.full(n, len(words), np.int32))], ["h", "item", "at", "p", "w", "n"])


def _probes(bits: int) -> list[Column]:
    """Two places of a hash in a filter of ``bits`` bits, a power of two."""
    return [F.col("h").bitwiseAND(bits - 1), F.shiftrightunsigned("h", 32).bitwiseAND(bits - 1)]


def _filter(places: DataFrame) -> np.ndarray:
    """Bloom filter of the hashes of ``places``, 64 bits a word, sized for 32 bits a hash up to FILTER_BITS."""
    bits = min(FILTER_BITS, max(1 << 16, 1 << (32 * places.count()).bit_length()))
    word = F.shiftright("bit", 6)
    one = F.expr("shiftleft(1L, cast(bit & 63 as int))")
    filled = places.select(F.explode(F.array(*_probes(bits))).alias("bit")).groupBy(word.alias("word")).agg(F.bit_or(one).alias("set"))
    out = np.zeros(bits >> 6, np.uint64)
    got = filled.toArrow()  # at most bits / 64 rows
    out[got.column("word").to_numpy()] = got.column("set").to_numpy().view(np.uint64)
    return out


def _in_filter(h: np.ndarray, words: np.ndarray) -> np.ndarray:
    mask = np.uint64(len(words) * 64 - 1)
    inside = np.ones(len(h), bool)
    for bit in (h & mask, (h >> np.uint64(32)) & mask):
        inside &= (words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
    return inside


def _candidates(docs: DataFrame, places: DataFrame) -> DataFrame:
    """Offsets to be verified: digest, item, at, offset."""
    wanted = docs.sparkSession.sparkContext.broadcast(_filter(places))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            digests, texts = batch.column("digest"), batch.column("text")
            cut, first, size = [], 0, 0
            for r in range(len(texts)):
                cut.append(hashes.of(tokens(texts[r].as_py())))
                size += len(texts[r].as_buffer())
                if size < STRETCH and r + 1 < len(texts):
                    continue
                words, rows = np.concatenate(cut), np.repeat(np.arange(len(cut)), [len(c) for c in cut])
                begins = np.cumsum([0] + [len(c) for c in cut])
                for width, h in seeds(words):
                    at = np.flatnonzero(_in_filter(h, wanted.value))
                    at = at[rows[at] == rows[at + width - 1]]  # windows within one text
                    if len(at):
                        yield pa.RecordBatch.from_arrays([
                            digests.take(pa.array(rows[at] + first)).cast(pa.binary()), pa.array((at - begins[rows[at]]).astype(np.int32)),
                            pa.array(h[at].view(np.int64))], ["digest", "d", "h"])
                cut, first, size = [], r + 1, 0

    hits = _texts(docs).mapInArrow(run, _HITS).distinct()
    offsets = hits.join(small(places), "h").groupBy("digest", "item", "at", (F.col("d") - F.col("p")).alias("offset"))
    found = offsets.agg(F.count("*").alias("hits"), (F.max(F.col("d") + F.col("w")) - F.min("d")).alias("span"), F.first("n").alias("n"))
    enough = (F.col("hits") >= LEAST_HITS) & (F.col("span") >= LEAST_SPAN)
    return found.where((F.col("n") < MIN_WORDS) | enough).select("digest", "item", "at", "offset")


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best stretch of each (text, item, piece, offset) that has one."""
    hashes = _WordHashes()
    names = [f.split()[0] for f in _FOUND.split(", ")]
    for batch in batches:
        for digest, text, lot in zip(*(batch.column(c) for c in ("digest", "text", "lot"))):
            words, found = hashes.of(tokens(text.as_py())).view(np.int64), []
            for x in lot:
                if (m := stretch(words, x["words"].values.to_numpy(), x["offset"].as_py())) is not None:
                    found.append((digest.as_py(), x["item"].as_py(), *m[:3], m[3] + x["at"].as_py()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], pa.binary() if i < 2 else pa.int64()) for i in range(6)], names)


def _found(docs: DataFrame, benchmark: DataFrame, lot: int) -> DataFrame:
    """The best stretch of each (text, item), stored: digest, item, n_words, n_equal, doc_word, item_word."""
    pieces = stored(_texts(benchmark).dropDuplicates(["digest"]).mapInArrow(_cut_items, _PIECES))
    candidates = stored(_candidates(docs, stored(pieces.mapInArrow(_seed_rows, _SEEDS))))
    counts = stored(candidates.groupBy("digest").agg(F.count("*").alias("n")))
    part = F.pmod(F.xxhash64("item", "at", "offset"), F.ceil(F.col("n") / lot))
    lots = (candidates.join(small(counts), "digest").withColumn("part", part)
            .join(small(pieces, BROADCAST_PIECES), ["item", "at"])
            .groupBy("digest", "part").agg(F.collect_list(F.struct("item", "at", "offset", "words")).alias("lot")))
    texts = _texts(docs).join(small(counts.select("digest")), "digest", "left_semi").dropDuplicates(["digest"])
    found = lots.join(texts, "digest").select("digest", "text", "lot").mapInArrow(_verify, _FOUND)
    best = found.groupBy("digest", "item").agg(F.max(F.struct(
        "n_equal", "n_words", (-F.col("doc_word")).alias("d"), (-F.col("item_word")).alias("i"))).alias("m"))
    return stored(best.select("digest", "item", "m.n_words", "m.n_equal", (-F.col("m.d")).alias("doc_word"), (-F.col("m.i")).alias("item_word")))


def leaks(docs: DataFrame, benchmark: DataFrame, lot: int = LOT) -> DataFrame:
    """A row per document and benchmark item found in it: doc_id, item_id, n_words, n_equal, doc_word, item_word."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), _digest(F.col("text")).alias("item"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _digest(F.col("text")).alias("digest"))
    return (ids.join(small(_found(docs, benchmark, lot)), "digest").join(items, "item")
            .select("doc_id", "item_id", "n_words", "n_equal", "doc_word", "item_word"))


def report(docs: DataFrame, benchmark: DataFrame, lot: int = LOT) -> DataFrame:
    """``leaks`` and, with null document and places, each item too short to be looked up (n_words its words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(tokens(t.as_py())) for t in batch.column("text")]
            out = pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(sizes, pa.int64())], ["item_id", "n_words"])
            yield out.filter(pa.array([n < SHORTEST for n in sizes], pa.bool_()))

    unchecked = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(run, "item_id long, n_words long")
    return leaks(docs, benchmark, lot).unionByName(unchecked, allowMissingColumns=True)


def remove(docs: DataFrame, benchmark: DataFrame, lot: int = LOT) -> DataFrame:
    """The rows of ``docs`` in which no item is found, all columns."""
    found = small(stored(_found(docs, benchmark, lot).select(F.col("digest").alias("_leaked")).distinct()))
    return docs.join(found, _digest(docs["text"]) == found["_leaked"], "left_anti")
