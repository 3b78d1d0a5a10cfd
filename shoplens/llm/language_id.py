"""Operator 1: language ID by compression.

For each language, a bounded sample of labelled documents becomes a raw-content zstandard dictionary (all in
lower case, as the texts are read, so that capitals tell nothing). A text is encoded with each dictionary, in pieces of ``PIECE`` bytes with a fresh window each, and the language
whose total is smallest wins; the margin between the two smallest totals gives the score, and
``rejected`` tells a margin too narrow to trust.

The sample: of each language the ``SAMPLE_DOCS`` labelled documents with the smallest hash of their id, up to
``EXCERPT`` characters of each from its middle, cut to the language's share of ``ALL_BYTES`` (and ``DICT_BYTES`` at
most), so dictionaries stay bounded however many languages there are. Predictions read whole texts.

Defined results: null text, or one without a letter, gives ``und`` with score 0, not rejected; equal totals
go to the language with more labelled documents, then the first by code point, rejected; with no
labelled document all is ``und``; a null doc_id is not held out; an empty table gives no rows; columns of the
input with names made here are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, Window, functions as F

SAMPLE_DOCS, EXCERPT = 64, 2_000
DICT_BYTES, ALL_BYTES = 64_000, 16_000_000
PIECE, LEVEL = 16_000, 3
#: Relative margin below which a prediction is rejected.
MARGIN = 0.02
MADE = ["lang_pred", "score", "rejected"]
_MAYBE_LETTER = re.compile(r"[^\W\d_]")  # also numerals that are no decimal digits


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _MAYBE_LETTER.finditer(text))


def learn(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, excerpt: int = EXCERPT) -> dict[str, bytes]:
    """Dictionary content per language from rows (doc_id, text, lang), most frequent language first."""
    labelled = labelled.where(F.col("lang").isNotNull() & (F.length("text") > 0))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.length("text"), "text")
    begin = F.greatest(F.floor((F.length("text") - excerpt) / 2), F.lit(0)).cast("int") + 1
    rows = labelled.withColumn("_n", F.row_number().over(order)).where(
        F.col("_n") <= sample_docs)  # partial limits keep hot languages cheap
    rows = rows.select("lang", "_n", F.lower(F.substring("text", begin, F.lit(excerpt))).alias("piece")).collect()
    count = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    texts: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (-count[r["lang"]], r["lang"], r["_n"])):
        texts.setdefault(r["lang"], []).append(r["piece"].encode())
    room = min(DICT_BYTES, ALL_BYTES // max(1, len(texts)))
    return {lang: b"\n".join(t)[:room] for lang, t in texts.items()}


class Encoders:
    """Compressors, one per language; made once in a Python worker."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        self.langs = list(dictionaries)
        params = zstd.ZstdCompressionParameters.from_level(
            level, strategy=zstd.STRATEGY_BTOPT, min_match=3, search_log=4,  # finds the short matches of short texts
            write_checksum=False, write_content_size=False, write_dict_id=False, format=zstd.FORMAT_ZSTD1_MAGICLESS)
        self.made = [zstd.ZstdCompressor(compression_params=params, dict_data=zstd.ZstdCompressionDict(
            content, dict_type=zstd.DICT_TYPE_RAWCONTENT)) for content in dictionaries.values()]

    def predict(self, text: str | None, margin: float) -> tuple[str, float, bool]:
        if not text or not self.made or not has_letter(text):
            return "und", 0.0, False
        data = text.lower().encode()
        sizes = [sum(len(c.compress(data[i:i + PIECE])) for i in range(0, len(data), PIECE)) for c in self.made]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.langs[0], 1.0, False
        second = min(s for i, s in enumerate(sizes) if i != best)
        score = (second - sizes[best]) / second
        return self.langs[best], score, score < margin


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """``docs`` (text, any other columns) with lang_pred, score and rejected; the text is left behind."""
    rest = [c for c in docs.columns if c not in (*MADE, "text")]
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = Encoders(shared.value)
        for batch in batches:
            out = [encoders.predict(t.as_py(), margin) for t in batch.column("text")]
            pred, score, rejected = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in rest] + [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                [*rest, *MADE])

    rows = docs.select(*rest, "text")
    schema = rows.select(*rest).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return rows.mapInArrow(run, schema)
