"""Operator 10: quality rules by distribution divergence (DataFrame functions only).

Each document's histogram of character classes, and its histogram of the common words of its
language, is compared with the language's reference by the Jensen-Shannon distance (base 2, 0 to
1). The references are sums over all documents of the language that pass the base rules'
length test, so they cover the whole corpus; one pass makes them (a map-side combined aggregate of
one row per language), a second one judges.

The common words are listed for four languages; for any other they are its 12 most frequent words in the documents.

Defined results: null text has no words and fails the base rules; a null language has no common words and no
reference, so only the remaining tests apply; histograms of texts
shorter than the guards are not compared; an empty table gives no rows; columns of the input named like a
result are replaced, all others pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shoplens.llm.common import WS_CHARS, small, stored, words

# Frequent function words of each language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "was"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un"],
}
#: Distances above these reject; measured only from these lengths on.
MAX_CLASS_DISTANCE, MIN_CHARS = 0.3, 200
MAX_WORD_DISTANCE, MIN_WORDS = 0.5, 50
#: A reference with fewer characters or words than this judges nothing.
MIN_REFERENCE = 2_000.0
WINDOW = 8
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars_seen", "_classes", "_common"]
VERDICT = ["base_failed", "class_distance", "word_distance", "kept"]


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def _shares(a: Column) -> Column:
    """Counts over their sum; null if all are zero. ``a`` is a column that exists, not an expression:
    inside a lambda an expression would be computed for each element anew."""
    return F.when(_total(a) > 0, F.transform(F.arrays_zip(a.alias("x"), F.array_repeat(_total(a), F.size(a)).alias("s")),
                                             lambda z: z["x"] / z["s"]))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of shares of one length; null if either is null."""
    part = lambda x, y: F.when(x > 0, x * F.log2(F.lit(2.0) * x / (x + y))).otherwise(0.0)
    terms = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    return F.when(p.isNotNull() & q.isNotNull(), F.sqrt(F.greatest(_total(terms) / 2, F.lit(0.0))))


def _pairs(df: DataFrame, source: str, target: str, gap: int) -> DataFrame:
    """``target``[i] = hash of ``source``[i] and ``source``[i + gap]."""
    n = F.greatest(F.size(source) - gap, F.lit(0))
    return df.withColumn(target, F.zip_with(F.slice(source, F.lit(1), n), F.slice(source, F.lit(gap + 1), n),
                                            lambda x, y: F.xxhash64(x, y)))


def learned_words(docs: DataFrame, common: dict[str, list[str]] | None = None, most: int = 12) -> DataFrame:
    """_lang, _learned: the ``most`` most frequent words of every language of ``docs`` (text, lang) that ``common`` does not list,
    from all its documents. A row per such language."""
    listed = list(COMMON_WORDS if common is None else common)
    others = docs.where(F.col("lang").isNotNull() & ~F.col("lang").isin(listed))
    counts = others.select("lang", F.explode(words(F.col("text"))).alias("w")).groupBy("lang", "w").agg(F.count("*").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "w")
    top = counts.withColumn("i", F.row_number().over(order)).where(F.col("i") <= most)
    return top.groupBy(F.col("lang").alias("_lang")).agg(F.sort_array(F.collect_list("w")).alias("_learned"))


def features(docs: DataFrame, common: dict[str, list[str]] | None = None, learned: DataFrame | None = None) -> DataFrame:
    """``docs`` (text, lang, any other columns) with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_chars_seen and the histograms _classes and _common."""
    common = COMMON_WORDS if common is None else common
    keep = [c for c in docs.columns if c not in FEATURES]
    listed = F.create_map(*[x for k, v in common.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]) \
        if common else F.lit(None).cast("map<string,array<string>>")
    # the input in a struct, so no column of it can clash with those made here
    out = docs.select(F.struct(*keep).alias("_row"), "lang", F.coalesce("text", F.lit("")).alias("_t"), words(F.col("text")).alias("_w"))
    none = F.array().cast("array<string>")
    if learned is None:
        out = out.withColumn("_c", F.coalesce(F.try_element_at(listed, F.col("lang")), none))
    else:
        out = out.join(small(learned), F.col("lang") == F.col("_lang"), "left").withColumn(
            "_c", F.coalesce(F.try_element_at(listed, F.col("lang")), "_learned", none))
    out = out.withColumn("_longest", F.coalesce(F.array_max(F.transform("_c", F.octet_length)), F.lit(0)))
    # what is left without lower-case letters and white space is short; the classes are counted in it
    out = out.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.concat_ws("", "_w")).cast("long"),
        "_rest": F.regexp_replace("_t", r"[\p{Ll}\x20\x09-\x0D]+", ""),
        "_hits": F.filter("_w", lambda w: (F.octet_length(w) <= F.col("_longest")) & F.array_contains(F.col("_c"), w)),
        "_lines": F.filter(F.split("_t", "\n"), lambda x: F.length(F.btrim(x, F.lit(WS_CHARS))) > 0),
    })
    out = _pairs(_pairs(_pairs(out, "_w", "_p2", 1), "_p2", "_p4", 2), "_p4", "_p8", 4)
    out = out.withColumn("_at", F.when(F.size(F.array_distinct("_p8")) < F.size("_p8"), F.sort_array(
        F.transform("_p8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    # windows equal to a neighbour in hash order; then the ground that their positions cover
    n = F.size("_at")
    equal = F.filter(F.zip_with(F.slice("_at", F.lit(1), n - 1), F.slice("_at", F.lit(2), n - 1), lambda x, y: F.struct(
        x["i"].alias("x"), y["i"].alias("y"), (x["h"] == y["h"]).alias("e"))), lambda z: z["e"])
    at = F.sort_array(F.array_distinct(F.flatten(F.transform(equal, lambda z: F.array(z["x"], z["y"])))))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("to"))
    cover = F.aggregate(at, start, lambda s, i: F.struct(
        (s["n"] + WINDOW - F.greatest(F.lit(0), s["to"] - i)).alias("n"), (i + WINDOW).alias("to")), lambda s: s["n"])
    count = lambda p: F.regexp_count("_rest", F.lit(p)).cast("double")
    space = (F.length("_t") - F.col("word_chars")).cast("double")
    rare = [count(r"\p{Lu}"), count(r"\p{Nd}"), count(r"\p{P}"), count(r"[^\p{L}\p{M}\p{N}\p{P}]")]
    out = out.withColumns({
        "n_symbols": F.regexp_count("_rest", F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.when(F.col("_at").isNull(), F.lit(0)).otherwise(cover).cast("long"),
        "n_chars_seen": F.length("_t").cast("long"),
        "_classes": F.array(*rare, space),
        "_common": F.concat(
            F.transform("_c", lambda c: F.size(F.filter(F.col("_hits"), lambda h: h == c)).cast("double")),
            F.array((F.col("n_words") - F.size("_hits")).cast("double"))),
    })
    out = out.withColumn("_classes", F.concat("_classes", F.array(F.col("n_chars_seen") - _total(F.col("_classes")))))
    return out.select(*[F.col("_row").getField(c).alias(c) for c in keep], *FEATURES)


def language_reference(seen: DataFrame, common: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per language from ``features()`` rows: summed histograms of its documents of 20 words
    or more. Sums of whole counts as doubles are exact in any order."""
    widest = max([len(v) for v in (COMMON_WORDS if common is None else common).values()], default=12) + 1
    widest = max(widest, 13)
    part = lambda c, i: F.coalesce(F.sum(F.get(c, F.lit(i))), F.lit(0.0))
    return seen.where(F.col("lang").isNotNull() & (F.col("n_words") >= 20)).groupBy(F.col("lang").alias("_lang")).agg(
        F.array(*[part("_classes", i) for i in range(6)]).alias("_ref_classes"),
        F.array(*[part("_common", i) for i in range(widest)]).alias("_ref_common"),
    )


def judge(seen: DataFrame, reference: DataFrame, max_class_distance: float = MAX_CLASS_DISTANCE,
          min_chars: int = MIN_CHARS, max_word_distance: float = MAX_WORD_DISTANCE, min_words: int = MIN_WORDS,
          min_reference: float = MIN_REFERENCE) -> DataFrame:
    """``features()`` rows with base_failed, class_distance, word_distance (null where a guard holds)
    and kept. ``reference`` is stored; it is broadcast if its counted size is small."""
    keep = [c for c in seen.columns if c not in VERDICT]
    reference = reference.select(
        "_lang", F.when(_total("_ref_classes") >= min_reference, _shares(F.col("_ref_classes"))).alias("_q"),
        "_ref_common", (_total("_ref_common") >= min_reference).alias("_enough"))
    out = seen.select(*keep).join(small(stored(reference)), F.col("lang") == F.col("_lang"), "left").withColumns({
        "base_failed": (F.col("n_words") < 20) | (F.lit(100) * F.col("n_repeat_words") > F.lit(30) * F.col("n_words")),
        "_p": F.when(F.col("n_chars_seen") >= min_chars, _shares(F.col("_classes"))),
        "_u": F.when((F.col("n_words") >= min_words) & (F.size("_common") > 1), _shares(F.col("_common"))),
        "_r": F.when(F.col("_enough"), F.slice("_ref_common", F.lit(1), F.size("_common"))),
    }).withColumn("_v", _shares(F.col("_r"))).withColumns({
        "class_distance": js_distance(F.col("_p"), F.col("_q")),
        "word_distance": js_distance(F.col("_u"), F.col("_v")),
    })
    kept = ~F.col("base_failed") & (F.coalesce("class_distance", F.lit(0.0)) <= max_class_distance) \
        & (F.coalesce("word_distance", F.lit(0.0)) <= max_word_distance)
    return out.withColumn("kept", kept).select(*keep, *VERDICT)


def quality(docs: DataFrame, common: dict[str, list[str]] | None = None, **limits) -> DataFrame:
    """Verdict for each row, texts left behind: the features are stored once and serve both the
    reference and the verdict."""
    seen = stored(features(docs, common, stored(learned_words(docs, common))).drop("text"))
    return judge(seen, stored(language_reference(seen, common)), **limits)


def filter_quality(docs: DataFrame, common: dict[str, list[str]] | None = None, **limits) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns; texts are read twice and never copied."""
    learned = stored(learned_words(docs, common))
    reference = stored(language_reference(features(docs.select("lang", "text"), common, learned), common))
    inside = docs.select(F.struct(*docs.columns).alias("_row"), "lang", "text")
    # Catalyst would push the test below the projections and compute each lambda's operands again for
    # every element; a row number in the test keeps it above them
    verdict = judge(features(inside, common, learned), reference, **limits).withColumn("_n", F.monotonically_increasing_id())
    return verdict.where(F.col("kept") & (F.col("_n") >= 0)).select("_row.*")
