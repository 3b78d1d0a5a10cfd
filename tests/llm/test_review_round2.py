"""Cases that a review named: letters, clashing columns, other languages, capped sources, hot lines."""

import collections

import pytest
from pyspark.sql import functions as F

from shoplens.llm import chat_format, language_id, line_dedup, mixing, quality_rules, sharding


def test_numerals_are_no_letters():
    assert not any(map(language_id.has_letter, ["½ ²", "①②", "Ⅷ", "12 $", "_", ""]))
    assert all(map(language_id.has_letter, ["1a", "½ß", "漢", "ª"]))


def test_inner_names_pass(spark):
    docs = spark.createDataFrame([(1, "a line of more than forty characters stands here", "en", 7, "x", "y", "z", 1, 2)],
                                 "doc_id long, text string, lang string, _at long, _t string, _key string, _mixed string, _bin int, _row int")
    want = (7, "x", "y", "z", 1, 2)
    for out in (line_dedup.dedup_lines(docs), sharding.shard(docs), quality_rules.quality(docs), quality_rules.features(docs)):
        r = out.first()
        assert tuple(r[c] for c in ("_at", "_t", "_key", "_mixed", "_bin", "_row")) == want


def test_common_words_of_unlisted_languages(spark):
    said = "ja nein oder doch wohl immer noch hier da so wie dort "
    rows = [(i, said * 10, "xx") for i in range(40)] + [(100, "qqq www eee rrr ttt zzz uuu iii ooo ppp aaa sss ddd fff " * 5, "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = quality_rules.learned_words(docs).collect()
    assert [(r["_lang"], r["_learned"]) for r in learned] == [("xx", sorted(said.split()))]
    got = {r["doc_id"]: r["word_distance"] for r in quality_rules.quality(docs).collect()}
    assert got[100] > 0.9 and got[0] < 0.1


def test_a_source_at_its_cap_comes_within_a_block(spark):
    """Ten blocks, wanted three times; and every seed."""
    block = mixing.BLOCK
    rows = [(1, "w " * (10 * block), "a")] + [(i, "v " * 500, "b") for i in range(2, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for seed in range(4):
        per = collections.Counter()
        for r in mixing.mix_digest(docs, seed=seed).collect():
            assert r["taken"] <= 3 * r["size"]
            per[r["source"]] += r["taken"]
            per[r["source"], "target"] = r["target"]
        assert all(abs(per[s] - per[s, "target"]) <= block for s in "ab")
    assert per["a"] == 30 * block


def test_draws_differ_by_shard(spark):
    sources = spark.createDataFrame([(i, "s", 1000 + 37 * i, 2300.0 + 11 * i) for i in range(40)], "_sid int, source string, source_size long, target double")
    got = mixing.draws(sources).collect()
    n = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: (r["_sid"], r["shard"])):
        assert r["first"] == sum(n[r["_sid"]])
        n[r["_sid"]].append(r["n"])
    for i in range(40):
        wanted = -(-(1000 + 37 * i) // mixing.BLOCK) * (2300.0 + 11 * i) / (1000 + 37 * i)
        assert abs(sum(n[i]) - wanted) < 1
    assert len({tuple(x - min(v) for x in v) for v in n.values()}) > 10


def plain_dedup(rows):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    found = collections.defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                found[key(x)].add(i)
    first = {k: max((i for i in v if i is not None), default=None) for k, v in found.items() if len(v) >= 5}
    return sorted((str(i), "\n".join(x for x in (t or "").split("\n") if key(x) not in first or first[key(x)] == i)) for i, t in rows)


@pytest.mark.parametrize("ranges", [1, 2, 13, 64])
def test_runs_over_any_ranges(spark, ranges):
    """A line that a third of all rows are, one that is in four documents and in five, repeated rows and null ids."""
    long = lambda x: f"{x} stands in a line of well over forty characters, doesn't it"
    rows = [(i, "\n".join([long("HOT") if i % 2 else f"  {long('hot').upper()}\t", long(f"own {i}"), long(f"of {i // 4}"), long(f"by {i // 5}"), "short"]))
            for i in range(120)]
    rows += [rows[3], rows[3], (None, long("hot")), (None, long("hot") + "\n" + long("of 2")), (500, long("hot") + "\n" + long("hot")), (501, None)]
    rows += [(None, long("nulls")), (None, long("nulls")), (600, long("nulls")), (601, long("nulls")), (602, long("nulls")), (603, long("nulls"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, ranges=ranges))
    assert sorted((str(r["doc_id"]), r["kept_text"]) for r in out.collect()) == plain_dedup(rows)


def test_rewritten_history_is_told(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    got = chat_format.digest(chat_format.format_conversations(turns)).first()
    assert got["rewrites_history"] is False and got["loss_chars"] == 1
    rewriting = lambda ts: f"{len(ts)}:" + "".join(t for _, t in ts)
    told = chat_format.digest(chat_format.format_conversations(turns, rewriting), lambda text: []).first()
    assert told["rewrites_history"] is True and told["loss_chars"] == 0
