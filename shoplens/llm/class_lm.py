"""Operator 2: language-model scoring by Brown class-based bigrams.

Training counts every word of every training text. All words seen ``MIN_COUNT`` times or more get learned classes by
the exchange algorithm, in two stages. The ``CORE`` most frequent words are moved one at a time, over several sweeps, by
the exact gain in the likelihood of the class bigrams. Then sweeps over all the others: tasks gather the classes that stand
before and after each word in the whole corpus, and find the word's best class against the table of class bigrams (the
gain of a word that is small next to its class); moves are applied half of the words at a time, the table is counted anew,
and moves that did not raise the likelihood are taken back. The number of classes grows with the vocabulary. Words
seen less often, or never, fall into fixed classes by form (how the word ends, its length, whether it is ASCII), and the
end of a text is a class of its own. A text's probability is the product of class transitions P(class | class before),
smoothed towards P(class), and word emissions P(word | class): relative frequencies, with absolute discounting for
the form classes, whose freed mass is the probability of one unknown word (the base counts unknown words as one event, too).

What scales: words are counted and looked up as 64-bit hashes (a clash of two words is about one in ten million
vocabularies of a million words); counts are combined per task and then over the cluster. The training texts are written
once as word numbers, which the sweeps read. What tasks hold is the model: ``TABLE`` words at most (a million, 14 MB; where a corpus
has more words of ``MIN_COUNT``, the count that is asked for doubles until they fit), their classes, and the class table. Gathered contexts
are summed per task and then, a thousand words at a time, in tasks that hold one block's sums. In scoring, only the rarer words of each
document are joined with the counts.

Defined results: null text is empty: one token, the end; rows are scored one by one, so repeated rows and
repeated or null doc_ids get a row each (a null id is not held out); without training text every token is unknown;
an empty table gives no rows. Other columns come back, but for those named like a result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shoplens.llm.common import Tokens, chunks, stored

MIN_COUNT, TABLE = 10, 1 << 20
#: Words moved one at a time, and how often; sweeps over all others; words whose contexts one task sums.
CORE, SWEEPS, BATCH_SWEEPS, BLOCK = 1024, 6, 2, 1024
#: Learned classes: this power of the number of clustered words, within the bounds.
GROWTH, FEWEST, MOST_CLASSES = 0.45, 16, 1024
#: Distinct (word, context) pairs a task holds before it gives them out.
PAIRS = 1_500_000
#: Pseudo-count of P(class) in P(class | class before).
SMOOTH = 16.0
#: Largest discount: a word seen once keeps some of its count even where no word was seen twice.
MOST = 0.9
LENGTHS = np.array([3, 5, 7, 10, 15])
FORMS = 4 * (len(LENGTHS) + 1) * 2
END = np.uint64(0)  # the end's hash: no word has it (see _hash)
_ENDING = np.zeros(256, dtype=np.int64)
_ENDING[33:48] = _ENDING[58:65] = _ENDING[91:97] = _ENDING[123:127] = 3
_ENDING[ord(".")], _ENDING[ord(",")] = 1, 2


def forms(t: Tokens) -> np.ndarray:
    """Form class of each word: ending, length, ASCII or not."""
    high = np.concatenate([[0], np.cumsum(t.data >= 128, dtype=np.int64)])
    length = np.searchsorted(LENGTHS, t.end - t.start, side="right")
    ending = _ENDING[t.data[t.end - 1]] if len(t.end) else np.zeros(0, np.int64)
    return (ending * (len(LENGTHS) + 1) + length) * 2 + (high[t.end] > high[t.start])


def with_ends(t: Tokens, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, form (-1 for the end) and row of all tokens, an end behind each row's words."""
    hashes = np.maximum(t.hash, np.uint64(1))
    behind = np.searchsorted(t.row, np.arange(rows), side="right")
    return (np.insert(hashes, behind, END), np.insert(forms(t), behind, -1), np.insert(t.row, behind, np.arange(rows)))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def word_counts(train: DataFrame) -> DataFrame:
    """h, form, c: each word's hash, form class and count; the end is h = 0. Combined per task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(parts: list) -> pa.RecordBatch:
            h, first, where = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
            c = np.bincount(where, weights=np.concatenate([p[2] for p in parts]), minlength=len(h)).astype(np.int64)
            return h, np.concatenate([p[1] for p in parts])[first], c

        held, size = [], 0
        for batch in batches:
            for a, b, t in chunks(batch, "text"):
                h, form, _ = with_ends(t, b - a)
                u, first, c = np.unique(h, return_index=True, return_counts=True)
                held.append((u, form[first], c))
                size += len(u)
                if size > 1_500_000:  # merge; pass on only what stays large
                    held = [emit(held)]
                    size = len(held[0][0])
                    if size > 1_000_000:
                        u, f, c = held[0]
                        yield pa.RecordBatch.from_arrays([_signed(u), pa.array(f), pa.array(c)], ["h", "form", "c"])
                        held, size = [], 0
        if held:
            u, f, c = emit(held)
            yield pa.RecordBatch.from_arrays([_signed(u), pa.array(f), pa.array(c)], ["h", "form", "c"])

    rows = train.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "h long, form long, c long")
    return rows.groupBy("h").agg(F.min("form").alias("form"), F.sum("c").alias("c"))


def _lookup(keys: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Positions of ``h`` in the sorted ``keys``; -1 where absent."""
    if not len(keys):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return np.where(keys[at] == h, at, -1)


def symbols(h: np.ndarray, form: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    """0 to n - 1: exchange words (sorted ``keys``), then forms, then the end."""
    at = _lookup(keys, h)
    return np.where(h == END, n + FORMS, np.where(at >= 0, at, n + form))


RESULTS = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]


def encoded(train: DataFrame, keys: np.ndarray) -> DataFrame:
    """ids: the symbols of some whole texts (32-bit numbers), each text closed by the end."""
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, t in chunks(batch, "text"):
                h, form, _ = with_ends(t, b - a)
                yield pa.RecordBatch.from_arrays([pa.array([symbols(h, form, keys, n).astype(np.int32).tobytes()], pa.binary())], ["ids"])

    return train.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "ids binary")


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for x in batch.column("ids"):
            yield np.frombuffer(x.as_buffer(), np.int32)


def class_bigrams(ids: DataFrame, cls: np.ndarray) -> np.ndarray:
    """Counts of successive classes; the end, which is the last class, also stands before each text."""
    k = int(cls[-1]) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k * k, np.int64)
        for s in _ids(batches):
            c = cls[s]
            total += np.bincount(np.concatenate([[k - 1], c[:-1]]) * k + c, minlength=k * k)
        where = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(total[where])], ["pair", "c"])

    got = ids.mapInArrow(run, "pair long, c long").groupBy("pair").agg(F.sum("c").alias("c")).toArrow()  # at most k * k rows
    out = np.zeros(k * k)
    out[got["pair"].to_numpy()] = got["c"].to_numpy()
    return out.reshape(k, k)


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(table: np.ndarray) -> float:
    """Log likelihood of the class bigrams, but for the words' own counts, which no class changes."""
    return float(xlogx(table).sum() - xlogx(table.sum(0)).sum() - xlogx(table.sum(1)).sum())


def _gather(batches: Iterator[pa.RecordBatch], cls: np.ndarray, moving: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per block of words: codes (word within the block, side, class) and counts of the contexts of the moving words."""
    k = int(cls[-1]) + 1

    def give(codes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        block = codes // (BLOCK * 2 * k)
        edges = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]])) if len(codes) else []
        for a, z in zip(edges, edges[1:]):
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(block[a])], pa.int32()), pa.array([(codes[a:z] - block[a] * (BLOCK * 2 * k)).astype(np.int32).tobytes()], pa.binary()),
                 pa.array([counts[a:z].tobytes()], pa.binary())], ["block", "codes", "counts"])

    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        codes = np.concatenate([p[0] for p in parts])
        order = np.argsort(codes, kind="stable").astype(np.int32)
        codes = codes[order]
        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        return codes[first], np.add.reduceat(np.concatenate([p[1] for p in parts])[order], first).astype(np.int32)

    held, size = [], 0
    for s in _ids(batches):
        at = np.flatnonzero(moving[s])  # no ends, so something follows
        if len(at):
            c = cls[s]
            word = s[at].astype(np.int64) * (2 * k)
            before = np.where(at > 0, c[np.maximum(at - 1, 0)], k - 1)
            codes, times = np.unique(np.concatenate([word + before, word + k + c[at + 1]]), return_counts=True)
            held.append((codes, times.astype(np.int32)))
            size += len(held[-1][0])
            if size > PAIRS:
                held = [merged(held)]
                size = len(held[0][0])
                if size > PAIRS // 2:
                    yield from give(*held[0])
                    held, size = [], 0
    if held:
        yield from give(*merged(held))


def best_classes(ids: DataFrame, cls: np.ndarray, table: np.ndarray, moving: np.ndarray, classes: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, class) of the moving words whose best learned class is not the one they have."""
    k = len(table)
    log = np.log(table + 0.5)
    margins = np.log(table.sum(1) + 0.5 * k) + np.log(table.sum(0) + 0.5 * k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = -1, np.zeros((BLOCK, 2 * k), np.int64)

        def found() -> pa.RecordBatch:
            word = np.flatnonzero(total.any(axis=1))
            x = total[word].astype(float)
            gain = x[:, :k] @ log + x[:, k:] @ log.T - x[:, :k].sum(axis=1)[:, None] * margins
            now = cls[block * BLOCK + word]
            best = gain[:, :classes].argmax(axis=1)
            own = gain[np.arange(len(word)), now]
            better = np.flatnonzero((best != now) & (gain[np.arange(len(word)), best] > own + 1e-9))
            return pa.RecordBatch.from_arrays([pa.array(block * BLOCK + word[better]), pa.array(best[better])], ["word", "cls"])

        for b in batches:
            for one, codes, counts in zip(b.column("block").to_pylist(), b.column("codes"), b.column("counts")):
                if one != block:
                    if block >= 0:
                        yield found()
                    block, total = one, np.zeros((BLOCK, 2 * k), np.int64)
                total.reshape(-1)[np.frombuffer(codes.as_buffer(), np.int32)] += np.frombuffer(counts.as_buffer(), np.int32)  # codes come once
        if block >= 0:
            yield found()

    sums = ids.mapInArrow(lambda it: _gather(it, cls, moving), "block int, codes binary, counts binary")
    dealt = sums.repartition(-(-n // BLOCK), "block").sortWithinPartitions("block")
    got = dealt.mapInArrow(run, "word long, cls long").toArrow()  # at most a row per word of the table
    return got["word"].to_numpy(), got["cls"].to_numpy()


def learned_classes(words: int) -> int:
    return int(min(MOST_CLASSES, max(FEWEST, round(words ** GROWTH)), max(1, words)))


def cluster(ids: DataFrame, counts: np.ndarray, form: np.ndarray, classes: int, core: int = CORE,
            sweeps: int = BATCH_SWEEPS) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(class of each symbol, table of class bigrams, likelihood after each step) for the words with these counts and forms."""
    n = len(counts)
    by_form = np.concatenate([classes + form, classes + np.arange(FORMS + 1)])
    head = np.sort(np.argsort(-counts, kind="stable")[:core])
    single = by_form - classes + len(head)  # the core's words one by one, all others by form
    single[head] = np.arange(len(head))
    moved = exchange(class_bigrams(ids, single), len(head), classes)[:len(head)]
    cls = by_form.copy()
    cls[head] = moved
    table = class_bigrams(ids, cls)
    seen = [likelihood(table)]
    others = np.ones(n, bool)
    others[head] = False
    for step in range(2 * sweeps if others.any() else 0):
        moving = np.zeros(len(cls), bool)
        moving[:n] = others & (np.arange(n) % 2 == step % 2)
        word, to = best_classes(ids, cls, table, moving, classes, n)
        tried = cls.copy()
        tried[word] = to
        after = class_bigrams(ids, tried) if len(word) else table
        if likelihood(after) <= seen[-1]:
            continue  # taken back
        cls, table = tried, after
        seen.append(likelihood(table))
    return cls, table, seen


def exchange(counts: np.ndarray, n: int, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each symbol: the first ``n`` are clustered into 0 to classes - 1, the others keep one each."""
    width = len(counts)
    k = classes + width - n
    cls = np.concatenate([np.arange(n) % classes, classes + np.arange(width - n)])
    own = np.zeros((width, k))
    own[np.arange(width), cls] = 1
    table = own.T @ counts @ own
    right, left, self_ = counts.sum(1), counts.sum(0), counts.diagonal()
    rows, cols = table.sum(1), table.sum(0)
    frequent = np.argsort(-(right + left)[:n], kind="stable")
    pick = np.arange(classes)
    for _ in range(sweeps):
        moved = 0
        for w in frequent:
            a = cls[w]
            r = np.bincount(cls, weights=counts[w], minlength=k)
            c = np.bincount(cls, weights=counts[:, w], minlength=k)
            r[a] -= self_[w]
            c[a] -= self_[w]
            table[a] -= r
            table[:, a] -= c
            table[a, a] -= self_[w]
            rows[a] -= right[w]
            cols[a] -= left[w]
            top, side = table[:classes], table[:, :classes]
            gain_rows = xlogx(top + r) - xlogx(top)
            gain_cols = xlogx(side + c[:, None]) - xlogx(side)
            corner = top[pick, pick]
            gain = gain_rows.sum(1) - gain_rows[pick, pick] + gain_cols.sum(0) - gain_cols[pick, pick] \
                + xlogx(corner + r[:classes] + c[:classes] + self_[w]) - xlogx(corner) \
                - xlogx(rows[:classes] + right[w]) + xlogx(rows[:classes]) \
                - xlogx(cols[:classes] + left[w]) + xlogx(cols[:classes])
            b = int(np.argmax(gain)) if gain.max() > gain[a] + 1e-9 else a
            moved += b != a
            cls[w] = b
            table[b] += r
            table[:, b] += c
            table[b, b] += self_[w]
            rows[b] += right[w]
            cols[b] += left[w]
        if not moved:
            break
    return cls


def transitions(table: np.ndarray, smooth: float = SMOOTH) -> np.ndarray:
    """log10 P(class | class before)."""
    share = (table.sum(0) + 0.5) / (table.sum() + 0.5 * len(table))
    return np.log10((table + smooth * share) / (table.sum(1, keepdims=True) + smooth))


class Model:
    """What scoring needs besides the counts of rare words; bounded by TABLE, MOST_CLASSES and FORMS."""

    def __init__(self, n_tokens: int, n_types: int, keys: np.ndarray, counts: np.ndarray, cls: np.ndarray, classes: int,
                 moves: np.ndarray, class_total: np.ndarray, form_stats: np.ndarray, likelihoods: list[float]):
        self.n_tokens, self.n_types = n_tokens, n_types
        self.keys, self.counts, self.cls, self.classes = keys, counts, cls, classes
        self.moves, self.class_total, self.form_stats, self.likelihoods = moves, class_total, form_stats, likelihoods


def least_count(counts: DataFrame, min_count: int = MIN_COUNT, table: int = TABLE) -> int:
    """``min_count``, doubled until at most ``table`` words are that frequent."""
    step = F.floor(F.log2(F.col("c") / min_count)).cast("int")
    sizes = {r[0]: r[1] for r in counts.where(F.col("c") >= min_count).groupBy(step).count().collect()}  # 64 rows at most
    doubled, left = 0, sum(sizes.values())
    while left > table:
        left -= sizes.get(doubled, 0)
        doubled += 1
    return min_count << doubled


def train(docs: DataFrame, counts: DataFrame, core: int = CORE, min_count: int = MIN_COUNT, table_words: int = TABLE,
          classes: int | None = None) -> Model:
    """``counts``: word_counts(docs), stored."""
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    words = counts.where("form >= 0")
    least = least_count(words, min_count, table_words)
    top = words.where(F.col("c") >= least).toArrow()  # at most ``table_words`` rows
    h, c, form = top["h"].to_numpy().view(np.uint64), top["c"].to_numpy(), top["form"].to_numpy()
    order = np.argsort(h)
    keys, c, form = h[order], c[order], form[order]
    classes = classes or learned_classes(len(keys))
    ids = stored(encoded(docs, keys))
    cls, table, likelihoods = cluster(ids, c, form, classes, core)
    class_total = np.bincount(cls[:len(keys)], weights=c, minlength=len(table)) if len(keys) else np.zeros(len(table))
    class_total[-1] = table[:, -1].sum()
    # the form classes hold all words without a learned class: tokens, types, types seen once, twice
    stats = np.zeros((FORMS, 4))
    for r in words.where(F.col("c") < least).groupBy("form").agg(F.sum("c"), F.count("*"), F.sum((F.col("c") == 1).cast("long")),
                                                                 F.sum((F.col("c") == 2).cast("long"))).collect():
        stats[r[0]] = r[1:]
    for i in np.flatnonzero(cls[:len(keys)] >= classes):
        stats[form[i]] += (c[i], 1, c[i] == 1, c[i] == 2)
    return Model(int(total[0]), int(total[1]), keys, c, cls, classes, transitions(table), class_total, stats, likelihoods)


def discounts(stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per form: the discount d taken from each count, and the unknown word's log10 probability."""
    tokens, types, once, twice = stats.T
    d = np.where(once > 0, np.minimum(once / np.maximum(once + 2 * twice, 1), MOST), 0.5)
    return d, np.log10(np.where(tokens > 0, np.maximum(d * types, 1e-9) / np.maximum(tokens, 1), 1.0))


def score(docs: DataFrame, counts: DataFrame, model: Model) -> DataFrame:
    """A row per document row: the columns of ``docs`` but the text and those named like a result, n_tokens, n_known, train_tokens, base_score, score."""
    rest = [c for c in docs.columns if c not in ("text", *RESULTS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 36
        n, k = len(model.keys), len(model.class_total)
        d, _ = discounts(model.form_stats)
        emit_form = np.log10(np.maximum(model.form_stats[:, 0], 1))
        log_class = np.log10(np.maximum(model.class_total, 1))
        base_at = np.log10(max(model.n_tokens + model.n_types + 1, 1))
        done = 0
        for batch in batches:
            others = batch.drop_columns(["text"])
            for a, b, t in chunks(batch, "text"):
                h, form, row = with_ends(t, b - a)
                s = symbols(h, form, model.keys, n)
                cl = model.cls[s]
                before = np.concatenate([[k - 1], cl[:-1]])
                logp = model.moves[before, cl]
                c = np.where(s < n, np.append(model.counts, 0)[np.minimum(s, n)], np.where(h == END, model.class_total[-1], 0))
                seen, is_form = c > 0, (form >= 0) & (cl >= model.classes)
                base = np.where(seen, np.log10(c + 1.0) - base_at, 0.0)
                f = np.maximum(form, 0)
                logp = logp + np.where(seen, np.where(
                    is_form, np.log10(np.maximum(c - d[f], 1e-9)) - emit_form[f], np.log10(np.maximum(c, 1)) - log_class[cl]), 0.0)
                if not model.n_tokens:
                    seen = np.where(h == END, False, seen)
                rows = b - a
                ids = part + done + np.arange(rows)
                done += rows
                sums = [np.bincount(row, weights=x, minlength=rows) for x in (np.ones(len(row)), seen, base, logp)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64()), pa.array(sums[0].astype(np.int64)),
                    pa.array(sums[1].astype(np.int64)), pa.array(sums[2]), pa.array(sums[3]),
                    pa.StructArray.from_arrays([x.cast(f.type) for x, f in zip(others.slice(a, rows).columns, others.schema)],
                                               fields=list(others.schema))],
                    ["id", "h", "form", "n", "known", "base", "logp", "row"])
                rare = np.flatnonzero(~seen)
                if len(rare):
                    # equal rare words of a row are one row here
                    order = rare[np.lexsort((h[rare], row[rare]))]
                    new = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])])
                    first = order[new]
                    times = np.diff(np.concatenate([np.flatnonzero(new), [len(order)]]))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ids[row[first]]), _signed(h[first]), pa.array(form[first]), pa.array(times),
                        pa.nulls(len(first), pa.int64()), pa.nulls(len(first), pa.float64()), pa.nulls(len(first), pa.float64()),
                        pa.nulls(len(first), pa.struct(list(others.schema)))],
                        ["id", "h", "form", "n", "known", "base", "logp", "row"])

    # a column that is never given back, as a struct needs one
    source = docs.select(*rest, F.lit(0).alias("_always"), F.coalesce("text", F.lit("")).alias("text"))
    kind = source.select(F.struct(*rest, "_always").alias("row")).schema["row"].dataType.simpleString()
    out = source.mapInArrow(run, f"id long, h long, form long, n long, known long, base double, logp double, row {kind}")
    out = stored(out)  # read twice below; the ids come from its tasks
    d, unknown = discounts(model.form_stats)
    table = lambda x: F.array(*[F.lit(float(v)) for v in x])
    size = float(np.log10(max(model.n_tokens + model.n_types + 1, 1)))
    rare = out.where(F.col("h").isNotNull()).select("id", "h", "form", "n").join(
        counts.select("h", F.col("c")), "h", "left")
    has = F.coalesce(F.col("c"), F.lit(0)).cast("double")
    f = F.greatest(F.col("form"), F.lit(0)).cast("int")
    emitted = F.when(F.col("form") < 0, 0.0).when(has > 0, F.log10(has - F.get(table(d), f)) - F.get(
        table(np.log10(np.maximum(model.form_stats[:, 0], 1))), f)).otherwise(F.get(table(unknown), f))
    rare = rare.select("id", (F.when(has > 0, F.col("n")).otherwise(0)).cast("long").alias("known"),
                       (F.col("n") * (F.log10(has + 1) - size)).alias("base"), (F.col("n") * emitted).alias("logp"))
    rows = out.where(F.col("h").isNull()).select("id", "n", "known", "base", "logp", "row").unionByName(
        rare, allowMissingColumns=True)
    rows = rows.groupBy("id").agg(F.max("n").alias("n_tokens"), F.sum("known").alias("n_known"), F.sum("base").alias("base_score"),
                                  F.sum("logp").alias("score"), F.first("row", ignorenulls=True).alias("row"))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in rest], "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score")


def score_documents(docs: DataFrame, is_train: Callable | None = None, **sizes) -> DataFrame:
    """Trains on the rows of ``docs`` (doc_id, text, ...) for which ``is_train`` (a Column) holds, scores all."""
    training = docs if is_train is None else docs.where(is_train)
    counts = stored(word_counts(training))
    return score(docs, counts, train(training, counts, **sizes))
