"""Operator 3: token counts by dynamic programming over a trie of pre-tokens.

Texts are cut into pre-tokens (a run of non-space characters with the one space before it, or a single
space character), so every character belongs to one. A pre-token's tokens are its best segmentation under a
unigram model: the highest sum of scores, then the fewest tokens. The distinct pre-tokens of a stretch of rows
form a trie; walked in sorted order, each node's forward score (best score and token count of its prefix) is
computed once for all pre-tokens below it, and terminal nodes store their count. Counts of
earlier stretches are kept in a bounded table, which only saves work.

Vocabulary: byte pieces with ranks, from a public tokenizer's file whose path is a parameter; the score
of rank r is -log(r + 1) - 1, a Zipf prior (nothing is trained). All 256 bytes are pieces, so every text has a segmentation.

Defined results: null or empty text has 0 pre-tokens and 0 tokens; an empty table gives no rows; columns of the
input with names made here are replaced.
"""

from __future__ import annotations

import base64
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MADE = ["n_pretokens", "n_tokens"]
PRETOKEN = re.compile(r" ?\S+|\s")
#: Characters of text per trie, and pre-tokens kept from earlier ones.
STRETCH, KEPT = 1 << 21, 300_000


def load_vocabulary(path: str = VOCABULARY) -> dict[bytes, float]:
    """Scores of the pieces in a file of lines "base64 rank"."""
    with open(path, "rb") as f:
        pieces = (line.split() for line in f if line.strip())
        scores = {base64.b64decode(a): -math.log(int(b) + 1) - 1 for a, b in pieces}
    lowest = min(scores.values(), default=0.0) - 1
    for b in range(256):
        scores.setdefault(bytes([b]), lowest)
    return scores


class TrieCounter:
    def __init__(self, scores: dict[bytes, float]):
        self.scores = scores
        # reading backwards from a position may stop once no piece ends in what was read
        self.endings = {p[i:] for p in scores for i in range(len(p))}
        self.known: dict[str, int] = {}

    def count_all(self, pretokens: Iterable[str]) -> dict[str, int]:
        """Token counts of distinct pre-tokens: a walk over their trie in sorted order."""
        out, scores, endings = {}, self.scores, self.endings
        before, best, fewest = b"", [0.0], [0]  # forward scores and counts along the path to the current node
        for word, text in sorted((t.encode("utf-8", "surrogatepass"), t) for t in pretokens):
            same = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                same += 1
            del best[same + 1:], fewest[same + 1:]
            for j in range(same + 1, len(word) + 1):
                top, count, i = -math.inf, 0, j - 1
                while i >= 0 and (piece := word[i:j]) in endings:
                    s = scores.get(piece)
                    if s is not None:
                        s += best[i]
                        if s > top or s == top and fewest[i] + 1 < count:
                            top, count = s, fewest[i] + 1
                    i -= 1
                best.append(top)
                fewest.append(count)
            before = word
            out[text] = fewest[-1]
        return out

    def count_texts(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """(pre-tokens, tokens) of each text."""
        cut = [PRETOKEN.findall(t) if t else [] for t in texts]
        if len(self.known) > KEPT:
            self.known = {}
        new = set().union(*cut).difference(self.known) if cut else set()
        known = self.known | self.count_all(new) if len(new) > KEPT else self.known
        if known is self.known:
            known.update(self.count_all(new))
        return [(len(c), sum(map(known.__getitem__, c))) for c in cut]


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` (text, any other columns) with n_pretokens and n_tokens; the text is left behind."""
    rest = [c for c in docs.columns if c not in (*MADE, "text")]
    scores = docs.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TrieCounter(scores.value)
        for batch in batches:
            counts, stretch, size = [], [], 0
            for t in batch.column("text"):
                stretch.append(t.as_py())
                size += len(stretch[-1] or "")
                if size > STRETCH:
                    counts += counter.count_texts(stretch)
                    stretch, size = [], 0
            counts += counter.count_texts(stretch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in rest] + [pa.array([c[k] for c in counts], pa.int64()) for k in (0, 1)], [*rest, *MADE])

    rows = docs.select(*rest, "text")
    return rows.mapInArrow(run, rows.select(*rest).schema.add("n_pretokens", "long").add("n_tokens", "long"))
