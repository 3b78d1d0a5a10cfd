"""Sharded minimal perfect hashes over (language, term) keys that keep their keys.

A shard of n keys has exactly n slots. Its keys fall into buckets; the fullest bucket first, each gets the first seed
that sends all its keys to free slots, and buckets of one key name a free slot outright. A lookup computes one slot
and compares language and term with the key stored there, so a key that is not in the set is never taken for one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from shoplens.llm.common import mix64

#: A slot's id is its shard's number times this, plus its place; keys a bucket holds on average; seeds tried at a time and in all.
SLOT_BITS, BUCKET, TRIES, MOST_TRIES = 20, 3, 256, 1 << 22
_STEP = np.uint64(0x9E3779B97F4A7C15)


def digests(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each key."""
    h = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), ">u8").reshape(-1, 2).astype(np.uint64)
    return h[:, 0], h[:, 1]


def paired(lang: tuple[np.ndarray, np.ndarray], term: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of (language, term) from those of both."""
    return mix64(lang[0] * _STEP + term[0]), mix64(lang[1] * _STEP + term[1])


def _slots(h: np.ndarray, seed: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    return (mix64(h + (seed.astype(np.uint64) + np.uint64(1)) * _STEP) % np.asarray(n, np.uint64)).astype(np.int64)


def buckets_of(n: np.ndarray | int) -> np.ndarray | int:
    return n // BUCKET + 1


def build(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slot of each key, each bucket's seed, or -1 - slot for a bucket of one key)."""
    n = len(h1)
    if n > 1 << SLOT_BITS:
        raise ValueError(f"a shard of {n} keys: more shards are needed")
    bucket = (h1 % np.uint64(buckets_of(n))).astype(np.int64)
    size = np.bincount(bucket, minlength=buckets_of(n))
    order = np.argsort(bucket, kind="stable")
    start = np.concatenate([[0], np.cumsum(size)])
    slot, how, free = np.full(n, -1), np.zeros(len(size), np.int32), np.ones(n, bool)
    for b in np.argsort(-size, kind="stable"):
        if size[b] < 2:
            break
        own = order[start[b]:start[b + 1]]
        for first in range(0, MOST_TRIES, TRIES):
            seeds = np.arange(first, first + TRIES)
            at = _slots(h2[own][None, :], seeds[:, None], n)
            near = np.sort(at, axis=1)
            fits = np.flatnonzero(free[at].all(axis=1) & (near[:, 1:] != near[:, :-1]).all(axis=1))
            if len(fits):
                slot[own], how[b] = at[fits[0]], seeds[fits[0]]
                free[at[fits[0]]] = False
                break
        else:
            raise ValueError("two keys of a shard have equal 128-bit hashes")
    single = np.flatnonzero(size == 1)
    own, left = order[start[single]], np.flatnonzero(free)
    slot[own], how[single] = left, -1 - left
    return slot, how


class Hashes:
    """All shards together: the slots of shard s are numbered from ``base[s]``."""

    def __init__(self, sizes: np.ndarray, how: np.ndarray, langs: list[str], lang_of: np.ndarray, keys: pa.Array):
        self.sizes, self.how, self.lang_of, self.keys = sizes, how, lang_of, keys
        self.base = np.concatenate([[0], np.cumsum(sizes)])
        self.first_bucket = np.concatenate([[0], np.cumsum(buckets_of(sizes))])
        self.shard = np.repeat(np.arange(len(sizes)), sizes)
        self.ids = (self.shard.astype(np.int64) << SLOT_BITS) + np.arange(len(self.shard)) - self.base[self.shard]
        self.langs = {x: i for i, x in enumerate(langs)}
        self.lang_hash = digests([x.encode() for x in langs])
        self.own = [np.flatnonzero(lang_of == i) for i in range(len(langs))]  # a language's slots
        self.place = np.zeros(len(lang_of), np.int64)  # a slot's place among those of its language
        for slots in self.own:
            self.place[slots] = np.arange(len(slots))

    def find(self, lang: np.ndarray, h: tuple[np.ndarray, np.ndarray], terms: pa.Array) -> np.ndarray:
        """Slot of each (number of the language, term) with the term's hashes ``h``; -1 for keys that are not stored."""
        if not len(self.keys) or not len(lang):
            return np.full(len(lang), -1)
        h1, h2 = paired((self.lang_hash[0][lang], self.lang_hash[1][lang]), h)
        shard = shard_of(h1, len(self.sizes))
        n = self.sizes[shard]
        bucket = (h1 % buckets_of(n).astype(np.uint64)).astype(np.int64)
        how = self.how[np.minimum(self.first_bucket[shard] + bucket, len(self.how) - 1)]
        at = np.where(how < 0, -1 - how, _slots(h2, np.maximum(how, 0), np.maximum(n, 1)))
        slot = np.where(n > 0, self.base[shard] + at, 0)
        same = pc.equal(self.keys.take(pa.array(slot)), terms).to_numpy(zero_copy_only=False)
        return np.where(same & (n > 0) & (self.lang_of[slot] == lang), slot, -1)


def shard_of(h1: np.ndarray, shards: int) -> np.ndarray:
    return ((h1 >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
