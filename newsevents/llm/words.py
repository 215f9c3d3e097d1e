"""Words of many texts at once: spans in the Arrow buffer, hashed character n-grams, cached rows per word."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from newsevents.llm.bpe import Table, spread, token_keys

#: Stretches that a long text gives to a training sample.
PIECES = 8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def char_table(extra: bytes = b"") -> np.ndarray:
    """Byte is part of a word: ASCII letters, all bytes of other code points, ``extra``."""
    t = np.zeros(256, bool)
    t[65:91] = t[97:123] = t[128:] = True
    t[list(extra)] = True
    return t


def has_words(text: Column, extra: str = "") -> Column:
    """A text holds a word by ``char_table(extra)``."""
    return F.coalesce(text.rlike(rf"[A-Za-z{extra}]|[^\x00-\x7F]"), F.lit(False))


def sample_text(text: Column, chars: int, extra: str = "") -> Column:
    """A text of at most ``chars`` characters as it is; of a longer one ``PIECES`` stretches, spread evenly over the whole of it.

    What is in no word is one blank there, so that each stretch has words; the bound on a sample's
    size then leaves no text out for its length.
    """
    words = F.trim(F.regexp_replace(text, rf"(?:(?![^\x00-\x7F])[^A-Za-z{extra}])++", " "))
    width = chars // PIECES
    pieces = F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)),
                         lambda i: F.substring(words, (F.lit(1) + F.floor(i * F.greatest(F.length(words) - width, F.lit(0)) / (PIECES - 1))).cast("int"), F.lit(width)))
    return F.when(F.length(text) <= chars, text).when(F.length(words) <= chars, words).otherwise(F.array_join(pieces, " "))


def word_spans(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ASCII-lower-cased bytes, and starts and ends of the words; no word crosses a text's border."""
    mask = table.take(buf)
    n = len(mask)
    before, after = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    before[1:] = mask
    after[:max(n - 1, 0)] = mask[1:]
    before[offsets] = False
    after[offsets[offsets > 0] - 1] = False
    return _LOWER.take(buf), np.flatnonzero(mask & ~before[:n]), np.flatnonzero(mask & ~after[:n]) + 1


def grams(data: np.ndarray, size: np.ndarray, low: int, high: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every n-gram of ``<word>``, ``low`` to ``high`` bytes long, over words given as bytes and sizes."""
    n = len(size)
    marked = np.empty(len(data) + 2 * n, np.uint64)
    ends = np.cumsum(size + 2)
    starts = ends - size - 2
    marked[starts] = ord("<")
    marked[ends - 1] = ord(">")
    marked[spread(starts + 1, size)] = data
    left = np.repeat(ends, size + 2) - np.arange(len(marked))  # bytes up to the word's end
    owner = np.repeat(np.arange(n, dtype=np.int32), size + 2)
    h = np.zeros(len(marked), np.uint64)
    out_w, out_g = [], []
    for k in range(1, high + 1):
        h = h[:len(marked) - k + 1] * np.uint64(0x100000001B3) + marked[k - 1:]
        if k >= low:
            ok = np.flatnonzero(left[:len(h)] >= k)
            g = h[ok] + np.uint64(k)
            g ^= g >> np.uint64(31)
            g *= np.uint64(0x9E3779B97F4A7C15)
            out_w.append(owner[ok])
            out_g.append((g >> np.uint64(33)).astype(np.int32) % np.int32(buckets))
    return np.concatenate(out_w), np.concatenate(out_g)


class Bags:
    """Rows of a parameter table averaged per group, and the gradient back to the rows."""

    def __init__(self, group: np.ndarray, item: np.ndarray, n_groups: int, n_items: int):
        group, item = group.astype(np.int32), item.astype(np.int32)  # a bounded sample: half the memory
        self.item = item[np.argsort(group, kind="stable")]
        count = np.bincount(group, minlength=n_groups)
        self.some = np.flatnonzero(count)
        self.count, self.at = count[self.some], (np.cumsum(count) - count)[self.some]
        back = np.argsort(item, kind="stable")
        self.back_group = group[back]
        n = np.bincount(item, minlength=n_items)
        self.rows = np.flatnonzero(n)
        self.back_at = (np.cumsum(n) - n)[self.rows]
        self.weight = np.zeros(n_groups, np.float32)
        self.weight[self.some] = 1.0 / self.count
        self.shape = n_groups, n_items

    def mean(self, table: np.ndarray) -> np.ndarray:
        out = np.zeros((self.shape[0], table.shape[1]), np.float32)
        if len(self.item):
            out[self.some] = np.add.reduceat(table[self.item], self.at) / self.count[:, None]
        return out

    def gradient(self, grad: np.ndarray) -> np.ndarray:
        out = np.zeros((self.shape[1], grad.shape[1]), np.float32)
        if len(self.item):
            out[self.rows] = np.add.reduceat((grad * self.weight[:, None])[self.back_group], self.back_at)
        return out


class Adam:
    """Adam steps on a list of parameter arrays, in place."""

    def __init__(self, params: list[np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = [np.zeros_like(p) for p in params]
        self.v = [np.zeros_like(p) for p in params]

    def step(self, grads: list[np.ndarray]) -> None:
        self.t += 1
        for p, g, m, v in zip(self.params, grads, self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.99 ** self.t)) + 1e-8)


class WordCache:
    """A row of numbers for each distinct word, computed once; at most ``limit`` words are held."""

    def __init__(self, compute: Callable[[np.ndarray, np.ndarray], np.ndarray], width: int, limit: int = 400_000):
        self.compute, self.width, self.limit = compute, width, limit
        self._clear()

    def _clear(self) -> None:
        self.known = Table(int(self.limit * 2).bit_length())
        self.values = np.zeros((0, self.width), np.float32)

    def rows(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """``width`` numbers for each word."""
        if not len(starts):
            return np.zeros((0, self.width), np.float32)
        keys, first, inverse = np.unique(token_keys(buf, starts, ends), return_index=True, return_inverse=True)
        at = self.known.find(keys, -1)
        if (new := np.flatnonzero(at < 0)).size:
            if self.known.size + len(new) > self.limit:
                self._clear()
                new = np.arange(len(keys))
            s, size = starts[first[new]], (ends - starts)[first[new]]
            self.known.insert(keys[new], np.arange(len(self.values), len(self.values) + len(new), dtype=np.int32))
            self.values = np.concatenate([self.values, self.compute(buf[spread(s, size)], size)])
            at = self.known.find(keys, -1)
        return self.values[at][inverse]
