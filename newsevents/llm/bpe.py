"""Byte-level BPE encoding and decoding without a regex engine.

Pre-tokenisation. Each code point gets one of sixteen symbols from its class
(letter, number, white space, other) and one to three code points of look-ahead.
A symbol is a transition function on eight states; functions compose
associatively, and the functions that the symbols generate form a small monoid,
so a composition is one look-up in a table. The scan cuts the symbols into
equal blocks, composes all blocks side by side, then the blocks' totals, and
reads the token starts off the state before each code point. Texts lie one after
the other in the scan: the first symbol of each resets the state.

Merging. A token's bytes are merged pair by pair, lowest rank first, once per
distinct token and worker: all new tokens of a slice together, one merge of each
per round. A bounded cache holds the ids of known tokens.

Decoding. A vocabulary is one byte string with offsets; the bytes of a list of
ids are gathered through them.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from newsevents.llm.common import arrow_map, batches, slices, text_buffer

#: Cached tokens per worker; the cache is emptied when full.
CACHE_TOKENS = 400_000
#: Block length of the scan.
BLOCK = 128

L, N, S, O = 0, 1, 2, 3  # noqa: E741
# Symbols: letter, number, other, apostrophe of a 2- or 3-character contraction,
# white space that more white space or the end follows, a space that something
# else follows, other white space that something else follows. Plus 8: the same
# as the first code point of a text.
SYM_L, SYM_N, SYM_O, SYM_A2, SYM_A3, SYM_W, SYM_SP, SYM_WS = range(8)
# States: nothing open, letters, numbers, others, a leading space, white space,
# one or two more characters of a contraction.
FREE, IN_L, IN_N, IN_O, LEAD, IN_W, C1, C2 = range(8)


def _step(state: int, sym: int) -> tuple[int, bool]:
    """Next state, and whether a token starts at this code point."""
    if sym == SYM_L:
        if state in (C1, C2):
            return (FREE if state == C1 else C1), False
        return IN_L, state not in (IN_L, LEAD)
    if sym == SYM_N:
        return IN_N, state not in (IN_N, LEAD)
    if sym in (SYM_O, SYM_A2, SYM_A3):
        if state in (IN_O, LEAD):
            return IN_O, False
        return (IN_O, C1, C2)[sym - SYM_O], True
    if sym == SYM_W:
        return IN_W, state != IN_W
    return (LEAD if sym == SYM_SP else FREE), True


@lru_cache(1)
def _monoid():
    """The functions that the symbols generate.

    Returns the index of each function followed by a symbol's (rows of 16), the
    functions as tables of states, and by ``state * 16 + symbol`` whether a token
    starts and the next state.
    """
    moves = [[_step(s, g % 8) if g < 8 else _step(FREE, g - 8) for s in range(8)] for g in range(16)]
    gens = [tuple(x for x, _ in m) for m in moves]
    fns, index, comp = [tuple(range(8))], {tuple(range(8)): 0}, []
    for f in fns:  # grows while it is read
        for g in gens:
            h = tuple(g[x] for x in f)
            if h not in index:
                index[h] = len(fns)
                fns.append(h)
            comp.append(index[h])
    starts = np.array([[m[s][1] or g >= 8 for g, m in enumerate(moves)] for s in range(8)])
    nexts = np.array([[m[s][0] for m in moves] for s in range(8)], np.int32)
    return np.array(comp, np.int32), np.array(fns, np.uint8), starts.ravel(), nexts.ravel()


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of every code point, from its Unicode category and White_Space property."""
    table = np.full(0x110000, O, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            table[cp] = L
        elif kind == "N":
            table[cp] = N
    # The code points with the White_Space property.
    for a, b in ((0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
                 (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)):
        table[a:b + 1] = S
    return table


def code_points(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of valid UTF-8 bytes and the byte offset of each."""
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    lead = buf[at]
    if len(at) == len(buf):
        return lead.astype(np.int32), at
    cp = lead.astype(np.int32)
    pad = np.concatenate([buf, np.zeros(3, np.uint8)])
    for low, high, mask, more in ((0xC0, 0xDF, 0x1F, 1), (0xE0, 0xEF, 0x0F, 2), (0xF0, 0xFF, 0x07, 3)):
        i = np.flatnonzero((lead >= low) & (lead <= high))
        if len(i):
            v = cp[i] & mask
            for k in range(1, more + 1):
                v = (v << 6) | (pad[at[i] + k] & 0x3F)
            cp[i] = v
    return cp, at


def _symbols(cp: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbol of each code point; ``first``: indices at which a text begins."""
    n = len(cp)
    cls = _classes().take(cp)
    sym = np.array([SYM_L, SYM_N, SYM_WS, SYM_O], np.uint8).take(cls)
    closed = np.zeros(n + 3, bool)  # a text begins here, or all texts have ended
    closed[first] = True
    closed[n:] = True
    space = np.flatnonzero(cls == S)
    if len(space):
        white = np.ones(n + 1, bool)
        np.equal(cls, S, out=white[:n])
        white[first] = True  # the end of a text before it counts as white space does
        sym[space] = np.where(white.take(space + 1), SYM_W, np.where(cp.take(space) == 0x20, SYM_SP, SYM_WS))
    quote = np.flatnonzero(cp == 0x27)
    if len(quote):
        ahead = np.concatenate([cp, [0, 0]])
        one = ahead[quote + 1] * ~closed[quote + 1]
        two = ahead[quote + 2] * ~closed[quote + 2] * (one > 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        sym[quote[short]] = SYM_A2
        sym[quote[long]] = SYM_A3
    sym[first] += 8
    return sym


def _scan(sym: np.ndarray) -> np.ndarray:
    """Whether a token starts at each symbol."""
    comp, apply, starts, nexts = _monoid()
    n = len(sym)
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint8)
    padded[:n] = sym
    el = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    # Each block's composition, all blocks side by side; ``comp`` holds rows of 16 generators.
    acc = np.zeros(blocks, np.int32)
    step = np.empty(blocks, np.int32)
    for j in range(BLOCK):
        np.multiply(acc, 16, out=step)
        step += el[j]
        comp.take(step, out=acc, mode="clip")
    # The blocks' totals one after the other, then the state before each symbol.
    carry = np.empty(blocks, np.uint8)
    state = FREE
    for b, f in enumerate(acc.tolist()):
        carry[b] = state
        state = int(apply[f, state])
    out = np.empty((BLOCK, blocks), bool)
    at, state = np.empty(blocks, np.int32), carry.astype(np.int32)
    for j in range(BLOCK):
        np.multiply(state, 16, out=at)
        at += el[j]
        starts.take(at, out=out[j], mode="clip")
        nexts.take(at, out=state, mode="clip")
    return np.ascontiguousarray(out.T).ravel()[:n]


def token_bounds(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte offsets at which the tokens of the texts in ``buf`` start.

    ``offsets`` (n + 1) are the texts' byte offsets in ``buf``.
    """
    cp, at = code_points(buf)
    if not len(cp):
        return np.zeros(0, np.int64)
    first = np.searchsorted(at, np.unique(offsets[:-1][np.diff(offsets) > 0]))
    return at[_scan(_symbols(cp, first))]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one token: the lowest-ranked neighbouring pair is merged until none is left (parts in a heap, n log n)."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    end = list(range(1, n + 1))
    prev = list(range(-1, n - 1))
    alive = [True] * n
    heap = []

    def offer(i):
        j = end[i]
        if j < n:
            r = ranks.get(piece[i:end[j]])
            if r is not None:
                heap.append((r, i, j, end[j])) if building else heapq.heappush(heap, (r, i, j, end[j]))

    building = True
    for i in range(n - 1):
        offer(i)
    heapq.heapify(heap)
    building = False
    while heap:
        _, i, j, e = heapq.heappop(heap)
        if not alive[i] or end[i] != j or not alive[j] or end[j] != e:
            continue
        alive[j] = False
        end[i] = e
        if e < n:
            prev[e] = i
        offer(i)
        if prev[i] >= 0:
            offer(prev[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class Table:
    """Open-addressed map from 64-bit keys to 32-bit values, filled and read by whole arrays."""

    def __init__(self, bits: int):
        self.bits, self.mask, self.size = bits, (1 << bits) - 1, 0
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.zeros(1 << bits, np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def insert(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add distinct keys that are not there yet."""
        self.size += len(keys)
        slot = self._slot(keys)
        while len(keys):
            empty = self.keys[slot] == -1
            self.keys[slot[empty]] = keys[empty]  # of several with one slot the last stays
            won = self.keys[slot] == keys
            self.values[slot[won]] = values[won]
            keys, values, slot = keys[~won], values[~won], (slot[~won] + 1) & self.mask

    def find(self, keys: np.ndarray, default: int) -> np.ndarray:
        out = np.full(len(keys), default, np.int32)
        slot = self._slot(keys)
        held = self.keys.take(slot)
        hit = held == keys
        out[hit] = self.values.take(slot[hit])
        todo = np.flatnonzero(~hit & (held != -1))
        slot = (slot[todo] + 1) & self.mask
        while len(todo):
            held, want = self.keys.take(slot), keys[todo]
            hit = held == want
            out[todo[hit]] = self.values.take(slot[hit])
            go = ~hit & (held != -1)
            todo, slot = todo[go], (slot[go] + 1) & self.mask
        return out


class Pairs:
    """Rank of the token that two neighbouring tokens make."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for piece, rank in ranks.items():
            for i in range(1, len(piece)):
                a, b = ranks.get(piece[:i]), ranks.get(piece[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        self.table = Table(max(16, int(len(keys) * 4).bit_length()))
        self.table.insert(np.array(keys, np.int64), np.array(values, np.int32))
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.table.find(a.astype(np.int64) << 32 | b, NONE)


#: Rank of a pair that makes no token.
NONE = np.iinfo(np.int32).max


def merge_many(data: np.ndarray, size: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many tokens at once: each round merges the best pair of each token.

    ``data``: the tokens' bytes one after the other, ``size``: their lengths (1 at
    least). Returns the ids one after the other, and how many each token has.
    """
    ids = pairs.byte_ids[data]
    word = np.arange(len(size))
    rank = np.full(len(ids), NONE, np.int32)
    starts = np.cumsum(size) - size
    inner = np.ones(len(ids), bool)
    inner[starts + size - 1] = False
    at = np.flatnonzero(inner)
    rank[at] = pairs.rank(ids[at], ids[at + 1])
    count = np.zeros(len(size), np.int64)
    ended: list[tuple[np.ndarray, np.ndarray]] = []
    while len(word):
        best = np.minimum.reduceat(rank, starts)
        done = best == NONE
        if done.any():
            count[word[done]] = size[done]
            gone = np.repeat(done, size)
            ended.append((np.repeat(word[done], size[done]), ids[gone]))
            live = ~done
            ids, rank, word, size, best = ids[~gone], rank[~gone], word[live], size[live], best[live]
            if not len(word):
                break
            starts = np.cumsum(size) - size
        hits = np.flatnonzero(rank == np.repeat(best, size))
        owner = np.searchsorted(starts, hits, side="right")
        first = np.ones(len(hits), bool)
        first[1:] = owner[1:] != owner[:-1]
        at = hits[first]  # the leftmost best pair of each token
        ids[at] = rank[at]
        stay = np.ones(len(ids), bool)
        stay[at + 1] = False
        ids, rank = ids[stay], rank[stay]
        at = at - np.arange(len(at))  # each earlier token has lost one part
        size = size - 1
        starts = np.cumsum(size) - size
        rank[at] = NONE
        right = at[at + 1 < starts + size]
        rank[right] = pairs.rank(ids[right], ids[right + 1])
        left = at[at > starts] - 1
        rank[left] = pairs.rank(ids[left], ids[left + 1])
    if not ended:
        return np.zeros(0, np.int32), count
    owner = np.concatenate([w for w, _ in ended])
    return np.concatenate([i for _, i in ended])[np.argsort(owner, kind="stable")], count


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


_ODD = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_ODD, -1, 1 << 64)
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256).astype(np.uint64)


@lru_cache(1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(1 << bits, _ODD, np.uint64), np.full(1 << bits, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def token_keys(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each token, from one running sum over the bytes."""
    up, down = _powers(max(20, int(len(buf)).bit_length()))
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE.take(buf) * up[:len(buf)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h.view(np.int64) & np.int64((1 << 62) - 1)


class Encoder:
    """Encodes texts; keeps the ids of at most ``cached`` distinct tokens by their hash.

    Two tokens with one hash would encode as the same: each slice is decoded
    again, and one that does not come out as it went in is encoded token by token.
    """

    cached = CACHE_TOKENS

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.pairs = ranks, Pairs(ranks)
        self.vocabulary = vocabulary(ranks)
        self._clear()

    def _clear(self) -> None:
        self.known = Table(int(self.cached * 2).bit_length())
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _alone(self, token: bytes) -> list[int]:
        """Ids of one token."""
        return merge(token, self.ranks)

    def _merged(self, buf: np.ndarray, keys: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of new tokens in the order of their ids, all ids, and how many each token has."""
        long = size >= 48
        data = buf[spread(starts[~long], size[~long])]
        ids, count = merge_many(data, size[~long], self.pairs)
        for k in np.flatnonzero(long).tolist():
            own = self._alone(buf[starts[k]:starts[k] + size[k]].tobytes())
            ids, count = np.concatenate([ids, np.array(own, np.int32)]), np.append(count, len(own))
        return np.concatenate([keys[~long], keys[long]]), ids, count

    def _learn(self, buf: np.ndarray, keys: np.ndarray, starts: np.ndarray, size: np.ndarray) -> None:
        keys, ids, count = self._merged(buf, keys, starts, size)
        self.known.insert(keys, np.arange(len(self.start), len(self.start) + len(keys), dtype=np.int32))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in ``buf``, how many each text has, and the tokens' byte offsets."""
        starts = token_bounds(buf, offsets)
        ends = np.append(starts[1:], len(buf)) if len(starts) else starts
        keys, first, inverse = np.unique(token_keys(buf, starts, ends), return_index=True, return_inverse=True)
        at = self.known.find(keys, -1)
        if (new := np.flatnonzero(at < 0)).size:
            if self.known.size + len(new) > self.cached:
                self._clear()
                new = np.arange(len(keys))
            self._learn(buf, keys[new], starts[first[new]], (ends - starts)[first[new]])
            at = self.known.find(keys, -1)
        which = at[inverse]
        count = self.count[which]
        ids = self.ids[spread(self.start[which], count)]
        if not np.array_equal(decode_ids(ids, self.vocabulary), buf):
            own = [self._alone(buf[s:e].tobytes()) for s, e in zip(starts.tolist(), ends.tolist())]
            count = np.array([len(x) for x in own])
            ids = np.array([i for x in own for i in x], np.int32)
        rows = np.searchsorted(starts, offsets)
        total = np.concatenate([[0], np.cumsum(count)])
        return ids, np.diff(total[rows]), starts


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a tiktoken file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def vocabulary(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """All tokens' bytes one after the other, by id, and their offsets."""
    by_id = {i: b for b, i in ranks.items()}
    parts = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(read_ranks(path))


def encode_batch(buf: np.ndarray, offsets: np.ndarray, coder: Encoder) -> list[bytes]:
    """The ids of each text, as little-endian unsigned 32-bit integers."""
    out: list[bytes] = []
    for i, j in slices(offsets):
        a, b = int(offsets[i]), int(offsets[j])
        ids, count, _ = coder.encode(buf[a:b], offsets[i:j + 1] - a)
        raw = ids.astype("<u4").tobytes()
        cuts = np.concatenate([[0], np.cumsum(count) * 4]).tolist()
        out += [raw[x:y] for x, y in zip(cuts, cuts[1:])]
    return out


def decode_ids(ids: np.ndarray, vocabulary: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The bytes that the ids stand for."""
    data, off = vocabulary
    return data[spread(off[ids], off[ids + 1] - off[ids])]


def decode_batch(buf: np.ndarray, offsets: np.ndarray, words: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
    """The bytes of each text from its ids (little-endian unsigned 32-bit, at ``offsets`` of ``buf``)."""
    out: list[bytes] = []
    for i, j in slices(offsets):
        ids = np.frombuffer(buf[offsets[i]:offsets[j]].tobytes(), "<u4").astype(np.int64)
        raw = decode_ids(ids, words).tobytes()
        # Where the texts lie in the decoded bytes, from the sizes of their tokens.
        size = np.concatenate([[0], np.cumsum(words[1][ids + 1] - words[1][ids])])
        cut = size[(offsets[i:j + 1] - offsets[i]) // 4].tolist()
        out += [raw[x:y] for x, y in zip(cut, cut[1:])]
    return out


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """Encode each text: ``doc_id, n_tokens long, ids binary`` (little-endian unsigned 32-bit).

    ``decoded`` adds ``decoded binary``, what the ids stand for, as ``decode``
    does, in the same pass. One row per input row, in no order. A null text
    counts as empty; an empty text has no ids. A null id stays null and repeated
    rows are repeated. Texts of any length are encoded whole. Special-token
    strings are ordinary text. ``ranks_path`` must name the file on every
    executor.
    """
    kind = dict(docs.dtypes)[id_col]
    names = ["doc_id", "n_tokens", "ids"] + ["decoded"] * decoded

    def run(it):
        coder = encoder(ranks_path)
        for b in batches(it):
            ids = encode_batch(*text_buffer(b.column(1)), coder)
            cols = [b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            if decoded:
                cols.append(pa.array(decode_batch(*text_buffer(cols[2]), coder.vocabulary), pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names)

    return arrow_map(docs.select(id_col, text_col), run, f"doc_id {kind}, n_tokens long, ids binary" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Decode what ``encode`` returns: its columns and ``decoded binary`` (null ids: no bytes)."""
    kind = dict(encoded.dtypes)["doc_id"]

    def run(it):
        words = encoder(ranks_path).vocabulary
        for b in batches(it):
            out = pa.array(decode_batch(*text_buffer(b.column(2)), words), pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], out], ["doc_id", "n_tokens", "ids", "decoded"])

    return arrow_map(encoded.select("doc_id", "n_tokens", "ids"), run,
                     f"doc_id {kind}, n_tokens long, ids binary, decoded binary")
