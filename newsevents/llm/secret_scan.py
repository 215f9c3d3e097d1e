"""Secrets in texts: fixed patterns, and strings that a tokenizer cannot shorten.

Text that people write costs a BPE vocabulary about four characters a token;
random strings cost about two. A run of key characters with letters and digits
whose characters per token stay below ``MAX_RATIO`` is reported as ``random``,
after known digests (by length) and identifiers (UUIDs, numbers, words joined
by dashes) are excluded. Plain words beside a random string raise the ratio of the run: where the whole
run passes, what is left without the plain pieces (between signs) at its ends is judged,
and each piece by itself. The fixed patterns find their spans first and keep
them; a random span never overlaps one of theirs, but what a run has beside them is judged.

Runs are found over whole Arrow buffers with numpy; regular expressions see
only the texts that hold one of their key words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from newsevents.llm.bpe import read_ranks
from newsevents.llm.common import arrow_map, batches, slices, text_buffer

KINDS = ("assign", "access", "hex", "random")
#: Shortest random string, and the characters per token below which it is one.
MIN_RANDOM, MAX_RATIO = 20, 2.5
MIN_HEX, MIN_VALUE = 24, 6

# The patterns of the contract.
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
KEY_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

# Lengths in hex digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512 digests.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
UUID = re.compile(rb"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
HEX = re.compile(rb"[0-9a-f]+|[0-9A-F]+")
PIECE, PLAIN = re.compile(rb"[A-Za-z0-9+]+"), re.compile(rb"[A-Za-z]{3,}|[0-9]{1,8}")
WORDS = re.compile(rb"(?:[A-Za-z]+|[0-9]{1,8})(?:[-_/=+](?:[A-Za-z]+|[0-9]{1,8}))*")


def _table(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars.encode())] = True
    return t


_DIGITS = "0123456789"
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_HEX = _table(_DIGITS + "abcdef")
_KEY = _table(_DIGITS + _LETTERS + _LETTERS.upper() + "+/_=-")


@lru_cache(2)
def _tokenizer(path: str):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})


def runs(mask: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true that are ``least`` long, none across a text's border."""
    n = len(mask)
    before, after = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    before[1:] = mask
    after[:n - 1] = mask[1:]
    before[offsets] = False
    after[offsets[offsets > 0] - 1] = False
    starts = np.flatnonzero(mask & ~before[:n])
    ends = np.flatnonzero(mask & ~after[:n]) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def is_known(s: bytes) -> bool:
    """A digest by its length, a UUID, a number, or words and short numbers joined by signs."""
    if UUID.fullmatch(s) or WORDS.fullmatch(s):
        return True
    return len(s) in DIGEST_LENGTHS and HEX.fullmatch(s) is not None


def is_random(s: bytes, tokenizer, max_ratio: float = MAX_RATIO) -> bool:
    if is_known(s) or not re.search(rb"[0-9]", s) or not re.search(rb"[A-Za-z]", s):
        return False
    return len(s) < max_ratio * len(tokenizer.encode_ordinary(s.decode()))


def random_parts(s: bytes, tokenizer, max_ratio: float = MAX_RATIO) -> list[tuple[int, int]]:
    """(start, end) of the random strings in a run of key characters."""
    if is_random(s, tokenizer, max_ratio):
        return [(0, len(s))]
    pieces = [(m.start(), m.end()) for m in PIECE.finditer(s)]
    # A piece is plain if it is a word or number, or a tokenizer can shorten it.
    plain = [PLAIN.fullmatch(s, a, z) is not None or z - a >= max_ratio * len(tokenizer.encode_ordinary(s[a:z].decode())) for a, z in pieces]
    odd = [i for i, p in enumerate(plain) if not p]
    if not odd:
        return []
    a, z = pieces[odd[0]][0], pieces[odd[-1]][1]
    if z - a >= MIN_RANDOM and is_random(s[a:z], tokenizer, max_ratio):
        return [(a, z)]
    return [(a, z) for a, z in pieces if z - a >= MIN_RANDOM and is_random(s[a:z], tokenizer, max_ratio)]


def beside(start: int, end: int, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """The parts of a run that no span (start, kind, end) covers."""
    for a, _, z in sorted(x for x in spans if x[0] < end and x[2] > start):
        if a > start:
            yield start, a
        start = max(start, z)
    if start < end:
        yield start, end


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the assign and access patterns, in bytes."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    return found + [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]


def scan_slice(buf: np.ndarray, offsets: np.ndarray, tokenizer, max_ratio: float) -> dict[int, list[tuple[int, int, int]]]:
    """Spans (start, kind, end) in bytes of each text that has some."""
    raw = buf.tobytes()
    found: dict[int, list] = {}
    # Texts with a key word.
    lower, rows = raw.lower(), set()
    for where, word in [(lower, w) for w in KEY_WORDS] + [(raw, b"AKIA")]:
        at = where.find(word)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, side="right")) - 1
            rows.add(row)
            at = where.find(word, int(offsets[row + 1]))  # on to the next text
    for row in rows:
        if spans := base_spans(raw[offsets[row]:offsets[row + 1]]):
            found[row] = spans
    for kind, table, least in ((2, _HEX, MIN_HEX), (3, _KEY, MIN_RANDOM)):
        starts, ends = runs(table.take(buf), offsets, least)
        for s, e, row in zip(starts.tolist(), ends.tolist(), (np.searchsorted(offsets, starts, side="right") - 1).tolist()):
            base = int(offsets[row])
            if kind == 2:
                found.setdefault(row, []).append((s - base, kind, e - base))
                continue
            fixed = [x for x in found.get(row, ()) if x[1] < 3]
            for a, z in beside(s - base, e - base, fixed):
                if z - a >= MIN_RANDOM:
                    for x, y in random_parts(raw[base + a:base + z], tokenizer, max_ratio):
                        found.setdefault(row, []).append((a + x, kind, a + y))
    return found


def in_code_points(text: np.ndarray, spans: list[tuple[int, int, int]]) -> list[dict]:
    """Sorted spans with offsets counted in code points."""
    before = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
    return [{"kind": KINDS[k], "start": int(before[s]), "end": int(before[e])} for s, k, e in sorted(spans)]


def find_secrets(docs: DataFrame, ranks_path: str, max_ratio: float = MAX_RATIO,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans array<struct<kind string, start int, end int>>`` of each text.

    Spans are sorted by start, then kind; offsets are code points, ends
    exclusive. One row per input row: null and empty texts have no spans, null
    ids stay null, repeated rows are repeated. Whole texts of any length are
    scanned. ``ranks_path`` must name the vocabulary on every executor.
    """
    kind = dict(docs.dtypes)[id_col]
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(it):
        tokenizer = _tokenizer(ranks_path)
        for b in batches(it):
            buf, off = text_buffer(b.column(1))
            out: list = [[] for _ in range(b.num_rows)]
            for i, j in slices(off):
                part, own = buf[off[i]:off[j]], off[i:j + 1] - off[i]
                if len(part):
                    for row, spans in scan_slice(part, own, tokenizer, max_ratio).items():
                        out[i + row] = in_code_points(part[own[row]:own[row + 1]], spans)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, spans_type)], ["doc_id", "spans"])

    return arrow_map(docs.select(id_col, text_col), run,
                     f"doc_id {kind}, spans array<struct<kind: string, start: int, end: int>>")
