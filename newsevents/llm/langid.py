"""Language of each word and text by a linear-chain conditional random field.

A word's score for each language is the average weight of its features: hashed
character n-grams, affixes (prefixes and suffixes of two to four bytes, marked
apart) and, if training has seen the word, its lexicon entry. Neighbouring words
are tied by learned transitions. Training maximises the likelihood of label
sequences (Adam on the exact gradient from forward-backward); sequences are cut
from labelled texts and joined across languages, so that switches are learnt
too. Prediction runs forward-backward over chains of at most ``CHAIN`` words
and sums the words' posteriors into the text's language.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsevents.llm.bpe import Table, spread, token_keys
from newsevents.llm.common import arrow_map, batches, slices, text_buffer
from newsevents.llm.toxicity import held_out
from newsevents.llm.words import Adam, Bags, WordCache, char_table, grams, has_words, sample_text, word_spans

#: Bounds of the training sample: rows per language, rows in all, characters of one (a longer text gives stretches of that many in all).
SAMPLE_ROWS, SAMPLE_TOTAL, SAMPLE_CHARS = 300, 6_000, 6_000
SAMPLE_PARTS = 64
#: Training sequences and their length, longest chain at prediction.
SEQUENCES, LENGTH, CHAIN = 1_500, 48, 128
BUCKETS, STEPS, RATE = 1 << 16, 40, 0.1
LETTERS = char_table()


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # BUCKETS n-grams, then as many affixes, by language
    lexicon_keys: np.ndarray
    lexicon: np.ndarray
    transitions: np.ndarray
    start: np.ndarray


def features(data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, feature) of words given as bytes and sizes: n-grams of 1 to 4 bytes, then affixes."""
    owner, gram = grams(data, size, 1, 4, BUCKETS)
    ends = np.cumsum(size)
    more = [(owner, gram)]
    for k in (2, 3, 4):
        at = np.flatnonzero(size >= k)
        for side, base in ((0, ends[at] - size[at]), (1, ends[at] - k)):
            h = np.full(len(at), 17 * k + side, np.uint64)
            for i in range(k):
                h = h * np.uint64(0x100000001B3) + data[base + i]
            h *= np.uint64(0x9E3779B97F4A7C15)
            more.append((at, BUCKETS + (h >> np.uint64(33)).astype(np.int64) % BUCKETS))
    return np.concatenate([o for o, _ in more]), np.concatenate([g for _, g in more])


def forward_backward(unary: np.ndarray, transitions: np.ndarray, start: np.ndarray, length: np.ndarray):
    """Posteriors [chain, place, label] and expected transitions of chains sorted longest first.

    ``unary`` [chain, place, label] holds scores; places beyond a chain's length are not read.
    """
    n, t_max, k = unary.shape
    live = np.searchsorted(-length, -np.arange(t_max), side="left")  # chains longer than t
    e = np.exp(unary - unary.max(2, keepdims=True))
    a = np.exp(transitions - transitions.max())
    alpha, beta = np.zeros_like(e), np.ones_like(e)
    x = e[:, 0] * np.exp(start - start.max())
    alpha[:, 0] = x / x.sum(1, keepdims=True)
    for t in range(1, t_max):
        m = live[t]
        x = (alpha[:m, t - 1] @ a) * e[:m, t]
        alpha[:m, t] = x / x.sum(1, keepdims=True)
    pairs = np.zeros((k, k))
    for t in range(t_max - 2, -1, -1):
        m = live[t + 1]
        x = e[:m, t + 1] * beta[:m, t + 1]
        y = x @ a.T
        norm = (alpha[:m, t] * y).sum(1, keepdims=True)
        beta[:m, t] = y / y.sum(1, keepdims=True)
        pairs += (alpha[:m, t] / norm).T @ x * a
    post = alpha * beta
    total = post.sum(2, keepdims=True)
    return post / np.where(total > 0, total, 1), pairs


def train(texts: list[bytes], label: np.ndarray, langs: list[str], steps: int = STEPS, seed: int = 5) -> Model | None:
    """Fit the field on whole texts of known language; None without words."""
    buf = np.frombuffer(b"".join(texts), np.uint8)
    off = np.cumsum([0] + [len(t) for t in texts])
    low, starts, ends = word_spans(buf, off, LETTERS)
    if not len(starts):
        return None
    rows = np.searchsorted(off, starts, side="right") - 1
    k = len(langs)
    keys, first, word = np.unique(token_keys(low, starts, ends), return_index=True, return_inverse=True)
    # Sequences: runs of words of random texts, joined until LENGTH words are there.
    rng = np.random.default_rng(seed)
    begin, end = np.searchsorted(rows, np.arange(len(texts))), np.searchsorted(rows, np.arange(len(texts)), side="right")
    by_label = [np.flatnonzero((label == i) & (end > begin)) for i in range(k)]
    known = [i for i in range(k) if len(by_label[i])]
    seq, tags = np.zeros((SEQUENCES, LENGTH), np.int64), np.zeros((SEQUENCES, LENGTH), np.int64)
    for s in range(SEQUENCES):
        at = 0
        while at < LENGTH:
            lang = known[rng.integers(len(known))]
            text = rng.choice(by_label[lang])
            n = min(LENGTH - at, int(rng.integers(6, LENGTH + 1)), int(end[text] - begin[text]))
            a = rng.integers(begin[text], end[text] - n + 1)
            seq[s, at:at + n] = word[a:a + n]
            tags[s, at:at + n] = lang
            at += n
    used, seq_word = np.unique(seq, return_inverse=True)
    seq_word = seq_word.reshape(seq.shape)
    s0, size = starts[first[used]], (ends - starts)[first[used]]
    owner, feat = features(low[spread(s0, size)], size)
    seen, feat = np.unique(feat, return_inverse=True)
    bags = Bags(owner, feat, len(used), len(seen))
    # Lexicon: how often each word's texts are of each language, as centred logs.
    counts = np.zeros((len(keys), k), np.float32)
    np.add.at(counts, (word, label[rows]), 1)
    logs = np.log((counts + 0.5) / (counts.sum(0) + 0.5 * len(keys)))
    lexicon = logs - logs.mean(1, keepdims=True)
    lexicon[counts.sum(1) < 2] = 0  # a word seen once says nothing that its n-grams don't
    weights = np.zeros((len(seen), k), np.float32)
    scale = np.full(1, 0.2, np.float32)  # weight of the lexicon
    trans, start = np.zeros((k, k), np.float32), np.zeros(k, np.float32)
    adam = Adam([weights, scale, trans, start], RATE)
    gold_pairs = np.zeros((k, k))
    np.add.at(gold_pairs, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
    gold_start = np.bincount(tags[:, 0], minlength=k)
    onehot = np.eye(k, dtype=np.float32)[tags]
    length = np.full(SEQUENCES, LENGTH)
    lex = lexicon[used]
    total = SEQUENCES * LENGTH
    for _ in range(steps):
        unary = (bags.mean(weights) + scale * lex)[seq_word]
        post, pairs = forward_backward(unary, trans, start, length)
        g = ((post - onehot) / total).astype(np.float32)
        by_word = np.zeros((len(used), k), np.float32)
        for c in range(k):
            by_word[:, c] = np.bincount(seq_word.ravel(), g[:, :, c].ravel(), len(used))
        adam.step([bags.gradient(by_word) + 1e-6 * weights, np.array([(by_word * lex).sum()], np.float32),
                   ((pairs - gold_pairs) / total).astype(np.float32) + 1e-4 * trans,
                   ((post[:, 0].sum(0) - gold_start) / SEQUENCES).astype(np.float32)])
    full = np.zeros((2 * BUCKETS, k), np.float32)
    full[seen] = weights
    some = np.flatnonzero(np.abs(lexicon).sum(1) > 0)
    return Model(langs, full, keys[some], (scale * lexicon[some]).astype(np.float32), trans, start)


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_total: int = SAMPLE_TOTAL,
        sample_chars: int = SAMPLE_CHARS) -> Model | None:
    """Train on at most ``sample_rows`` texts of each language (``sample_total`` in all) that are not held out.

    Rows with a null id or language, and texts without a word, take no part. Texts of at most
    ``sample_chars`` are taken first and whole; a longer one gives stretches from all over it
    (``sample_text``), so the sample has a fixed bound and no language is left out for the length of its texts.
    """
    usable = (docs.select("doc_id", "lang", "text").where("doc_id is not null and lang is not null").where(~held_out("doc_id"))
              .where(has_words(F.col("text"))))
    n_langs = usable.select("lang").distinct().count()
    if not n_langs:
        return None
    each = max(1, min(sample_rows, sample_total // n_langs))
    some = usable.select("doc_id", "lang", (F.length("text") > sample_chars).alias("long"), F.xxhash64("text").alias("version"))
    some = some.withColumn("_part", F.pmod(F.xxhash64("doc_id", "version"), F.lit(SAMPLE_PARTS)))
    # A language may be a third of all rows: its first rows are taken by parts, then of those.
    for keys in (["lang", "_part"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy("long", F.xxhash64("doc_id"), "doc_id", "version")
        some = some.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= each)
    # At most sample_total rows (or one a language).
    some = some.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), "version").distinct()
    rows = (usable.join(F.broadcast(some), (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")) & (F.xxhash64("text") == F.col("version")))
            .select("doc_id", "lang", sample_text(F.col("text"), sample_chars).alias("text")).limit(max(sample_total, n_langs)).collect())
    rows.sort(key=lambda r: (r.doc_id, r.text))
    langs = sorted({r.lang for r in rows})
    return train([r.text.encode() for r in rows], np.array([langs.index(r.lang) for r in rows]), langs) if rows else None


def has_letter(raw: bytes) -> bool:
    return any(c.isalpha() for c in raw.decode("utf-8", "replace"))


class Tagger:
    """Posteriors of the words of many texts."""

    def __init__(self, model: Model):
        self.model = model
        self.lexicon = Table(max(8, int(len(model.lexicon_keys) * 2).bit_length()))
        self.lexicon.insert(model.lexicon_keys, np.arange(len(model.lexicon_keys), dtype=np.int32))
        self.cache = WordCache(self._scores, len(model.langs))

    def _scores(self, data: np.ndarray, size: np.ndarray) -> np.ndarray:
        owner, feat = features(data, size)
        w, k = self.model.weights, len(self.model.langs)
        n = np.bincount(owner, minlength=len(size))
        out = np.stack([np.bincount(owner, w[feat, c], len(size)) for c in range(k)], 1) / n[:, None]
        ends = np.cumsum(size)
        at = self.lexicon.find(token_keys(data, ends - size, ends), -1)
        known = at >= 0
        out[known] += self.model.lexicon[at[known]]
        return out.astype(np.float32)

    def posteriors(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """[word, language]; ``rows``: the text of each word, ascending."""
        n, k = len(starts), len(self.model.langs)
        if not n:
            return np.zeros((0, k))
        unary = self.cache.rows(low, starts, ends)
        place = np.arange(n) - np.searchsorted(rows, rows)
        head = np.flatnonzero(place % CHAIN == 0)
        length = np.diff(np.append(head, n))
        order = np.argsort(-length, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        chain = np.repeat(rank, length)
        t = np.arange(n) - np.repeat(head, length)
        grid = np.zeros((len(head), int(length.max()), k), np.float32)
        grid[chain, t] = unary
        post, _ = forward_backward(grid, self.model.transitions, self.model.start, length[order])
        return post[chain, t]


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred string, score double, mix map<string,double>`` (share of the words by language).

    One row per input row. A text that is null or has no letter is ``und`` with
    score 0 and an empty mix, as is every text if there is no model. Texts of
    any length are read whole; repeated rows are predicted alike; null ids stay
    null. Of tied languages the first by name is taken.
    """
    kind = dict(docs.dtypes)[id_col]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size but for the lexicon, bounded by the sample
    mix_type = pa.map_(pa.string(), pa.float64())

    def run(it):
        m = shared.value
        tagger = Tagger(m) if m is not None else None
        for b in batches(it):
            buf, off = text_buffer(b.column(1))
            pred, score, mix = ["und"] * b.num_rows, np.zeros(b.num_rows), [[] for _ in range(b.num_rows)]
            for i, j in slices(off) if tagger else ():
                own = off[i:j + 1] - off[i]
                part = buf[off[i]:off[j]]
                low, starts, ends = word_spans(part, own, LETTERS)
                rows = np.searchsorted(own, starts, side="right") - 1
                post = tagger.posteriors(low, starts, ends, rows)
                mass = np.stack([np.bincount(rows, post[:, c], j - i) for c in range(len(m.langs))], 1)
                ascii_words = np.bincount(rows, low[starts] < 128, j - i) if len(rows) else np.zeros(j - i)
                for r in np.flatnonzero(mass.sum(1) > 0).tolist():
                    if not ascii_words[r] and not has_letter(part[own[r]:own[r + 1]].tobytes()):
                        continue
                    share = mass[r] / mass[r].sum()
                    best = int(share.argmax())
                    pred[i + r], score[i + r] = m.langs[best], min(1.0, float(share[best]))
                    mix[i + r] = [(lang, float(x)) for lang, x in zip(m.langs, share) if x >= 0.005]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pred), pa.array(score), pa.array(mix, mix_type)],
                                             ["doc_id", "lang_pred", "score", "mix"])

    return arrow_map(docs.select(id_col, text_col), run, f"doc_id {kind}, lang_pred string, score double, mix map<string,double>")
