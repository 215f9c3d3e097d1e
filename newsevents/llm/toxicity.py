"""Toxicity by subword-bag embeddings under a linear softmax, trained jointly in numpy.

A word is the average of the embeddings of its hashed character n-grams, a
window of words the average of its words, and a softmax over two classes reads
the window. Embeddings and softmax are trained together (Adam, all windows of
the sample at once; a window has its text's label). As misspellings share most
n-grams with the word meant, unseen ones score alike.

Insults are a few words in a long text, so a text scores by its worst window: a
two-parameter logistic over that window's margin, fitted on the same sample.

The model is linear in the embeddings: each n-gram's contribution to the margin
is one number, and only that table (``BUCKETS`` floats) goes to the executors.

Training goes over all windows first; then, in rounds, over the windows that
score worst in each text, kept from round to round: what a clean text scores
highest is what must be learnt to be harmless.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsevents.llm.bpe import spread, token_keys
from newsevents.llm.common import arrow_map, batches, slices, text_buffer
from newsevents.llm.words import Adam, Bags, WordCache, char_table, grams, has_words, sample_text, word_spans

#: Bounds of the training sample: clean and toxic rows, and the characters of one (a longer text gives stretches of that many in all).
SAMPLE_ROWS, SAMPLE_CHARS = (2_200, 700), 5_000
BUCKETS, DIM, LOW, HIGH, WINDOW = 1 << 17, 8, 3, 5, 2
STEPS, ROUNDS, ROUND_STEPS, RATE = 15, 6, 20, 0.05
WORST = 4
SIGNS = "0123456789@$"
CHARS = char_table(SIGNS.encode())


@dataclass
class Model:
    table: np.ndarray  # margin of each n-gram
    bias: float
    slope: float
    shift: float


def _words(texts: list[bytes]):
    """Bytes, spans and owning text of all words."""
    buf = np.frombuffer(b"".join(texts), np.uint8)
    off = np.cumsum([0] + [len(t) for t in texts])
    low, starts, ends = word_spans(buf, off, CHARS)
    return low, starts, ends, np.searchsorted(off, starts, side="right") - 1


def worst_windows(margin: np.ndarray, rows: np.ndarray, n: int, width: int = WINDOW) -> np.ndarray:
    """Highest mean margin of ``width`` neighbouring words of each of ``n`` texts (shorter texts: of all words; none: nan)."""
    out = np.full(n, np.nan)
    if not len(margin):
        return out
    total = np.concatenate([[0.0], np.cumsum(margin, dtype=np.float64)])
    first = np.searchsorted(rows, np.arange(n))
    last = np.searchsorted(rows, np.arange(n), side="right")
    end = np.minimum(np.arange(len(margin)) + width, last[rows])
    begin = np.maximum(end - width, first[rows])
    mean = (total[end] - total[begin]) / (end - begin)
    some = np.flatnonzero(last > first)
    out[some] = np.maximum.reduceat(mean, first[some])
    return out


def train(texts: list[bytes], toxic: np.ndarray, steps: int = STEPS, seed: int = 4) -> Model | None:
    """Fit the model; None unless there are texts with words of both classes."""
    buf, starts, ends, rows = _words(texts)
    if len(set(toxic[np.unique(rows)].tolist())) < 2:
        return None
    keys, first, word = np.unique(token_keys(buf, starts, ends), return_index=True, return_inverse=True)
    size = (ends - starts)[first]
    owner, gram = grams(buf[spread(starts[first], size)], size, LOW, HIGH, BUCKETS)
    used, gram = np.unique(gram, return_inverse=True)  # only n-grams seen have parameters to fit
    owner, gram = owner.astype(np.int32), gram.astype(np.int32)
    # Windows side by side: words of one text, WINDOW at a time.
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    _, window = np.unique(rows * (1 << 32) + place // WINDOW, return_inverse=True)
    n_windows = int(window.max()) + 1
    text_of = np.zeros(n_windows, np.int64)
    text_of[window] = rows
    y = toxic[text_of].astype(np.float32)
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (len(used), DIM)).astype(np.float32)
    soft = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    adam = Adam([embed, soft, bias], RATE)

    def steps_on(chosen: np.ndarray, n: int) -> None:
        """Adam steps on some windows; classes weigh the same."""
        at = np.full(n_windows, -1)
        at[chosen] = np.arange(len(chosen))
        here = np.flatnonzero(at[window] >= 0)
        own_words, w = np.unique(word[here], return_inverse=True)
        windows = Bags(at[window[here]], w, len(chosen), len(own_words))
        back = np.full(len(keys), -1)
        back[own_words] = np.arange(len(own_words))
        has = np.flatnonzero(back[owner] >= 0)
        bags = Bags(back[owner[has]], gram[has], len(own_words), len(used))
        t = y[chosen]
        weight = np.where(t > 0, 0.5 / max(1.0, t.sum()), 0.5 / max(1.0, (1 - t).sum())).astype(np.float32)
        for _ in range(n):
            x = windows.mean(bags.mean(embed))
            z = x @ soft + bias
            p = 1 / (1 + np.exp(np.clip(z[:, 0] - z[:, 1], -40, 40)))
            g1 = ((p - t) * weight)[:, None]
            g = np.concatenate([-g1, g1], axis=1)
            adam.step([bags.gradient(windows.gradient(g @ soft.T)), x.T @ g, g.sum(0)])

    all_bags = Bags(owner, gram, len(keys), len(used))
    # As many windows of clean texts as there are of toxic ones are enough to begin with.
    clean = np.flatnonzero(y == 0)
    some = rng.permutation(clean)[:int((y > 0).sum())]
    steps_on(np.sort(np.concatenate([np.flatnonzero(y > 0), some])), steps)
    hard = np.zeros(0, np.int64)
    for _ in range(ROUNDS):
        margin = all_bags.mean(embed @ (soft[:, 1:] - soft[:, :1]))[word, 0]
        z = np.bincount(window, margin, n_windows) / np.bincount(window, minlength=n_windows)
        order = np.lexsort((-z, text_of))
        rank = np.arange(n_windows) - np.searchsorted(text_of[order], text_of[order])
        # The worst window of a toxic text, the worst few of a clean one.
        worst = order[rank < np.where(y[order] > 0, 1, WORST)]
        hard = np.union1d(hard[y[hard] == 0], worst)
        steps_on(hard, ROUND_STEPS)
    bags = all_bags
    table = np.zeros(BUCKETS, np.float32)
    table[used] = embed @ (soft[:, 1] - soft[:, 0])
    model = Model(table, float(bias[1] - bias[0]), 1.0, 0.0)
    z = worst_windows(bags.mean(table[used][:, None])[word, 0], rows, len(texts)) + model.bias
    model.slope, model.shift = _logistic(z[~np.isnan(z)], toxic[~np.isnan(z)])
    return model


def _logistic(z: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton's method with a small penalty."""
    scale = max(float(np.std(z)), 1e-6)
    x = np.stack([(z - z.mean()) / scale, np.ones_like(z)], 1)
    w = np.full(len(y), 1.0 / len(y))
    b = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (w * (p - y)) + 1e-4 * b * [1, 0]
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        b -= np.clip(np.linalg.solve(hess, grad), -2, 2)
    slope = max(b[0] / scale, 0.0)
    return slope, float(b[1] - b[0] * z.mean() / scale)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: tuple[int, int] = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> Model | None:
    """Train on at most ``sample_rows`` labelled rows (clean, toxic) that are not held out.

    ``labels``: ``doc_id, toxic`` (0 or 1; null labels and ids are skipped). Only texts with a word count.
    Rows are taken in the order of a hash of their id, texts of at most ``sample_chars`` first: they are
    learnt from whole, while a longer one gives stretches from all over it (``sample_text``). So
    the sample's size has a fixed bound, and a class whose texts are all long is learnt none the less.
    """
    ids = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = ids.select(F.col("doc_id").alias("_id"), "toxic")
    texts = docs.select("doc_id", "text").where(has_words(F.col("text"), SIGNS)).withColumn("long", F.length("text") > sample_chars)
    sizes = texts.select("doc_id", "long", F.xxhash64("text").alias("version")).join(ids, F.col("doc_id") == F.col("_id"))
    some = None
    for value in (0, 1):
        part = sizes.where(F.col("toxic") == value).orderBy("long", F.xxhash64("doc_id"), "doc_id", "version").limit(sample_rows[value])
        some = part if some is None else some.unionByName(part)
    some = some.groupBy("_id", "version", "toxic").agg(F.count("*").alias("n"))  # at most sum(sample_rows) rows: safe to broadcast
    picked = texts.join(F.broadcast(some), (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("version")))
    rows = picked.select("doc_id", sample_text(F.col("text"), sample_chars, SIGNS).alias("text"), "toxic").collect()
    rows.sort(key=lambda r: (r.doc_id, r.text))
    return train([r.text.encode() for r in rows], np.array([r.toxic for r in rows], np.int64))


def held_out(id_col: str = "doc_id"):
    """Rows that are never learnt from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score double`` from 0 to 1, higher: more likely toxic.

    One row per input row. A text without words (null, empty) scores 0, as does
    every text if there is no model. Texts of any length are scored whole;
    repeated rows score alike; a null id stays null.
    """
    kind = dict(docs.dtypes)[id_col]
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # BUCKETS floats whatever the data

    def run(it):
        m = shared.value

        def margins(data, size):
            owner, gram = grams(data, size, LOW, HIGH, BUCKETS)
            return (np.bincount(owner, m.table[gram], len(size)) / np.maximum(np.bincount(owner, minlength=len(size)), 1))[:, None].astype(np.float32)

        cache = WordCache(margins, 1)
        for b in batches(it):
            buf, off = text_buffer(b.column(1))
            out = np.zeros(b.num_rows)
            for i, j in slices(off) if m is not None else ():
                own = off[i:j + 1] - off[i]
                low, starts, ends = word_spans(buf[off[i]:off[j]], own, CHARS)
                rows = np.searchsorted(own, starts, side="right") - 1
                z = worst_windows(cache.rows(low, starts, ends)[:, 0], rows, j - i) + m.bias
                p = 1 / (1 + np.exp(-np.clip(m.slope * z + m.shift, -40, 40)))
                out[i:j] = np.where(np.isnan(z), 0.0, p)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out)], ["doc_id", "score"])

    return arrow_map(docs.select(id_col, text_col), run, f"doc_id {kind}, score double")
