"""Quality rules with risk-controlled cutoffs.

Each rule scores a text from 0 to 100 (higher is worse). In each stratum one
half of the labelled rows says what each score is worth: the odds of bad to good
among the rows with that score or more. A text's combined score is the best odds
that one of its rules gives (a level from 0 to 100), so a cutoff on it is a
cutoff on every rule at once. The holdout half certifies combined cutoffs from
the most lenient to the strictest: one is certified if the exact binomial upper
bound on the share of good rows rejected is at most ``ALPHA``, at confidence
1 - ``DELTA`` split over the strata (Bonferroni); the walk stops at the first
that is not (fixed-sequence testing, so the error stays that of one test). So
with probability 1 - ``DELTA``, no stratum that certifies loses more than
``ALPHA`` of its good rows to all rules together. Of the certified cutoffs the
one is taken that in the other half rejects most bad rows beyond the good ones
(of equal ones the strictest).

All strata together are one more, pooled, stratum. A labelled stratum that
certifies no cutoff of its own takes the pooled cutoffs, unless its own holdout speaks
against them: they are off where so many of its good rows would go that a share of at most ``ALPHA`` is
refuted by an exact test at level ``DOUBT``. Under pooled cutoffs the bound holds
for the good rows of all strata together; only a stratum's ``own`` cutoffs carry the guarantee
for it. The rules stay off in a stratum
without labelled rows, which the pool knows nothing of, and everywhere if the
pooled rows are too few as well.

The statistics cover every labelled row: Spark counts (stratum, rule, score,
half, label), then (stratum, combined score, half, label), and a stratum is a
few thousand counts at most.
"""

from __future__ import annotations

from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsevents.llm.common import arrow_map, batches, discard, text_buffer, written

#: Share of good rows of a stratum that all rules together may reject, and the probability that a stratum loses more.
ALPHA, DELTA = 0.01, 0.05
#: Level of the test that turns pooled cutoffs off in a stratum.
DOUBT = 0.05

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")
RULES = ("symbols", "dup_lines", "repeats", "shouting", "marks", "long_words", "short_words")

_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_WHITE = np.frombuffer(b" \t\n\v\f\r", np.uint8)
_MARKS = np.frombuffer(b"!?", np.uint8)


def repeat_words(words: list[bytes], width: int = 5) -> int:
    """Words inside windows of ``width`` words that the text holds twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    seq = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    v = len(ids)
    key, top = seq[:n].copy(), v
    for k in range(1, width):
        if top * v >= 1 << 62:  # dense ranks keep the key exact
            ranks, key = np.unique(key, return_inverse=True)
            top = len(ranks)
        key = key * v + seq[k:k + n]
        top *= v
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    cover = np.zeros(len(words) + 1, np.int64)
    cover[at] += 1
    np.subtract.at(cover, at + width, 1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def text_counts(raw: bytes) -> tuple[int, ...]:
    """``COUNTS`` of one text in UTF-8."""
    words = raw.split()  # bytes split at exactly \x20 and \x09-\x0D
    if not words:
        return (0,) * len(COUNTS)
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    points = len(raw) - int(hist[0x80:0xC0].sum())
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return (len(words), points - int(hist[_WHITE].sum()), int(hist[_SYMBOLS].sum()), len(lines) - len(set(lines)),
            repeat_words(words), len(lines), int(hist[65:91].sum()), int(hist[_MARKS].sum()))


def counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (a struct of all columns of ``docs``) and the ``COUNTS`` of each text.

    One row per input row; a null text has no words. The struct keeps columns
    that share a name with a count apart.
    """
    names = [f"_k{i}" for i in range(len(docs.columns))]
    kinds = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema.fields))
    plain = docs.toDF(*names)
    text = names[docs.columns.index(text_col)]

    def run(it):
        for b in batches(it):
            buf, off = text_buffer(b.column(b.schema.get_field_index(text)))
            cut = off.tolist()
            rows = [text_counts(buf[x:y].tobytes()) for x, y in zip(cut, cut[1:])]
            cols = [pa.array(c, pa.int64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], [*names, *COUNTS])

    out = arrow_map(plain, run, kinds + ", " + ", ".join(f"{c} long" for c in COUNTS))
    return out.select(F.struct(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)]).alias("row"), *COUNTS)


def base_failed() -> Column:
    """Fewer than ten words, or over a fifth of them in repeated windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def scores() -> dict[str, Column]:
    """Score of each rule, a whole number from 0 to 100."""
    def share(a, b, by=100):
        whole = F.floor(by * F.col(a) / F.greatest(F.col(b), F.lit(1)))
        return F.least(F.greatest(whole, F.lit(0)), F.lit(100)).cast("int")
    length = share("word_chars", "n_words", 5)  # a mean of 20 or more scores 100
    return {
        "symbols": share("n_symbols", "word_chars"), "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"), "shouting": share("n_upper", "word_chars"),
        "marks": share("n_marks", "word_chars"), "long_words": length, "short_words": (100 - length).cast("int"),
    }


def binomial_tail(n: int, p: float, k: int) -> float:
    """P(X <= k) for X binomial (n, p): the exact p-value of "the true rate is p or more" when k are seen."""
    if k >= n:
        return 1.0
    total, base = 0.0, lgamma(n + 1)
    for i in range(k, -1, -1):
        term = exp(base - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log(1 - p))
        total += term
        if i < n * p and term < total * 1e-12:
            break
    return min(1.0, total)


def cutoff(score: np.ndarray, holdout: np.ndarray, is_good: np.ndarray, count: np.ndarray, alpha: float, delta: float) -> int | None:
    """The cutoff on one stratum's (combined) score, from counts by (score, holdout, good); None: off."""
    def tail(half, good_rows):
        own = (holdout == half) & (is_good == good_rows)
        return np.bincount(score[own], count[own], minlength=101)[::-1].cumsum()[::-1]
    good = tail(True, True)
    tune_good, tune_bad = tail(False, True), tail(False, False)
    n, best, most = int(good[0]), None, 0
    for c in range(100, 0, -1):
        if n == 0 or binomial_tail(n, alpha, int(good[c])) > delta:
            break
        gain = int(tune_bad[c]) - int(tune_good[c])
        if tune_bad[c] > 0 and gain >= most:
            best, most = c, gain
    return best


def levels(score: np.ndarray, is_good: np.ndarray, count: np.ndarray) -> list[int]:
    """Level of each score of a rule, from the counts of the rows that are not held out: 0, or 50 to 100 by the odds of bad to good.

    A score has the best level of the cutoffs up to it, so levels never fall.
    """
    good, bad = (np.bincount(score[own], count[own], minlength=101)[::-1].cumsum()[::-1] for own in (is_good, ~is_good))
    odds = np.minimum(50 + np.floor(6 * np.log2((bad + 1) / (good + 1))), 100)
    level = np.where((bad > 0) & (bad >= good), odds, 0)
    level[0] = 0  # a score of 0 is no offence
    return np.maximum.accumulate(level).astype(int).tolist()


def thresholds(counted: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``stratum, cutoffs map<string,int>, source`` from counted rows (``doc_id, stratum``, ``COUNTS``) and labels (``doc_id, quality``).

    A row for each labelled stratum; ``source`` is ``own``, ``pooled`` or ``off`` (null cutoffs). Inside, the null stratum is the pooled one. Rows that the base rules reject, and labels that are null, take no part. A
    row with several labels counts once for each.
    """
    own = scores()
    seen = written(counted.where(~base_failed())
                   .join(labels.where("quality is not null").select(F.col("doc_id").alias("_id"), "quality"), F.col("doc_id") == F.col("_id"))
                   .select(F.explode(F.array(F.col("stratum"), F.lit(None).cast("string"))).alias("stratum"),
                           (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0).alias("holdout"),
                           (F.col("quality") == 1).alias("good"), *[own[r].alias(r) for r in RULES])
                   .groupBy("stratum", "holdout", "good", *RULES).count(), "quality-scores")
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("score")) for r in RULES])).alias("s")
    tune = (seen.where("not holdout").select("stratum", "good", "count", each)
            .groupBy("stratum", "s.rule", "s.score", "good").agg(F.sum("count").alias("count")))

    def rank(key, t):
        score, good, count = (t[n].to_numpy(zero_copy_only=False) for n in ("score", "good", "count"))
        return pa.Table.from_pylist([{"stratum": key[0].as_py(), "rule": key[1].as_py(), "level": levels(score, good, count)}],
                                    pa.schema([("stratum", pa.string()), ("rule", pa.string()), ("level", pa.list_(pa.int32()))]))

    ranked = tune.groupBy("stratum", "rule").applyInArrow(rank, "stratum string, rule string, level array<int>")
    maps = written(ranked.groupBy(F.col("stratum").alias("_stratum")).agg(F.map_from_entries(F.collect_list(F.struct("rule", "level"))).alias("level")), "quality-levels")
    worst = F.greatest(*[F.coalesce(F.get(F.col("level")[r], F.col(r)), F.lit(0)) for r in RULES])
    hist = written(seen.join(maps, F.col("stratum").eqNullSafe(F.col("_stratum")))
                   .groupBy("stratum", "holdout", "good", worst.alias("score")).agg(F.sum("count").alias("count")), "quality-histogram")
    each_delta = delta / max(1, hist.select("stratum").distinct().count())  # the pooled stratum counts as one

    def certify(key, t):
        own = {n: t[n].to_numpy(zero_copy_only=False) for n in ("score", "holdout", "good", "count")}
        c = cutoff(own["score"], own["holdout"], own["good"], own["count"], alpha, each_delta)
        rows = [] if c is None else [{"stratum": key[0].as_py(), "cutoff": c}]
        return pa.Table.from_pylist(rows, pa.schema([("stratum", pa.string()), ("cutoff", pa.int32())]))

    found = hist.groupBy("stratum").applyInArrow(certify, "stratum string, cutoff int")
    # Levels never fall: the scores below the cutoff are as many as the smallest score that reaches it.
    lowest = F.map_filter(F.transform_values("level", lambda _, v: F.size(F.filter(v, lambda x: x < F.col("cutoff")))), lambda _, v: v <= 100)
    certified = written(found.join(maps, F.col("stratum").eqNullSafe(F.col("_stratum"))).select("stratum", lowest.alias("cutoffs")), "quality-certified")
    pooled = certified.where("stratum is null").agg(F.first("cutoffs").alias("_pooled"))  # always one row
    # Good holdout rows of each stratum, and how many of them the pooled cutoffs reject.
    caught = F.coalesce(F.array_max(F.array(*[(F.col(r) >= F.col("_pooled")[r]).cast("int") for r in RULES])), F.lit(0))
    good = (seen.where("stratum is not null and holdout and good").crossJoin(F.broadcast(pooled))
            .groupBy("stratum").agg(F.sum("count").alias("n"), F.sum(F.col("count") * caught).alias("lost")))

    def doubt(it):
        for b in batches(it):
            n, lost = b.column(1).to_pylist(), b.column(2).to_pylist()
            # P(X >= lost) for a share of alpha.
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x > 0 and 1 - binomial_tail(m, alpha, x - 1) < DOUBT for m, x in zip(n, lost)])], ["_stratum", "refuted"])

    refuted = arrow_map(good, doubt, "_stratum string, refuted boolean")
    strata = hist.where("stratum is not null").select("stratum").distinct()
    chosen = (strata.join(certified, "stratum", "left").join(refuted, F.col("stratum") == F.col("_stratum"), "left").crossJoin(F.broadcast(pooled))
              .withColumn("source", F.when(F.col("cutoffs").isNotNull(), "own")
                          .when(F.col("_pooled").isNotNull() & ~F.coalesce("refuted", F.lit(False)), "pooled").otherwise("off")))
    out = written(chosen.select("stratum", F.when(F.col("source") == "own", F.col("cutoffs")).when(F.col("source") == "pooled", F.col("_pooled")).alias("cutoffs"),
                                "source"), "quality-cutoffs")
    discard(seen, maps, hist, certified)
    return out


def verdict(counted: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``counted`` (with ``stratum``) and ``base_failed``, ``kept``; a stratum without cutoffs keeps all that the base rules keep."""
    marked = counted.join(cutoffs.select(F.col("stratum").alias("_stratum"), "cutoffs"), F.col("stratum") == F.col("_stratum"), "left")
    own = scores()
    rejects = F.lit(False)
    for r in RULES:
        rejects = rejects | F.coalesce(own[r] >= F.col("cutoffs")[r], F.lit(False))
    return (marked.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & ~rejects).drop("_stratum", "cutoffs"))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            stratum_col: str = "lang", alpha: float = ALPHA, delta: float = DELTA, keep_rows: bool = False) -> DataFrame:
    """Verdict on each row of ``docs``: its id, ``COUNTS``, ``base_failed``, ``kept``.

    One row per input row. Null and empty texts have no words and fail the base
    rules; a null stratum is a stratum of its own, apart from any that has a name; a null id has no label.
    Repeated rows get the same verdict. ``keep_rows``: ``row`` (all columns of
    ``docs``) in place of the id; the counts are then made twice, so that no
    text is shuffled.
    """
    ids = [F.col(f"row.{id_col}").alias("doc_id"), F.coalesce(F.concat(F.lit("="), F.col(f"row.{stratum_col}").cast("string")), F.lit("null")).alias("stratum")]
    slim = docs.select(*dict.fromkeys([id_col, text_col, stratum_col]))
    table = written(counts(slim, text_col).select(*ids, *COUNTS), "quality-counts")
    found = thresholds(table, labels, alpha, delta)
    if not keep_rows:
        return verdict(table, found)
    discard(table)
    return verdict(counts(docs, text_col).select("row", ids[1], *COUNTS), found)
