import math
import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from newsevents.llm import lexical_search as L
from newsevents.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    """Rows (item, rank, doc, score) by scoring every pair."""
    counts = [(key, Counter(t), len(t)) for key, text in docs if (t := plain_terms(text))]
    n_docs, n_terms = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for key, c, n in counts:
            m = 25 + (75 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in plain_terms(text) if t in c)
            if s > 0:
                scored.append((-s, key is None, key or 0, key))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return out


def got(spark, docs, items, **how):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, score string, item int").repartition(3)
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    return sorted((tuple(r) for r in L.search(d, i, **how).select("item_id", "rank", "doc_id", "score").collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aZ9 @[`{/é中\x00\x7f\n", max_size=40))
def test_terms(text):
    assert [t.decode() for t in L.terms(text)] == plain_terms(text)


def rows(seed, n, words):
    rnd = random.Random(seed)
    return [(k, " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 30)))) for k in range(n)]


def test_against_all_pairs(spark):
    words = [f"w{i}" for i in range(40)] + ["Ärger", "THE"] * 10
    docs, items = rows(1, 120, words), rows(2, 9, words)
    docs += [(k + 1000, docs[k % 3][1]) for k in range(30)]  # copies: equal scores
    want = sorted(plain(docs, items), key=str)
    assert got(spark, docs, items) == want
    assert got(spark, docs, items, block_items=2) == want and got(spark, docs, items, block_bytes=30) == want


def test_odd_rows(spark):
    docs = [(1, "alpha beta"), (1, "alpha beta"), (None, "alpha beta"), (2, None), (3, ""), (4, "... !"), (5, "beta " * 100_000), (6, "gamma"), (7, "delta")]
    items = [(1, "alpha"), (2, None), (3, ""), (4, "beta alpha alpha"), (None, "gamma delta"), (6, "nowhere")]
    assert got(spark, docs, items) == sorted(plain(docs, items), key=str)
    assert [r[2] for r in got(spark, docs, items) if r[0] == 1] == [1, 1, None]
    assert got(spark, docs, [(1, "alpha"), (1, "gamma")]) == sorted(plain(docs, [(1, "alpha"), (1, "gamma")]), key=str)


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a")]) == got(spark, [(1, "a")], []) == got(spark, [(1, None)], [(1, "a")]) == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(*c).collect()]
    want = plain(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    assert sorted(tuple(r) for r in QUERIES["op12_lexical_search"](spark, sf).select("item_id", "rank", "doc_id", "score").collect()) == sorted(want)
