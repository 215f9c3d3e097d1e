import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from newsevents.llm import suffix_dedup as X


def plain(rows):
    """(doc, bytes, removed, spans, kept) by a table of all strings; rows in order of id."""
    seen, out = {}, []
    for i, raw in sorted({(i, r) for i, r in rows if i is not None}):
        for a in range(len(raw) - X.LENGTH + 1):
            seen.setdefault(raw[a:a + X.LENGTH], (i, a))
    for i, raw in rows:
        gone = np.zeros(len(raw) + 1, bool)
        if i is not None:
            for a in range(len(raw) - X.LENGTH + 1):
                if seen[raw[a:a + X.LENGTH]] < (i, a):
                    gone[a:a + X.LENGTH] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(bool(g) and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in df.collect()), key=str)


def text(rng, n):
    return "".join(rng.choice(list("abcdefg é"), n))


def test_every_string_has_its_anchor():
    rng = np.random.default_rng(1)
    raws = [text(rng, n).encode() for n in (0, 99, 100, 101, 700, 50, 1000)] + [b"a" * 400, b"ab" * 300]
    off = np.cumsum([0] + [len(r) for r in raws])
    row, place, near, far, _ = X.anchors(np.frombuffer(b"".join(raws), np.uint8), off)
    starts = {}
    for r, x, a, z in zip(row.tolist(), place.tolist(), near.tolist(), far.tolist()):
        for o in range(a, z + 1):
            s = raws[r][x - o:x - o + X.LENGTH]
            assert len(s) == X.LENGTH and starts.setdefault(s, o) == o  # equal strings, equal place of the anchor
            starts.setdefault((r, x - o), o)
    for r, raw in enumerate(raws):
        assert all((r, a) in starts for a in range(len(raw) - X.LENGTH + 1))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.text(alphabet="ab", max_size=12).map(str.encode), max_size=8).map(sorted), max_size=6))
def test_merge_runs(runs):
    coded = []
    for r in runs:
        lcp = [X.common_prefix(a, b) for a, b in zip([b"", *r], r)]
        coded.append((np.array(lcp, np.uint8), [s[c:] for s, c in zip(r, lcp)]))
    run, index, lcp = X.merge_runs(coded)
    merged = [runs[r][i] for r, i in zip(run, index)]
    assert merged == sorted(s for r in runs for s in r)
    assert lcp == [X.common_prefix(a, b) for a, b in zip([b"", *merged], merged)]


def corpus(rng):
    passage, line = text(rng, 260), text(rng, 110)
    docs = [text(rng, 300) + passage[:int(rng.integers(90, 260))] + text(rng, 40) for _ in range(15)]
    docs += [line + text(rng, int(rng.integers(0, 200))) for _ in range(25)]
    docs += [docs[2], docs[2][:150] + "#" + docs[2][150:], passage * 3, "ab" * 200, "a" * 350, line[:99], line[:100], "", text(rng, 99), docs[0] + docs[1]]
    near = docs[4]
    for _ in range(10):
        k = int(rng.integers(len(near)))
        docs.append(near[:k] + "%" + near[k + 1:])
    return docs


def test_against_table_of_all_strings(spark):
    rng = np.random.default_rng(2)
    docs = corpus(rng)
    rows = list(zip(rng.permutation(len(docs)).tolist(), docs))
    rows += [(None, docs[0]), (rows[3][0], rows[3][1]), (500, None), (501, text(rng, 40_000) + docs[3])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row", "2 as start", "3 as place")
    want = plain([(i, (t or "").encode()) for i, t in rows])
    assert result(X.deduplicate(frame)) == want


def test_small_holdings_give_the_same(spark, monkeypatch):
    docs = list(enumerate(corpus(np.random.default_rng(3))))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    assert result(X.deduplicate(frame)) == plain([(i, t.encode()) for i, t in docs])


def test_empty_tables(spark):
    assert X.deduplicate(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = X.deduplicate(spark.createDataFrame([(1, None), (2, ""), (3, "short")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in got) == [(1, 0, 0, 0), (2, 0, 0, 0), (3, 5, 0, 0)]


def test_query(spark):
    from newsevents.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    got = sorted((tuple(r) for r in QUERIES["op10_suffix_dedup"](spark, sf).collect()), key=str)
    docs = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(sf + "/documents.parquet").collect()]
    assert got == plain(docs)


def test_hot_grams_by_digest(spark):
    docs = corpus(np.random.default_rng(4))
    rows = list(enumerate(docs)) + [(3, docs[3]), (None, docs[0])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row", "2 as key", "3 as h1")
    want = plain([(i, t.encode()) for i, t in rows])
    for hot in (0, 3, 12):
        assert result(X.deduplicate(frame, hot_anchors=hot)) == want


def test_borders_from_long_texts(spark):
    rng = np.random.default_rng(5)
    passage = text(rng, 500)
    docs = [(i, text(rng, 22_000) + passage + text(rng, 50)) for i in range(6)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("row", X.F.xxhash64("doc_id", "text"))
    found = X.repeated_anchors(frame)
    assert len(X._borders(frame, found, 5)) >= 3
    assert result(X.deduplicate(frame.drop("row"))) == plain([(i, t.encode()) for i, t in docs])
