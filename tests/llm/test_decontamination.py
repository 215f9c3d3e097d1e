import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from newsevents.llm import decontamination as D


def plain_normal(text):
    text = "".join(c.lower() if c.isascii() or "À" <= c <= "Þ" and c != "×" else c for c in text)
    return " " + re.sub(r"[\x00-\x7f]+", lambda m: re.sub(r"[^a-z0-9]+", " ", m[0]), text).strip(" ") + " "


def normal(texts):
    raw = [t.encode() for t in texts]
    buf, off = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])
    data, own = D.normalise(buf, off)
    return [data[a:b].tobytes().decode() for a, b in zip(own, own[1:])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aZ9 .É×é中\n-", max_size=20), min_size=1, max_size=4))
def test_normal_form(texts):
    for t, got in zip(texts, normal(texts)):
        want = plain_normal(t)
        assert got == (want if want.strip() else " ") or got.strip() == want.strip() == ""


def search(p, t, anchored=False):
    """Least distance of p to a stretch of t, by the whole table."""
    row = list(range(len(t) + 1)) if anchored else [0] * (len(t) + 1)
    for i in range(1, len(p) + 1):
        new = [i]
        for j in range(1, len(t) + 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p[i - 1] != t[j - 1])))
        row = new
    return min(row), row.index(min(row))


@settings(max_examples=300, deadline=None)
@given(st.binary(min_size=1, max_size=12).map(lambda b: bytes(97 + x % 3 for x in b)), st.binary(max_size=30).map(lambda b: bytes(97 + x % 3 for x in b)), st.booleans())
def test_myers(p, t, anchored):
    assert D.myers(p, t, anchored) == search(p, t, anchored)


def plain(docs, items, rate):
    """(doc, item, least distance) by whole-table search of every pair."""
    out = set()
    for d, t in docs:
        for i, x in items:
            if t is None or x is None or not plain_normal(x).strip():
                continue
            p, text = plain_normal(x).encode(), plain_normal(t).encode()
            best = search(p, text)[0]
            if best <= int(rate * len(p)):
                out.add((d, i, best))
    return out


ITEM = "It was the best of times, it was the worst of times, it was the age of wisdom, it was the age of foolishness"


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    items = [(1, ITEM), (2, "Call me Ishmael. Some years ago - never mind how long precisely"), (3, "yes"), (4, None), (5, ""), (6, "?!"), (7, "Émile ÉTAIT à Paris")]
    filler = "lorem ipsum dolor sit amet yesterday consectetur adipiscing elit sed do eiusmod tempor incididunt"
    docs = []
    for k in range(60):
        text = items[k % 2][1]
        for _ in range(int(rng.integers(0, 9))):
            at = int(rng.integers(0, len(text)))
            text = [text[:at] + text[at + 1:], text[:at] + "q" + text[at:], text[:at] + "z" + text[at + 1:]][int(rng.integers(3))]
        docs.append((k, filler[:int(rng.integers(0, 60))] + "\n" + text.upper() + "; " + filler))
    docs += [(100, None), (101, ""), (102, "Yes, it is"), (103, "émile était à paris!"), (104, ITEM + " " + ITEM)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id", "2 as distance")
    items_frame = spark.createDataFrame(items, "item_id int, text string")
    want = plain(docs, items, D.RATE)
    for block_bytes in (1 << 20, 150):
        got = D.contaminated(frame, items_frame, block_bytes=block_bytes).collect()
        assert {(r.doc_id, r.item_id, r.distance) for r in got} == want and len(got) == len(want)
        left = D.clean(frame, items_frame, block_bytes=block_bytes)
        assert left.columns == frame.columns
        assert {r.doc_id for r in left.collect()} == {d for d, _ in docs} - {d for d, _, _ in want}
    for r in got:
        text = normal([dict(docs)[r.doc_id]])[0].encode()
        p = normal([dict(items)[r.item_id]])[0].encode()
        assert search(p, text[r.start:r.end], True)[0] == r.distance


def test_empty_and_repeated(spark):
    docs = spark.createDataFrame([(1, ITEM), (1, ITEM), (None, ITEM)], "doc_id long, text string")
    items = spark.createDataFrame([(9, ITEM)], "item_id long, text string")
    assert sorted(((r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()), key=str) == [(1, 9), (1, 9), (None, 9)]
    assert D.contaminated(docs, items.limit(0)).count() == 0 and D.contaminated(docs.limit(0), items).count() == 0
    assert D.clean(docs, items.limit(0)).count() == 3


def test_query_against_brute_force(spark):
    from newsevents.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    got = {(r.doc_id, r.item_id, r.distance) for r in QUERIES["op2_decontamination"](spark, sf).collect()}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(sf + "/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(sf + "/benchmark.parquet").collect()]
    # Whole-table search of every pair is slow in Python: rows of the table as numpy arrays.
    want = set()
    for d, t in docs:
        text = np.frombuffer(plain_normal(t or "").encode(), np.uint8)
        for i, x in items:
            p = plain_normal(x).encode()
            row = np.zeros(len(text) + 1, np.int64)
            ramp = np.arange(len(text) + 1)
            budget = int(D.RATE * len(p))
            for k, c in enumerate(p, 1):
                new = np.concatenate([[k], np.minimum(row[1:] + 1, row[:-1] + (text != c))])
                row = np.minimum.accumulate(new - ramp) + ramp
                if row.min() > budget:
                    break
            if row.min() <= budget:
                want.add((d, i, int(row.min())))
    assert got == want
