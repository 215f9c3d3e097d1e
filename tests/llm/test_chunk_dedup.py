import hashlib

import numpy as np

from newsevents.llm import chunk_dedup as C


def plain_borders(raw):
    """Borders of one text, byte by byte."""
    cuts, last = [0], 0
    for end in range(1, len(raw) + 1):
        if end - last > C.MAX_CHUNK:
            last += C.MAX_CHUNK
            cuts.append(last)
        h = 0
        for b in raw[max(0, end - C.WINDOW):end]:
            h = (h * 2 + int(C._GEAR[b])) % (1 << 32)
        hit = end >= C.WINDOW and h >> (32 - C.BITS) == 0
        if hit and end - last >= C.MIN_CHUNK:
            cuts.append(end)
            last = end
    if len(raw) > last:
        cuts.append(len(raw))
    return cuts


def plain_spans(docs):
    """(doc, start, end, chunks, first doc) over distinct (id, text) pairs with hash order of versions not needed."""
    places = []
    for i, t in sorted(docs):
        cuts = plain_borders(t)
        places += [(i, a, b, t[a:b]) for a, b in zip(cuts, cuts[1:])]
    first = {}
    for i, a, b, c in places:
        first.setdefault(c, (i, a))
    out, run = [], None
    for i, a, b, c in places:
        if first[c] == (i, a):
            continue
        if run and run[0] == i and run[2] == a:
            run = (i, run[1], b, run[3] + 1, min(run[4], first[c][0]))
        else:
            out.append(run)
            run = (i, a, b, 1, first[c][0])
    return sorted(r for r in [*out, run] if r and r[2] - r[1] >= C.MIN_SPAN)


def text(rng, n):
    return " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(n))


def test_borders():
    rng = np.random.default_rng(1)
    raws = [b"", b"short", text(rng, 300).encode(), b"a" * 3000, text(rng, 60).encode(), b"x" * C.MAX_CHUNK, b"y" * (C.MAX_CHUNK + 1)]
    got = C.borders(np.frombuffer(b"".join(raws), np.uint8), np.cumsum([0] + [len(r) for r in raws]))
    assert got == [plain_borders(r) for r in raws]


def test_insertions_shift_only_near_chunks():
    rng = np.random.default_rng(2)
    a = text(rng, 400).encode()
    b = a[:500] + b" inserted words " + a[500:]
    def cut(x):
        c = plain_borders(x)
        return [x[s:e] for s, e in zip(c, c[1:])]
    assert len(set(cut(a)) - set(cut(b))) <= 4


def test_against_plain_version(spark):
    rng = np.random.default_rng(3)
    passage = text(rng, 60)
    docs = [(k, text(rng, 80) + " " + passage + " " + text(rng, 20)) for k in range(12)]
    docs += [(20, docs[3][1]), (21, passage * 3), (22, ""), (23, "a" * 2000), (24, text(rng, 50)), (30, docs[5][1] + "tail " * 20_000)]
    rows = docs + [(None, docs[0][1]), (40, None), (20, docs[3][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start", "2 as version")
    got = sorted((r.doc_id, r.start, r.end, r.n_chunks, r.first_doc_id) for r in C.repeated_spans(frame).collect())
    want = plain_spans([(i, t.encode()) for i, t in docs])
    assert got == want
    assert {r[0] for r in got} >= set(range(1, 12)) | {20, 21, 30} and not {0, 22, 24} & {r[0] for r in got}
    assert C.repeated_spans(frame.limit(0)).count() == 0


def test_short_passages_are_found(spark):
    rng = np.random.default_rng(4)
    def word():
        return "".join(rng.choice(list("etaoinshrdlu"), rng.integers(1, 10)))
    pairs, docs, place = 600, [], {}
    for k in range(pairs):
        passage = " ".join(word() for _ in range(51))
        for i in (2 * k, 2 * k + 1):
            head = " ".join(word() for _ in range(int(rng.integers(10, 40)))) + " "
            docs.append((i, head + passage + " " + " ".join(word() for _ in range(20))))
            place[i] = len(passage)
    found = {}
    for r in C.repeated_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + r.end - r.start
    shares = [found[i] / place[i] for i in found]
    print("missed", pairs - len(found), "of", pairs, "cover", np.mean(shares))
    assert all(i % 2 for i in found) and len(found) >= 0.99 * pairs and np.mean(shares) > 0.72


def test_query(spark):
    from newsevents.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    got = sorted((r.doc_id, r.start, r.end, r.n_chunks, r.first_doc_id) for r in QUERIES["op8_chunk_dedup"](spark, sf).collect())
    docs = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(sf + "/documents.parquet").collect()]
    # The borders come from the operator here (the plain ones are slow); the rest is plain.
    global plain_borders
    slow = plain_borders
    plain_borders = lambda raw: C.borders(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]
    try:
        assert got == plain_spans(docs)
    finally:
        plain_borders = slow
