import re

import numpy as np

from newsevents.llm import ngram_join as J


def plain_set(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def plain(rows):
    """(doc_id, n_shingles, component) by comparing all pairs of distinct sets."""
    sets = [plain_set(t) for _, t in rows]
    live = [k for k, (i, _) in enumerate(rows) if i is not None and sets[k]]
    root = {rows[k][0]: rows[k][0] for k in live}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    index = {}
    for k in live:
        for g in sets[k]:
            index.setdefault(g, []).append(k)
    tried = set()
    for group in index.values():
        for x, a in enumerate(group):
            for b in group[:x]:
                if (a, b) in tried:
                    continue
                tried.add((a, b))
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    p, q = find(rows[a][0]), find(rows[b][0])
                    root[max(p, q)] = min(p, q)
    return sorted(((i, len(s), None if i is None else find(i) if i in root and s else i) for (i, _), s in zip(rows, sets)), key=str)


def words(rng, n):
    return ["".join(rng.choice(list("abcdef"), 4)) for _ in range(n)]


def family(rng, n, size, edits):
    base = words(rng, n)
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(int(rng.integers(0, edits + 1))):
            w[int(rng.integers(len(w)))] = "".join(rng.choice(list("uvwxyz"), 5))
        out.append(" ".join(w))
    return out


def join(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as n", "1 as gram", "2 as comp")
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(frame).collect()), key=str)


def test_against_brute_force(spark):
    rng = np.random.default_rng(5)
    texts = []
    for n, size, edits in ((40, 30, 4), (100, 25, 8), (12, 20, 2), (7, 12, 1), (300, 12, 20), (60, 40, 6)):
        texts += family(rng, n, size, edits)
    line = " ".join(words(rng, 12))
    texts += [line + " " + " ".join(words(rng, 40)) for _ in range(40)]  # a line that many hold
    chain = words(rng, 80)
    for k in range(12):  # neighbours link, ends don't
        texts.append(" ".join(chain[2 * k:2 * k + 50]))
    texts += ["one two", "One TWO", "one  two\n", "one", "a b c d", "É b c d e f", "é b c d e f", "", "  \n\t", None, "same words here again today", "same words here again today"]
    order = rng.permutation(len(texts)).tolist()
    rows = [(3 * i, texts[k]) for i, k in enumerate(order)]
    rows += [(None, texts[0]), (rows[0][0], rows[0][1]), (10_000, " ".join(words(rng, 30_000)))]
    assert join(spark, rows) == plain(rows)


def test_pairs_of_unequal_length(spark):
    rng = np.random.default_rng(11)
    def fresh(n):
        return ["".join(rng.choice(list("klmnop"), 7)) for _ in range(n)]
    texts = []
    for base, one, two in [(30, 2, 6), (6, 2, 0)] + [tuple(int(x) for x in rng.integers((8, 0, 0), (120, 12, 25))) for _ in range(300)]:
        both = fresh(base)
        texts += [" ".join(both + fresh(one)), " ".join(both + fresh(two))]  # appended tails
    for n in range(20, 60):
        whole = fresh(n)
        texts += [" ".join(whole), " ".join(whole[:n - n // 5]), " ".join(fresh(3) + whole[n // 6:])]  # cut tail, new head
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts)]
    want = plain(rows)
    assert join(spark, rows) == want
    assert len({c for _, _, c in want}) < len(rows) - 100


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert J.near_duplicates(empty).count() == 0
    assert join(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]


def test_components_of_long_chains(spark):
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 103), (103, 101), (200, 200)]
    got = {r.doc: r.comp for r in J.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(got.get(i, i) == 0 for i in range(61)) and {got.get(i, i) for i in (100, 101, 103)} == {100}


def test_query(spark):
    from newsevents.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op6_ngram_join"](spark, sf).collect()), key=str)
    assert got == plain(rows)


def test_components_of_random_graphs(spark):
    rng = np.random.default_rng(9)
    for n, m in ((40, 30), (60, 60)):
        pairs = [(int(a), int(b)) for a, b in rng.integers(0, n, (m, 2))]
        root = list(range(n))
        for _ in range(n):
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        got = {r.doc: r.comp for r in J.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
        assert [got.get(i, i) for i in range(n)] == root
