import zlib
from itertools import product

import numpy as np

from newsevents.llm import langid as L

SF = "/root/testdata/sf0.01"


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(2)
    k, lengths = 3, np.array([5, 3, 1])
    unary = rng.normal(size=(3, 5, k)).astype(np.float32)
    trans, start = rng.normal(size=(k, k)), rng.normal(size=k)
    post, pairs = L.forward_backward(unary, trans, start, lengths)
    want_pairs = np.zeros((k, k))
    for s, n in enumerate(lengths):
        paths = list(product(range(k), repeat=int(n)))
        w = np.array([np.exp(start[p[0]] + sum(unary[s, t, y] for t, y in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        w /= w.sum()
        for t in range(n):
            for y in range(k):
                assert abs(post[s, t, y] - sum(x for x, p in zip(w, paths) if p[t] == y)) < 1e-5
        for x, p in zip(w, paths):
            for a, b in zip(p, p[1:]):
                want_pairs[a, b] += x
    assert np.allclose(pairs, want_pairs, atol=1e-5)


EN = ["the house stands by the river and the road", "they were reading that book with the children", "what is this thing that was found"]
FR = ["la maison est près de la rivière et du chemin", "ils lisaient ce livre avec les enfants", "quelle est cette chose que nous avons trouvée"]


def model():
    texts = [t.encode() for t in (EN + FR) * 10]
    return L.train(texts, np.array(([0] * 3 + [1] * 3) * 10), ["en", "fr"])


def test_cases(spark):
    m = model()
    rows = [(1, EN[0], "x"), (2, FR[1], "x"), (3, None, "x"), (4, "", "x"), (5, "123 — ½ 456", "x"), (None, EN[2], "x"), (1, EN[0], "x"),
            (6, (EN[0] + " " + FR[0] + ". ") * 5_000, "x"), (7, "éà", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = L.predict(docs, m).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert [by[i].lang_pred for i in (1, 2, 3, 4, 5, None)] == ["en", "fr", "und", "und", "und", "en"]
    assert by[5].score == 0.0 and by[7].lang_pred in ("en", "fr") and all(0 <= r.score <= 1 for r in got)
    assert 0.3 < by[6].mix["en"] < 0.7 and 0.3 < by[6].mix["fr"] < 0.7  # code-switched text: both languages' words are labelled
    assert {r.lang_pred for r in L.predict(docs, None).collect()} == {"und"}
    assert L.predict(docs.limit(0), m).count() == 0
    assert L.fit(docs.selectExpr("doc_id", "text", "cast(null as string) as lang")) is None


def test_held_out_accuracy(spark):
    from newsevents.llm.queries import QUERIES
    got = {r.doc_id: r for r in QUERIES["op5_langid"](spark, SF).collect()}
    docs = spark.read.parquet(SF + "/documents.parquet").collect()
    held = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 4 == 2]
    assert all(got[d.doc_id].held_out for d in held) and len(got) == len(docs)
    assert np.mean([got[d.doc_id].lang_pred == d.lang for d in held]) > 0.95


def test_a_language_of_long_texts_is_learnt(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(EN, 4)), "en") for i in range(100)] + [(200 + i, " ".join(rng.choice(FR, 200)), "fr") for i in range(60)]
    rows += [(300, "1 2 3", "de"), (301, None, "de")]
    assert min(len(t) for i, t, _ in rows if 200 <= i < 300) > L.SAMPLE_CHARS
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    m = L.fit(docs)
    got = {r.doc_id: r.lang_pred for r in L.predict(docs, m).collect()}
    assert m.langs == ["en", "fr"] and all(got[i] == lang for i, _, lang in rows if i < 300)


def test_label_against_plain_version(spark):
    """The language of a text by a small fixed model: features by definition, all paths of labels."""
    rng = np.random.default_rng(9)
    langs = ["a", "b", "c"]
    m = L.Model(langs, rng.normal(size=(2 * L.BUCKETS, 3)).astype(np.float32), np.zeros(0, np.int64), np.zeros((0, 3), np.float32),
                rng.normal(size=(3, 3)).astype(np.float32), rng.normal(size=3).astype(np.float32))

    def features(word):
        w, out = b"<" + word + b">", []
        for n in range(1, 5):
            for i in range(len(w) - n + 1):
                h = 0
                for b in w[i:i + n]:
                    h = (h * 0x100000001B3 + b) % 2**64
                h = (h + n) % 2**64
                h ^= h >> 31
                h = h * 0x9E3779B97F4A7C15 % 2**64
                out.append((h >> 33) % L.BUCKETS)
        for k in (2, 3, 4):
            for side, part in ((0, word[:k]), (1, word[-k:])):
                if len(word) >= k:
                    h = 17 * k + side
                    for b in part:
                        h = (h * 0x100000001B3 + b) % 2**64
                    h = h * 0x9E3779B97F4A7C15 % 2**64
                    out.append(L.BUCKETS + (h >> 33) % L.BUCKETS)
        return out

    def plain(words):
        unary = [m.weights[features(w)].mean(0) for w in words]
        mass = np.zeros(3)
        total = 0.0
        for p in product(range(3), repeat=len(words)):
            x = np.exp(m.start[p[0]] + sum(unary[t][y] for t, y in enumerate(p)) + sum(m.transitions[a, b] for a, b in zip(p, p[1:])))
            total += x
            mass += x * np.bincount(p, minlength=3)
        return mass / total / len(words)

    texts = ["the house", "Größe", "un deux trois quatre", "x y", "ab, cd; ef!", "one two three four five"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in L.predict(docs, m).collect()}
    import re
    for i, t in enumerate(texts):
        share = plain(re.findall(rb"[a-z\x80-\xff]+", t.encode().lower()))
        assert got[i].lang_pred == langs[int(share.argmax())] and abs(got[i].score - share.max()) < 1e-4
