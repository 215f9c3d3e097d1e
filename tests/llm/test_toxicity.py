import zlib

import numpy as np

from newsevents.llm import toxicity as T

SF = "/root/testdata/sf0.01"
CALM = ["the river runs by the old house", "rain fell on the quiet fields all day", "she read a long letter by the window",
        "market prices rose a little in spring", "the train left the station on time"]
RUDE = ["you are a stupid idiot", "what a pathetic worthless clown", "shut up you stupid moron", "such disgusting trash and scum"]


def model():
    rng = np.random.default_rng(1)
    calm = [" ".join(rng.choice(CALM, 4)) for _ in range(120)]
    rude = [" ".join([*rng.choice(CALM, 2), rng.choice(RUDE), *rng.choice(CALM, 1)]) for _ in range(60)]
    return T.train([t.encode() for t in calm + rude], np.array([0] * 120 + [1] * 60))


def test_worst_windows_by_hand():
    margin, rows = np.array([1.0, 5, 0, 2, 9, 9]), np.array([0, 0, 0, 0, 0, 2])
    got = T.worst_windows(margin, rows, 4, width=2)
    assert got[0] == 5.5 and np.isnan(got[1]) and got[2] == 9 and np.isnan(got[3])


def test_train_needs_both_classes():
    assert T.train([b"a b", b"c"], np.array([0, 0])) is None
    assert T.train([b"", b"..."], np.array([0, 1])) is None


def test_cases(spark):
    m = model()
    rows = [(1, CALM[0], 1), (2, "you stupidd idiott", 0), (3, None, 0), (4, "", 0), (5, ".,;", 0), (None, RUDE[0], 0), (1, CALM[0], 1),
            (6, "calm words here " * 100_000 + RUDE[1], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = [(r.doc_id, r.score) for r in T.score(docs, m).collect()]
    by = dict(got)
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, s in got)
    assert by[3] == by[4] == by[5] == 0.0
    assert by[1] < 0.3 and by[2] > 0.5 and by[None] > 0.5 and by[6] > 0.5
    assert [r.score for r in T.score(docs, None).collect()] == [0.0] * len(rows)
    assert T.score(docs.limit(0), m).count() == 0


def test_held_out_accuracy_and_no_leak(spark):
    docs = spark.read.parquet(SF + "/documents.parquet")
    labels = spark.read.parquet(SF + "/labels.parquet")
    # Held-out labels turned around must change nothing.
    flipped = labels.withColumn("toxic", T.F.when(T.held_out(), 1 - T.F.col("toxic")).otherwise(T.F.col("toxic")))
    from newsevents.llm.queries import QUERIES
    got = {r.doc_id: r for r in QUERIES["op4_toxicity"](spark, SF).collect()}
    again = {r.doc_id: r.score for r in T.score(docs, T.fit(docs, flipped)).collect()}
    assert {i: r.score for i, r in got.items()} == again
    right = n = 0
    for r in labels.collect():
        held = zlib.crc32(str(r.doc_id).encode()) % 4 == 2
        assert got[r.doc_id].held_out == held
        assert got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.3)
        if held:
            n += 1
            right += got[r.doc_id].predicted == r.toxic
    assert right / n > 0.9  # some labels of these tables are wrong


def test_a_class_of_long_texts_is_learnt(spark):
    rng = np.random.default_rng(3)
    calm = [" ".join(rng.choice(CALM, 4)) for _ in range(200)]
    rude = [" ".join(rng.choice(RUDE + CALM[:1], 240)) for _ in range(60)]
    assert min(map(len, rude)) > T.SAMPLE_CHARS
    rows = [(i, t) for i, t in enumerate(calm + rude)] + [(1000, "..."), (1001, "  " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 200)) for i in range(260)] + [(1000, 1), (1001, 1)], "doc_id long, toxic int")
    m = T.fit(docs, labels)
    got = {r.doc_id: r.score for r in T.score(docs, m).collect()}
    assert m is not None and np.mean([got[i] > 0.5 for i in range(200, 260)]) > 0.95 and np.mean([got[i] < 0.3 for i in range(200)]) > 0.95
    # Few long texts beside enough short ones do not crowd them out, and the sample's bound holds.
    assert T.fit(docs, labels, sample_rows=(50, 20), sample_chars=200) is not None


def test_score_against_plain_version(spark):
    """The score of a small fixed model, n-gram by n-gram."""
    rng = np.random.default_rng(6)
    m = T.Model(rng.normal(size=T.BUCKETS).astype(np.float32), 0.3, 1.7, -0.4)

    def bucket(gram):
        h = 0
        for b in gram:
            h = (h * 0x100000001B3 + b) % 2**64
        h = (h + len(gram)) % 2**64
        h ^= h >> 31
        h = h * 0x9E3779B97F4A7C15 % 2**64
        return (h >> 33) % 2**31 % T.BUCKETS if (h >> 33) < 2**31 else (h >> 33) % T.BUCKETS

    def margin(word):
        w = b"<" + word + b">"
        grams = [w[i:i + n] for n in range(T.LOW, T.HIGH + 1) for i in range(len(w) - n + 1)]
        return float(np.mean([m.table[bucket(g)] for g in grams])) if grams else 0.0

    def plain(text):
        import re
        words = re.findall(rb"[a-z0-9@$\x80-\xff]+", (text or "").encode().lower())
        if not words:
            return 0.0
        z = [margin(w) for w in words]
        worst = max(np.mean(z[i:i + T.WINDOW]) for i in range(max(1, len(z) - T.WINDOW + 1)))
        return float(1 / (1 + np.exp(-np.clip(m.slope * (worst + m.bias) + m.shift, -40, 40))))

    texts = [*CALM, *RUDE, "one", "", None, "Größe über ALLES", "a b", "x", "m@il $100", "!?", " ".join(CALM * 30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in T.score(docs, m).collect()}
    for i, t in enumerate(texts):
        assert abs(got[i] - plain(t)) < 1e-4, t
