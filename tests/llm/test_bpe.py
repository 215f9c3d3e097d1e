import hashlib

import numpy as np
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers as P
from newsevents.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
CODER = bpe.Encoder(RANKS)
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def arrays(texts):
    raw = [t.encode() for t in texts]
    return (np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw]))


def pieces(texts):
    buf, off = arrays(texts)
    starts = bpe.token_bounds(buf, off).tolist() + [len(buf)]
    return [buf[a:b].tobytes().decode() for a, b in zip(starts, starts[1:])]


HAND = ["", "don't", "'tis 's", "  's", "\n's", "!'s", "we'll'd  \n\n x", "a \n", " \t ", "x'", "'", "''s", "'re've'r'v",
        "é1²½ Ⅷ中文 字", "a b　 c", "\x85x", "a" * 300, "!" * 200 + " " * 50, "tab\t\tend\t", "😀 😀😀'll"]


def test_bounds_by_hand():
    for t in HAND:
        assert pieces([t]) == regex.findall(P.PATTERN, t), t
    assert pieces(HAND) == [p for t in HAND for p in regex.findall(P.PATTERN, t)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'stmdrevl1a!é中"), st.characters(exclude_categories=["Cs"])), max_size=30), max_size=6))
def test_bounds_and_ids(texts):
    got = bpe.encode_batch(*arrays(texts), CODER)
    want = [np.array(ENC.encode_ordinary(t), "<u4").tobytes() for t in texts]
    # Unicode versions may class a few code points differently: compare where they agree.
    for t, g, w in zip(texts, got, want):
        if pieces([t]) == regex.findall(P.PATTERN, t):
            assert g == w


def test_long_piece_merges_like_the_short_way():
    rng = np.random.default_rng(1)
    short = ["".join(rng.choice(list("abcdeth é"), n)).encode() for n in rng.integers(1, 40, 500)]
    ids, count = bpe.merge_many(np.frombuffer(b"".join(short), np.uint8), np.array([len(p) for p in short]), CODER.pairs)
    ends = np.cumsum(count)
    for p, a, b in zip(short, ends - count, ends):
        assert ids[a:b].tolist() == bpe.merge(p, RANKS)
    for n in (48, 100, 5000):
        t = "".join(rng.choice(list("abcdeth"), n))
        assert bpe.merge(t.encode(), RANKS) == ENC.encode_ordinary(t)
    assert bpe.merge(b"=" * 3000, RANKS) == ENC.encode_ordinary("=" * 3000)


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, t, "x") for i, t in enumerate(HAND)] + [(None, "null id", "x"), (3, None, None), (3, None, None), (99, "word " * 200_000, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


def test_round_trip(frame):
    out = bpe.decode(bpe.encode(frame, PATH), PATH).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, bpe.encode(frame, PATH, decoded=True).collect()))
    assert len(out) == len(HAND) + 4
    texts = {(i, t or "") for i, t, _ in frame.collect()}
    for r in out:
        text = bytes(r.decoded).decode()
        assert (r.doc_id, text) in texts
        assert np.frombuffer(r.ids, "<u4").tolist() == ENC.encode_ordinary(text)
        assert r.n_tokens == len(r.ids) // 4


def test_empty_table(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_query(spark):
    from newsevents.llm.queries import QUERIES
    rows = {r.doc_id: r for r in QUERIES["op3_bpe"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = ENC.encode_ordinary(d.text or "")
        r = rows[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_hash_clash_and_full_cache(monkeypatch):
    texts = ["some words here", "other words there", "x" * 60]
    want = [np.array(ENC.encode_ordinary(t), "<u4").tobytes() for t in texts]
    monkeypatch.setattr(bpe, "CACHE_TOKENS", 4)
    small = bpe.Encoder(RANKS)
    assert [bpe.encode_batch(*arrays([t]), small)[0] for t in texts * 3] == want * 3
    monkeypatch.setattr(bpe, "token_keys", lambda buf, s, e: np.ones(len(s), np.int64))
    assert bpe.encode_batch(*arrays(texts), bpe.Encoder(RANKS)) == want
