import hashlib
import re

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsevents.llm import secret_scan as S

PATH = P.path("byte_bpe_50k.tiktoken")


def plain_base(text):
    """The contract's patterns one by one, in code points."""
    spans = []
    for m in re.finditer(r"(?a:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", _fold(text)):
        if len(m[2]) >= 6:
            spans.append((m.start(), 0, m.end()))
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(S.KINDS[k], s, e) for s, k, e in sorted(spans)]


def _fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


PARTS = ["password", "PassWD", "secret", "token", "api_key", "apikey", "\"", "'", " ", ":", "=", "abc12", "xyz", "é", "AKIA",
         "ABCDEFGH12345678", "0123456789abcdef", "deadbeef", "\n", "ſecret", "中"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), min_size=1, max_size=5))
def test_base_spans(texts):
    raw = [t.encode() for t in texts]
    buf, off = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])
    found = S.scan_slice(buf, off, S._tokenizer(PATH), S.MAX_RATIO) if len(buf) else {}
    for i, t in enumerate(texts):
        spans = S.in_code_points(buf[off[i]:off[i + 1]], found.get(i, []))
        got = [(s["kind"], s["start"], s["end"]) for s in spans if s["kind"] != "random"]
        assert got == plain_base(t)


def test_random_strings_and_known_ones():
    tok = S._tokenizer(PATH)
    assert S.is_random(b"xK9vQ2mZpL8rT4wYbN7cJ1hG", tok)
    for known in (b"d41d8cd98f00b204e9800998ecf8427e", b"123e4567-e89b-12d3-a456-426614174000", b"12345678901234567890123",
                  b"release-candidate-2024-final", b"Thequickbrownfoxjumpsoverit"):
        assert not S.is_random(known, tok)


def test_operator_cases(spark):
    rows = [(1, "a key xK9vQ2mZpL8rT4wYbN7cJ1hG here", "z"), (2, None, "z"), (3, "", "z"), (None, "token=abcdef", "z"),
            (4, "token=abcdef", "z"), (4, "token=abcdef", "z"), (5, "é " * 300_000 + "AKIA" + "A1" * 8, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = [(r.doc_id, [tuple(s) for s in r.spans]) for r in S.find_secrets(docs, PATH).collect()]
    assert sorted(out, key=str) == sorted([(1, [("random", 6, 30)]), (2, []), (3, []), (None, [("assign", 0, 12)]), (4, [("assign", 0, 12)]),
                                           (4, [("assign", 0, 12)]), (5, [("access", 600_000, 600_020)])], key=str)
    assert S.find_secrets(docs.limit(0), PATH).count() == 0


def test_query(spark):
    from newsevents.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op9_secrets"](spark, sf).collect()}
    docs = spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        base = plain_base(d.text or "")
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        r = got[d.doc_id]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for k, _, _ in base) for x in S.KINDS[:3]]
        assert [x for x in r.spans.split(",") if not x.startswith("random")] == joined.split(",")


def test_random_strings_behind_plain_words():
    tok = S._tokenizer(PATH)
    rng = np.random.default_rng(7)
    signs = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
    keys = ["".join(rng.choice(signs, 20)) for _ in range(200)]
    keys = [k for k in keys if any(c.isdigit() for c in k)]
    found = {}
    for name, before, after in (("bare", "", ""), ("assigned", "application_configuration_storage_credentials=", ""),
                                ("path", "/projects/production/deployment/configuration/", ""), ("inside", "release-candidate/", "/download_archive_folder"),
                                ("base", "deadbeefdeadbeefdeadbeef", "-")):
        n = 0
        for k in keys:
            raw = (before + ("/" if name == "base" else "") + k + after).encode()
            spans = S.scan_slice(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), tok, S.MAX_RATIO).get(0, [])
            at = raw.find(k.encode())
            n += any(kind == 3 and s <= at and at + 20 <= e for s, kind, e in spans)
            assert all(x[2] <= y[0] for x, y in zip(sorted(spans), sorted(spans)[1:]))
        found[name] = n / len(keys)
    assert found["bare"] >= 0.9 and all(x >= 0.9 for x in found.values()), found


def test_plain_runs_stay_clean():
    tok = S._tokenizer(PATH)
    for text in (b"/usr/local/share/applications/configuration", b"2024-11-30/archive_2023/report-final-version", b"This_is-a_long-identifier_with_many-words",
                 b"en/news/2024/index-of_pages/older", b"=" * 60, b"_" * 30 + b"name", b"a/b/c/d/e/f/g/h/i/j/k/l/m", b"0-1-2-3-4-5-6-7-8-9-10-11-12"):
        assert not S.random_parts(text, tok)
    assert S.random_parts(b"words/" * 200_000 + b"xK9vQ2mZpL8rT4wYbN7cJ1hG", tok) == [(1_200_000, 1_200_024)]
