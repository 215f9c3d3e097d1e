import hashlib

import numpy as np
import public_tokenizers as P
import tiktoken
from pyspark.sql import types as T

import corpus_pipeline as C
from newsevents.llm import bpe

from . import test_decontamination as D
from . import test_ngram_join as J
from . import test_pii as I

SF = "/root/testdata/sf0.001"


def test_stages_in_order_against_plain_versions(spark):
    docs = spark.read.parquet(SF + "/documents.parquet")
    names = docs.columns
    kept = [f(spark, docs, SF) for _, f in C.STAGES[:1]][0]
    rows = kept.collect()
    assert kept.columns == names and 0 < len(rows) <= docs.count()
    # Near duplicates: one of each component of what the stage before it kept.
    joined = C.near_duplicate_join(spark, kept, SF)
    comp = J.plain([(r.doc_id, r.text) for r in rows])
    assert joined.columns == names and sorted(r.doc_id for r in joined.collect()) == sorted({c for _, _, c in comp})
    # Decontamination: what the search finds goes, the rest stays as it is.
    clean = C.benchmark_decontamination(spark, joined, SF)
    from newsevents.llm.decontamination import contaminated
    hit = {r.doc_id for r in contaminated(joined, spark.read.parquet(SF + "/benchmark.parquet")).collect()}
    left = {r.doc_id: r for r in clean.collect()}
    assert clean.columns == names and set(left) == {r.doc_id for r in joined.collect()} - hit
    # Pseudonyms.
    private = C.personal_data(spark, clean, SF)
    old, I.KEY = I.KEY, C.PII_KEY
    try:
        texts = {i: I.plain_text(r.text)[0] for i, r in left.items()}
    finally:
        I.KEY = old
    assert private.columns == names and dict(private.dtypes) == dict(docs.dtypes)
    assert {r.doc_id: (r.text, r.n_chars) for r in private.collect()} == {i: (t, len(t)) for i, t in texts.items()}
    # Ids.
    path = P.path("byte_bpe_multi_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    out = {r.doc_id: r for r in C.byte_bpe(spark, private, SF).collect()}
    assert set(out) == set(texts)
    for i, t in texts.items():
        assert np.frombuffer(out[i].ids, "<u4").tolist() == enc.encode_ordinary(t)
        assert out[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert sorted(tuple(r) for r in C.run(spark, SF).collect()) == sorted(tuple(r) for r in out.values())


def test_extra_columns_nulls_and_empty_table(spark):
    docs = spark.read.parquet(SF + "/documents.parquet").limit(40).selectExpr("*", "'x' as kept", "1 as component_id", "2 as pii", "3 as row", "4 as _id", "5 as __kinds", "6 as __new", "7 as _k1")
    odd = spark.createDataFrame([(None, "a few words that stand alone in a text of their own here", *[None] * 11),
                                 (7001, *[None] * 12)],
                                T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields]))
    for start in (docs.unionByName(odd), docs.limit(0)):
        now = start
        for _, stage in C.STAGES[:-1]:
            now = stage(spark, now, SF)
            assert now.columns == docs.columns
        assert C.STAGES[-1][1](spark, now, SF).count() <= start.count()
