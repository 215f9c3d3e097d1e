import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
import public_tokenizers

from newsevents.llm import token_files as T
from newsevents.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, start string, ids string"


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [0]


def written(spark, rows, path, **how):
    T.write_tokens(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3), path, PATH, **how)
    return path


def test_round_trip(spark, tmp_path, plain):
    rows = [(i, f"text number {i} " * (i % 5)) for i in range(60, 0, -1)]
    rows += [(None, "no id"), (None, None), (7, "same id"), (8, "twice"), (8, "twice"), (90, None), (91, ""), (92, "<|endoftext|> é中 \x00"), (93, "ab" * 200_000)]
    path = written(spark, rows, str(tmp_path / "t"))
    out = T.read_tokens(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in out] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k or 0))
    assert sorted((str(r.doc_id), tuple(r.ids)) for r in out) == sorted((str(k), tuple(plain(t))) for k, t in rows)
    at = 0
    for r in out:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        at += r.n_tokens


def test_empty_table(spark, tmp_path):
    path = written(spark, [], str(tmp_path / "t"))
    assert T.read_tokens(spark, path).collect() == [] and T.select_range(spark, path, 0, 9).collect() == []
    assert T.select_documents(spark, path, 0, 9).collect() == []


def test_layout(spark, tmp_path):
    rows = [(i, f"words of text {i} are words of a text " * 40) for i in range(6000)]
    path = written(spark, rows, str(tmp_path / "t"), file_bytes=3 << 20, row_group_bytes=100 << 10)
    files = sorted((tmp_path / "t" / "tokens").glob("part-*.parquet"))
    assert len(files) >= 3
    meta = pq.ParquetFile(files[0]).metadata
    group = meta.row_group(0)
    assert meta.num_row_groups > 1
    of = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert any("DICTIONARY" in e for e in of["ids.list.element"].encodings)
    for c in ("doc_id", "start", "n_tokens"):
        assert "DELTA_BINARY_PACKED" in of[c].encodings and of[c].has_column_index and of[c].has_offset_index
    plan = T.read_tokens(spark, path).select("doc_id", "n_tokens")._jdf.queryExecution().toString()
    assert "ids" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_selective(spark, tmp_path, plain):
    rows = [(i, "word " * (i % 7) + str(i)) for i in range(300)]
    path = written(spark, rows, str(tmp_path / "t"))
    got = T.select_documents(spark, path, 17, 130)
    assert sorted((r.doc_id, list(r.ids)) for r in got.collect()) == [(k, plain(t)) for k, t in rows[17:131]]
    assert "GreaterThanOrEqual(doc_id,17)" in got._jdf.queryExecution().toString()
    whole = [i for _, t in rows for i in plain(t)]
    for a, z in ((0, 5), (3, 400), (777, 778), (0, 10**9), (len(whole) - 3, len(whole)), (len(whole), 10**9)):
        part = T.select_range(spark, path, a, z).orderBy("start").collect()
        assert [i for r in part for i in r.ids] == whole[a:z]
        assert not part or part[0].start == a


def test_query(spark, plain):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op11_token_files"](spark, sf).collect()}
    at = 0
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    assert len(got) == len(rows)
    for k, text in rows:
        ids = plain(text)
        assert (got[k].start, got[k].n_tokens, got[k].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_split_is_the_library_s(plain):
    """The token bounds are those of the library for every code point beside a letter, a number, a sign and spaces."""
    import pyarrow as pa

    coder = T._encoder(open(PATH, "rb").read())
    texts = [f"a{chr(c)}1{chr(c)}!{chr(c)} {chr(c)}" for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    at = 0
    for ids, count in coder.rows(pa.array(texts)):
        assert ids.tolist() == [i for e in coder._batch(texts[at:at + len(count)]) for i in e]
        at += len(count)
    assert at == len(texts)


def test_other_kinds_encode_whole_texts():
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    coder = T.LibraryEncoder(open(path, "rb").read())
    texts = ["Some WORDS, and more", None, ""]
    (ids, count), = coder.rows(pa.array(texts))
    assert not coder.by_token and ids.tolist() == [i for x in texts for i in t.encode(x or "", add_special_tokens=False).ids] and count[1:].tolist() == [0, 0]
