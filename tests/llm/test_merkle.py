import hashlib
import random
import zlib

from newsevents.llm import merkle as M
from newsevents.llm.queries import QUERIES

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, p int, path string"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(digests):
    """Levels from the leaves to one digest."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 16 * 16
        out.append((level[run:i], level[i + 1:run + 16]))
        i //= 16
    return out


def plain(rows):
    """(doc_id, leaf, subroot, root, proof digest, folded root of the tampered row, verified) of each row."""
    by = {}
    for row in rows:
        by.setdefault(row[1], []).append(row)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        by[name].sort(key=lambda row: (row[0] is not None, row[0] or 0, plain_leaf(row)))
    trees = {name: tree([plain_leaf(row) for row in by[name]]) for name in names}
    top = tree([trees[name][-1][0] for name in names])
    out = []
    for p, name in enumerate(names):
        for i, row in enumerate(by[name]):
            path = siblings(trees[name], i) + siblings(top, p)
            held = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                held = (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))
            d = plain_leaf(held)
            for before, after in path:
                d = h("".join(before) + d + "".join(after))
            out.append((row[0], plain_leaf(row), trees[name][-1][0], top[-1][0], h("".join("".join(a + b) for a, b in path)), d, d == top[-1][0]))
    return sorted(out, key=str)


def query(spark, rows, tmp_path):
    spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    out = QUERIES["op13_merkle_manifest"](spark, str(tmp_path))
    return sorted((tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def some_rows(seed, n, sources):
    rnd = random.Random(seed)
    return [(k, rnd.choice(sources), rnd.choice(["en", None]), k * 3, rnd.choice(["Text Größe 中", "lower only", "ABC " * 50])) for k in range(n)]


def test_deep_trees(spark, tmp_path):
    # A source with most rows (three levels), others of 1, 16, 17 rows, and more than 16 sources (two levels on top).
    rows = [(k, "hot", "en", 1, f"Text {k}") for k in range(600)]
    rows += [(1000 + k, "s16", "en", 1, "T") for k in range(16)] + [(2000 + k, "s17", None, None, "T") for k in range(17)]
    rows += [(3000 + k, f"é{k}", "de", 2, None) for k in range(20)] + [(5000, None, None, None, None), (5001, "", "", 0, "")]
    assert query(spark, rows, tmp_path) == plain(rows)


def test_odd_rows(spark, tmp_path):
    rows = some_rows(1, 40, ["a", "B", None]) + [(None, "a", "en", 1, "No Id"), (None, "a", "en", 1, "No Id either"), (5, "a", "en", 1, "T"), (5, "a", "en", 1, "U")]
    rows += [(77, "b", "en", 1, "Twice")] * 40 + [(78, "long", "en", 1, "Very Long " * 100_000)]
    got = query(spark, rows, tmp_path)
    assert got == plain(rows)
    assert any(not r[6] for r in got)


def test_one_row(spark, tmp_path):
    rows = [(5, "a", "en", 1, "Text")]
    assert query(spark, rows, tmp_path) == plain(rows)


def test_empty_table(spark, tmp_path):
    assert query(spark, [], tmp_path) == []


def test_some_requests(spark, tmp_path):
    rows = some_rows(2, 700, ["a"] * 30 + [f"s{i}" for i in range(20)])
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    m = M.build(df.select("source", "doc_id", M.leaf_digest(*df.columns).alias("leaf")), str(tmp_path / "m"))
    asked = m.table("leaves").where("doc_id % 97 = 5").withColumnRenamed("leaf", "proof")  # a clashing name
    out = M.prove(m, asked.select("p", "r", "doc_id", asked["proof"].alias("_i")))
    want = {r[0]: r for r in plain(rows)}
    got = out.select("doc_id", "_i", "digest", "subroot", M.proof_digest().alias("d"), M.folded("digest").alias("f")).collect()
    assert len(got) == len([r for r in rows if r[0] % 97 == 5])
    for r in got:
        assert (r._i, r.subroot, r.f, r.d) == (want[r.doc_id][1], want[r.doc_id][2], m.root(), want[r.doc_id][4]) and r.digest == r._i
    none = M.prove(m, spark.createDataFrame([(0, 10**6), (10**6, 0)], "p long, r long"))
    assert none.where("digest is not null").count() == 0
