"""Registered queries of the subpackage: name -> Spark callable, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsevents.llm.common import documents, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Key of the pseudonyms in the registered queries; a real job passes its own secret.
PII_KEY = "registered-query-key"


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


@query("op3_bpe")
def op3(spark, sf_dir):
    """Whole texts encoded by the multilingual rank file, then decoded from the ids."""
    import public_tokenizers

    from newsevents.llm.bpe import encode

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = encode(documents(spark, sf_dir, "doc_id", "text"), path, decoded=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op4_toxicity")
def op4(spark, sf_dir):
    """Toxicity of every whole text; learnt from rows that are not held out."""
    from newsevents.llm.toxicity import fit, held_out, score

    docs = documents(spark, sf_dir, "doc_id", "text")
    model = fit(docs, documents(spark, sf_dir, "doc_id", "toxic", name="labels"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score",
                                     (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op5_langid")
def op5(spark, sf_dir):
    """Language of every whole text; learnt from rows that are not held out."""
    from newsevents.llm.langid import fit, predict
    from newsevents.llm.toxicity import held_out

    model = fit(documents(spark, sf_dir, "doc_id", "text", "lang"))
    return predict(documents(spark, sf_dir, "doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "mix")


@query("op7_quality")
def op7(spark, sf_dir):
    """Counts, base verdict and risk-controlled verdict of every whole text; strata are the languages."""
    from newsevents.llm.quality_rules import quality

    out = quality(documents(spark, sf_dir, "doc_id", "text", "lang"), documents(spark, sf_dir, "doc_id", "quality", name="labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op9_secrets")
def op9(spark, sf_dir):
    """Secrets in every whole text, as counts and digests of their spans."""
    import public_tokenizers

    from newsevents.llm.secret_scan import find_secrets

    found = find_secrets(documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"))

    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@query("op1_pii")
def op1(spark, sf_dir):
    """Every whole text with its personal numbers, dates and addresses replaced by pseudonyms."""
    from newsevents.llm.pii import KINDS, pseudonymise

    out = pseudonymise(documents(spark, sf_dir, "doc_id", "text"), PII_KEY)
    return out.select("doc_id", "text", F.coalesce(F.size("pii").cast("long"), F.lit(0)).alias("n_pii"),
                      *[F.coalesce(F.expr(f"size(filter(pii, k -> k = '{kind}'))").cast("long"), F.lit(0)).alias(f"n_{kind}")
                        for kind in KINDS])


@query("op2_decontamination")
def op2(spark, sf_dir):
    """Every whole text against every benchmark item."""
    from newsevents.llm.decontamination import contaminated

    return contaminated(documents(spark, sf_dir, "doc_id", "text"), documents(spark, sf_dir, "item_id", "text", name="benchmark"))


@query("op6_ngram_join", r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM d),
-- Documents with one and the same set count once.
k AS (SELECT list_sort(s) AS s, len(s) AS n, min(doc_id) AS k FROM s WHERE len(s) > 0 GROUP BY ALL),
g AS (SELECT k, n, unnest(s) AS g FROM k),
i AS (SELECT a.k AS a, b.k AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS n FROM g a JOIN g b ON a.g = b.g AND a.k < b.k
      WHERE 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n) GROUP BY ALL),
l AS (SELECT a, b FROM i WHERE 100 * n >= 75 * (na + nb - n)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(k, c) AS (SELECT k, k FROM k UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.k WHERE r.c < e.b),
c AS (SELECT k, min(c) AS c FROM r GROUP BY k)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(c.c, s.doc_id) AS component_id
FROM s LEFT JOIN k ON k.s = list_sort(s.s) LEFT JOIN c ON c.k = k.k""")
def op6(spark, sf_dir):
    """Components of documents whose five-word shingles are alike."""
    from newsevents.llm.ngram_join import near_duplicates

    return near_duplicates(documents(spark, sf_dir, "doc_id", "text"))


@query("op8_chunk_dedup")
def op8(spark, sf_dir):
    """Spans of every whole text that occur earlier, by content-defined chunks."""
    from newsevents.llm.chunk_dedup import repeated_spans

    return repeated_spans(documents(spark, sf_dir, "doc_id", "text"))


@query("op10_suffix_dedup", r"""
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
t AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 200)) AS s FROM (SELECT doc_id, h, unnest(range(0, greatest(0, strlen(h) // 2 - 99))) AS i FROM h)),
f AS (SELECT s, min((doc_id, i)) AS f FROM t GROUP BY s HAVING count(*) > 1),
p AS (SELECT t.doc_id, t.i FROM t JOIN f ON t.s = f.s WHERE (t.doc_id, t.i) > f.f),
-- Starts less than 101 bytes apart make one removed run.
q AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 100, true) AS new FROM p),
n AS (SELECT doc_id, i, sum(new::INTEGER) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM q),
r AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS z FROM n GROUP BY ALL),
k AS (SELECT h.doc_id, any_value(h.h) AS h, coalesce(list({'a': r.a, 'z': r.z} ORDER BY r.a) FILTER (WHERE r.a IS NOT NULL), []) AS r FROM h LEFT JOIN r ON h.doc_id = r.doc_id GROUP BY h.doc_id)
SELECT doc_id, strlen(h) // 2 AS n_bytes, CAST(coalesce(list_sum([x.z - x.a FOR x IN r]), 0) AS BIGINT) AS n_removed, len(r) AS n_spans,
       sha256(unhex(array_to_string([substr(h, 2 * CAST(CASE WHEN j = 0 THEN 0 ELSE r[j].z END AS BIGINT) + 1,
                                            2 * CAST(CASE WHEN j = len(r) THEN strlen(h) // 2 ELSE r[j + 1].a END - CASE WHEN j = 0 THEN 0 ELSE r[j].z END AS BIGINT)) FOR j IN range(0, len(r) + 1)], ''))) AS kept_sha256
FROM k""")
def op10(spark, sf_dir):
    """Every whole text without the 100-byte strings that occur earlier."""
    from newsevents.llm.suffix_dedup import deduplicate

    out = deduplicate(documents(spark, sf_dir, "doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_token_files")
def op11(spark, sf_dir):
    """Every whole text as ids in token files, read back from them."""
    import public_tokenizers

    from newsevents.llm.token_files import checksums, read_tokens, write_tokens
    from newsevents.session import shared_dir

    path = shared_dir(spark, "tokens")
    write_tokens(documents(spark, sf_dir, "doc_id", "text"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return checksums(read_tokens(spark, path))


_TERMS_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query("op12_lexical_search", f"""
WITH d AS (SELECT doc_id, {_TERMS_SQL} AS terms FROM documents),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
m AS (SELECT doc_id, 25 + (75 * len(terms) * n_docs) // n_terms AS m FROM d, c WHERE len(terms) > 0),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, c GROUP BY term, n_docs),
i AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS_SQL}) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM i JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10""")
def op12(spark, sf_dir):
    """The ten best documents of every benchmark item, over all documents."""
    from newsevents.llm.lexical_search import search

    return search(documents(spark, sf_dir, "doc_id", "text"), documents(spark, sf_dir, "item_id", "text", name="benchmark"))


def _merkle_sql(levels: int = 6, top: int = 5) -> str:
    """The manifest and its proofs for sources of up to 16 ** ``levels`` rows and 16 ** ``top`` sources, level by level.

    A level passes on what has one node already. crc32 is stated bit by bit.
    """
    def value(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = "list_reduce(list_prepend(xor(a, c), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    crc = (f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), "
           f"lambda a, c: {bits}), 4294967295)")
    parts = [f"d AS (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS held FROM documents)",
             "r AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS p, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d)",
             "s0 AS (SELECT p, i, leaf AS h FROM r)"]
    run = "OVER (PARTITION BY p, i // 16 ORDER BY i ROWS BETWEEN"

    def tree(t: str, n: int) -> None:
        for k in range(n):
            parts.append(f"{t}n{k} AS (SELECT *, count(*) OVER (PARTITION BY p) AS n, "
                         f"coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before, "
                         f"coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM {t}{k})")
            parts.append(f"{t}{k + 1} AS (SELECT p, i // 16 AS i, CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {t}n{k} GROUP BY p, i // 16)")

    tree("s", levels)
    parts.append(f"t0 AS (SELECT 0 AS p, p AS i, h FROM s{levels})")
    tree("t", top)
    parts.append("f0 AS (SELECT *, held AS f, '' AS proof FROM r)")
    steps = [(f"sn{k}", f"n.p = f.p AND n.i = f.i // {16 ** k}") for k in range(levels)] + [(f"tn{k}", f"n.i = f.p // {16 ** k}") for k in range(top)]
    for k, (nodes, on) in enumerate(steps):
        parts.append(f"f{k + 1} AS (SELECT f.* REPLACE (CASE WHEN n = 1 THEN f ELSE sha256(before || f || after) END AS f, proof || before || after AS proof) FROM f{k} f JOIN {nodes} n ON {on})")
    return ("WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = t.h AS verified
FROM f{len(steps)} f JOIN s{levels} s ON s.p = f.p, t{top} t""")


@query("op13_merkle_manifest", _merkle_sql())
def op13(spark, sf_dir):
    """Manifest of all documents; the proof of every row, checked against a copy that is tampered with in every fifth."""
    from newsevents.llm.merkle import build, folded, leaf_digest, proof_digest, prove

    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    docs = documents(spark, sf_dir, "doc_id", "source", "lang", "n_chars", "text")
    rows = docs.select("source", "doc_id", leaf_digest(*fields, F.col("text")).alias("leaf"))
    manifest = build(rows)
    # What a reader of the tampered copy holds in place of the leaf.
    held = docs.where(changed).select("doc_id", leaf_digest(*fields, F.col("text")).alias("leaf"), leaf_digest(*fields, lower).alias("held")).distinct()
    requests = manifest.table("leaves").join(held, ["doc_id", "leaf"], "left").withColumn("held", F.coalesce("held", "leaf"))
    root = F.lit(manifest.root())
    return (prove(manifest, written(requests, "requests"))
            .select("doc_id", "leaf", "subroot", root.alias("root"), proof_digest().alias("proof_sha256"), folded("held").alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
