"""The corpus pipeline: five stages over the documents, each one operator of ``newsevents.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept; ``run`` writes each stage's table to the shared folder and reads
it again. All stages but the last return the columns of ``documents``; the last
returns each text's ids under the byte-level BPE vocabulary.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsevents.llm.bpe import encode
from newsevents.llm.common import documents, written
from newsevents.llm.decontamination import clean
from newsevents.llm.ngram_join import near_duplicates
from newsevents.llm.pii import pseudonymise
from newsevents.llm.quality_rules import quality
from newsevents.llm.queries import PII_KEY


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the risk-controlled cutoffs keep (op 7)."""
    judged = quality(docs, documents(spark, sf_dir, "doc_id", "quality", name="labels"), keep_rows=True)
    return judged.where("kept").select("row.*")


def near_duplicate_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates (op 6); a null id is a group of its own."""
    first = (near_duplicates(docs).where("doc_id = component_id or doc_id is null")
             .select(F.col("doc_id").alias("_id")).distinct())
    return docs.join(first, docs["doc_id"].eqNullSafe(first["_id"]), "left_semi")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (op 2)."""
    return clean(docs, documents(spark, sf_dir, "item_id", "text", name="benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal numbers, dates and addresses replaced (op 1); ``n_chars`` follows the text."""
    kinds = "kinds" + "_" * max(map(len, docs.columns))  # a name that no column has
    out = pseudonymise(docs, PII_KEY, kinds_col=kinds).drop(kinds)
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])).select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text (op 3): ``doc_id, n_tokens, ids`` and a digest of what they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode(docs, path, decoded=True).select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicate_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII pseudonyms", personal_data),
    ("byte-level BPE", byte_bpe),
]

#: SQL cannot state the merges, the certified cutoffs or the Feistel network; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
