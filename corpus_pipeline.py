"""A corpus from raw documents to token ids, stage by stage.

Each stage takes what the one before it kept; all but the last return the columns of
``documents``. A stage's rows are written to the shared folder and read again, so a lost
executor costs a stage's tasks, never the stages before it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.llm import byte_bpe, chosen_path, decision_list, decontaminate, secrets
from eventloom.llm.common import as_row, table
from eventloom.session import stage_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the decision list learned from ``labels``."""
    _, rules = decision_list.judge(docs, table(spark, sf_dir, "labels"))
    return decision_list.kept_rows(docs, rules)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest id.

    Of rows that share an id the first by text stays. Rows without id are in no class; all
    of them stay.
    """
    classes = chosen_path.join(docs)
    others = classes.where("doc_id != class_id").select("doc_id").distinct()
    first = Window.partitionBy("doc_id", F.when(F.col("doc_id").isNull(), F.xxhash64("text"))).orderBy("text")
    row = docs.join(others, "doc_id", "left_anti").select(as_row(docs).alias("_row"), "doc_id", "text")
    numbered = row.withColumn("_n", F.row_number().over(first))
    return numbered.where("_n = 1 or doc_id is null").select("_row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"), {"_row": as_row(docs)})
    return found.where("not contaminated").select("_row.*")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark and ``n_chars`` set anew where that was done."""
    found = secrets.scan_table(docs, {"_row": as_row(docs)}, clean=True)
    changed = F.coalesce(F.col("redacted") != F.col("_row.text"), F.lit(False))
    own = {
        "text": F.col("redacted"),
        "n_chars": F.when(changed, F.length("redacted").cast("bigint")).otherwise(F.col("_row.n_chars")),
    }
    return found.select(*[own.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids_sha256, decoded_sha256, ids) of every document."""
    return byte_bpe.round_trip(
        docs,
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
        {c: F.col(c) for c in ("doc_id", "lang", "source")},
        with_ids=True,
    )


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", one_of_near_copies),
    ("benchmark decontamination", decontamination),
    ("secret scans", without_secrets),
    ("byte-level BPE", token_ids),
]

# Learned rules, sampled paths and merges have no SQL form; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
