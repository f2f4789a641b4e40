"""A corpus made ready for training: toxic documents and copies out, near copies out, personal data hidden, packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from doclog.llm import exact_dedup, ngram_join, packing, pii, toxicity
from doclog.llm.common import Scratch, normal_space


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic. Each is scored by itself, so rows that repeat share their fate."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels)
    return docs.where(toxicity.score(F.col("text"), model) < 0.5)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of those of equal text; of its rows with that text the first in order."""
    found = Scratch(spark, "pipeline").save(exact_dedup.exact_duplicates(docs))
    key = F.sha2(F.encode(normal_space(F.col("text")), "UTF-8"), 256)
    repeated = not found.groupBy("doc_id", "text_sha256").count().where("count > 1").isEmpty()
    kept = found.where("kept").select(F.col("doc_id").alias("_kept"), "text_sha256")
    same = docs["doc_id"].eqNullSafe(kept["_kept"]) & (key == kept["text_sha256"])
    out = docs.join(kept.hint("merge"), same, "left_semi")
    if not repeated:
        return out
    rows = Window.partitionBy("doc_id", F.col("_text_key")).orderBy("text")
    once = out.withColumn("_text_key", key).withColumn("_row", F.row_number().over(rows)).where("_row = 1")
    return once.select(*(F.col(f"`{c}`") for c in docs.columns))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies; of one id, one text."""
    gone = ngram_join.near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("_gone"), "text_hash")
    text = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    same = docs["doc_id"].eqNullSafe(gone["_gone"]) & (text == gone["text_hash"])
    return docs.join(gone.hint("merge"), same, "left_anti")


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind, n_chars of the new text; null texts keep theirs."""
    length = F.coalesce(F.char_length("text").cast("long"), "n_chars")
    return pii.redact(docs).withColumn("n_chars", length)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, a row per piece of a document."""
    return packing.pack_documents(docs, 2048, "word_bpe_49k.json", end_id=0)


STAGES = [
    ("toxicity", toxic),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("PII", private),
    ("best-fit packing", packed),
]

# The joins of texts are sort-merge joins at every size, so that the disk they need follows the input.

#: A kernel machine, MinHash and a tokenizer are not SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; each result is written to the shared folder and read back for the next."""
    scratch = Scratch(spark, "corpus")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.save(docs)
    return docs
