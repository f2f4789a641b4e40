"""One query for each operator of this package, over the whole table it is meant for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, divergence, exact_dedup, line_rules, ngram_join, packing, pii, revisits, secret_scan, shards
from . import token_counts, toxicity, transducer


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_documents(spark, sf_dir))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.best_fit_shards(_documents(spark, sf_dir), shards=8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = transducer.encode_decode(_documents(spark, sf_dir), "byte_bpe_50k.json", keep=["doc_id"])
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, sf_dir), limit=512, tokenizer="byte_bpe_50k.json")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_documents(spark, sf_dir), n=5, threshold=0.8)


def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.line_rules(_documents(spark, sf_dir))


def _digest(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Numbers of the fixed forms by kind, and all spans as text."""
    names = F.array(*(F.lit(k) for k in kinds))

    def listed(spans) -> Column:
        text = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
        return F.array_join(text, ",")

    def number(kind: int) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(number(n).alias(f"n_{kind}") for n, kind in enumerate(kinds)),
        F.sha2(listed(F.col("base_spans")), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("base_spans", "added_spans"))).alias("spans"),
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(pii.find_personal_data(_documents(spark, sf_dir)), pii.KINDS)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), 2048, "word_bpe_49k.json", end_id=0)


#: Seconds between two pages of the crawl, and from a page to its revisit.
PAGE_STEP, REVISIT_AFTER = 60, 86_400


def archive_records(pages: DataFrame) -> DataFrame:
    """A crawl of `pages` in id order as archive records: each page as a response, and a revisit of it a day later.

    Every third revisit confirms the page's entity tag, every third confirms it weakly, every third has another one;
    which response it meets depends on the pages that the URL had meanwhile.
    """
    tag = F.concat(F.lit('"'), F.md5(F.encode("html", "UTF-8")), F.lit('"'))
    sent = F.col("page_id") * PAGE_STEP
    part = F.pmod("page_id", F.lit(3))
    tag_again = F.when(part == 0, tag).when(part == 1, F.concat(F.lit("W/"), tag)).otherwise('"other"')

    def headers(**values) -> Column:
        return F.create_map(*(x for k, v in values.items() for x in (F.lit(k.replace("_", "-")), v.cast("string"))))

    def record(number: int, kind: str, url: Column, date: Column, status: int, made: Column) -> Column:
        return F.struct(
            (F.col("page_id") * 2 + number).alias("record_id"),
            F.lit(kind).alias("type"),
            url.alias("url"),
            date.alias("date"),
            F.lit(status).alias("status"),
            made.alias("headers"),
            F.when(F.lit(number == 0), F.sha1(F.encode("html", "UTF-8"))).alias("digest"),
        )

    first = headers(
        cache_control=F.lit("max-age=60"),
        content_length=F.octet_length("html"),
        content_type=F.lit("text/html"),
        date=sent,
        etag=tag,
    )
    again = headers(
        cache_control=F.lit("max-age=120"), content_length=F.lit(0), date=sent + REVISIT_AFTER, etag=tag_again
    )
    records = F.array(
        record(0, "response", F.col("url"), sent, 200, first),
        record(1, "revisit", F.concat(F.col("url"), F.lit("#again")), sent + REVISIT_AFTER, 304, again),
    )
    return pages.select(F.inline(records))


def op10_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = revisits.resolve_revisits(archive_records(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return resolved.withColumn("headers", F.array_join(lines, ";"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(_documents(spark, sf_dir))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(secret_scan.find_secrets(_documents(spark, sf_dir)), secret_scan.KINDS)


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_sharding": op2_sharding,
    "op3_bpe": op3_bpe,
    "op4_token_counts": op4_token_counts,
    "op5_toxicity": op5_toxicity,
    "op6_ngram_join": op6_ngram_join,
    "op7_line_rules": op7_line_rules,
    "op8_pii": op8_pii,
    "op9_packing": op9_packing,
    "op10_revisits": op10_revisits,
    "op11_centroids": op11_centroids,
    "op12_divergence": op12_divergence,
    "op13_secrets": op13_secrets,
}
