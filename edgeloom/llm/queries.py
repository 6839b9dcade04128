"""The registered queries of the operators: production parameters, whole tables, full results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.llm import (
    arc,
    centroids,
    conversations,
    decontam,
    exact,
    html,
    jaccard,
    language,
    lines,
    pieces,
    sharding,
    simhash,
    toxicity,
)
from edgeloom.storage import keep

N_SHARDS = 16
TOXIC_CATEGORIES = ["low_quality", "toxic", "toxic_low_quality"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jump consistent hashing of ``doc_id``; the law is ``key``."""
    rows = sharding.shards(table(spark, sf_dir, "documents"), N_SHARDS)
    slotted = sharding.with_slots(rows, "shard", ["doc_id", "size", "text_crc32"])
    return slotted.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select(
        "doc_id",
        "__lines.n_lines",
        "__lines.n_dropped",
        F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"),
    )


def toxic_labels(labels: DataFrame) -> DataFrame:
    """The two flags of ``labels`` and their conjunction as categories."""
    low, toxic = 1 - F.col("quality"), F.col("toxic")
    return labels.select(
        "doc_id",
        low.alias("low_quality"),
        toxic.alias("toxic"),
        (low * toxic).alias("toxic_low_quality"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = toxic_labels(table(spark, sf_dir, "labels"))
    chain = toxicity.train(docs, labels, TOXIC_CATEGORIES)
    found = toxicity.score(docs, chain)
    return found.select(
        "doc_id",
        *(F.col(f"{toxicity.COLUMN}.p_{c}").alias(f"p_{c}") for c in TOXIC_CATEGORIES),
        *(F.col(f"{toxicity.COLUMN}.{c}").alias(c) for c in TOXIC_CATEGORIES),
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs)
    found = language.label(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        language.held_out(F.col("doc_id")).alias("held_out"),
        F.col(f"{language.COLUMN}.lang").alias("lang_pred"),
        F.col(f"{language.COLUMN}.score").alias("score"),
    )


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = pieces.vocabulary_of(spark)
    both = pieces.decode(pieces.encode(docs, vocabulary), vocabulary)
    ids = F.col(pieces.COLUMN)
    return both.select(
        "doc_id",
        F.size(F.coalesce(ids, F.array().cast("array<int>"))).cast("bigint").alias("n_pieces"),
        F.sha2(F.encode(F.array_join(ids.cast("array<string>"), ","), "UTF-8"), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"),
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = arc.pages_through_archives(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    text = F.col(html.COLUMN)
    return found.select(
        "page_id", "url", text.alias("text"), F.length(text).cast("bigint").alias("n_chars")
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.dedup_exact(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles and 85 percent, as its contract says."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=85)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontam.contamination(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 centroids of 64 components, five rounds, as the contract says."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return centroids.cluster(vectors, dims=64, k=40, rounds=5, scale=256, salt="2:")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles and four bits, as the contract says."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, most=4)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repairs of the damaged conversations; those of which no row is left have zeros."""
    source = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = conversations.damage(source)
    found = keep(conversations.audits(rows), "audits")
    hashes = conversations.digests(conversations.repairs(rows, found))
    ids = source.select(F.col("conv_id").alias("id")).distinct()
    known = ids.join(found, F.col("id").eqNullSafe(found.conv_id), "left").drop("conv_id")
    both = known.join(hashes, F.col("id").eqNullSafe(hashes.conv_id), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return both.select(
        F.col("id").alias("conv_id"),
        *(F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_line_dedup,
        op3_toxicity,
        op4_language_id,
        op5_sentencepiece,
        op6_warc,
        op7_html_extraction,
        op8_exact_dedup,
        op9_ngram_jaccard_join,
        op10_decontamination,
        op11_centroid_clustering,
        op12_simhash,
        op13_conversation_repair,
    )
}
