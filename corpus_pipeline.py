"""A training-data pipeline over ``documents``, stage by stage.

Language identification, line deduplication, near-duplicate removal, benchmark
decontamination, piece encoding. Each stage is written as Parquet and read again as the
next one's documents; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.llm import decontam, jaccard, language, lines, pieces
from edgeloom.storage import keep, use_local_folder

# A text goes if no language holds this share of its words.
MIN_LANGUAGE_SCORE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, and those of no prevailing language."""
    found = language.label(docs, language.train(docs))
    score, name = F.col(f"{language.COLUMN}.score"), F.col(f"{language.COLUMN}.lang")
    kept = found.where((name != language.UNKNOWN) & (score >= MIN_LANGUAGE_SCORE))
    return kept.select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that many documents share, and documents of which nothing is left."""
    found = lines.dedup_lines(docs)
    n_left = F.col("__lines.n_lines") - F.col("__lines.n_dropped")
    return _counted(found.where(n_left > 0).select(*docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each component: that of the least id, rows without one last, then by row.

    Rows count on their own, whatever their ids: a row that repeats a kept one goes, and a row
    with another text stays when one of the same id goes. Row numbers are written with the
    documents, as every reading of them has to find the same.
    """
    docs = keep(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    found = jaccard.near_duplicates(docs, key="__row")
    ids = docs.select("__row", "doc_id")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__row")
    first = found.join(ids, "__row").groupBy("component_id").agg(F.min(order).alias("first"))
    kept = first.select(F.col("first.__row").alias("__row"))
    return docs.join(kept, "__row", "left_semi").drop("__row")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which a window of a benchmark item occurs."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.drop_documents(docs, benchmark)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of each text, and whether they decode to the very text."""
    vocabulary = pieces.vocabulary_of(spark)
    both = pieces.decode(pieces.encode(docs, vocabulary), vocabulary)
    ids = F.col(pieces.COLUMN)
    return both.select(
        "doc_id",
        "lang",
        "source",
        ids.alias("piece_ids"),
        F.size(F.coalesce(ids, F.array().cast("array<int>"))).cast("bigint").alias("n_pieces"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"),
    )


def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars`` of the present text, where the column is there."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("sentencepiece", encode_pieces),
]

# Language identification is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder."""
    use_local_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
