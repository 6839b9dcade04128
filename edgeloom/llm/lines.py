"""Line deduplication across documents.

Lines are exploded, normalised and hashed; the documents that hold a hash are
counted, and lines of keys held by many documents are dropped except in the
document with the largest id. Only hashes and positions are shuffled for that;
the texts meet the positions of their dropped lines once and are put together
from the stretches between them.

A key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z in
lower case, represented by two 64-bit hashes. A null text is one empty line,
like an empty text. Rows that share an id are one document; rows without an id
neither count nor lose lines. Extra columns are carried along.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.storage import keep

MIN_CHARS = 40
MIN_DOCS = 5
BLANKS = " \t\n\x0b\x0c\r"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else.

    ``lower`` does that for pure ASCII, much faster than ``translate``.
    """
    plain = F.octet_length(text) == F.length(text)
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(text)).otherwise(slow)


def _keys(docs: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """``(id, text_hash, at, h1, h2)`` of every line with a long enough key."""
    lines = docs.where(F.col(key).isNotNull()).select(
        F.col(key).alias("id"),
        F.xxhash64(text).alias("text_hash"),
        F.posexplode(F.split(ascii_lower(F.col(text)), "\n")).alias("at", "line"),
    )
    stripped = lines.where(F.length("line") >= min_chars).select(
        "id", "text_hash", "at", F.btrim("line", F.lit(BLANKS)).alias("line")
    )
    return stripped.where(F.length("line") >= min_chars).select(
        "id",
        "text_hash",
        "at",
        F.xxhash64("line").alias("h1"),
        F.xxhash64(F.lit(1), "line").alias("h2"),
    )


def _kept_text(text: Column, cuts: Column) -> Column:
    """The lines of ``text`` that are not at the sorted positions ``cuts``.

    Takes the stretches between the positions, so the work is linear in the
    number of lines. The one-element array binds the split text once.
    """
    bound = F.array(F.struct(F.split(text, "\n").alias("lines"), cuts.alias("cuts")))

    def joined(s: Column) -> Column:
        def stretch(i: Column) -> Column:
            begin = F.coalesce(F.get(s["cuts"], i - 1) + 1, F.lit(0))
            end = F.coalesce(F.get(s["cuts"], i), F.size(s["lines"]))
            return F.slice(s["lines"], begin + 1, end - begin)

        stretches = F.transform(F.sequence(F.lit(0), F.size(s["cuts"])), stretch)
        return F.array_join(F.flatten(stretches), "\n")

    return F.when(F.size(cuts) == 0, text).otherwise(F.transform(bound, joined)[0])


def dedup_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """``docs`` with repeated lines dropped from the text, and two counts.

    Adds ``__lines(n_lines, n_dropped)``, a struct of the number of lines
    before and the number of dropped lines. Null texts become empty.
    """
    docs = docs.withColumn(text, F.coalesce(F.col(text), F.lit("")))
    keys = keep(_keys(docs, key, text, min_chars), "line_keys")
    # The distinct count is planned by hash and document first, so that a line of very
    # many documents is summed up before its rows meet.
    repeated = keep(
        keys.groupBy("h1", "h2")
        .agg(F.countDistinct("id").alias("n"), F.max("id").alias("holder"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2", "holder"),
        "repeated_lines",
    )
    cuts = (
        keys.join(repeated, ["h1", "h2"])
        .where(F.col("id") != F.col("holder"))
        .groupBy("id", "text_hash")
        .agg(F.array_sort(F.collect_set("at")).alias("__cuts"))
        .withColumnsRenamed({"id": "__id", "text_hash": "__text_hash"})
    )
    same = (docs[key] == cuts["__id"]) & (F.xxhash64(docs[text]) == cuts["__text_hash"])
    joined = docs.join(cuts, same, "left")
    found = F.coalesce(cuts["__cuts"], F.array().cast("array<int>"))
    newlines = F.length(docs[text]) - F.length(F.replace(docs[text], F.lit("\n"), F.lit("")))
    counts = F.struct(
        (newlines + 1).cast("bigint").alias("n_lines"),
        F.size(found).cast("bigint").alias("n_dropped"),
    )
    return joined.select(
        *(
            _kept_text(docs[text], found).alias(text) if c == text else docs[c]
            for c in docs.columns
        ),
        counts.alias("__lines"),
    )
