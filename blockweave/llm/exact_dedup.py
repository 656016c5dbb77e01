"""Exact deduplication by two-pass Bloom filtering.

Texts are equal when identical after each run of ASCII white space became one space; null counts as empty.
The first pass sets each text hash's bits and keeps those that more than one row set; the second finds the rows whose
bits are all kept.  Only these possibly repeated rows shuffle.  The others pass straight through as groups of one.
The filter has a size bound (``bloom.MAX_BITS``); beyond it more rows shuffle, and the result stays the same.

Edge cases: an empty table gives an empty result; null and empty texts are copies of each other; rows that repeat
a ``doc_id`` with an equal text all count in ``group_size``, and all those with the smallest id are ``kept`` by
``mark`` while ``drop_copies`` returns one of them; a null ``doc_id`` stays only if its group has no other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockweave.llm import bloom
from blockweave.llm.shared import small_batches, written


def normalised(text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _filter(hashes: DataFrame, column: str) -> tuple:
    bits = bloom.size_for(hashes.count())
    return bloom.repeated(hashes, column, bits), bits


def mark(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    sha = F.sha2(normalised(text).cast("binary"), 256)
    hashed = written(docs.select(F.col(doc_id).alias("doc_id"), F.unhex(sha).alias("sha")), "hashes")
    words, bits = _filter(hashed, "sha")
    tested = bloom.may_repeat(hashed, F.col("sha"), words, bits, "may_repeat")
    maybe = tested.where("may_repeat").drop("may_repeat")
    groups = maybe.groupBy("sha").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    shuffled = maybe.join(written(groups, "groups"), "sha")  # apart from the aggregate, so that a hot group's join can be split
    single = tested.where("not may_repeat").select("sha", "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    return single.unionByName(shuffled).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each group of equal texts: that of the smallest ``doc_id``."""
    key = F.xxhash64(normalised(text))
    hashed = written(docs.select(key.alias("key")), "hashes")
    words, bits = _filter(hashed, "key")
    names = docs.columns
    row = docs.select(F.struct(*[docs[c] for c in names]).alias("row"))
    norm = normalised(F.col(f"row.`{text}`"))
    tested = bloom.may_repeat(row, F.xxhash64(norm), words, bits, "may_repeat")
    maybe = tested.where("may_repeat").withColumn("sha", F.sha2(norm.cast("binary"), 256))
    order = F.struct(F.col(f"row.`{doc_id}`").isNull(), F.col(f"row.`{doc_id}`"), F.xxhash64("row"))
    kept = maybe.groupBy("sha").agg(F.min_by("row", order).alias("row")).select("row")
    return tested.where("not may_repeat").select("row").unionByName(kept).select("row.*")


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return mark(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
