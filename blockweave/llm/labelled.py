"""Bounded samples of labelled rows for the trained operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as an empty text."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, bound: int) -> DataFrame:
    """doc_id, text and label of at most ``bound`` labelled rows outside the held-out fold, chosen by a hash of the id.

    Rows without a label are left out; where labels or documents repeat an id, the largest label and text count.
    The id list is bounded, so the join broadcasts it.
    """
    ids = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (remainder("doc_id", modulus) != held_out))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id", F.lit(label)), "doc_id")
        .limit(bound)
    )
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.max("text").alias("text"))
