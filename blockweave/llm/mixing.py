"""Mixing sources to target weights.

Each document gets a hash-random key; each source's documents are put in key order through ranges of the key,
distributed prefix sums of their sizes place every document on the source's axis of words, and the mix is cut exactly at
the source's budget.  A budget of several times the source repeats it: whole epochs first, then the prefix that remains.
The document that stands on the cut is taken in part, so that the words taken equal the floor of the target.

Targets: the sources in code point order (null last) weigh 5, 2, 1, repeating, and share the sum of all sizes.  A target
stops at ``MOST_EPOCHS`` times its source; the excess goes to the others by weight.  With sources in ascending order of
cap / weight, the capped ones are a prefix of that order, so that one window over the sources gives the level.

Edge cases: null texts and texts without words have size 0 and nothing taken; a null source is a source of its own;
repeated rows count each; an empty table gives an empty result.  The table of sources is expected to be small (one row a
source); documents never gather by source, since ranges of the key split each source.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockweave.llm import ragged
from blockweave.llm.shared import small_batches, written

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
#: Documents in a range of keys, on average, and ranges that are summed together before sources are.
RANGE_ROWS, SUPER = 2_000, 1_000


def sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, source and size: the number of words."""

    def count(batches):
        for batch in batches:
            for part, flat, off in ragged.chunks(batch, "text"):
                _, _, rows = ragged.words(flat, off)
                yield pa.record_batch([part.column("doc_id"), part.column("source"), pa.array(np.diff(rows).astype(np.int64))], names=["doc_id", "source", "size"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "source", F.col(text).alias("text")).mapInArrow(count, f"doc_id {kind}, source string, size long")


def targets(sized: DataFrame) -> DataFrame:
    """source, source_size, docs and target."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int"))
    total, weights = F.sum("source_size").over(Window.partitionBy()), F.sum("weight").over(Window.partitionBy())
    level = (total - F.coalesce(F.sum("cap").over(by_level), F.lit(0))).cast("double") / (weights - F.coalesce(F.sum("weight").over(by_level), F.lit(0)))
    sources = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * MOST_EPOCHS)
        .withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
        .withColumn("level", level)
        .withColumn("open", F.when(F.col("ratio") > F.col("level"), F.col("level")))
        .withColumn("open", F.max("open").over(Window.partitionBy()))
    )
    share = F.col("open") * F.col("weight")
    return sources.select("source", "source_size", "docs", F.when(F.col("open").isNull() | (F.col("ratio") <= F.col("open")), F.col("cap").cast("double")).otherwise(share).alias("target"))


def random_key(doc_id: str | Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))


def _starts(ranges: DataFrame) -> DataFrame:
    """of, rg, start: words before each range of its source, by sums over groups of ``SUPER`` ranges and then within each group."""
    grouped = ranges.withColumn("sup", F.floor(F.col("rg") / SUPER))
    within = Window.partitionBy("of", "sup").orderBy("rg").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("of").orderBy("sup").rowsBetween(Window.unboundedPreceding, -1)
    before = grouped.groupBy("of", "sup").agg(F.sum("range_size").alias("held")).select(F.col("of").alias("so"), F.col("sup").alias("ss"), F.coalesce(F.sum("held").over(over), F.lit(0)).alias("base"))
    inner = grouped.withColumn("part", F.coalesce(F.sum("range_size").over(within), F.lit(0)))
    joined = inner.join(before, F.col("of").eqNullSafe(F.col("so")) & (F.col("sup") == F.col("ss")))
    return joined.select("of", "rg", (F.col("base") + F.col("part")).alias("start"))


def mix(docs: DataFrame, seed: str = "mix", text: str = "text") -> DataFrame:
    """doc_id, size, source_size, target and taken of every document; also source and its random key."""
    sized = written(sizes(docs, text), "sizes")
    goal = targets(sized)
    keyed = sized.withColumn("key", random_key("doc_id", seed))
    at = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    goal = goal.select(F.col("source").alias("of"), "source_size", "target", F.ceil(F.col("docs") / RANGE_ROWS).alias("ranges"))
    placed = keyed.join(goal, keyed.source.eqNullSafe(goal.of), "left").drop("of").withColumn("range", F.floor(at * F.col("ranges")).cast("long"))
    starts = _starts(placed.groupBy(F.col("source").alias("of"), F.col("range").alias("rg")).agg(F.sum("size").alias("range_size")))
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = summed.join(starts, summed.source.eqNullSafe(starts.of) & (summed.range == starts.rg), "left")
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest("source_size", F.lit(1)))).otherwise(0)
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start") - F.col("inside")))
    return joined.select("doc_id", "source", "key", "size", "source_size", "target", (epochs * F.col("size") + part).cast("long").alias("taken"))


def mixture(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The documents that the mix takes, all columns, with ``mix_words`` (words taken) and ``mix_epochs`` (times it is read, the last perhaps in part).

    A document without words has nothing to take and passes with 0.  Rows that repeat a doc_id share their numbers' sums; null ids are
    one id.  Columns of the input that are called like the two new ones give way to them; an empty table gives an empty result.
    """
    numbers = mix(docs, seed).groupBy(F.col("doc_id").alias("mix_id")).agg(F.sum("taken").alias("words"), F.sum("size").alias("size"))
    numbers = numbers.where("words > 0 or size = 0")
    epochs = F.when(F.col("size") > 0, F.ceil(F.col("words") / F.greatest("size", F.lit(1)))).otherwise(0).cast("long")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    joined = rows.join(numbers, F.col("row.doc_id").eqNullSafe(F.col("mix_id")))
    own = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c.lower() not in ("mix_words", "mix_epochs")]
    return joined.select(*own, F.col("words").alias("mix_words"), epochs.alias("mix_epochs"))


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS pos FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(pos - 1) % 3 + 1] AS weight, 3 * source_size AS cap, (3 * source_size)::DOUBLE / [5, 2, 1][(pos - 1) % 3 + 1] AS ratio FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER p, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER p, 0)) AS level
  FROM w WINDOW p AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (SELECT *, max(CASE WHEN ratio > level THEN level END) OVER () AS open FROM l),
t AS (SELECT source, source_size, CASE WHEN open IS NULL OR ratio <= open THEN cap::DOUBLE ELSE open * weight END AS target FROM o),
c AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM c)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken FROM e
"""
