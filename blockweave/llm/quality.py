"""Quality classifier: hashed word n-gram logistic regression, trained by follow-the-regularised-leader updates.

A text's features are its words and word pairs, and the runs of one to three word shapes (letter case, final sign, length,
whether a word repeats the one before), all hashed to ``2**BITS`` weights; a feature weighs its count over the root of the
number of words.  Scores are sparse dot products over whole texts, summed by numpy over batches of texts.

Training uses at most ``TRAIN_ROWS`` labelled rows outside the held-out fold, chosen by a hash of the id; executors send
their hashed features to the driver, which runs the updates in id order, so that reruns give the same weights.

Edge cases: null and empty texts score by the bias and the marks of an empty text; without training rows every score is
0.5; repeated rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockweave.llm import labelled, ragged
from blockweave.llm.shared import small_batches

BITS = 18
#: Most labelled rows to train on.
TRAIN_ROWS = 4000
FOLDS, HELD_OUT = 3, 1
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.05

#: Kinds of byte for word shapes: other ASCII signs keep themselves.
_KIND = np.arange(256, dtype=np.int64)
_KIND[97:123] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[128:] = 4


def _shapes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A hash of each word's shape."""
    size = ends - starts
    second = _KIND[flat[np.minimum(starts + 1, ends - 1)]]
    before_last = _KIND[flat[np.maximum(ends - 2, starts)]]
    bucket = np.minimum(np.searchsorted([1, 2, 4, 8, 12, 20, 40], size), 7)
    same = np.zeros(len(size), dtype=np.int64)
    if len(size):
        same[1:] = hashes[1:] == hashes[:-1]
        heads = rows[:-1][np.diff(rows) > 0]
        same[heads] = 2
    code = ((((_KIND[flat[starts]] << 8 | second) << 8 | before_last) << 8 | _KIND[flat[ends - 1]]) << 3 | bucket) << 2 | same
    return ragged.mix(code.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))


def features(flat: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers and their rows, and each row's number of words."""
    starts, ends, rows = ragged.words(flat, off)
    hashes = ragged.range_hash(ragged.prefix_hash(flat), starts, ends)
    shapes = _shapes(flat, starts, ends, hashes, rows)
    n = np.diff(rows)
    found = [ragged.grams(hashes, rows, k) for k in (1, 2)] + [ragged.grams(shapes, rows, k) for k in (1, 2, 3)]
    some = np.flatnonzero(n > 0)
    for word in (rows[:-1][some], rows[1:][some] - 1):  # the first and the last word's shape, apart from the others
        found.append((ragged.mix(shapes[word] * np.uint64(3) + np.uint64(len(found))), some))
    found.append((ragged.mix(np.searchsorted([0, 5, 20, 100, 500, 2000], n).astype(np.uint64) + np.uint64(0xABCDEF)), np.arange(len(n))))
    value, row = np.concatenate([v for v, _ in found]), np.concatenate([r for _, r in found])
    return (value >> np.uint64(64 - BITS)).astype(np.int64), row, n


def _scale(n: np.ndarray) -> np.ndarray:
    return 1.0 / np.sqrt(np.maximum(n, 1))


def _collect(rows: DataFrame) -> pa.Table:
    """Distinct features with counts of each training row, hashed on the executors."""

    def hashed(batches):
        for batch in batches:
            for part, flat, off in ragged.chunks(batch, "text"):
                value, row, n = features(flat, off)
                key, count = np.unique(row << BITS | value, return_counts=True)
                cuts = np.searchsorted(key, np.arange(len(n) + 1) << BITS).astype(np.int32)
                index = pa.ListArray.from_arrays(cuts, pa.array((key & ((1 << BITS) - 1)).astype(np.int32)))
                weight = pa.ListArray.from_arrays(cuts, pa.array((count * np.repeat(_scale(n), np.diff(cuts))).astype(np.float32)))
                yield pa.record_batch([part.column("doc_id").cast(pa.string()), part.column("label"), index, weight], names=["doc_id", "label", "f", "x"])

    return rows.mapInArrow(hashed, "doc_id string, label int, f array<int>, x array<float>").toArrow()


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Weights and bias."""
    table = _collect(labelled.sample(docs, labels, label, FOLDS, HELD_OUT, bound)).combine_chunks()
    z, g = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_z = bias_g = 0.0

    def weight(z, g):
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(g)) / ALPHA + L2))

    if not table.num_rows:
        return np.zeros(1 << BITS, dtype=np.float32), 0.0
    ids = np.array(table.column("doc_id").to_pylist())
    order, y = np.lexsort((ids, np.char.str_len(ids))), table.column("label").to_numpy()
    order = order[np.argsort(ragged.mix(np.arange(len(order), dtype=np.uint64)))]
    f, x = (table.column(c).combine_chunks() for c in ("f", "x"))
    cuts, f, x = f.offsets.to_numpy(), f.values.to_numpy(), x.values.to_numpy().astype(np.float64)
    for _ in range(EPOCHS):
        for i in order:
            at, v = f[cuts[i] : cuts[i + 1]], x[cuts[i] : cuts[i + 1]]
            zi, gi = z[at], g[at]
            w = weight(zi, gi)
            bias = -bias_z / ((BETA + np.sqrt(bias_g)) / ALPHA)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ v + bias, -30, 30)))
            d = (p - y[i]) * v
            z[at] = zi + d - (np.sqrt(gi + d * d) - np.sqrt(gi)) / ALPHA * w
            g[at] = gi + d * d
            e = p - y[i]
            bias_z += e - (np.sqrt(bias_g + e * e) - np.sqrt(bias_g)) / ALPHA * bias
            bias_g += e * e
    return weight(z, g).astype(np.float32), float(-bias_z / ((BETA + np.sqrt(bias_g)) / ALPHA))


def probabilities(model: tuple[np.ndarray, float], flat: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The score of each text: sparse dot products through the logistic curve, to nine digits."""
    weights, bias = model
    value, row, n = features(flat, off)
    total = np.bincount(row, weights=weights[value], minlength=len(n)) * _scale(n) + bias
    return np.round(1.0 / (1.0 + np.exp(-np.clip(total, -30, 30))), 9)


def score(docs: DataFrame, model: tuple[np.ndarray, float], keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (by default doc_id) with ``score``."""
    keep = keep or ["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f"c{i}" for i in range(len(keep))]

    def run(batches):
        for batch in batches:
            for part, flat, off in ragged.chunks(batch, "__text"):
                yield pa.record_batch([*(part.column(c) for c in kept), pa.array(probabilities(shared.value, flat, off))], names=[*kept, "__score"])

    source = docs.select(*[docs[c].alias(k) for c, k in zip(keep, kept, strict=True)], docs["text"].alias("__text"))
    kinds = ", ".join(f"{k} {source.schema[k].dataType.simpleString()}" for k in kept)
    return source.mapInArrow(run, f"{kinds}, __score double").select(*[F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)], F.col("__score").alias("score"))


def op4_quality_classifier(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id",
        (labelled.remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score at least ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part, flat, off in ragged.chunks(batch, "text"):
                yield part.filter(pa.array(probabilities(shared.value, flat, off) >= threshold))

    return docs.mapInArrow(run, docs.schema)
