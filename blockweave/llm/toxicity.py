"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, maps homoglyphs (Cyrillic, Greek, full-width) to Latin letters and digits inside words to the letters they
stand for, drops invisible characters, and turns everything that is no letter into a space.  Lexicon terms start at a word's
start; a term either ends at the word's end or is a prefix.  Of the terms that match at one place the heaviest counts once, and a
place inside an exception phrase doesn't count.  The sum of weights, by itself and over the root of the number of words, goes
through a logistic curve.

The lexicon starts from ``SEEDS`` and learns terms and weights as smoothed log-odds from one half of at most ``TRAIN_ROWS`` labelled
rows outside the held-out fold; the curve is fitted on the other half.  At most ``TERMS`` terms are kept (a model parameter).

Edge cases: null and empty texts score by the curve's intercept; without labels the seeds and a fixed curve score; repeated rows
score alike; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockweave.llm import labelled
from blockweave.llm.shared import small_batches, written

TRAIN_ROWS = 12_000
TERMS = 2000
FOLDS, HELD_OUT = 5, 0
PREFIXES = (4, 5, 6, 7)
LEAST_ROWS, LEAST_ODDS = 4, np.log(12.0)
SEED_WEIGHT = 3.0
#: Intercept, sum of weights, sum over the root of words.
DEFAULT_CURVE = (-3.0, 1.0, 1.0)

SEEDS = (
    "idiot", "stupid", "moron", "trash", "pathetic", "loser", "worthless", "disgusting", "clown", "scum",
    "dumb", "imbecile", "vermin", "filthy", "despicable", "jerk", "bastard", "asshole", "bitch", "whore", "slut",
)
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "clown car", "stupid simple", "idiot proof", "idiot light", "pond scum", "sore loser rule", "dumb bell", "dumb waiter", "soda jerk")

_FOLD = {
    **dict(zip(map(ord, "абвгезикмнорстухцьѕіјһԁԛԝ"), "abbre3ukmhopctyxubsijhdqw", strict=True)),
    **dict(zip(map(ord, "αβγεηικνορτυχωϲ"), "abyenikvoptuxwc", strict=True)),
    **{0xFF41 + i: chr(97 + i) for i in range(26)},
    **dict(zip(map(ord, "0134578"), "oieastb", strict=True)),
    **{c: None for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)},
}
_FOLD[ord("з")] = "e"
_NO_LETTER = re.compile(r"[\W\d_]+")


def fold(text: str) -> str:
    """Folded words, each with one space before it, and a space at the end."""
    return " " + _NO_LETTER.sub(" ", text.lower().translate(_FOLD)).strip() + " "


def _terms(folded: str) -> set[str]:
    """Whole words as " word ", prefixes as " pref"."""
    found = set()
    for word in set(folded.split()):
        if len(word) > 2:
            found.add(f" {word} ")
            for n in PREFIXES:
                if len(word) > n:
                    found.add(f" {word[:n]}")
    return found


def automaton(weights: dict[str, float]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in EXCEPTIONS:
        found.add_word(f" {phrase} ", (len(phrase) + 2, None))
    for term, weight in weights.items():
        found.add_word(term, (len(term), weight))
    found.make_automaton()
    return found


def lexicon_sum(found: ahocorasick.Automaton, folded: str) -> float:
    """Sum over places of the heaviest term there, without those in exception phrases."""
    places: dict[int, float] = {}
    excused = []
    for end, (size, weight) in found.iter(folded):
        start = end - size + 1
        if weight is None:
            excused.append((start, end))
        elif weight > places.get(start, 0.0):
            places[start] = weight
    excused.sort()
    total, i, until = 0.0, 0, -1  # until: where the exceptions that begin at or before a place reach to
    for at in sorted(places):
        while i < len(excused) and excused[i][0] <= at:
            until = max(until, excused[i][1])
            i += 1
        if at >= until:
            total += places[at]
    return total


def _counted(rows: DataFrame) -> DataFrame:
    def count(batches):
        for batch in batches:
            toxic, clean = Counter(), Counter()
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
                (toxic if label else clean).update(_terms(fold(text)))
            terms = list(toxic)
            yield pa.record_batch([pa.array(terms, pa.string()), pa.array([toxic[t] for t in terms], pa.int64()), pa.array([0] * len(terms), pa.int64())], names=["term", "toxic", "clean"])
            terms = list(clean)
            yield pa.record_batch([pa.array(terms, pa.string()), pa.array([0] * len(terms), pa.int64()), pa.array([clean[t] for t in terms], pa.int64())], names=["term", "toxic", "clean"])

    return rows.mapInArrow(count, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Weights of terms by their log-odds between toxic and other rows; seeds that rows don't show keep their weight."""
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    weights = {f" {s} ": SEED_WEIGHT for s in SEEDS}
    if toxic < LEAST_ROWS or not clean:
        return weights
    odds = F.log((F.col("toxic") + 0.5) / F.lit(toxic + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(clean + 1.0))
    seeds = F.col("term").isin([f" {s} " for s in SEEDS])
    kept = _counted(rows).withColumn("odds", odds).where((F.col("toxic") >= LEAST_ROWS) & ((F.col("odds") >= float(LEAST_ODDS)) | seeds))
    best = kept.orderBy((F.col("odds") * F.sqrt("toxic")).desc(), "term").limit(TERMS).collect()
    for r in best:
        shrink = r["toxic"] / (r["toxic"] + 4.0)
        weights[r["term"]] = max(0.0, float(r["odds"]) * shrink)
    return weights


def _sums(rows: DataFrame, weights: dict[str, float], keep: str) -> DataFrame:
    """Adds the lexicon sum and the number of words, in place of the text."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)
    kind = rows.schema[keep].dataType.simpleString()

    def run(batches):
        found = automaton(shared.value)
        for batch in batches:
            total, n = [], []
            for text in batch.column("text"):
                folded = fold(text.as_py() or "")
                total.append(lexicon_sum(found, folded))
                n.append(folded.count(" ") - 1 if len(folded) > 2 else 0)
            yield pa.record_batch([batch.column(keep), pa.array(total, pa.float64()), pa.array(n, pa.int64())], names=[keep, "total", "n"])

    return rows.select(keep, "text").mapInArrow(run, f"{keep} {kind}, total double, n long")


def _signals(total: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(total)), np.minimum(total, 60.0) / 10.0, total / np.sqrt(np.maximum(n, 1))], axis=1)


def fit_curve(y: np.ndarray, total: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton's steps; weights of signals don't go below zero."""
    x, w = _signals(total, n), np.array(DEFAULT_CURVE)
    if y.sum() < LEAST_ROWS or (1 - y).sum() < LEAST_ROWS:
        return w
    ridge = np.diag([1e-3, 1e-2, 1e-2])
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -2, 2)
    w[1:] = np.maximum(w[1:], 0)
    return w


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = TRAIN_ROWS) -> tuple[dict[str, float], np.ndarray]:
    """The lexicon's weights and the curve."""
    rows = written(labelled.sample(docs, labels, label, FOLDS, HELD_OUT, bound), "labelled")
    half = F.xxhash64("doc_id", F.lit("half")) % 2 == 0
    weights = learn_lexicon(rows.where(half))
    table = _sums(rows.where(~half), weights, "label").orderBy("label", "total", "n").toArrow()
    return weights, fit_curve(*(table.column(c).to_numpy().astype(float) for c in ("label", "total", "n")))


def score(docs: DataFrame, model: tuple[dict[str, float], np.ndarray]) -> DataFrame:
    weights, (a, b, c) = model
    signal = F.lit(float(a)) + F.lit(float(b)) * F.least("total", F.lit(60.0)) / 10 + F.lit(float(c)) * F.col("total") / F.sqrt(F.greatest("n", F.lit(1)))
    return _sums(docs, weights, "doc_id").select("doc_id", F.round(1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), signal)))), 9).alias("score"))


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id",
        (labelled.remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
