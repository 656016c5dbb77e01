"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

An item is contained in a document when the document has at least ``CONTAINMENT`` of the item's distinct five-word shingles
(A-Z lower-cased; an item of fewer words is one shingle of its own length).  Items are partitioned by their number of
shingles, and an item's sketch is its smallest shingle hashes, as many as its partition asks for: one more than the
shingles that a containing document may lack, so that a hit is certain.  A document looks its own shingles up among the
sketches; pairs that meet and have enough equal hashes are verified by exact containment of the words themselves.  Documents
never shuffle and no pair of documents is ever made.

The items are a stated query set: they are sent to the executors in blocks of at most ``BLOCK_SHINGLES`` shingles (one
larger item is a block), each block meeting all rows.

Edge cases: null and empty texts and items match nothing; an item that repeats gives a pair each; a document row that
repeats gives its pairs again; very long texts are searched whole; empty tables give an empty result; further columns play
no part in ``search`` and are kept by ``drop_contaminated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockweave.llm import ragged
from blockweave.llm.shared import small_batches

K = 5
CONTAINMENT = (80, 100)
BLOCK_SHINGLES = 2_000_000


def sketch_size(n: int) -> int:
    """Hashes in the sketch of an item of n shingles, by the upper end of its size partition (powers of two)."""
    partition = 1 << max(0, n - 1).bit_length()
    lacking = partition * (CONTAINMENT[1] - CONTAINMENT[0]) // CONTAINMENT[1]
    return min(n, lacking + 1)


class Index:
    """Sketches, shingle hashes and texts of a block of items."""

    def __init__(self, items: list[tuple]):
        """items: id, ascending distinct shingle hashes, words in a shingle, text as bytes."""
        self.items = items
        self.sizes = sorted({k for _, _, k, _ in items})
        self.k = np.array([k for _, _, k, _ in items], dtype=np.int64)
        keys = [np.sort(s)[: sketch_size(len(s))] for _, s, _, _ in items]
        key = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        of = np.repeat(np.arange(len(items)), [len(k) for k in keys])
        order = np.argsort(key, kind="stable")
        self.keys, self.of = key[order], of[order]
        self.hint = np.zeros(1 << 16, dtype=bool)
        self.hint[(self.keys >> np.uint64(48)).astype(np.int64)] = True

    def candidates(self, grams: dict) -> np.ndarray:
        """Rows and items that share a hash of the item's sketch."""
        found = [np.empty((0, 2), np.int64)]
        for k, (value, row) in grams.items():
            maybe = np.flatnonzero(self.hint[(value >> np.uint64(48)).astype(np.int64)])
            lo = np.searchsorted(self.keys, value[maybe], "left")
            n = np.searchsorted(self.keys, value[maybe], "right") - lo
            item = self.of[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            pair = np.stack([np.repeat(row[maybe], n), item], axis=1)
            found.append(np.unique(pair[self.k[item] == k], axis=0))
        return np.concatenate(found)

    def pairs(self, flat: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, item's number, shared shingles) of each pair that is contained."""
        hashes, rows = ragged.word_hashes(flat, off)
        grams = {k: ragged.grams(hashes, rows, k) for k in self.sizes}
        sets, maybe = {}, []
        for r, i in self.candidates(grams).tolist():
            _, want, k, _ = self.items[i]
            if (r, k) not in sets:
                value, row = grams[k]
                sets[r, k] = np.unique(value[np.searchsorted(row, r) : np.searchsorted(row, r + 1)])
            if CONTAINMENT[1] * int(np.isin(want, sets[r, k], assume_unique=True).sum()) >= CONTAINMENT[0] * len(want):
                maybe.append((k, r, i))
        return sorted(self._exact(flat, off, maybe))

    def _exact(self, flat: np.ndarray, off: np.ndarray, maybe: list[tuple[int, int, int]]):
        """The same pairs by their words, some at a time."""
        maybe.sort()
        at = 0
        while at < len(maybe):
            k, size, end = maybe[at][0], 0, at
            while end < len(maybe) and maybe[end][0] == k and (end == at or size < ragged.CHUNK_BYTES):
                size += int(off[maybe[end][1] + 1] - off[maybe[end][1]]) + len(self.items[maybe[end][2]][3])
                end += 1
            some = maybe[at:end]
            texts = [flat[off[r] : off[r + 1]] for _, r, _ in some]
            items = [np.frombuffer(self.items[i][3], np.uint8) for _, _, i in some]
            sides = [(np.concatenate(x), np.cumsum([0, *map(len, x)])) for x in (texts, items)]
            _, wanted, shared = ragged.shared_shingles(*sides, k)
            for (_, r, i), n, both in zip(some, wanted.tolist(), shared.tolist(), strict=True):
                if CONTAINMENT[1] * both >= CONTAINMENT[0] * n:
                    yield r, i, both
            at = end


def item_sets(table: pa.Table) -> list[tuple]:
    """id, distinct shingle hashes, shingle length and text of each item with words."""
    out = []
    for batch in table.to_batches():
        for part, flat, off in ragged.chunks(batch, "text"):
            value, rows = ragged.shingle_sets(flat, off, K)
            _, _, word_rows = ragged.words(flat, off)
            n = np.diff(word_rows)
            for i, item in enumerate(part.column("item_id").to_pylist()):
                if n[i]:
                    out.append((item, value[rows[i] : rows[i + 1]], int(min(K, n[i])), flat[off[i] : off[i + 1]].tobytes()))
    return out


def indexes(spark, items: DataFrame) -> Iterator[tuple]:
    """The broadcast index of each block of items, and the type of their ids."""
    total = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-int(total) // (BLOCK_SHINGLES * 4)))
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).select("item_id", "text").toArrow()
        yield spark.sparkContext.broadcast(Index(item_sets(block))), block.schema.field("item_id").type


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_shingles (the item's), n_shared of each contained pair."""
    spark = docs.sparkSession
    kinds = [dict(docs.dtypes)["doc_id"], dict(items.dtypes)["item_id"]]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, n_shingles long, n_shared long"
    source = docs.select("doc_id", "text")
    result = None
    for index, item_type in indexes(spark, items):

        def run(batches, index=index, item_type=item_type):
            for batch in batches:
                for part, flat, off in ragged.chunks(batch, "text"):
                    pairs = index.value.pairs(flat, off)
                    chosen = [index.value.items[i] for _, i, _ in pairs]
                    yield pa.record_batch(
                        [
                            part.column("doc_id").take(pa.array([r for r, _, _ in pairs], pa.int64())),
                            pa.array([c[0] for c in chosen], item_type),
                            pa.array([len(c[1]) for c in chosen], pa.int64()),
                            pa.array([s for _, _, s in pairs], pa.int64()),
                        ],
                        names=["doc_id", "item_id", "n_shingles", "n_shared"],
                    )

        found = source.mapInArrow(run, schema)
        result = found if result is None else result.unionByName(found)
    return result


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no item; each row is judged by its own text, whatever its id."""
    for index, _ in indexes(docs.sparkSession, items):

        def run(batches, index=index):
            for batch in batches:
                for part, flat, off in ragged.chunks(batch, "text"):
                    keep = np.ones(part.num_rows, dtype=bool)
                    keep[[r for r, _, _ in index.value.pairs(flat, off)]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op8_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "item_id", "n_shingles", "n_shared", F.round(F.col("n_shared") / F.col("n_shingles"), 6).alias("containment"))


SQL = r"""
WITH i AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
s AS (SELECT DISTINCT item_id, least(5, len(w)) AS k, unnest(list_transform(range(1, len(w) - least(5, len(w)) + 2), lambda x: array_to_string(w[x : x + least(5, len(w)) - 1], ' '))) AS g FROM i WHERE len(w) > 0),
n AS (SELECT item_id, count(*) AS n_shingles FROM s GROUP BY item_id),
d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda x: array_to_string(w[x : x + k - 1], ' '))) AS g
  FROM d, (SELECT DISTINCT k FROM s) WHERE len(w) >= k),
c AS (SELECT g.doc_id, s.item_id, count(*) AS n_shared FROM g JOIN s ON g.k = s.k AND g.g = s.g GROUP BY ALL)
SELECT doc_id, item_id, n_shingles, n_shared, round(n_shared / n_shingles, 6) AS containment
FROM c JOIN n USING (item_id) WHERE 100 * n_shared >= 80 * n_shingles
"""
