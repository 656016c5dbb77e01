"""Token counts of byte-level BPE by rank-synchronous array merging.

Texts are split into pre-tokens by numpy passes over their code points (letters, numbers, other signs, white space, and the
English contractions).  Pre-tokens that a batch shows for the first time are held as one ragged array of symbols; each round
looks every neighbouring pair's rank up, finds each sequence's lowest rank, and merges that pair in all sequences at
once, until no sequence has a pair left; the surviving symbols are counted.  Counts of pre-tokens seen before come from a
bounded cache in the worker, by their bytes; within a batch equal pre-tokens meet by hash and are compared by their bytes.  Strings of added special tokens inside a text count as one token each, as the library does by
default.  Whole texts are counted, without truncation.

Edge cases: null and empty texts have 0 bytes and 0 tokens; repeated rows count alike; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from blockweave.llm import ragged
from blockweave.llm.shared import small_batches

LIMIT = 512
#: Most pre-tokens in a worker's cache; it is emptied when full.
CACHE = 400_000
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: Unicode's White_Space, fixed values.
WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def load(path: str) -> dict:
    """Arrays of a byte-level BPE file: symbol of each byte, merges by pair, special strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    whole = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    marked = any(t.get(k) for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized"))
    if spec.get("normalizer") or not plain or not whole or marked:
        raise ValueError("the file asks for steps that aren't those of byte-level BPE with the usual split")
    vocab, merges = model["vocab"], model["merges"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow from 256 on
    hidden = [b for b in range(256) if b not in set(shown)]
    char = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    width = max(vocab.values()) + 1
    keys = np.array([vocab[a] * width + vocab[b] for a, b in pairs], dtype=np.int64)
    order = np.argsort(keys)
    return {
        "width": width,
        "bytes": np.array([vocab[char[b]] for b in range(256)], dtype=np.int64),
        "keys": keys[order],
        "ranks": order.astype(np.int64),
        "merged": np.array([vocab[a + b] for a, b in pairs], dtype=np.int64),
        "special": [t["content"].encode() for t in spec.get("added_tokens", [])],
    }


def merge_counts(model: dict, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Symbols that survive in each range of bytes."""
    n = len(starts)
    size = ends - starts
    counts = size.copy()
    seq = np.repeat(np.arange(n), size)
    at = np.arange(len(seq)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(starts, size)
    symbol = model["bytes"][flat[at]]
    keys, ranks, merged, width = model["keys"], model["ranks"], model["merged"], model["width"]
    none = len(merged)
    while len(symbol):
        pair = symbol[:-1] * width + symbol[1:]
        found = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        rank = np.where((keys[found] == pair) & (seq[:-1] == seq[1:]), ranks[found], none)
        rank = np.append(rank, none)
        heads = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
        lowest = np.minimum.reduceat(rank, heads)
        length = np.diff(np.append(heads, len(seq)))
        best = np.repeat(lowest, length)
        hit = (rank == best) & (best < none)
        # where hits follow one another (a run of one symbol), every second one merges
        first = hit & ~np.append(False, hit[:-1])
        place = np.arange(len(hit))
        hit &= (place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 0
        gone = np.append(False, hit[:-1])
        symbol = np.where(hit, merged[np.minimum(best, none - 1)], symbol)
        counts[seq[heads]] = length - np.add.reduceat(gone.astype(np.int64), heads)
        keep = ~gone & (best < none)
        symbol, seq = symbol[keep], seq[keep]
    return counts


def _classes() -> np.ndarray:
    kinds = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
    for c in range(sys.maxunicode + 1):
        first = unicodedata.category(chr(c))[0]
        kinds[c] = LETTER if first == "L" else NUMBER if first == "N" else OTHER
    kinds[WHITE] = SPACE
    return kinds


def pretokens(kinds: np.ndarray, flat: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the pre-tokens of all rows, in order."""
    if not len(flat):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    code = np.frombuffer(flat.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    lead = np.flatnonzero((flat & 0xC0) != 0x80)
    n = len(code)
    edge = np.zeros(n + 1, dtype=bool)
    edge[np.searchsorted(lead, off)] = True
    kind = kinds[code]
    run = np.ones(n, dtype=bool)
    run[1:] = (kind[1:] != kind[:-1]) | edge[1:n]
    mark = run.copy()
    blank = code == 0x20
    inner = ~edge[1:n]  # between places i and i + 1 no row ends
    mark[1:] &= ~((kind[1:] != SPACE) & blank[:-1] & inner)
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & inner)
    mark[last] = True  # the last white space before a sign starts a pre-token of its own or the sign's
    for at in np.flatnonzero((code == 0x27) & mark):
        if at + 1 < n and not edge[at + 1] and kind[at + 1] == LETTER:
            ahead = code[at + 1]
            two = (ahead, code[at + 2]) if at + 2 < n and not edge[at + 2] else (0, 0)
            k = 1 if ahead in (115, 116, 109, 100) else 2 if two in ((114, 101), (118, 101), (108, 108)) else 0
            if k:
                mark[at + 1] = False
                if at + 1 + k < n:
                    mark[at + 1 + k] = True
    starts = lead[mark]
    return starts, np.append(starts[1:], len(flat))


class Counter:
    """Counts tokens of batches of texts, keeping counts of pre-tokens."""

    def __init__(self, model: dict, cache: int = CACHE):
        self.model, self.limit, self.kinds, self.known = model, cache, _classes(), {}

    def _count(self, flat: np.ndarray, off: np.ndarray) -> np.ndarray:
        starts, ends = pretokens(self.kinds, flat, off)
        if not len(starts):
            return np.zeros(len(off) - 1, dtype=np.int64)
        keys, first, inverse = np.unique(ragged.range_hash(ragged.prefix_hash(flat), starts, ends), return_index=True, return_inverse=True)
        if not ragged.agree(flat, starts, ends, first[inverse]).all():  # hashes of different pre-tokens agree: each counts for itself
            return ragged.row_sums(merge_counts(self.model, flat, starts, ends), np.searchsorted(starts, off))
        data = flat.tobytes()
        texts = [data[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        counts = np.fromiter(map(self.known.get, texts, [0] * len(texts)), dtype=np.int64, count=len(texts))
        new = np.flatnonzero(counts == 0)
        if len(new):
            counts[new] = merge_counts(self.model, flat, starts[first[new]], ends[first[new]])
            if len(self.known) + len(new) > self.limit:
                self.known = {}
            self.known.update((texts[i], n) for i, n in zip(new.tolist(), counts[new].tolist(), strict=True) if len(texts[i]) <= 100)
        return ragged.row_sums(counts[inverse], np.searchsorted(starts, off))

    def __call__(self, flat: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Tokens of each row; special strings split the text and are a token each."""
        text, specials = flat.tobytes(), []
        for special in self.model["special"]:
            at = text.find(special)
            while at >= 0:
                if np.searchsorted(off, at, "right") == np.searchsorted(off, at + len(special) - 1, "right"):
                    specials.append((at, at + len(special)))
                    at = text.find(special, at + len(special))
                else:
                    at = text.find(special, at + 1)
        if not specials:
            return self._count(flat, off)
        row = np.searchsorted(off, [a for a, _ in specials], "right") - 1
        cuts = np.unique(np.concatenate([off, np.array(specials, dtype=np.int64).ravel()]))
        is_special = np.isin(cuts[:-1], [a for a, _ in specials])
        pieces = self._count(flat, cuts)
        owner = np.searchsorted(off, cuts[:-1], "right") - 1
        out = np.bincount(owner, weights=np.where(is_special, 0, pieces), minlength=len(off) - 1).astype(np.int64)
        return out + np.bincount(row, minlength=len(off) - 1)


def count(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(load(path))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        counter = Counter(shared.value)
        for batch in batches:
            for part, flat, off in ragged.chunks(batch, "text"):
                tokens = counter(flat, off)
                yield pa.record_batch([part.column("doc_id"), pa.array(np.diff(off)), pa.array(tokens), pa.array(tokens > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    import public_tokenizers

    return count(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
