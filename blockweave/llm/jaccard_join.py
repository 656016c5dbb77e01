"""N-gram Jaccard join: a size-aware heavy-light join on five-word shingles, and the components of its links.

Documents with equal words form a class, and only classes go on.  Two classes are candidates when they share a key:

* a small set enumerates all subsets of ``SUBSET`` of its extended prefix, the ``n - ceil(0.8 n) + SUBSET`` smallest shingle
  hashes; sets that link share at least that many of them, so that no link is missed;
* a large set has an inverted list for each of its smallest hashes.  Where two sets that link differ by ``d`` elements, they share
  one of the first ``d + 1`` elements of their union.  The lists go that far for the largest ``d`` that a set can have, and
  ``n / 8`` elements further, so that no link is missed either;
* the boundary between them is the size at which the keys of all sets, as their sizes are distributed, are the fewest; sets
  within a factor 0.8 below it do both.

Lists are scanned in two rounds.  First each list links its members to its smallest one (a star, linear in the list).  After
verification and components, the second round compares, within lists that still hold several components, the members of
different components; a parity bitmap of each set, as wide as its size asks for, bounds the symmetric difference from below and
prunes pairs exactly.
A set with so few lists of more than ``HOT`` members that it must share another list with whatever it links to, by the ``n / 8``
elements to spare, is left out of those; lists of more than ``BLOCK`` members that remain are compared by blocks, and only
blocks whose sizes can link meet.  Surviving pairs are verified by their words, not by hashes.

Components come from alternating large-star and small-star steps, each stored; nothing gathers on the driver.

Edge cases: null, empty and wordless texts have no shingles and link with nothing, their component is their own id; fewer
than five words make one shingle; rows that repeat a ``doc_id`` are one document; a null ``doc_id`` links with nothing and has
a null component; very long texts count whole; empty tables give empty results; further columns play no part in
``membership`` and are kept by ``drop_near_copies``.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockweave.llm import bloom, ragged
from blockweave.llm.shared import release, small_batches, written

K = 5
SUBSET = 2
#: Words of the narrowest and the widest bitmap; there is a bit for each element in between.
NARROW, WIDE = 16, 1024
#: Pairs of a list that are compared at once.
PAIRS = 200_000
#: Largest size whose sets may enumerate subsets; the boundary is at most this.
MOST_SMALL = 64
#: Members beyond which a list is hot, members of a list that are compared at once, and ways that a hot list's join is split.
HOT, BLOCK, SALTS = 50, 2000, 16
CLASS = ["h1", "h2", "h3", "h4"]


def least(n: np.ndarray) -> np.ndarray:
    """Least overlap of a set of n with any set that it links to."""
    return (80 * n + 99) // 100


def apart(n):
    """Most elements that a set of n and one that it links to don't share."""
    return (n + 5 * n // 4) // 9


def lists_of(n):
    """Elements that a large set of n has lists for."""
    return np.minimum(n, apart(n) + 1 + n // 8)


def subsets_of(n):
    """Subsets that a small set of n enumerates."""
    prefix = np.minimum(n, n - least(n) + SUBSET)
    return prefix * (prefix - 1) // 2


def boundary(sizes: dict[int, int]) -> int:
    """The largest size of small sets, at which all sets of these sizes (size: number) have the fewest keys."""
    n = np.array(sorted(k for k in sizes if 1 < k <= MOST_SMALL), dtype=np.int64)
    weight = np.array([sizes[k] for k in n.tolist()], dtype=np.int64)
    cost = [int((weight * (np.where(n <= b, subsets_of(n), 0) + np.where(5 * n > 4 * b, lists_of(n), 0))).sum()) for b in range(1, MOST_SMALL + 1)]
    return 1 + int(np.argmin(cost))


def set_keys(value: np.ndarray, rows: np.ndarray, small: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and their rows; a row's keys differ."""
    n = np.diff(rows)
    keys, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    few = np.flatnonzero((n >= 2) & (n <= small))
    if len(few):
        prefix = np.minimum(n[few], n[few] - least(n[few]) + SUBSET)
        for i in range(int(prefix.max())):
            for j in range(i + 1, int(prefix.max())):
                has = few[prefix > j]
                keys.append(ragged.mix(value[rows[has] + i] * np.uint64(0x9E3779B97F4A7C15) + value[rows[has] + j]))
                owners.append(has)
    many = np.flatnonzero((5 * n > 4 * small) | (n == 1))
    if len(many):
        count = lists_of(n[many])
        owner = np.repeat(many, count)
        at = np.repeat(rows[many], count) + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        keys.append(ragged.mix(value[at] ^ np.uint64(0xD1B54A32D192ED03)))
        owners.append(owner)
    return np.concatenate(keys), np.concatenate(owners)


def bitmaps(value: np.ndarray, rows: np.ndarray) -> pa.Array:
    """Parity of the number of elements in each bucket, as binary for each set: a power of two of words with a bit for each element."""
    n = np.diff(rows)
    width = np.clip(1 << np.ceil(np.log2(np.maximum(n, 1) / 64)).clip(0).astype(np.int64), NARROW, WIDE)
    out = [b""] * len(n)
    for w in np.unique(width).tolist():
        some = np.flatnonzero(width == w)
        owner = np.repeat(np.arange(len(some)), n[some])
        at = np.arange(len(owner)) - np.repeat(np.cumsum(n[some]) - n[some], n[some]) + np.repeat(rows[some], n[some])
        bucket = (value[at] >> np.uint64(7)).astype(np.int64) & (64 * w - 1)
        odd = np.bincount(owner * (64 * w) + bucket, minlength=len(some) * 64 * w).astype(np.uint8) & 1
        for i, packed in zip(some.tolist(), np.packbits(odd.reshape(len(some), -1), axis=1), strict=True):
            out[i] = packed.tobytes()
    return pa.array(out, pa.binary())


class Bits:
    """Bitmaps of a column, by width."""

    def __init__(self, column: pa.Array):
        flat, off = ragged.buffers(column)
        self.width = np.diff(off) // 8
        self.place, self.held = np.zeros(len(column), np.int64), {}
        for w in np.unique(self.width).tolist():
            some = np.flatnonzero(self.width == w)
            self.place[some] = np.arange(len(some))
            self.held[w] = np.ascontiguousarray(flat[off[some][:, None] + np.arange(8 * w)]).view(np.uint64)

    def take(self, i: np.ndarray, own: int, w: int) -> np.ndarray:
        """Rows i, all of the width ``own``, folded to the width w."""
        out = self.held[own][self.place[i]]
        while out.shape[1] > w:
            out = out[:, : out.shape[1] // 2] ^ out[:, out.shape[1] // 2 :]
        return out


def could_link(n_a: np.ndarray, n_b: np.ndarray, a: Bits, i: np.ndarray, b: Bits, j: np.ndarray) -> np.ndarray:
    """Whether sizes and bitmaps leave it open that the sets i of a and j of b link: exact pruning."""
    open_ = 5 * np.minimum(n_a, n_b) >= 4 * np.maximum(n_a, n_b)
    kinds = a.width[i] << 20 | b.width[j]
    for kind in np.unique(kinds[open_]).tolist():
        w_a, w_b = kind >> 20, kind & (1 << 20) - 1
        w = min(w_a, w_b)
        some = np.flatnonzero(open_ & (kinds == kind))
        for at in range(0, len(some), max(1, (1 << 18) // max(w_a, w_b))):
            part = some[at : at + max(1, (1 << 18) // max(w_a, w_b))]
            apart_ = np.bitwise_count(a.take(i[part], w_a, w) ^ b.take(j[part], w_b, w)).sum(axis=1, dtype=np.int64)
            open_[part] = 9 * apart_ <= n_a[part] + n_b[part]
    return open_


def _digests(flat: np.ndarray, off: np.ndarray) -> np.ndarray:
    """SHA-256 of each text's words with one space between them, A-Z lower-cased, as four signed numbers a row."""
    data = flat.tobytes()
    out = b"".join(hashlib.sha256(b" ".join(data[a:b].lower().split())).digest() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True))
    return np.frombuffer(out, dtype="<i8").reshape(-1, 4)


def profiles(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, the digest of the words, and a bitmap of the set."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            for part, flat, off in ragged.chunks(batch, "text"):
                value, rows = ragged.shingle_sets(flat, off, K)
                digest = np.ascontiguousarray(_digests(flat, off).T)
                yield pa.record_batch([part.column("doc_id"), pa.array(np.diff(rows)), *map(pa.array, digest), bitmaps(value, rows)], names=["doc_id", "n_shingles", *CLASS, "bits"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_shingles long, h1 long, h2 long, h3 long, h4 long, bits binary")


def _classes(every: DataFrame) -> tuple[DataFrame, tuple]:
    """Classes (digest, rep, n, bits), and what tells a representative's row: two filters with their bits.

    As in exact deduplication, a filter of digests that may repeat sends only those rows to a shuffle.
    """
    some = every.where("n_shingles > 0 and doc_id is not null")
    size = bloom.size_for(some.count())
    places = F.explode(F.array(*[F.col(h).bitwiseAND(F.lit(size - 1)) for h in CLASS[:2]])).alias("slot")
    again = bloom.bitmap(some.select(places).groupBy("slot").count().where("count > 1"), size)
    shared = every.sparkSession.sparkContext.broadcast(again)

    @F.arrow_udf("boolean")
    def repeats(first: pa.Array, second: pa.Array) -> pa.Array:
        return pa.array(bloom.holds(shared.value, first.to_numpy() & (size - 1), second.to_numpy() & (size - 1)))

    tested = some.withColumn("again", repeats("h1", "h2"))
    single = tested.where("not again").select(*CLASS, F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "bits")
    grouped = tested.where("again").groupBy(*CLASS).agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bits").alias("bits"))
    grouped = written(grouped, "repeated")
    reps_size = bloom.size_for(grouped.count())
    return written(single.unionByName(grouped), "classes"), (again, size, bloom.present(grouped, "rep", reps_size), reps_size)


def _slots(key: Column, bits: int) -> list[Column]:
    """The places of a key, which is a hash itself, in a filter."""
    return [key.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(key, 32).bitwiseAND(F.lit(bits - 1))]


def _filter(keys: DataFrame) -> tuple[np.ndarray, int]:
    """A filter of the column ``key``, of bounded size, and its bits."""
    bits = bloom.size_for(keys.count())
    return bloom.bitmap(keys.select(F.explode(F.array(*_slots(F.col("key"), bits))).alias("slot")), bits), bits


def _held(found: tuple[np.ndarray, int], key: np.ndarray) -> np.ndarray:
    """Whether a filter of keys holds each key."""
    words, last = found[0], np.uint64(found[1] - 1)
    return bloom.holds(words, key & last, key >> np.uint64(32) & last)


def _postings(docs: DataFrame, filters: tuple, small: int, only: tuple | None = None, hot: tuple | None = None) -> DataFrame:
    """key and rep: the keys of the classes, from their representatives' texts, or those of them that a filter holds.

    With a filter of hot keys also whether it holds the key: told here, so that a task has one Python worker.

    A copy that the filters take for a representative only adds links to its own class.
    """
    again, size, reps, reps_size = filters
    shared = docs.sparkSession.sparkContext.broadcast((again, reps, only, hot))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        again, reps, only, hot = shared.value
        for batch in batches:
            for part, flat, off in ragged.chunks(batch, "text"):
                digest = _digests(flat, off)
                mine = bloom.holds(reps, part.column("first").to_numpy(), part.column("second").to_numpy())
                mine |= ~bloom.holds(again, digest[:, 0] & (size - 1), digest[:, 1] & (size - 1))
                part = part.filter(pa.array(mine))
                if part.num_rows:
                    value, rows = ragged.shingle_sets(*ragged.buffers(part.column("text")), K)
                    key, owner = set_keys(value, rows, small)
                    if only is not None:
                        held = _held(only, key)
                        key, owner = key[held], owner[held]
                    columns = [pa.array(ragged.signed(key)), part.column("rep").take(pa.array(owner))]
                    yield pa.record_batch(columns + ([pa.array(_held(hot, key))] if hot else []), names=["key", "rep", "hot"][: 2 + bool(hot)])

    first, second = bloom.slots(F.col("doc_id"), reps_size)
    source = docs.where("doc_id is not null").select(F.col("doc_id").alias("rep"), first.alias("first"), second.alias("second"), "text")
    return source.mapInArrow(run, f"key long, rep {kind}" + (", hot boolean" if hot else ""))


def _pruned(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs a, b that sizes and bitmaps don't rule out."""
    side = classes.select("rep", "n", "bits")
    one = side.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    two = side.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    both = pairs.join(two, "b").join(one, "a").where("5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
                each = np.arange(batch.num_rows)
                keep = could_link(n_a, n_b, Bits(batch.column("bits_a")), each, Bits(batch.column("bits_b")), each)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    kind = classes.schema["rep"].dataType.simpleString()
    return both.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, f"a {kind}, b {kind}").distinct()


def linked(batch: pa.RecordBatch) -> pa.Array:
    """Whether the texts t_a and t_b of each row link, by exact intersection of their sets of words."""
    (flat_a, off_a), (flat_b, off_b) = ragged.buffers(batch.column("t_a")), ragged.buffers(batch.column("t_b"))
    keep, at, total = [], 0, off_a + off_b
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(total, total[at] + ragged.CHUNK_BYTES, "right")) - 1)
        a, b = ((flat[off[at] : off[end]], off[at : end + 1] - off[at]) for flat, off in ((flat_a, off_a), (flat_b, off_b)))
        n_a, n_b, both = ragged.shared_shingles(a, b, K)
        keep.append((both > 0) & (100 * both >= 80 * (n_a + n_b - both)))
        at = end
    return pa.array(np.concatenate(keep) if keep else np.empty(0, bool), pa.bool_())


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs a, b whose sets link; only texts of pairs left over by the pruning shuffle."""
    left = written(_pruned(pairs, classes), "pruned")
    needed = left.select(F.col("a").alias("rep")).union(left.select("b")).distinct()
    bits = bloom.size_for(2 * left.count())
    words = bloom.present(needed, "rep", bits)
    kind = classes.schema["rep"].dataType.simpleString()
    texts = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").alias("rep"), "text")
    texts = bloom.may_repeat(texts, F.col("rep"), words, bits, "held").where("held")

    def run(batches):
        for batch in batches:
            yield batch.select(["a", "b"]).filter(linked(batch))

    one = texts.select(F.col("rep").alias("a"), F.col("text").alias("t_a"))
    two = texts.select(F.col("rep").alias("b"), F.col("text").alias("t_b"))
    # shuffled joins, so that the filter of texts and the comparison don't hold Python workers in the same task
    return left.join(two.hint("merge"), "b").join(one.hint("merge"), "a").select("a", "b", "t_a", "t_b").mapInArrow(run, f"a {kind}, b {kind}").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) of every node on an edge a, b."""
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")

    def step(edges: DataFrame) -> DataFrame:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        return small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1000003)).first())

    before, edges = None, edges
    now = state(edges)
    while now[0] and now != before:
        old, edges = edges, written(step(edges), "edges")
        before, now = now, state(edges)
        release(old)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _whole_lists(batches, columns: list[str]):
    """Tables of whole lists, rows that agree on the columns, from sorted batches; and the places where their lists begin."""
    held = []
    for batch in batches:
        held.append(batch)
        table = pa.Table.from_batches(held).combine_chunks()
        heads = _heads(table, columns)
        if len(heads) > 1:
            yield table.slice(0, heads[-1]), heads[:-1]
            held = table.slice(heads[-1]).combine_chunks().to_batches()
        else:
            held = table.to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        if table.num_rows:
            yield table, _heads(table, columns)


def _heads(table: pa.Table, columns: list[str]) -> np.ndarray:
    new = np.arange(table.num_rows) == 0
    for c in columns:
        v = table.column(c).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def _pairs(heads: np.ndarray, n: int):
    """Places i < j of the pairs of each list, some lists or parts of lists at a time."""
    ends = np.repeat(np.append(heads[1:], n), np.diff(np.append(heads, n)))
    count = ends - np.arange(n) - 1
    upto = np.cumsum(count)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, "right")))
        c = count[at:to]
        i = np.repeat(np.arange(at, to), c)
        yield i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(c) - c, c)
        at = to


class _Hot:
    """Joins by key in which hot keys are spread: a filter of bounded size tells which rows may have one."""

    def __init__(self, lists: DataFrame):
        hot = lists.where(F.col("members") > HOT).select("key")
        self.words, self.bits = _filter(hot)
        self.shared = lists.sparkSession.sparkContext.broadcast(self.words)

    def _may(self, rows: DataFrame) -> Column:
        shared = self.shared

        @F.arrow_udf("boolean")
        def test(first: pa.Array, second: pa.Array) -> pa.Array:
            return pa.array(bloom.holds(shared.value, first.to_numpy(), second.to_numpy()))

        return test(*_slots(F.col("key"), self.bits)) if self.words.any() else F.lit(False)

    def join(self, rows: DataFrame, lists: DataFrame) -> DataFrame:
        """Rows with what ``lists`` (one row a key) says of their key; a hot key's rows go ``SALTS`` ways.

        A column ``hot``, if both have it, says which keys are hot: then no Python worker is asked.
        """
        salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        told = lists if "hot" in lists.columns else lists.withColumn("hot", self._may(lists))
        theirs = told.withColumn("salt", F.explode(salts)).drop("hot")
        salt = F.when(F.col("hot"), F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
        mine = (rows if "hot" in rows.columns else rows.withColumn("hot", self._may(rows))).withColumn("salt", salt).drop("hot")
        return mine.join(theirs, ["key", "salt"]).drop("salt")


def _blocks(members: Column, n: Column, rep: Column) -> Column:
    """The blocks of its list that a set is compared in, as an array of (lo, hi, own); a list of up to ``BLOCK`` members is one.

    A longer list has blocks by size class, a factor 1.25 each, and by a hash within a class; only equal and neighbouring classes can link.
    """
    parts = F.ceil(members / BLOCK).cast("int")
    own = F.floor(F.log(n.cast("double")) / math.log(1.25)).cast("int") * F.lit(1 << 20) + F.pmod(F.xxhash64(rep), parts).cast("int")
    others = F.flatten(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.transform(F.sequence(F.lit(0), parts - 1), lambda p: (F.shiftright(own, 20) + d) * F.lit(1 << 20) + p)))
    many = F.transform(others, lambda o: F.struct(F.least(own, o).alias("lo"), F.greatest(own, o).alias("hi"), own.alias("own")))
    zero = F.lit(0).cast("int")
    return F.when(members > BLOCK, many).otherwise(F.array(F.struct(zero.alias("lo"), zero.alias("hi"), zero.alias("own"))))


def _uncovered(listed: DataFrame, classes: DataFrame, small: int) -> DataFrame:
    """Without the sets in hot lists that meet all they link to in other lists as well."""
    hot = listed.where(F.col("members") > HOT).groupBy("rep").agg(F.count("*").alias("hot_lists"))
    spare = hot.join(classes.select("rep", F.col("n").alias("size")), "rep").where((F.col("size") > small) & (F.col("hot_lists") <= F.floor(F.col("size") / 10)))
    placed = listed.join(spare.select("rep", F.lit(True).alias("covered")), "rep", "left")
    return placed.where((F.col("members") <= HOT) | F.col("covered").isNull()).drop("covered")


def _across(listed: DataFrame, hot: _Hot, roots: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs a, b of one list and different components that sizes and bitmaps don't rule out."""
    placed = listed.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    members = written(placed, "members")
    # rows of a key agree on its members; asked as a filter, Python would answer twice in a task, once more for the join's null check
    is_hot = F.col("members") > HOT
    mixed = members.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max("members").alias("members")).where("low < high").select("key", is_hot.alias("hot"))
    rows = (
        hot.join(members.withColumn("hot", is_hot), mixed)
        .join(classes.select("rep", "n", "bits"), "rep")
        .select("key", "rep", "root", "pivot", "n", "bits", F.explode(_blocks(F.col("members"), F.col("n"), F.col("rep"))).alias("x"))
        .select("key", "x.*", "rep", "root", "pivot", "n", "bits")
        .repartition("key", "lo", "hi")
        .sortWithinPartitions("key", "lo", "hi", "rep")
    )

    def run(batches):
        for table, heads in _whole_lists(batches, ["key", "lo", "hi"]):
            n, rep, root, own, lo, hi, pivot = (table.column(c).to_numpy() for c in ("n", "rep", "root", "own", "lo", "hi", "pivot"))
            bits = Bits(table.column("bits").combine_chunks())
            for i, j in _pairs(heads, len(rep)):
                # the first round compared the pivot with all; of two blocks only pairs across count
                ok = (root[i] != root[j]) & (rep[i] != pivot[i]) & (rep[j] != pivot[i]) & ((lo[i] == hi[i]) | (own[i] != own[j]))
                i, j = i[ok], j[ok]
                keep = could_link(n[i], n[j], bits, i, bits, j)
                found = np.unique(np.stack([rep[i[keep]], rep[j[keep]]]), axis=1)  # pairs meet in several lists
                yield pa.record_batch([pa.array(found[0]), pa.array(found[1])], names=["a", "b"])

    kind = classes.schema["rep"].dataType.simpleString()
    return rows.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def join(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id, n_shingles and digest of each row, and rep, root and digest of each class of equal words."""
    every = written(profiles(docs), "profiles")
    classes, filters = _classes(every)
    small = boundary({r["n"]: r["count"] for r in classes.where(F.col("n") <= MOST_SMALL).groupBy("n").count().collect()})
    postings = _postings(docs, filters, small)
    lists = postings.groupBy("key").agg(F.min("rep").alias("pivot"), F.max("rep").alias("last"), F.count("*").alias("members"))
    lists = written(lists.where("members > 1 and pivot <> last"), "lists")
    longer = lists.where("members > 2").select("key", "pivot", "members")
    hot = _Hot(lists)
    found = written(hot.join(_postings(docs, filters, small, _filter(longer), (hot.words, hot.bits)), longer), "found")
    listed = written(_uncovered(found, classes, small), "listed")
    twos = lists.where("members = 2").select(F.col("pivot").alias("a"), F.col("last").alias("b"))
    stars = twos.union(listed.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b"))).distinct()
    edges = written(_verified(stars, classes, docs), "links")
    roots = components(edges)
    links = edges.unionByName(_verified(_across(listed, hot, roots, classes), classes, docs))
    roots = components(links)
    release(lists, found, listed)
    return every.select("doc_id", "n_shingles", *CLASS), classes.select("rep", *CLASS).join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))


def membership(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    every, classes = join(docs)
    found = every.join(classes, CLASS, "left")
    return found.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("root", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are the smallest ``doc_id`` of their component; a null id stays."""
    kept = membership(docs).where("doc_id = component_id").select(F.col("doc_id").alias("kept")).distinct()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    found = rows.join(kept, F.col("row.doc_id") == F.col("kept"), "left_semi")
    return found.unionByName(rows.where("row.doc_id is null")).select("row.*")


def op6_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return membership(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - least(5, len(w)) + 2), lambda x: array_to_string(w[x : x + least(5, len(w)) - 1], ' '))) AS g FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.c = e.a)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""
