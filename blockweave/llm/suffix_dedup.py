"""Removal of repeated byte strings by a hash-compared suffix sort.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts earlier (in a smaller ``doc_id``, or earlier in the
same document).  Texts are judged as UTF-8; matches never cross documents.

Every window of ``LENGTH`` bytes names the leftmost smallest hash among its ``GRAM``-byte substrings as its anchor, so that equal
windows name equal anchors; the consecutive windows of one anchor are a span.

1. Spans, as (anchor, hash of the span, place), are range-sorted.  In a class of equal spans all but the first repeat it as a
   whole.  Ranges split hot anchors, so that no key gathers in a task; where a range begins or ends within an anchor, its classes
   go on to step 2 as if they differed.
2. Where an anchor has several classes, their first spans, cut from their documents, are compared window by window: the suffixes
   at the windows' starts are merge-sorted.  A comparison takes a logarithmic number of steps, since a binary search over prefix
   polynomial hashes finds the common extension.  Neighbours with a common extension of ``LENGTH`` are equal, which their bytes
   verify; all but the first of equals are repeated.  An anchor of more than ``HOT_SPANS`` such spans would gather in one task:
   its windows meet by hashes of their own, so that they spread.
3. Every repeated range names the earlier range that it repeats; neighbouring ones with the same way between them are one run.
   Both sides of every run are compared by SHA-256 of their bytes.  Should one differ, two hashes collided, and all starts anew
   with other bases, so that no result rests on a hash.
4. Runs meet their documents, and the others pass straight through.

Edge cases: null and short texts have nothing to remove; rows that repeat a ``doc_id`` are taken as one document and don't repeat
one another: that of the smallest text hash stands for it, and rows of other texts have nothing removed; a null ``doc_id``
comes last; very long texts go by parts; empty tables give empty results; further columns play no part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockweave.llm import bloom, ragged
from blockweave.llm.shared import release, small_batches, written

LENGTH = 100
GRAM = 32
#: Spans of an anchor beyond which its windows go by their own hashes.
HOT_SPANS = 2000
#: Bytes of spans cut or sorted at once (more only within one anchor), and pairs whose bytes are compared at once.
SORT_BYTES = 1 << 19
COMPARED = 10_000
#: Spans of hot anchors whose windows are made at once.
APART_SPANS = 500
#: Families of hashes that are tried.
TRIES = 8
_PLACE_BITS = 20
#: Bytes whose spans are made at once: at most what ``_PLACE_BITS`` can place.
PART_BYTES = 1 << 19
_LAST = 2**63 - 1
_RANGES = "doc_id long, lo long, hi long, src long, src_lo long"
_NAMES = ["doc_id", "lo", "hi", "src", "src_lo"]


def _least_of(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    out, have = key, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[: len(out) - (width - have)], out[width - have :])
    return out


def _part_spans(piece: np.ndarray, off: np.ndarray, at: int, seed: int) -> tuple[np.ndarray, ...]:
    """Spans of the bytes from ``at`` on, of texts that may begin before or end after them."""
    first, last = np.searchsorted(off, at, "right") - 1, np.searchsorted(off, at + len(piece), "left")
    cuts = np.clip(off[first : last + 1] - at, 0, len(piece))
    row, start, *rest = spans(piece, cuts, seed)
    return row + first, start + cuts[row] + at - off[row + first], *rest


def spans(flat: np.ndarray, off: np.ndarray, seed: int = 0) -> tuple[np.ndarray, ...]:
    """Row, start in the row, number of windows, start of the anchor after the span's, anchor's hash and span's hash."""
    n = len(flat) - LENGTH + 1
    if n <= 0:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if len(flat) > PART_BYTES:  # by parts, which split a span at most
        parts, step = [], PART_BYTES - LENGTH - 1
        for at in range(0, n, step):
            piece = flat[at : at + step + LENGTH - 1]
            row, start, *rest = _part_spans(piece, off, at, seed)
            parts.append((row, start, *rest))
        return tuple(np.concatenate(c) for c in zip(*parts, strict=True))
    prefix = ragged.prefix_hash(flat, seed=seed)
    gram = ragged.window_keys(flat, GRAM)
    at = np.arange(len(gram))
    key = (gram >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | at.astype(np.uint64)
    anchor = (_least_of(key, LENGTH - GRAM + 1) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    valid = np.zeros(n + 1, dtype=np.int64)
    whole = np.diff(off) >= LENGTH
    np.add.at(valid, off[:-1][whole], 1)
    np.add.at(valid, off[1:][whole] - LENGTH + 1, -1)
    inside = np.cumsum(valid[:-1]) > 0
    new = np.ones(n, dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
    heads = np.flatnonzero(new)
    ends = np.append(heads[1:], n)
    keep = inside[heads]
    heads, ends = heads[keep], ends[keep]
    row = np.searchsorted(off, heads, "right") - 1
    return row, heads - off[row], ends - heads, anchor[heads] - heads, gram[anchor[heads]], ragged.range_hash(prefix, heads, ends + LENGTH - 1, seed)


def _span_rows(docs: DataFrame, seed: int) -> DataFrame:
    """A row for each span: its start, number of windows and way to its anchor are packed in ``windows``."""

    def run(batches):
        for batch in batches:
            for part, flat, off in ragged.chunks(batch, "text"):
                row, start, count, lead, anchor, span = spans(flat, off, seed)
                doc = part.column("doc_id").to_numpy()[row]
                yield pa.record_batch([pa.array(ragged.signed(anchor)), pa.array(ragged.signed(span)), pa.array(doc), pa.array(start << 16 | count << 8 | lead)], names=["anchor", "span", "doc_id", "windows"])

    return docs.mapInArrow(run, "anchor long, span long, doc_id long, windows long")


def _classes(rows: DataFrame) -> DataFrame:
    """Ranges of spans that repeat one, with the range they repeat, and with ``anchor`` and ``windows`` set the spans to compare by windows.

    Rows are read as a stream: what is held is the open class's first row and the open anchor's first spans.
    """

    def run(batches):
        held, classes, begins, last = [], 0, True, None  # of the open anchor; whether it is the first; the open class's first row
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("anchor", "span", "doc_id", "windows")]
            if not len(columns[0]):
                continue
            carried = last is not None
            if carried:
                columns = [np.concatenate([[x], c]) for x, c in zip(last, columns, strict=True)]
            anchor, span, doc, windows = columns
            n = len(anchor)
            new_anchor, new_class = np.full(n, not carried), np.full(n, not carried)
            new_anchor[1:] = anchor[1:] != anchor[:-1]
            new_class[1:] = new_anchor[1:] | (span[1:] != span[:-1])
            first = np.maximum.accumulate(np.where(new_class, np.arange(n), 0))
            start, count = windows >> 16, windows >> 8 & 255
            again = (doc != doc[first]) | (start != start[first])
            yield _found([doc[again], start[again], (start + count + LENGTH - 1)[again], doc[first[again]], start[first[again]]])
            place = np.cumsum(new_anchor) - (not carried)
            several = np.bincount(place, weights=new_class)
            several[0] += classes
            open_ = int(place[-1])
            keep = several > 1
            keep[0] |= begins
            heads = np.flatnonzero(new_class)
            mine = [np.stack([anchor[heads], doc[heads], windows[heads]])]
            if open_:
                done = heads[(place[heads] < open_) & keep[place[heads]]]
                for part in [*(held if keep[0] else []), np.stack([anchor[done], doc[done], windows[done]])]:
                    yield _edges(part)
                begins, held = False, []
                mine = [mine[0][:, place[heads] == open_]]
            held, classes, last = held + mine, int(several[open_]), [c[first[-1]] for c in columns]
        for part in held:  # the range may end within this anchor
            yield _edges(part)

    ordered = rows.repartitionByRange("anchor", "span", "doc_id", "windows").sortWithinPartitions("anchor", "span", "doc_id", "windows")
    return ordered.mapInArrow(run, f"{_RANGES}, anchor long, windows long")


def _found(columns: list) -> pa.RecordBatch:
    none = pa.nulls(len(columns[0]), pa.int64())
    return pa.record_batch([*map(pa.array, columns), none, none], names=[*_NAMES, "anchor", "windows"])


def _edges(part: np.ndarray) -> pa.RecordBatch:
    anchor, doc, windows = part
    none = pa.nulls(len(doc), pa.int64())
    return pa.record_batch([pa.array(doc), none, none, none, none, pa.array(anchor), pa.array(windows)], names=[*_NAMES, "anchor", "windows"])


def common_extension(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, up to ``most``, by binary search over prefix hashes."""
    low, high = np.zeros(len(a), dtype=np.int64), np.full(len(a), most, dtype=np.int64)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high + 1) >> 1
        same = ragged.quick_range(prefix, a, a + middle) == ragged.quick_range(prefix, b, b + middle)
        low, high = np.where(open_ & same, middle, low), np.where(open_ & ~same, middle - 1, high)


def _compare(flat: np.ndarray, prefix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sign of the order of the suffixes at a and b; 0 if they share ``LENGTH`` bytes."""
    common = common_extension(prefix, a, b)
    equal = common >= LENGTH
    common = np.minimum(common, LENGTH - 1)
    return np.where(equal, 0, np.sign(flat[a + common].astype(np.int64) - flat[b + common].astype(np.int64)))


def sort_suffixes(flat: np.ndarray, prefix: np.ndarray, suffix: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Stable order of the suffixes within each group (groups begin at ``heads``): a bottom-up mergesort of all groups at once.

    In each round an element finds its rank in the neighbouring run by binary search, every step a logarithmic comparison.
    """
    n = len(suffix)
    order = np.arange(n)
    size = np.diff(np.append(heads, n))
    start = np.repeat(heads, size)
    end = start + np.repeat(size, size)
    width, largest = 1, int(size.max()) if n else 0
    while width < largest:
        place = np.arange(n)
        run = (place - start) // width
        left = run % 2 == 0
        low = np.minimum(start + (run + np.where(left, 1, -1)) * width, end)
        begin, high = low.copy(), np.minimum(low + width, end)
        while True:
            todo = np.flatnonzero(low < high)
            if not len(todo):
                break
            middle = (low[todo] + high[todo]) >> 1
            sign = _compare(flat, prefix, suffix[order[middle]], suffix[order[todo]])
            before = np.where(left[todo], sign < 0, sign <= 0)  # equals of the left run stay in front
            low[todo] = np.where(before, middle + 1, low[todo])
            high[todo] = np.where(before, high[todo], middle)
        base = np.where(left, place, place - width)
        target = np.where(left, base + (low - begin), start + (run - 1) * width + (place - (start + run * width)) + (low - begin))
        merged = np.empty(n, dtype=order.dtype)
        merged[target] = order
        order, width = merged, width * 2
    return order


def _equal_to_the_one_before(flat: np.ndarray, suffix: np.ndarray, group: np.ndarray, compared: int) -> np.ndarray:
    """Whether the bytes of each sorted window are those of the one before it in its group."""
    same = np.zeros(len(suffix), dtype=bool)
    pair = np.flatnonzero(group[1:] == group[:-1])
    for at in range(0, len(pair), compared):
        some = pair[at : at + compared]
        same[some + 1] = (flat[suffix[some][:, None] + np.arange(LENGTH)] == flat[suffix[some + 1][:, None] + np.arange(LENGTH)]).all(axis=1)
    return same


def repeated_windows(flat: np.ndarray, begin: np.ndarray, count: np.ndarray, lead: np.ndarray, anchor: np.ndarray, doc: np.ndarray, start: np.ndarray, compared: int = COMPARED) -> tuple[np.ndarray, ...]:
    """Of spans sorted by (anchor, doc, start): numbers of the spans and windows that have an equal window before them, and of the first such."""
    total = int(count.sum())
    owner = np.repeat(np.arange(len(count)), count)
    inner = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    key = lead[owner] - inner  # equal windows have equal ways to their anchor
    order = np.lexsort((owner, key, anchor[owner]))
    owner, inner, key = owner[order], inner[order], key[order]
    new = np.ones(total, dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (anchor[owner[1:]] != anchor[owner[:-1]])
    group = np.cumsum(new) - 1
    several = np.bincount(group)[group] > 1
    owner, inner, group = owner[several], inner[several], group[several]
    if not len(owner):
        return owner, inner, owner, inner
    suffix = begin[owner] + inner
    heads = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    prefix = ragged.quick_prefix(flat)
    order = sort_suffixes(flat, prefix, suffix, heads)
    same = _equal_to_the_one_before(flat, suffix[order], group, compared)
    pair = np.flatnonzero((group[1:] == group[:-1]) & ~same[1:])
    if len(pair) and (common_extension(prefix, suffix[order][pair], suffix[order][pair + 1]) >= LENGTH).any():
        data = flat.tobytes()  # hashes of different windows agree, which may part equal ones: their bytes sort them
        order = np.array(sorted(range(len(suffix)), key=lambda i: (group[i], data[suffix[i] : suffix[i] + LENGTH], i)), dtype=np.int64)
        same = _equal_to_the_one_before(flat, suffix[order], group, compared)
    owner, inner = owner[order], inner[order]
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
    same &= (doc[owner] != doc[owner[first]]) | (start[owner] + inner != start[owner[first]] + inner[first])
    return owner[same], inner[same], owner[first[same]], inner[first[same]]


def _with_lists(docs: DataFrame, lists: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, text and what ``lists`` (one row a document) says; a filter of the ids keeps other texts out of the shuffle.

    The join is always a shuffled one, so that the filter and what reads the texts don't hold Python workers in the same task.
    """
    bits = bloom.size_for(ids.count())
    held = bloom.may_repeat(docs, F.col("doc_id"), bloom.present(ids, "doc_id", bits), bits, "held")
    return held.where("held").drop("held").join(lists.hint("merge"), "doc_id")


def _pieces(docs: DataFrame, edges: DataFrame) -> DataFrame:
    """The spans to compare, with their bytes, cut from their documents, and whether their anchor is hot.

    A filter tells hot anchors; one that it takes for hot goes the same way with all its spans.
    """
    hot = edges.groupBy("anchor").count().where(F.col("count") > HOT_SPANS).select("anchor")
    bits = bloom.size_for(hot.count())
    slots = F.explode(F.array(*[F.shiftrightunsigned("anchor", k).bitwiseAND(F.lit(bits - 1)) for k in (0, 32)])).alias("slot")
    shared = docs.sparkSession.sparkContext.broadcast(bloom.bitmap(hot.select(slots), bits))
    lists = edges.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "windows")).alias("spans"))
    most = SORT_BYTES

    def run(batches):
        for batch in batches:
            flat, off = ragged.buffers(batch.column("text"))
            lists = batch.column("spans")
            cuts = lists.offsets.to_numpy()
            fields = lists.values.flatten()
            anchor, windows = fields[0].to_numpy()[cuts[0] : cuts[-1]], fields[1].to_numpy()[cuts[0] : cuts[-1]]
            key = anchor.view(np.uint64)
            hot = bloom.holds(shared.value, key & np.uint64(bits - 1), key >> np.uint64(32) & np.uint64(bits - 1))
            row = np.repeat(np.arange(batch.num_rows), np.diff(cuts))
            doc, first, size = batch.column("doc_id").to_numpy()[row], off[row] + (windows >> 16), (windows >> 8 & 255) + LENGTH - 1
            ends = np.cumsum(size)
            at = 0
            while at < len(row):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
                n = size[at:to]
                begin = np.concatenate([[0], np.cumsum(n)])
                data = flat[np.arange(begin[-1]) + np.repeat(first[at:to] - begin[:-1], n)]
                content = pa.Array.from_buffers(pa.binary(), to - at, [None, pa.py_buffer(begin.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
                yield pa.record_batch([pa.array(anchor[at:to]), pa.array(doc[at:to]), pa.array(windows[at:to] >> 16), pa.array(windows[at:to] & 255), content, pa.array(hot[at:to])], names=["anchor", "doc_id", "start", "lead", "content", "hot"])
                at = to

    ids = edges.select("doc_id").distinct()
    return _with_lists(docs, lists, ids).select("doc_id", "text", "spans").mapInArrow(run, "anchor long, doc_id long, start long, lead long, content binary, hot boolean")


def _compared(pieces: DataFrame) -> DataFrame:
    """Ranges of the windows of these spans that repeat one."""
    most, compared = SORT_BYTES, COMPARED

    def work(table: pa.Table):
        anchor, doc, start, lead = (table.column(c).to_numpy() for c in ("anchor", "doc_id", "start", "lead"))
        flat, off = ragged.buffers(table.column("content").combine_chunks())
        owner, inner, first, first_inner = repeated_windows(flat, off[:-1], np.diff(off) - LENGTH + 1, lead, anchor, doc, start, compared)
        return _runs(doc[owner], start[owner] + inner, doc[first], start[first] + first_inner)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column("content").nbytes
            if size > most:
                table = pa.Table.from_batches(held)
                anchor = table.column("anchor").to_numpy()
                cut = int(np.searchsorted(anchor, anchor[-1]))
                if cut:
                    yield work(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
                size = sum(b.column("content").nbytes for b in held)
        if held:
            yield work(pa.Table.from_batches(held))

    rows = pieces.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "start")
    return rows.mapInArrow(run, _RANGES)


def _runs(doc: np.ndarray, at: np.ndarray, src: np.ndarray, src_at: np.ndarray) -> pa.RecordBatch:
    """Ranges of neighbouring windows that repeat neighbouring ones, from windows in any order."""
    order = np.lexsort((at, doc))
    doc, at, src, src_at = doc[order], at[order], src[order], src_at[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + 1) | (src[1:] != src[:-1]) | (at[1:] - src_at[1:] != at[:-1] - src_at[:-1])
    heads = np.flatnonzero(new)
    last = np.append(heads[1:], len(doc))[: len(heads)] - 1
    return pa.record_batch([pa.array(x) for x in (doc[heads], at[heads], at[last] + LENGTH, src[heads], src_at[heads])], names=_NAMES)


def _compared_apart(pieces: DataFrame, seed: int) -> DataFrame:
    """The same for spans of hot anchors: every window goes by two hashes of its own, so that no anchor gathers in a task.

    The first place of a window is an aggregate, combined before the shuffle, and meets the windows in a join that can be split.
    """
    most = APART_SPANS

    def windows(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, most):
                batch = whole.slice(i, most)
                flat, off = ragged.buffers(batch.column("content"))
                count = np.diff(off) - LENGTH + 1
                owner = np.repeat(np.arange(len(count)), count)
                inner = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                begin, prefix = off[:-1][owner] + inner, ragged.prefix_hash(flat, seed=seed)
                one = ragged.range_hash(prefix, begin, begin + LENGTH, seed)
                two = ragged.range_hash(prefix, begin, begin + LENGTH // 2, seed)
                doc, start = batch.column("doc_id").to_numpy(), batch.column("start").to_numpy()
                yield pa.record_batch([pa.array(ragged.signed(one)), pa.array(ragged.signed(two)), pa.array(doc[owner]), pa.array(start[owner] + inner)], names=["w1", "w2", "doc_id", "at"])

    def runs(batches):
        for batch in batches:
            yield _runs(*(batch.column(c).to_numpy() for c in ("doc_id", "at", "src", "src_at")))

    rows = written(pieces.mapInArrow(windows, "w1 long, w2 long, doc_id long, at long"), "windows")
    first = rows.groupBy("w1", "w2").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.max(F.struct("doc_id", "at")).alias("last")).where("first <> last")
    again = rows.join(written(first.select("w1", "w2", "first"), "firsts"), ["w1", "w2"]).where("doc_id <> first.doc_id or at <> first.at")
    return again.select("doc_id", "at", F.col("first.doc_id").alias("src"), F.col("first.at").alias("src_at")).mapInArrow(runs, _RANGES)


def _joined(ranges: DataFrame) -> DataFrame:
    """Neighbouring ranges of a document with the same way to what they repeat, as one."""

    def run(batches):
        last = None
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in _NAMES]
            if not len(columns[0]):
                continue
            if last is not None:
                columns = [np.concatenate([[x], c]) for x, c in zip(last, columns, strict=True)]
            doc, lo, hi, src, src_lo = columns
            new = np.ones(len(doc), dtype=bool)
            new[1:] = (doc[1:] != doc[:-1]) | (lo[1:] > hi[:-1] - LENGTH + 1) | (src[1:] != src[:-1]) | (lo[1:] - src_lo[1:] != lo[:-1] - src_lo[:-1])
            heads = np.flatnonzero(new)
            ends = np.maximum.reduceat(hi, heads)
            out = [doc[heads], lo[heads], ends, src[heads], src_lo[heads]]
            last = [c[-1] for c in out]
            yield pa.record_batch([pa.array(c[:-1]) for c in out], names=_NAMES)
        if last is not None:
            yield pa.record_batch([pa.array([c], pa.int64()) for c in last], names=_NAMES)

    return ranges.repartition("doc_id").sortWithinPartitions("doc_id", "lo").mapInArrow(run, _RANGES)


def _order(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST))


def _source(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """doc_id (null last) and text of each document; and the hash of the text that counts of each id that has several, if one has."""
    rows = docs.select(_order().alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    hashed = rows.select("doc_id", F.xxhash64("text").alias("h"))
    twice = hashed.groupBy("doc_id").agg(F.min("h").alias("own"), F.max("h").alias("other")).where("own <> other").select("doc_id", "own")
    twice = written(twice, "twice")
    if not twice.take(1):
        return rows, None
    return rows.join(twice, "doc_id", "left").where("own is null or xxhash64(text) = own").drop("own"), twice


def repeats(docs: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, lo, hi, src, src_lo: runs of bytes that repeat earlier ones, as hashes of this seed find them."""
    return _repeats(_source(docs)[0], seed)


def _repeats(source: DataFrame, seed: int) -> DataFrame:
    found = written(_classes(_span_rows(source, seed)), "spans")
    edges = found.where("anchor is not null").select("anchor", "doc_id", "windows")
    pieces = written(_pieces(source, edges), "pieces")
    result = found.where("anchor is null").select(*_NAMES).union(_compared(pieces.where("not hot").drop("hot")))
    if pieces.where("hot").take(1):
        result = result.union(_compared_apart(pieces.where("hot").drop("hot"), seed))
    runs = written(_joined(result), "runs")
    release(found, pieces)
    return runs


def merge_ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the ranges' union; ranges that touch are one run."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.append(True, lo[1:] > hi[:-1])[: len(lo)]
    heads = np.flatnonzero(new)
    return lo[heads], hi[np.append(heads[1:], len(lo))[: len(heads)] - 1]


def _result(doc, data: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple:
    kept, at = [], 0
    for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
        kept.append(data[at:a])
        at = b
    kept.append(data[at:])
    rest = b"".join(kept)
    return doc, len(data), len(data) - len(rest), len(lo), hashlib.sha256(rest).hexdigest()


def _digests(data: bytes, lo: list, hi: list) -> np.ndarray:
    """SHA-256 of ranges of a text, the first 128 bits as two numbers each."""
    return np.frombuffer(b"".join(hashlib.sha256(data[a:b]).digest()[:16] for a, b in zip(lo, hi, strict=True)), dtype="<i8").reshape(-1, 2)


def _checked(docs: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For each document with runs the result's columns; and for each range that runs repeat the least and greatest digests of the runs."""
    lists = runs.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi", "src", "src_lo")).alias("runs"))

    def run(batches):
        for batch in batches:
            flat, off = ragged.buffers(batch.column("text"))
            out, checks, cuts = [], [], [0]
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                lo, hi, src, src_lo = (f.to_numpy() for f in batch.column("runs")[i].values.flatten())
                data = flat[off[i] : off[i + 1]].tobytes()
                out.append(_result(doc, data, *merge_ranges(lo, hi)))
                checks.append(np.column_stack([src, src_lo, hi - lo, _digests(data, lo.tolist(), hi.tolist())]))
                cuts.append(cuts[-1] + len(lo))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            each = np.concatenate(checks) if checks else np.empty((0, 5), np.int64)
            check = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in each.T], names=["src", "src_lo", "size", "d1", "d2"])
            listed = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), check)
            yield pa.record_batch([*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.string()), listed], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "checks"])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, checks array<struct<src: long, src_lo: long, size: long, d1: long, d2: long>>"
    changed = written(_with_lists(docs, lists, runs.select("doc_id").distinct()).select("doc_id", "text", "runs").mapInArrow(run, schema), "changed")
    each = changed.select(F.inline("checks"))
    sides = [f(d).alias(f"{n}_{d}") for n, f in (("least", F.min), ("most", F.max)) for d in ("d1", "d2")]
    return changed.drop("checks"), written(each.groupBy("src", "src_lo", "size").agg(*sides), "checks")


def _collided(docs: DataFrame, checks: DataFrame) -> bool:
    """Whether a range differs from one that is held to repeat it."""
    same = "least_d1 = most_d1 and least_d2 = most_d2"
    lists = checks.groupBy(F.col("src").alias("doc_id")).agg(F.collect_list(F.struct("src_lo", "size", "least_d1", "least_d2")).alias("ranges"))

    def run(batches):
        for batch in batches:
            flat, off = ragged.buffers(batch.column("text"))
            differ = 0
            for i in range(batch.num_rows):
                lo, size, d1, d2 = (f.to_numpy() for f in batch.column("ranges")[i].values.flatten())
                own = _digests(flat[off[i] : off[i + 1]].tobytes(), lo.tolist(), (lo + size).tolist())
                differ += int(((own[:, 0] != d1) | (own[:, 1] != d2)).sum())
            yield pa.record_batch([pa.array([differ], pa.int64())], names=["differ"])

    if checks.where(f"not ({same})").take(1):
        return True
    found = _with_lists(docs, lists, checks.select(F.col("src").alias("doc_id")).distinct()).select("text", "ranges").mapInArrow(run, "differ long")
    return bool(found.agg(F.sum("differ")).first()[0])


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    source, twice = _source(docs)
    for seed in range(TRIES):
        runs = _repeats(source, seed)
        changed, checks = _checked(source, runs)
        if not _collided(source, checks):
            break
        release(runs, checks)
    else:
        raise RuntimeError("ranges that hashes hold equal differ with every family of hashes")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", _order().alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("whole"), F.xxhash64(text).alias("h"))
    found = changed.select(F.col("doc_id").alias("of"), "n_removed", "n_spans", "kept_sha256").dropDuplicates(["of"])
    out = rows.join(found, F.col("id") == F.col("of"), "left")
    mine = F.col("of").isNotNull()
    if twice is not None:
        out = out.join(twice.select(F.col("doc_id").alias("several"), "own"), F.col("id") == F.col("several"), "left")
        mine = mine & F.coalesce(F.col("h") == F.col("own"), F.lit(True))
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "n_bytes", *[F.when(mine, F.col(c)).otherwise(zero).alias(c) for c in ("n_removed", "n_spans")], F.when(mine, F.col("kept_sha256")).otherwise(F.col("whole")).alias("kept_sha256"))


def op9_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
