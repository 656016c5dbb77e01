import hashlib
import re

import pytest
from pyspark.sql import functions as F

from blockweave.llm import bloom, exact_dedup, jaccard_join, shared, suffix_dedup


def plain(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def test_exact_groups(docs, corpus):
    got = {r["doc_id"]: r for r in exact_dedup.mark(docs(corpus + corpus[:9])).collect()}
    texts = [plain(t) for t in corpus + corpus[:9]]
    for i, t in enumerate(texts):
        group = [j for j, x in enumerate(texts) if x == t]
        r = got[i]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (group[0], len(group), group[0] == i)
        assert r["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_exact_with_a_full_filter(docs, corpus, monkeypatch):
    """A filter that holds everything sends all rows the shuffled way, with the same result."""
    want = sorted(exact_dedup.mark(docs(corpus)).collect())
    monkeypatch.setattr(bloom, "MIN_BITS", 64)
    monkeypatch.setattr(bloom, "MAX_BITS", 64)
    assert sorted(exact_dedup.mark(docs(corpus)).collect()) == want


def test_drop_copies_keeps_columns_and_smallest_id(docs, corpus):
    df = docs(corpus + corpus[:9]).withColumn("sha", F.lit(1)).withColumn("key", F.lit("k")).withColumn("row", F.lit(2)).withColumn("may_repeat", F.lit(True))
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns
    texts = [plain(t) for t in corpus + corpus[:9]]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({texts.index(t) for t in texts})


def test_exact_null_ids_and_repeated_rows(spark, docs):
    df = spark.createDataFrame([(None, "a"), (3, "a"), (3, "a"), (None, "b"), (5, None), (4, "")], "doc_id long, text string")
    rows = sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in exact_dedup.mark(df).collect())
    assert rows == [("3", "3", 3, True), ("3", "3", 3, True), ("4", "4", 2, True), ("5", "4", 2, False), ("None", "3", 3, False), ("None", "None", 1, True)]
    assert sorted(str(r["doc_id"]) for r in exact_dedup.drop_copies(df).collect()) == ["3", "4", "None"]


@pytest.mark.parametrize("operator", [exact_dedup.mark, exact_dedup.drop_copies, jaccard_join.membership, jaccard_join.drop_near_copies, suffix_dedup.digest])
def test_empty_tables(docs, operator):
    assert operator(docs([])).count() == 0


def components(texts, shingle):
    sets = [shingle(t) for t in texts]
    root = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j in range(i):
                b = sets[j]
                both = len(a & b)
                if a and b and 100 * both >= 80 * (len(a) + len(b) - both) and root[i] != root[j]:
                    low = min(root[i], root[j])
                    high = max(root[i], root[j])
                    root = [low if r == high else r for r in root]
                    changed = True
    return sets, root


@pytest.mark.parametrize("block, hot", [(2000, 1000), (3, 4)])
def test_jaccard_components(docs, corpus, shingle, monkeypatch, block, hot):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    corpus = [*corpus, "a " * 6, "a " * 7, "A  a a a a", "a b " * 9, "a b " * 10]
    sets, root = components(corpus, shingle)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.membership(docs(corpus)).collect()}
    assert got == {i: (len(s), root[i]) for i, s in enumerate(sets)}
    clash = docs(corpus).withColumn("root", F.lit(1)).withColumn("rep", F.lit(1)).withColumn("kept", F.lit(2)).withColumn("row", F.lit("x"))
    kept = jaccard_join.drop_near_copies(clash)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(root)) and kept.columns == clash.columns


def test_sets_that_link_share_a_key():
    """At the least similarity that links, with sizes on both sides of any boundary, and more lists than they need by an eighth."""
    import numpy as np

    rng = np.random.default_rng(5)
    for small in (1, 14, 40):
        for n in [*range(1, 60), 75, 100, 333, 1000]:
            for _ in range(12):
                m = int(rng.integers(n, 5 * n // 4 + 1))
                both = -(-4 * (n + m) // 9)
                if both > n:
                    continue
                pool = np.unique(rng.integers(0, 2**63, n + m, dtype=np.uint64))[: n + m - both]
                place = rng.permutation(len(pool)) if rng.random() < 0.5 else np.arange(len(pool))  # differences anywhere, or all among the first
                a = np.sort(np.concatenate([pool[place[: n - both]], pool[place[n + m - 2 * both :]]]))
                b = np.sort(pool[place[n - both :]])
                key, owner = jaccard_join.set_keys(np.concatenate([a, b]), np.array([0, n, n + m]), small)
                shared = len(np.intersect1d(key[owner == 0], key[owner == 1]))
                assert shared >= (1 + n // 10 if n > small and n > 9 else 1), (small, n, m)


def test_bitmaps_prune_only_what_cannot_link():
    """Sets of all widths: pairs that link are never pruned, and few pairs with nothing in common are left."""
    import numpy as np

    rng = np.random.default_rng(3)
    sets = []
    for n in (1, 5, 60, 500, 520, 1000, 1030, 5000, 20000, 70000):
        base = np.unique(rng.integers(0, 2**63, 2 * n, dtype=np.uint64))[:n]
        rng.shuffle(base)
        cut = n // 10
        sets += [np.sort(base), np.sort(np.concatenate([base[cut:], rng.integers(0, 2**63, cut, dtype=np.uint64)]))]
    sets = [np.unique(x) for x in sets]
    rows = np.cumsum([0, *map(len, sets)])
    bits = jaccard_join.Bits(jaccard_join.bitmaps(np.concatenate(sets), rows))
    n = np.diff(rows)
    i, j = np.triu_indices(len(sets), 1)
    left = jaccard_join.could_link(n[i], n[j], bits, i, bits, j)
    for a, b, open_ in zip(i, j, left):
        both = len(np.intersect1d(sets[a], sets[b]))
        assert open_ or 100 * both < 80 * (len(sets[a]) + len(sets[b]) - both)
        assert not open_ or both or n[a] < 5 or n[a] > 60000


def test_the_boundary_follows_the_sizes():
    assert jaccard_join.boundary({}) >= 1
    for sizes in ({5: 10}, {12: 100, 16: 1}, {16: 100}, {n: 1 for n in range(2, 65)}):
        best = jaccard_join.boundary(sizes)

        def cost(b):
            total = 0
            for n, c in sizes.items():
                p = min(n, n - -(-8 * n // 10) + 2)
                total += c * ((p * (p - 1) // 2 if n <= b else 0) + (min(n, (n + 5 * n // 4) // 9 + 1 + n // 8) if 5 * n > 4 * b else 0))
            return total

        assert cost(best) == min(cost(b) for b in range(1, 65))


def test_texts_whose_hashes_agree_are_told_apart(docs, monkeypatch):
    """Words that a polynomial modulo a power of two takes for equal, and any words if all hashes are the same."""
    import numpy as np
    import pyarrow as pa

    from blockweave.llm import ragged

    thue = "a"
    for _ in range(10):
        thue += thue.translate({97: 98, 98: 97})
    other = thue.translate({97: 98, 98: 97})
    texts = [f"one two {thue} three four", f"one two {other} three four", f"ONE two  {thue} three four"]
    assert [r["component_id"] for r in jaccard_join.membership(docs(texts)).orderBy("doc_id").collect()] == [0, 1, 0]
    monkeypatch.setattr(ragged, "range_hash", lambda prefix, starts, ends: np.full(len(starts), 3, np.uint64))
    batch = pa.record_batch({"t_a": pa.array([texts[0], "a b c d e f"]), "t_b": pa.array([texts[1], "A b  c d e f"])})
    assert jaccard_join.linked(batch).to_pylist() == [False, True]


def test_jaccard_null_and_repeated_ids(spark):
    text = " ".join("abcdefghijk")
    df = spark.createDataFrame([(None, text), (2, text), (2, text), (1, text + " l")], "doc_id long, text string")
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in jaccard_join.membership(df).collect()) == [("1", 1), ("2", 1), ("2", 1), ("None", 1)]


def removed(texts):
    seen, out = set(), {}
    for d, t in enumerate(texts):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            w = data[p : p + 100]
            if w in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(w)
        rest = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[d] = (len(data), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    return out


@pytest.mark.parametrize("hot", [50_000, 1])
def test_repeated_strings(docs, corpus, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_SPANS", hot)
    clash = docs(corpus).withColumn("anchor", F.lit("x")).withColumn("span", F.lit(1)).withColumn("id", F.lit(2)).withColumn("held", F.lit(True))
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.digest(clash).collect()}
    assert got == removed(corpus)


def test_repeated_strings_in_small_pieces(corpus, monkeypatch):
    """Texts go by parts, alone and side by side."""
    import numpy as np
    import pyarrow as pa

    from blockweave.llm import ragged

    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 700)
    whole = pa.record_batch({"t": pa.array([t or "" for t in corpus])})
    for part, flat, off in ragged.chunks(whole, "t", 1):
        row, start, count, lead, *_ = suffix_dedup.spans(flat, off)
        covered = np.concatenate([np.arange(a, a + c) for a, c in zip(start, count)]) if len(row) else np.empty(0)
        assert sorted(covered) == list(range(max(0, len(flat) - 99)))
    (part, flat, off), = ragged.chunks(whole, "t")
    row, start, count, lead, *_ = suffix_dedup.spans(flat, off)
    covered = sorted((int(r), int(x)) for r, a, c in zip(row, start, count) for x in range(a, a + c))
    assert covered == [(r, x) for r, n in enumerate(np.diff(off).tolist()) for x in range(n - 99)]


@pytest.mark.parametrize("hot", [50_000, 3])
def test_streams_of_small_batches_agree(docs, corpus, monkeypatch, hot):
    """Classes, anchors and runs that go over several batches; the limits are sent to the workers with the functions."""
    monkeypatch.setattr(shared, "BATCH_ROWS", 3)
    for limit, value in (("SORT_BYTES", 700), ("COMPARED", 7), ("APART_SPANS", 2), ("HOT_SPANS", hot)):
        monkeypatch.setattr(suffix_dedup, limit, value)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.digest(docs(corpus)).collect()}
    assert got == removed(corpus)


def test_a_collision_starts_anew_with_other_hashes(docs, corpus, monkeypatch):
    """Hashes of spans that all agree are found out by their bytes, and the next family gives the right result."""
    real, seeds = suffix_dedup._span_rows, []

    def weak(source, seed):
        seeds.append(seed)
        rows = real(source, seed)
        return rows if seed else rows.withColumn("span", F.lit(5).cast("long"))

    monkeypatch.setattr(suffix_dedup, "_span_rows", weak)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.digest(docs(corpus)).collect()}
    assert got == removed(corpus) and seeds == [0, 1]


def test_windows_whose_hashes_agree_are_sorted_by_their_bytes(monkeypatch):
    import numpy as np

    from blockweave.llm import ragged

    a, b = bytes(range(97, 197)), bytes(range(96, 196))
    flat = np.frombuffer(a + b + a + b + a, np.uint8)
    args = flat, np.arange(5) * 100, np.ones(5, np.int64), np.zeros(5, np.int64), np.zeros(5, np.int64), np.arange(5), np.zeros(5, np.int64)
    want = [(2, 0), (3, 1), (4, 0)]
    pairs = lambda: sorted(zip(*(x.tolist() for x in suffix_dedup.repeated_windows(*args)[::2])))
    assert pairs() == want
    monkeypatch.setattr(ragged, "quick_range", lambda prefix, starts, ends: np.zeros(len(starts), np.uint64))
    assert pairs() == want


def test_suffix_sort_orders_suffixes():
    import numpy as np

    from blockweave.llm import ragged

    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    data[1000:2000] = data[:1000]
    suffix = rng.integers(0, 3900, 300)
    heads = np.array([0, 1, 4, 130, 131])
    order = suffix_dedup.sort_suffixes(data, ragged.quick_prefix(data), suffix, heads)
    raw = data.tobytes()
    for a, b in zip(heads, [*heads[1:], 300]):
        want = sorted(range(a, b), key=lambda i: raw[suffix[i] : suffix[i] + 100])
        assert order[a:b].tolist() == want


def test_repeated_ids_are_one_document(spark):
    text = "".join(chr(97 + i % 26) for i in range(90)) + "".join(map(str, range(200)))
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (2, "short")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_removed"]) for r in suffix_dedup.digest(df).collect())
    assert got == [("1", 0), ("1", 0), ("2", 0), ("None", len(text))]


def test_ids_with_several_texts(spark):
    """One text stands for the id; rows of others have nothing removed."""
    text = "".join(map(str, range(200)))
    df = spark.createDataFrame([(1, text), (2, text), (2, "x" + text + "y"), (3, text)], "doc_id long, text string")
    got = [(r["doc_id"], r["n_removed"]) for r in suffix_dedup.digest(df).collect()]
    assert sorted(got) in ([(1, 0), (2, 0), (2, len(text)), (3, len(text))],)


def _workers(node) -> tuple[int, int]:
    """Python nodes that run in the task of a plan's node, and the most in any task below it."""
    kind = node.nodeName()
    if kind == "AdaptiveSparkPlan":
        return _workers(node.executedPlan())
    below = [_workers(node.children().apply(i)) for i in range(node.children().size())]
    own = sum(n for n, _ in below) + bool(re.search("Python|MapInArrow", kind))
    return (0 if "Exchange" in kind else own, max([own, *(most for _, most in below)]))


def test_near_copies_take_one_python_worker_a_task(docs, corpus, monkeypatch):
    """Each worker beside it holds some 100 MB of an executor."""
    seen, store = {}, jaccard_join.written

    def watched(df, name="t"):
        seen[name] = max(seen.get(name, 0), _workers(df._jdf.queryExecution().executedPlan())[1])
        return store(df, name)

    monkeypatch.setattr(jaccard_join, "written", watched)
    monkeypatch.setattr(jaccard_join, "HOT", 3)
    kept = jaccard_join.drop_near_copies(docs(corpus))
    seen["kept"] = _workers(kept._jdf.queryExecution().executedPlan())[1]
    assert {k: n for k, n in seen.items() if n > 1} == {} and seen["pruned"] == 1
