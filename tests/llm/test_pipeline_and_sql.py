import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from blockweave.llm import decontaminate, exact_dedup, jaccard_join, mixing, quality, queries, ragged, suffix_dedup, token_count, toxicity, url_filter
from blockweave.llm.shared import written
from oracle import same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert same(queries.QUERIES[name](spark, SF), queries.ORACLE_SQL[name], SF) >= 0


def test_all_are_registered():
    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 11)) and "pipeline" in names


def test_stages_against_brute_force(spark, shingle):
    """Each stage on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "decontaminate", "mix"]
    for name, stage in corpus_pipeline.STAGES:
        before = dict(rows)
        out = written(stage(spark, docs, SF), name)
        rows = {r["doc_id"]: r for r in out.collect()}
        if name == "quality":
            model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            assert set(rows) == {r["doc_id"] for r in quality.score(docs, model).where("score >= 0.5").collect()} and len(rows) > 100
        elif name == "exact_dedup":
            first = {}
            for i in sorted(before):
                first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", before[i]["text"] or ""), i)
            assert set(rows) == set(first.values())
        elif name == "near_dedup":
            ids = sorted(before)
            sets = {i: shingle(before[i]["text"]) for i in ids}
            root = {i: i for i in ids}
            for i in ids:
                for j in ids:
                    both = len(sets[i] & sets[j])
                    if j < i and both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both) and root[i] != root[j]:
                        low, high = min(root[i], root[j]), max(root[i], root[j])
                        root = {k: low if r == high else r for k, r in root.items()}
            assert set(rows) == set(root.values())
        elif name == "decontaminate":
            items = [shingle(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            clean = {i for i in before if not any(100 * len(shingle(before[i]["text"]) & s) >= 80 * len(s) for s in items if s)}
            assert set(rows) == clean
        else:
            taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
            assert {i: r["mix_words"] for i, r in rows.items() if r["mix_words"]} == {i: t for i, t in taken.items() if t}
        assert name == "mix" or out.columns == columns
        assert all(tuple(rows[i])[:5] == tuple(before[i])[:5] for i in rows)
        docs = out
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()) == sorted(rows)


LONG = " ".join(f"long{i * i % 977}" for i in range(30_000))
ODD = [None, "", " ", "a", "a", "A", "b " * 50, "b " * 51, LONG, LONG + " end", "a  a", "x" * 5000]
CLASHES = "text_sha256 row sha key may_repeat kept root rep mix_words mix_epochs size taken words mix_id of score __score __kept __hit h1 bits hot held id again".split()


def odd(spark, docs, texts=ODD, clashes=True):
    """Odd texts, a repeated row and a null id, with columns that the operators' own might clash with."""
    df = docs(texts).unionByName(docs(texts[3:4], 3)) if len(texts) > 3 else docs(texts)
    df = df.withColumn("doc_id", F.when(F.col("doc_id") != 6, F.col("doc_id")))
    for i, name in enumerate(CLASHES if clashes else []):
        df = df.withColumn(name, F.lit(f"{name} of the input") if i % 2 else F.lit(i))
    return df


@pytest.fixture
def small_sf(spark, tmp_path):
    """Labels and benchmark items for the stages."""
    spark.createDataFrame([(i, i % 2, 0) for i in range(12)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "b b b"), (2, None), (3, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages_take_odd_rows(spark, docs, small_sf):
    """Nulls, empty and very long texts, ties, repeated rows and clashing columns: what stays is exactly known."""
    df = odd(spark, docs)
    ids = lambda out: sorted(str(r["doc_id"]) for r in out.collect())
    stage = dict(corpus_pipeline.STAGES)
    every = [str(i) for i in (0, 1, 2, 3, 3, 4, 5, 7, 8, 9, 10, 11)]
    # equal texts after white space: 0 and 1; 3, 3 and 4
    exact = stage["exact_dedup"](spark, df, small_sf)
    assert ids(exact) == sorted(["0", "2", "3", "5", "7", "8", "9", "10", "11", "None"]) and exact.columns == df.columns
    # wordless texts link with nothing; a and A; the long ones; a null id stays
    near = stage["near_dedup"](spark, df, small_sf)
    assert ids(near) == sorted(["0", "1", "2", "3", "3", "7", "8", "10", "11", "None"]) and near.columns == df.columns
    leaks = stage["decontaminate"](spark, df, small_sf)
    assert ids(leaks) == sorted(x for x in every if x != "7") and leaks.columns == df.columns  # the null id's text has b b b too
    good = stage["quality"](spark, df, small_sf)
    assert good.columns == df.columns and set(ids(good)) <= {*every, "None"}
    model = quality.train(df, spark.read.parquet(f"{small_sf}/labels.parquet"))
    assert ids(good) == ids(quality.score(df, model).where("score >= 0.5"))
    mixed = stage["mix"](spark, df, small_sf)
    assert set(mixed.columns) == set(df.columns) and {r["mix_epochs"] for r in mixed.collect()} <= {0, 1, 2, 3}
    assert all(isinstance(r["mix_words"], int) for r in mixed.collect()) and "0" in ids(mixed)
    kept = {r["row"] for r in mixed.collect()}
    assert kept <= {r["row"] for r in df.collect()}  # columns of the input keep their values


def test_stages_take_empty_tables(spark, docs, small_sf):
    for empty in (docs([]), odd(spark, docs).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, empty, small_sf)
            assert out.count() == 0, name
            assert name == "mix" or out.columns == empty.columns


def test_operators_take_clashing_columns_and_repeated_rows(spark, docs):
    """The thin operators read their own columns alone: others change nothing, and a repeated row gives its result again."""
    plain, clash = odd(spark, docs, clashes=False), odd(spark, docs)
    items = spark.createDataFrame([(1, "b b b")], "item_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(12)], "doc_id long, quality int, toxic int")
    path = public_tokenizers.path("byte_bpe_50k.json")
    for operator in (
        exact_dedup.mark,
        mixing.mix,
        jaccard_join.membership,
        lambda d: decontaminate.search(d, items),
        lambda d: quality.score(d, quality.train(d, labels)),
        lambda d: toxicity.score(d, toxicity.train(d, labels)),
        lambda d: token_count.count(d, path),
        suffix_dedup.digest,
    ):
        got = sorted(map(str, operator(clash).collect()))
        assert got == sorted(map(str, operator(plain).collect())) and got
        repeated = [r for r in operator(plain).collect() if r["doc_id"] == 3]
        assert len(repeated) in (0, 2) and len(set(map(str, repeated))) <= 1
    pages = spark.createDataFrame([(1, "http://a.io/casino", "<p>x</p>"), (1, "http://a.io/casino", "<p>x</p>"), (None, None, None), (2, "http://b.io/" + "free/" * 100_000 + "?win", "")], "page_id long, url string, html string")
    for i, name in enumerate("host path rule ruled verdict text n_chars strict_hits soft_weight".split()):
        pages = pages.withColumn(name, F.lit(i))
    verdicts = sorted((str(r["page_id"]), r["verdict"]) for r in url_filter.judge(pages).collect())
    assert verdicts == [("1", "block"), ("1", "block"), ("2", "block"), ("None", "allow")]
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_weights_of_url_terms(spark):
    """Soft terms block by their weights: everyday words need company, and none blocks alone."""
    table = spark.createDataFrame([("Bad", None), ("often", 1.5), ("plain", 1.0), ("weak", 0.5), ("feeble", 0.5), ("often", 0.1), ("", 3.0), (None, 1.0)], "term string, weight double")
    strict, soft = url_filter.vocabulary(table)
    assert strict == ("bad",) and soft == {"feeble": 0.5, "often": 1.5, "plain": 1.0, "weak": 0.5}
    urls = {"http://bad.io": "block", "http://often.io": "allow", "http://often.io/often/often": "allow", "http://often.io/weak": "block", "http://plain.io/weak": "allow", "http://plain.io/weak/feeble": "block", "http://abad.io": "allow"}
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    assert [r["verdict"] for r in url_filter.judge(pages, strict=strict, soft=soft).orderBy("page_id").collect()] == list(urls.values())
    assert {r["verdict"] for r in url_filter.judge(pages, strict=(), soft={}).collect()} == {"allow"}


def test_quality_against_a_plain_learner(spark, docs):
    """The same updates with dictionaries and loops, from the features as counted one by one."""
    rng = random.Random(3)
    say = lambda words: " ".join(rng.choice(words) for _ in range(rng.randint(1, 30)))
    good, bad = "the river rose over night".split(), "BUY now $$$ click here !!".split()
    texts = [say(good + bad[:1]) if i % 2 else say(bad + good[:1]) for i in range(90)] + ["", None]
    labels = spark.createDataFrame([(i, i % 2) for i in range(90)], "doc_id long, quality int")
    weights, bias = quality.train(docs(texts), labels)
    rows = [i for i in range(90) if zlib.crc32(str(i).encode()) % 3 != 1]

    def counted(text):
        flat, off = ragged.buffers(pa.array([text or ""]))
        value, _, n = quality.features(flat, off)
        return {f: c / max(1, n[0]) ** 0.5 for f, c in Counter(value.tolist()).items()}

    ids = sorted(map(str, rows), key=lambda x: (len(x), x))
    order = np.argsort(ragged.mix(np.arange(len(ids), dtype=np.uint64)))
    z, g, w0 = Counter(), Counter(), [0.0, 0.0]

    def weight(f):
        return 0.0 if abs(z[f]) <= quality.L1 else -(z[f] - math.copysign(quality.L1, z[f])) / ((quality.BETA + g[f] ** 0.5) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for i in order:
            x, y = counted(texts[int(ids[i])]), int(ids[i]) % 2
            w = {f: weight(f) for f in x}
            b = -w0[0] / ((quality.BETA + w0[1] ** 0.5) / quality.ALPHA)
            e = 1 / (1 + math.exp(-(sum(w[f] * v for f, v in x.items()) + b))) - y
            for f, v in x.items():
                d = e * v
                z[f] += d - ((g[f] + d * d) ** 0.5 - g[f] ** 0.5) / quality.ALPHA * w[f]
                g[f] += d * d
            w0 = [w0[0] + e - ((w0[1] + e * e) ** 0.5 - w0[1] ** 0.5) / quality.ALPHA * b, w0[1] + e * e]
    plain_bias = -w0[0] / ((quality.BETA + w0[1] ** 0.5) / quality.ALPHA)
    assert bias == pytest.approx(plain_bias, abs=1e-4) and all(weights[f] == pytest.approx(weight(f), abs=1e-3) for f in z)
    scores = {r["doc_id"]: r["score"] for r in quality.score(docs(texts), (weights, bias)).collect()}
    for i, text in enumerate(texts):
        want = 1 / (1 + math.exp(-(sum(weight(f) * v for f, v in counted(text).items()) + plain_bias)))
        assert scores[i] == pytest.approx(want, abs=1e-3)


def test_toxicity_against_a_plain_scorer():
    """Terms and exceptions looked for at every place of the folded text."""
    rng = random.Random(4)
    weights = {" idiot ": 3.0, " idio": 1.0, " trash ": 2.0, " tra": 0.5, " clown ": 1.5}
    words = ["idiot", "idiots", "trash", "can", "bin", "track", "clown", "fish", "proof", "tidy"]
    found = toxicity.automaton(weights)
    for _ in range(200):
        folded = toxicity.fold(" ".join(rng.choice(words) for _ in range(rng.randint(0, 14))))
        excused = set()
        for phrase in toxicity.EXCEPTIONS:
            for at in range(len(folded)):
                if folded.startswith(f" {phrase} ", at):
                    excused |= set(range(at, at + len(phrase) + 1))
        total = sum(max((w for t, w in weights.items() if folded.startswith(t, at)), default=0.0) for at in range(len(folded)) if at not in excused)
        assert toxicity.lexicon_sum(found, folded) == pytest.approx(total)


def test_long_texts_of_exceptions_take_linear_time():
    found = toxicity.automaton({" trash ": 2.0, " idiot ": 1.0})
    began = time.perf_counter()
    assert toxicity.lexicon_sum(found, toxicity.fold("trash can idiot " * 60_000)) == 60_000
    assert time.perf_counter() - began < 10
