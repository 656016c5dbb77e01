from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from blockweave.llm import decontaminate, html_extract, labelled, mixing, quality, ragged, token_count, toxicity, url_filter

SF = "/root/testdata/sf0.01"

# HTML


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("<p></p>", ""),
        ("plain text", "plain text"),
        ("<p>a &amp; b&nbsp;c<br>d<p>e", "a & b c d\ne"),
        ("<div class='comment'>x</div>", ""),
        ("<article><p>One</p><script>var a='<p>'</script><form>q</form><p>2 &lt; 3</p></article>", "One\n2 < 3"),
        ("<nav><a>Menu</a></nav><article><h1>T</h1><p>foo<b>bar</b>  baz\n qux</p></article><footer>f</footer>", "T\nfoobar baz qux"),
        ("<article><p>Text here</p><section id=comments><article><p>many words of a reader here</p></article></section></article>", "Text here"),
        ("<!-- <p>no</p> --><p title='a > b'>yes</p><style>p{}", "yes"),
    ],
)
def test_extract(page, want):
    assert html_extract.extract(page) == want


WORDS = " ".join(f"word{i}" for i in range(60))


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<article><h1>Rain comes</h1><div class=share>Share this page with friends</div><p>{WORDS}</p></article>", f"Rain comes\n{WORDS}"),
        (f"<article><h1>Rain comes</h1><p>{WORDS}</p><div class=ad>{'buy now ' * 20}</div><p>Last words.</p></article>", f"Rain comes\n{WORDS}\nLast words."),
        (f"<main><h1>Rain comes</h1><form>{'your mail ' * 20}</form><p>{WORDS}</p><aside>{'see also ' * 20}</aside><p>End.</p></main>", f"Rain comes\n{WORDS}\nEnd."),
        (f"<div><h1>Rain comes</h1><div class=share>{'share it ' * 20}</div><p>{WORDS}</p><div class=ad>{'buy now ' * 20}</div><p>End.</p></div>", f"Rain comes\n{WORDS}\nEnd."),
        (f"<article><h1><a href=x>Rain comes</a></h1><p>{WORDS}</p><ul><li><a href=x>One</a></li><li><a href=x>Two</a></li></ul></article>", f"Rain comes\n{WORDS}\nOne\nTwo"),
        (f"<article><p>Start.</p>{'<figure><img></figure>' * 200}<p>{WORDS}</p></article><ul><li><a href=x>More</a></li></ul>", f"Start.\n{WORDS}"),
    ],
)
def test_asides_and_links_do_not_cut_an_article(page, want):
    assert html_extract.extract(page) == want


ARTICLE = f"<h1>Rain comes</h1><p>{WORDS}</p><p>Last words.</p>"


@pytest.mark.parametrize(
    "page",
    [
        *[f"<body><div class='{names}'><{tag}>{ARTICLE}</{tag}></div></body>" for names in ("site has-sidebar", "no-sidebar", "content no-comments", "page has-banner", "page_with_right_sidebar", "widget post") for tag in ("article", "main", "div")],
        f"<body><form id=aspnetForm><div><a href=x>Home</a></div><article>{ARTICLE}</article></form></body>",
        f"<body><form id=aspnetForm><nav><a href=x>Home</a></nav><div>{ARTICLE}</div><footer>Imprint</footer></form></body>",
        f"<body><div class='post comments'><main>{ARTICLE}</main></div></body>",
        f"<body><div id=content>{ARTICLE}</div><div id=comments><article><p>{WORDS} {WORDS}</p></article></div></body>",
        f"<body><article>{ARTICLE}</article><div id=comments><article><p>{WORDS} {WORDS}</p></article></div></body>",
        f"<body><article>{ARTICLE}</article><div class=sidebar><article><h1>Other</h1><p>{WORDS} {WORDS}</p></article></div></body>",
        f"<body><div>{ARTICLE}</div><form><p>Your name</p><p>Your mail</p></form><aside><article>{WORDS} {WORDS}</article></aside></body>",
        f"<body><div>{ARTICLE}</div><div class='no-print-share share'>Share it</div><div class='cookie-notice'><p>{WORDS} {WORDS}</p><p>{WORDS} {WORDS}</p></div></body>",
    ],
)
def test_marks_on_wrappers_do_not_silence_an_article(page):
    assert html_extract.extract(page) == f"Rain comes\n{WORDS}\nLast words."


def test_deep_nesting():
    assert html_extract.extract("<div class=ad><b>" * 3000 + "x" + "</div>" * 3000 + "<p>y</p>") == "y"


class Blocks(HTMLParser):
    """An extraction of its own for well-formed articles: texts of blocks, without what asides hold."""

    def __init__(self, page):
        super().__init__()
        self.lines, self.away = [""], 0
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        kind = dict(attrs).get("class") or ""
        if self.away or tag in ("aside", "form") or kind in ("share", "ad-box"):
            self.away += tag != "input"
        elif tag in html_extract.BLOCKS:
            self.lines.append("")

    def handle_endtag(self, tag):
        if self.away:
            self.away -= 1
        elif tag in html_extract.BLOCKS:
            self.lines.append("")

    def handle_data(self, data):
        if not self.away:
            self.lines[-1] += data

    def text(self):
        return "\n".join(line for line in (" ".join(x.split()) for x in self.lines) if line)


@pytest.mark.parametrize("page", html_extract.LABELLED)
def test_labelled_pages(page):
    start, end = page.index("⟦"), page.index("⟧")
    assert html_extract.extract(page.replace("⟦", "").replace("⟧", "")) == Blocks(page[start + 1 : end]).text()


@pytest.mark.parametrize("wrapper", range(len(html_extract._WRAPPERS)))
def test_layouts_left_out_of_the_fit(wrapper):
    """Weights fitted on the other layouts find the article in this one."""
    each = len(html_extract._INSIDE)
    by_rule = html_extract._by_rule()
    mine = by_rule[wrapper * each : (wrapper + 1) * each]
    weights = html_extract.fit([p for p in html_extract.LABELLED if p not in mine])
    for page in mine:
        start, end = page.index("⟦"), page.index("⟧")
        assert html_extract.extract(page.replace("⟦", "").replace("⟧", ""), weights) == Blocks(page[start + 1 : end]).text()


@pytest.mark.parametrize("names", ["page has-sidebar", "no-sidebar", "post with-comments", "nav-open layout", "entry widget", "theme-share-button", "footer-fixed page", "cookie-bar-visible", "comments-page single", "story notice", "related"])
@pytest.mark.parametrize("page", ["<body><div class='{0}'>{1}</div></body>", "<body class='{0}'><div>{1}</div></body>", "<body><div class='{0}'><div class=menu><a href=x>Home</a></div><div id=content>{1}</div><div class=footer>(c) 2020</div></div></body>"])
def test_layout_classes_keep_their_text(names, page):
    assert html_extract.extract(page.format(names, ARTICLE)) == f"Rain comes\n{WORDS}\nLast words."


HOSTILE = {
    "quotes": lambda n: '<a "' * n,
    "closers": lambda n: "<div>" * n + "</p></b>" * n,
    "strays": lambda n: "<div>" * n + "x</span>" * n,
    "odd quotes": lambda n: "<a '>' " * n + "'",
    "open tags": lambda n: "<p " * n,
    "inline": lambda n: "<td>" + "<b>" * n + "<p></p>" * n,
    "names": lambda n: f"<div class='has{'_advert' * n}!'>x</div>",
    "words": lambda n: "<p>" + "word " * n,
}


@pytest.mark.parametrize("kind", HOSTILE)
def test_hostile_pages_take_linear_time(kind):
    import time

    page = HOSTILE[kind](1_000_000 // (len(HOSTILE[kind](2)) - len(HOSTILE[kind](1))))
    began = time.perf_counter()
    html_extract.extract(page)
    assert len(page) > 900_000 and time.perf_counter() - began < 10


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/\"'=!- pabdiv&;#3\n", max_size=80))
def test_extract_takes_anything(page):
    text = html_extract.extract(page)
    assert text == "\n".join(" ".join(line.split()) for line in text.split("\n") if line.strip())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=12))
def test_region_is_the_best(scores):
    a, b = html_extract.region([float(s) for s in scores])
    best = max([0, *(sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1))])
    assert sum(scores[a:b]) == best


def test_pages_of_a_table(spark):
    rows = [(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(0))
    assert sorted(str(tuple(r)) for r in html_extract.extract_pages(df).collect()) == ["(1, 'u', 'a', 1)", "(1, 'u', 'a', 1)", "(None, None, '', 0)"]
    assert html_extract.extract_pages(df.limit(0)).count() == 0


# URL filters


@pytest.mark.parametrize(
    "url, want",
    [
        (None, ("", "", None, "allow")),
        ("no scheme", ("", "", None, "allow")),
        ("http://A.Example.COM/en/7x?casino", ("a.example.com", "/en/7x", "example.com/en/7", "allow")),
        ("http://example.com/en/8", ("example.com", "/en/8", "com/en/", "block")),
        ("http://notcom/en/", ("notcom", "/en/", None, "allow")),
        ("x://y.net/de/8", ("y.net", "/de/8", "net/de/", "allow")),
        ("x://example.net/de/8#q", ("example.net", "/de/8", "example.net/de/8", "block")),
        ("http://h.io/big-casino/", ("h.io", "/big-casino/", None, "block")),
        ("http://h.io/casinoroyal/free", ("h.io", "/casinoroyal/free", None, "allow")),
        ("http://free.io/free/FREE", ("free.io", "/free/FREE", None, "allow")),
        ("http://free.io/a?win=1", ("free.io", "/a", None, "block")),
        ("a://b://c/d", ("b:", "//c/d", None, "allow")),
    ],
)
def test_urls(spark, url, want):
    row = url_filter.judge(spark.createDataFrame([(1, url)], "page_id long, url string")).first()
    assert tuple(row)[1:5] == want


# Token counts

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
COUNTER = token_count.Counter(token_count.load(public_tokenizers.path("byte_bpe_50k.json")), cache=50)


def counted(texts, limit=1 << 19):
    out = []
    for _, flat, off in ragged.chunks(pa.record_batch({"t": pa.array(texts, pa.string())}), "t", limit):
        out += COUNTER(flat, off).tolist()
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.lists(st.sampled_from(["a", "'", "s", "'ll", " ", "  ", "\n", "<|endoftext|>", "1", "!", "é", " ", "\u3000", "The", "中", "\x85"]), max_size=25).map("".join)), max_size=6))
def test_tokens_equal_the_library(texts):
    want = [len(TOKENIZER.encode(t, add_special_tokens=False).ids) for t in texts]
    assert counted(texts) == want and counted(texts, 7) == want


def test_odd_tokens():
    texts = ["a" * 5000, " " * 3000 + "x", "\n" * 999, None, "", "<|endoftext|><|endoftext|>", "'" * 50 + "s"]
    assert counted(texts) == [len(TOKENIZER.encode(t or "").ids) for t in texts]


def test_token_table(spark, docs):
    df = docs(["hello world", None, "x " * 600]).withColumn("n_bytes", F.lit("clash"))
    rows = {r["doc_id"]: tuple(r)[1:] for r in token_count.count(df, public_tokenizers.path("byte_bpe_50k.json")).collect()}
    assert rows[0] == (11, 2, False) and rows[1] == (0, 0, False) and rows[2][2]
    assert token_count.count(docs([]), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


# Decontamination


def test_containment_against_brute_force(spark, docs, corpus, shingle):
    items = [t for t in corpus if t and len(t.split()) > 20][:12] + ["just three words", "", None, "one"]
    items = [" ".join(t.split()[5:-5]) if t and len(t.split()) > 20 else t for t in items]
    texts = [*corpus, "here are just THREE words", None]
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = set()
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            if k := min(5, len((item or "").split())):
                w = [x.lower() for x in (text or "").split()]
                mine, need = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}, shingle(item, k)
                if 100 * len(need & mine) >= 80 * len(need):
                    want.add((d, i, len(need), len(need & mine)))
    assert {tuple(r) for r in decontaminate.search(docs(texts), table).collect()} == want and len(want) > 10
    kept = decontaminate.drop_contaminated(docs(texts), table)
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - {w[0] for w in want}


def test_blocks_of_items_agree(spark, docs, corpus, monkeypatch):
    table = spark.createDataFrame([(i, t) for i, t in enumerate(corpus) if t], "item_id long, text string")
    whole = sorted(decontaminate.search(docs(corpus), table).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", 500)
    assert sorted(decontaminate.search(docs(corpus), table).collect()) == whole
    assert decontaminate.search(docs([]), table).count() == decontaminate.search(docs(corpus), table.limit(0)).count() == 0


def test_rows_of_null_and_repeated_ids_are_judged_alone(spark):
    rows = [(None, "one two three four five six"), (None, "quite clean"), (7, "one two three four five six"), (7, "clean too"), (8, None)]
    items = spark.createDataFrame([(1, "one two three four five")], "item_id long, text string")
    kept = decontaminate.drop_contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items)
    assert sorted(str(tuple(r)) for r in kept.collect()) == ["(7, 'clean too')", "(8, None)", "(None, 'quite clean')"]


@pytest.mark.parametrize("n", [*range(1, 200), 500, 4000])
def test_sketches_reach_every_containment(n):
    """With all that may lack lacking, a hash of the sketch is there."""
    assert decontaminate.sketch_size(n) > n - -(-80 * n // 100)


def test_colliding_hashes_and_long_items(spark, docs, shingle, monkeypatch):
    """The words decide even where every hash is the same; items of hundreds of shingles are found wherever they lie."""
    long = [f"w{i}" for i in range(600)]
    near = [w if i % 30 else "other" for i, w in enumerate(long)]
    texts = [" ".join(["x"] * 50 + near + ["y"] * 9), " ".join(long[:400]), "a b c d e f", None, "", " ".join(long * 3)]
    items = spark.createDataFrame([(1, " ".join(long)), (2, "a b c d e"), (3, "f e d c b a"), (4, "nothing of it")], "item_id long, text string")
    want = [(0, 1, False), (2, 2, True), (5, 1, True)]
    want = [(d, i) for d, i, _ in want if 100 * len(shingle(texts[d]) & shingle(items.where(f"item_id = {i}").first()["text"])) >= 80 * len(shingle(items.where(f"item_id = {i}").first()["text"]))]
    assert sorted(tuple(r)[:2] for r in decontaminate.search(docs(texts), items).collect()) == want and (5, 1) in want
    index = decontaminate.Index(decontaminate.item_sets(items.toArrow()))
    flat, off = ragged.buffers(pa.array([t or "" for t in texts]))
    exact = index.pairs(flat, off)
    monkeypatch.setattr(ragged, "word_hashes", lambda flat, off, lower=True: (np.full(len(ragged.words(flat, off)[0]), 7, np.uint64), ragged.words(flat, off)[2]))
    index = decontaminate.Index(decontaminate.item_sets(items.toArrow()))
    assert exact == index.pairs(flat, off) and len(exact) == len(want)


# Mixing


def water(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in capped else share[s] for s in names}
        capped |= over


def test_mix(docs, corpus):
    sources = ["b", "a", None, "é", "Z", "b", "b", "b"]
    table = docs(corpus * 3, sources=sources)
    rows = mixing.mix(table).collect()
    assert sorted(rows) == sorted(mixing.mix(table.repartition(3)).collect())
    sizes, taken = {}, {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = water(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    for s in sizes:
        assert taken[s] == int(want[s] + 1e-6)


def test_mixture_and_odd_tables(spark, docs):
    assert mixing.mix(docs([])).count() == 0 and mixing.mixture(docs([])).count() == 0
    df = docs(["a b", None, "", "c"], sources=["x", "y"]).withColumn("size", F.lit("clash")).withColumn("key", F.lit(0))
    rows = mixing.mixture(df).collect()
    assert sum(r["mix_words"] for r in rows) in (2, 3)
    assert all(r["taken"] == 0 for r in mixing.mix(docs([None, ""])).collect())


# Trained operators


def fitted(spark, op, label, modulus, held):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op(spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    right = [r["predicted"] == labels[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in labels]
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == held) for r in rows)
    return sum(right) / len(right)


def test_quality_on_held_out_rows(spark):
    assert fitted(spark, quality.op4_quality_classifier, "quality", 3, 1) > 0.95


def test_toxicity_on_held_out_rows(spark):
    assert fitted(spark, toxicity.op10_toxicity, "toxic", 5, 0) > 0.93


def test_training_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = docs(["some text", None, "", "you idiot, you worthless moron " * 3])
    assert {r["score"] for r in quality.score(df, quality.train(df, none)).collect()} == {0.5}
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(df, toxicity.train(df, none)).collect()}
    assert scores[3] > 0.5 > max(scores[i] for i in (0, 1, 2))
    assert quality.keep_good(df.withColumn("score", F.lit("x")), quality.train(df, none)).columns == [*df.columns, "score"]
    assert quality.score(docs([]), quality.train(df, none)).count() == toxicity.score(docs([]), toxicity.train(df, none)).count() == 0


def test_held_out_labels_are_never_learned(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(300)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    import zlib

    for label, modulus, held in (("quality", 3, 1), ("toxic", 5, 0)):
        ids = [r["doc_id"] for r in labelled.sample(docs(["x"] * 300), labels, label, modulus, held, 100).collect()]
        assert len(ids) == len(set(ids)) == 100 and all(zlib.crc32(str(i).encode()) % modulus != held for i in ids)


@pytest.mark.parametrize("text, same", [("IDIOT", "idiot"), ("1d1ot", "idiot"), ("іdіоt", "idiot"), ("ｉｄｉｏｔ", "idiot"), ("id\u200biot", "idiot"), ("idiot!?", "idiot"), ("", "")])
def test_fold(text, same):
    assert toxicity.fold(text).split() == same.split()


def test_exceptions_and_the_heaviest_term():
    found = toxicity.automaton({" trash ": 2.0, " tra": 1.0, " idiot": 3.0})
    value = lambda t: toxicity.lexicon_sum(found, toxicity.fold(t))
    assert value("trash") == 2 and value("the trash can") == 0 and value("trash, idiots") == 5 and value("extrash") == 0
