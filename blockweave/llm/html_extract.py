"""HTML extraction by a maximum-scoring subsequence.

A page is read as a sequence of words and tags.  Words score by where they stand, tags below zero by what they are, with
weights fitted as log-odds on labelled pages; one linear scan finds the contiguous region of the highest sum.  Inside
``<article>`` or ``<main>`` nothing scores below zero, so that asides, tags and links don't cut it.  The region's
text is given block by block, without what stands in menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles and reader comments, by element, role, or class and id names.  Such a mark doesn't count on an element that holds the
page's article, or on a page without ``<article>`` and ``<main>`` most of its words; nor do names like has-sidebar or no-comments.
Every step is linear in the page: tags are found by one scan, and open elements are looked up by name.

Character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined in page order by
one newline; nothing else is dropped or cut.

Edge cases: null, empty and wordless pages give an empty text; text outside of any tag is a block; elements that aren't
closed end with the page or with an enclosing element; a tag that isn't closed is text, and from a quote that isn't
closed on, a tag ends at the next ``>``; repeated rows give equal results; an empty
table an empty one; further columns play no part.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from blockweave.llm.shared import small_batches

#: Elements whose content is no text.
RAW = ("script", "style", "template", "noscript", "iframe", "svg", "math", "object", "textarea", "title", "canvas", "video", "audio", "xmp", "noembed", "noframes")
#: Elements that are never part of an article.
ASIDE = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "fieldset", "datalist"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
#: Parts of class and id names that mark what isn't the article.
_PARTS = (
    r"ad|ads|advert[a-z]*|adsense|sponsor\w*|promo[a-z]*|banner|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side-bar|aside|footer|masthead|site-header|page-header|topbar"
    r"|cookies?|consent|gdpr|notices?|notification|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|related|recommended|comments?|commentlist|disqus|respond|replies|widget|toolbar|pagination|pager|skip-link"
)
NAMES = re.compile(rf"(?:^|[\s_-])(?:{_PARTS})(?:$|[\s_-])", re.I)
#: Names that say what an element has or lacks, not what it is.
STATES = re.compile(rf"(?:^|(?<=[\s_-]))(?:has|no|with|without)(?:[_-](?:left|right|top|bottom|primary|secondary|main|site|page|header|page-head|logo|sidebars|\d+|{_PARTS}))+(?=$|[\s_-])", re.I)
#: Names that hold no article, however long they are.
APART = re.compile(r"(?:^|[\s_-])(?:footer|cookies?|consent|gdpr|notices?|related|recommended|comments?|commentlist|disqus|respond|replies)(?:$|[\s_-])", re.I)
BLOCKS = set(
    "address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Blocks that hold other blocks; a few words that stand in them alone are rarely part of an article.
HOLDERS = {"", "html", "body", "div", "section", "header", "center", "tr", "table"}
FEW = 3
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES_P = BLOCKS - {"body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt", "legend", "summary", "figcaption"}
_OPEN = re.compile(r"<(?:(?P<comment>!--)|(?P<other>[!?])|(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*))")
_UNQUOTED = re.compile("[^>\"']*")
_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
#: Closing tags that also end the cells and tables that are open in their element.
_ENDS_TABLES = {"table", "tr", "tbody", "thead", "tfoot", "div", "section", "article", "main", "body", "html"}
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
#: Names that mark a page's head where they stand outside of the article.
HEADS = re.compile(r"(?:^|[\s_-])(?:header|page-head|top|logo)(?:$|[\s_-])", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)

#: Labelled pages written by hand: what stands between ⟦ and ⟧ is the article.
BY_HAND = (
    "<html><head><title>t</title></head><body><header><a href=x>Site name</a></header><nav><ul><li><a href=x>Home</a></li><li><a href=x>About us</a></li><li><a href=x>Contact</a></li></ul></nav><article>⟦<h1>A first title here</h1><p>The first paragraph has many words in a row, as articles do.</p><p>A second one <b>follows</b> and <a href=x>links</a> to a page.</p><p>Short end.</p>⟧</article><aside><h3>More</h3><ul><li><a href=x>One more</a></li><li><a href=x>Another one</a></li></ul></aside><footer><p>All rights reserved</p></footer></body></html>",
    "<body><div class=top><a href=x>Log in</a> <a href=x>Register</a></div><div class=menu><a href=x>News</a><a href=x>Sport</a><a href=x>Weather</a></div><div id=content>⟦<h2>Rain is coming</h2><p>It will rain in most places tomorrow, and the wind gets stronger in the evening.</p><ul><li>North: light rain at first</li><li>South: dry until noon</li></ul><blockquote>Take an umbrella, the office says.</blockquote><p>Later in the week it clears up.</p>⟧</div><div class=ad>Buy umbrellas now</div><div class=comments><h4>Comments</h4><p>First!</p><p>I like rain.</p></div></body>",
    "<body><div><a href=x>Start</a> | <a href=x>Shop</a> | <a href=x>Help</a></div><div><div><span>Mon 3</span></div></div><main>⟦<h1>How to bake</h1><p>Mix flour and water, wait an hour, then knead the dough until it is smooth.</p><ol><li>Heat the oven</li><li>Bake for an hour</li></ol><table><tr><th>Flour</th><td>500 g of wheat</td></tr></table><p>Let it cool before you cut it.</p>⟧</main><div><form><input><span>Search this site</span></form></div><div><a href=x>Imprint</a> <a href=x>Privacy</a></div></body>",
    "<body><div class=cookie-notice>We use cookies <a href=x>Accept</a></div><div><ul><li><a href=x>A</a></li><li><a href=x>B</a></li></ul></div><div><div>⟦<p>Letters from readers came in great number this week, and we print a few of them here.</p><p>One wrote about the bridge, another about the trees along the river that fell in the storm.</p><p>Thank you all.</p>⟧</div></div><div class=share><a href=x>Share</a><a href=x>Send</a></div><div><span>2020</span> <a href=x>Terms of use</a></div></body>",
)

_WORDS = "the river rose over night and people from both towns came to carry sand while rain fell on roofs fields markets old bridges until morning light showed how far water had gone".split()
_WRAPPERS = (
    ("<article>", "</article>"),
    ("<main>", "</main>"),
    ("<main><article>", "</article></main>"),
    ("<div id=content>", "</div>"),
    ("<div class='page has-sidebar'><div>", "</div></div>"),
    ("<section class='post with-comments'>", "</section>"),
    ("<div class='entry widget'><div class=text>", "</div></div>"),
    ("<table><tr><td>", "</td></tr></table>"),
)
_BEFORE = (
    "<header><a href=x>{0}</a></header><nav><ul><li><a href=x>{1}</a></li><li><a href=x>{2}</a></li></ul></nav>",
    "<div class=menu><a href=x>{0}</a> <a href=x>{1}</a> <a href=x>{2}</a></div>",
    "<div><a href=x>{0}</a> | <a href=x>{1}</a></div><div class=cookie-notice><p>{2} {0}</p><a href=x>{1}</a></div>",
    "<ul><li><a href=x>{0} {1}</a></li><li><a href=x>{2}</a></li><li><a href=x>{1}</a></li></ul><div><span>{0}</span></div>",
)
_INSIDE = ("", "<div class=share><a href=x>{0}</a> {1}</div>", "<aside><p>{0} {1} {2}</p></aside>", "<form><label>{0}</label><input></form>", "<div class=ad-box>{0} {1} {2}</div>")
_AFTER = (
    "<footer><p>{0} {1}</p></footer>",
    "<div class=comments><h4>{0}</h4><p>{1}</p><p>{2}</p></div>",
    "<aside><h3>{0}</h3><ul><li><a href=x>{1}</a></li><li><a href=x>{2}</a></li></ul></aside><footer>{0}</footer>",
    "<div class=related><a href=x>{0}</a><a href=x>{1}</a></div><div id=footer><a href=x>{2}</a></div>",
    "<div><span>{0}</span> <a href=x>{1}</a></div><div>{0}</div>",
)


def _by_rule() -> list[str]:
    """Labelled pages of every layout with every kind of aside, their words in a fixed rotation."""
    pages, turn = [], 0

    def say(n: int) -> str:
        nonlocal turn
        turn += 7
        return " ".join(_WORDS[(turn + i * i) % len(_WORDS)] for i in range(n))

    for w, (begin, end) in enumerate(_WRAPPERS):
        for i, inside in enumerate(_INSIDE):
            fill = lambda part: part.format(say(2), say(1 + w % 3), say(3))
            before, after = _BEFORE[(w + i) % len(_BEFORE)], _AFTER[(w + 2 * i) % len(_AFTER)]
            middle = f"<ul><li>{say(4)}</li><li>{say(3)} <a href=x>{say(2)}</a></li></ul>" if i % 2 else f"<blockquote>{say(9)}</blockquote><p>{say(14)} <a href=x>{say(3)}</a> {say(5)}</p>"
            article = f"<h1>{say(4)}</h1>{fill(inside)}<p>{say(30 + 5 * i)}</p>{middle}<h2>{say(3)}</h2><p>{say(22)} <b>{say(2)}</b> {say(6)}</p>{fill(inside)}<p>{say(5)}</p>"
            pages.append(f"<html><head><title>{say(3)}</title></head><body>{fill(before)}{begin}⟦{article}⟧{end}{fill(after)}</body></html>")
    return pages


#: All pages that the weights are fitted on.
LABELLED = (*BY_HAND, *_by_rule())

Token = tuple[str, str, bool, int, bool]  # kind of score, text ("" for a tag), aside, number of block, where nothing scores below zero


def _marks(name: str, attrs: str, in_main: bool = True) -> int:
    """Whether an element's name or attributes set it apart from the article.

    0 no, 1 yes, 2 yes, and it is a wrapper of one only with the page's headline, 3 yes, and it is no wrapper of one.
    """
    if name in ASIDE:
        return 1 if name in ("form", "fieldset") else 3
    if name in ("html", "body", "main", "article") or "=" not in attrs and "hidden" not in attrs.lower():
        return 0
    mark = 3 if _HIDDEN.search(attrs) else 0
    for m in _ATTRIBUTE.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id"):
            value = STATES.sub("", value)
            if NAMES.search(value) or not in_main and HEADS.search(value):
                mark = max(mark, 2 if APART.search(value) else 1)
        elif key == "role" and value.strip().lower() in ROLES:
            mark = max(mark, 1 if value.strip().lower() == "form" else 3)
        elif key == "hidden" and not value or key == "aria-hidden" and value.lower() == "true":
            mark = 3
    return mark


class _Element:
    """An element, its mark, and what it holds; ``aside`` is the highest mark from it upwards."""

    __slots__ = ("name", "parent", "mark", "link", "mains", "articles", "words", "head", "parts", "aside", "holder")

    def __init__(self, name: str, parent: _Element | None, mark: int):
        self.name, self.parent, self.mark = name, parent, mark
        self.holder = name if name in BLOCKS or parent is None else parent.holder
        self.link = name == "a" or parent is not None and parent.link
        self.mains = (name in ("article", "main")) + (parent.mains if parent else 0)
        self.articles = (name == "article") + (parent.articles if parent else 0)
        self.words, self.head, self.parts = 0, name == "h1", (name == "p") + 2 * (name in ("header", "nav", "footer"))


def _tags(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """Start, end, name, whether it closes, and attributes of each tag; what is no text (comments, scripts) has no name."""
    at, plain = 0, False
    while (m := _OPEN.search(page, at)) is not None:
        if m["comment"]:
            end = page.find("-->", m.end())
            at = len(page) if end < 0 else end + 3
            yield m.start(), at, "", False, ""
            continue
        end = -1 if plain or m["other"] else _tag_end(page, m.end())
        if end < 0:  # a quote isn't closed, here or before: attributes are no longer told apart
            plain = plain or not m["other"]
            end = page.find(">", m.end())
            if end < 0:
                return
        at = end + 1
        if m["other"]:
            yield m.start(), at, "", False, ""
            continue
        name = m["name"].lower()
        if name in _END and not m["close"]:
            close = _END[name].search(page, at)
            at = len(page) if close is None else close.end()
            yield m.start(), at, "", False, ""
        else:
            yield m.start(), at, name, bool(m["close"]), page[m.end() : end]


def _tag_end(page: str, at: int) -> int:
    """Where a tag's ``>`` stands outside of quotes; -1 if it doesn't."""
    while (at := _UNQUOTED.match(page, at).end()) < len(page):
        if page[at] == ">":
            return at
        at = page.find(page[at], at + 1) + 1
        if not at:
            return -1
    return -1


class _Stack:
    """Open elements, found by name and by whether they are blocks."""

    def __init__(self, top: _Element):
        self.items, self.named, self.blocks = [top], {}, []

    def push(self, e: _Element) -> None:
        self.named.setdefault(e.name, []).append(len(self.items))
        if e.name in BLOCKS:
            self.blocks.append(len(self.items))
        self.items.append(e)

    def last(self, name: str) -> int:
        return self.named[name][-1] if self.named.get(name) else 0

    def cut(self, at: int) -> None:
        """Closes the element at this place and all in it."""
        while len(self.items) > at:
            self.named[self.items.pop().name].pop()
        while self.blocks and self.blocks[-1] >= at:
            self.blocks.pop()

    def close(self, name: str) -> None:
        at = self.last(name)
        if at and (name in _ENDS_TABLES or at >= max(self.last("td"), self.last("th"), self.last("table"))):
            self.cut(at)

    def close_block(self, name: str) -> None:
        """Closes the innermost block if it has this name."""
        if self.blocks and self.items[self.blocks[-1]].name == name:
            self.cut(self.blocks[-1])


def _parse(page: str) -> tuple[list[tuple[str, str, _Element, int]], list[_Element]]:
    """Texts ("" as the tag) and tags of a page with the element and the block they stand in, and all elements, outer ones first."""
    top = _Element("", None, 0)
    stack, elements, found = _Stack(top), [top], []
    at = block = 0
    for start, end, name, closes, attrs in _tags(page):
        if start > at:
            found.append(("", page[at:start], stack.items[-1], block))
        at = end
        if not name:
            continue
        if name in BLOCKS:
            block += 1
        if name == "br":
            found.append(("tag:br", " ", stack.items[-1], block))
            continue
        if closes:
            stack.close(name)
        else:
            if name in _CLOSES_P or name == "li":
                stack.close_block("li" if name == "li" else "p")
            if name not in VOID and not attrs.rstrip().endswith("/"):
                parent = stack.items[-1]
                mains = parent.mains > 0
                stack.push(_Element(name, parent, _marks(name, attrs, mains) or (name == "header" and not mains and 3)))
                elements.append(stack.items[-1])
        found.append((f"tag:{name}", "", stack.items[-1], block))
    if at < len(page):
        found.append(("", page[at:], stack.items[-1], block))
    return found, elements


def _lift(elements: list[_Element]) -> _Element | None:
    """Takes marks off the elements that hold the page's article, which is returned if it is an element of its own.

    That is a ``<main>``, else an ``<article>`` that is in no other, an unmarked one first; in what is always apart it counts only
    with an ``<h1>``.  Without one, a wrapper holds two thirds of the words that aren't links, and paragraphs or parts of a page;
    one whose name is that of a part below the article also the ``<h1>``.
    """
    for e in elements:
        e.aside = max(e.mark, e.parent.aside if e.parent else 0)
    best, chosen = None, None
    for e in elements:
        if e.name not in ("article", "main") or not e.words or e.name == "article" and e.articles > 1:
            continue
        if e.name == "article" and not e.head and e.aside > 1:
            continue
        rank = (e.name == "main", not e.aside, e.head, e.words)
        if best is None or rank > best:
            best, chosen = rank, e
    if chosen is not None:
        e = chosen
        while (e := e.parent) is not None:
            e.mark = 0
    else:
        for e in elements:
            if (e.mark == 1 or e.mark == 2 and e.head) and e.parts > 1 and 3 * e.words > 2 * elements[0].words:
                e.mark = 0
    for e in elements:
        e.aside = max(e.mark, e.parent.aside if e.parent else 0)
    return chosen


def tokens(page: str) -> Iterator[Token]:
    """Texts and tags of a page, in order."""
    found, elements = _parse(page)
    in_block = Counter()
    for tag, text, e, block in found:
        if not tag and not e.link:
            e.words += (n := len(text.split()))
            in_block[block] += n
    for e in reversed(elements):
        if e.parent is not None:
            e.parent.words += e.words
            e.parent.head |= e.head
            e.parent.parts += e.parts
    has_main = _lift(elements) is not None
    has_article = any(e.name == "article" and e.words and not e.aside for e in elements)
    def loose(e: _Element, block: int) -> bool:
        return e.holder in HOLDERS and in_block[block] <= FEW

    # a page of nothing else has its text in them
    some = any(not tag and not e.link and not e.aside and text.strip() and not loose(e, block) for tag, text, e, block in found)
    for tag, text, e, block in found:
        kind = tag or ("aside" if e.aside else "outside" if has_main and not e.mains else "link" if e.link else "loose" if some and loose(e, block) else "word")
        yield kind, text, e.aside > 0, block, e.mains > 0 and (e.aside or e.articles > 0 or not has_article)


def fit(pages: Iterable[str] = LABELLED) -> dict[str, float]:
    """Weights of words and tags: log-odds of standing inside the labelled article; tags stay below zero."""
    inside, outside = Counter(), Counter()
    for page in pages:
        parts = re.split("([⟦⟧])", page)
        plain, marks, length = [], [], 0
        for part in parts:
            if part in "⟦⟧" and part:
                marks.append(length)
            else:
                plain.append(part)
                length += len(part)
        seen = 0
        text = "".join(plain)
        for kind, words, *_ in tokens(text):
            n = len(words.split()) if not kind.startswith("tag:") else 1
            # a token stands where its first character does; tags have none, so the text read so far places them
            if words.strip():
                seen = text.find(words, seen)
            (inside if marks[0] <= seen < marks[1] else outside)[kind] += n
            if words.strip():
                seen += len(words)
    weights = {}
    for kind in {*inside, *outside}:
        odds = math.log((inside[kind] + 0.5) / (outside[kind] + 0.5))
        weights[kind] = min(-0.02, 0.1 * odds) if kind.startswith("tag:") else odds
    return weights


WEIGHTS = fit()
OTHER_TAG = -0.05


def region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous part with the highest sum; of equal ones the first, then the longest."""
    best = total = 0.0
    start = at = end = 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, at = 0.0, i
        total += score
        if total > best:
            best, start, end = total, at, i + 1
    return start, end


def scores(found: Iterable[Token], weights: dict[str, float]) -> list[float]:
    """What each token adds to a region.

    The article's own tags add nothing, nor do asides in it.  On a page without ``<article>`` and ``<main>``, asides between two
    words weigh together as one word, however long they are.
    """
    out, parted = [], False
    for kind, text, aside, _, inside in found:
        n = len(text.split())
        if kind.startswith("tag:"):
            out.append(0.0 if aside or inside else weights.get(kind, OTHER_TAG))
        elif aside:
            out.append(0.0 if inside or parted or not n else weights["aside"])
            parted = parted or n > 0
        else:
            out.append(weights["word" if inside else kind] * n)
            parted = parted and not n
    return out


def extract(page: str | None, weights: dict[str, float] = WEIGHTS) -> str:
    """The main text of a page."""
    if not page:
        return ""
    found = list(tokens(page))
    start, end = region(scores(found, weights))
    blocks: dict[int, list[str]] = {}
    for _, text, aside, block, _ in found[start:end]:
        if text and not aside:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join(entities.unescape("".join(parts)).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def extract_pages(pages: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    kind = dict(pages.dtypes)["page_id"]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [extract(page.as_py(), weights) for page in part.column("html")]
                yield pa.record_batch([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def op1_html_extraction(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
