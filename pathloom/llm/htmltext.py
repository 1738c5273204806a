"""Main text of web pages: flat text blocks, classified by a decision tree on word counts and link densities of each and its neighbours."""

from __future__ import annotations

import html
import random
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches
from .trees import DecisionTree

# Element names of HTML by what they do to text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend "
    "li main menu nav ol option optgroup p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
RAW_TAGS = frozenset("script style title textarea iframe noembed noframes".split())
DROPPED_TAGS = frozenset("noscript template svg math object canvas audio video".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form menu button select dialog search fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words of class and id names: those that tell of something beside the main text wherever they stand, and those that do so as a whole name only.
STRONG_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion popup modal cookie cookies consent sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "footer masthead topbar comments disqus replies related recommended newsletter subscribe pagination pager copyright".split()
)
WEAK_WORDS = frozenset("comment reply respond share sharing social notice notices alert header signup login widget tags toolbar skip legal".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())

_OPEN = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)")
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?", re.S)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def tags_of(page: str):
    """(start, end, closing, name, attributes) of the tags, comments (without name) and raw elements of a page, in time linear in its length.

    A quote in a tag hides what follows up to its like. Where the page ends before that, and ever after, tags end at the next >.
    """
    at, plain, size = 0, False, len(page)
    unended: set[str] = set()
    while True:
        start = page.find("<", at)
        if start < 0:
            return
        m = _OPEN.match(page, start)
        if not m:
            if page.startswith(("<!", "<?"), start):
                mark = "-->" if page.startswith("<!--", start) else "]]>" if page.startswith("<![CDATA[", start) else ">"
                end = page.find(mark, start + 2)
                at = size if end < 0 else end + len(mark)
                yield start, at, False, "", ""
            else:
                at = start + 1
            continue
        end = m.end()
        while not plain:
            stop = _STOP.search(page, end)
            if not stop:
                plain = True
            elif stop[0] == ">":
                end = stop.start()
                break
            else:
                end = page.find(stop[0], stop.end()) + 1
                plain = not end
        if plain:
            end = page.find(">", m.end())
            end = size if end < 0 else end
        name, attributes, at = m[2].lower(), page[m.end() : end], min(size, end + 1)
        if name in RAW_TAGS and not m[1]:
            # raw text ends at its own end tag only, whatever stands in between; without one, a script or style runs to the page's end
            close = None if name in unended else re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            if close:
                end = page.find(">", close.end())
                at = size if end < 0 else end + 1
            elif name in ("script", "style"):
                at = size
            else:
                unended.add(name)
            yield start, at, False, "", ""
        else:
            yield start, at, bool(m[1]), name, attributes


def mark_of(tag: str, attributes: str) -> int:
    """How much an element's name, class or role tells of something beside the main text: 2 plainly, 1 perhaps, 0 nothing."""
    if tag in BOILERPLATE_TAGS:
        return 2
    found = int(tag == "header")
    if not attributes or attributes.isspace() or tag in ("html", "body", "article", "main"):
        return found
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            for token in value.split():
                parts = {w.lower() for w in _PARTS.findall(token)}
                if parts & STRONG_WORDS or token.lower() in WEAK_WORDS or len(parts & WEAK_WORDS) > 1:
                    return 2
                found = max(found, int(bool(parts & WEAK_WORDS)))
        elif name == "role" and value.lower() in BOILERPLATE_ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
            return 2
    return found


class Block:
    """One run of text: its words, how many of them are in links, and where it stands."""

    __slots__ = ("text", "words", "linked", "mark", "article", "heading", "item", "own")

    def __init__(self, text, words, linked, mark, article, heading, item, own):
        self.text, self.words, self.linked, self.mark, self.article, self.heading, self.item, self.own = text, words, linked, mark, article, heading, item, own


class _Open:
    """The open block elements, with running counts, so that a block's place is known without a walk over them."""

    def __init__(self):
        self.stack: list[tuple] = []
        self.names, self.marks = Counter(), [0, 0, 0]
        self.headers = 0  # an article's own headers, which are marked 1 alone

    def push(self, tag: str, attributes: str) -> None:
        mark = mark_of(tag, attributes)
        if tag == "header" and mark == 1 and not (self.names["article"] or self.names["main"]):
            mark = 2
        self.stack.append((tag, attributes, mark))
        self.names[tag] += 1
        self.marks[mark] += 1

    def pop(self) -> str:
        tag, _, mark = self.stack.pop()
        self.names[tag] -= 1
        self.marks[mark] -= 1
        return tag

    def top(self) -> str:
        return self.stack[-1][0] if self.stack else ""

    def mark(self) -> int:
        return 2 if self.marks[2] else 1 if self.marks[1] else 0


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order, without those that have no text."""
    tags = list(tags_of(page))
    # dropped elements that end: the outermost pairs, however nested; one that never ends hides nothing
    waiting: dict[str, list[int]] = {}
    until: dict[int, int] = {}
    for i, (start, end, closing, name, attributes) in enumerate(tags):
        if name in DROPPED_TAGS:
            if closing and waiting.get(name):
                until[waiting[name].pop()] = i
            elif not closing and not attributes.endswith("/"):
                waiting.setdefault(name, []).append(i)
    out: list[Block] = []
    open_ = _Open()
    pieces: list[str] = []
    counts = [0, 0]
    in_link, at, skip = False, 0, -1

    def flush() -> None:
        if pieces:
            words = "".join(pieces).split()
            if words:
                names = open_.names
                heading, article = any(names[h] for h in HEADINGS), bool(names["article"] or names["main"])
                out.append(Block(" ".join(words), len(words), min(counts[1], len(words)), open_.mark(), article, heading, bool(names["li"]), open_.stack[-1][1] if open_.stack else ""))
            pieces.clear()
        counts[0] = counts[1] = 0

    def add(raw: str) -> None:
        if raw:
            text = html.unescape(raw)
            pieces.append(text)
            if in_link:
                counts[1] += len(text.split())

    for i, (start, end, closing, tag, attributes) in enumerate(tags):
        if i <= skip:
            at = end
            continue
        add(page[at:start])
        at = end
        if i in until:
            skip = until[i]
        elif tag == "head":
            flush()
        elif tag == "a":
            in_link = not closing
        elif tag == "br":
            pieces.append("\n")
        elif tag in BLOCK_TAGS:
            flush()
            if closing:
                if open_.names[tag]:
                    while open_.pop() != tag:
                        pass
                in_link = False
            elif tag not in VOID_TAGS:
                if tag in ("p", "li", "option") or tag in HEADINGS:
                    while open_.top() in ("p", "option") or open_.top() in HEADINGS or tag == "li" == open_.top():
                        open_.pop()
                elif open_.top() == "p":
                    open_.pop()
                open_.push(tag, attributes)
    add(page[at:])
    flush()
    return out


COLUMNS = "words link before_words before_link after_words after_link mark article page_article heading item".split()


def features(blocks: list[Block]) -> list[list[float]]:
    """A row for each block: own and neighbouring word counts and link densities, and where it stands."""
    w = [0, *(b.words for b in blocks), 0]
    d = [0.0, *(b.linked / b.words for b in blocks), 0.0]
    whole = any(b.article and b.mark < 2 for b in blocks)
    return [[w[i], d[i], w[i - 1], d[i - 1], w[i + 1], d[i + 1], b.mark, b.article, whole, b.heading, b.item] for i, b in enumerate(blocks, 1)]


# The labelled pages, made for this purpose. {n} stands for n words, [n] for n linked ones, {*} for 1 to 300; main text carries the
# attribute m.
TRAINING = """
<nav><ul><li>[1]<li>[1]<li>[2]</ul></nav><div class=ad>{9}</div><article><h1 m>{8}</h1><p m>{*}<p m>{*}<p m>{*}<p m>{*} [5]</article><footer>{12}</footer>
<nav><ul><li>[1]<li>[1]<li>[1]</ul></nav><div class=ad>{*}</div><article><h1 m>{*}</h1><p m>{*}<p m>{*}<p m>{*}<p m>{*}<p m>{*}</article><footer>{*}</footer>
<header><h2>{2}</h2><p>{*}</header><nav>[1] [1] [2]</nav><article><h1 m>{*}</h1><p m>{*}<p m>{*}<p m>[3]<p m>{*}</article><aside><h3>{3}</h3><p>{*}</aside><section id=comments><h3>{1}</h3><p>{*}<p>{*}</section><footer>[2] [3] {4}</footer>
<div class=cookie-banner>{30} [2]</div><article><header><h1 m>{9}</h1><p m>{24}<p>{3}</header><p m>{*}<aside>{*}</aside><p m>{*}<div class=ads>{14}</div><ul><li m>{4}<li m>{*}<li m>{3}</ul><p m>{*}<div class=related><p>[6]<p>[5]</div></article><p>{*}
<article><header>{2} <h1 m>{6}</h1><div>{4}</div><div m>{35}</div></header><p m>{*}<section class=share-prices><p m>{45}<p m>{18}</section><div class=social-buttons>[1] [1]</div><p m>{*}<div class=comment-count>[2]</div></article><footer><p>{*}</footer>
<article><h1 m>{*}</h1><div class=legal-news><p m>{50}<p m>{33}</div><div class=share-bar>{2}</div><p m>{*}<div class=notice-text><p m>{60}</div><div class=tags-list>[2] [1]</div><form><p>{*}</form><section class=comments><article><p>{*}</article><article><p>{*}</article></section></article>
<main><h1 m>{*}</h1><p m>{*}<p m>{*}<table><tr><td m>{1}<td m>{2}</table><blockquote m>{30}</blockquote><h2 m>{2}</h2><p m>[8]<p m>{*}</main><nav>[1] [2]</nav><div>{*}</div><p>{*}
<p>{*}<h2>{4}</h2><article><h2 m>{*}</h2><div m>{*}</div><div m>{*}</div></article><div>{*}</div><ul><li>{*}<li>[4]</ul>
<div id=header>[3]</div><ul><li>[1]<li>[2]<li>[1]</ul><h1 m>{7}</h1><p m>{80}<p m>{4}<p m>{50}<h2 m>{3}</h2><p m>{35} [3]<ul><li m>{9}<li m>{6}</ul><p m>{44}<div>[2] [2] [3]</div><p>{4}<div>[1]</div>
<div>[1] [1] [1]</div><div>{3}</div><div m>{120} [4]</div><div m>{18}</div><div m>{200}</div><div m>{7}</div><div m>{60}</div><div>[4] {1}</div><div>[5]</div><div>{5}</div>
<div>[2]</div><p>{6}<h2 m>{5}</h2><p m>{33}<p m>{150}<p m>{12}<p m>{64}<h3>{2}</h3><ul><li>[4]<li>[6]<li>[5]</ul><div class=copyright>{40}</div><p>{7} [3]
<table><tr><td>[2]<td>[1]</table><div m>{28}</div><div m>{90} [8]</div><div m>{9}</div><div m>{45}</div><div>{2}</div><div>[3]</div><div>[7] {2}</div>
<div class=sidebar><p>{*}<p>{*}</div><div class=content><h1 m>{6}</h1><p m>{100}<p m>{24}<p m>{3}<p m>{51}</div><div id=footer><p>{*}<p>[3]</div>
<div class=share-prices><p m>{50}<p m>{25}<p m>{80}</div><div class=comment-form>{3}</div><div class=comment-form>[4] {2}</div><div class=login-box>{6}</div>
<nav>[1] [1]</nav><article><h1 m>{*}</h1><p m>{*}<ul><li m>{*}<li m>{*}<li m>{*}</ul><p m>{*}</article>
<article><p m>{*}</article>
<article><header><h1 m>{2}</h1><p>{2}</header><p m>{*}<header><h2 m>{4}</h2></header><p m>{*}<div class=share-links>{3}</div></article><footer>{4}</footer>
<article><header><p>{3}<h1 m>{3}</h1></header><p m>{*}<p m>{*}</article>
<p>{*}<ul><li>{*}<li>{*}<li>{*}</ul><div>{*}</div><article><p m>{*}<ul><li m>{*}<li m>{*}</ul><p m>{*}<p m>{*}</article>
<p m>{20}<p m>{40}<p m>{16}<p m>{90}
"""  # noqa: E501


def training_rows(variants: int = 12, seed: int = 4) -> tuple[list[list[float]], list[int]]:
    """The blocks of `variants` forms of each page: lengths of ten and more words are drawn from 0.6 to 2.5 times those that stand there."""
    x, y, rng = [], [], random.Random(seed)

    def words(m) -> str:
        if m[1] == "*":
            n = int(300 ** rng.random())
        else:
            n = int(m[1]) if int(m[1]) < 10 else max(10, int(int(m[1]) * 2.5 ** rng.uniform(-0.5, 1)))
        return "w " * n

    for page in TRAINING.strip().split("\n"):
        for _ in range(variants):
            filled = re.sub(r"\[(\d+)\]", lambda m: f"<a href=x>{'w ' * int(m[1])}</a>", re.sub(r"\{(\d+|\*)\}", words, page))
            found = blocks_of(filled)
            x += features(found)
            y += [int("m" in b.own.split()) for b in found]
    return x, y


def trained() -> DecisionTree:
    return DecisionTree(*training_rows(), depth=12, least=4)


_tree: list[DecisionTree] = []


def main_text(page: str | None) -> str:
    """The main text of one page: blocks of main text in order, parted by an empty line."""
    if not page:
        return ""
    if not _tree:
        _tree.append(trained())
    found = blocks_of(page)
    return "\n\n".join(b.text for b, row in zip(found, features(found)) if _tree[0](row) >= 0.5)


def extract_text(pages: DataFrame) -> DataFrame:
    """`pages` (html, ...) without html, with the columns text and n_chars, which replace columns of these names.

    Cases: a null or empty page, and one without main text, give an empty text. Character references are decoded once; those
    that HTML doesn't know stay as they are. An unclosed comment, script or style hides the rest of the page, as it does in a browser; other
    unclosed elements and quotes hide nothing. Repeated rows give the same text, and there are no ties. Whole pages are read, however
    long, in time linear in their length. An empty table gives no rows.
    """
    bounded_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def text(page: pd.Series) -> pd.Series:
        return page.map(main_text, na_action=None)

    out = pages.withColumn("text", text(F.coalesce(F.col("html").cast("string"), F.lit("")))).withColumn("n_chars", F.char_length("text").cast("long"))
    return out.drop("html")
