"""Main text of pages: hand-marked pages, hostile ones, and the cases that the docstring names."""

import time

import pytest

from pathloom.llm import htmltext


def w(n, name="word"):
    return " ".join([name] * n)


# (page, blocks of main text) marked by hand
PAGES = [
    (f"<body><article><h1>A headline</h1><p>{w(30)}</p></article>", ["A headline", w(30)]),
    (f'<article><section class="share-prices"><p>{w(30)}</p></section><p>{w(9, "more")}</p></article>', [w(30), w(9, "more")]),
    (f"<article><header><h1>Title</h1><p>{w(20, 'lead')}</p></header><p>{w(40)}</p></article>", ["Title", w(20, "lead"), w(40)]),
    (f'<article><p>{w(30)}</p></article><section class="comments"><p>{w(40, "reader")}</p></section>', [w(30)]),
    (f'<nav><a>x</a></nav><article><p>{w(30)}</p><div class="comment"><p>{w(50, "reader")}</p></div><div class="newsletter-signup"><p>{w(20)}</p></div></article><footer>{w(30)}</footer>', [w(30)]),
    (f'<div class="notice"><p>{w(20)}</p></div><main><p>{w(3, "main")}</p><p>{w(30)}</p></main>', [w(3, "main"), w(30)]),
    (f"<div><a>Home</a> <a>x</a></div><div>{w(80)}</div><div>{w(6, 'short')}</div><div>{w(80)}</div><div>{w(3)}</div>", [w(80), w(6, "short"), w(80)]),
    (f"<article><p>{w(5)}</p><video src=x><p>{w(5, 'after')}</p></article>", [w(5), w(5, "after")]),
    (f"<article><object><object>in</object>inner</object><p>{w(5)}</p></article>", [w(5)]),
    (f"<article><noscript><p>none</p></noscript><p>{w(5)}</p><textarea>mine</textarea><svg><text>t</text></svg></article>", [w(5)]),
    (f'<article><p title="open>{w(5)}</p><p>{w(6, "b")}</p></article>', [w(5), w(6, "b")]),
    (f"<article><p>a &lt;b&gt; &amp;amp; &unknown; {w(3)}</p><script>var a='</p>';</script><style>p</style></article>", [f"a <b> &amp; &unknown; {w(3)}"]),
    ("", []),
    ("<p", []),
]


@pytest.mark.parametrize("number", range(len(PAGES)))
def test_marked_pages(number):
    page, blocks = PAGES[number]
    assert htmltext.main_text(page) == "\n\n".join(blocks)


@pytest.mark.parametrize("piece", ['<a "', '<a href="x>', "<textarea>", "<svg>", "<object><b ", "<!--", "&amp", "<", "</div>", "<div>", "<p a='", "<script", "<li><p>"])
def test_hostile_pages_take_linear_time(piece):
    began = time.time()
    htmltext.main_text(piece * (3_000_000 // len(piece)) + "</div></p>" * 1000)
    assert time.time() - began < 20


def test_tree_uses_neighbours():
    tree = htmltext.trained()
    used = {htmltext.COLUMNS[n[0]] for n in tree.nodes if n[0] >= 0}
    assert {"words", "link", "mark"} < used and used & {"after_words", "after_link", "before_words", "before_link"}
    x, y = htmltext.training_rows()
    assert sum((tree(r) >= 0.5) != bool(t) for r, t in zip(x, y)) <= 0.005 * len(y)


def test_extract_text_cases(spark):
    page = f'<html><head><title>T</title></head><body><nav><a href=x>Home</a></nav><article><h1>Head &amp; line</h1><p>First  <b>para</b>\ngraph.</p></article><footer>{w(9)}</footer>'
    long = f"<article><p>{w(50)}</p><p>{w(300_000, 'x')}</p></article>"
    rows = [(1, "u", page, 5), (1, "u", page, 5), (2, None, None, None), (None, "u", long, 1), (4, "u", "", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int").withColumnRenamed("url", "text")
    got = htmltext.extract_text(df).collect()
    assert sorted(r.n_chars for r in got) == sorted([30, 30, 0, 0, 50 * 5 - 1 + 2 + 2 * 300_000 - 1]) and all(len(r.text) == r.n_chars for r in got)
    assert htmltext.extract_text(df.limit(0)).count() == 0
