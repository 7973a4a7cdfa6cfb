"""Main text extraction: the given pages against a template reading, and pages of other makes."""

from __future__ import annotations

import html
import re
import time

import pytest

from haven.llm.common import read_table
from haven.llm.main_text import main_text, main_text_of, read_page

LOREM = "The committee met on Monday, heard three reports, and voted to publish them in full. "
LONG = LOREM * 4


def brute_article(page):
    """The given pages hold one article element; its blocks are headings and paragraphs."""
    body = re.search(r"<article>(.*?)</article>", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)\b[^>]*>", body[1]) if body else []
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", lambda t: " " if t[0].startswith("<br") else "", p)).split()) for p in parts]
    return "\n\n".join(t for t in texts if t)


def test_given_pages(spark, sf_dir):
    from haven.llm import queries as Q
    pages = {r.page_id: (r.url, brute_article(r.html)) for r in read_table(spark, sf_dir, "pages").collect()}
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in Q.op11_main_text(spark, sf_dir).collect()}
    assert got == {k: (u, t, len(t)) for k, (u, t) in pages.items()} and any(len(t) > 200 for _, t in pages.values())


CASES = {
    "plain divs": (f"<div id=top><a href=/>Home</a> <a href=/b>Blog</a></div><div class=content><h1>T</h1><p>{LONG}<p>{LONG}</div>"
                   f"<div class=sidebar><p>{LONG}</p></div>", ["T", LONG.strip(), LONG.strip()]),
    "comments longer than the article": (
        f"<body><main><h1>T</h1><p>{LOREM}</p></main><section id=comments>" + f"<article class=comment><p>{LONG}</p></article>" * 9
        + "</section></body>", ["T", LOREM.strip()]),
    "notice, advert and form inside": (
        f"<article><p>{LONG}</p><div class='cookie-notice'><p>{LONG}</p></div><div class=ad>Buy, buy, buy.</div>"
        f"<form><p>{LONG}</p></form><p>Last words.</p></article>", [LONG.strip(), "Last words."]),
    "layout names on wrappers": (f"<div class='sidebar-left header-fixed'><h1>T</h1><div><p>{LONG}</p><p>{LONG}</p></div></div>",
                                 ["T", LONG.strip(), LONG.strip()]),
    "body in several boxes": (f"<div><div class=part><p>{LONG}</p></div><div class=part><p>{LOREM}</p></div></div><div><a>x</a></div>",
                              [LONG.strip(), LOREM.strip()]),
    "references": ("<article><p>a&nbsp;&amp;&#x20AC;&lt;b&gt; &copy &unknown; &am</p></article>", ["a &€<b> © &unknown; &am"]),
    "white space": ("<article><p> a\n\t b<br>c<br/>d </p>loose  text<p>e</p></article>", ["a b c d", "loose text", "e"]),
    "lists and tables": ("<article><p>Intro.</p><ul><li>one<li>two</ul><table><tr><td>x<td>y<tr><td>z</table></article>",
                         ["Intro.", "one", "two", "x", "y", "z"]),
    "a menu of links inside": ("<article><p>Text, with <a href=x>a link</a> in it.</p><ul><li><a>A one</a><li><a>B two</a></ul></article>",
                               ["Text, with a link in it."]),
    "raw text": ("<article><script>if (a<b) '</p>'</script><style>p{}</style><p>x</p><!-- <p>no</p> --></article>", ["x"]),
    "quoted brackets": ('<article title="a>b" data-x=\'<p>\'><p class="c>d">x</p></article>', ["x"]),
    "unclosed": ("<article><h1>T</h1><p><b>bold<p>rest", ["T", "bold", "rest"]),
    "a page cut inside a tag": (f"<article><p>{LOREM}</p><p>more</p><a hre", [LOREM.strip(), "more"]),
    "header of the article": ("<header><h1>Site</h1></header><article><header><h1>T</h1></header><p>x, y.</p></article>", ["T", "x, y."]),
    "hidden": ("<article><p hidden>a</p><p style='display: none'>b</p><p aria-hidden=true>c</p><p>d</p></article>", ["d"]),
    "no markup": ("just   words", ["just words"]),
    "boilerplate alone": ("<nav><a>x</a></nav><footer>y</footer><div class=ad>z</div>", []),
    "angle": ("<article><p>1 < 2 and 3 <4</p></article>", ["1 < 2 and 3 <4"]),
    "no head end": (f"<html><head><title>t</title><p>{LOREM}</p>", [LOREM.strip()]),
    "empty": ("", []),
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_pages_of_other_makes(case):
    page, blocks = CASES[case]
    assert main_text_of(page) == "\n\n".join(blocks)


def test_linear_in_the_page():
    def seconds(page):
        t = time.perf_counter()
        main_text_of(page)
        return time.perf_counter() - t
    makes = {"deep": lambda n: "<div>" * n + LOREM, "inline": lambda n: "<b>" * n + "<p>x," * n, "stray ends": lambda n: "<div>" * n + "</span></p></li>" * n,
             "open quotes": lambda n: "<a b=\"" * n, "open comments": lambda n: "<!-- x " * n, "lists": lambda n: "<ul><li>" * n + "</ul>" * n,
             "angles": lambda n: "<" * n, "cells": lambda n: "<table><tr><td>" * n + "x", "scripts": lambda n: "<script>" * n,
             "classes": lambda n: "<p class='" + "a-b " * n + "'>x"}
    for name, make in makes.items():
        small, large = seconds(make(4000)), seconds(make(32_000))
        assert large < 40 * max(small, 0.02), (name, small, large)


def test_awkward_rows(spark):
    pages = [(1, None, None), (None, "u", ""), (2, "u", "<p>x</p>"), (2, "u", "<p>x</p>"), (3, "v", f"<article>{'<p>word, ' * 50_000}")]
    df = spark.createDataFrame([(*p, "t", 5, "n") for p in pages], "page_id long, url string, html string, text string, n_chars int, node string")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in main_text(df).collect()), key=repr)
    want = [(p, u, t, len(t)) for p, u, t in [(1, None, ""), (None, "u", ""), (2, "u", "x"), (2, "u", "x"), (3, "v", "\n\n".join(["word,"] * 50_000))]]
    assert got == sorted(want, key=repr)
    assert main_text(df.limit(0)).collect() == []


def test_tree_closes_what_html_closes():
    def shape(n):
        return [n.tag, *[shape(c) if not isinstance(c, str) else c for c in n.children]]
    assert shape(read_page("<ul><li>a<ul><li>b</ul><li>c</ul>"))[1] == ["ul", ["li", "a", ["ul", ["li", "b"]]], ["li", "c"]]
    assert shape(read_page("<p>a<div>b</div></p>c"))[1:] == [["p", "a"], ["div", "b"], "c"]
    assert shape(read_page("<table><tr><td>a<table><tr><td>b</table>c<td>d</table>"))[1] == [
        "table", ["tr", ["td", "a", ["table", ["tr", ["td", "b"]]], "c"], ["td", "d"]]]
