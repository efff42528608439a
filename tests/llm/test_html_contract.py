"""Main text of pages whose parts are known."""

from __future__ import annotations

import html
import random

import pytest

from lendgrid.llm.html_extract import BOILER, CONTENT, DOUBT, main_text, named

LONG = "Prose of an article that runs on for long enough to be told from the links of a menu, sentence after sentence, with few tags in it."
MENU = '<nav><ul><li><a href="/">Home</a><li><a href="/b">About</a></ul></nav>'
FOOT = "<footer><p>Imprint and rights</p></footer>"


def test_two_articles_in_one_main():
    page = f"<body>{MENU}<main><article><h2>One</h2><p>{LONG} 1</p></article><article><h2>Two</h2><p>{LONG} 2</p><p>{LONG} 3</p></article></main>{FOOT}"
    assert main_text(page) == f"One\n{LONG} 1\nTwo\n{LONG} 2\n{LONG} 3"


def test_intro_beside_the_body():
    paragraphs = "".join(f"<p>{LONG} {i}</p>" for i in range(9))
    page = f'<body>{MENU}<div class="intro"><p>{LONG}</p></div><div class="body">{paragraphs}</div>{FOOT}'
    assert main_text(page) == "\n".join([LONG, *(f"{LONG} {i}" for i in range(9))])


def test_names_that_hold_a_word_of_boilerplate():
    page = (f"<body>{MENU}<article><h1>T</h1><section class='search-engines'><p>{LONG}</p></section><p class='share-price'>{LONG} 2</p>"
            f"<div class='share-buttons'><p>{LONG} 3</p></div><div class=user-comments-42><p>{LONG} 4</p></div></article>{FOOT}")
    assert main_text(page) == f"T\n{LONG}\n{LONG} 2"
    assert [named(x) for x in ("search-engines", "share-price", "siteHeader", "cookie-notice", "main-nav", "has-sidebar", "post", "newsletterSignup", "nav", "comment-17", "adventure")] == [
        DOUBT, DOUBT, BOILER, BOILER, BOILER, CONTENT, CONTENT, BOILER, BOILER, BOILER, CONTENT]


def test_white_space_headers_and_comments_of_articles():
    page = (f"<body><header><h1>Site</h1></header>{MENU}<article class='post'><header class='header'><h1>Head​line</h1></header><p>{LONG}   a\xa0b​c</p></article>"
            f"<article class=comment><p>{LONG} says a reader</p></article>{FOOT}")
    assert main_text(page) == f"Head​line\n{LONG} a b​c"


def build(r: random.Random):
    """A page and the blocks that are its article."""
    wanted: list[str] = []

    def prose():
        return " ".join(r.choice(["the", "of", "réseau", "und", "5 < 6", "A&B", "long", "words", "go", "on"]) for _ in range(r.randint(25, 60)))

    def block(keep: bool) -> str:
        text = prose()
        if keep:
            wanted.append(text)
        inner = html.escape(text)
        if r.random() < 0.3:
            inner = f"<b>{inner}</b>"
        return r.choice(["<p>{}</p>", "<p>{}", "<blockquote>{}</blockquote>", "<div>{}</div>"]).format(inner)

    def junk() -> str:
        return r.choice([MENU, FOOT, f"<aside>{block(False)}</aside>", f'<div class="{r.choice(["ad", "cookie-notice", "sidebar", "related-posts", "comments"])}">{block(False)}</div>',
                         "<script>var p = '<p>no</p>';</script>", "<style>p{}</style>", f"<form>{block(False)}</form>", "<!-- <p>no</p> -->"])

    def body() -> str:
        out = []
        if r.random() < 0.8:
            wanted.append("A headline")
            out.append(r.choice(["<h1>A headline</h1>", "<header><h1>A  headline</h1></header>"]))
        for _ in range(r.randint(2, 7)):
            out.append(block(True))
            if r.random() < 0.3:
                out.append(junk())
        return "".join(out)

    articles = "".join(f"<article>{body()}</article>" for _ in range(r.choice([1, 1, 1, 2, 3])))
    around = lambda: "".join(junk() for _ in range(r.randint(0, 3)))
    page = f"<!DOCTYPE html><html><head><title>{prose()}</title></head><body>{around()}{r.choice(['{}', '<main>{}</main>', '<div id=page>{}</div>']).format(articles)}{around()}</body></html>"
    return page, wanted


@pytest.mark.parametrize("seed", range(200))
def test_built_pages_give_back_their_articles(seed):
    page, wanted = build(random.Random(seed))
    assert main_text(page) == "\n".join(wanted)
