"""Pages with the markup that real pages have wrong, and the ratios against a second computation."""

import math
import random
import re

import pytest

from tallyforge.llm.html_extract import ARTICLE_WEIGHT, blocks, main_text, ratios

TEXT = ["The first sentence stands here, long enough to count.", "A second one follows it; it has, as one sees, more marks.", "The third closes the piece."]
P = "".join(f"<p>{t}</p>" for t in TEXT)
MENU = "<ul><li><a href=/>Home</a></li><li><a href=/a>About</a></li><li><a href=/b>Contact</a></li></ul>"
FOOT = "<footer>All rights reserved</footer>"
WHOLE = "\n".join(TEXT)


@pytest.mark.parametrize("body", [
    f"<a href=/story><div>{P}</div></a>", f"<a name=top><div>{P}</div>", f"<div><a href=/x>{P}</div>", f"<a href=/x><article>{P}</article></a>", f"<div><a id=a>{P}</a></div>",
    f"<div>{P}<button>", f"<div><button>{P}</div>", f"<select><div>{P}</div>", f"<svg><div>{P}</div>", f"<div><object>{P}</div>", f"<iframe><div>{P}</div>", f"<canvas><div>{P}</div>", f"<template><div>{P}</div>",
    f"<div><button>{P}<button>Send</button></div>", f"<div><svg><path d='M0'/><g></g></svg>{P}</div>", f"<div><svg/>{P}</div>", f"<div><!-->{P}<!-- x --></div>", f"<div><!--->{P}<!-- --></div>", f"<div><!-- a --!>{P}</div>",
    f"<script src=/a/>var a = '<p>code, more code.</p>';</script><div>{P}</div>", f"<div>{P}<select><option>One<option>Two</select><svg><text>Label</text></svg><button>Go</button></div>",
    f"<div><noscript><p>{TEXT[0]}</p></noscript>{''.join(f'<p>{t}</p>' for t in TEXT[1:])}</div>",
])
def test_no_text_is_lost(body):
    assert main_text(f"<html><body>{body}</body></html>") == WHOLE
    if "<a href=/x>" not in body:  # there the link ends where the menu's begins
        assert main_text(f"<html><body>{MENU}{body}{FOOT}</body></html>") == WHOLE


def test_formulas_are_text():
    page = "<div><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding=tex>x=2</annotation></math> be, in this case, two.</p><p>Then <object data=f.svg>x squared</object> is four, of course.</p></div>"
    assert main_text(page) == "Let x=2 be, in this case, two.\nThen x squared is four, of course."


def test_links_that_are_menus_stay_out():
    cards = "".join(f"<a href=/{i}><div>Card {i}</div><div>teaser</div></a>" for i in range(8))
    assert main_text(f"<body><div>{cards}</div><div>{P}</div></body>") == WHOLE
    assert main_text(f"<body>{MENU}<div>{P}</div></body>") == WHOLE


def test_discussions_of_another_name():
    talk = '<div class="discussion">' + "".join(f"<div><b>User {i}</b> wrote, I agree, it is nice.</div>" for i in range(4)) + "</div>"
    assert main_text(f"<body><article>{P}{talk}</article></body>") == WHOLE


def test_pages_of_links_alone():
    assert main_text("<body><div><p><a href=/a>The only sentence, a link.</a></p></div></body>") == "The only sentence, a link."


def test_many_unclosed_elements_take_linear_time():
    page = "<button><svg><select><iframe><template>" * 20_000 + P
    assert main_text(page).endswith(TEXT[-1])


def plain_ratios(found):
    """The ratios, path by path, in another way: sums first, then means over the page, then means by path."""
    by_path = {}
    for b in found:
        by_path.setdefault(b.element.path, []).append(b)
    density = {p: (sum(max(0, len(b.text) - b.linked) for b in bs) / len(bs), sum(len(re.findall(r"[.,;:!?…。、！？¿¡]", b.text)) for b in bs) / len(bs)) for p, bs in by_path.items()}
    series = [density[b.element.path] for b in found]
    padded = [series[0], *series, series[-1]]
    out = {p: 0.0 for p in by_path}
    for i, b in enumerate(found):
        t, k = (((1 + padded[i][c]) ** 0.25 * (1 + padded[i + 1][c]) ** 0.5 * (1 + padded[i + 2][c]) ** 0.25) - 1 for c in (0, 1))
        e = b.element
        weight = 0.0 if e.apart or (e.header and not e.article) else ARTICLE_WEIGHT if e.article else 1.0
        out[e.path] += weight * t * math.log(math.e + k) / len(by_path[e.path])
    return out


def test_ratios_against_a_second_computation():
    rng = random.Random(6)
    for _ in range(60):
        page = ""
        for _ in range(rng.randint(1, 40)):
            tag = rng.choice(["p", "div", "li", "article", "nav", "h1", "section class=story", "td", "a href=x", "header"])
            page += f"<{tag}>" + rng.choice(["", *TEXT, "x", "<a href=y>link text</a>"]) + rng.choice(["", f"</{tag.split()[0]}>"])
        found = blocks(page)
        if found:
            got, want = ratios(found), plain_ratios(found)
            assert got.keys() == want.keys() and all(math.isclose(got[p], want[p], rel_tol=1e-9, abs_tol=1e-9) for p in want)
