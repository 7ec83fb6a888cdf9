"""Main text: pages of known blocks, the line-block distribution against a plain version, and hostile pages."""

from __future__ import annotations

import html as escapes
import time

import pytest

pytest.importorskip("galenus.llm")

from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from galenus.llm import html  # noqa: E402

LONG = "some text of the page that is long enough to be a paragraph"
P = f"<p>{LONG}</p>"


def plain_stretches(density, window):
    """Each sum on its own; runs of sums by their definition."""
    sums = [sum(density[i : i + window]) for i in range(len(density))]
    out, i = [], 0
    while i < len(sums):
        j = i
        while j < len(sums) and sums[j] > 0:
            j += 1
        if j > i and max(sums[i:j]) >= html.SURGE * max(sums):
            lines = [k for k in range(i, j) if density[k] > 0]
            if lines:
                out.append((min(lines), max(lines) + 1))
        i = j + 1
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([0, 0, 0, 1, 4, 20, 80]), max_size=25), st.integers(1, 5))
def test_stretches(density, window):
    assert html.stretches(density, window) == plain_stretches(density, window)


words = st.lists(st.sampled_from(["plain", "a<b", "x & y", "é中", "it's", '"q"', "1.5", "\U0001f600"]), min_size=1, max_size=12).map(" ".join)
kept = words.flatmap(lambda t: st.sampled_from([f"<p>{escapes.escape(t)}</p>", f"<h2>{escapes.escape(t)}</h2>", f"<div class='social-history'><p>{escapes.escape(t)}</div>", f"<blockquote>{escapes.escape(t)}</blockquote>", f"<ul><li>{escapes.escape(t)}</ul>", f"<p title=it's>{escapes.escape(t)}"]).map(lambda m: (m, t)))
gone = words.flatmap(lambda t: st.sampled_from(["<nav><a href=/>{}</a></nav>", "<aside><p>{}</aside>", '<div class="ad-slot">{}</div>', "<footer>{}</footer>", "<div hidden>{}</div>", "<script>{}</script>", "<!-- {} -->", "<div class='comments-area'><article>{}</article></div>", "<form><p>{}</form>"]).map(lambda m: (m.format(escapes.escape(t)), None)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(kept, gone), max_size=14))
def test_known_blocks_of_an_article(blocks):
    """All text of the article's blocks and none of the others, in order."""
    page = "<body><nav><a href=/x>Home</a></nav><article>" + "".join(m for m, _ in blocks) + f"{P * 8}</article><footer>end</footer>"
    assert html.main_text(page).split("\n") == [t for _, t in blocks if t] + [LONG] * 8


@settings(max_examples=100, deadline=None)
@given(st.lists(kept, max_size=8), st.lists(gone, max_size=4), st.lists(kept, max_size=8))
def test_known_blocks_without_an_article(before, middle, after):
    page = "".join(m for m, _ in [*before, *middle, *after]) + P * 8
    assert html.main_text(page).split("\n") == [t for _, t in [*before, *after]] + [LONG] * 8


def test_links_without_a_name_dive():
    menu = "".join(f"<div><a href=/{i}>Item {i}</a></div>" for i in range(5))
    page = menu + f"<h1><a href=/t>Title</a></h1>{P}<p><a href=/in>a link between</a></p>{P}" + menu + "<div>imprint</div>"
    assert html.main_text(page) == f"Title\n{LONG}\na link between\n{LONG}"
    assert html.main_text("<p><a href=/>only a link</a></p>") == "only a link"


def test_layout_is_kept():
    for wrapper in ('<div class="wrap has-sidebar">', '<div class="no-sidebar">', '<div class="with-ads">', '<div class="notice-board">', '<div class="social-history">', '<div id="related-work">', '<div title="The hidden cost of">', '<div class="x hidden y">', "<form>"):
        for inner in (f"<article>{P * 3}</article>", P * 3):
            assert html.main_text(f"{wrapper}{inner}</div></form>") == "\n".join([LONG] * 3)
    assert html.main_text(P * 3 + "<div class=ad><p>a<p>b<p>c<p>d</div>" + P * 3) == "\n".join([LONG] * 6)
    assert html.main_text("<p title=it's>one</p><p>two it's</p><p>three</p>") == "one\ntwo it's\nthree"
    assert html.main_text(f'<article>{P * 2}</article><article class="related"><p>teaser</p></article>') == "\n".join([LONG] * 2)
    assert html.main_text(f"<article><p>teaser</p></article><div>{P * 9}</div>") == "\n".join(["teaser", *[LONG] * 9])
    assert html.main_text('<p>text <span class="ad">buy</span> more <math><mi>y</mi></math></p>a < b') == "text more y\na < b"


def test_hostile_pages_take_linear_time():
    n = 8000
    pages = ["<a b " * n, "<div>" * n + "<p>y</p>" * n, "<div class=ad>" * n + "<p>y</p>" * n, "<b><div>" + "<i>" * n + "</b>" * n, '<a x="' * n, "<!x " * n, "<title>" * n, "<textarea>" * n, "<" * 5 * n, "<a " + "=" * 5 * n, "<ul><li>" * n, "<div class=sidebar>" * n + "<main>" * n, "</div>" * n, "&" * 5 * n]
    for page in pages:
        began = time.process_time()
        html.main_text(page)
        assert time.process_time() - began < 0.5, page[:30]
