"""Names in classes only advise; broken pages are parsed in linear time."""

import time

import pytest

from ferryline.llm import html_text

LONG = "Some words of a story that go on for a good while, so that this paragraph is long enough. " * 3
TWO = f"<p>{LONG}</p><p>{LONG}</p>"
BOTH = f"{LONG}{LONG}".strip()


@pytest.mark.parametrize("name", [
    'class="layout has-sidebar"', 'class="no-sidebar"', 'id="social-history"', 'id="related-work"',
    'class="sidebar-left"', "class=widget", 'class="search hidden"', 'title="the hidden one"'])
def test_a_name_does_not_silence_a_page(name):
    page = f"<body><nav><a href=/>Home</a></nav><div {name}>{TWO}</div><footer>End</footer></body>"
    assert html_text.extract(page) == BOTH


@pytest.mark.parametrize("part", ['<h2 class="section-header">Head</h2>', '<div class="table-header">Head</div>',
                                  '<p id="related-work">Head</p>'])
def test_loose_names_inside_an_article(part):
    assert html_text.extract(f"<body><article>{part}{TWO}</article></body>") == f"Head {BOTH}"


@pytest.mark.parametrize("part", [
    '<div class="cookie-notice">We use cookies.</div>', '<p class="share">Share this</p>',
    '<div id="related-posts"><a href=/a>Another story</a></div>', '<div class="ad">Buy now</div>',
    '<div class="see-related-pages"><a href=/a>Another story</a></div>', '<form>Your name</form>',
    f'<div class="comments"><div class="comment">{LONG * 9}</div></div>', "<div hidden>Secret</div>"])
def test_boilerplate_goes(part):
    assert html_text.extract(f"<body>{part}<div>{TWO}</div>{part}</body>") == BOTH
    assert html_text.extract(f"<body><article><h1>T</h1>{TWO}{part}</article>{part}</body>") == f"T {BOTH}"


def test_an_advert_longer_than_the_article():
    assert html_text.extract('<body><div class="ad">Buy ten of these now.</div><article><h1>T</h1><p>Hi</article>') == "T Hi"


def test_a_quote_that_is_never_closed():
    assert html_text.extract(f"<body><p>{LONG}<a href='x>link</a> tail</p>") == f"{LONG}link tail".strip()


@pytest.mark.parametrize("page", [
    "<span>{n}<li>x</li>{n}", "<span>{n}</b>{n}", "<span>{n}<body>{n}", "<a {n}'", '<a ">"{n}\'',
    "<b>{n}<p>x{n}", "<td>{n}</tr>{n}"])
def test_broken_pages_take_linear_time(page):
    def seconds(n):
        parts = page.split("{n}")
        text = "".join(p * n for p in parts[:-1]) + parts[-1]
        start = time.process_time()
        html_text.extract(text)
        return time.process_time() - start

    assert seconds(40_000) < 8 * max(seconds(10_000), 0.05)
