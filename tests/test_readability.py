"""The main text of pages: what is chosen, and pages that are odd."""

from heronlake.sources.html_article import _is_noise, extract, parse
from heronlake.sources.readability import main_text

PARA = "A paragraph that is long enough, with some commas, and with words in it."


def text_of(html):
    return main_text(parse(html), _is_noise)


def test_links_and_asides_lose():
    links = "".join(f"<li><a href='/{i}'>A headline, which is rather long, number {i}</a></li>" for i in range(30))
    html = f"<body><ul>{links}</ul><div><div><p>{PARA}</p><p>{PARA} 2</p><p>short</p><p><a href='/'>{PARA}</a></p></div></div><aside><p>{PARA} x</p></aside></body>"
    assert text_of(html) == f"{PARA} {PARA} 2"


def test_siblings_with_points_belong_to_it():
    many = "".join(f"<p>{PARA}, a, b, c, d {i}</p>" for i in range(6))
    few = "".join(f"<p>{PARA}, a, b, c, d, e, f {i}</p>" for i in range(3))
    html = f"<body><div class='a'>{many}</div><div class='b'>{few}</div><div class='c'><p>{PARA}</p></div></body>"
    found = text_of(html)
    assert found.count(PARA) == 9 and found.endswith("f 2")


def test_pages_without_text():
    for html in ("", "<p>short</p>", "<html></html>", "plain text", "<a href='/'>" + "x" * 300 + "</a>", "<p><a href='/'>" + PARA + "</a></p>", "<script>" + PARA + "</script>"):
        assert text_of(html) == ""
    assert text_of(f"<p>{PARA}") == PARA


def test_deep_and_wide_pages():
    deep = "<div>" * 5000 + f"<p>{PARA}</p>" + "</div>" * 5000
    assert text_of(deep) == PARA
    assert text_of("<div>" + f"<p>{PARA}</p>" * 5000 + "</div>").count(PARA) == 5000


def test_the_page_stands_in_for_short_bodies_only():
    page = f"<html><body><div class='x'>{('<p>' + PARA + '</p>') * 4}</div></body></html>"
    found = extract(page, "https://h.example/")
    assert found["content_from"] == "page" and found["content"].count(PARA) == 4
    ld = '<script type="application/ld+json">{"@type": "NewsArticle", "articleBody": "%s"}</script>'
    assert extract(ld % ("long body " * 40) + page, "u")["content_from"] == "json-ld"
    assert extract(ld % "short" + page, "u")["content_from"] == "page"
    assert extract(ld % "short", "u")["content"] == "short" and extract(None, None) == {}
