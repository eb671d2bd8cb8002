"""Extraction reads a block's text once to score it and once to give it, and finds the head's elements while it parses."""

from heronlake.sources import html_article as H
from heronlake.sources.readability import main_text

PAGE = "<html><head><title>a</title><meta name=x content=y><script type='application/ld+json'>{}</script></head><body><div><p>" + "</p><p>".join(f"Some text, of a paragraph, number {i}, with commas" for i in range(5)) + "<p>x <time datetime=z>t</time></p></div><title>b</title><meta name=k /></body></html>"


def test_texts_are_read_twice_at_most(monkeypatch):
    calls, text = [], H.Node.text
    monkeypatch.setattr(H.Node, "text", lambda node, *a: calls.append(id(node)) or text(node, *a))
    assert main_text(H.parse(PAGE)).count("paragraph") == 5
    assert max(map(calls.count, calls)) <= 2


def test_heads_are_those_of_a_walk():
    for page in (PAGE, "<p>a<li><title>q</title><p><script>1</script></ul><time><meta><meta/></time></p><time>", ""):
        tree = H.tree_of(page)
        assert list(map(id, tree.heads)) == [id(n) for n in tree.root.walk() if n.tag in H.HEADS]
    assert [n.tag for n in H.tree_of(PAGE).heads] == ["title", "meta", "script", "time", "title", "meta"]


def test_the_text_of_a_single_child():
    node = H.parse("<p>  one </p>").children[0]
    assert node.text() == "one" and node.text(" ", lambda n: n.tag == "p") == ""
