"""The main text of a page without known selectors: blocks scored by their text and by how much of it is links.

Each block of text gives points for its length and its commas, less the share that stands in links. The element around it gets
these points, the next one out half of them, and an element's sum counts by the share of its text that isn't linked. The element
with most points is the article; elements beside it with a fifth as many belong to it. One walk over the tree
does it all, whatever its depth.
"""

from __future__ import annotations

#: Elements that never hold the article's text.
OUTSIDE = frozenset("head title script style noscript iframe template nav footer aside form button select textarea figcaption table svg".split())
BLOCKS = frozenset("p pre blockquote li div section article main body td dd".split())
#: Characters of the shortest block that counts, and of the shortest that is part of the text.
LEAST, SHORTEST = 25, 10
COMMAS = ",،、，"


def _walk(root, skip) -> list:
    """The elements of a page in order, without those outside of articles and all within."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.tag in OUTSIDE or skip(node):
            continue
        out.append(node)
        stack += [c for c in reversed(node.children) if not isinstance(c, str)]
    return out


def main_text(root, skip=lambda node: False) -> str:
    """The text of the page's main blocks, by a space; empty where no block is long enough. skip tells noise."""
    nodes = _walk(root, skip)
    inside = {id(n) for n in nodes}
    size, linked, points = {}, {}, {}
    for node in reversed(nodes):  # children before their parents
        n = links = 0
        for c in node.children:
            if isinstance(c, str):
                n += len(" ".join(c.split()))
            elif id(c) in inside:
                n += size[id(c)]
                links += linked[id(c)]
        size[id(node)] = n
        linked[id(node)] = n if node.tag == "a" else links
    # Blocks that hold no other.
    outer = {id(n.parent) for n in nodes if n.tag in BLOCKS}
    for node in nodes:
        if node.tag not in BLOCKS or id(node) in outer:
            continue
        n = size[id(node)]
        if n < LEAST:
            continue
        text = node.text(" ")
        commas = sum(map(text.count, COMMAS))
        worth = (1 + min(n / 100, 3) + commas) * (1 - linked[id(node)] / n)
        parent = node.parent
        for share in (1.0, 0.5):
            if parent is None or id(parent) not in inside:
                break
            points[id(parent)] = points.get(id(parent), 0.0) + share * worth
            parent = parent.parent
    value = {id(n): points[id(n)] * (1 - linked[id(n)] / max(1, size[id(n)])) for n in nodes if id(n) in points}
    if not any(value.values()):
        return ""
    best = max((n for n in nodes if id(n) in value), key=lambda n: value[id(n)])
    beside = best.parent.children if best.parent is not None and best.tag != "body" else [best]
    chosen = [c for c in beside if c is best or (not isinstance(c, str) and value.get(id(c), 0.0) >= max(10.0, value[id(best)] / 5))]
    parts = []
    for one in chosen:
        for node in _walk(one, skip):
            if node.tag in BLOCKS and id(node) not in outer:
                text = node.text(" ", lambda x: x.tag in OUTSIDE or skip(x))
                if len(text) > SHORTEST and linked[id(node)] <= size[id(node)] / 2:
                    parts.append(text)
    return " ".join(parts)
