"""Highlights: the best passage of a text for the tokens of a query, with the hits marked."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from heronlake.functions.text import PLAIN_LETTERS, folded_word

WORD = re.compile(r"\w+")
BOUNDARY = regex.compile(r"(?V1w)\b")
_TABLE = str.maketrans(PLAIN_LETTERS)


def folded(word: str) -> str:
    """A word as the folding analyzer has it."""
    return "".join(c for c in word.lower().translate(_TABLE) if unicodedata.category(c) != "Mn")


def _words(text: str, fold: bool | str) -> Iterator[tuple[int, int, str]]:
    if fold == "words":
        at = 0
        for word in BOUNDARY.split(text):
            yield at, at + len(word), folded_word(word)
            at += len(word)
    else:
        for m in WORD.finditer(text):
            yield m.start(), m.end(), folded(m[0]) if fold else m[0].lower()


def hits(text: str, terms: dict[str, float], fold: bool | str = False) -> list[tuple[int, int, str]]:
    """(start, end, term) of the words that are terms, in order. With fold "words", Thai has no hits: its words need a dictionary."""
    return [w for w in _words(text, fold) if w[2] in terms]


def best_passage(found: list[tuple[int, int, str]], terms: dict[str, float], size: int) -> int | None:
    """Where the passage of `size` characters starts whose distinct terms weigh most, of equal ones the first; None without hits.

    Of the passages that hold the same hits the first ends with the last of them, so those that end with a hit will do.
    Hits come and go at the two ends as the passage moves on: one pass, whatever the text's length. Only whole hits count;
    where no hit is as short as a passage, the passage starts with the first hit.
    """
    if not found:
        return None
    best, at, held, weight, first = -1.0, found[0][0], {}, 0.0, 0
    for _, end, term in found:
        if not held.get(term):
            weight += terms[term]
        held[term] = held.get(term, 0) + 1
        start = max(0, end - size)
        while first < len(found) and found[first][0] < start:
            gone = found[first][2]
            held[gone] -= 1
            if not held[gone]:
                weight -= terms[gone]
            first += 1
        # Sums of the same weights in another order differ in the last digits.
        if weight > best + 1e-9 and any(held.values()):
            best, at = weight, start
    return at


def marked(text: str, found: list[tuple[int, int, str]], start: int, end: int) -> str:
    out, at = [], start
    for s, e, _ in found:
        if start <= s and e <= end:
            out += [text[at:s], "<mark>", text[s:e], "</mark>"]
            at = e
    return "".join([*out, text[at:end]])


def fragment(title: str | None, content: str | None, terms: dict[str, float], fold: bool | str = False, size: int = 150) -> str | None:
    """The content's best passage, or else the whole title, with the hits marked; None where neither has one."""
    if found := hits(content or "", terms, fold):
        start = best_passage(found, terms, size)
        return marked(content, found, start, start + size)
    found = hits(title or "", terms, fold)
    return marked(title, found, 0, len(title)) if found else None


def highlight(title: Column, content: Column, tokens: list[str], weights: Column, fold: bool | str = False, size: int = 150) -> Column:
    """fragment as a column; weights holds an array with a weight for each token."""

    @F.pandas_udf(StringType())
    def run(titles: pd.Series, contents: pd.Series, rows: pd.Series) -> pd.Series:
        return pd.Series([fragment(t, c, dict(zip(tokens, w, strict=True)), fold, size) for t, c, w in zip(titles, contents, rows, strict=True)], dtype=object)

    return run(title, content, weights)
