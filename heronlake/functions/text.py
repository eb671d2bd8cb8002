"""Text: cleaning, folding of tones, title keys, words and the search analyzer."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from heronlake.functions.vocab import BOILERPLATE

#: Letters with marks that decomposition doesn't cover by itself, or that occur composed most often.
_PLAIN = {
    "a": "àáảãạăằắẳẵặâầấẩẫậäåāą", "e": "èéẻẽẹêềếểễệëēęě", "i": "ìíỉĩịîïī", "o": "òóỏõọôồốổỗộơờớởỡợöōő", "u": "ùúủũụưừứửữựûüūůű",
    "y": "ỳýỷỹỵÿ", "d": "đ", "c": "çćč", "n": "ñńň", "s": "śš", "z": "źżž", "r": "ř", "t": "ť", "g": "ğ", "l": "ľĺ",
}
_FROM = "".join(_PLAIN.values())
_TO = "".join(k * len(v) for k, v in _PLAIN.items())
PLAIN_LETTERS = dict(zip(_FROM, _TO, strict=True))


def trimmed(x: Column) -> Column:
    """Without white space at either end, in the sense of Unicode."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def collapsed(x: Column) -> Column:
    return trimmed(F.regexp_replace(x, r"(?U)\s+", " "))


@F.pandas_udf(StringType())
def _unescape_twice(x: pd.Series) -> pd.Series:
    return x.map(lambda t: html.unescape(html.unescape(t)), na_action="ignore")


def clean_content(x: Column) -> Column:
    """Entities decoded twice, boilerplate removed, white space collapsed. Python decodes texts with & only; the others cross
    to it as nulls, in Arrow batches."""
    t = F.coalesce(x, F.lit(""))
    t = F.when(t.contains("&"), _unescape_twice(F.when(t.contains("&"), t))).otherwise(t)
    for pattern in BOILERPLATE:
        t = trimmed(F.regexp_replace(t, f"(?isuU){pattern}", ""))
    return collapsed(t)


def fold(x: Column) -> Column:
    """Lower case without tones: composed letters by a table, combining marks by their class."""
    return F.regexp_replace(F.translate(F.lower(x), _FROM, _TO), r"\p{Mn}", "")


def title_key(x: Column) -> Column:
    """Lower case, no tones, no punctuation, single spaces."""
    return collapsed(F.regexp_replace(fold(trimmed(F.coalesce(x, F.lit("")))), r"(?U)[^\p{L}\p{N}_\s]", " "))


def title_hash(x: Column) -> Column:
    return F.substring(F.md5(title_key(x)), 1, 12)


def count_words(x: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(x, F.lit("")), r"(?U)\s+"), lambda w: w != ""))


#: Letters with a stroke or without a dot, which no decomposition takes apart.
_STRUCK = str.maketrans("đøłħŧı", "dolhti")
#: Blocks of the marks that folding drops. Those of Thai, Hebrew or Arabic, vowels among them, stay.
_MARKS = ((0x0300, 0x036F), (0x1AB0, 0x1AFF), (0x1DC0, 0x1DFF), (0x20D0, 0x20FF), (0xFE20, 0xFE2F))
_DROPPED = {c: None for first, last in _MARKS for c in range(first, last + 1)}


def folded_word(t: str) -> str:
    """A text after compatibility decomposition and case folding, without marks, composed again."""
    once = unicodedata.normalize("NFKD", t.casefold()).casefold().translate(_STRUCK)
    return unicodedata.normalize("NFC", unicodedata.normalize("NFKD", once).translate(_DROPPED))


def folded_text(t: str) -> str:
    """folded_word of a text line by line, as nothing composes across a line feed: lines of ASCII are only lower-cased."""
    return "\n".join(w.lower() if w.isascii() else folded_word(w) for w in t.split("\n"))


@F.pandas_udf(StringType())
def _fold_others(x: pd.Series) -> pd.Series:
    return x.map(folded_text, na_action="ignore")


def fold_fully(x: Column) -> Column:
    """folded_word as a column: ligatures, full width, circled and struck letters too. Texts of ASCII and the table's letters
    stay in the JVM, the others cross to Python in Arrow batches."""
    other = x.rlike(f"[^\\x00-\\x7F{_FROM}{_FROM.upper()}]")
    return F.when(other, _fold_others(F.when(other, x))).otherwise(F.translate(F.lower(x), _FROM, _TO))


_KANA = r"\p{IsKatakana}\u30FC\uFF70"
_ALONE = rf"\p{{IsHan}}\p{{IsHiragana}}\p{{IsThai}}{_KANA}"
_LETTER = rf"[\p{{L}}\p{{Nl}}&&[^{_ALONE}]]"
#: Words by the default rules of Unicode: letters, digits and _, joined by marks between letters (as in don't, U.S.A) or between digits
#: (as in 1,000.5); a word for each ideograph and hiragana; runs of katakana; runs of Thai, which a dictionary cuts.
WORD_RULES = (
    rf"[\p{{L}}\p{{Nl}}\p{{Nd}}\p{{M}}_&&[^{_ALONE}]](?:[\p{{L}}\p{{Nl}}\p{{Nd}}\p{{M}}_&&[^{_ALONE}]]"
    rf"|(?<=[\p{{L}}\p{{Nl}}\p{{M}}&&[^{_ALONE}]])[:.'\u00B7\u2018\u2019\u2024\u2027](?={_LETTER})|(?<=\p{{IsHebrew}})\"(?=\p{{IsHebrew}})"
    rf"|(?<=\p{{Nd}})[.,;'\u2018\u2019\u2024\u2044](?=\p{{Nd}}))*|[\p{{IsHan}}\p{{IsHiragana}}]\p{{M}}*|[{_KANA}]+\p{{M}}*|[\p{{IsThai}}]+|\p{{No}}"
)


def word_tokens(x: Column) -> Column:
    """The search analyzer with word segmentation: words by WORD_RULES, Thai by the JVM's dictionary, folded fully.

    Null and empty texts have none. Ideographs are words one by one; Lao, Khmer and Burmese, for which no dictionary is at
    hand, are cut at spaces only.
    """
    words = F.filter(F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(WORD_RULES), F.lit(0)), lambda w: w.rlike(r"[\p{L}\p{N}]"))
    thai = F.coalesce(x, F.lit("")).rlike(r"\p{IsThai}")
    cut = F.flatten(F.transform(words, lambda w: F.when(w.rlike(r"^\p{IsThai}"), F.flatten(F.sentences(w, F.lit("th"), F.lit("TH")))).otherwise(F.array(w))))
    # No word holds a line feed.
    return F.filter(F.split(fold_fully(F.array_join(F.when(thai, cut).otherwise(words), "\n")), "\n"), lambda w: w != "")


def tokens(x: Column, folded: bool | str = False) -> Column:
    """The search analyzer: lower-case runs of letters, digits and _; without tones if folded; word_tokens if "words"."""
    if folded == "words":
        return word_tokens(x)
    t = F.coalesce(x, F.lit(""))
    t = fold(t) if folded else F.lower(t)
    return F.filter(F.split(t, r"[^\p{L}\p{N}_]+"), lambda w: w != "")
