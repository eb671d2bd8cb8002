"""Entities and keywords: normalising, rejecting, retyping, ordered dedup, and merging of BIO tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from heronlake.functions import vocab as V
from heronlake.functions.text import collapsed, trimmed

ENTITIES = "array<struct<text:string,type:string>>"


def normalize_text(x: Column) -> Column:
    t = trimmed(F.coalesce(x, F.lit("")))
    t = F.regexp_replace(t, f"(?U)^{V.EDGE_PUNCTUATION}", "")
    return collapsed(F.regexp_replace(t, f"(?U){V.EDGE_PUNCTUATION}$", ""))


def is_date_like(x: Column) -> Column:
    return x.rlike(V.DATE_LIKE)


def is_numeric(x: Column) -> Column:
    return x.rlike(f"(?U){V.NUMERIC}")


def is_money_or_percent(x: Column) -> Column:
    return x.rlike(V.PERCENT) | x.rlike(V.CURRENCY)


def is_common_word(x: Column) -> Column:
    return F.lower(trimmed(x)).isin(V.COMMON_WORDS)


def _fits(x: Column) -> Column:
    return F.length(x).between(*V.ENTITY_LENGTHS)


def is_noise(x: Column) -> Column:
    """Whether a normalised text is no entity and no keyword."""
    return ~_fits(x) | is_numeric(x) | is_date_like(x) | is_money_or_percent(x) | is_common_word(x)


def _first_prefix(x: Column, prefixes: list[str]) -> Column:
    """Length of the first prefix in the list that fits, null if none does."""
    low = F.lower(x)
    return F.coalesce(*(F.when(low.startswith(p), F.lit(len(p))) for p in prefixes))


def clean_entity(entity: Column) -> Column:
    """The cleaned struct (text, type), or null for noise."""
    text = normalize_text(entity["text"])
    place, person = _first_prefix(text, V.PLACE_PREFIXES), _first_prefix(text, V.PERSON_PREFIXES)
    rest = trimmed(F.substring(text, F.coalesce(place, person) + 1, F.length(text)))
    new_text = F.when(F.coalesce(place, person).isNotNull() & (F.length(rest) >= V.ENTITY_LENGTHS[0]), rest).otherwise(text)
    new_type = F.when(place.isNotNull(), "LOC").when(person.isNotNull(), "PER").otherwise(entity["type"])
    known = (F.coalesce(entity["text"], F.lit("")) != "") & (F.coalesce(entity["type"], F.lit("")) != "")
    keep = known & ~is_noise(text) & _fits(new_text) & ~is_common_word(new_text)
    return F.when(keep, F.struct(new_text.alias("text"), new_type.alias("type")))


def _with(value: Column, use) -> Column:
    """use(value), with the value computed once: what a lambda takes from outside is computed for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _first_of_each(items: Column, key) -> Column:
    """The items whose key is the first of its kind, in order, by one sort of the keys."""

    def firsts(own: Column) -> Column:
        placed = F.sort_array(F.transform(own, lambda e, i: F.struct(key(e).alias("k"), i.alias("i"))))
        kept = _with(placed, lambda p: F.filter(p, lambda x, j: (j == 0) | ~F.get(p, j - 1)["k"].eqNullSafe(x["k"])))
        return F.transform(F.sort_array(F.transform(kept, lambda x: x["i"])), lambda i: F.get(own, i))

    return _with(items, firsts)


def distinct_entities(entities: Column) -> Column:
    """First of each lower-cased text and type, in order."""
    return _first_of_each(entities, lambda e: F.struct(F.lower(e["text"]), e["type"]))


def distinct_keywords(keywords: Column) -> Column:
    """First of each lower-cased keyword, in order."""
    return _first_of_each(F.filter(keywords, lambda k: k.isNotNull()), F.lower)


def clean_entities(entities: Column) -> Column:
    cleaned = F.filter(F.transform(F.coalesce(entities, F.array().cast(ENTITIES)), clean_entity), lambda e: e.isNotNull())
    return distinct_entities(cleaned)


def clean_keyword(keyword: Column) -> Column:
    text = normalize_text(keyword)
    return F.when(~is_noise(text) & ~F.lower(text).isin(V.CATEGORY_KEYWORDS), text)


def clean_keywords(keywords: Column) -> Column:
    empty = F.array().cast("array<string>")
    return distinct_keywords(F.filter(F.transform(F.coalesce(keywords, empty), clean_keyword), lambda k: k.isNotNull()))


def split_keywords(raw: Column) -> Column:
    """a|b|c, or else a,b,c."""
    t = F.coalesce(raw, F.lit(""))
    parts = F.when(t.contains("|"), F.split(t, r"\|")).otherwise(F.split(t, ","))
    return F.filter(F.transform(parts, trimmed), lambda k: k != "")


def union_keywords(first: Column, second: Column) -> Column:
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(first, empty), F.coalesce(second, empty)))


def is_person_name(x: Column) -> Column:
    """Two to five words that start with a capital and hold no digit or sign; no brand."""
    t = trimmed(F.coalesce(x, F.lit("")))
    words = F.filter(F.split(t, r"(?U)\s+"), lambda w: w != "")
    name_like = F.forall(words, lambda w: w.rlike(r"^\p{Lu}") & ~w.rlike(r"[\p{Nd}/@#_]"))
    return ~t.isin(V.BRANDS) & F.size(words).between(2, 5) & name_like


def fix_author(author: Column, source: Column) -> Column:
    """The author, or nothing where it only names a source."""
    a = trimmed(F.coalesce(author, F.lit("")))
    return F.when((F.lower(a) == F.lower(source)) | F.lower(a).isin(V.SOURCE_NAMES), "").otherwise(a)


def merge_bio(tags: Column) -> Column:
    """Entities of an array of (token, tag) structs: B starts, I of the same type goes on, I of another starts, O ends."""
    open_type = "struct<tokens:array<string>,type:string>"
    none = F.struct(F.array().cast("array<string>").alias("tokens"), F.lit("").alias("type")).cast(open_type)
    start = F.struct(F.array().cast(f"array<{open_type}>").alias("done"), none.alias("now"))

    def step(state: Column, item: Column) -> Column:
        tag, kind = item["tag"], F.substring(item["tag"], 3, 1000)
        ends = (tag == "O") | tag.startswith("B-") | (tag.startswith("I-") & (kind != state["now"]["type"]))
        goes_on = tag.startswith("I-") & (kind == state["now"]["type"])
        done = F.when(ends & (F.size(state["now"]["tokens"]) > 0), F.concat(state["done"], F.array(state["now"]))).otherwise(state["done"])
        fresh = F.struct(F.array(item["token"]).alias("tokens"), kind.alias("type")).cast(open_type)
        longer = F.struct(F.concat(state["now"]["tokens"], F.array(item["token"])).alias("tokens"), state["now"]["type"].alias("type")).cast(open_type)
        now = F.when(goes_on, longer).when(tag == "O", none).when(tag.startswith("B-") | tag.startswith("I-"), fresh).otherwise(state["now"])
        return F.struct(done.alias("done"), now.alias("now"))

    def finish(state: Column) -> Column:
        every = F.concat(state["done"], F.array(state["now"]))
        merged = F.transform(every, lambda e: F.struct(trimmed(F.array_join(e["tokens"], " ")).alias("text"), e["type"].alias("type")))
        return F.filter(merged, lambda e: F.length(e["text"]).between(*V.NER_LENGTHS) & (e["type"] != ""))

    return F.aggregate(tags, start, step, finish)
