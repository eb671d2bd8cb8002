"""The stages from crawled to ready articles: merge, cleanup, recognition and cleaning of entities."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heronlake.functions import vocab as V
from heronlake.functions.categories import with_category
from heronlake.functions.entities import ENTITIES, clean_entities, clean_keywords, distinct_entities, fix_author
from heronlake.functions.text import clean_content, count_words, trimmed
from heronlake.functions.times import time_fields
from heronlake.operators.dedup import first_wins, merge_fold, near_dup_groups, not_yet_done


def reject_reason(title: Column, content: Column, published_at: Column, least: int = V.MIN_LENGTH_RSS) -> Column:
    """Why an article is invalid, null if it is valid; the first reason in this order."""
    n = F.coalesce(F.length(content), F.lit(0))
    return (
        F.when(F.trim(F.coalesce(title, F.lit(""))) == "", "empty_title").when(F.coalesce(published_at, F.lit("")) == "", "no_published_at")
        .when(n < least, F.concat(F.lit("content_too_short("), n.cast("string"), F.lit(")")))
    )


def refill(rows: DataFrame) -> DataFrame:
    """Articles with defaults for what is missing, text cleaned again and lengths computed again."""
    texts = ("id", "url", "published_at", "crawled_at", "source", "source_domain", "source_type", "category_raw", "category_normalized", "author")
    filled = rows.withColumns({c: F.coalesce(c, F.lit("")) for c in texts} | {c: clean_content(F.col(c)) for c in ("title", "content")})
    keywords = F.filter(F.coalesce("keywords", F.array().cast("array<string>")), lambda k: F.coalesce(k, F.lit("")) != "")
    filled = filled.withColumns({"keywords": keywords, "entities": F.coalesce("entities", F.array().cast(ENTITIES)), "language": F.coalesce("language", F.lit("vi"))})
    return filled.withColumns({"content_length": F.length("content"), "has_full_content": F.length("content") >= V.FULL_LENGTH})


def build_dataset(crawled: DataFrame, order: list[str]) -> DataFrame:
    """One valid article for each id of several crawls; validity is judged before cleaning."""
    merged = merge_fold(crawled.filter(F.coalesce("id", F.lit("")) != ""), "id", order)
    return refill(merged.filter(reject_reason(F.col("title"), F.col("content"), F.col("published_at")).isNull()))


def cleanup(articles: DataFrame, order: list[str], least: int = V.MIN_LENGTH_CLEAN) -> DataFrame:
    """First of each id, near-duplicate groups, categories, authors, local time and word counts; short articles go
    last, so they still count in their group."""
    rows = near_dup_groups(first_wins(articles, "id", order), order)
    rows = with_category(rows, "category_raw", "category_normalized", V.CATEGORY_GROUPS_EXTENDED)
    at = F.try_to_timestamp("published_at")
    names = ("publish_date", "publish_hour", "publish_dow")
    rows = rows.withColumns({"author": fix_author(F.col("author"), F.col("source")), "word_count": count_words(F.col("content"))} | dict(zip(names, time_fields(at), strict=True)))
    return rows.filter(F.coalesce("content_length", F.lit(0)) >= least)


def in_time_order(articles: DataFrame, order: list[str]) -> DataFrame:
    """articles sorted by the text of published_at, an unknown one first, ties by `order`: for files that hold them so."""
    return articles.orderBy(F.coalesce("published_at", F.lit("")), *order)


def daily_run(crawled: DataFrame, order: list[str], tagger: Tagger, done: DataFrame | None = None) -> DataFrame:
    """The daily chain: crawls merged and validated, cleaned up, entities recognised for articles not in `done`, entities and
    keywords cleaned; gives the ready articles. Nothing is written between the stages."""
    built = build_dataset(crawled, order)
    # A merged article has one row for its id, so any order of columns is one.
    ready = cleanup(built, ["id"])
    return clean_article_entities(recognise_entities(ready, tagger, done, chars=None))


Tagger = Callable[[str], list[tuple[str, str]]]


def gazetteer_tagger(names: dict[str, str]) -> Tagger:
    """A tagger that marks listed names (text -> type), longest first, word by word."""
    listed = {tuple(k.split()): v for k, v in names.items()}
    longest = max(map(len, listed), default=0)

    def tag(text: str) -> list[tuple[str, str]]:
        words, out, i = text.split(), [], 0
        bare = [w.strip(".,;:!?()\"'") for w in words]
        while i < len(words):
            n = next((n for n in range(min(longest, len(words) - i), 0, -1) if tuple(bare[i : i + n]) in listed), 0)
            if n:
                kind = listed[tuple(bare[i : i + n])]
                out += [(bare[i + k], f"{'I' if k else 'B'}-{kind}") for k in range(n)]
            else:
                out.append((words[i], "O"))
            i += n or 1
        return out

    return tag


def recognise_entities(articles: DataFrame, tagger: Tagger, done: DataFrame | None = None, id_column: str = "id", title_only: bool = False, chars: int | None = V.NER_CHARS, errors: str | None = None) -> DataFrame:
    """articles with entities of their title and of the first `chars` characters of their content (None: all of it; the
    default is the reference's limit); ids in done are left out. Only the texts go through Python.

    A text that the tagger fails on has none; `errors` names a column for how many of an article's two texts failed. A tagger
    with `tag_all` is given the texts of a batch at once, and one by one where that fails."""
    rows = articles if done is None else not_yet_done(articles, done, id_column)
    kept = [c for c in rows.columns if c != "entities"]
    content = F.col("content") if chars is None else F.substring("content", 1, chars)
    cut = rows.select(F.struct(*kept).alias("row"), F.coalesce("title", F.lit("")).alias("t"), (F.lit("") if title_only else F.coalesce(content, F.lit(""))).alias("c"))
    kind = pa.list_(pa.struct([("text", pa.string()), ("type", pa.string())]))

    def safely(text: str) -> list[tuple[str, str]] | None:
        try:
            return tagger(text) if text else []
        except Exception:  # noqa: BLE001  whatever a tagger raises
            return None

    def tag_all(texts: list[str]) -> list[list[tuple[str, str]] | None]:
        try:
            return tagger.tag_all(texts)
        except Exception:  # noqa: BLE001
            return list(map(safely, texts))

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                found = [tag_all(batch.column(i).to_pylist()) for i in (1, 2)]
                failed = [sum(x is None for x in pair) for pair in zip(*found, strict=True)]
                merged = [[{"text": a, "type": b} for a, b in dict.fromkeys(e for x in pair for e in _merged(x or []))] for pair in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(merged, kind), pa.array(failed, pa.int32())], names=["row", "found", "failed"])

    row = cut.schema["row"].dataType.simpleString()
    tagged = cut.mapInArrow(run, f"row {row}, found array<struct<text:string,type:string>>, failed int")
    bare = F.transform("found", lambda e: F.struct(trimmed(e["text"]).alias("text"), e["type"].alias("type")))
    found = distinct_entities(F.filter(bare, lambda e: F.length(e["text"]).between(*V.NER_LENGTHS) & (e["type"] != "")))
    return tagged.select("row.*", found.alias("entities"), *([F.col("failed").alias(errors)] if errors else []))


def _merged(tagged: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """(text, type) of entities as `merge_bio` has them, before it trims and sifts: in time that grows with their number."""
    out, words, kind = [], [], ""
    for token, tag in tagged:
        if tag == "O":
            if words:
                out.append((" ".join(words), kind))
            words, kind = [], ""
        elif tag and tag.startswith(("B-", "I-")):
            own = tag[2:1002]
            if tag[0] == "I" and own == kind:
                words.append(token)
            else:
                if words:
                    out.append((" ".join(words), kind))
                words, kind = [token], own
    return [*out, (" ".join(words), kind)] if words else out


def clean_article_entities(articles: DataFrame) -> DataFrame:
    return articles.withColumns({"entities": clean_entities(F.col("entities")), "keywords": clean_keywords(F.col("keywords"))})
