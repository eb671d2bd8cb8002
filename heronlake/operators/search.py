"""Search: token and substring predicates, entities, BM25 over postings, highlights, details by id."""

from __future__ import annotations

import json
import math
import re

import xxhash
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from heronlake.functions.highlight import highlight
from heronlake.functions.text import tokens
from heronlake.operators.access import HIDDEN_FROM_GUESTS, visible
from heronlake.sources.tables import SEARCH_FIELDS

K1, B = 1.2, 0.75
BOOSTS = {"title": 3.0, "content": 1.0}


def has_all_tokens(query: str, columns: list[str], folded: bool | str = False) -> Column:
    """Whether the columns together hold every token of the query."""
    text = F.concat_ws(" ", *columns)
    wanted = tokens(F.lit(query), folded)
    return (F.size(wanted) > 0) & (F.size(F.array_except(wanted, tokens(text, folded))) == 0)


def like(query: str, columns: list[str], ignore_case: bool = False) -> Column:
    """%query% in a column; % and _ in the query are wildcards."""
    match = [F.col(c).ilike(f"%{query}%") if ignore_case else F.col(c).like(f"%{query}%") for c in columns]
    found = match[0]
    for m in match[1:]:
        found = found | m
    return found


def has_entity(text: str, kind: str | None = None, column: str = "entities") -> Column:
    """Whether one entity has the text and the type."""
    return F.exists(column, lambda e: (e["text"] == text) & (F.lit(True) if kind is None else e["type"] == kind))


def has_field(column: str) -> Column:
    """Whether a field is there at all; an empty string or list counts."""
    return F.col(column).isNotNull()


def restrict(rows: DataFrame, category: str | None = None, source: str | None = None, date_from=None, date_to=None) -> DataFrame:
    return rows.filter(_conditions("admin", category, source, date_from, date_to))


#: Folders that the tokens and the articles of an index are dealt to by their hash.
TOKEN_FOLDERS = 64
#: Columns that postings carry, where articles have them, so that roles and filters need no join.
CARRIED = ("is_canonical", "category", "source", "publish_date")
#: Ids that a search may broadcast: those of its rare tokens, whose number the index knows before it reads them.
RARE_IDS = 250_000


def _counted(articles: DataFrame, fields: tuple[str, ...], folded: bool | str, carried: tuple[str, ...]) -> DataFrame:
    """(id, carried columns, field, len, token, tf) of articles, a row for each distinct token of a field.

    An article's tokens stand in one row, so they are counted where they are made: sorted, and cut where they change.
    """
    parts = None
    for field in fields:
        own = articles.select("id", *carried, F.lit(field).alias("field"), F.sort_array(tokens(F.col(field), folded)).alias("t"))
        # The places of a token's first occurrences, and behind the last one the end.
        first = F.filter(F.sequence(F.lit(0), F.size("t") - 1), lambda i: (i == 0) | (F.get("t", i) != F.get("t", i - 1)))
        own = own.filter(F.size("t") > 0).withColumn("at", F.concat(first, F.array(F.size("t"))))
        runs = F.transform(F.slice("at", 1, F.size("at") - 1), lambda i, k: F.struct(F.get("t", i).alias("token"), (F.get("at", k + 1) - i).cast("long").alias("tf")))
        own = own.select("id", *carried, "field", F.size("t").alias("len"), F.explode(runs).alias("run")).select("id", *carried, "field", "len", "run.token", "run.tf")
        parts = own if parts is None else parts.unionByName(own)
    return parts


def postings(articles: DataFrame, fields: tuple[str, ...] = ("title", "content"), folded: bool | str = False, carried: tuple[str, ...] = ()) -> DataFrame:
    """(field, token, id, tf, len, carried columns): how often a token stands in a field of an article, and how many tokens that
    has. Nothing is shuffled; an id stands for one article."""
    return _counted(articles, fields, folded, carried).select("field", "token", "id", "tf", "len", *carried)


def _folder(value: Column, folders: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(folders)).cast("int")


class SearchIndex:
    """A written inverted index of articles: postings in folders by the hash of their token, sorted by token, each with
    the columns that roles and filters ask for; the document frequencies of the tokens; the articles in folders
    by the hash of their id, sorted by id; and one row of statistics for each field. A query reads the folders of its tokens
    and, in them, the row groups of its tokens; a fetch the folders and row groups of its ids."""

    def __init__(self, spark: SparkSession, path: str, rare: int = RARE_IDS):
        options = spark.read.json(f"{path}/options").first()
        self.spark, self.rare = spark, rare
        # With their schemas, tables without rows, and so without files, can be read.
        self.postings, self.tokens, self.articles = (spark.read.schema(StructType.fromJson(json.loads(options[t]))).parquet(f"{path}/{t}") for t in ("postings", "tokens", "articles"))
        self.folded, self.folders = options["folded"], options["folders"]
        self.carried = [c for c in CARRIED if c in self.postings.columns]
        # One row for each field.
        self.statistics = {r["field"]: (r["docs"], r["mean"]) for r in spark.read.parquet(f"{path}/fields").collect()}

    @classmethod
    def write(cls, articles: DataFrame, path: str, folded: bool | str = False, boosts: dict[str, float] | None = None, folders: int = TOKEN_FOLDERS) -> SearchIndex:
        """Index the fields of articles under path, which must not exist, and open the index."""
        spark, fields, carried = articles.sparkSession, tuple(boosts or BOOSTS), tuple(c for c in CARRIED if c in articles.columns)
        kept = articles.withColumn("__folder", _folder(F.col("id"), folders))
        kept.hint("rebalance", "__folder").sortWithinPartitions("__folder", "id").write.partitionBy("__folder").parquet(f"{path}/articles")
        stored = spark.read.schema(kept.schema).parquet(f"{path}/articles")
        rows = postings(stored, fields, folded, carried).withColumn("folder", _folder(F.col("token"), folders))
        # The only shuffle of postings; a frequent token may spread over several files of its folder.
        rows.hint("rebalance", "folder").sortWithinPartitions("folder", "token", "id").write.option("compression", "zstd").partitionBy("folder").parquet(f"{path}/postings")
        written = spark.read.schema(rows.schema).parquet(f"{path}/postings")
        df = written.groupBy("field", "token").agg(F.count("*").alias("df")).withColumn("folder", _folder(F.col("token"), folders))
        df.hint("rebalance", "folder").sortWithinPartitions("folder", "token").write.partitionBy("folder").parquet(f"{path}/tokens")
        schemas = {"articles": kept.schema, "tokens": df.schema, "postings": rows.schema}
        lengths = None
        for field in fields:
            own = stored.select(F.lit(field).alias("field"), F.size(tokens(F.col(field), folded)).alias("len")).filter("len > 0")
            lengths = own if lengths is None else lengths.unionByName(own)
        lengths.groupBy("field").agg(F.count("*").alias("docs"), F.avg("len").alias("mean")).write.parquet(f"{path}/fields")
        spark.range(1).select(F.lit(folded).alias("folded"), F.lit(folders).alias("folders"), *(F.lit(v.json()).alias(k) for k, v in schemas.items())).write.json(f"{path}/options")
        return cls(spark, path)

    def look_up(self, query: str) -> tuple[list[str], DataFrame]:
        """(tokens of the query, their postings)."""
        wanted = query_tokens(self.spark, query, self.folded)
        mine = F.col("folder").isin(self._folders(wanted)) & F.col("token").isin(wanted)
        # A row for each field and token of the query.
        df = self.tokens.filter(mine).select(F.col("field").alias("__f"), F.col("token").alias("__t"), "df")
        hits = self.postings.filter(mine).join(F.broadcast(df), (F.col("field") == F.col("__f")) & (F.col("token") == F.col("__t")))
        return wanted, hits.drop("__f", "__t")

    def _frequencies(self, wanted: list[str], fields: list[str]) -> dict[str, dict[str, int]] | None:
        """Document frequencies of the tokens by field; None, without a job, where all their postings are few anyhow."""
        if sum(self.statistics.get(f, (0, 1.0))[0] for f in fields) * len(wanted) <= self.rare:
            return None
        found: dict[str, dict[str, int]] = {t: dict.fromkeys(fields, 0) for t in wanted}
        rows = self.tokens.filter(F.col("folder").isin(self._folders(wanted)) & F.col("token").isin(wanted) & F.col("field").isin(fields))
        for r in rows.collect():  # a row for each token of the query and field
            found[r["token"]][r["field"]] = r["df"]
        return found

    def _folders(self, wanted: list[str]) -> list[int]:
        # What _folder gives for strings: XXH64 of UTF-8 with seed 42, as a signed number.
        hashes = (xxhash.xxh64_intdigest(t.encode(), seed=42) for t in wanted)
        return sorted({(h - (h >> 63 << 64)) % self.folders for h in hashes})

    def all_tokens(self, query: str, fields: tuple[str, ...] = ("title", "content")) -> DataFrame:
        """(id) of the articles whose fields together hold every token of the query; none for a query without tokens.

        Where the rarest token's articles are few, their ids are broadcast and the other tokens' postings only pass by them;
        else all postings meet in one aggregation.
        """
        wanted, hits = self.look_up(query)
        hits = hits.filter(F.col("field").isin(list(fields)))
        df = self._frequencies(wanted, list(fields)) if len(wanted) > 1 else None
        if df is not None:
            rarest = min(wanted, key=lambda t: sum(df[t].values()))
            if sum(df[rarest].values()) <= self.rare:
                few = hits.filter(F.col("token") == rarest).select("id").distinct()
                hits = hits.join(F.broadcast(few), "id", "left_semi")  # `rare` ids at most
        if not 1 <= len(wanted) <= 60:
            held = hits.groupBy("id").agg(F.count_distinct("token").alias("n"))
            return held.filter((F.col("n") == len(wanted)) & (F.col("n") > 0)).select("id")
        # A bit for each token; their union is the least that an aggregate must carry.
        place = F.array_position(F.array(*map(F.lit, wanted)), F.col("token")).cast("int")
        bit = F.element_at(F.array(*(F.lit(1 << k).cast("long") for k in range(len(wanted)))), place)
        return hits.groupBy("id").agg(F.bit_or(bit).alias("bits")).filter(F.col("bits") == (1 << len(wanted)) - 1).select("id")

    def bm25(self, query: str, boosts: dict[str, float] | None = None, idf_of: str | None = None) -> DataFrame:
        """(id, score) of the articles with at least one token of the query: the best field's BM25, boosted.

        idf_of: a field for which idf is added, the weights of the query's tokens that an article's field holds, others 0.
        """
        return self._scored(*self.look_up(query), boosts or BOOSTS, idf_of)

    def _scored(self, wanted: list[str], hits: DataFrame, boosts: dict[str, float], idf_of: str | None) -> DataFrame:
        best, weights = [], []
        for f, boost in boosts.items():
            docs, mean = self.statistics.get(f, (0, 1.0))
            idf = F.log1p((docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
            part = boost * idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / mean))
            best.append(F.sum(F.when(F.col("field") == f, part).otherwise(0.0)))
            if f == idf_of:
                weights = [F.coalesce(F.max(F.when((F.col("field") == f) & (F.col("token") == t), idf)), F.lit(0.0)) for t in wanted]
        added = [F.array(*weights).cast("array<double>").alias("idf")] if idf_of else []
        return hits.filter(F.col("field").isin(list(boosts))).groupBy("id").agg((F.greatest(*best) if len(best) > 1 else best[0]).alias("score"), *added)

    def top(self, query: str, size: int, keep: Column | None = None, ids: DataFrame | None = None, boosts: dict[str, float] | None = None, idf_of: str | None = None) -> tuple[list[str], list[Row]]:
        """(tokens of the query, the best `size` of bm25 with the folder of their ids, ties by id), of the postings that keep
        holds for and the articles whose id is among ids.

        Where a query has rare and frequent tokens, the articles with a rare one are scored first, by all tokens. If the last
        of the best has more than the frequent tokens can give together, no other article can be among them; else all are
        scored. So the frequent tokens' postings are read, but mostly not shuffled.
        """
        boosts = boosts or BOOSTS
        wanted, hits = self.look_up(query)
        hits = hits if keep is None else hits.filter(keep)

        def best(rows: DataFrame) -> list[Row]:
            scored = self._scored(wanted, rows, boosts, idf_of)
            scored = scored if ids is None else scored.join(ids, "id", "left_semi")
            return scored.orderBy(F.col("score").desc(), "id").limit(size).withColumn("folder", _folder(F.col("id"), self.folders)).collect()

        df, rare, most = self._frequencies(wanted, list(boosts)), [], 0
        for t in sorted(df or (), key=lambda t: sum(df[t].values())):
            most += sum(df[t].values())
            rare += [t] if most <= self.rare else []
        if rare and len(rare) < len(wanted):
            few = hits.filter(F.col("token").isin(rare) & F.col("field").isin(list(boosts))).select("id").distinct()
            found = best(hits.join(F.broadcast(few), "id", "left_semi"))  # `rare` ids at most
            docs = {f: self.statistics.get(f, (0, 1.0))[0] for f in boosts}
            rest = sum(max(boost * (K1 + 1) * math.log1p((docs[f] - df[t][f] + 0.5) / (df[t][f] + 0.5)) for f, boost in boosts.items()) for t in wanted if t not in rare)
            if len(found) == size and found[-1]["score"] > rest * (1 + 1e-9):
                return wanted, found
        return wanted, best(hits)

    def fetch(self, rows: list[Row]) -> DataFrame:
        """The indexed articles with the ids and folders of the rows: of their folders and row groups only."""
        found = self.articles.filter(F.col("__folder").isin(sorted({r["folder"] for r in rows})) & F.col("id").isin([r["id"] for r in rows]))
        return found.drop("__folder")


def bm25(articles: DataFrame, query: str, folded: bool | str = False, boosts: dict[str, float] = BOOSTS, idf_of: str | None = None) -> DataFrame:
    """(id, score) of the articles with at least one token of the query: the best field's BM25, boosted; idf_of: see the index.

    Only the query's tokens leave the scan, as counts in each document's row: no token is shuffled. The statistics
    (documents, mean lengths, document frequencies) are one aggregate of a single row.
    """
    wanted = query_tokens(articles.sparkSession, query, folded)
    if not wanted:
        none = [F.array().cast("array<double>").alias("idf")] if idf_of else []
        return articles.select("id", F.lit(0.0).alias("score"), *none).limit(0)
    rows = articles.select("id", *(tokens(F.col(f), folded).alias(f) for f in boosts))
    columns, statistics = [], [F.count("*").alias("docs")]
    for f in boosts:
        columns.append(F.size(f).alias(f"len_{f}"))
        statistics.append(F.avg(F.when(F.col(f"len_{f}") > 0, F.col(f"len_{f}"))).alias(f"mean_{f}"))
        statistics.append(F.count_if(F.col(f"len_{f}") > 0).alias(f"docs_{f}"))
        for k, t in enumerate(wanted):
            columns.append(_occurrences(f, t).alias(f"tf_{f}_{k}"))
            statistics.append(F.count_if(F.col(f"tf_{f}_{k}") > 0).alias(f"df_{f}_{k}"))
    counted = rows.select("id", *columns)
    matched = None
    for f in boosts:
        for k in range(len(wanted)):
            hit = F.col(f"tf_{f}_{k}") > 0
            matched = hit if matched is None else matched | hit
    scored = counted.filter(matched).crossJoin(F.broadcast(counted.agg(*statistics)))  # one row
    best = []
    for f, boost in boosts.items():
        total = F.lit(0.0)
        for k in range(len(wanted)):
            df, n, tf = F.col(f"df_{f}_{k}"), F.col(f"docs_{f}"), F.col(f"tf_{f}_{k}")
            idf = F.log1p((n - df + 0.5) / (df + 0.5))
            norm = K1 * (1 - B + B * F.col(f"len_{f}") / F.col(f"mean_{f}"))
            total = total + F.when(tf > 0, idf * tf * (K1 + 1) / (tf + norm)).otherwise(0.0)
        best.append(total * boost)
    weights = []
    if idf_of:
        df, n = [F.col(f"df_{idf_of}_{k}") for k in range(len(wanted))], F.col(f"docs_{idf_of}")
        held = [F.when(F.col(f"tf_{idf_of}_{k}") > 0, F.log1p((n - d + 0.5) / (d + 0.5))).otherwise(0.0) for k, d in enumerate(df)]
        weights = [F.array(*held).alias("idf")]
    return scored.select("id", F.greatest(*best).alias("score") if len(best) > 1 else best[0].alias("score"), *weights)


def _occurrences(column: str, token: str) -> Column:
    return F.size(F.filter(column, lambda x: x == token))


def query_tokens(spark: SparkSession, query: str, folded: bool | str) -> list[str]:
    """The distinct tokens of a query, in order."""
    if query.isascii() and folded != "words":
        found = (t for t in re.split(r"[^a-z0-9_]+", query.lower()) if t)
    else:
        # A local relation: the analyzers but that of words run while the plan is made, without a job.
        found = spark.sql("SELECT q FROM VALUES (:q) AS t(q)", args={"q": query}).select(tokens(F.col("q"), folded).alias("t")).first()["t"]
    return list(dict.fromkeys(found))


#: Results that one search may ask for, at most.
MAX_SIZE = 100


def _checked(query: str | None, size: int) -> None:
    if query is not None and not query.strip():
        raise ValueError("the query is empty")
    if not 1 <= size <= MAX_SIZE:
        raise ValueError(f"size must be from 1 to {MAX_SIZE}, not {size}")


def search(articles: DataFrame, query: str, role: str = "guest", size: int = 20, folded: bool | str = False, index: SearchIndex | None = None, **filters) -> DataFrame:
    """The best `size` articles for a query, with score and highlight.

    Without an index, scores come from a scan of the articles, ranks are settled on ids and scores, and the chosen articles
    join; the statistics are those of all articles that the role sees, whatever the filters. With one, scores, roles, filters
    and texts are those of the index, and statistics those of all articles in it; articles are read only for a filter that
    its postings don't carry.
    """
    _checked(query, size)
    rows = visible(articles, role)
    best = (F.col("score").desc(), "id")
    if index is not None:
        return _search_index(index, rows, query, role, size, filters).orderBy(*best).limit(size)
    wanted = query_tokens(rows.sparkSession, query, folded)
    scored = bm25(rows, query, folded, idf_of="content")
    if any(v is not None for v in filters.values()):
        scored = scored.join(restrict(rows, **filters).select("id"), "id")
    found = rows.join(F.broadcast(scored.orderBy(*best).limit(size)), "id")  # `size` rows
    return found.withColumn("highlight", highlight(F.col("title"), F.col("content"), wanted, F.col("idf"), folded)).drop("idf").orderBy(*best)


def _search_index(index: SearchIndex, rows: DataFrame, query: str, role: str, size: int, filters: dict) -> DataFrame:
    filters = {k: v for k, v in filters.items() if v is not None}
    asked = {"publish_date" if k.startswith("date_") else k for k in filters} | ({"is_canonical"} if role != "admin" else set())
    if asked <= set(index.carried):
        kept = None if not asked else _conditions(role, **filters)
        wanted, top = index.top(query, size, keep=kept, idf_of="content")
    else:
        wanted, top = index.top(query, size, ids=restrict(rows, **filters).select("id"), idf_of="content")
    found = index.fetch(top)
    found = found if role == "admin" else found.drop(*HIDDEN_FROM_GUESTS)
    if not top:
        return found.select("*", F.lit(0.0).alias("score"), F.lit(None).cast("string").alias("highlight")).limit(0)
    # `size` ids at most, as one literal: no join, and one call to the JVM.
    marks = F.from_json(F.lit(json.dumps({str(r["id"]): {"score": r["score"], "idf": r["idf"]} for r in top})), "map<string, struct<score: double, idf: array<double>>>")
    found = found.withColumn("__mark", F.element_at(marks, F.col("id").cast("string")))
    shown = highlight(F.col("title"), F.col("content"), wanted, F.col("__mark.idf"), index.folded)
    return found.withColumn("score", F.col("__mark.score")).withColumn("highlight", shown).drop("__mark")


def _conditions(role: str, category: str | None = None, source: str | None = None, date_from=None, date_to=None) -> Column:
    held = F.lit(True) if role == "admin" else F.col("is_canonical")
    for column, value in (("category", category), ("source", source)):
        held = held if value is None else held & (F.col(column) == value)
    held = held if date_from is None else held & (F.col("publish_date") >= F.lit(date_from))
    return held if date_to is None else held & (F.col("publish_date") <= F.lit(date_to))


def search_by_entity(articles: DataFrame, text: str, kind: str | None = None, category: str | None = None, role: str = "guest", size: int = 20) -> DataFrame:
    _checked(text, size)
    rows = restrict(visible(articles, role), category=category).filter(has_entity(text, kind))
    return rows.orderBy(F.col("publish_date").desc(), "id").limit(size)


def search_entity_and_text(articles: DataFrame, text: str, kind: str, query: str, role: str = "guest") -> DataFrame:
    """Articles with the entity and at least one token of the query in their content."""
    return visible(articles, role).filter(has_entity(text, kind) & F.arrays_overlap(tokens(F.lit(query)), tokens(F.col("content"))))


def search_documents(articles: DataFrame) -> DataFrame:
    """articles with the fields that search keeps, and no others; a field that articles lack is null."""
    return articles.select(*(F.col(c) if c in articles.columns else F.lit(None).cast("string").alias(c) for c in SEARCH_FIELDS))


def article(articles: DataFrame, article_id, role: str = "guest") -> DataFrame:
    """One article by id; no row where it doesn't exist or the role doesn't see it."""
    return visible(articles, role).filter(F.col("id") == article_id)
