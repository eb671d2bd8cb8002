"""The registered queries of the library's own operators over the test tables."""

from __future__ import annotations

import datetime
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heronlake.functions import categories as C
from heronlake.functions import entities as E
from heronlake.functions import text as X
from heronlake.functions import times as TM
from heronlake.functions import urls as U
from heronlake.functions import vocab as V
from heronlake.operators import access, cleaning, dedup, load, profile, ranks, reports, rollups, search, substring, tagging, trends
from heronlake.plans import adapters as A
from heronlake.sources import catalog, feed_source, legacy_csv, rss, stored, tables
from heronlake.sources.html_article import extract_articles
from heronlake.streaming import rollups as stream

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _shared(s: SparkSession, name: str) -> str:
    """A folder of its own that driver and executors share; local masters may do without spark.checkpoint.dir."""
    base = s.conf.get("spark.checkpoint.dir", None)
    if not base and not s.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}" if base else "file://" + tempfile.mkdtemp(prefix=f"heronlake-{name}-") + "/data"


#: Lines that tok1_words puts before texts.
PLANTED_WORDS = ("Đường Nguyễn Ê-kíp", "我们喜欢北京。", "ﬁne ｆｕｌｌ Ⅳ ① Straße", "don't U.S.A. 1,000.5 rock·n·roll", "カタカナ ひらがな 한국어", "")


def _joined(x: Column) -> Column:
    return F.array_join(x, "|")


# Rollups and trends


@query
def agg04_hourly_keyword_rollup(s: SparkSession, d: str) -> DataFrame:
    return rollups.rollup(A.keyword_events(s, d), rollups.HOURLY)


@query
def agg05_daily_keyword_rollup(s: SparkSession, d: str) -> DataFrame:
    return rollups.rollup(A.keyword_events(s, d), rollups.DAILY_KEYWORD)


@query
def agg06_daily_entity_rollup(s: SparkSession, d: str) -> DataFrame:
    return rollups.rollup(A.entity_events(s, d), rollups.DAILY_ENTITY)


@query
def agg07_merged_rollup(s: SparkSession, d: str) -> DataFrame:
    events = A.keyword_events(s, d)
    parts = [rollups.rollup(events.filter(F.col("article_id") % 2 == k), rollups.DAILY_KEYWORD) for k in (0, 1)]
    return rollups.merge_rollups(*parts, keys=rollups.DAILY_KEYWORD)


def _daily(s: SparkSession, d: str):
    events = A.keyword_events(s, d)
    return rollups.rollup(events, rollups.DAILY_KEYWORD), trends.last_day(events)


@query
def agg08_top_keywords(s: SparkSession, d: str) -> DataFrame:
    daily, day = _daily(s, d)
    return trends.top_keywords(daily, day)


@query
def agg08_top_keywords_category(s: SparkSession, d: str) -> DataFrame:
    daily, day = _daily(s, d)
    return trends.top_keywords(daily, day, days=14, category="1", limit=10)


@query
def agg09_hot_keywords(s: SparkSession, d: str) -> DataFrame:
    daily, day = _daily(s, d)
    return trends.hot_keywords(daily, day)


@query
def agg09_hot_keywords_joined(s: SparkSession, d: str) -> DataFrame:
    daily, day = _daily(s, d)
    return trends.hot_keywords_joined(daily, day)


@query
def agg10_hourly_filled(s: SparkSession, d: str) -> DataFrame:
    events = A.keyword_events(s, d)
    return trends.hourly(events, trends.last_day(events))


@query
def agg11_top_entities(s: SparkSession, d: str) -> DataFrame:
    events = A.entity_events(s, d)
    return trends.top_entities(rollups.rollup(events, rollups.DAILY_ENTITY), trends.last_day(events), "click")


@query
def agg12_timeline(s: SparkSession, d: str) -> DataFrame:
    events = A.keyword_events(s, d)
    return trends.timeline(events, trends.last_day(events))


@query
def agg12_orders_timeline(s: SparkSession, d: str) -> DataFrame:
    orders = A.table(s, d, "orders").select(F.to_date("o_orderdate").alias("day"), F.col("o_orderstatus").alias("category"))
    return trends.timeline(orders, trends.last_day(orders, "day"), days=365, category="F", day="day")


@query
def agg13_cross_source(s: SparkSession, d: str) -> DataFrame:
    events = A.keyword_events(s, d)
    return trends.cross_source(events, trends.last_day(events))


@query
def agg14_sources(s: SparkSession, d: str) -> DataFrame:
    return trends.counts_by(A.table(s, d, "documents"), "source")


@query
def agg14_categories(s: SparkSession, d: str) -> DataFrame:
    return trends.counts_by(A.table(s, d, "documents").withColumnRenamed("lang", "category"), "category")


@query
def agg15_admin_stats(s: SparkSession, d: str) -> DataFrame:
    return access.admin_stats(dedup.near_dup_groups(A.articles(s, d), ["id"]), A.keyword_events(s, d), A.entity_events(s, d))


# Dedup and merge


@query
def win1_near_dup(s: SparkSession, d: str) -> DataFrame:
    marked = dedup.near_dup_groups(A.articles(s, d), ["id"]).filter(F.col("content_length") >= 200)
    return marked.select("id", "dup_group_id", "is_canonical", "dup_count")


@query
def agg03_group_stats(s: SparkSession, d: str) -> DataFrame:
    return dedup.group_stats(dedup.near_dup_groups_windowed(A.articles(s, d), ["id"]))


def _keyed(s: SparkSession, d: str) -> DataFrame:
    return A.articles(s, d).select(F.md5("content").alias("key"), "id", "source", "category", "content", F.array("source", "category").alias("keywords"))


@query
def agg01_first_wins(s: SparkSession, d: str) -> DataFrame:
    return dedup.first_wins(_keyed(s, d), "key", ["id"]).select("key", "id", "source")


@query
def snk4_last_wins(s: SparkSession, d: str) -> DataFrame:
    return dedup.last_wins(_keyed(s, d), "key", ["id"]).select("key", "id", "source")


@query
def agg02_merge_fold(s: SparkSession, d: str) -> DataFrame:
    rows = A.articles(s, d).select(F.md5("title").alias("key"), (F.col("id") % 2).alias("rank"), "id", "content", F.array("source", "category", (F.col("id") % 5).cast("string")).alias("keywords"))
    merged = dedup.merge_fold(rows, "key", ["rank", "id"])
    return merged.select("key", "id", "content_length", "has_full_content", _joined(F.col("keywords")).alias("keywords"))


@query
def jon3_not_yet_done(s: SparkSession, d: str) -> DataFrame:
    return dedup.not_yet_done(A.table(s, d, "documents").select("doc_id", "source"), A.table(s, d, "labels"), "doc_id")


@query
def snk2_append_if_absent(s: SparkSession, d: str) -> DataFrame:
    rows = _keyed(s, d)
    return dedup.append_if_absent(rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1"), "key", ["id"]).select("key", "id")


@query
def jon6_category_lookup(s: SparkSession, d: str) -> DataFrame:
    groups = {"metal": ["bolt", "gear"], "round": ["ring", "wheel"], "colour": ["red", "blue w"], "tool": ["widget"]}
    return C.with_category(A.table(s, d, "part").select("p_partkey", "p_name"), "p_name", "label", groups).select("p_partkey", "p_name", "label")


def _raw_categories(s: SparkSession, d: str) -> DataFrame:
    """Every key of the shipped maps, alone, within more, cut, in capitals, and words that are no key."""
    keys = sorted({k for groups in (V.CATEGORY_GROUPS, V.CATEGORY_GROUPS_EXTENDED) for v in groups.values() for k in v})
    key = F.element_at(F.array(*map(F.lit, keys)), (F.col("doc_id") % len(keys) + 1).cast("int"))
    form = F.element_at(F.array(key, F.concat(F.lit(" "), F.upper(key)), F.concat(F.lit("x/"), key, F.lit("-y")), F.substring(key, 1, 4), F.col("source"), F.lit("")), (F.col("doc_id") % 6 + 1).cast("int"))
    return A.table(s, d, "documents").select("doc_id", form.alias("raw"))


@query
def fn08_category_maps(s: SparkSession, d: str) -> DataFrame:
    rows = C.with_category(_raw_categories(s, d), "raw", "base")
    return C.with_category(rows, "raw", "extended", V.CATEGORY_GROUPS_EXTENDED).select("doc_id", "raw", "base", "extended")


# URLs


@query
def fn01_url_identity(s: SparkSession, d: str) -> DataFrame:
    return A.table(s, d, "pages").select("page_id", U.normalize_url(F.col("url")).alias("normalized"), U.stable_id(F.col("url")).alias("id"))


@query
def fn02_domain_source(s: SparkSession, d: str) -> DataFrame:
    names = {"example.com": "com-site", "example.net": "net-site"}
    host = U.domain(F.col("url"))
    return A.table(s, d, "pages").select("page_id", host.alias("domain"), U.source_of(host, names).alias("source"))


@query
def fn03_source_names(s: SparkSession, d: str) -> DataFrame:
    """Every shipped domain, alone, with a host before it, with more behind it, and none."""
    n, known = F.col("doc_id"), list(V.SOURCES)
    name = F.element_at(F.array(*map(F.lit, known)), (n % len(known) + 1).cast("int"))
    host = F.element_at(F.array(name, F.concat(F.lit("m."), name), F.concat(name, F.lit(".example")), F.concat(F.lit("x"), name)), (n % 4 + 1).cast("int"))
    return A.table(s, d, "documents").select("doc_id", host.alias("host"), U.source_of(host).alias("source"))


@query
def fn09_url_category_maps(s: SparkSession, d: str) -> DataFrame:
    """URLs whose first or second folder is a key of the shipped map, in whole or part, or none."""
    n, keys = F.col("doc_id"), [k for v in V.CATEGORY_GROUPS.values() for k in v if " " not in k]
    key = F.element_at(F.array(*map(F.lit, keys)), (n % len(keys) + 1).cast("int"))
    path = F.element_at(F.array(F.concat(key, F.lit("/a.html")), F.concat(F.lit("zzqq/"), key, F.lit("-123/b")), F.concat(key, F.lit("-99")), F.lit("zzqq/qqzz/c"), F.lit("")), (n % 5 + 1).cast("int"))
    return A.table(s, d, "documents").select("doc_id", U.category_of_url(F.concat(F.lit("https://h.example/"), path)).alias("category"))


@query
def fn09_url_category(s: SparkSession, d: str) -> DataFrame:
    return A.table(s, d, "pages").select("page_id", U.category_of_url(F.col("url"), {"english": ["en"], "french": ["fr"]}).alias("category"))


@query
def src9_page_urls(s: SparkSession, d: str) -> DataFrame:
    page = (F.col("page_id") % 3 + 1).cast("int")
    return A.table(s, d, "pages").select("page_id", U.page_url(F.col("url"), page, "{base}/trang-{page}.htm").alias("page_url"))


@query
def flt17_article_links(s: SparkSession, d: str) -> DataFrame:
    links = U.article_links(F.col("html"), F.col("url"), r"/[a-z]+$")
    return A.table(s, d, "pages").select("page_id", F.explode(links).alias("link"))


# Times


@query
def fn06_time_fields(s: SparkSession, d: str) -> DataFrame:
    return A.table(s, d, "events").select("event_id", *TM.time_fields(F.col("ts")), TM.bucket_label(F.col("ts")).alias("bucket"))


@query
def fn04_parse_times(s: SparkSession, d: str) -> DataFrame:
    """Times in every known format, and one in none."""
    forms = ["EEE, dd MMM yyyy HH:mm:ss '+0700'", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "dd MMM yyyy HH:mm:ss 'GMT'", "yyyy/MM/dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm", "dd/MM/yyyy", "dd-MM-yyyy HH:mm"]
    raw = F.element_at(F.array(*(F.date_format("ts", f) for f in forms), F.lit("junk")), (F.col("event_id") % 10 + 1).cast("int"))
    return A.table(s, d, "events").select("event_id", F.unix_timestamp(TM.to_utc(raw)).alias("epoch"))


# Text, entities and keywords


@query
def fn12_word_count(s: SparkSession, d: str) -> DataFrame:
    return A.table(s, d, "documents").select("doc_id", X.count_words(F.col("text")).cast("long").alias("words"))


@query
def fn11_title_key(s: SparkSession, d: str) -> DataFrame:
    return A.articles(s, d).select("id", X.title_key(F.col("title")).alias("title_key"), X.title_hash(F.col("title")).alias("title_hash"))


@query
def fn07_clean_content(s: SparkSession, d: str) -> DataFrame:
    start = F.element_at(F.array(*map(F.lit, ("", "TTO - ", "(Dân trí) - ", "TTXVN-  ", "Lưu bài viết thành công x Tin bài đã lưu"))), (F.col("id") % 5 + 1).cast("int"))
    end = F.when(F.col("id") % 2 == 0, F.lit("  Nguồn: [Link nguồn] a\n b")).otherwise(F.lit(" \t"))
    raw = F.concat(start, F.col("title"), F.lit(" &amp;lt;b&amp;gt;&nbsp;&quot;&#233;&amp;#7879;&quot; \n"), end)
    return A.articles(s, d).select("id", X.clean_content(raw).alias("cleaned"))


@query
def fn10_author(s: SparkSession, d: str) -> DataFrame:
    rows = A.table(s, d, "documents")
    author = F.when(F.col("doc_id") % 3 == 0, F.upper("source")).when(F.col("doc_id") % 3 == 1, F.lit(" ZNews ")).otherwise(F.concat(F.lit(" A "), F.col("lang")))
    return rows.select("doc_id", E.fix_author(author, F.col("source")).alias("author"))


@query
def fn18_keyword_split(s: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("doc_id") % 2 == 0, F.concat_ws("|", "lang", F.lit(" "), "source")).otherwise(F.concat_ws(",", "lang", F.lit(""), "source"))
    return A.table(s, d, "documents").select("doc_id", _joined(E.split_keywords(raw)).alias("keywords"))


def _phrases(s: SparkSession, d: str) -> DataFrame:
    """Phrases that each rule applies to, made from the words of titles."""
    base = A.articles(s, d).select("id", F.split("title", " ")[0].alias("w"))
    def listed(words: list[str]) -> Column:
        return F.element_at(F.array(*map(F.lit, words)), (F.col("id") % len(words) + 1).cast("int"))

    forms = F.array(
        F.col("w"), F.concat(listed(V.PERSON_PREFIXES), F.col("w")), F.concat(F.upper(listed(V.PLACE_PREFIXES)), F.lit(" "), F.col("w")), F.concat(F.lit("năm "), F.col("id").cast("string")), F.concat(F.col("id").cast("string"), F.lit(" %")),
        F.concat(F.lit("(" ), F.col("w"), F.lit("), ")), F.concat(F.col("id").cast("string"), F.lit(" tỷ")), listed(sorted(V.CATEGORY_KEYWORDS)), listed(V.COMMON_WORDS), F.concat(F.lit("khu vực "), F.col("w")),
    )
    return base.select("id", F.posexplode(forms).alias("form", "phrase"))


@query
def fn14_reject_flags(s: SparkSession, d: str) -> DataFrame:
    text = E.normalize_text(F.col("phrase"))
    return _phrases(s, d).select(
        "id", "form", text.alias("text"), E.is_date_like(text).alias("date_like"), E.is_numeric(text).alias("numeric"), E.is_money_or_percent(text).alias("money"), E.is_common_word(text).alias("common")
    )


@query
def fn15_clean_entities(s: SparkSession, d: str) -> DataFrame:
    rows = _phrases(s, d).withColumn("e", E.clean_entity(F.struct(F.col("phrase").alias("text"), F.lit("ORG").alias("type"))))
    return rows.filter("e is not null").select("id", "form", F.col("e.text").alias("text"), F.col("e.type").alias("type"))


@query
def fn16_clean_keywords(s: SparkSession, d: str) -> DataFrame:
    rows = _phrases(s, d).withColumn("k", E.clean_keyword(F.col("phrase")))
    return rows.filter("k is not null").select("id", "form", F.col("k").alias("keyword"))


@query
def fn17_ordered_dedup(s: SparkSession, d: str) -> DataFrame:
    return A.articles(s, d).select("id", _joined(E.distinct_keywords(F.split("title", " "))).alias("words"))


@query
def fn19_person_name(s: SparkSession, d: str) -> DataFrame:
    name = F.array_join(F.slice(F.split("title", " "), 1, (F.col("id") % 6 + 1).cast("int")), " ")
    return A.articles(s, d).select("id", E.is_person_name(name).alias("is_name"))


@query
def fn30_entity_arrays(s: SparkSession, d: str) -> DataFrame:
    return rollups.entity_arrays(A.articles(s, d)).select("id", _joined(F.col("entity_texts")).alias("texts"), _joined(F.col("entity_types")).alias("types"))


@query
def fn31_keyword_events(s: SparkSession, d: str) -> DataFrame:
    return rollups.keyword_events(A.articles(s, d)).select("article_id", "keyword", "publish_date", "publish_hour", "source", "category")


@query
def fn31_entity_events(s: SparkSession, d: str) -> DataFrame:
    return rollups.entity_events(A.articles(s, d)).select("article_id", "entity_text", "entity_type", "publish_date", "source", "category")


@query
def ner_recognise(s: SparkSession, d: str) -> DataFrame:
    tagger = cleaning.gazetteer_tagger({"The": "PER", "der": "LOC", "la": "LOC", "de la": "ORG"})
    found = cleaning.recognise_entities(A.articles(s, d), tagger, A.table(s, d, "labels").select(F.col("doc_id").alias("id")), chars=None)
    return found.select("id", _joined(F.transform("entities", lambda e: F.concat_ws("/", e["text"], e["type"]))).alias("entities"))


def _learns() -> Column:
    """Whether a tagger may learn from an article."""
    return F.crc32(F.col("id").cast("string")) % 3 != 1


@query
def ner_learned(s: SparkSession, d: str) -> DataFrame:
    """Entities of whole articles by a tagger that learned from the titles of other ones."""
    rows = A.articles(s, d)
    tagger = tagging.train(rows.filter(_learns()))
    found = cleaning.recognise_entities(rows.filter(~_learns()).select("id", "title", "content"), tagger, chars=None, errors="failed")
    return found.select("id", _joined(F.transform("entities", lambda e: F.concat_ws("/", e["text"], e["type"]))).alias("entities"), "failed")


@query
def flt01_validity(s: SparkSession, d: str) -> DataFrame:
    published = F.when(F.col("id") % 7 == 0, "").otherwise("2024-01-01")
    return A.articles(s, d).select("id", cleaning.reject_reason(F.col("title"), F.col("content"), published, 300).alias("reason"))


# Profiles


@query
def agg16_profile(s: SparkSession, d: str) -> DataFrame:
    return profile.shares(A.table(s, d, "documents"), "source")


@query
def agg17_length_profile(s: SparkSession, d: str) -> DataFrame:
    return profile.length_profile(A.articles(s, d))


@query
def agg17_length_percentiles(s: SparkSession, d: str) -> DataFrame:
    rows = A.table(s, d, "documents").select("source", F.length("text").alias("length"))
    made = ranks.percentiles(rows, ["source"], "length", {"p10": 0.1, "median": 0.5, "p95": 0.95, "p999": 0.999})
    return made.select("source", *(F.round(c, 6).alias(c) for c in ("p10", "median", "p95", "p999")))


@query
def agg18_presence(s: SparkSession, d: str) -> DataFrame:
    return profile.presence(dedup.near_dup_groups(A.articles(s, d), ["id"]))


@query
def agg19_top_by_type(s: SparkSession, d: str) -> DataFrame:
    return profile.top_by_type(A.entity_events(s, d))


@query
def agg20_date_range(s: SparkSession, d: str) -> DataFrame:
    return A.articles(s, d).agg(F.min("publish_date").alias("first"), F.max("publish_date").alias("last"))


@query
def agg20_most_active_dates(s: SparkSession, d: str) -> DataFrame:
    return profile.most_active_dates(A.articles(s, d))


def _keyword_lists(s: SparkSession, d: str) -> DataFrame:
    return _phrases(s, d).groupBy("id").agg(F.collect_list(F.col("phrase")).alias("keywords")).withColumn("entities", F.array().cast(E.ENTITIES))


@query
def agg21_cleaning_totals(s: SparkSession, d: str) -> DataFrame:
    rows = _keyword_lists(s, d)
    return profile.cleaning_totals(rows, rows.withColumn("keywords", F.filter(F.transform("keywords", E.clean_keyword), lambda k: k.isNotNull())))


@query
def agg21_rejected_keywords(s: SparkSession, d: str) -> DataFrame:
    return profile.rejected_keywords(_keyword_lists(s, d))


@query
def agg21_clean_changes(s: SparkSession, d: str) -> DataFrame:
    phrases = _phrases(s, d).select(F.struct(F.col("phrase").alias("text"), F.when(F.col("form") % 2 == 0, "ORG").otherwise("PER").alias("type")).alias("e"))
    cleaned = phrases.select(E.clean_entity(F.col("e")).alias("c")).filter("c is not null")
    return profile.clean_changes(phrases.select(F.col("e.type").alias("entity_type")), cleaned.select(F.col("c.type").alias("entity_type")))


# Search and access


@query
def flt05_guest_view(s: SparkSession, d: str) -> DataFrame:
    seen = access.visible(dedup.near_dup_groups(A.articles(s, d), ["id"]))
    return seen.select("id", "title", "source", "category", "dup_count")


@query
def flt12_like(s: SparkSession, d: str) -> DataFrame:
    return A.articles(s, d).filter(search.like("the and", ["title", "content"])).select("id")


@query
def flt13_ilike(s: SparkSession, d: str) -> DataFrame:
    return A.articles(s, d).filter(search.like("THE", ["title", "content"], ignore_case=True)).select("id")


@query
def flt12_like_indexed(s: SparkSession, d: str) -> DataFrame:
    return substring.TrigramIndex.write(A.articles(s, d), _shared(s, "trigrams")).like("the and").select("id")


@query
def flt13_ilike_indexed(s: SparkSession, d: str) -> DataFrame:
    return substring.TrigramIndex.write(A.articles(s, d), _shared(s, "trigrams")).like("THE%reth_", ignore_case=True).select("id")


@query
def flt14_entity_search(s: SparkSession, d: str) -> DataFrame:
    return A.articles(s, d).filter(search.has_entity("The", "PER")).select("id", "title")


@query
def sch2_all_tokens(s: SparkSession, d: str) -> DataFrame:
    return A.articles(s, d).filter(search.has_all_tokens("The of", ["title", "content"])).select("id")


@query
def sch1_bm25(s: SparkSession, d: str) -> DataFrame:
    return search.bm25(A.articles(s, d), "the idiot").select("id", F.round("score", 6).alias("score"))


@query
def sch4_highlight(s: SparkSession, d: str) -> DataFrame:
    found = search.search(dedup.near_dup_groups(A.articles(s, d), ["id"]), "idiot clown", size=20)
    return found.select("id", "highlight")


@query
def sch5_by_entity(s: SparkSession, d: str) -> DataFrame:
    found = search.search_by_entity(dedup.near_dup_groups(A.articles(s, d), ["id"]), "The", "PER", category="en", size=50)
    return found.select("id", "publish_date")


@query
def sch6_entity_and_text(s: SparkSession, d: str) -> DataFrame:
    return search.search_entity_and_text(A.articles(s, d), "The", "PER", "idiot moron", role="admin").select("id")


@query
def sch7_article(s: SparkSession, d: str) -> DataFrame:
    return search.article(A.articles(s, d), 17, role="admin").select("id", "title", "source", "url")


@query
def sch1_bm25_indexed(s: SparkSession, d: str) -> DataFrame:
    index = search.SearchIndex.write(A.articles(s, d), _shared(s, "index"))
    return index.bm25("the idiot").select("id", F.round("score", 6).alias("score"))


@query
def sch1_guest_indexed(s: SparkSession, d: str) -> DataFrame:
    """A guest's filtered search: role, filters and texts from the index alone."""
    rows = dedup.near_dup_groups(A.articles(s, d), ["id"])
    index = search.SearchIndex.write(rows, _shared(s, "index"))
    day = datetime.date(2024, 1, 1)
    found = search.search(rows, "the idiot", size=50, index=index, category="en", date_from=day, date_to=day + datetime.timedelta(days=1))
    return found.select("id", "title", F.md5("content").alias("content"), F.round("score", 6).alias("score"))


@query
def sch2_all_tokens_indexed(s: SparkSession, d: str) -> DataFrame:
    return search.SearchIndex.write(A.articles(s, d), _shared(s, "index")).all_tokens("The of")


@query
def sch3_token_count(s: SparkSession, d: str) -> DataFrame:
    index = search.SearchIndex.write(A.articles(s, d), _shared(s, "index"))
    return index.all_tokens("the and of").agg(F.count("*").alias("n"))


@query
def tok1_folded_tokens(s: SparkSession, d: str) -> DataFrame:
    rows = A.articles(s, d).select("id", F.concat(F.lit("Đường Nguyễn Ê-kíp, "), "title").alias("title"))
    return rows.select("id", _joined(X.tokens(F.col("title"), folded=True)).alias("tokens"))


@query
def tok1_words(s: SparkSession, d: str) -> DataFrame:
    """Words of whole documents behind a line of their own, in several scripts and forms."""
    planted = F.concat(F.element_at(F.array(*map(F.lit, PLANTED_WORDS)), (F.col("doc_id") % len(PLANTED_WORDS) + 1).cast("int")), F.lit("\n"), F.coalesce("text", F.lit("")))
    found = A.table(s, d, "documents").select("doc_id", X.word_tokens(planted).alias("t"))
    return found.select("doc_id", F.size("t").cast("long").alias("n_words"), F.md5(_joined(F.col("t"))).alias("words"))


@query
def flt04_search_documents(s: SparkSession, d: str) -> DataFrame:
    kept = search.search_documents(A.articles(s, d).withColumn("language", F.lit("vi")))
    return kept.select("id", "title", "url", "has_full_content", F.lit("|".join(kept.columns)).alias("fields"), "word_count")


@query
def flt08_date_range(s: SparkSession, d: str) -> DataFrame:
    rows = search.restrict(A.articles(s, d), category="en", date_from=datetime.date(2024, 1, 1), date_to=datetime.date(2024, 1, 2))
    return rows.select("id", "publish_date")


@query
def flt11_exists(s: SparkSession, d: str) -> DataFrame:
    rows = A.articles(s, d)
    return rows.agg(*(F.count_if(search.has_field(c)).alias(c) for c in ("title", "event_time", "publish_date", "source")))


@query
def win2_time_order(s: SparkSession, d: str) -> DataFrame:
    rows = A.articles(s, d).withColumn("published_at", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss"))
    return cleaning.in_time_order(rows, ["id"]).select("id", "published_at")


# Files and loads


@query
def src2_jsonl_round_trip(s: SparkSession, d: str) -> DataFrame:
    base = _shared(s, "jsonl")
    tables.write_jsonl(A.articles(s, d).select("id", "title", "content", "source"), base, max_records=50)
    back = tables.read_jsonl(s, tables.expand_inputs(s, [f"{base}/*.json", f"{base}/part-*"]))
    return back.select(F.col("id").cast("long").alias("id"), "title", F.md5("content").alias("content"), "source")


@query
def src4_file_order(s: SparkSession, d: str) -> DataFrame:
    """Rows of two sets of files with equal titles: the first set in the list wins, and in it the first line.

    Files of a set are ranges of its order, named in that order, so no task sorts or writes a whole set."""
    base, rows = _shared(s, "order"), A.articles(s, d).select("id", "title", "source")
    parts = []
    for rank, part in enumerate((rows.filter("id % 2 = 1"), rows.filter("id % 2 = 0"))):
        part.orderBy(F.col("id").desc()).write.json(f"{base}/{rank}")
        parts.append(tables.with_sequence(tables.read_jsonl(s, f"{base}/{rank}"), rank))
    return dedup.first_wins(tables.union_all(*parts), "title", ["_seq"]).select("title", F.col("id").cast("long").alias("id"))


@query
def src6_legacy_csv(s: SparkSession, d: str) -> DataFrame:
    base, n = _shared(s, "csv"), F.col("doc_id")
    rows = A.table(s, d, "documents").select(
        F.concat(F.lit("https://vnexpress.net/the-thao/"), n.cast("string"), F.when(n % 2 == 0, "/").otherwise("")).alias("url"), F.concat(F.lit('T "q", '), n.cast("string")).alias("title"),
        F.when(n % 11 == 0, "junk").otherwise("2024-01-01T07:00:00").alias("published_at"), F.expr("repeat('a b\n', cast(doc_id % 97 as int))").alias("content.text"), F.when(n % 3 == 0, "Le Van A").otherwise("VnExpress").alias("source.name"),
        F.lit("k1| k2|").alias("keywords"), F.when(n % 5 == 0, "trang-chu").otherwise("du-lich").alias("category.primary"), F.lit("").alias("language"),
    )
    rows.write.option("header", True).option("escape", '"').csv(base)
    made = legacy_csv.articles_from_csv(legacy_csv.read_csv(s, base), "html")
    return made.select("id", "url", "title", "published_at", "author", "source", "category_raw", "category_normalized", "content_length", _joined(F.col("keywords")).alias("keywords"))


@query
def src7_rss(s: SparkSession, d: str) -> DataFrame:
    base, n = _shared(s, "rss"), F.col("doc_id")
    day = F.element_at(F.array(*(F.lit(x) for x in ("Mon, 01 Jan 2024 20:00:00 +0700", "Mon, 01 Jan 2024 20:00:00 GMT", "Tue, 02 Jan 2024 02:00:00 +0700", "junk"))), (n % 4 + 1).cast("int"))
    item = F.concat(F.lit("<item><title> T "), n.cast("string"), F.lit("</title><link>https://dantri.com.vn/suc-khoe/"), n.cast("string"), F.lit("?utm_source=x</link><pubDate>"), day,
                    F.lit("</pubDate><description>"), F.expr("repeat('c d ', cast(doc_id % 60 as int))"), F.lit("</description><category>k</category></item>"))
    feeds = A.table(s, d, "documents").groupBy(F.expr("doc_id div 500")).agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.collect_list(item), ""), F.lit("</channel></rss>")).alias("value"))
    feeds.select("value").write.option("maxRecordsPerFile", 1).text(base)
    made = rss.articles_from_feed(rss.read_feed(s, base), start_date=datetime.date(2024, 1, 2))
    return made.select("id", "url", "title", "published_at", "source", "category_raw", "category_normalized", "content_length", _joined(F.col("keywords")).alias("keywords"))


def _two_loads(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Articles by the hash of their text: most of them, and then every other one under another name, and the rest."""
    rows = A.articles(s, d).select(F.md5("content").alias("id"), F.col("id").alias("n"), "title", "source", "publish_date")
    return rows.filter("n % 3 <> 0"), rows.filter("n % 2 = 0 OR n % 3 = 0").withColumn("source", F.concat(F.lit("again-"), "source"))


@query
def snk4_stored_upsert(s: SparkSession, d: str) -> DataFrame:
    first, second = _two_loads(s, d)
    table = stored.StoredTable.create(s, _shared(s, "stored"), first.schema, "id", buckets=8)
    table.upsert(first, ["n"])
    table.upsert(second, ["n"])
    return table.read()


@query
def snk8_stored_inserts(s: SparkSession, d: str) -> DataFrame:
    first, second = _two_loads(s, d)
    table = stored.StoredTable.create(s, _shared(s, "stored"), first.schema, "id", buckets=8)
    table.insert_absent(first, ["n"])
    table.insert_absent(second, ["n"])
    return table.read()


def _escaped(x: Column) -> Column:
    """Text as XML holds it; characters that XML can't hold are left out."""
    t = F.regexp_replace(x, r"[\x00-\x08\x0B\x0C\x0D\x0E-\x1F\x{FFFE}\x{FFFF}]", "")
    return F.replace(F.replace(F.replace(t, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _stored_feeds(s: SparkSession, items: DataFrame, n: Column) -> str:
    """A folder with feeds of some 100 items (title, link, at, text); every third is Atom."""
    base, atom = _shared(s, "feeds"), F.expr("feed % 3 = 0")
    t, u, x = (_escaped(F.col(c)) for c in ("title", "link", "text"))
    rss_item = F.concat(F.lit("<item><title>"), t, F.lit("</title><link>"), u, F.lit("</link><pubDate>"), F.date_format("at", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000</pubDate><description>"), x, F.lit("</description></item>"))
    entry = F.concat(F.lit("<entry><title>"), t, F.lit('</title><link rel="alternate" href="'), u, F.lit('"/><updated>'), F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z</updated><summary>"), x, F.lit("</summary></entry>"))
    dealt = items.withColumn("feed", n).select("feed", F.when(atom, entry).otherwise(rss_item).alias("item"))
    whole = F.array_join(F.collect_list("item"), "")
    feeds = dealt.groupBy("feed").agg(F.when(atom, F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), whole, F.lit("</feed>"))).otherwise(F.concat(F.lit("<rss><channel>"), whole, F.lit("</channel></rss>"))).alias("value"))
    feeds.select("value").write.option("maxRecordsPerFile", 1).option("lineSep", " ").text(base)
    return base


@query
def src7_feed_source(s: SparkSession, d: str) -> DataFrame:
    """Titles and texts of articles through stored feeds and the feed source, from the second day on."""
    rows = A.articles(s, d).filter("event_time IS NOT NULL")
    items = rows.select("id", "title", F.concat(F.lit("https://dantri.com.vn/suc-khoe/"), F.col("id").cast("string")).alias("link"), F.col("event_time").alias("at"), F.col("content").alias("text"))
    made = rss.articles_from_feed(feed_source.read_feeds(s, _stored_feeds(s, items, F.expr("id div 100")), datetime.date(2024, 1, 2)))
    return made.select("url", "title", "published_at", "category_normalized", F.md5("content").alias("content"), "content_length")


@query
def fn28_feed_with_pages(s: SparkSession, d: str) -> DataFrame:
    """Items of pages, with short titles and texts, filled up from the pages behind their links."""
    pages = A.table(s, d, "pages")
    events = A.table(s, d, "events").select("event_id", F.col("ts").alias("at"))
    items = pages.join(events, F.col("page_id") == F.col("event_id")).select("page_id", F.lit("T").alias("title"), F.col("url").alias("link"), "at", F.lit("s").alias("text"))
    made = rss.articles_from_feed(feed_source.read_feeds(s, _stored_feeds(s, items, F.expr("page_id div 20"))), pages=extract_articles(pages))
    return made.select("url", "title", "published_at", "category_raw", "author", F.md5("content").alias("content"), "content_length", _joined(F.col("keywords")).alias("keywords"))


def _bucketed(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    base, name = _shared(s, "catalog"), f"heronlake_{uuid.uuid4().hex}"
    events = A.keyword_events(s, d).select("article_id", "keyword", "publish_hour")
    return (
        catalog.save_bucketed(A.articles(s, d).select("id", "title", F.col("source").alias("site")), f"{name}_articles", ["id"], buckets=8, path=f"{base}/articles"),
        catalog.save_bucketed(events, f"{name}_events", ["article_id"], ["keyword"], buckets=8, path=f"{base}/events"),
    )


@query
def snk6_bucketed_join(s: SparkSession, d: str) -> DataFrame:
    """Articles and how often each is mentioned at which hours, joined and grouped by id where they lie."""
    articles, events = _bucketed(s, d)
    counted = events.groupBy("article_id").agg(F.count("*").alias("mentions"), F.min("publish_hour").alias("first_hour"))
    return articles.hint("merge").join(counted, F.col("id") == F.col("article_id")).select("id", "site", "mentions", "first_hour")


@query
def snk7_repeated_keys(s: SparkSession, d: str) -> DataFrame:
    return load.repeated_keys(A.articles(s, d).select(F.md5("content").alias("key")), "key")


@query
def load_tables(s: SparkSession, d: str) -> DataFrame:
    """The articles in two loads, the second appended to the first; the rows of all six tables by month."""
    base, rows = _shared(s, "load"), A.articles(s, d)
    load.load_articles(rows.filter("id % 3 = 0"), base, "overwrite")
    load.load_articles(rows.filter("id % 3 <> 0"), base, "append")
    counts = load.loaded_counts(s, base)
    return counts.filter(F.col("table").isin("articles", "keyword_events", "entity_events"))


@query
def load_rollups(s: SparkSession, d: str) -> DataFrame:
    base, rows = _shared(s, "load"), A.articles(s, d)
    load.load_articles(rows.filter("id % 3 = 0"), base, "overwrite")
    load.load_articles(rows.filter("id % 3 <> 0"), base, "append")
    return rollups.merge_rollups(s.read.parquet(f"{base}/daily_keyword_stats"), keys=rollups.DAILY_KEYWORD)


@query
def etl_daily_run(s: SparkSession, d: str) -> DataFrame:
    """Two crawls that share articles, through the whole daily chain."""
    rows, n = A.articles(s, d), F.col("id")
    crawled = rows.select(
        F.md5("content").alias("id"), "url", F.concat(F.lit("T "), "source").alias("title"), F.expr("repeat('x y ', cast(id % 200 + 1 as int))").alias("content"), F.lit("2024-01-01T20:00:00+00:00").alias("published_at"),
        F.lit("").alias("crawled_at"), "source", F.lit("d").alias("source_domain"), F.lit("rss").alias("source_type"), F.lit("the-thao").alias("category_raw"), F.lit("").alias("category_normalized"),
        F.col("source").alias("author"), F.lit("vi").alias("language"), F.array(F.lit(" k1,"), F.lit("K1"), F.lit("2024")).alias("keywords"), F.array().cast(E.ENTITIES).alias("entities"), n.alias("crawl"),
    )
    ready = cleaning.daily_run(crawled, ["crawl"], cleaning.gazetteer_tagger({"x y": "LOC"}))
    return ready.select(
        "id", "content_length", "has_full_content", "category_normalized", "author", "publish_date", "publish_hour", "word_count", "is_canonical", "dup_count",
        _joined(F.col("keywords")).alias("keywords"), _joined(F.transform("entities", lambda e: F.concat_ws("/", e["text"], e["type"]))).alias("entities"),
    )


# Extraction


@query
def fn26_extract_articles(s: SparkSession, d: str) -> DataFrame:
    found = extract_articles(A.table(s, d, "pages"))
    return found.select(
        "page_id", "title", "published_at", "author", _joined(F.col("keywords")).alias("keywords"), F.md5("content").alias("content"), F.length("content").alias("content_length"), "content_from", "category_raw", "domain"
    )


@query
def fn25_planted_bodies(s: SparkSession, d: str) -> DataFrame:
    """Texts of documents, a line a paragraph, amid menus, lists of links, an aside and comments; what is found of them."""
    rows, n = A.table(s, d, "documents"), F.col("doc_id")
    rows = rows.filter(F.exists(F.split("text", "\n"), lambda x: F.length(F.trim(x)) >= 25))
    links = F.expr("array_join(transform(sequence(1, 12), i -> concat('<li><a href=\"/', i, '\">Some headline, with commas, number ', i, '</a></li>')), '')")
    wrap = F.when(n % 3 == 0, F.lit("section")).when(n % 3 == 1, F.lit("div")).otherwise(F.lit("main"))
    body = F.concat(F.lit("<p>"), F.replace(_escaped(F.col("text")), F.lit("\n"), F.lit("</p><p>")), F.lit("</p>"))
    html = F.concat(
        F.lit("<html><head><title>t</title><style>p{}</style></head><body><nav><ul>"), links, F.lit("</ul></nav><div class='x'><ul>"), links, F.lit("</ul></div><div><"), wrap, F.lit(" class='y'>"), body,
        F.lit("</"), wrap, F.lit("></div><aside><p>An aside of some length, which isn't part of it.</p></aside><div id='comments'><p>A comment, which isn't part of it, either, at all.</p></div><footer>end</footer></body></html>"),
    )
    found = extract_articles(rows.select(n.alias("page_id"), F.lit("https://h.example/a").alias("url"), html.alias("html")))
    return found.select(F.col("page_id").alias("doc_id"), F.md5("content").alias("content"), F.length("content").alias("content_length"), "content_from")


# Reports


def _runs(s: SparkSession, d: str) -> DataFrame:
    events = A.table(s, d, "events")
    engine = F.element_at(F.array(*map(F.lit, ("alpha", "beta", "beta-2"))), (F.col("user_id") % 3 + 1).cast("int"))
    return events.select(F.col("event_type").alias("scenario"), engine.alias("engine"), F.col("value").alias("ms"), (F.col("event_id") % 20).alias("run"))


@query
def agg22_latency_summary(s: SparkSession, d: str) -> DataFrame:
    made = reports.latency_summary(_runs(s, d), ["scenario", "engine"])
    return made.select("scenario", "engine", "runs", "min_ms", "max_ms", *(F.round(c, 6).alias(c) for c in ("median_ms", "mean_ms", "p95_ms", "stdev_ms", "qps")))


@query
def agg23_engine_ranking(s: SparkSession, d: str) -> DataFrame:
    made = reports.engine_ranking(reports.latency_summary(_runs(s, d), ["scenario", "engine"]))
    return made.select("engine", F.round("median_of_medians", 6).alias("median_of_medians"), "cases")


@query
def agg24_speed_up(s: SparkSession, d: str) -> DataFrame:
    made = reports.speed_up_against(reports.speed_up(reports.latency_summary(_runs(s, d), ["scenario", "engine"])), "beta")
    return made.select("scenario", "engine", F.round("times_fastest", 6).alias("times_fastest"), F.round("speed_up", 6).alias("speed_up"))


@query
def agg25_storage_totals(s: SparkSession, d: str) -> DataFrame:
    sizes = A.table(s, d, "orders").select(F.col("o_orderpriority").alias("engine"), F.col("o_orderkey").alias("data_size"), (F.col("o_orderkey") % 7).alias("index_size"), F.col("o_custkey").alias("disk_size"))
    return reports.storage_totals(sizes, 1000.0)


# Streaming


def _event_stream(s: SparkSession, d: str, base: str, parts: int = 3) -> DataFrame:
    """The events table as a stream of several files, one to a micro-batch."""
    rows = A.keyword_events(s, d)
    rows.repartition(parts, "article_id").write.parquet(f"{base}/events")
    return s.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/events")


@query
def str1_stream_rollup(s: SparkSession, d: str) -> DataFrame:
    base = _shared(s, "stream")
    stream.maintain_rollup(_event_stream(s, d, base), rollups.HOURLY, f"{base}/rollup", f"{base}/state").awaitTermination()
    return stream.read_rollup(s, f"{base}/rollup", rollups.HOURLY)


@query
def str1_compacted_rollup(s: SparkSession, d: str) -> DataFrame:
    base = _shared(s, "stream")
    stream.maintain_rollup(_event_stream(s, d, base), rollups.HOURLY, f"{base}/rollup", f"{base}/state").awaitTermination()
    stream.compact(s, f"{base}/rollup", f"{base}/compact", rollups.HOURLY)
    return stream.read_rollup(s, f"{base}/compact", rollups.HOURLY)


@query
def str2_buckets(s: SparkSession, d: str) -> DataFrame:
    return stream.buckets(A.keyword_events(s, d))


#: Later than all events by far: such a row closes the windows of all others.
FAR = "TIMESTAMP_NTZ '2050-01-01 00:00:00'"


def _in_turn(s: SparkSession, base: str, *parts: DataFrame) -> DataFrame:
    """Tables as a stream with a micro-batch for each, in this order."""
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(f"{base}/events")
    return s.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/events")


def _closing(rows: DataFrame) -> DataFrame:
    return rows.limit(1).withColumn("event_time", F.expr(FAR))


@query
def str2_streamed_buckets(s: SparkSession, d: str) -> DataFrame:
    """Every event is in time, whatever file it comes in."""
    base, rows = _shared(s, "stream"), A.keyword_events(s, d)
    events = _in_turn(s, base, rows.filter("article_id % 3 = 1"), rows.filter("article_id % 3 <> 1"), _closing(rows))
    stream.maintain_buckets(events, f"{base}/buckets", f"{base}/state", lateness="3650 days").awaitTermination()
    return s.read.parquet(f"{base}/buckets")


@query
def str2_late_buckets(s: SparkSession, d: str) -> DataFrame:
    """Every fiftieth event of the first quarter comes after the second half, too late for its window."""
    base, rows = _shared(s, "stream"), A.keyword_events(s, d)
    first, last = rows.agg(F.min("event_time"), F.max("event_time")).first()
    quarter, half = first + (last - first) / 4, first + (last - first) / 2
    late = (F.col("article_id") % 50 == 0) & (F.col("event_time") < F.lit(quarter).cast("timestamp_ntz"))
    early = F.col("event_time") < F.lit(half).cast("timestamp_ntz")
    events = _in_turn(s, base, rows.filter(early & ~late), rows.filter(~early & ~late), rows.filter(late), _closing(rows))
    run = stream.maintain_buckets(events, f"{base}/buckets", f"{base}/state")
    run.awaitTermination()
    counted = s.read.parquet(f"{base}/buckets")
    return counted.withColumn("dropped", F.lit(stream.late_rows(run, counted, still_open=1)).cast("long"))


@query
def str3_first_seen(s: SparkSession, d: str) -> DataFrame:
    """Keys of events that come in two batches, and all once more."""
    base, rows = _shared(s, "stream"), A.keyword_events(s, d).withColumn("key", F.concat_ws("/", "keyword", "category"))
    events = _in_turn(s, base, rows.filter("article_id % 2 = 0"), rows.filter("article_id % 2 = 1"), rows)
    stream.maintain_first_seen(events, "key", f"{base}/seen", f"{base}/state", within="3650 days").awaitTermination()
    return s.read.parquet(f"{base}/seen").select("key")


@query
def str3_append_new(s: SparkSession, d: str) -> DataFrame:
    base = _shared(s, "stream")
    events = _event_stream(s, d, base).select(F.concat_ws("/", "keyword", "category").alias("key"), "article_id")
    stream.append_new(events, "key", ["article_id"], f"{base}/store", f"{base}/state").awaitTermination()
    return stream.read_appended(s, f"{base}/store").select("key")


@query
def str7_circuit_breaker(s: SparkSession, d: str) -> DataFrame:
    log = A.table(s, d, "events").select("event_id", F.col("user_id").cast("string").alias("domain"), F.struct("ts", "event_id").alias("at"), (F.col("event_type") == "purchase").alias("ok"))
    return stream.circuit_breaker(log).select("event_id", "blocked")
