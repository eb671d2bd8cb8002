"""DuckDB SQL for the registered queries."""

from heronlake.functions import vocab as V
from heronlake.sources.tables import SEARCH_FIELDS


def listed(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def one_of(words, number: str = "id") -> str:
    """The word that a number picks."""
    return f"({listed(words)})[({number} % {len(words)} + 1)::INTEGER]"


def first_prefix(words) -> str:
    return f"coalesce(length(list_filter({listed(words)}, lambda p: starts_with(lower(text), p))[1]), 0)"


def mapped(raw: str, groups: dict) -> str:
    """The label of a raw category: that of the first equal key, else of the first that contains it or is contained."""
    keys = [(k, v) for v, ks in groups.items() for k in ks]
    names, labels, low = listed(k for k, _ in keys), listed(v for _, v in keys), f"lower(trim({raw}))"
    near = f"list_filter(range(1, {len(keys) + 1}), lambda i: contains({low}, ({names})[i]) OR contains(({names})[i], {low}))[1]"
    return f"CASE WHEN {raw} = '' THEN 'other' ELSE coalesce(({labels})[coalesce(list_position({names}, {low}), {near})], 'other') END"


KE = """SELECT event_id AS article_id, json_extract_string(props, '$.k') AS keyword, ts AS event_time, ts::DATE AS publish_date,
  hour(ts)::INTEGER AS publish_hour, event_type AS source, (user_id % 4)::VARCHAR AS category FROM events"""
EE = """SELECT event_id AS article_id, user_id::VARCHAR AS entity_text, event_type AS entity_type, ts::DATE AS publish_date,
  (user_id % 4)::VARCHAR AS category FROM events"""
ART = r"""SELECT doc_id AS id, split_part(text, chr(10), 1) AS title, text AS content, source, lang AS category, ts AS event_time, ts::DATE AS publish_date,
  hour(ts)::INTEGER AS publish_hour, 'https://example.net/' || doc_id AS url, source AS author, length(text) AS content_length, length(text) >= 500 AS has_full_content,
  list_transform(list_filter(string_split_regex(split_part(text, chr(10), 1), '[^\p{L}]+'), lambda w: regexp_matches(w, '^\p{Lu}')),
    lambda w: {'text': w, 'type': CASE length(w) % 3 WHEN 0 THEN 'PER' WHEN 1 THEN 'LOC' ELSE 'ORG' END}) AS entities
  FROM documents LEFT JOIN events ON doc_id = event_id"""
KEY = r"trim(regexp_replace(regexp_replace(replace(strip_accents(lower(trim(title))), 'đ', 'd'), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
DUP = f"""SELECT *, CASE WHEN count(*) OVER w > 1 THEN h ELSE '' END AS dup_group_id, count(*) OVER w AS dup_count,
  row_number() OVER (PARTITION BY h ORDER BY has_full_content DESC, content_length DESC, id) = 1 AS is_canonical
  FROM (SELECT *, md5({KEY})[1:12] AS h FROM ({ART})) WINDOW w AS (PARTITION BY h)"""
TOKENS = r"list_filter(string_split_regex(lower(title || ' ' || content), '[^\p{L}\p{N}_]+'), lambda t: t <> '')"
DAILY = f"SELECT publish_date, keyword, category, count(*) AS mention_count FROM ({KE}) GROUP BY ALL"
HOT = f"""WITH d AS ({DAILY}), a AS (SELECT max(publish_date) AS day FROM d),
now AS (SELECT keyword, sum(mention_count)::BIGINT AS count_now FROM d, a WHERE publish_date >= day - 7 GROUP BY 1),
prev AS (SELECT keyword, sum(mention_count)::BIGINT AS p FROM d, a WHERE publish_date >= day - 14 AND publish_date < day - 7 GROUP BY 1)
SELECT keyword, count_now, coalesce(p, 0) AS count_prev, count_now / greatest(coalesce(p, 0), 1) AS multiplier
FROM now LEFT JOIN prev USING (keyword) WHERE count_now >= 5 ORDER BY multiplier DESC, count_now DESC, keyword LIMIT 20"""
PHRASES = f"""SELECT id, form - 1 AS form, forms[form] AS phrase FROM (
  SELECT id, [w, {one_of(V.PERSON_PREFIXES)} || w, upper({one_of(V.PLACE_PREFIXES)}) || ' ' || w, 'năm ' || id, id || ' %', '(' || w || '), ', id || ' tỷ',
    {one_of(sorted(V.CATEGORY_KEYWORDS))}, {one_of(V.COMMON_WORDS)}, 'khu vực ' || w] AS forms
  FROM (SELECT id, split_part(title, ' ', 1) AS w FROM ({ART}))), range(1, 11) r(form)"""
EDGE = r"[\s,.;:!?\-–—(){}\[\]''\"“”‘’]+"
NORMAL = rf"trim(regexp_replace(regexp_replace(regexp_replace(trim(phrase), '^{EDGE}', ''), '{EDGE}$', ''), '\s+', ' ', 'g'))"
FLAGS = rf"""SELECT id, form, text, regexp_matches(text, '(?i)^(năm|tháng|ngày|tuần|giờ|phút|quý|thế\s*kỷ|thập\s*kỷ)\s*[0-9]') AS date_like,
  regexp_matches(text, '^[0-9\s,.\-+]+$') AS numeric, regexp_matches(text, '[%‰]|(?i)(USD|VND|EUR|JPY|CNY|đ|đồng|tỷ|triệu|nghìn)\s*$') AS money,
  list_contains({listed(V.COMMON_WORDS)}, lower(text)) AS common
  FROM (SELECT id, form, {NORMAL} AS text FROM ({PHRASES}))"""
CLEAN = f"""SELECT id, form, new_text AS text, CASE WHEN place > 0 THEN 'LOC' WHEN person > 0 THEN 'PER' ELSE 'ORG' END AS type FROM (
  SELECT *, CASE WHEN greatest(place, person) > 0 AND length(rest) >= 2 THEN rest ELSE text END AS new_text FROM (
    SELECT *, trim(text[CASE WHEN place > 0 THEN place ELSE person END + 1:]) AS rest FROM (
      SELECT *, {first_prefix(V.PLACE_PREFIXES)} AS place, {first_prefix(V.PERSON_PREFIXES)} AS person FROM ({FLAGS})
      WHERE length(text) BETWEEN 2 AND 50 AND NOT date_like AND NOT numeric AND NOT money AND NOT common)))
  WHERE length(new_text) BETWEEN 2 AND 50 AND NOT list_contains({listed(V.COMMON_WORDS)}, lower(new_text))"""
URL = r"regexp_extract(url, '^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)', {})"
NORMAL_URL = "CASE WHEN p LIKE '%/' AND length(p) > 1 THEN left(bare, length(bare) - 1) ELSE bare END"
KEPT_KEYWORDS = f"SELECT id, form, text AS keyword FROM ({FLAGS}) WHERE length(text) BETWEEN 2 AND 50 AND NOT date_like AND NOT numeric AND NOT money AND NOT common AND NOT list_contains({listed(V.CATEGORY_KEYWORDS)}, lower(text))"
ARTICLE_KEYWORDS = rf"""SELECT unnest(list_transform(list_sort(list_transform(list_distinct(ts), lambda t: {{'p': list_position(ts, t), 't': t}})), lambda x: x.t)[1:3]) AS keyword, publish_date, category FROM (
    SELECT *, list_filter(string_split_regex(lower(title), '[^\p{{L}}\p{{N}}_]+'), lambda t: t <> '') AS ts FROM ({ART}))"""
RUNS = "SELECT event_type AS scenario, ['alpha', 'beta', 'beta-2'][user_id % 3 + 1] AS engine, value AS ms, event_id % 20 AS run FROM events"
SUMMARY = f"""SELECT scenario, engine, count(*) AS runs, min(ms) AS min_ms, quantile_cont(ms, 0.5) AS median_ms, avg(ms) AS mean_ms, quantile_cont(ms, 0.95) AS p95_ms,
  max(ms) AS max_ms, coalesce(stddev_samp(ms), 0) AS stdev_ms, 1000 / avg(ms) AS qps FROM ({RUNS}) WHERE run >= 3 GROUP BY ALL"""

SQL = {
    "agg04_hourly_keyword_rollup": f"SELECT publish_date, publish_hour, keyword, category, source, count(*) AS mention_count FROM ({KE}) GROUP BY ALL",
    "agg05_daily_keyword_rollup": DAILY,
    "agg06_daily_entity_rollup": f"SELECT publish_date, entity_text, entity_type, category, count(*) AS mention_count FROM ({EE}) GROUP BY ALL",
    "agg07_merged_rollup": DAILY,
    "agg08_top_keywords": f"WITH d AS ({DAILY}) SELECT keyword, sum(mention_count)::BIGINT AS total FROM d WHERE publish_date >= (SELECT max(publish_date) FROM d) - 7 GROUP BY 1 ORDER BY total DESC, keyword LIMIT 20",
    "agg08_top_keywords_category": f"WITH d AS ({DAILY}) SELECT keyword, sum(mention_count)::BIGINT AS total FROM d WHERE publish_date >= (SELECT max(publish_date) FROM d) - 14 AND category = '1' GROUP BY 1 ORDER BY total DESC, keyword LIMIT 10",
    "agg09_hot_keywords": HOT,
    "agg09_hot_keywords_joined": HOT,
    "agg10_hourly_filled": f"""WITH e AS ({KE}), c AS (SELECT publish_hour, count(*) AS n FROM e WHERE publish_date >= (SELECT max(publish_date) FROM e) - 30 GROUP BY 1)
SELECT r.hour, coalesce(n, 0) AS count FROM range(24) r(hour) LEFT JOIN c ON publish_hour = r.hour""",
    "agg11_top_entities": f"WITH e AS ({EE}) SELECT entity_text, count(*) AS total FROM e WHERE entity_type = 'click' AND publish_date >= (SELECT max(publish_date) FROM e) - 7 GROUP BY 1 ORDER BY total DESC, entity_text LIMIT 20",
    "agg12_timeline": f"WITH e AS ({KE}) SELECT publish_date, count(*) AS count FROM e WHERE publish_date >= (SELECT max(publish_date) FROM e) - 30 GROUP BY 1",
    "agg12_orders_timeline": "SELECT o_orderdate::DATE AS publish_date, count(*) AS count FROM orders WHERE o_orderstatus = 'F' AND o_orderdate::DATE >= (SELECT max(o_orderdate)::DATE FROM orders) - 365 GROUP BY 1",
    "agg13_cross_source": f"""WITH e AS ({KE}) SELECT keyword, count(DISTINCT source) AS source_count, count(*) AS total_mentions FROM e WHERE publish_date >= (SELECT max(publish_date) FROM e) - 7
GROUP BY 1 HAVING count(DISTINCT source) >= 3 ORDER BY source_count DESC, total_mentions DESC, keyword LIMIT 20""",
    "agg14_sources": "SELECT source, count(*) AS count FROM documents GROUP BY 1",
    "agg14_categories": "SELECT lang AS category, count(*) AS count FROM documents GROUP BY 1",
    "agg15_admin_stats": f"""SELECT count(*) AS articles_full, count(*) FILTER (is_canonical) AS articles_public, count(*) FILTER (NOT is_canonical) AS hidden,
  (SELECT count(*) FROM events) AS keyword_events, (SELECT count(*) FROM events) AS entity_events FROM ({DUP})""",
    "win1_near_dup": f"SELECT id, dup_group_id, is_canonical, dup_count FROM ({DUP}) WHERE content_length >= 200",
    "agg03_group_stats": f"SELECT count(DISTINCT nullif(dup_group_id, '')) AS dup_groups, count(*) FILTER (dup_group_id <> '' AND NOT is_canonical) AS dup_records FROM ({DUP})",
    "agg01_first_wins": "SELECT md5(text) AS key, min(doc_id) AS id, arg_min(source, doc_id) AS source FROM documents GROUP BY 1",
    "snk4_last_wins": "SELECT md5(text) AS key, max(doc_id) AS id, arg_max(source, doc_id) AS source FROM documents GROUP BY 1",
    "agg02_merge_fold": f"""WITH r AS (SELECT md5(title) AS key, list({{'id': id, 'n': content_length, 'k': [source, category, (id % 5)::VARCHAR]}} ORDER BY id % 2, id) AS rows FROM ({ART}) GROUP BY 1),
f AS (SELECT key, list_reduce(rows, lambda a, x: CASE WHEN x.n > a.n THEN {{'id': x.id, 'n': x.n, 'k': list_concat(x.k, a.k)}} ELSE {{'id': a.id, 'n': a.n, 'k': list_concat(a.k, x.k)}} END) AS w FROM r),
u AS (SELECT key, w.id AS id, w.n AS n, w.k AS k FROM f)
SELECT key, id, n::INTEGER AS content_length, n >= 500 AS has_full_content, array_to_string(list_filter(k, lambda v, i: list_position(k, v) = i), '|') AS keywords FROM u""",
    "jon3_not_yet_done": "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "snk2_append_if_absent": """SELECT md5(text) AS key, min(doc_id) AS id FROM documents WHERE doc_id % 2 = 1
  AND text NOT IN (SELECT text FROM documents WHERE doc_id % 2 = 0) GROUP BY 1""",
    "jon6_category_lookup": """WITH m(pos, k, v) AS (VALUES (1, 'bolt', 'metal'), (2, 'gear', 'metal'), (3, 'ring', 'round'), (4, 'wheel', 'round'), (5, 'red', 'colour'), (6, 'blue w', 'colour'), (7, 'widget', 'tool')),
f AS (SELECT name, arg_min(v, (name <> k, pos)) AS label FROM (SELECT DISTINCT lower(trim(p_name)) AS name FROM part) CROSS JOIN m WHERE contains(name, k) OR contains(k, name) GROUP BY 1)
SELECT p_partkey, p_name, coalesce(label, 'other') AS label FROM part LEFT JOIN f ON name = lower(trim(p_name))""",
    "fn01_url_identity": f"""SELECT page_id, {NORMAL_URL} AS normalized, md5({NORMAL_URL}) AS id
FROM (SELECT page_id, bare, {URL.format(3).replace("(url,", "(bare,")} AS p FROM (SELECT page_id, split_part(trim(url), '#', 1) AS bare FROM pages))""",
    "fn02_domain_source": f"""SELECT page_id, host AS domain, CASE WHEN host LIKE '%example.com' THEN 'com-site' WHEN host LIKE '%example.net' THEN 'net-site' ELSE host END AS source
FROM (SELECT page_id, replace(lower({URL.format(2)}), 'www.', '') AS host FROM pages)""",
    "fn09_url_category": rf"""WITH p AS (SELECT page_id, list_filter(string_split({URL.format(3)}, '/'), lambda x: x <> '') AS parts FROM pages),
k AS (SELECT page_id, parts, list_filter(list_transform(parts[1:2], lambda x: regexp_replace(x, '-[0-9]+$', '')), lambda x: contains(x, 'en') OR contains('en', x) OR contains(x, 'fr') OR contains('fr', x)) AS known FROM p)
SELECT page_id, coalesce(known[1], parts[1], '') AS category FROM k""",
    "src9_page_urls": r"""SELECT page_id, CASE page_id % 3 + 1 WHEN 1 THEN url ELSE
  CASE WHEN regexp_matches(url, '\.html?$') THEN regexp_replace(url, '\.html?$', '') ELSE rtrim(url, '/') END || '/trang-' || (page_id % 3 + 1) || '.htm' END AS page_url FROM pages""",
    "flt17_article_links": rf"""WITH h AS (SELECT page_id, url, {URL.format(1)} AS scheme, {URL.format(2)} AS host, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["'']', 1)) AS href FROM pages),
r AS (SELECT page_id, url, split_part(CASE WHEN regexp_matches(trim(href), '^[a-zA-Z][a-zA-Z0-9+.\-]*:') THEN trim(href) ELSE scheme || '://' || host || trim(href) END, '?', 1) AS whole, host FROM h WHERE trim(href) <> '')
SELECT DISTINCT page_id, split_part(whole, '#', 1) AS link FROM r
WHERE replace(lower(regexp_extract(whole, '^[a-z]+://([^/?#]*)', 1)), 'www.', '') = replace(lower(host), 'www.', '') AND regexp_matches(whole, '/[a-z]+$')""",
    "fn06_time_fields": """SELECT event_id, (ts + INTERVAL 7 HOUR)::DATE AS publish_date, hour(ts + INTERVAL 7 HOUR)::INTEGER AS publish_hour, (isodow(ts + INTERVAL 7 HOUR) - 1)::INTEGER AS publish_dow,
  strftime(time_bucket(INTERVAL 4 HOUR, ts), '%Y-%m-%dT%H') AS bucket FROM events""",
    "fn04_parse_times": """SELECT event_id, CASE event_id % 10 WHEN 2 THEN epoch(date_trunc('second', ts)) WHEN 3 THEN epoch(date_trunc('second', ts)) WHEN 6 THEN epoch(date_trunc('minute', ts)) - 25200
  WHEN 7 THEN epoch(date_trunc('day', ts)) - 25200 WHEN 8 THEN epoch(date_trunc('minute', ts)) - 25200 WHEN 9 THEN NULL ELSE epoch(date_trunc('second', ts)) - 25200 END::BIGINT AS epoch FROM events""",
    "fn03_source_names": f"""WITH h AS (SELECT doc_id, [k, 'm.' || k, k || '.example', 'x' || k][doc_id % 4 + 1] AS host FROM (SELECT doc_id, {one_of(list(V.SOURCES), "doc_id")} AS k FROM documents))
SELECT doc_id, host, coalesce(({listed(V.SOURCES.values())})[list_filter(range(1, {len(V.SOURCES) + 1}), lambda i: ends_with(host, ({listed(V.SOURCES)})[i]))[1]], host) AS source FROM h""",
    "fn09_url_category_maps": f"""WITH p AS (SELECT doc_id, string_split([k || '/a.html', 'zzqq/' || k || '-123/b', k || '-99', 'zzqq/qqzz/c', ''][doc_id % 5 + 1], '/') AS parts FROM (
  SELECT doc_id, {one_of([k for v in V.CATEGORY_GROUPS.values() for k in v if " " not in k], "doc_id")} AS k FROM documents)),
k AS (SELECT doc_id, parts, list_filter(list_transform(parts[1:2], lambda x: regexp_replace(x, '-[0-9]+$', '')), lambda x: len(list_filter({listed(k for v in V.CATEGORY_GROUPS.values() for k in v)}, lambda c: contains(x, c) OR contains(c, x))) > 0 AND x <> '') AS known FROM p)
SELECT doc_id, coalesce(known[1], parts[1], '') AS category FROM k""",
    "fn12_word_count": r"SELECT doc_id, len(list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')) AS words FROM documents",
    "fn11_title_key": f"SELECT id, {KEY} AS title_key, md5({KEY})[1:12] AS title_hash FROM ({ART})",
    "fn10_author": "SELECT doc_id, CASE WHEN doc_id % 3 < 2 THEN '' ELSE 'A ' || lang END AS author FROM documents",
    "fn18_keyword_split": "SELECT doc_id, lang || '|' || source AS keywords FROM documents",
    "fn14_reject_flags": FLAGS,
    "fn15_clean_entities": CLEAN,
    "fn16_clean_keywords": KEPT_KEYWORDS,
    "fn17_ordered_dedup": f"""WITH w AS (SELECT id, string_split(title, ' ') AS words FROM ({ART})), n AS (SELECT id, words[i] AS word, i, row_number() OVER (PARTITION BY id, lower(words[i]) ORDER BY i) AS k FROM (SELECT id, words, unnest(range(1, len(words) + 1)) AS i FROM w))
SELECT id, string_agg(word, '|' ORDER BY i) AS words FROM n WHERE k = 1 GROUP BY 1""",
    "fn19_person_name": rf"""SELECT id, len(ws) BETWEEN 2 AND 5 AND len(list_filter(ws, lambda w: NOT regexp_matches(w, '^\p{{Lu}}') OR regexp_matches(w, '[0-9/@#_]'))) = 0 AS is_name
FROM (SELECT id, list_filter(string_split(title, ' ')[1:(id % 6 + 1)], lambda w: w <> '') AS ws FROM ({ART}))""",
    "fn30_entity_arrays": f"SELECT id, array_to_string(list_transform(entities, lambda e: e.text), '|') AS texts, array_to_string(list_transform(entities, lambda e: e.type), '|') AS types FROM ({ART})",
    "fn31_keyword_events": rf"""SELECT id AS article_id, unnest(ks) AS keyword, publish_date, coalesce(publish_hour, 0) AS publish_hour, source, category FROM (
  SELECT *, list_transform(list_sort(list_transform(list_distinct(ts), lambda t: {{'p': list_position(ts, t), 't': t}})), lambda x: x.t)[1:3] AS ks FROM (
    SELECT *, list_filter(string_split_regex(lower(title), '[^\p{{L}}\p{{N}}_]+'), lambda t: t <> '') AS ts FROM ({ART})))""",
    "fn31_entity_events": f"SELECT article_id, e.text AS entity_text, e.type AS entity_type, publish_date, source, category FROM (SELECT id AS article_id, unnest(entities) AS e, publish_date, source, category FROM ({ART}))",
    "flt01_validity": f"""SELECT id, CASE WHEN trim(title) = '' THEN 'empty_title' WHEN id % 7 = 0 THEN 'no_published_at' WHEN content_length < 300 THEN 'content_too_short(' || content_length || ')' END AS reason FROM ({ART})""",
    "agg16_profile": "SELECT source AS value, count(*) AS n, 100 * count(*) / (SELECT count(*) FROM documents) AS share FROM documents GROUP BY 1",
    "agg17_length_profile": """WITH l AS (SELECT length(text) AS v, row_number() OVER (ORDER BY length(text)) - 1 AS i, count(*) OVER () AS n FROM documents)
SELECT sum(v) / count(*) AS mean, min(v) FILTER (i = n // 2) AS p50, min(v) FILTER (i = floor(n * 0.95)::BIGINT) AS p95, min(v) AS shortest, max(v) AS longest, count(*) AS n FROM l""",
    "agg18_presence": rf"""SELECT count(DISTINCT nullif(dup_group_id, '')) AS dup_groups, count(*) FILTER (is_canonical) AS canonical, count(*) FILTER (author <> '') AS with_author,
  count(*) FILTER (k > 0) AS with_keywords, sum(k)::BIGINT AS keywords, count(*) FILTER (len(entities) > 0) AS with_entities, sum(len(entities))::BIGINT AS entities
FROM (SELECT *, least(3, len(list_distinct(list_filter(string_split_regex(lower(title), '[^\p{{L}}\p{{N}}_]+'), lambda t: t <> '')))) AS k FROM ({DUP}))""",
    "agg19_top_by_type": f"""SELECT * FROM (SELECT entity_type, entity_text, count(*) AS n, row_number() OVER (PARTITION BY entity_type ORDER BY count(*) DESC, entity_text)::INTEGER AS place FROM ({EE}) GROUP BY 1, 2) WHERE place <= 5""",
    "agg20_date_range": "SELECT min(ts)::DATE AS first, max(ts)::DATE AS last FROM documents JOIN events ON doc_id = event_id",
    "agg21_clean_changes": f"""WITH b AS (SELECT CASE WHEN form % 2 = 0 THEN 'ORG' ELSE 'PER' END AS entity_type, count(*) AS n_before FROM ({PHRASES}) GROUP BY 1),
a AS (SELECT CASE WHEN type = 'ORG' AND form % 2 = 1 THEN 'PER' ELSE type END AS entity_type, count(*) AS n_after FROM ({CLEAN}) GROUP BY 1)
SELECT entity_type, coalesce(n_before, 0) AS n_before, coalesce(n_after, 0) AS n_after, coalesce(n_after, 0) - coalesce(n_before, 0) AS delta,
  CASE WHEN n_before > 0 THEN 100 * (n_before - coalesce(n_after, 0)) / n_before ELSE 0.0 END AS reduction FROM b FULL JOIN a USING (entity_type)""",
    "flt05_guest_view": f"SELECT id, title, source, category, dup_count FROM ({DUP}) WHERE is_canonical",
    "flt12_like": f"SELECT id FROM ({ART}) WHERE title LIKE '%the and%' OR content LIKE '%the and%'",
    "flt13_ilike": f"SELECT id FROM ({ART}) WHERE title ILIKE '%THE%' OR content ILIKE '%THE%'",
    "flt14_entity_search": f"SELECT id, title FROM ({ART}) WHERE list_contains(entities, {{'text': 'The', 'type': 'PER'}})",
    "sch2_all_tokens": f"SELECT id FROM (SELECT id, {TOKENS} AS t FROM ({ART})) WHERE list_contains(t, 'the') AND list_contains(t, 'of')",
    "sch1_bm25": rf"""WITH f AS (SELECT id, 'title' AS field, 3.0 AS boost, string_split_regex(lower(title), '[^\p{{L}}\p{{N}}_]+') AS t FROM ({ART}) UNION ALL SELECT id, 'content', 1.0, string_split_regex(lower(content), '[^\p{{L}}\p{{N}}_]+') FROM ({ART})),
g AS (SELECT id, field, boost, list_filter(t, lambda x: x <> '') AS t FROM f),
n AS (SELECT field, count(*) FILTER (len(t) > 0) AS n, avg(len(t)) FILTER (len(t) > 0) AS mean FROM g GROUP BY 1),
c AS (SELECT id, field, boost, len(t) AS l, q, len(list_filter(t, lambda x: x = q)) AS tf FROM g, (VALUES ('the'), ('idiot')) v(q)),
df AS (SELECT field, q, count(*) FILTER (tf > 0) AS df FROM c GROUP BY ALL),
s AS (SELECT id, field, boost * sum(CASE WHEN tf > 0 THEN ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * l / mean)) ELSE 0 END) AS score, sum(tf) AS hits FROM c JOIN df USING (field, q) JOIN n USING (field) GROUP BY id, field, boost)
SELECT id, round(max(score), 6) AS score FROM s GROUP BY id HAVING sum(hits) > 0""",
    "sch5_by_entity": f"SELECT id, publish_date FROM ({DUP}) WHERE is_canonical AND category = 'en' AND list_contains(entities, {{'text': 'The', 'type': 'PER'}}) ORDER BY publish_date DESC, id LIMIT 50",
    "sch6_entity_and_text": rf"""SELECT id FROM ({ART}) WHERE list_contains(entities, {{'text': 'The', 'type': 'PER'}})
  AND list_has_any(string_split_regex(lower(content), '[^\p{{L}}\p{{N}}_]+'), ['idiot', 'moron'])""",
    "sch7_article": f"SELECT id, title, source, url FROM ({ART}) WHERE id = 17",
    "agg22_latency_summary": f"SELECT scenario, engine, runs, min_ms, max_ms, round(median_ms, 6) AS median_ms, round(mean_ms, 6) AS mean_ms, round(p95_ms, 6) AS p95_ms, round(stdev_ms, 6) AS stdev_ms, round(qps, 6) AS qps FROM ({SUMMARY})",
    "agg23_engine_ranking": f"SELECT engine, round(quantile_cont(median_ms, 0.5), 6) AS median_of_medians, count(*) AS cases FROM ({SUMMARY}) GROUP BY 1",
    "agg24_speed_up": f"""SELECT scenario, engine, round(median_ms / min(median_ms) OVER w, 6) AS times_fastest, round((min(median_ms) FILTER (starts_with(engine, 'beta')) OVER w) / median_ms, 6) AS speed_up FROM ({SUMMARY}) WINDOW w AS (PARTITION BY scenario)""",
    "agg25_storage_totals": "SELECT o_orderpriority AS engine, sum(o_orderkey)::BIGINT AS data_size, sum(o_orderkey % 7)::BIGINT AS index_size, sum(o_custkey)::BIGINT AS disk_size, sum(o_custkey) / 1000.0::DOUBLE AS times_raw FROM orders GROUP BY 1",
    "str1_stream_rollup": f"SELECT publish_date, publish_hour, keyword, category, source, count(*) AS mention_count FROM ({KE}) GROUP BY ALL",
    "str2_buckets": "SELECT strftime(time_bucket(INTERVAL 4 HOUR, ts), '%Y-%m-%dT%H') AS bucket, count(*) AS n FROM events GROUP BY 1",
    "str3_append_new": f"SELECT DISTINCT keyword || '/' || category AS key FROM ({KE})",
    "str7_circuit_breaker": """WITH r AS (SELECT *, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS run FROM events)
SELECT event_id, coalesce(count(*) FILTER (event_type <> 'purchase') OVER (PARTITION BY user_id, coalesce(run, 0) ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) >= 6 AS blocked FROM r""",
    "str1_compacted_rollup": f"SELECT publish_date, publish_hour, keyword, category, source, count(*) AS mention_count FROM ({KE}) GROUP BY ALL",
    "str2_streamed_buckets": "SELECT strftime(time_bucket(INTERVAL 4 HOUR, ts), '%Y-%m-%dT%H') AS bucket, count(*) AS n FROM events GROUP BY 1",
    "fn08_category_maps": f"""WITH r AS (SELECT doc_id, [k, ' ' || upper(k), 'x/' || k || '-y', k[1:4], source, ''][doc_id % 6 + 1] AS raw FROM (
  SELECT doc_id, source, {one_of(sorted({k for g in (V.CATEGORY_GROUPS, V.CATEGORY_GROUPS_EXTENDED) for v in g.values() for k in v}), "doc_id")} AS k FROM documents))
SELECT doc_id, raw, {mapped("raw", V.CATEGORY_GROUPS)} AS base, {mapped("raw", V.CATEGORY_GROUPS_EXTENDED)} AS extended FROM r""",
    "fn07_clean_content": rf"""WITH t AS (SELECT id, trim(regexp_replace(title, '\s+', ' ', 'g')) AS title, title AS raw FROM ({ART}))
SELECT id, trim(regexp_replace(title || ' <b> "éệ"', '\s+', ' ', 'g')) AS cleaned FROM t""",
    "tok1_folded_tokens": rf"""SELECT id, array_to_string(list_filter(string_split_regex(replace(strip_accents(lower('Đường Nguyễn Ê-kíp, ' || title)), 'đ', 'd'), '[^\p{{L}}\p{{N}}_]+'), lambda t: t <> ''), '|') AS tokens FROM ({ART})""",
    "flt04_search_documents": f"SELECT id, title, url, has_full_content, '{'|'.join(SEARCH_FIELDS)}' AS fields, NULL::VARCHAR AS word_count FROM ({ART})",
    "flt08_date_range": f"SELECT id, publish_date FROM ({ART}) WHERE category = 'en' AND publish_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-02'",
    "flt11_exists": f"SELECT count(title) AS title, count(event_time) AS event_time, count(publish_date) AS publish_date, count(source) AS source FROM ({ART})",
    "win2_time_order": f"SELECT id, strftime(event_time, '%Y-%m-%dT%H:%M:%S') AS published_at FROM ({ART})",
    "src2_jsonl_round_trip": f"SELECT id, title, md5(content) AS content, source FROM ({ART})",
    "src4_file_order": f"SELECT title, coalesce(max(id) FILTER (id % 2 = 1), max(id)) AS id FROM ({ART}) WHERE title <> '' GROUP BY 1",
    "src6_legacy_csv": """WITH r AS (SELECT doc_id, 'https://vnexpress.net/the-thao/' || doc_id AS url, 4 * (doc_id % 97) - 1 AS n FROM documents WHERE doc_id % 11 <> 0)
SELECT md5(url) AS id, url, 'T "q", ' || doc_id AS title, '2024-01-01T00:00:00+00:00' AS published_at, CASE WHEN doc_id % 3 = 0 THEN 'Le Van A' ELSE '' END AS author, 'vnexpress' AS source,
  CASE WHEN doc_id % 5 = 0 THEN 'the-thao' ELSE 'du-lich' END AS category_raw, CASE WHEN doc_id % 5 = 0 THEN 'sports' ELSE 'travel' END AS category_normalized, n::INTEGER AS content_length, 'k1|k2' AS keywords
FROM r WHERE n >= 300""",
    "src7_rss": """WITH r AS (SELECT doc_id, 'https://dantri.com.vn/suc-khoe/' || doc_id || '?utm_source=x' AS url, 4 * (doc_id % 60) - 1 AS n FROM documents WHERE doc_id % 4 IN (1, 2))
SELECT md5(url) AS id, url, 'T ' || doc_id AS title, CASE WHEN doc_id % 4 = 1 THEN '2024-01-01T20:00:00+00:00' ELSE '2024-01-01T19:00:00+00:00' END AS published_at, 'dantri' AS source,
  'suc-khoe' AS category_raw, 'health' AS category_normalized, n::INTEGER AS content_length, 'k' AS keywords FROM r WHERE n >= 100""",
    "snk7_repeated_keys": "SELECT md5(text) AS key, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1",
    "load_tables": f"""WITH a AS ({ART}), k AS ({ARTICLE_KEYWORDS}), e AS (SELECT publish_date, unnest(entities) AS e FROM a),
t AS (SELECT 'articles' AS "table", publish_date FROM a UNION ALL SELECT 'keyword_events', publish_date FROM k UNION ALL SELECT 'entity_events', publish_date FROM e)
SELECT "table", coalesce(year(publish_date) * 100 + month(publish_date), 0)::INTEGER AS ym, count(*) AS n FROM t GROUP BY ALL""",
    "load_rollups": f"SELECT publish_date, keyword, category, count(*) AS mention_count FROM ({ARTICLE_KEYWORDS}) GROUP BY ALL",
    "etl_daily_run": f"""WITH c AS (SELECT md5(text) AS id, doc_id, source, doc_id % 200 + 1 AS k FROM documents),
b AS (SELECT id, arg_max(source, (k, -doc_id)) AS source, max(k) AS k FROM c GROUP BY id HAVING 4 * max(k) >= {V.MIN_LENGTH_RSS}),
g AS (SELECT *, 4 * k - 1 AS n, count(*) OVER (PARTITION BY source) AS dup_count, row_number() OVER (PARTITION BY source ORDER BY 4 * k - 1 >= 500 DESC, k DESC, id) = 1 AS is_canonical FROM b)
SELECT id, n::INTEGER AS content_length, n >= 500 AS has_full_content, 'sports' AS category_normalized, '' AS author, DATE '2024-01-02' AS publish_date, 3 AS publish_hour, (2 * k)::INTEGER AS word_count,
  is_canonical, dup_count, 'k1' AS keywords, 'x y/LOC' AS entities FROM g WHERE n >= {V.MIN_LENGTH_CLEAN}""",
    "agg20_most_active_dates": f"SELECT publish_date, count(*) AS n FROM ({ART}) WHERE publish_date IS NOT NULL GROUP BY 1 ORDER BY n DESC, publish_date LIMIT 5",
    "agg21_cleaning_totals": f"""WITH n AS (SELECT (SELECT count(DISTINCT id) FROM ({PHRASES})) AS articles, (SELECT count(*) FROM ({PHRASES})) AS b, (SELECT count(*) FROM ({KEPT_KEYWORDS})) AS a)
SELECT articles AS articles_before, articles AS articles_after, 0::BIGINT AS entities_before, 0::BIGINT AS entities_after, b AS keywords_before, a AS keywords_after, 0.0::DOUBLE AS entities_reduction,
  0.0::DOUBLE AS entities_per_article, 100 * (b - a) / b AS keywords_reduction, a / articles AS keywords_per_article FROM n""",
    "agg21_rejected_keywords": f"""SELECT lower(text) AS keyword, count(*) AS n FROM ({FLAGS}) WHERE list_contains({listed(V.CATEGORY_KEYWORDS)}, lower(text)) GROUP BY 1 ORDER BY n DESC, keyword LIMIT 10""",
}

SQL["sch1_bm25_indexed"] = SQL["sch1_bm25"]
SQL["sch1_guest_indexed"] = f"""WITH s AS ({SQL["sch1_bm25"]})
SELECT id, title, md5(content) AS content, score FROM s JOIN (SELECT id, title, content FROM ({DUP}) WHERE is_canonical AND category = 'en' AND publish_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-02') USING (id)
ORDER BY score DESC, id LIMIT 50"""
SQL["agg17_length_percentiles"] = """SELECT source, round(quantile_cont(length(text), 0.1), 6) AS p10, round(quantile_cont(length(text), 0.5), 6) AS median, round(quantile_cont(length(text), 0.95), 6) AS p95,
  round(quantile_cont(length(text), 0.999), 6) AS p999 FROM documents GROUP BY 1"""
SQL["sch2_all_tokens_indexed"] = SQL["sch2_all_tokens"]
SQL["sch3_token_count"] = f"SELECT count(*) AS n FROM (SELECT {TOKENS} AS t FROM ({ART})) WHERE list_contains(t, 'the') AND list_contains(t, 'and') AND list_contains(t, 'of')"
SQL["flt12_like_indexed"] = SQL["flt12_like"]
SQL["flt13_ilike_indexed"] = f"SELECT id FROM ({ART}) WHERE title ILIKE '%THE%reth_%' OR content ILIKE '%THE%reth_%'"
LOADS = f"SELECT md5(content) AS id, id AS n, title, source, publish_date, n % 3 <> 0 AS early, n % 2 = 0 OR n % 3 = 0 AS late FROM ({ART})"
SQL["snk4_stored_upsert"] = f"""WITH r AS ({LOADS}), e AS (SELECT id, n, title, source, publish_date, 1 AS load FROM r WHERE early UNION ALL SELECT id, n, title, 'again-' || source, publish_date, 2 FROM r WHERE late)
SELECT id, n, title, source, publish_date FROM e QUALIFY row_number() OVER (PARTITION BY id ORDER BY load DESC, n DESC) = 1"""
SQL["snk8_stored_inserts"] = f"""WITH r AS ({LOADS}), e AS (SELECT id, n, title, source, publish_date, 1 AS load FROM r WHERE early UNION ALL SELECT id, n, title, 'again-' || source, publish_date, 2 FROM r WHERE late)
SELECT id, n, title, source, publish_date FROM e QUALIFY row_number() OVER (PARTITION BY id ORDER BY load, n) = 1"""
SQL["src7_feed_source"] = rf"""WITH a AS (SELECT *, trim(regexp_replace(regexp_replace(content, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM ({ART}) WHERE event_time IS NOT NULL)
SELECT 'https://dantri.com.vn/suc-khoe/' || id AS url, trim(title) AS title, strftime(event_time, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS published_at, 'health' AS category_normalized, md5(text) AS content,
  length(text)::INTEGER AS content_length FROM a WHERE (event_time + INTERVAL 7 HOUR)::DATE >= DATE '2024-01-02' AND length(text) >= {V.MIN_LENGTH_RSS} AND trim(title) <> ''"""
SQL["fn25_planted_bodies"] = r"""WITH l AS (SELECT doc_id, i, trim(regexp_replace(line, '\s+', ' ', 'g')) AS line, length(trim(line, ' ')) >= 25 AS long
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)),
c AS (SELECT doc_id, string_agg(line, ' ' ORDER BY i) FILTER (length(line) > 10) AS content FROM l GROUP BY 1 HAVING bool_or(long))
SELECT doc_id, md5(content) AS content, length(content)::INTEGER AS content_length, 'page' AS content_from FROM c"""
SQL["str2_late_buckets"] = f"""WITH e AS ({KE}), s AS (SELECT *, min(event_time) OVER () + (max(event_time) OVER () - min(event_time) OVER ()) / 4 AS quarter FROM e),
l AS (SELECT *, article_id % 50 = 0 AND event_time < quarter AS late FROM s)
SELECT strftime(time_bucket(INTERVAL 4 HOUR, event_time), '%Y-%m-%dT%H') AS bucket, count(*) AS n, (SELECT count(*) FROM l WHERE late) AS dropped FROM l WHERE NOT late GROUP BY 1"""
SQL["str3_first_seen"] = SQL["str3_append_new"]
SQL["snk6_bucketed_join"] = f"""WITH c AS (SELECT article_id, count(*) AS mentions, min(publish_hour)::INTEGER AS first_hour FROM ({KE}) GROUP BY 1)
SELECT id, source AS site, mentions, first_hour FROM ({ART}) JOIN c ON id = article_id"""
