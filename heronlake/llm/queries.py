"""The operators' queries over the whole tables, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heronlake.llm.support import table, words_in, written


def _tokenizer(name: str) -> str:
    # Only three operators need the vocabularies; the others work without them.
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm.simhash import simhash_groups

    groups = simhash_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.selectExpr("id AS doc_id", "fingerprint", "component_id")


def op2_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm.embed_dedup import embedding_groups

    return embedding_groups(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm.token_store import token_round_trip

    stored = token_round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), _tokenizer("byte_bpe_50k.json"))
    return stored.selectExpr("id AS doc_id", "start", "n_tokens", "crc32(ids) AS ids_crc32")


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm.mixing import mix_sources

    # Every text is cut into words once; the mix needs no more of it than their number.
    sized = written(table(spark, sf_dir, "documents").select("doc_id", "source", words_in("text").alias("size")), "mix-documents")
    return mix_sources(sized, text=None).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm.url_filter import filter_urls

    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm.exact_dedup import mark_repeats, text_digest

    docs = table(spark, sf_dir, "documents")
    prints = written(docs.select("doc_id", text_digest().alias("text_sha256")), "text-digests")
    return mark_repeats(prints, prints=prints).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm.toxicity import held_out, score_texts, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scorer = train(docs, table(spark, sf_dir, "labels"))
    return score_texts(docs, scorer, keep=["doc_id"]).select("doc_id", held_out().alias("held_out"), "score").selectExpr("*", "cast(score >= 0.7 as int) AS predicted")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm.bpe import encode_texts

    coded = encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), _tokenizer("word_bpe_49k.json"))
    return coded.selectExpr("doc_id", "cast(octet_length(ids) div 4 as bigint) AS n_tokens", "sha2(ids, 256) AS ids_sha256", "sha2(cast(decoded as binary), 256) AS decoded_sha256")


def op9_long_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm.long_matches import long_matches

    cut = long_matches(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = "aggregate(spans, 0L, (n, s) -> n + s.end - s.start)"
    return cut.selectExpr("id AS doc_id", "n_bytes", f"{removed} AS n_removed", "cast(size(spans) as bigint) AS n_spans", "sha2(kept, 256) AS kept_sha256")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm.warc import archive_round_trip

    captures = archive_round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return captures.selectExpr("page_id", "response.payload_bytes AS payload_bytes", "response.payload_digest AS payload_digest", "response.type AS record_type", "refers_to")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm.filter_audit import filter_audit

    return filter_audit(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), table(spark, sf_dir, "labels"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm.decontamination import contaminated_spans

    found = contaminated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")
    return found.select(
        F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm.token_alignment import align_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made, _ = align_tokenizers(docs, _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"), digest=True)
    return made.withColumnsRenamed({"id": "doc_id", "groups": "groups_sha256"})


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_simhash, op2_embedding_groups, op3_token_store, op4_source_mix, op5_url_rules, op6_exact_dedup, op7_toxicity, op8_bpe, op9_long_matches, op10_warc, op11_filter_audit, op12_decontamination, op13_token_alignment, pipeline)}

SQL = {
    "op2_embedding_groups": """
WITH RECURSIVE unit AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a),
comp AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
deg AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT c.vec_id, coalesce(d.n_links, 0) AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM comp c LEFT JOIN deg d USING (vec_id)""",
    "op5_url_rules": r"""
WITH split AS (
  SELECT page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
rules(h, p, action) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'block'),
                               ('example.net', '/de/8', 'allow'), ('org', '/es/', 'block')),
fits AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS action
  FROM split, rules WHERE ('.' || host) LIKE '%.' || h AND starts_with(path, p) GROUP BY page_id)
SELECT s.page_id, coalesce(s.host, '') AS host, coalesce(s.path, '') AS path, f.rule,
       coalesce(f.action, CASE WHEN regexp_matches('.' || s.host, '\.(spam-[^.]*|cheap-pills|casino-[^.]*|free-money)\.') THEN 'block' ELSE 'allow' END) AS verdict
FROM split s LEFT JOIN fits f USING (page_id)""",
    "op6_exact_dedup": """
WITH keyed AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) = 1 AS kept, text_sha256
FROM keyed""",
    "op9_long_matches": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
pieces AS (SELECT doc_id, k, substring(h, 1024 * k + 1, 1122) AS piece FROM (SELECT doc_id, h, unnest(range(0, length(h) // 1024 + 1)) AS k FROM d)),
w AS (SELECT doc_id, p, s FROM (SELECT doc_id, 512 * k + j AS p, substring(piece, 2 * j + 1, 100) AS s FROM (SELECT doc_id, k, piece, unnest(range(0, 512)) AS j FROM pieces)) WHERE length(s) = 100),
m AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
g AS (SELECT doc_id, p, lag(p) OVER o AS before, lead(p) OVER o AS next FROM w JOIN m USING (s) WHERE least < doc_id WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
edges AS (SELECT doc_id, p AS start, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS n FROM g WHERE before IS NULL OR p - before > 50),
stops AS (SELECT doc_id, p + 50 AS stop, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS n FROM g WHERE next IS NULL OR next - p > 50),
runs AS (SELECT doc_id, start, stop, n FROM edges JOIN stops USING (doc_id, n)),
kept AS (SELECT doc_id, coalesce(lag(stop) OVER o, 0) AS start, start AS stop FROM runs WINDOW o AS (PARTITION BY doc_id ORDER BY n)
  UNION ALL SELECT doc_id, coalesce(max(stop), 0), any_value(length(h)) // 2 FROM d LEFT JOIN runs USING (doc_id) GROUP BY doc_id),
rest AS (SELECT doc_id, string_agg(substring(h, 2 * kept.start + 1, 2 * (kept.stop - kept.start)), '' ORDER BY kept.start) AS r FROM kept JOIN d USING (doc_id) GROUP BY doc_id),
counts AS (SELECT doc_id, sum(stop - start)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(r)) AS kept_sha256
FROM d JOIN rest USING (doc_id) LEFT JOIN counts USING (doc_id)""",
    "op10_warc": """
WITH full_pages AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
ranked AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY h) ELSE page_id END AS first FROM full_pages)
SELECT page_id, payload_bytes, sha256(h) AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM ranked""",
    "op11_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
f AS (SELECT part, doc_id, [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
        regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails FROM w),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY 1),
m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
k AS (SELECT unnest(range(1, 6)) AS k),
o AS (SELECT [a.k, b.k, c.k, d.k, e.k] AS o FROM k a, k b, k c, k d, k e WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (SELECT o, unnest(range(1, 6)) AS step FROM o),
r AS (SELECT part, list_reduce(list_transform(o, lambda x: 'ABCDE'[x]), lambda x, y: x || y) AS filter_order, step::INTEGER AS step, o[step] AS filter,
        coalesce(len(list_filter(o[1:step - 1], lambda x: fails[x])), 0) AS before, fails[o[step]] AS failed, len(list_filter(fails, lambda x: x)) AS n_fails, n, good, toxic FROM s, m),
c AS (SELECT part, filter_order, step, filter, sum(CASE WHEN before = 0 AND NOT failed THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN before = 0 AND failed THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN before > 0 AND failed THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN failed AND n_fails = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN before = 0 AND failed THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN before = 0 AND failed THEN toxic ELSE 0 END)::BIGINT AS toxic_lost FROM r GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM c""",
    "op12_decontamination": r"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
of_items AS (SELECT DISTINCT item, least(len(w), 10) AS m, list_aggregate(w[p:p + least(len(w), 10) - 1], 'string_agg', ' ') AS s
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM of_items),
of_docs AS (SELECT doc_id, m, p, list_aggregate(w[p:p + m - 1], 'string_agg', ' ') AS s FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM words, sizes WHERE len(w) >= m)),
met AS (SELECT doc_id, p, m, item FROM of_docs JOIN of_items USING (m, s)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM met) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
}
