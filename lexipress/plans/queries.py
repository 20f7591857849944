"""Queries over whole tables, one or more for each operator, with the SQL of the same results."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import keys
from ..functions import text as T
from ..functions import vectors as V
from ..operators import classify, dedup, evaluation, ingest, labels, merge, retrieval, rules, stats, verdict
from .lineage import bounded_batches, spread
from .tables import OBJECTS, POSTS, RANKED, TRUTH, VERDICTS, Query, object_queries, old_verdicts, posts, ranked, table, truth, vectors

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Demo catalogs in Latin letters, for tables that hold no other.
OBJECT_PATTERNS = {1: r"license", 2: r"token\s*=", 3: r"tion\b"}
NEGATIVE_PATTERNS = {1: r"apache", 2: r"", 3: r"[%]{3}"}
BROAD = ("licen[sc]e", "version")
GOALS = {1: ["license", "version"], 2: ["token"], 3: []}


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _goals(spark):
    return spark.createDataFrame([(k, f"goal {k}", v) for k, v in GOALS.items()], "id_goal int, goal string, keywords array<string>")


# Scans and ingest


@query(f"WITH {POSTS} SELECT id_raw_post, time_post, title FROM posts WHERE CAST(time_post AS DATE) = DATE '2024-01-01'")
def day_slice(spark, sf):
    return ingest.day_slice(posts(spark, sf), "time_post", F.lit("2024-01-01").cast("date")).select("id_raw_post", "time_post", "title")


@query(f"WITH {POSTS} SELECT id_raw_post, md5(content) AS content_hash, coalesce(source, 'unknown_source') AS source_name FROM posts WHERE time_post >= TIMESTAMP '2024-01-01' AND time_post < TIMESTAMP '2024-01-02' AND trim(content) <> ''")
def mirrored_range(spark, sf):
    day = F.lit("2024-01-01").cast("date")
    return ingest.mirrored(posts(spark, sf).withColumn("metadata", F.lit(None).cast("string")), "time_post", day.cast("timestamp"), day).select("id_raw_post", "content_hash", "source_name")


@query("SELECT doc_id, source FROM documents WHERE doc_id > 100 ORDER BY doc_id LIMIT 50")
def keyset_page(spark, sf):
    return ingest.keyset_page(table(spark, sf, "documents").select("doc_id", "source"), "doc_id", 100, 50)


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id OFFSET 20 LIMIT 30")
def offset_page(spark, sf):
    return ingest.offset_page(table(spark, sf, "documents").select("doc_id", "n_chars"), [F.desc("n_chars"), F.col("doc_id")], 20, 30)


@query("SELECT doc_id, source FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 100")
def random_rows(spark, sf):
    return ingest.random_rows(table(spark, sf, "documents"), 100, "doc_id", 7).select("doc_id", "source")


@query("""SELECT CASE WHEN event_type IS NULL OR event_type = '' THEN 'no_url' WHEN props IS NULL OR props = '' THEN 'no_content'
WHEN try_cast(json_extract_string(props, '$.k') AS BIGINT) IS NULL THEN 'no_time_post' ELSE 'inserted' END AS status, count(*) AS n FROM events GROUP BY 1""")
def ingest_status(spark, sf):
    items = table(spark, sf, "events").select(F.col("event_type").alias("url"), F.col("props").alias("content"), F.get_json_object("props", "$.k").alias("created_at"))
    return ingest.status_counts(items)


@query("SELECT event_id, make_timestamp(CAST(json_extract_string(props, '$.k') AS BIGINT) * 1000000) AS time_post FROM events")
def ingest_accepted(spark, sf):
    items = table(spark, sf, "events").select("event_id", F.col("event_type").alias("url"), F.col("props").alias("content"), F.get_json_object("props", "$.k").alias("created_at"))
    return ingest.accepted(items).select("event_id", "time_post")


@query("SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def new_items(spark, sf):
    return ingest.new_items(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), ["doc_id"])


@query("SELECT lower(source) AS source_key, arg_min(source, doc_id) AS name_source, min(doc_id) AS first_seen, row_number() OVER (ORDER BY min(doc_id), lower(source)) AS id_source FROM documents GROUP BY 1")
def source_dimension(spark, sf):
    return ingest.sources(posts(spark, sf))


@query("WITH s AS (SELECT lower(source) AS k, row_number() OVER (ORDER BY min(doc_id), lower(source)) AS id_source FROM documents GROUP BY 1) SELECT d.doc_id AS id_raw_post, s.id_source FROM documents d LEFT JOIN s ON lower(d.source) = s.k")
def posts_with_source(spark, sf):
    p = posts(spark, sf)
    return ingest.with_source(p, ingest.sources(p)).select("id_raw_post", "id_source")


# Predicates and rules


@query(f"WITH {VERDICTS} SELECT id_raw_post FROM verdicts WHERE drop_reason IS NULL AND NOT is_duplicate")
def kept_rows(spark, sf):
    return old_verdicts(spark, sf).where(verdict.kept_rows()).select("id_raw_post")


@query(f"WITH {VERDICTS} SELECT id_raw_post, drop_reason FROM verdicts WHERE drop_reason LIKE 'junk:%'")
def junk_prefix(spark, sf):
    return old_verdicts(spark, sf).where(verdict.is_junk()).select("id_raw_post", "drop_reason")


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.doc_id IS NULL")
def pending(spark, sf):
    d, done = table(spark, sf, "documents"), table(spark, sf, "labels")
    return verdict.pending(d, done, "doc_id").select("doc_id")


@query("SELECT event_id FROM events WHERE json_exists(props, '$.k')")
def json_key(spark, sf):
    return table(spark, sf, "events").where(keys.has_json_key(F.col("props"), "k")).select("event_id")


@query("SELECT o_orderkey FROM orders WHERE o_custkey >= 10 AND o_custkey <= 500 AND o_totalprice >= 1000 AND o_orderstatus IN ('F', 'O')")
def optional_ranges(spark, sf):
    o = table(spark, sf, "orders")
    cond = rules.all_of([rules.between_optional(F.col("o_custkey"), 10, 500), rules.between_optional(F.col("o_totalprice"), 1000), F.col("o_orderstatus").isin("F", "O"), None])
    return o.where(cond).select("o_orderkey")


@query("SELECT doc_id AS id, contains(lower(text), 'license') OR contains(lower(text), 'token') AS hit FROM documents")
def any_keyword(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), rules.any_keyword(F.col("text"), F.array(F.lit("license"), F.lit("token"))).alias("hit"))


@query("SELECT CASE WHEN NOT (contains(lower(text), 'license') OR contains(lower(text), 'tion')) THEN 'keyword_miss' WHEN lower(source) NOT IN ('src1', 'src2') THEN 'source_type_miss' END AS drop_reason, count(*) AS n FROM documents GROUP BY 1")
def corpus_filter(spark, sf):
    return rules.corpus_filter(table(spark, sf, "documents"), "text", "source", ["License", "tion"], ["src1", "src2"]).groupBy("drop_reason").agg(F.count("*").alias("n"))


@query("SELECT doc_id AS id, list_filter([CASE WHEN regexp_matches(text, '(?i)license') THEN 1 END, CASE WHEN regexp_matches(text, '(?i)token\\s*=') THEN 2 END, CASE WHEN regexp_matches(text, '(?i)tion($|[^\\pL\\pN_])') THEN 3 END], lambda x: x IS NOT NULL)::VARCHAR AS tags FROM documents")
def pool_tags(spark, sf):
    t = rules.tags(F.col("text"), {1: "license", 2: r"token\s*=", 3: r"tion($|[^\p{L}\p{N}_])"})
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.concat(F.lit("["), F.array_join(t.cast("array<string>"), ", "), F.lit("]")).alias("tags"))


@query(f"""WITH {POSTS}, m AS (SELECT id_raw_post AS id, len(regexp_extract_all(title || chr(10) || content, '(?i)licen[sc]e|version')) + len(regexp_extract_all(title || chr(10) || content, '(?i)token')) AS topic_hits,
regexp_matches(title, '(?i)licen[sc]e|version|token') AS in_title,
CASE WHEN regexp_matches(content, '(?i)licen[sc]e|version') THEN length(regexp_extract(content, '(?is)^(.*?)(?:licen[sc]e|version)', 1)) WHEN regexp_matches(content, '(?i)token') THEN length(regexp_extract(content, '(?is)^(.*?)token', 1)) ELSE -1 END AS first_pos,
regexp_matches(title || chr(10) || content, '(?i)token') AS has_object FROM posts)
SELECT id, topic_hits, in_title, first_pos, has_object, first_pos >= 0 AND first_pos < 300 AS in_lead,
has_object OR in_title OR topic_hits >= 3 OR (first_pos >= 0 AND first_pos < 300 AND topic_hits >= 2) AS kept,
CASE WHEN topic_hits <= 1 THEN '1' WHEN topic_hits = 2 THEN '2' WHEN topic_hits <= 4 THEN '3-4' WHEN topic_hits <= 9 THEN '5-9' ELSE '10+' END AS hits_bucket FROM m""")
def triage(spark, sf):
    t = rules.triage(posts(spark, sf), "title", "content", BROAD, ("token",))
    return t.select(F.col("id_raw_post").alias("id"), "topic_hits", "in_title", "first_pos", "has_object", "in_lead", "kept", "hits_bucket")


@query("SELECT k.id_object, d.doc_id AS id FROM documents d CROSS JOIN (VALUES (1, '(?i)license'), (2, '(?i)token\\s*=')) k(id_object, p) WHERE regexp_matches(d.text, k.p)")
def regex_channel(spark, sf):
    return retrieval.regex_channel(table(spark, sf, "documents"), {1: "license", 2: r"token\s*=", 9: ""}, F.col("text"), "doc_id")


@query("SELECT 1 AS id_object, doc_id AS id FROM documents WHERE regexp_matches(text, '(?i)license') AND NOT regexp_matches(text, '(?i)apache')")
def regex_minus_negative(spark, sf):
    return retrieval.regex_channel(table(spark, sf, "documents"), {1: "license"}, F.col("text"), "doc_id", NEGATIVE_PATTERNS)


@query("SELECT l.doc_id FROM labels l WHERE l.doc_id IN (SELECT doc_id FROM documents WHERE source = 'src3')")
def universe(spark, sf):
    return table(spark, sf, "labels").join(table(spark, sf, "documents").where("source = 'src3'").select("doc_id"), "doc_id", "left_semi").select("doc_id")


@query("""WITH m AS (SELECT doc_id AS id, list_distinct(list_transform(regexp_extract_all(text, '(?i)(?:^|[^\\pL\\pN_])(idiot|moron|scum|pathetic)', 1), lambda x: lower(x))) AS t FROM documents)
SELECT id, len(t) AS n_terms FROM m WHERE len(t) >= 2""")
def junk_terms(spark, sf):
    t = rules.terms(F.col("text"), rules.FLAGS + r"(?<![\p{L}\p{N}_])(?:idiot|moron|scum|pathetic)")
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.size(t).alias("n_terms")).where("n_terms >= 2")


@query()
def junk_filter(spark, sf):
    p = posts(spark, sf)
    return rules.with_junk(p, "title", "content", rules.DEMO_RULES).withColumnRenamed("id_raw_post", "id").where("junk is not null").select("id", "junk.category", F.array_join("junk.matched_terms", "|").alias("terms"), "junk.title_match_count", "junk.body_match_count")


@query("""WITH k AS (SELECT * FROM (VALUES (1, 'source', 'src1', true), (1, 'source', 'src2', false), (2, 'source', 'src2', true)) v(id_goal, kind, key, include)),
g AS (SELECT unnest([1, 2, 3]) AS id_goal), m AS (SELECT d.doc_id AS id, k.id_goal, bool_or(NOT include) AS ex, bool_or(include) AS inc FROM documents d JOIN k ON lower(d.source) = k.key GROUP BY 1, 2)
SELECT d.doc_id AS id, g.id_goal, CASE WHEN g.id_goal = 3 THEN 'no_rankings_for_goal' WHEN m.ex THEN 'excluded_by_source_ranking' WHEN m.inc THEN 'included_by_source_ranking' ELSE 'no_matching_source_ranking' END AS reason,
NOT (g.id_goal <> 3 AND (coalesce(m.ex, false) OR m.id IS NULL)) AS allowed
FROM documents d CROSS JOIN g LEFT JOIN m ON m.id = d.doc_id AND m.id_goal = g.id_goal""")
def ranking_gate(spark, sf):
    d = table(spark, sf, "documents")
    null = F.lit(None).cast("string")
    k = keys.document_keys(null, F.col("source"), null, null)
    docs = d.select(F.col("doc_id").alias("id"), *(v.alias(n) for n, v in k.items()))
    r = spark.createDataFrame([(1, "source", "src1", True), (1, "source", "src2", False), (2, "source", "src2", True)], "id_goal int, source_kind string, source_key string, include boolean")
    return labels.ranking_gate(docs, r, _goals(spark))


# Text functions


@query("""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b[^>]*>.*?</script>', ' ', 'g'), '(?is)<style\\b[^>]*>.*?</style>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?i)</?(?:br|p|div|article|section|li|ul|ol|h[1-6]|tr|td|th)\\b[^>]*>', chr(10), 'g'), '<[^>]+>', ' ', 'g') AS body FROM pages""")
def strip_tags(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.strip_tags(F.col("html")).alias("body"))


@query("""WITH a AS (SELECT doc_id, regexp_replace(regexp_replace(replace(text, chr(160), ' '), '\\r\\n?', chr(10), 'g'), '[ \\t\\f\\x0B]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, ' *\\n *', chr(10), 'g'), '\\n\\s*\\n\\s*\\n+', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g') AS tidy FROM a""")
def tidy_spaces(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.tidy_spaces(F.col("text")).alias("tidy"))


@query("SELECT doc_id, array_to_string(regexp_extract_all(replace(lower(text), 'ё', 'е'), '[A-Za-zЀ-ӿ0-9]+'), ' ') AS key FROM documents")
def words_key(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.words_key(F.col("text")).alias("key"))


@query("SELECT doc_id, sha256(array_to_string(regexp_extract_all(lower(text), '[A-Za-zЀ-ӿ0-9]+'), ' ')) AS hash FROM documents")
def exact_hash(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.exact_hash(F.lit(None).cast("string"), F.col("text"), null_if_empty=False).alias("hash"))


@query("SELECT doc_id, array_to_string(regexp_extract_all(lower(left(text, 4000)), '[A-Za-zЀ-ӿ0-9]+'), ' ') AS near_doc FROM documents")
def near_document(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.near_document(F.col("text"), T.DEDUP_CHARS).alias("near_doc"))


@query("SELECT doc_id, length(regexp_replace(lower(text), '[^а-яё]', '', 'g')) AS cyrillic, length(regexp_replace(lower(text), '[^a-z]', '', 'g')) AS latin FROM documents")
def letter_counts(spark, sf):
    a, b = T.letter_counts(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", a.alias("cyrillic"), b.alias("latin"))


@query("""WITH c AS (SELECT doc_id, text, length(regexp_replace(lower(text), '[^a-z]', '', 'g')) AS a, length(regexp_replace(lower(text), '[^à-ÿñ]', '', 'g')) AS b FROM documents),
l AS (SELECT *, CASE WHEN a + b = 0 THEN NULL WHEN b = 0 THEN 'plain' WHEN a = 0 THEN 'marked' WHEN a + b < 20 THEN CASE WHEN a >= b THEN 'plain' ELSE 'marked' END WHEN a / (a + b) >= 0.9 THEN 'plain' ELSE 'marked' END AS lang FROM c)
SELECT doc_id, lang, trim(text) <> '' AND a + b >= 20 AND NOT coalesce(lang = 'plain', false) AS filtered FROM l""")
def language(spark, sf):
    lang = T.language(F.col("text"), "a-z", "à-ÿñ", ("plain", "marked"), ratio=0.9)
    return table(spark, sf, "documents").select("doc_id", lang.alias("lang"), T.foreign(F.col("text"), lang, "a-z", "à-ÿñ", "plain").alias("filtered"))


@query("SELECT doc_id, len(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS n_shingles FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM documents)")
def word_shingles(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.size(T.word_ngrams(F.col("text"), 5)).alias("n_shingles"))


@query()
def mixed_shingles(spark, sf):
    bounded_batches(spark, size=4 << 20)  # the sets of a batch are ten times as large as its texts
    d = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return d.select("doc_id", F.size(T.mixed_shingles(T.near_document(F.col("text")))).alias("n_shingles"))


@query()
def clean_pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.clean_text("html").alias("clean_text"))


@query("SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS net_location, regexp_replace(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:@]*)', 1)), '^www\\.', '') AS domain FROM pages")
def domains(spark, sf):
    return table(spark, sf, "pages").select("page_id", keys.net_location(F.col("url")).alias("net_location"), keys.domain_key(F.col("url")).alias("domain"))


@query("SELECT page_id, regexp_replace(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:@]*)', 1)), '^www\\.', '') AS source_name FROM pages")
def source_names(spark, sf):
    return table(spark, sf, "pages").select("page_id", keys.source_name(F.lit("{}"), F.col("url")).alias("source_name"))


@query("SELECT event_id, try_cast(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS importance, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, 'x-' || event_type || '-' || CAST(user_id AS VARCHAR) AS session FROM events")
def small_values(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", keys.importance(F.col("props")).alias("importance"), keys.int_like(F.get_json_object("props", "$.k")).alias("k"), keys.session_key(F.lit("x"), F.col("event_type"), F.col("user_id").cast("string")).alias("session"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%d-%m-%Y') || 'to' || strftime(o_orderdate + INTERVAL 7 DAY, '%d-%m-%Y') AS span FROM orders")
def day_spans(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", keys.day_span(F.col("o_orderdate"), F.date_add("o_orderdate", 7)).alias("span"))


@query("SELECT conv_id, turn, CAST(floor(length(text) / 3) + 50 AS BIGINT) AS tokens, left(text, 100) AS head FROM conversations")
def token_estimates(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", keys.token_estimate([F.col("text")]).cast("long").alias("tokens"), T.capped(F.col("text"), 100).alias("head"))


@query("SELECT p_partkey, 'Rate the part ' || p_name || ' of ' || p_brand || '.' AS prompt FROM part")
def prompts(spark, sf):
    return table(spark, sf, "part").select("p_partkey", keys.fill_template(F.lit("Rate the part {{name}} of {{brand}}."), {"name": F.col("p_name"), "brand": F.col("p_brand")}).alias("prompt"))


# Duplicates and verdicts


@query("SELECT md5(text) AS hash, min(doc_id) AS canonical FROM documents GROUP BY 1")
def exact_dup_map(spark, sf):
    return dedup.first_of_hash(table(spark, sf, "documents").select("doc_id", F.md5("text").alias("hash")), "hash", "doc_id")


@query("WITH f AS (SELECT md5(text) AS hash, min(doc_id) AS first FROM documents GROUP BY 1) SELECT d.doc_id, CASE WHEN f.first < d.doc_id THEN f.first END AS canonical FROM documents d JOIN f ON f.hash = md5(d.text)")
def exact_duplicates(spark, sf):
    return dedup.exact_duplicates(table(spark, sf, "documents").select("doc_id", F.md5("text").alias("hash")), "hash", "doc_id").select("doc_id", "canonical")


@query()
def near_duplicates(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("clean_content"), T.exact_hash(F.lit(""), F.col("text")).alias("content_hash"))
    return dedup.near_duplicates(d).select("id", "kept", "canonical", F.round("score", 3).alias("score"))


@query()
def near_duplicates_by_signature(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("clean_content"), T.exact_hash(F.lit(""), F.col("text")).alias("content_hash"))
    return dedup.by_signature(verdict.with_entry(d)).select("id", "kept", "canonical", F.round("score", 3).alias("score"))


@query()
def verdicts(spark, sf):
    v = verdict.verdicts(posts(spark, sf), target="a-zà-ÿñß", other="а-яё", names=("xx", "ru"))
    return v.select("id_raw_post", "drop_reason", "is_duplicate", "content_hash", "dup_score", "id_canonical")


@query(f"WITH {VERDICTS}, n AS (SELECT id_raw_post, CASE WHEN drop_reason = 'junk:quality' THEN NULL ELSE drop_reason END AS r, is_duplicate AS d FROM verdicts), j AS (SELECT CASE WHEN v.is_duplicate THEN 'duplicate' ELSE coalesce(v.drop_reason, 'kept') END <> CASE WHEN n.d THEN 'duplicate' ELSE coalesce(n.r, 'kept') END AS bad FROM verdicts v JOIN n USING (id_raw_post)) SELECT count(*) AS n, count(*) FILTER (WHERE bad) AS mismatches, count(*) FILTER (WHERE bad) / count(*) AS rate, count(*) FILTER (WHERE bad) / count(*) <= 0.005 AS passed FROM j")
def verdict_agreement(spark, sf):
    v = old_verdicts(spark, sf)
    return verdict.agreement(v, v.withColumn("drop_reason", F.when(F.col("drop_reason") != "junk:quality", F.col("drop_reason"))))


# Statistics


@query(f"""WITH {POSTS}, {VERDICTS}, s AS (SELECT source, row_number() OVER (ORDER BY min(id_raw_post), lower(source)) AS id_source FROM posts GROUP BY 1)
SELECT s.id_source, s.source AS name_source, count(p.id_raw_post) AS total_raw, count(v.id_raw_post) AS processed,
round(CAST(100.0 * count(*) FILTER (WHERE v.drop_reason LIKE 'junk:%') / nullif(count(v.id_raw_post), 0) AS DOUBLE), 2) AS pct_junk,
round(CAST(100.0 * count(*) FILTER (WHERE v.drop_reason = 'non_russian') / nullif(count(v.id_raw_post), 0) AS DOUBLE), 2) AS pct_non_russian,
round(CAST(100.0 * count(*) FILTER (WHERE v.is_duplicate) / nullif(count(v.id_raw_post), 0) AS DOUBLE), 2) AS pct_duplicates,
round(avg(length(p.content))) AS avg_content_len, max(p.time_post) AS last_seen_at
FROM s LEFT JOIN posts p ON p.source = s.source LEFT JOIN verdicts v USING (id_raw_post) GROUP BY 1, 2""")
def source_stats(spark, sf):
    p = posts(spark, sf)
    s = ingest.sources(p)
    return stats.source_stats(s.select("id_source", "name_source"), ingest.with_source(p, s), old_verdicts(spark, sf))


@query(f"WITH {VERDICTS} SELECT drop_reason, is_duplicate, count(*) AS n FROM verdicts GROUP BY 1, 2")
def verdict_counts(spark, sf):
    return stats.verdict_counts(old_verdicts(spark, sf))


@query(f"WITH {VERDICTS} SELECT count(*) FILTER (WHERE drop_reason IS NULL AND NOT is_duplicate) AS kept, count(*) FILTER (WHERE drop_reason IS NOT NULL AND NOT is_duplicate) AS dropped, count(*) FILTER (WHERE is_duplicate) AS duplicates FROM verdicts")
def batch_counters(spark, sf):
    return stats.batch_counters(old_verdicts(spark, sf))


@query("SELECT (SELECT count(*) FROM documents) AS n_documents, (SELECT count(*) FROM pages) AS n_pages, (SELECT count(*) FROM labels) AS n_labels, (SELECT count(*) FROM events) AS n_events, (SELECT count(*) FROM embeddings) AS n_embeddings")
def volumes(spark, sf):
    return stats.volumes(**{n: table(spark, sf, n) for n in ("documents", "pages", "labels", "events", "embeddings")})


@query("SELECT min(ts) AS first, max(ts) AS last, count(ts) AS n FROM events")
def time_range(spark, sf):
    return stats.time_range(table(spark, sf, "events"), "ts")


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1")
def daily_counts(spark, sf):
    at = lambda d: F.lit(d).cast("timestamp")
    return stats.daily(table(spark, sf, "events"), "ts", at("2024-01-05"), at("2024-01-20")).withColumn("day", F.col("day").cast("string"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 3")
def most_common(spark, sf):
    return stats.most_common(table(spark, sf, "events"), "event_type", 3)


@query("SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS position FROM events QUALIFY position <= 5")
def first_of_each(spark, sf):
    return stats.first_of_each(table(spark, sf, "events").select("event_type", "event_id"), "event_type", "event_id", 5)


@query(f"WITH {VERDICTS} SELECT id_canonical, count(*) AS n FROM verdicts WHERE id_canonical IS NOT NULL GROUP BY 1 ORDER BY n DESC, id_canonical LIMIT 1")
def largest_group(spark, sf):
    return stats.largest_group(old_verdicts(spark, sf))


@query(f"WITH {VERDICTS}, t AS (SELECT id_canonical AS top FROM verdicts WHERE id_canonical IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) SELECT v.id_raw_post, v.id_canonical FROM verdicts v, t WHERE v.id_canonical = t.top OR v.id_raw_post = t.top")
def reprint_group(spark, sf):
    return stats.reprint_group(old_verdicts(spark, sf)).select("id_raw_post", "id_canonical")


@query(f"WITH {POSTS}, {VERDICTS} SELECT v.id_raw_post, v.id_canonical, md5(a.content) AS duplicate_md5, md5(b.content) AS canonical_md5 FROM verdicts v JOIN posts a USING (id_raw_post) LEFT JOIN posts b ON b.id_raw_post = v.id_canonical WHERE v.is_duplicate")
def duplicate_pairs(spark, sf):
    v = old_verdicts(spark, sf).withColumn("dup_score", F.lit(1.0))
    return stats.duplicate_pairs(v, posts(spark, sf)).select("id_raw_post", "id_canonical", F.md5("duplicate_text").alias("duplicate_md5"), F.md5("canonical_text").alias("canonical_md5"))


@query("WITH r AS (SELECT d.doc_id AS id, g.id_goal, list_any_value(list_filter(list_transform(g.words, lambda w: contains(lower(d.text), w)), lambda x: x)) IS NOT NULL AS relevance FROM documents d CROSS JOIN (VALUES (1, ['license', 'version']), (2, ['token'])) g(id_goal, words)) SELECT * FROM r")
def relevance_matrix(spark, sf):
    return classify.relevance_matrix(table(spark, sf, "documents"), _goals(spark), F.col("text"), "doc_id")


@query("""WITH g AS (SELECT * FROM (VALUES (1, 'goal 1'), (2, 'goal 2'), (3, 'goal 3')) v(id_goal, goal)), l AS (SELECT doc_id AS id, 1 AS id_goal, contains(lower(text), 'license') OR contains(lower(text), 'version') AS relevance FROM documents UNION ALL SELECT doc_id, 2, contains(lower(text), 'token') FROM documents)
SELECT g.id_goal, g.goal, count(*) FILTER (WHERE l.relevance) AS relevant FROM g LEFT JOIN l USING (id_goal) GROUP BY 1, 2""")
def relevant_by_goal(spark, sf):
    return stats.relevant_by_goal(_goals(spark).select("id_goal", "goal"), classify.relevance_matrix(table(spark, sf, "documents"), _goals(spark), F.col("text"), "doc_id"))


@query("SELECT (SELECT count(*) FROM documents) AS total_docs, (SELECT count(DISTINCT doc_id) FROM labels) AS processed_docs, (SELECT count(*) FROM labels WHERE quality = 1) AS relevant_total, (SELECT count(*) FROM labels WHERE quality = 1) = 341 AS done")
def progress(spark, sf):
    return stats.progress(table(spark, sf, "documents"), table(spark, sf, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("relevance")), 341)


@query("SELECT doc_id, CASE WHEN quality = 1 THEN toxic ELSE 0 END AS toxic, quality <> 1 AND toxic <> 0 AS changed FROM labels")
def reset_irrelevant(spark, sf):
    return classify.reset_irrelevant(table(spark, sf, "labels").withColumn("relevance", F.col("quality") == 1), {"toxic": 0}).select("doc_id", "toxic", "changed")


#: Demo rules around a word of the corpus.
BRAND = classify.BrandRules(r"license", r"released|licensed", r"token|shouting", r"version 2", None, {1: classify.GoalRules("version", "released|licensed|this work", r"!!"), 2: classify.GoalRules("apache", "licensed", r"[$]{3}", open=True, quiet="gnu")})


#: Places of a brand of seven letters in a text, and what stands around each; the text is ``t``, the reach two numbers.
_PLACES = """parts AS (SELECT {keys}, t, string_split(lower(t), 'license') AS p FROM texts),
ks AS (SELECT *, unnest(range(1, len(p))) AS k FROM parts),
places AS (SELECT {keys}, t, k, CAST(list_sum(list_transform(p[1:k], lambda x: length(x))) AS BIGINT) + 7 * (k - 1) AS a FROM ks)"""
_REACH = "substr(t, greatest(a - {0}, 0) + 1, a + 7 + {1} - greatest(a - {0}, 0))"


@query(f"""WITH {POSTS}, texts AS (SELECT id_raw_post, content AS t FROM posts WHERE content IS NOT NULL), {_PLACES.format(keys="id_raw_post")},
found AS (SELECT id_raw_post, k, {_REACH.format(160, 240)} AS near, trim(regexp_replace({_REACH.format(80, 120)}, '[\\s\\x{{85}}\\p{{Z}}]+', ' ', 'g')) AS text FROM places),
firsts AS (SELECT * FROM found WHERE text <> '' QUALIFY row_number() OVER (PARTITION BY id_raw_post, text ORDER BY k) = 1),
few AS (SELECT * FROM firsts QUALIFY row_number() OVER (PARTITION BY id_raw_post ORDER BY k) <= {classify.MOST_MENTIONS}),
told AS (SELECT id_raw_post, text, CASE WHEN regexp_matches(near, 'token|shouting', 'i') THEN 'negative' WHEN regexp_matches(near, 'released|licensed', 'i') THEN 'positive' ELSE 'neutral' END AS sentiment FROM few)
SELECT *, CASE WHEN sentiment = 'neutral' THEN 0.6::DOUBLE ELSE 0.7::DOUBLE END AS confidence FROM told""")
def brand_mentions(spark, sf):
    m = classify.mentions(posts(spark, sf), "content", BRAND)
    return m.select("id_raw_post", F.explode("mentions").alias("m")).select("id_raw_post", "m.text", "m.sentiment", "m.confidence")


@query(f"""WITH {POSTS}, texts AS (SELECT id_raw_post AS id, coalesce(title, '') || chr(10) || coalesce(content, '') AS t FROM posts), {_PLACES.format(keys="id")},
near AS (SELECT id, list({_REACH.format(220, 320)}) AS ws FROM places GROUP BY 1),
goals(id_goal, bad, good) AS (VALUES (1, '!!', 'released|licensed|this work'), (2, '[$]{{3}}', 'licensed')),
seen AS (SELECT texts.id, t, id_goal, ws, ws IS NOT NULL AND (id_goal = 2 OR regexp_matches(t, 'version', 'i')) AS about, NOT (id_goal = 2 AND regexp_matches(t, 'gnu', 'i')) AS loud, bad, good FROM texts CROSS JOIN goals LEFT JOIN near USING (id)),
told AS (SELECT id, t, id_goal, about, CASE WHEN about AND loud AND len(list_filter(ws, lambda w: regexp_matches(w, bad, 'i'))) > 0 THEN 'negative' WHEN about AND loud AND len(list_filter(ws, lambda w: regexp_matches(w, good, 'i'))) > 0 THEN 'positive' ELSE 'neutral' END AS impact FROM seen)
SELECT id, id_goal, impact, CASE WHEN about THEN 'direct' ELSE 'indirect' END AS signal_strength, CASE WHEN impact = 'neutral' THEN 0.6::DOUBLE ELSE 0.7::DOUBLE END AS confidence, CAST(impact <> 'neutral' AND regexp_matches(t, 'version 2', 'i') AS INTEGER) AS is_paid FROM told""")
def brand_impacts(spark, sf):
    pairs = posts(spark, sf).select(F.col("id_raw_post").alias("id"), "title", "content", F.explode(F.array(F.lit(1), F.lit(2))).alias("id_goal"))
    return classify.impacts(pairs, BRAND).select("id", "id_goal", "impact", "signal_strength", "confidence", "is_paid")


# Vectors and retrieval


@query("WITH u AS (SELECT vec_id, CAST(embedding[1:16] AS DOUBLE[]) AS v FROM embeddings) SELECT vec_id, round(sqrt(list_inner_product(v, v)), 6) AS norm, round(v[1] / sqrt(list_inner_product(v, v)), 6) AS first FROM u")
def unit_prefix(spark, sf):
    u = V.unit_prefix(F.col("embedding"), 16)
    cut = F.slice(V.as_doubles(F.col("embedding")), 1, 16)
    return table(spark, sf, "embeddings").select("vec_id", F.round(V.norm(cut), 6).alias("norm"), F.round(F.get(u, F.lit(0)), 6).alias("first"))


@query(f"WITH {RANKED} SELECT id_object, id, score, rank FROM ranked WHERE rank <= 100")
def vector_topk(spark, sf):
    return ranked(spark, sf, 100)


@query(f"WITH {RANKED}, kw AS (SELECT CAST(id_object AS INTEGER) AS id_object, vec_id AS id FROM embeddings, (SELECT unnest([1, 2, 3]) AS id_object) WHERE embedding[1] > 0.2), v AS (SELECT id_object, id FROM ranked WHERE rank <= 50) SELECT coalesce(v.id_object, k.id_object) AS id_object, coalesce(v.id, k.id) AS id, v.id IS NOT NULL AS in_vector, k.id IS NOT NULL AS in_keyword FROM v FULL JOIN kw k ON v.id_object = k.id_object AND v.id = k.id")
def union_candidates(spark, sf):
    return _candidates(spark, sf)


def _candidates(spark, sf):
    kw = table(spark, sf, "embeddings").where(F.get("embedding", F.lit(0)) > 0.2).select(F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("id_object"), F.col("vec_id").alias("id"))
    return retrieval.union_candidates(ranked(spark, sf, 50), kw)


@query(f"""WITH {RANKED}, {TRUTH}, kw AS (SELECT CAST(id_object AS INTEGER) AS id_object, vec_id AS id FROM embeddings, (SELECT unnest([1, 2, 3]) AS id_object) WHERE embedding[1] > 0.2), v AS (SELECT id_object, id FROM ranked WHERE rank <= 50),
c AS (SELECT coalesce(v.id_object, k.id_object) AS o, coalesce(v.id, k.id) AS i, v.id IS NOT NULL AS iv, k.id IS NOT NULL AS ik FROM v FULL JOIN kw k ON v.id_object = k.id_object AND v.id = k.id),
b AS (SELECT coalesce(c.o, t.id_object) AS id_object, coalesce(c.i, t.id) AS id, CASE WHEN t.id IS NOT NULL THEN CASE WHEN iv AND ik THEN 'both' WHEN iv THEN 'vector_only' WHEN ik THEN 'regex_only' ELSE 'missed' END WHEN ik THEN 'regex_false' END AS bucket FROM c FULL JOIN truth t ON c.o = t.id_object AND c.i = t.id)
SELECT * FROM b WHERE bucket IS NOT NULL""")
def difference_buckets(spark, sf):
    return retrieval.difference_buckets(_candidates(spark, sf), truth(spark, sf))


@query(f"WITH {RANKED} SELECT r.id_object, r.id FROM ranked r JOIN embeddings e ON e.vec_id = r.id WHERE r.rank <= 100 AND e.embedding[1] > 0.1")
def intersection_chain(spark, sf):
    hits = table(spark, sf, "embeddings").where(F.get("embedding", F.lit(0)) > 0.1).select(F.col("vec_id").alias("id"))
    return ranked(spark, sf, 100).join(hits, "id", "left_semi").select("id_object", "id")


@query(f"""WITH {RANKED}, b AS (SELECT id_object, id, row_number() OVER (PARTITION BY id_object ORDER BY -id) AS rank FROM ranked WHERE rank <= 100), t AS (SELECT id_object, id, rank FROM ranked WHERE rank <= 100 UNION ALL SELECT * FROM b)
SELECT id_object, id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score FROM t GROUP BY 1, 2""")
def rank_fusion(spark, sf):
    a = ranked(spark, sf, 100)
    b = a.select("id_object", "id", F.row_number().over(W.partitionBy("id_object").orderBy(F.desc("id"))).alias("rank"))
    return retrieval.fuse(a.select("id_object", "id", "rank").unionByName(b)).select("id_object", "id", F.round("score", 9).alias("score"))


@query(f"WITH {RANKED}, s AS (SELECT vec_id AS id, round(CAST(embedding[2] AS DOUBLE), 6) AS score FROM embeddings WHERE embedding[1] > 0) SELECT r.id_object, r.id, row_number() OVER (PARTITION BY r.id_object ORDER BY s.score DESC NULLS LAST, r.rank) AS rank FROM ranked r LEFT JOIN s USING (id) WHERE r.rank <= 100")
def rerank_order(spark, sf):
    return _reranked(spark, sf).select("id_object", "id", "rank")


def _reranked(spark, sf):
    a = ranked(spark, sf, 100)
    e = table(spark, sf, "embeddings").where(F.get("embedding", F.lit(0)) > 0).select(F.col("vec_id").alias("id"), F.round(F.get("embedding", F.lit(1)).cast("double"), 6).alias("score"))
    return retrieval.rerank(a, a.select("id_object", "id").join(e, "id"))


@query(f"WITH {RANKED}, f AS (SELECT id_object, id % 3 AS facet, id, row_number() OVER (PARTITION BY id_object, id % 3 ORDER BY score DESC, id) AS rank FROM ranked) SELECT DISTINCT id_object, id FROM f WHERE rank <= greatest(1, floor(50 / (SELECT count(DISTINCT g.facet) FROM f g WHERE g.id_object = f.id_object)))")
def equal_budget(spark, sf):
    a = ranked(spark, sf).withColumn("facet", F.col("id") % 3)
    lists = a.select("id_object", "facet", "id", F.row_number().over(W.partitionBy("id_object", "facet").orderBy(F.desc("score"), "id")).alias("rank"))
    return retrieval.equal_budget(lists, 50)


@query(f"""WITH {RANKED}, d AS (SELECT id_object, rank - 1 AS pos, lag(score) OVER (PARTITION BY id_object ORDER BY rank) - score AS fall FROM ranked),
i AS (SELECT id_object, pos, fall FROM d WHERE pos >= 50 AND pos < 200), b AS (SELECT id_object, max(struct_pack(fall := fall, pos := pos)) AS best, list_sort(list(fall)) AS falls FROM i GROUP BY 1), n AS (SELECT id_object, count(*) AS n FROM ranked GROUP BY 1)
SELECT n.id_object, n.n, CAST(CASE WHEN least(200, n.n) <= least(50, n.n) OR b.best IS NULL THEN least(50, n.n) WHEN b.falls[len(b.falls) // 2 + 1] > 0 AND b.best.fall < 3.0 * b.falls[len(b.falls) // 2 + 1] THEN least(200, n.n) ELSE b.best.pos END AS BIGINT) AS cutoff FROM n LEFT JOIN b USING (id_object)""")
def adaptive_cutoff(spark, sf):
    return retrieval.adaptive_cutoff(ranked(spark, sf))


def _scores(spark, sf):
    """Scores of documents for two objects by an offline scorer, through an empty cache."""
    d = table(spark, sf, "documents")
    found = d.where(F.lower("text").contains("license")).select(F.explode(F.array(F.lit(1), F.lit(2))).alias("id_object"), F.col("doc_id").alias("id"))
    cache = spark.createDataFrame([], "id_object int, id long, model string, score double")
    scorer = retrieval.overlap_scorer({1: ["license", "version", "released"], 2: ["apache", "license"]})
    return retrieval.score_with_cache(found, d.select(F.col("doc_id").alias("id"), "text"), cache, scorer, "overlap")


_SCORED = "s AS (SELECT o.id_object, d.doc_id AS id, lower(d.text) AS t, round(10.0 * len(list_filter(o.words, lambda w: contains(lower(d.text), w))) / len(o.words), 3)::DOUBLE AS score FROM documents d CROSS JOIN (VALUES (1, ['license', 'version', 'released']), (2, ['apache', 'license'])) o(id_object, words) WHERE contains(lower(d.text), 'license'))"


@query(f"WITH {_SCORED} SELECT id_object, id, score FROM s")
def cached_scores(spark, sf):
    return _scores(spark, sf)[0].select("id_object", "id", "score")


@query(f"WITH {_SCORED} SELECT id_object, id, score AS llm_score FROM s WHERE score >= 5.0 AND NOT (id_object = 1 AND regexp_matches(t, '(?i)gnu'))")
def threshold_and_veto(spark, sf):
    hay = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("haystack"))
    return retrieval.decide(_scores(spark, sf)[0], hay, {1: "gnu", 2: ""}, 5.0)


# Evaluation


@query(f"WITH {RANKED}, {TRUTH} SELECT t.id_object, count(*) AS positives, " + ", ".join(f"round(count(*) FILTER (WHERE r.rank <= {k}) / count(*), 6) AS recall_at_{k}" for k in (10, 50, 100, 500)) + " FROM truth t LEFT JOIN ranked r USING (id_object, id) GROUP BY 1")
def recall_at_k(spark, sf):
    r = evaluation.recall_at(ranked(spark, sf), truth(spark, sf))
    return r.select("id_object", "positives", *(F.round(c, 6).alias(c) for c in r.columns[2:]))


_LABELLED = "l AS (SELECT vec_id AS id FROM embeddings WHERE embedding[3] > 0)"


@query(f"""WITH {RANKED}, {TRUTH}, {_LABELLED}, s AS (SELECT id_object, id FROM ranked WHERE rank <= 100), c AS (SELECT id_object, id FROM ranked),
j AS (SELECT coalesce(t.id_object, s.id_object) AS id_object, t.id IS NOT NULL AS p, s.id IS NOT NULL AS s, coalesce(t.id, s.id) IN (SELECT id FROM l) OR t.id IS NOT NULL AS known FROM truth t FULL JOIN s ON t.id_object = s.id_object AND t.id = s.id)
SELECT id_object, count(*) FILTER (WHERE p) AS positives, count(*) FILTER (WHERE s) AS selected, count(*) FILTER (WHERE p AND s) AS found, count(*) FILTER (WHERE s AND known) AS known, count(*) FILTER (WHERE s AND NOT known) AS unknown,
round(count(*) FILTER (WHERE p AND s) / count(*) FILTER (WHERE p), 6) AS recall, round(coalesce(count(*) FILTER (WHERE p AND s) / nullif(count(*) FILTER (WHERE s AND known), 0), 0), 6) AS precision,
round(coalesce((SELECT count(*) FROM truth t JOIN c USING (id_object, id) WHERE t.id_object = j.id_object), 0) / count(*) FILTER (WHERE p), 6) AS ceiling FROM j GROUP BY 1 HAVING count(*) FILTER (WHERE p) > 0""")
def selection_quality(spark, sf):
    known = table(spark, sf, "embeddings").where(F.get("embedding", F.lit(2)) > 0).select(F.col("vec_id").alias("id"))
    every = ranked(spark, sf)
    q = evaluation.set_quality(every.where("rank <= 100"), truth(spark, sf), known, every)
    return q.select("id_object", "positives", "selected", "found", "known", "unknown", *(F.round(c, 6).alias(c) for c in ("recall", "precision", "ceiling")))


_SWEEP = f"""WITH {RANKED}, {TRUTH}, {_LABELLED}, s AS (SELECT r.id_object, r.id, r.score, t.id IS NOT NULL AS p, r.id IN (SELECT id FROM l) OR t.id IS NOT NULL AS k FROM ranked r LEFT JOIN truth t USING (id_object, id)),
g AS (SELECT x AS step, (SELECT min(score) FROM s) + ((SELECT max(score) FROM s) - (SELECT min(score) FROM s)) * x / 20 AS threshold FROM (SELECT unnest(range(0, 21)) AS x)),
e AS (SELECT step, threshold, id_object, count(*) FILTER (WHERE p) AS r, count(*) FILTER (WHERE p AND score >= threshold) AS f, count(*) FILTER (WHERE k AND score >= threshold) AS kn, count(*) FILTER (WHERE score >= threshold) AS n FROM s CROSS JOIN g GROUP BY 1, 2, 3),
w AS (SELECT step, threshold, avg(f / r) AS recall, avg(coalesce(f / nullif(kn, 0), 0)) AS precision, avg(n) AS selected FROM e WHERE r > 0 GROUP BY 1, 2)"""


@query(_SWEEP + " SELECT CAST(step AS INTEGER) AS step, round(threshold, 6) AS threshold, round(recall, 6) AS recall, round(precision, 6) AS precision, round(selected, 6) AS selected FROM w")
def threshold_sweep(spark, sf):
    w = _sweep(spark, sf)
    return w.select("step", *(F.round(c, 6).alias(c) for c in ("threshold", "recall", "precision", "selected")))


def _sweep(spark, sf):
    known = table(spark, sf, "embeddings").where(F.get("embedding", F.lit(2)) > 0).select(F.col("vec_id").alias("id"))
    return evaluation.threshold_sweep(ranked(spark, sf), truth(spark, sf), known)


@query(_SWEEP + " SELECT CAST(step AS INTEGER) AS step, round(recall, 6) AS recall, round(precision, 6) AS precision FROM w WHERE recall >= 0.7 ORDER BY precision DESC, threshold LIMIT 1")
def best_threshold(spark, sf):
    return evaluation.best_threshold(_sweep(spark, sf)).select("step", F.round("recall", 6).alias("recall"), F.round("precision", 6).alias("precision"))


@query(f"""WITH {RANKED}, {TRUTH}, {_LABELLED}, s AS (SELECT r.id_object, r.score, t.id IS NOT NULL AS p, r.id IN (SELECT id FROM l) OR t.id IS NOT NULL AS k FROM ranked r LEFT JOIN truth t USING (id_object, id)),
c AS (SELECT a.id_object, a.score AS threshold, (SELECT count(*) FROM s b WHERE b.id_object = a.id_object AND b.p AND b.score >= a.score) AS f, (SELECT count(*) FROM s b WHERE b.id_object = a.id_object AND b.k AND b.score >= a.score) AS kn, (SELECT count(*) FROM s b WHERE b.id_object = a.id_object AND b.p) AS r FROM (SELECT DISTINCT id_object, score FROM s) a)
SELECT id_object, threshold, round(f / r, 6) AS recall, round(coalesce(f / nullif(kn, 0), 0), 6) AS precision FROM c WHERE r > 0 AND f / r >= 0.7 QUALIFY row_number() OVER (PARTITION BY id_object ORDER BY coalesce(f / nullif(kn, 0), 0) DESC, threshold) = 1""")
def object_thresholds(spark, sf):
    known = table(spark, sf, "embeddings").where(F.get("embedding", F.lit(2)) > 0).select(F.col("vec_id").alias("id"))
    t = evaluation.object_thresholds(ranked(spark, sf), truth(spark, sf), known)
    return t.select("id_object", "threshold", F.round("recall", 6).alias("recall"), F.round("precision", 6).alias("precision"))


@query(f"""WITH {RANKED}, {TRUTH}, {_LABELLED}, s AS (SELECT r.id_object, r.score, t.id IS NOT NULL AS p, r.id IN (SELECT id FROM l) AS k FROM ranked r LEFT JOIN truth t USING (id_object, id)),
m AS (SELECT id_object, list_sort(list(score) FILTER (WHERE p)) AS a, list_sort(list(score) FILTER (WHERE NOT p AND k)) AS b FROM s GROUP BY 1)
SELECT id_object, CAST(len(a) AS BIGINT) AS n_pos, CAST(len(b) AS BIGINT) AS n_neg, a[len(a) // 2 + 1] AS median_pos, b[len(b) // 2 + 1] AS median_neg, round(a[len(a) // 2 + 1] - b[len(b) // 2 + 1], 6) AS gap, round(len(list_filter(b, lambda x: x >= a[len(a) // 2 + 1])) / len(b), 6) AS overlap FROM m WHERE len(a) > 0 AND len(b) > 0""")
def separation(spark, sf):
    known = table(spark, sf, "embeddings").where(F.get("embedding", F.lit(2)) > 0).select(F.col("vec_id").alias("id"))
    s = evaluation.separation(ranked(spark, sf), truth(spark, sf), known)
    return s.select("id_object", "n_pos", "n_neg", "median_pos", "median_neg", F.round("gap", 6).alias("gap"), F.round("overlap", 6).alias("overlap"))


@query(f"""WITH {RANKED}, {TRUTH}, s AS (SELECT vec_id AS id, round(CAST(embedding[2] AS DOUBLE), 6) AS score FROM embeddings WHERE embedding[1] > 0), a AS (SELECT id_object, id, rank FROM ranked WHERE rank <= 100),
b AS (SELECT r.id_object, r.id, row_number() OVER (PARTITION BY r.id_object ORDER BY s.score DESC NULLS LAST, r.rank) AS rank FROM a r LEFT JOIN s USING (id)), k AS (SELECT unnest([10, 50]) AS k)
SELECT t.id_object, k.k, round(count(a.id) FILTER (WHERE a.rank <= k.k) / count(*), 6) AS before, round(count(b.id) FILTER (WHERE b.rank <= k.k) / count(*), 6) AS after FROM truth t CROSS JOIN k LEFT JOIN a USING (id_object, id) LEFT JOIN b USING (id_object, id) GROUP BY 1, 2""")
def rerank_delta(spark, sf):
    d = evaluation.rerank_delta(ranked(spark, sf, 100), _reranked(spark, sf), truth(spark, sf), (10, 50))
    return d.select("id_object", "k", F.round("before", 6).alias("before"), F.round("after", 6).alias("after"))


@query(f"WITH {RANKED}, {TRUTH}, r AS (SELECT t.id_object, count(r.id) / count(*) AS recall FROM truth t LEFT JOIN ranked r USING (id_object, id) GROUP BY 1) SELECT count(*) AS objects, round(avg(recall), 6) AS mean_recall, avg(recall) >= 0.7 AS passed FROM r")
def regression_gate(spark, sf):
    r = evaluation.recall_at(ranked(spark, sf), truth(spark, sf), (500,))
    return evaluation.gate(r, recall="recall_at_500").withColumn("mean_recall", F.round("mean_recall", 6))


@query(f"WITH {RANKED}, {TRUTH} SELECT coalesce(t.id_object, r.id_object) AS id_object, count(*) FILTER (WHERE t.id IS NOT NULL AND r.id IS NOT NULL) AS both, count(*) FILTER (WHERE r.id IS NULL) AS model_only, count(*) FILTER (WHERE t.id IS NULL) AS regex_only FROM truth t FULL JOIN (SELECT * FROM ranked WHERE rank <= 50) r ON t.id_object = r.id_object AND t.id = r.id GROUP BY 1")
def agreement(spark, sf):
    return evaluation.agreement(truth(spark, sf), ranked(spark, sf, 50))


@query("SELECT label AS id_object, vec_id AS id FROM embeddings WHERE label IN (SELECT label FROM embeddings GROUP BY 1 HAVING count(*) >= 5) AND label <> 9")
def truth_sets(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.array("label").alias("label_objects"), F.array().cast("array<int>").alias("mention_objects"))
    return evaluation.truth(e, "event", 5, [9])


@query("WITH c AS (SELECT unnest([1, 2]) AS id_object, doc_id AS id FROM documents WHERE contains(text, 'License')), l AS (SELECT doc_id AS id, CASE WHEN quality = 1 THEN [1] ELSE [] END AS e, CASE WHEN toxic = 1 THEN [2] ELSE [] END AS m FROM labels) SELECT id_object, count(*) AS found, count(*) FILTER (WHERE list_contains(e, id_object) OR list_contains(m, id_object)) AS confirmed, count(*) FILTER (WHERE list_contains(e, id_object)) AS strict, count(*) FILTER (WHERE list_contains(e, id_object) OR list_contains(m, id_object)) * 100 // count(*) AS pct FROM c JOIN l USING (id) GROUP BY 1")
def control_check(spark, sf):
    c = table(spark, sf, "documents").where(F.col("text").contains("License")).select(F.explode(F.array(F.lit(1), F.lit(2))).alias("id_object"), F.col("doc_id").alias("id"))
    return evaluation.control_check(c, _label_rows(spark, sf))


def _label_rows(spark, sf):
    none = F.array().cast("array<int>")
    return table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, F.array(F.lit(1))).otherwise(none).alias("label_objects"), F.when(F.col("toxic") == 1, F.array(F.lit(2))).otherwise(none).alias("mention_objects"))


@query("WITH l AS (SELECT doc_id, [quality, 3, toxic] AS a, [3, toxic, quality] AS b FROM labels) SELECT count(*) AS n, count(*) FILTER (WHERE a = b) AS same_order, count(*) FILTER (WHERE list_sort(list_distinct(a)) = list_sort(list_distinct(b))) AS same_set FROM l")
def self_consistency(spark, sf):
    one = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.array("quality", F.lit(3), "toxic").alias("label_objects"))
    two = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.array(F.lit(3), "toxic", "quality").alias("label_objects"))
    return evaluation.consistency(one, two)


@query("WITH s AS (SELECT event_type, list_sort(list(value)) AS v FROM events GROUP BY 1) SELECT event_type, v[least(len(v) - 1, CAST(floor(0.9 * len(v)) AS BIGINT)) + 1] AS p90, v[len(v) // 2 + 1] AS median FROM s")
def nearest_percentiles(spark, sf):
    return evaluation.values_at(table(spark, sf, "events"), ["event_type"], "value", {"p90": evaluation.nearest(0.9), "median": evaluation.middle()}).drop("n")


@query("SELECT event_id AS id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY md5('3:' || event_id), event_id) <= 10")
def stratified_sample(spark, sf):
    return evaluation.stratified(table(spark, sf, "events").select(F.col("event_id").alias("id"), "event_type"), "event_type", 10, seed=3)


# Labels and merges


@query("""WITH u AS (SELECT l_orderkey, l_linenumber, l_shipdate + CASE WHEN l_linenumber = 1 THEN 10 ELSE 0 END * INTERVAL 1 DAY AS d, l_extendedprice AS p, l_partkey AS k, l_suppkey AS s, l_returnflag AS r, 'stored' AS l_returnflag, 0 AS new FROM lineitem WHERE l_linenumber <= 2
UNION ALL SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_partkey, l_suppkey, l_returnflag, l_returnflag, 1 FROM lineitem)
SELECT l_orderkey, l_linenumber, l_returnflag FROM u QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY d DESC, p DESC, k DESC, s DESC, r DESC, new DESC) = 1""")
def latest_wins(spark, sf):
    """Stored rows of line 1 are newer, those of line 2 as new as the new ones."""
    rows = table(spark, sf, "lineitem")
    later = F.col("l_shipdate") + F.make_dt_interval(F.when(F.col("l_linenumber") == 1, 10).otherwise(0))
    version = lambda day: F.struct(day.cast("timestamp").alias("day"), "l_extendedprice", "l_partkey", "l_suppkey", "l_returnflag").alias("version")
    stored = rows.where("l_linenumber <= 2").select("l_orderkey", "l_linenumber", version(later), F.lit("stored").alias("l_returnflag"))
    new = rows.select("l_orderkey", "l_linenumber", version(F.col("l_shipdate")), "l_returnflag")
    return merge.latest_wins(stored, new, ["l_orderkey", "l_linenumber"], "version").select("l_orderkey", "l_linenumber", "l_returnflag")


@query("SELECT doc_id, quality FROM labels UNION ALL SELECT doc_id, 7 AS quality FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def insert_missing(spark, sf):
    new = table(spark, sf, "documents").select("doc_id", F.lit(7).alias("quality"))
    return merge.insert_missing(table(spark, sf, "labels").select("doc_id", F.col("quality").cast("int").alias("quality")), new, ["doc_id"])


@query("SELECT c.c_custkey, coalesce(o.p, c.c_mktsegment) AS c_mktsegment FROM customer c LEFT JOIN (SELECT o_custkey, max(o_orderpriority) AS p FROM orders GROUP BY 1) o ON o.o_custkey = c.c_custkey")
def set_column(spark, sf):
    new = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderpriority").alias("c_mktsegment"))
    return merge.set_column(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), new, "c_custkey", "c_mktsegment")


@query("SELECT event_id, '{\"k\":\"' || json_extract_string(props, '$.k') || '\",\"type\":\"' || event_type || '\"}' AS merged FROM events")
def json_merge(spark, sf):
    patch = F.to_json(F.struct(F.col("event_type").alias("type")))
    return table(spark, sf, "events").select("event_id", merge.flat_patch(F.col("props"), patch).alias("merged"))


@query("WITH n AS (SELECT doc_id, 9 AS quality, 9 AS toxic FROM documents WHERE source = 'src3') SELECT * FROM (SELECT doc_id, quality, toxic FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM n) UNION ALL SELECT * FROM n)")
def replace_labels(spark, sf):
    new = table(spark, sf, "documents").where("source = 'src3'").select("doc_id", F.lit(9).alias("quality"), F.lit(9).alias("toxic"))
    return merge.replace_of(table(spark, sf, "labels").select("doc_id", "quality", "toxic"), new, "doc_id")


@query(f"WITH {VERDICTS}, k AS (SELECT id_raw_post, id_raw_post + 1000000 AS clean FROM verdicts WHERE drop_reason IS NULL) SELECT v.id_raw_post, coalesce(k.clean, v.id_canonical) AS dup_of FROM verdicts v LEFT JOIN k ON k.id_raw_post = v.id_canonical WHERE v.is_duplicate")
def relinked(spark, sf):
    v = old_verdicts(spark, sf)
    kept = v.where(verdict.kept_rows()).select(F.col("id_raw_post").alias("id_raw"), (F.col("id_raw_post") + 1000000).alias("id_clean"))
    return merge.relinked(v.where("is_duplicate").select("id_raw_post", F.col("id_canonical").alias("dup_of")), kept)


@query("""WITH t AS (SELECT list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') AS w FROM conversations), g AS (SELECT unnest(list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) AS trigram FROM t WHERE len(w) >= 3)
SELECT trigram, count(*) AS n, round(count(*) / (SELECT count(*) FROM g), 9) AS relative_frequency FROM g GROUP BY 1""")
def trigrams(spark, sf):
    t = merge.word_trigrams(table(spark, sf, "conversations"), F.col("text"))
    return t.select("trigram", "n", F.round("relative_frequency", 9).alias("relative_frequency"))


@query("WITH a AS (SELECT doc_id AS id, unnest(list_distinct(regexp_extract_all(text, '[A-Z]{2,6}'))) AS abbreviation FROM documents) SELECT id, abbreviation, e.expansion, CASE WHEN e.expansion IS NULL THEN 'unresolved' ELSE 'resolved' END AS status FROM a LEFT JOIN (VALUES ('MIT', 'Massachusetts Institute of Technology'), ('CC', 'Creative Commons')) e(abbreviation, expansion) USING (abbreviation)")
def abbreviations(spark, sf):
    known = spark.createDataFrame([("MIT", "Massachusetts Institute of Technology"), ("CC", "Creative Commons")], "abbreviation string, expansion string")
    return merge.expand_abbreviations(table(spark, sf, "documents"), known, key="doc_id", pattern="[A-Z]{2,6}")


@query("SELECT doc_id AS id, CASE WHEN quality + toxic > 0 THEN 'labelled' ELSE 'skipped' END AS status, CASE WHEN quality + toxic = 0 THEN 'no_relevant_goals' END AS reason, CAST(quality AS BIGINT) AS n_positive, CAST(toxic AS BIGINT) AS n_negative, CAST(0 AS BIGINT) AS n_neutral FROM labels")
def roll_up(spark, sf):
    n = table(spark, sf, "labels")
    rows = n.where("quality = 1").select(F.col("doc_id").alias("id"), F.lit("positive").alias("impact")).union(n.where("toxic = 1").select("doc_id", F.lit("negative")))
    return labels.roll_up(n.select(F.col("doc_id").alias("id")), rows)


@query("SELECT doc_id AS id, CASE WHEN quality = 1 THEN '1. goal 1: positive' || CASE WHEN toxic = 1 THEN chr(10) || '2. goal 2: negative' ELSE '' END ELSE '2. goal 2: negative' END AS context FROM labels WHERE quality = 1 OR toxic = 1")
def label_context(spark, sf):
    n = table(spark, sf, "labels")
    rows = n.where("quality = 1").select(F.col("doc_id").alias("id"), F.lit(1).alias("id_goal"), F.lit("positive").alias("impact")).union(n.where("toxic = 1").select("doc_id", F.lit(2), F.lit("negative")))
    return labels.label_context(rows, _goals(spark).select("id_goal", "goal"))


@query("SELECT doc_id AS id, CASE WHEN quality = 1 THEN [1] ELSE [] END::VARCHAR AS label_objects, CASE WHEN toxic = 1 THEN [2] ELSE [] END::VARCHAR AS mention_objects, CASE WHEN quality = 1 THEN 'high' END AS confidence FROM labels WHERE doc_id IN (SELECT doc_id FROM documents)")
def cleaned_labels(spark, sf):
    r = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, F.array(F.lit(1), F.lit(77))).alias("events"), F.when(F.col("toxic") == 1, F.array(F.lit(2), F.lit(1))).alias("mentions"), F.when(F.col("quality") == 1, "high").otherwise("sure").alias("confidence"))
    r = r.withColumn("mentions", F.when(F.col("events").isNull(), F.filter("mentions", lambda x: x != 1)).otherwise(F.col("mentions")))
    c = labels.cleaned_labels(r, table(spark, sf, "documents").select(F.col("doc_id").alias("id")), {1, 2, 3})
    show = lambda k: F.concat(F.lit("["), F.array_join(F.col(k).cast("array<string>"), ", "), F.lit("]"))
    return c.select("id", show("label_objects").alias("label_objects"), show("mention_objects").alias("mention_objects"), "confidence")


@query("SELECT doc_id, CASE WHEN quality = 1 THEN 1 WHEN toxic = 1 THEN 2 ELSE 0 END AS impact_code, CASE WHEN quality = 1 THEN 'direct' ELSE '' END AS signal_text FROM labels")
def predictions(spark, sf):
    n = table(spark, sf, "labels").select("doc_id", F.when(F.col("quality") == 1, "positive").when(F.col("toxic") == 1, "negative").alias("impact"), F.when(F.col("quality") == 1, "direct").alias("signal_strength"))
    return labels.predictions(n).select("doc_id", "impact_code", "signal_text")


@query("""WITH c AS (SELECT conv_id * 100 + turn AS id, role, text FROM conversations), k AS (SELECT id, sha256(array_to_string(regexp_extract_all(lower(text), '[A-Za-zЀ-ӿ0-9]+'), ' ')) AS h, array_to_string(regexp_extract_all(lower(text), '[A-Za-zЀ-ӿ0-9]+'), ' ') AS key FROM c WHERE role = 'user' AND text <> ''),
f AS (SELECT h, min(id) AS first FROM k WHERE key <> '' GROUP BY 1)
SELECT CASE WHEN c.text IS NULL OR c.text = '' THEN 'no_url' WHEN c.role = 'user' THEN CASE WHEN f.first < c.id THEN 'collision' ELSE 'kept' END WHEN c.role = 'system' THEN 'unprocessed' ELSE 'non_russian' END AS outcome, count(*) AS n FROM c LEFT JOIN k USING (id) LEFT JOIN f ON f.h = k.h AND k.key <> '' GROUP BY 1""")
def migration_report(spark, sf):
    c = table(spark, sf, "conversations").withColumn("id", F.col("conv_id") * 100 + F.col("turn"))
    meta = F.when(F.col("role") == "assistant", '{"preprocess": {"status": "filtered_out", "reason": "non_russian_text"}}').otherwise("{}")
    items = c.select("id", F.col("text").alias("url"), F.lit("2024-01-01").alias("published_at"), F.col("text").alias("content"), meta.alias("metadata"))
    clean = c.where("role = 'user'").select((F.col("id") + 5).alias("id"), F.col("id").alias("raw_item_id"), F.lit(None).cast("string").alias("clean_title"), F.col("text").alias("clean_text"))
    return merge.migrate(items, clean, items.limit(0))["report"]


# Joins of several tables, look-ups, models, keys


@query(f"WITH {POSTS}, {VERDICTS}, s AS (SELECT lower(source) AS source_key, arg_min(source, id_raw_post) AS name_source FROM posts GROUP BY 1) SELECT p.id_raw_post, p.title, s.name_source FROM verdicts v JOIN posts p USING (id_raw_post) JOIN s ON s.source_key = lower(p.source) WHERE v.drop_reason IS NULL AND NOT v.is_duplicate")
def clean_with_source(spark, sf):
    p = posts(spark, sf)
    clean = old_verdicts(spark, sf).where(verdict.kept_rows()).select("id_raw_post")
    return ingest.clean_with_source(clean, p, ingest.sources(p)).select("id_raw_post", "title", "name_source")


@query(f"WITH {POSTS}, {VERDICTS}, l AS (SELECT doc_id AS id, 1 AS id_goal, 'positive' AS impact FROM labels WHERE quality = 1 UNION ALL SELECT doc_id, 2, 'negative' FROM labels WHERE toxic = 1) SELECT l.id, l.id_goal, 'goal ' || l.id_goal AS goal, l.impact, v.drop_reason, p.title, p.time_post FROM l JOIN verdicts v ON v.id_raw_post = l.id JOIN posts p ON p.id_raw_post = l.id WHERE NOT v.is_duplicate")
def labelled_posts(spark, sf):
    n = table(spark, sf, "labels")
    rows = n.where("quality = 1").select(F.col("doc_id").alias("id"), F.lit(1).alias("id_goal"), F.lit("positive").alias("impact")).union(n.where("toxic = 1").select("doc_id", F.lit(2), F.lit("negative")))
    clean = old_verdicts(spark, sf).where("not is_duplicate").select("id_raw_post", "drop_reason")
    return labels.labelled_posts(rows, _goals(spark), clean, posts(spark, sf)).select("id", "id_goal", "goal", "impact", "drop_reason", "title", "time_post")


@query("SELECT doc_id, source, TRUE AS in_pool FROM documents WHERE source = 'src3' UNION ALL SELECT * FROM (SELECT doc_id, source, FALSE AS in_pool FROM documents WHERE source IS DISTINCT FROM 'src3' ORDER BY md5('5:' || doc_id), doc_id LIMIT 50)")
def pool_and_background(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source")
    return ingest.with_background(d, d.where("source = 'src3'"), 50, "doc_id", 5)


@query(f"WITH {POSTS}, i AS (SELECT DISTINCT doc_id * 3 AS id_raw_post FROM labels) SELECT i.id_raw_post, p.title, p.time_post FROM i LEFT JOIN posts p USING (id_raw_post)")
def looked_up_titles(spark, sf):
    ids = table(spark, sf, "labels").select((F.col("doc_id") * 3).alias("id_raw_post"))
    return ingest.looked_up(ids, posts(spark, sf), "id_raw_post", ["title", "time_post"])


@query("SELECT doc_id AS id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def next_stage(spark, sf):
    return labels.next_stage(table(spark, sf, "documents").select(F.col("doc_id").alias("id")), table(spark, sf, "labels").where("quality = 1").select(F.col("doc_id").alias("id")))


def _searched(where: str) -> str:
    scored = f"SELECT o.id_object, e.vec_id AS id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(o.q AS DOUBLE[])), 6) AS score FROM embeddings e CROSS JOIN objects o WHERE {where}"
    return f"WITH {OBJECTS}, scored AS ({scored}) SELECT *, row_number() OVER (PARTITION BY id_object ORDER BY score DESC, id) AS rank FROM scored QUALIFY rank <= 100"


@query(_searched("e.vec_id % 2 = 0"))
def vector_of_model(spark, sf):
    v = vectors(spark, sf).withColumn("model", F.when(F.col("id") % 2 == 0, "even").otherwise("odd"))
    return retrieval.vector_channel(v, object_queries(spark, sf), 100, model="even", digits=6)


@query(_searched("e.label IS NOT NULL AND e.vec_id % 3 > 0"))
def vector_in_universe(spark, sf):
    return retrieval.vector_channel(vectors(spark, sf), object_queries(spark, sf), 100, truth(spark, sf).where("id % 3 > 0"), digits=6)


_WORDS = {1: "the GNU license", 2: "version of token", 3: "a b"}


@query("""WITH t AS (SELECT doc_id AS id, string_split_regex(lower(text), '[^\\pL\\pN_]+') AS w FROM documents), q(id_object, words) AS (VALUES (1, ['the', 'gnu', 'license']), (2, ['version', 'token'])),
s AS (SELECT id_object, id, len(list_filter(w, lambda x: list_contains(words, x))) AS score FROM t CROSS JOIN q)
SELECT id_object, id, score, row_number() OVER (PARTITION BY id_object ORDER BY score DESC, id) AS rank FROM s WHERE score > 0 QUALIFY rank <= 100""")
def word_search(spark, sf):
    return retrieval.word_channel(table(spark, sf, "documents"), _WORDS, F.col("text"), 100, "doc_id")


@query("SELECT vec_id AS id, len(embedding) AS n, embedding[1] AS first, embedding[len(embedding)] AS last, CAST(NULL AS BOOLEAN) AS broken FROM embeddings WHERE embedding IS NOT NULL")
def vector_texts(spark, sf):
    v = vectors(spark, sf).where("embedding is not null").select("id", V.literal(F.col("embedding")).alias("text"))
    read = V.parse(F.col("text"))
    broken = F.isnotnull(V.parse(F.concat(F.lit("x"), "text")))
    return v.select("id", F.size(read).alias("n"), F.element_at(read, 1).cast("float").alias("first"), F.element_at(read, -1).cast("float").alias("last"), F.when(broken, True).alias("broken"))


@query("""SELECT page_id, TRY_CAST(nullif(regexp_extract(string_split(url, '/')[-1], '([0-9]+)', 1), '') AS INTEGER) AS goal, sha1('[' || to_json(url) || ',' || to_json('page ' || page_id) || ']') AS fingerprint, CAST(page_id AS INTEGER) AS step_goal,
CASE WHEN page_id % 3 = 0 THEN CAST(page_id AS DOUBLE) END AS wait, page_id % 3 < 2 AS over, CASE WHEN page_id % 2 = 0 THEN page_id END AS whole FROM pages""")
def call_keys(spark, sf):
    p, n = table(spark, sf, "pages"), F.col("page_id")
    error = F.when(n % 3 == 0, F.concat(F.lit("HTTP 429, Retry-After: "), n.cast("string"))).when(n % 3 == 1, "Rate limit hit").otherwise("bad request")
    number = F.when(n % 2 == 0, F.concat(F.lit(" "), n.cast("string"))).otherwise(F.concat(n.cast("string"), F.lit(".5")))
    return p.select("page_id", keys.goal_of_file(F.col("url")).alias("goal"), keys.row_fingerprint(F.col("url"), F.concat(F.lit("page "), n.cast("string"))).alias("fingerprint"), keys.step_goal(F.concat(F.lit("label-kr-"), n.cast("string"))).alias("step_goal"), keys.retry_after(error).alias("wait"), keys.over_capacity(error).alias("over"), keys.int_like(number).alias("whole"))


@query("SELECT string_agg(n_nationkey || '. ' || n_name, chr(10) ORDER BY n_nationkey) AS catalog, count(*) AS n FROM nation WHERE n_regionkey <> 2")
def active_goals(spark, sf):
    return labels.goal_catalog(table(spark, sf, "nation").select(F.col("n_nationkey").alias("id_goal"), F.col("n_name").alias("goal"), (F.col("n_regionkey") != 2).alias("active")))


@query("SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' OR c_custkey % 3 = 0")
def missing_enrichment(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("enrichment"), F.when(F.col("c_custkey") % 3 == 0, "trial_run").alias("enriched_by"))
    return labels.missing_enrichment(c).select("c_custkey")


@query(f"WITH {TRUTH}, c AS (SELECT id_object, count(*) AS positives FROM truth GROUP BY 1) SELECT count(*) AS objects, round(avg(positives), 6) AS positives FROM c")
def macro_positives(spark, sf):
    m = evaluation.macro(truth(spark, sf).groupBy("id_object").agg(F.count("*").alias("positives")), "positives")
    return m.select("objects", F.round("positives", 6).alias("positives"))


from . import exchanged, indexed, scored  # noqa: E402, F401  register their queries
