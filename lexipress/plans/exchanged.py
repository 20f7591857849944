"""Queries of what is exchanged with others: files that are written and read back, replies that are checked, posts that wait for a vector."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import payloads
from ..operators import labels, merge, rules, verdict
from ..sources import files
from .lineage import folder
from .queries import query
from .tables import POSTS, VERDICTS, old_verdicts, posts, table


@query("SELECT conv_id, CAST(turn AS BIGINT) AS turn, role, text FROM conversations")
def jsonl_round_trip(spark, sf):
    """Conversations as JSON lines and back."""
    path = folder(spark, "jsonl")
    files.write_jsonl(table(spark, sf, "conversations"), path, "gzip")
    return files.read_jsonl(spark, path, "conv_id long, turn long, role string, text string")


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(text, '') AS text, coalesce(source, '') AS source FROM documents")
def delimited_round_trip(spark, sf):
    """Texts with line ends and quotes as compressed delimited text and back; nulls come back as empty texts."""
    path = folder(spark, "delimited")
    files.write_delimited(table(spark, sf, "documents").select("doc_id", "text", "source"), path)
    return files.read_delimited(spark, path, ["doc_id", "text", "source"])


@query("SELECT doc_id, CASE WHEN quality = 1 THEN 9 ELSE toxic END AS toxic, quality FROM labels WHERE quality = 0 OR doc_id % 2 = 0")
def bulk_replaced(spark, sf):
    """Labels written by quality, then one partition replaced: the others stay."""
    path, rows = folder(spark, "bulk"), table(spark, sf, "labels").select("doc_id", "toxic", "quality")
    files.write_bulk(rows, path, ["quality"])
    files.write_bulk(rows.where("quality = 1 and doc_id % 2 = 0").withColumn("toxic", F.lit(9)), path, ["quality"])
    return spark.read.schema("doc_id long, toxic int, quality int").parquet(path)


@query(f"WITH {VERDICTS} SELECT v.id_raw_post FROM verdicts v JOIN documents d ON d.doc_id = v.id_raw_post LEFT JOIN embeddings e ON e.vec_id = v.id_raw_post WHERE v.drop_reason IS NULL AND NOT v.is_duplicate AND d.text IS NOT NULL AND e.embedding IS NULL")
def embeddable_posts(spark, sf):
    """Kept posts with a text and without a vector."""
    texts = table(spark, sf, "documents").select(F.col("doc_id").alias("id_raw_post"), F.col("text").alias("clean_content"))
    made = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id_raw_post"), "embedding")
    return old_verdicts(spark, sf).join(texts, "id_raw_post").join(made, "id_raw_post", "left").where(verdict.embeddable()).select("id_raw_post")


@query("""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '?') AS source FROM documents),
e AS (SELECT doc_id, CASE doc_id % 3
  WHEN 0 THEN CASE WHEN doc_id % 4 > 1 THEN 'is_paid_news is not 0 or 1' END
  WHEN 1 THEN CASE WHEN NOT contains(text, source) THEN 'evidence is not in the text' WHEN doc_id % 7 = 6 THEN 'confidence is no number from 0.5 to 1' END
  ELSE CASE WHEN NOT contains(text, 'the') THEN 'companies is not in the text' END END AS error FROM d)
SELECT doc_id, error IS NULL AS ok, error FROM e""")
def reply_contracts(spark, sf):
    """Replies about every document, held against their contracts: paid flags, effects with evidence, entities."""
    d = table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("source", F.lit("?")).alias("source"))
    paid = F.format_string('{"result": {"payloads": [{"text": "{\\"is_paid_news\\": %d}"}]}}', F.col("doc_id") % 4)
    sure = F.format_string("%.1f", 0.5 + (F.col("doc_id") % 7) / 10)
    effect = F.format_string('```json\n{"impact": "positive", "signal_strength": "direct", "evidence": ["«%s»"], "reasoning_steps": ["a"], "theme": "t", "dashboard_description": "d", "why_for_goal": "w", "uncertainty": "u", "confidence": %s}\n```', "source", sure)
    named = F.lit('{"meta": {"finalAssistantVisibleText": "So: {\\"entities\\": {\\"companies\\": [\\"the\\"]}}"}}')
    kind = F.col("doc_id") % 3
    told = F.when(kind == 0, payloads.checked(lambda p, t: payloads.paid_flag(p), paid, F.col("text"))).when(kind == 1, payloads.checked(payloads.impact, effect, F.col("text"))).otherwise(payloads.checked(payloads.entities, named, F.col("text")))
    return d.select("doc_id", told.alias("c")).select("doc_id", "c.ok", "c.error")


@query("""WITH d AS (SELECT doc_id AS id, doc_id % 8 AS m, (doc_id // 8) % 2 AS pass, coalesce(text, '') AS t FROM documents),
k AS (SELECT id, pass, array_to_string(regexp_extract_all(replace(lower(t), 'ё', 'е'), '[A-Za-zЀ-ӿ0-9]+'), ' ') AS key FROM d WHERE m IN (0, 3)),
h AS (SELECT id, pass, CASE WHEN key <> '' THEN sha256(key) END AS h FROM k),
f AS (SELECT *, h IS NOT NULL AND min(id) OVER (PARTITION BY pass, h) < id AS collides FROM h)
SELECT id AS id_raw_post, CAST(NULL AS VARCHAR) AS drop_reason, FALSE AS is_duplicate, h AS content_hash, CAST(NULL AS DOUBLE) AS dup_score, CAST(NULL AS BIGINT) AS id_canonical FROM f WHERE NOT collides
UNION ALL SELECT id, CASE m WHEN 4 THEN 'non_russian' WHEN 5 THEN 'junk:ads' ELSE 'empty_clean_text' END, FALSE, NULL, NULL, NULL FROM d WHERE m IN (4, 5, 7)
UNION ALL SELECT d.id, 'duplicate', TRUE, NULL, 0.91, f.id FROM d JOIN f ON f.id = d.id - 6 AND NOT f.collides WHERE d.m = 6""")
def migrated_verdicts(spark, sf):
    """Verdict rows of a migration in three passes: half of the items, then all, then all again, which adds nothing."""
    m, id_ = F.col("id") % 8, F.col("id")
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    pre = lambda body: F.lit('{"preprocess": {%s}}' % body)  # noqa: E731, UP031  braces are JSON's
    copy = F.format_string('{"preprocess": {"status": "duplicate", "duplicate_of_clean_item_id": %d, "similarity": 0.91}}', id_ - 6 + 1_000_000)
    meta = F.when(m == 4, pre('"status": "filtered_out", "reason": "non_russian_text"')).when(m == 5, pre('"status": "filtered_out", "reason": "junk_topic_regex", "junk_category": "ads"')).when(m == 6, copy).when(m == 7, pre('"status": "failed", "reason": "empty_clean_text"')).otherwise("{}")
    items = d.select("id", F.when(m != 1, "u").alias("url"), F.when(m != 2, "2024-01-01").alias("published_at"), F.col("text").alias("content"), meta.alias("metadata"))
    clean = d.where(m.isin(0, 3)).select((id_ + 1_000_000).alias("id"), id_.alias("raw_item_id"), F.lit(None).cast("string").alias("clean_title"), F.col("text").alias("clean_text"))
    half = items.where(F.expr("id div 8 % 2 = 0"))
    passes = (merge.migrate(half, clean, items.limit(0)), merge.migrate(items, clean, half), merge.migrate(items, clean, items))
    return reduce(lambda a, b: a.unionByName(b), (p["verdicts"] for p in passes))


@query(f"""WITH {POSTS} SELECT id_raw_post, substr(coalesce(content, ''), 1, 120) AS text_head, length(coalesce(content, '')) > 120 AS truncated,
array_to_string(list_filter([CASE WHEN regexp_matches(t, 'license', 'i') THEN 1 END, CASE WHEN regexp_matches(t, 'token *=', 'i') THEN 2 END, CASE WHEN regexp_matches(t, 'version', 'i') THEN 3 END], lambda x: x IS NOT NULL), ',') AS controls FROM (SELECT *, coalesce(title, '') || ' ' || coalesce(content, '') AS t FROM posts)""")
def labelling_queue(spark, sf):
    q = rules.queue_row(posts(spark, sf), "title", "content", {1: "license", 2: "token *=", 3: "version"}, 120)
    return q.select("id_raw_post", "text_head", "truncated", F.array_join(F.col("control_objects").cast("array<string>"), ",").alias("controls"))


@query("""WITH n AS (SELECT doc_id AS id, CAST(count(*) AS BIGINT) AS c FROM labels WHERE quality = 1 GROUP BY 1)
SELECT doc_id AS id, CASE WHEN c IS NULL THEN 'failed' WHEN text IS NULL THEN 'pending' ELSE 'enriched' END AS status, CASE WHEN c IS NULL THEN 'missing_document_labels' END AS reason, coalesce(c, 0) AS label_count,
CASE WHEN c IS NOT NULL AND text IS NOT NULL THEN 1 + CAST(lang = 'en' AS INTEGER) END AS companies, CASE WHEN c IS NOT NULL AND text IS NOT NULL THEN 0 END AS people, CASE WHEN c IS NOT NULL AND text IS NOT NULL THEN CAST(n_chars % 3 AS INTEGER) END AS events FROM documents LEFT JOIN n ON n.id = doc_id""")
def semantics_status(spark, sf):
    d = table(spark, sf, "documents")
    names = F.when(F.col("lang") == "en", F.array("source", "lang")).otherwise(F.array("source"))
    found = d.where("text is not null").select(F.col("doc_id").alias("id"), F.create_map(F.lit("companies"), names).alias("entities"), F.array_repeat(F.lit("event"), (F.col("n_chars") % 3).cast("int")).alias("events"))
    made = labels.semantics_roll_up(d.select(F.col("doc_id").alias("id")), table(spark, sf, "labels").where("quality = 1").select(F.col("doc_id").alias("id")), found)
    return made.select("id", "status", "reason", "label_count", "entity_counts.companies", "entity_counts.people", F.col("event_count").alias("events"))


@query()
def clean_export(spark, sf):
    """The cleaning step over pages: titles from addresses; every third page has its text in a payload alone."""
    p = table(spark, sf, "pages")
    alone = F.col("page_id") % 3 == 0
    rows = p.select(F.col("page_id").alias("id"), F.col("url").alias("title"), F.when(~alone, F.col("html")).alias("text"), F.when(alone, F.to_json(F.struct(F.struct(F.col("html").alias("body")).alias("article")))).alias("payload"))
    return verdict.clean_step(rows, "a-zà-ÿñß", "а-яё", ("xx", "ru"))
