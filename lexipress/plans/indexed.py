"""Queries of what is fetched in parts, or stored once and met again: vendor days, indexes, ledger of calls."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import stems
from ..functions import text as T
from ..operators import fulltext, ledger, merge
from ..sources import captured, paged
from .lineage import folder
from .queries import query
from .tables import table

#: Words of each object: one group, two groups, three groups, a group that nothing matches.
_GROUPS = {1: [["license", "gnu", "token", "tion"]], 2: [["the", "la"], ["license", "version", "und"]], 3: [["the"], ["of"], ["and"]], 4: [["the"], ["qqqq"]]}
_VALUES = ", ".join(f"({o}, {g}, '{t}', {len(q)})" for o, q in _GROUPS.items() for g, words in enumerate(q) for t in words)


@query(f"""WITH q(id_object, part, term, parts) AS (VALUES {_VALUES}),
w AS (SELECT doc_id AS id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS words FROM documents WHERE text IS NOT NULL),
places AS (SELECT id, unnest(words) AS term, generate_subscripts(words, 1) AS place FROM w),
hits AS (SELECT id_object, id, parts, place, list(part) AS of FROM places JOIN q USING (term) GROUP BY ALL),
single AS (SELECT id_object, id, count(*) * 0.1::DOUBLE AS score FROM hits WHERE parts = 1 GROUP BY ALL),
numbered AS (SELECT *, row_number() OVER w AS nth, last_value(CASE WHEN list_contains(of, 0) THEN place END IGNORE NULLS) OVER w AS p0, last_value(CASE WHEN list_contains(of, 1) THEN place END IGNORE NULLS) OVER w AS p1,
  CASE WHEN parts > 2 THEN last_value(CASE WHEN list_contains(of, 2) THEN place END IGNORE NULLS) OVER w ELSE place END AS p2 FROM hits WHERE parts > 1 WINDOW w AS (PARTITION BY id_object, id ORDER BY place)),
starts AS (SELECT *, CASE WHEN p0 IS NOT NULL AND p1 IS NOT NULL AND p2 IS NOT NULL THEN least(p0, p1, p2) END AS start FROM numbered),
ends AS (SELECT *, lag(start) OVER (PARTITION BY id_object, id ORDER BY place) AS before FROM starts),
covers AS (SELECT e.id_object, e.id, 0.1::DOUBLE / (1 + (e.place - e.start) - (e.nth - s.nth)) AS part FROM ends e JOIN numbered s ON s.id_object = e.id_object AND s.id = e.id AND s.place = e.start WHERE e.before IS NULL OR e.before < e.start),
scores AS (SELECT * FROM single UNION ALL SELECT id_object, id, sum(part) AS score FROM covers GROUP BY ALL)
SELECT id_object, id, round(score, 6) AS score, row_number() OVER (PARTITION BY id_object ORDER BY round(score, 6) DESC, id) AS rank FROM scores QUALIFY rank <= {fulltext.DEPTH}""")
def text_rank(spark, sf):
    """Cover density over whole words, through a stored index of all documents."""
    index = fulltext.Index(spark, folder(spark, "text-index"), 16, stems.same)
    return index.add(table(spark, sf, "documents"), "text", "doc_id").search(_GROUPS)


@query()
def text_rank_stems(spark, sf):
    """The same over stems, without words that are too common."""
    index = fulltext.Index(spark, folder(spark, "stem-index"), 16)
    return index.add(table(spark, sf, "documents"), "text", "doc_id").search({1: fulltext.any_of("Licenses, versions; the tokens"), 2: fulltext.all_of("lizenz license", "software version")})


def _length_scorer(prompts):
    """A scorer without any service: a number of a text's length."""
    return [str(len(p) % 11) for p in prompts]


def _under_ten(reply, prompt):
    if reply == "10":
        raise ValueError("out of range")
    return reply


@query("""WITH d AS (SELECT doc_id, text, length(text) % 11 AS n FROM documents),
firsts AS (SELECT text, bool_or(doc_id % 2 = 0) AS before FROM d WHERE text IS NOT NULL GROUP BY 1)
SELECT doc_id, CASE WHEN n < 10 THEN CAST(n AS VARCHAR) END AS reply, CAST(CASE WHEN d.text IS NULL THEN NULL WHEN n < 10 THEN 1 WHEN before THEN 4 ELSE 2 END AS INTEGER) AS attempts FROM d LEFT JOIN firsts ON firsts.text = d.text""")
def paid_calls(spark, sf):
    """Two runs over one ledger: the second asks for what is new or was refused."""
    book = ledger.Ledger(spark, folder(spark, "ledger"))
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("prompt"))
    ask = lambda d: book.ask(d, "score", "length", _length_scorer, _under_ten, batch=200, rounds=2)
    ask(docs.where("doc_id % 2 = 0"))
    found = ask(docs)
    tried = book.rows("score").groupBy("digest").agg(F.max("attempt").alias("attempts"))
    return found.join(tried, "digest", "left").select("doc_id", "reply", "attempts")


@query("SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'")
def vendor_days(spark, sf):
    """Events through the paged source: only the days that the filter leaves, a task for a range of each."""
    paged.register(spark)
    held = captured.capture(table(spark, sf, "events").select("event_id", "event_type", "ts"), "ts", "event_id", folder(spark, "vendor"))
    source = spark.read.format("paged").options(fetch="lexipress.sources.captured:fetch", head="lexipress.sources.captured:head", schema="event_id string, event_type string", first="2024-01-01", last="2024-01-31", limit=100, pages_a_task=500, source=held)
    return source.load().where("day >= DATE '2024-01-05' AND day < DATE '2024-01-12'").withColumn("day", F.col("day").cast("string"))


@query("""SELECT event_id, '{"at":' || to_json(event_type) || ',"geo":{"c":' || to_json(event_type) || '},"k":{"deep":[' || event_id || ',{"x":null}]}' || CASE WHEN event_id % 3 = 0 THEN ',"n":null' ELSE '' END || ',"z":' || CAST(json(props) AS VARCHAR) || '}' AS merged FROM events""")
def json_nested_merge(spark, sf):
    """Nested properties: an inner object is replaced whole, others stay as they are."""
    e = table(spark, sf, "events")
    stored = F.format_string('{"z": %s, "geo": {"a": 1, "c": 2}, "k": {"deep": [%d, {"x": null}]}, "n": "old"}', F.col("props"), F.col("event_id"))
    stored = F.when(F.col("event_id") % 3 == 0, stored).otherwise(F.regexp_replace(stored, ', "n": "old"', ""))
    kind = F.to_json(F.struct(F.col("event_type").alias("at"), F.struct(F.col("event_type").alias("c")).alias("geo")))
    patch = F.when(F.col("event_id") % 3 == 0, F.concat(F.expr("substring(k, 1, length(k) - 1)"), F.lit(', "n": null}'))).otherwise(F.col("k"))
    return e.withColumn("k", kind).select("event_id", merge.json_patch(stored, patch).alias("merged"))


@query("""WITH l AS (SELECT doc_id, lang, n_chars, source, split_part(text, chr(10), 1) AS a, split_part(text, chr(10), 2) AS b FROM documents),
p AS (SELECT *, [CASE WHEN regexp_matches(a, '\\S') THEN a END, CASE WHEN regexp_matches(b, '\\S') THEN b ELSE source END] AS body FROM l)
SELECT doc_id AS id, CASE WHEN len(list_filter(body, lambda x: x IS NOT NULL)) > 0 THEN array_to_string(list_filter(body, lambda x: x IS NOT NULL), chr(10)) ELSE concat_ws(chr(10), lang, n_chars) END AS text FROM p""")
def payload_walk(spark, sf):
    """Texts of nested payloads: the first line of a document, then an object with the second line and a source."""
    line = lambda k: F.get(F.split(F.col("text"), "\n"), k)
    second = F.struct(F.coalesce(F.when(F.col("text").isNotNull(), F.coalesce(line(1), F.lit(""))), F.lit(" ")).alias("text"), F.col("source").alias("other"))
    d = table(spark, sf, "documents")
    payload = F.to_json(F.struct(F.struct("lang", "n_chars").alias("meta"), F.struct(F.struct(line(0).alias("a"), second.alias("b")).alias("parts")).alias("body")))
    return T.payload_texts(d.select(F.col("doc_id").alias("id"), payload.alias("payload")))
