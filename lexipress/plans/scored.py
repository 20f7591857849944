"""Queries of pair scores over windows, of stories, and of edit distances."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import edits, retrieval, stories, windows
from .queries import query
from .tables import object_queries, table, vectors

_ASKED = {1: "the", 2: "en", 3: "fail"}
_SIZE, _STRIDE = 600, 450


def count_scorer(asked, texts):
    """A scorer without any service: how often the query stands in a text; one query always fails."""
    if asked == "fail":
        raise OSError("refused")
    return [float(t.lower().count(asked)) for t in texts]


_FIRST = "SELECT o AS id_object, doc_id AS id, row_number() OVER (PARTITION BY o ORDER BY n_chars DESC, doc_id) AS first_rank FROM documents, (VALUES (1), (2), (3)) v(o) WHERE lang <> 'fr' QUALIFY first_rank <= 100"


@query(f"""WITH first AS ({_FIRST}), asked(id_object, q) AS (VALUES (1, 'the'), (2, 'en'), (3, 'fail')),
w AS (SELECT id_object, id, first_rank, q, unnest(range(0, 1 + CAST(greatest(0, ceil((length(coalesce(text, '')) - {_SIZE}) / {_STRIDE})) AS INTEGER))) AS win, coalesce(text, '') AS text FROM first JOIN asked USING (id_object) JOIN documents ON doc_id = id),
s AS (SELECT *, substr(text, win * {_STRIDE} + 1, {_SIZE}) AS t FROM w),
scored AS (SELECT id_object, id, first_rank, win, CASE WHEN id_object < 3 THEN CASE WHEN id % 2 = 0 AND win = 0 THEN 1.5::DOUBLE ELSE len(string_split(lower(t), q)) - 1.0::DOUBLE END END AS score FROM s),
best AS (SELECT id_object, id, first_rank, max(score) AS score, CAST(arg_max(win, (score, -win)) AS INTEGER) AS win FROM scored GROUP BY ALL)
SELECT id_object, id, first_rank, score, CASE WHEN score IS NOT NULL THEN win END AS win, row_number() OVER (PARTITION BY id_object ORDER BY score DESC NULLS LAST, first_rank) AS rank FROM best""")
def window_rerank(spark, sf):
    """Candidates by length, ranked anew by their best window; half of the first windows are in the cache, one object's calls fail."""
    d = table(spark, sf, "documents")
    objects = spark.createDataFrame(list(_ASKED.items()), "id_object int, query string")
    ranked = retrieval.top_k(d.where("lang <> 'fr'").select(F.col("doc_id").alias("id"), F.col("n_chars").alias("score"), F.explode(F.array(*map(F.lit, _ASKED))).alias("id_object")), 100, "id_object")
    cache = ranked.where("id % 2 = 0 and id_object < 3").select("id_object", "id", F.lit("count").alias("model"), F.lit(0).alias("window"), F.lit(1.5).alias("score"))
    cache = cache.unionByName(cache.withColumns({"model": F.lit("other"), "score": F.lit(99.0)}))
    scores, _ = windows.window_scores(ranked, objects, d.select(F.col("doc_id").alias("id"), "text"), count_scorer, "count", cache, _SIZE, _STRIDE)
    again = retrieval.rerank(ranked, scores).join(scores.drop("score"), ["id_object", "id"], "left")
    return again.select("id_object", "id", "first_rank", "score", F.col("window").alias("win"), "rank")


@query()
def story_clusters(spark, sf):
    """Stories of all vectors in four slices, with the size and days of each, and the objects they match."""
    v = vectors(spark, sf).select("id", "embedding")
    last = v.agg(F.max("id")).head()[0] or 0
    rows = v.withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.expr(f"cast(id * 4 div {last + 1} as int)")))
    grown, members = stories.run(spark, rows, [f"2024-01-0{k}" for k in range(1, 5)], 0.8)
    goals = object_queries(spark, sf).select(F.col("id_object").alias("id_goal"), "query_embedding")
    best = stories.goal_matches(grown, goals, 0.5).groupBy("id_cluster").agg(F.count("*").alias("n_goals"))
    told = members.join(grown.drop("total"), "id_cluster").join(best, "id_cluster", "left")
    return told.select("id", "id_cluster", F.round("score", 6).alias("score"), "size", F.col("first_day").cast("string"), F.col("last_day").cast("string"), F.coalesce("n_goals", F.lit(0)).alias("n_goals"))


_PLAIN = r"[^\x00-\x7F]"


@query(f"""WITH d AS (SELECT doc_id AS id, substr(regexp_replace(text, '{_PLAIN}', '', 'g'), 1, 400) AS t FROM documents WHERE text IS NOT NULL),
p AS (SELECT min(id) OVER (PARTITION BY substr(t, 1, 24)) AS a, id AS b FROM d WHERE length(t) >= 24),
j AS (SELECT a, b, x.t AS ta, y.t AS tb, list_distinct(string_split(x.t, ' ')) AS wa, list_distinct(string_split(y.t, ' ')) AS wb FROM p JOIN d x ON x.id = a JOIN d y ON y.id = b WHERE a < b),
s AS (SELECT a, b, len(list_intersect(wa, wb)) / len(list_distinct(list_concat(wa, wb))) AS jaccard, levenshtein(ta, tb) AS n, floor(greatest(length(ta), length(tb)) * 0.15) AS most FROM j)
SELECT a, b, round(jaccard, 6) AS jaccard, CASE WHEN n <= most THEN CAST(n AS INTEGER) END AS distance, CASE WHEN n <= most THEN CASE WHEN jaccard >= 0.7 THEN 'both' ELSE 'edits_only' END WHEN jaccard >= 0.7 THEN 'words_only' ELSE 'neither' END AS told FROM s""")
def edit_confirmed(spark, sf):
    """Pairs that begin alike, judged by common words and by edits."""
    d = table(spark, sf, "documents").where("text is not null").select(F.col("doc_id").alias("id"), F.substring(F.regexp_replace("text", _PLAIN, ""), 1, 400).alias("text"))
    firsts = d.where("length(text) >= 24").withColumn("head", F.substring("text", 1, 24))
    pairs = firsts.join(firsts.groupBy("head").agg(F.min("id").alias("a")), "head").where("a < id").select("a", F.col("id").alias("b"))
    words = lambda c: F.array_distinct(F.split(c, " "))
    own = d.select("id", words(F.col("text")).alias("w"))
    judged = pairs.join(own.select(F.col("id").alias("a"), F.col("w").alias("wa")), "a").join(own.select(F.col("id").alias("b"), F.col("w").alias("wb")), "b").select("a", "b", V.jaccard(F.col("wa"), F.col("wb")).alias("jaccard"))
    near = edits.confirmed(pairs, d)
    j = judged.join(near, ["a", "b"], "left")
    told = F.when(F.col("distance").isNotNull(), F.when(F.col("jaccard") >= 0.7, "both").otherwise("edits_only")).when(F.col("jaccard") >= 0.7, "words_only").otherwise("neither")
    return j.select("a", "b", F.round("jaccard", 6).alias("jaccard"), "distance", told.alias("told"))
