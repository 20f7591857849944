"""The driver's tables in the roles that the operators know.

A document is a raw post: its id gives its time (minutes from the start of 2024), its
first line its title.  Labels are earlier verdicts: quality 0 is junk, toxic 1 a foreign
text.  Conversations are replies, events are vendor items, and the label of an embedding
says which object it belongs to.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id_raw_post, time_post, title, content, source."""
    d = table(spark, sf_dir, "documents")
    time = F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60)
    return d.select(F.col("doc_id").alias("id_raw_post"), time.alias("time_post"), T.title_of(F.col("text")).alias("title"), F.col("text").alias("content"), "source")


#: The same in SQL, as common table expressions that queries start with.
POSTS = "posts AS (SELECT doc_id AS id_raw_post, make_timestamp(CAST((1704067200 + doc_id * 60) * 1000000 AS BIGINT)) AS time_post, split_part(text, chr(10), 1) AS title, text AS content, source FROM documents)"


def old_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id_raw_post, drop_reason, is_duplicate of every labelled document that is there."""
    from ..operators.dedup import exact_duplicates

    d = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("hash"))
    x = exact_duplicates(d, "hash", "doc_id").join(table(spark, sf_dir, "labels"), "doc_id")
    dup = F.col("canonical").isNotNull()
    reason = F.when(dup, "duplicate").when(F.col("toxic") == 1, "non_russian").when(F.col("quality") == 0, "junk:quality")
    return x.select(F.col("doc_id").alias("id_raw_post"), reason.alias("drop_reason"), dup.alias("is_duplicate"), F.col("canonical").alias("id_canonical"))


VERDICTS = """first_of AS (SELECT md5(text) AS hash, min(doc_id) AS first FROM documents GROUP BY 1),
verdicts AS (SELECT d.doc_id AS id_raw_post,
  CASE WHEN f.first < d.doc_id THEN 'duplicate' WHEN l.toxic = 1 THEN 'non_russian' WHEN l.quality = 0 THEN 'junk:quality' END AS drop_reason,
  f.first < d.doc_id AS is_duplicate, CASE WHEN f.first < d.doc_id THEN f.first END AS id_canonical
  FROM documents d JOIN labels l USING (doc_id) JOIN first_of f ON f.hash = md5(d.text))"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", F.col("label").alias("truth"))


def object_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query for each label: its vector of the smallest id."""
    v = table(spark, sf_dir, "embeddings").where("label is not null")
    return v.groupBy(F.col("label").alias("id_object")).agg(F.min_by("embedding", "vec_id").alias("query_embedding"))


OBJECTS = "objects AS (SELECT label AS id_object, arg_min(embedding, vec_id) AS q FROM embeddings WHERE label IS NOT NULL GROUP BY 1)"
#: (id_object, id, score, rank) of all vectors for all objects; scores are rounded before they are ranked.
RANKED = OBJECTS + """,
scored AS (SELECT o.id_object, e.vec_id AS id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(o.q AS DOUBLE[])), 6) AS score FROM embeddings e CROSS JOIN objects o),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id_object ORDER BY score DESC, id) AS rank FROM scored QUALIFY rank <= 500)"""
TRUTH = "truth AS (SELECT label AS id_object, vec_id AS id FROM embeddings WHERE label IS NOT NULL)"


def ranked(spark: SparkSession, sf_dir: str, k: int = 500) -> DataFrame:
    from ..operators.retrieval import vector_channel

    return vector_channel(vectors(spark, sf_dir), object_queries(spark, sf_dir), k, digits=6)


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors(spark, sf_dir).where("truth is not null").select(F.col("truth").alias("id_object"), "id")
