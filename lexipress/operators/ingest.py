"""From vendor items to raw posts and their sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import keys

STATUSES = ("inserted", "no_url", "no_content", "no_time_post")


def blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def with_status(items: DataFrame) -> DataFrame:
    """Items (url, content, created_at) with ``time_post`` and ``status``; nothing is guessed."""
    timed = items.withColumn("time_post", keys.unix_seconds(F.col("created_at")))
    status = F.when(blank(F.col("url")), "no_url").when(blank(F.col("content")), "no_content").when(F.col("time_post").isNull(), "no_time_post").otherwise("inserted")
    return timed.withColumn("status", status)


def accepted(items: DataFrame) -> DataFrame:
    return with_status(items).where("status = 'inserted'").drop("status")


def status_counts(items: DataFrame) -> DataFrame:
    return with_status(items).groupBy("status").agg(F.count("*").alias("n"))


def new_items(items: DataFrame, stored: DataFrame, on: list[str]) -> DataFrame:
    """Items that are not stored yet, one for each key: insert, or do nothing on a conflict."""
    return items.dropDuplicates(on).join(stored.select(*on), on, "left_anti")


def sources(posts: DataFrame, name: str = "source", order: str = "id_raw_post") -> DataFrame:
    """Dimension of sources: key in lower case, the name as first seen, the number of its first row's rank.

    Numbers follow the order in which names were first seen; ranks are taken over sources,
    of which there are few, not over posts.
    """
    seen = posts.groupBy(F.lower(F.col(name)).alias("source_key")).agg(F.min_by(F.col(name), F.col(order)).alias("name_source"), F.min(order).alias("first_seen"))
    return seen.withColumn("id_source", F.row_number().over(W.orderBy("first_seen", "source_key")))


def with_source(posts: DataFrame, dimension: DataFrame, name: str = "source") -> DataFrame:
    return posts.join(dimension.select("source_key", "id_source"), F.lower(F.col(name)) == F.col("source_key"), "left").drop("source_key")


def day_slice(posts: DataFrame, time: str, day: Column) -> DataFrame:
    """Posts of one day in UTC."""
    return posts.where(F.to_date(time) == day)


def mirrored(posts: DataFrame, time: str, start: Column, end: Column) -> DataFrame:
    """Posts from ``start`` to before the day after ``end`` with text, md5 of it and their source from JSON or column."""
    inside = (F.col(time) >= start) & (F.col(time) < F.date_add(end, 1).cast("timestamp"))
    picked = posts.where(inside & (F.trim(F.coalesce("content", F.lit(""))) != ""))
    return picked.withColumn("content_hash", F.md5("content")).withColumn("source_name", F.coalesce(F.nullif(F.trim(F.get_json_object("metadata", "$.source")), F.lit("")), F.col("source"), F.lit(keys.UNKNOWN_SOURCE)))


def keyset_page(rows: DataFrame, key: str, after: int, size: int) -> DataFrame:
    """The next ``size`` rows after a key."""
    return rows.where(F.col(key) > after).orderBy(key).limit(size)


def offset_page(rows: DataFrame, order: list[Column], offset: int, size: int) -> DataFrame:
    return rows.orderBy(*order).offset(offset).limit(size)


def random_rows(rows: DataFrame, size: int, key: str, seed: int = 0) -> DataFrame:
    """A sample of ``size`` rows, the same for a seed: smallest hashes of seed and key."""
    return rows.orderBy(keys.drawn(key, seed), key).limit(size)


def with_background(rows: DataFrame, pool: DataFrame, extra: int, key: str, seed: int = 0) -> DataFrame:
    """Rows of the pool and ``extra`` others drawn at random; ``in_pool`` tells them apart.

    A row without a key is in no pool and may be drawn.
    """
    ids = pool.select(key).distinct()
    inside = rows.join(ids, key, "left_semi").withColumn("in_pool", F.lit(True))
    return inside.unionByName(random_rows(rows.join(ids, key, "left_anti"), extra, key, seed).withColumn("in_pool", F.lit(False)))


def clean_with_source(clean: DataFrame, raw: DataFrame, dimension: DataFrame, key: str = "id_raw_post", name: str = "source") -> DataFrame:
    """Clean rows with the columns of their raw post and the name of its source; rows that lack either go."""
    of_source = dimension.select(F.col("source_key").alias("_source_key"), "name_source")
    return clean.join(raw, key).join(of_source, F.lower(F.col(name)) == F.col("_source_key")).drop("_source_key")


def looked_up(ids: DataFrame, rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``columns`` of the rows with the given ids, repeated ids once; an unknown id has nulls."""
    return ids.select(key).distinct().join(rows.select(key, *columns), key, "left")
