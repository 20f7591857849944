"""Reports: source statistics, verdict and day counts, volumes, progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .verdict import is_junk, kept_rows


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Half-up percentage, null of nothing."""
    exact = part.cast("decimal(20,0)") * 100 / F.nullif(whole, F.lit(0)).cast("decimal(20,0)")
    return F.round(exact, digits).cast("double")


def source_stats(sources: DataFrame, raw: DataFrame, verdicts: DataFrame, foreign: str = "non_russian") -> DataFrame:
    """One row a source, empty sources included: volumes, shares of what was processed, mean length, last post."""
    rows = sources.join(raw, "id_source", "left").join(verdicts.drop("time_post"), "id_raw_post", "left")
    done = F.count("drop_or_kept")
    rows = rows.withColumn("drop_or_kept", F.when(F.col("is_duplicate").isNotNull(), 1))
    return rows.groupBy("id_source", "name_source").agg(
        F.count("id_raw_post").alias("total_raw"), done.alias("processed"),
        percent(F.count_if(is_junk()), done).alias("pct_junk"), percent(F.count_if(F.col("drop_reason") == foreign), done).alias("pct_non_russian"),
        percent(F.count_if(F.col("is_duplicate")), done).alias("pct_duplicates"),
        F.round(F.avg(F.length("content"))).cast("double").alias("avg_content_len"), F.max("time_post").alias("last_seen_at"),
    )


def verdict_counts(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("drop_reason", "is_duplicate").agg(F.count("*").alias("n"))


def batch_counters(verdicts: DataFrame) -> DataFrame:
    return verdicts.agg(F.count_if(kept_rows()).alias("kept"), F.count_if(~F.col("is_duplicate") & F.col("drop_reason").isNotNull()).alias("dropped"), F.count_if("is_duplicate").alias("duplicates"))


def volumes(**tables: DataFrame) -> DataFrame:
    """One row with the number of rows of each table: one aggregate each, side by side."""
    from functools import reduce

    return reduce(lambda a, b: a.crossJoin(b), (t.agg(F.count("*").alias(f"n_{name}")) for name, t in tables.items()))


def time_range(rows: DataFrame, time: str) -> DataFrame:
    return rows.agg(F.min(time).alias("first"), F.max(time).alias("last"), F.count(time).alias("n"))


def daily(rows: DataFrame, time: str, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Rows by day, from ``start`` to before ``end`` if given."""
    from .rules import all_of

    inside = all_of([F.col(time) >= start if start is not None else None, F.col(time) < end if end is not None else None])
    return rows.where(inside).groupBy(F.to_date(time).alias("day")).agg(F.count("*").alias("n"))


def most_common(rows: DataFrame, column: str, n: int) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(n)


def first_of_each(rows: DataFrame, group: str, order: str, n: int) -> DataFrame:
    return rows.withColumn("position", F.row_number().over(W.partitionBy(group).orderBy(order))).where(F.col("position") <= n)


def largest_group(verdicts: DataFrame, canonical: str = "id_canonical") -> DataFrame:
    """The original with most duplicates, and how many."""
    return verdicts.where(F.col(canonical).isNotNull()).groupBy(canonical).agg(F.count("*").alias("n")).orderBy(F.desc("n"), canonical).limit(1)


def reprint_group(verdicts: DataFrame, key: str = "id_raw_post", canonical: str = "id_canonical") -> DataFrame:
    """The largest group's original and duplicates: two equi-joins instead of one join on OR."""
    top = largest_group(verdicts, canonical).select(F.col(canonical).alias("top"))
    one = verdicts.join(F.broadcast(top), F.col(canonical) == F.col("top"), "left_semi")
    return one.unionByName(verdicts.join(F.broadcast(top), F.col(key) == F.col("top"), "left_semi"))


def duplicate_pairs(verdicts: DataFrame, raw: DataFrame) -> DataFrame:
    """Duplicate and original side by side: near ones first, least similar first, newest id first."""
    d = verdicts.where("is_duplicate").join(raw.select("id_raw_post", F.col("content").alias("duplicate_text")), "id_raw_post")
    o = raw.select(F.col("id_raw_post").alias("id_canonical"), F.col("content").alias("canonical_text"))
    return d.join(o, "id_canonical", "left").orderBy(F.coalesce(F.col("dup_score") < 1, F.lit(False)).desc(), F.asc_nulls_last("dup_score"), F.desc("id_raw_post"))


def progress(docs: DataFrame, labels: DataFrame, previous: int | None) -> DataFrame:
    """total_docs, processed_docs, relevant_total, done: done when a later look finds no more relevant ones."""
    a = docs.agg(F.count("*").alias("total_docs"))
    b = labels.agg(F.count_distinct("id").alias("processed_docs"), F.count_if("relevance").alias("relevant_total"))
    done = F.lit(False) if previous is None else F.col("relevant_total") == previous
    return a.crossJoin(b).withColumn("done", done)


def relevant_by_goal(goals: DataFrame, labels: DataFrame) -> DataFrame:
    """Relevant documents of each goal, none included."""
    return goals.join(labels, "id_goal", "left").groupBy("id_goal", "goal").agg(F.count_if("relevance").alias("relevant"))
