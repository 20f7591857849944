"""Stories: clusters of posts that grow slice by slice, and how they match goals.

Slices follow time.  A vector joins the story whose centroid, as it was before the slice, has
the highest cosine of at least the threshold.  Those that no story takes found new ones: in
the order of ids, a vector joins the best earlier founder of its slice within the threshold,
or is a founder itself.  After the slice a story's sum, size and days are updated by partial
sums of its new members, so that a slice costs its own vectors and the stories, never old ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.lineage import bounded_batches, cut, drop
from . import dedup
from .retrieval import BLOCK_BYTES, blocks_of, nearest, unit_rows, vector_scores

THRESHOLD = 0.8
#: Vectors of a block that meets another block at most, and of a strip of one product; cosines are rounded so that every order of sums decides alike.
BLOCK, STRIP = 8192, 512
DIGITS = 9

STORIES = "id_cluster long, total array<double>, size long, first_day date, last_day date"


def _near_rows(threshold: float):
    spec = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                ids = [batch.column(c)[k].values.to_numpy() for c in ("ids_a", "ids_b")]
                same = batch.column("own")[k].as_py()
                sides = [unit_rows(batch.column(c)[k].values) for c in ("a", "b")]
                for n in sides[0].keys() & sides[1].keys():
                    (at, v), (on, w) = sides[0][n], sides[1][n]
                    for start in range(0, len(at), STRIP):
                        scores = np.round(v[start : start + STRIP] @ w.T, DIGITS)
                        x, y = np.nonzero(scores >= threshold)
                        p, q = ids[0][at[start + x]], ids[1][on[y]]
                        use = p < q if same else slice(None)
                        made = np.minimum(p, q)[use], np.maximum(p, q)[use], scores[x, y][use]
                        yield pa.RecordBatch.from_arrays([pa.array(m) for m in made], schema=spec)

    return run


def near_pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """(a, b, score), a < b, of all vectors (id, embedding) of one slice within the threshold; block meets block as one product.

    Blocks stand in a ring: each is sent to itself and to those of the half ring after it.
    """
    n, wide = rows.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(1))).head()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    packed, blocks = blocks_of(rows, "id", "embedding", min(BLOCK, BLOCK_BYTES // (8 * max(1, wide)), max(256, -(-n // cores))), n)
    packed = cut(packed)
    other = packed.select(F.col("block").alias("j"), F.col("ids").alias("ids_b"), F.col("vectors").alias("b"))
    sent = packed.select(F.col("block").alias("i"), F.col("ids").alias("ids_a"), F.col("vectors").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(blocks // 2))).alias("step"))
    sent = sent.withColumn("j", F.pmod(F.col("i") + F.col("step"), F.lit(blocks)))
    # Two blocks that face each other in a ring of even length meet once.
    sent = sent.where((F.col("step") * 2 < blocks) | (F.col("i") < F.col("j")))
    # Spark takes repeated blocks for as small as one of each: without the hint it would broadcast them.
    met = sent.join(other.hint("merge"), "j").select("ids_a", "a", "ids_b", "b", (F.col("i") == F.col("j")).alias("own"))
    return met.mapInArrow(_near_rows(threshold), "a long, b long, score double")


def _sums(members: DataFrame) -> DataFrame:
    """(id_cluster, total, size, first_day, last_day) of members (id_cluster, day, unit)."""
    parts = members.select("id_cluster", "day", F.posexplode("unit").alias("k", "x")).groupBy("id_cluster", "k").agg(F.sum("x").alias("x"), F.count("*").alias("n"), F.min("day").alias("first"), F.max("day").alias("last"))
    total = F.transform(F.sort_array(F.collect_list(F.struct("k", "x"))), lambda s: s["x"])
    return parts.groupBy("id_cluster").agg(total.alias("total"), F.max("n").alias("size"), F.min("first").alias("first_day"), F.max("last").alias("last_day"))


def grow(stories: DataFrame, slice_: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(stories after the slice, (id, id_cluster, score) of its vectors); slice_: id, day, embedding.

    A founder's id is its story's; its score is 1.  Vectors without a direction join nothing and
    found nothing.
    """
    bounded_batches(slice_.sparkSession, 4096)
    rows = slice_.where("embedding is not null").select("id", "day", F.col("embedding").cast("array<double>").alias("embedding"))
    size = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    rows = rows.withColumn("size", size).where("size > 0 and size < double('infinity')").withColumn("unit", F.transform("embedding", lambda x: x / F.col("size")))
    rows = cut(rows.select("id", "day", "embedding", "unit"))
    told = cut(nearest(rows, stories.select("id_cluster", F.col("total").alias("centroid"))).where(F.col("score") >= threshold))
    left = cut(rows.join(told, "id", "left_anti").select("id", "embedding"))
    founded = dedup.resolve(left, near_pairs(left, threshold)).select("id", F.coalesce("canonical", "id").alias("id_cluster"), F.coalesce("score", F.lit(1.0)).alias("score"))
    members = cut(told.unionByName(founded))
    new = _sums(rows.join(members, "id").select("id_cluster", "day", "unit"))
    both = stories.unionByName(new).groupBy("id_cluster").agg(F.collect_list("total").alias("totals"), F.sum("size").alias("size"), F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
    added = F.when(F.size("totals") == 1, F.col("totals")[0]).otherwise(F.zip_with(F.get("totals", F.lit(0)), F.get("totals", F.lit(1)), lambda x, y: x + y))
    return both.select("id_cluster", added.alias("total"), "size", "first_day", "last_day"), members


def run(spark: SparkSession, rows: DataFrame, days: list, threshold: float = THRESHOLD, stories: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(stories, members) of all slices in order; ``days``: their days, which the caller's clock knows."""
    state, found = stories if stories is not None else spark.createDataFrame([], STORIES), None
    for day in days:
        grown, members = grow(state, rows.where(F.col("day") == F.lit(day)), threshold)
        before, state = state, cut(grown)
        if hasattr(before, "cut_path"):
            drop(before)
        found = members if found is None else found.unionByName(members)
    return state, found


def goal_matches(stories: DataFrame, goals: DataFrame, least: float) -> DataFrame:
    """(id_cluster, id_goal, score): stories whose centroid is at least so near to a goal (id_goal, query_embedding)."""
    docs = stories.select(F.col("id_cluster").alias("id"), F.col("total").alias("embedding"))
    # As many as there are stories: all of them, since the threshold decides; none is ranked.
    every = vector_scores(docs, goals, 1 << 30, "id_goal")
    return every.where(F.col("score") >= least).select(F.col("id").alias("id_cluster"), "id_goal", "score")
