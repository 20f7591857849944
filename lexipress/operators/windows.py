"""Pair scores over text windows: a scorer reads windows of a document beside the query, the best one counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import bounded_batches, cut

#: Characters of a window, and from one window's begin to the next.
SIZE = 2000
STRIDE = 1500
BATCH = 32

#: A query and texts to as many scores.
PairScorer = Callable[[str, list[str]], list[float]]


def text_windows(text: Column, size: int = SIZE, stride: int = STRIDE) -> Column:
    """array<struct<window, text>> of a text, from 0: each begins ``stride`` after the last, the last one ends the text; an empty text is one window."""
    last = F.greatest(F.lit(0), F.ceil((F.length(text) - size) / stride)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.struct(k.alias("window"), F.substring(text, k * stride + 1, F.lit(size)).alias("text")))


def window_scores(candidates: DataFrame, queries: DataFrame, docs: DataFrame, scorer: PairScorer, model: str, cache: DataFrame, size: int = SIZE, stride: int = STRIDE, batch: int = BATCH) -> tuple[DataFrame, DataFrame]:
    """(scores, new): scores (id_object, id, score, window) of candidates (id_object, id), and the rows that are new to the cache.

    queries: id_object, query.  docs: id, text.  cache: id_object, id, model, window, score; only
    rows of ``model`` count, and what they have is not asked for.  The scorer is called here, in
    batches of one object; a batch that fails, or is answered for another number of texts, has no
    scores.  A document counts when all its windows have one: the best, the first of equal ones.
    """
    bounded_batches(candidates.sparkSession, 1024)
    texts = docs.select("id", F.coalesce("text", F.lit("")).alias("text")).select("id", F.explode(text_windows(F.col("text"), size, stride)).alias("w")).select("id", "w.window", "w.text")
    wanted = candidates.select("id_object", "id").distinct().join(texts, "id")
    known = cache.where(F.col("model") == model).select("id_object", "id", "window", "score")
    todo = wanted.join(known, ["id_object", "id", "window"], "left_anti").join(queries.select("id_object", "query"), "id_object")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for (id_object, query), group in part.groupby(["id_object", "query"], sort=True):
                for k in range(0, len(group), batch):
                    own = group.iloc[k : k + batch]
                    try:
                        got = [float(x) for x in scorer(query, own["text"].tolist())]
                    except Exception:  # noqa: BLE001  an external call may fail in any way
                        continue
                    if len(got) == len(own):
                        yield pd.DataFrame({"id_object": id_object, "id": own["id"], "window": own["window"], "score": got})

    fresh = cut(todo.repartition("id_object", "id").mapInPandas(run, "id_object int, id long, window int, score double"))
    have = wanted.select("id_object", "id", "window").join(known.unionByName(fresh), ["id_object", "id", "window"], "left")
    best = F.max(F.struct("score", (-F.col("window")).alias("first")))
    scores = have.groupBy("id_object", "id").agg(best.alias("m"), F.count("*").alias("n"), F.count("score").alias("told")).where("n = told")
    return scores.select("id_object", "id", F.col("m.score").alias("score"), (-F.col("m.first")).alias("window")), fresh.withColumn("model", F.lit(model))
