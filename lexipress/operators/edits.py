"""Edit distance as a second look at near-duplicate candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def within(a: Column, b: Column, most: Column) -> Column:
    """Levenshtein distance of two texts if it is at most ``most``, else null.

    Texts whose lengths differ by more are told apart without a table, and Spark fills only the
    cells of the table within ``most`` of its diagonal.
    """
    distance = F.call_function("levenshtein", a, b, most.cast("int"))
    return F.when(F.abs(F.length(a) - F.length(b)) <= most, F.when(distance >= 0, distance))


def confirmed(pairs: DataFrame, texts: DataFrame, share: float = 0.15, chars: int | None = None) -> DataFrame:
    """Pairs (a, b, …) with ``distance``, those at most ``share`` of the longer text apart; texts: id, text.

    ``chars``: compare so many first characters; a null text is in no pair.
    """
    cut_ = F.col("text") if chars is None else F.substring("text", 1, chars)
    own = texts.where("text is not null").select("id", cut_.alias("t"))
    both = pairs.join(own.select(F.col("id").alias("a"), F.col("t").alias("ta")), "a").join(own.select(F.col("id").alias("b"), F.col("t").alias("tb")), "b")
    most = F.floor(F.greatest(F.length("ta"), F.length("tb")) * share).cast("int")
    return both.withColumn("distance", within(F.col("ta"), F.col("tb"), most)).where("distance is not null").drop("ta", "tb")
