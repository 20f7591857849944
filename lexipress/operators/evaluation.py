"""Retrieval evaluation: truth, recall, precision, sweeps, agreement, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import keys

DEPTHS = (10, 50, 100, 500)
ACCEPTED_RECALL = 0.70
MIN_POSITIVES = 5
STEPS = 20


def truth(labels: DataFrame, relation: str = "event", min_positives: int = 1, exclude: list[int] | None = None) -> DataFrame:
    """(id_object, id) of labels (id, label_objects, mention_objects): events, or events and mentions."""
    objects = F.col("label_objects") if relation == "event" else F.array_union(F.coalesce("label_objects", F.array().cast("array<int>")), F.coalesce("mention_objects", F.array().cast("array<int>")))
    rows = labels.select(F.explode(objects).alias("id_object"), "id").distinct()
    if exclude:
        rows = rows.where(~F.col("id_object").isin(exclude))
    enough = rows.groupBy("id_object").agg(F.count("*").alias("n")).where(F.col("n") >= min_positives)
    return rows.join(enough.select("id_object"), "id_object", "left_semi")


def recall_at(ranked: DataFrame, positives: DataFrame, depths: tuple[int, ...] = DEPTHS, per: str = "id_object") -> DataFrame:
    """(object, positives, recall_at_<k>…): share of positives among the first k; objects without any rank count too."""
    hit = positives.select(per, "id").join(ranked.select(per, "id", "rank"), [per, "id"], "left")
    out = [(F.count_if(F.col("rank") <= k) / F.count("*")).alias(f"recall_at_{k}") for k in depths]
    return hit.groupBy(per).agg(F.count("*").alias("positives"), *out)


def set_quality(selected: DataFrame, positives: DataFrame, labelled: DataFrame, candidates: DataFrame | None = None, per: str = "id_object") -> DataFrame:
    """selected, found, known, unknown, recall, precision among labelled, ceiling of each object of the truth."""
    pos = positives.select(per, "id", F.lit(1).alias("p"))
    sel = selected.select(per, "id").distinct().withColumn("s", F.lit(1))
    rows = pos.join(sel, [per, "id"], "full").join(labelled.select("id").distinct().withColumn("l", F.lit(1)), "id", "left")
    n = lambda c: F.count_if(c)
    p, s, known = F.col("p").isNotNull(), F.col("s").isNotNull(), F.col("l").isNotNull() | F.col("p").isNotNull()
    agg = rows.groupBy(per).agg(n(p).alias("positives"), n(s).alias("selected"), n(p & s).alias("found"), n(s & known).alias("known"), n(s & ~known).alias("unknown")).where("positives > 0")
    agg = agg.withColumn("recall", F.col("found") / F.col("positives")).withColumn("precision", F.coalesce(F.try_divide("found", "known"), F.lit(0.0)))
    if candidates is None:
        return agg
    reach = pos.join(candidates.select(per, "id").distinct(), [per, "id"], "left_semi").groupBy(per).agg(F.count("*").alias("reachable"))
    return agg.join(reach, per, "left").withColumn("ceiling", F.coalesce("reachable", F.lit(0)) / F.col("positives")).drop("reachable")


def macro(rows: DataFrame, *columns: str) -> DataFrame:
    """Means over objects."""
    return rows.agg(F.count("*").alias("objects"), *(F.avg(c).alias(c) for c in columns))


def threshold_sweep(scores: DataFrame, positives: DataFrame, labelled: DataFrame, steps: int = STEPS, per: str = "id_object") -> DataFrame:
    """(step, threshold, recall, precision, selected): macro means at thresholds from the least to the largest score.

    Recall is taken of the positives that have a score; precision of labelled ones.
    """
    s = scores.select(per, "id", "score").join(positives.select(per, "id", F.lit(1).alias("p")), [per, "id"], "left").join(labelled.select("id").distinct().withColumn("l", F.lit(1)), "id", "left")
    ends = s.agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    grid = ends.select(F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("step"), "lo", "hi").select("step", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("step") / steps).alias("threshold"))
    over = F.col("score") >= F.col("threshold")  # the grid has steps + 1 rows
    each = s.crossJoin(F.broadcast(grid)).groupBy("step", "threshold", per).agg(
        F.count("p").alias("reachable"), F.count_if(over & F.col("p").isNotNull()).alias("found"), F.count_if(over & (F.col("l").isNotNull() | F.col("p").isNotNull())).alias("known"), F.count_if(over).alias("selected")
    )
    each = each.where("reachable > 0")
    return each.groupBy("step", "threshold").agg(F.avg(F.col("found") / F.col("reachable")).alias("recall"), F.avg(F.coalesce(F.try_divide("found", "known"), F.lit(0.0))).alias("precision"), F.avg("selected").alias("selected"))


def best_threshold(sweep: DataFrame, least_recall: float = ACCEPTED_RECALL, per: list[str] | None = None) -> DataFrame:
    """The sweep's row of highest precision with enough recall, the lowest threshold of equal ones."""
    order = W.partitionBy(*(per or [F.lit(0)])).orderBy(F.desc("precision"), "threshold")
    return sweep.where(F.col("recall") >= least_recall).withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def object_thresholds(scores: DataFrame, positives: DataFrame, labelled: DataFrame, per: str = "id_object") -> DataFrame:
    """(object, threshold, recall, precision): every score of an object is a threshold; the best is kept."""
    s = scores.select(per, "id", "score").join(positives.select(per, "id", F.lit(1).alias("p")), [per, "id"], "left").join(labelled.select("id").distinct().withColumn("l", F.lit(1)), "id", "left")
    down = W.partitionBy(per).orderBy(F.desc("score"))  # a range: equal scores pass together
    run = s.select(per, F.col("score").alias("threshold"), F.count("p").over(down).alias("found"), F.count(F.coalesce("l", "p")).over(down).alias("known"), F.count("p").over(W.partitionBy(per)).alias("reachable")).where("reachable > 0").distinct()
    rows = run.withColumn("recall", F.col("found") / F.col("reachable")).withColumn("precision", F.coalesce(F.try_divide("found", "known"), F.lit(0.0)))
    return best_threshold(rows, per=[per]).select(per, "threshold", "recall", "precision")


#: Equal ranges between a group's least and greatest value, by which its values are counted first.
RANGES = 1024


def values_at(rows: DataFrame, per: list[str], value: str, places: dict[str, Column]) -> DataFrame:
    """(per, n, name, …): of each group's sorted values those at some places, without holding a group in one task.

    ``places``: by name, the place from 0 as an expression of ``n``, the number of the group's
    values; beyond the last it is null.  Nulls are no values.  Values are counted by ``RANGES``
    ranges of their group; only the ranges that places fall into are sorted, equal values as one.
    """
    x = rows.where(F.col(value).isNotNull()).select(*per, F.col(value).alias("_v"))
    ends = x.groupBy(*per).agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count("*").alias("n"))
    share = (F.col("_v") - F.col("_low")) / F.nullif(F.col("_high") - F.col("_low"), F.lit(0))
    range_ = F.least(F.lit(RANGES - 1), F.floor(F.coalesce(share, F.lit(0)) * RANGES)).cast("int")
    counted = x.groupBy(*per, "_v").agg(F.count("*").alias("_m")).join(ends, per).withColumn("_r", range_)
    per_range = counted.groupBy(*per, "_r").agg(F.sum("_m").alias("_c"))
    before = F.coalesce(F.sum("_c").over(W.partitionBy(*per).orderBy("_r").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    wanted = ends.select(*per, "n", F.explode(F.array(*(F.struct(F.lit(name).alias("name"), at.cast("long").alias("at")) for name, at in places.items()))).alias("_p")).select(*per, "_p.name", "_p.at")
    held = per_range.withColumn("_b", before).join(wanted, per).where((F.col("at") >= F.col("_b")) & (F.col("at") < F.col("_b") + F.col("_c")))
    inside = held.select(*per, "_r", "name", (F.col("at") - F.col("_b")).alias("_at")).join(counted.select(*per, "_r", "_v", "_m"), [*per, "_r"])
    upto = F.sum("_m").over(W.partitionBy(*per, "name").orderBy("_v"))
    found = inside.withColumn("_u", upto).where((F.col("_u") > F.col("_at")) & (F.col("_u") - F.col("_m") <= F.col("_at")))
    columns = [F.max(F.when(F.col("name") == name, F.col("_v"))).alias(name) for name in places]
    return ends.select(*per, "n").join(found.groupBy(*per).agg(*columns), per, "left")


def middle() -> Column:
    """The place of the middle value, of two the upper: no mean is taken."""
    return F.floor(F.col("n") / 2)


def nearest(q: float) -> Column:
    """The place min(n - 1, int(q * n))."""
    return F.least(F.col("n") - 1, F.floor(F.col("n") * q))


def separation(scores: DataFrame, positives: DataFrame, labelled: DataFrame, per: str = "id_object") -> DataFrame:
    """(object, n_pos, n_neg, median_pos, median_neg, gap, overlap): how well scores part positives from labelled negatives."""
    s = scores.select(per, "id", "score").join(positives.select(per, "id", F.lit(True).alias("p")), [per, "id"], "left").join(labelled.select("id").distinct().withColumn("l", F.lit(True)), "id", "left")
    pos, neg = F.col("p").isNotNull(), F.col("p").isNull() & F.col("l").isNotNull()
    of_pos, of_neg = (values_at(s.where(side), [per], "score", {f"median_{name}": middle()}).withColumnRenamed("n", f"n_{name}") for side, name in ((pos, "pos"), (neg, "neg")))
    m = of_pos.join(of_neg, per)
    over = s.where(neg).join(m.select(per, "median_pos"), per).groupBy(per).agg((F.count_if(F.col("score") >= F.col("median_pos")) / F.count("*")).alias("overlap"))
    return m.join(over, per).withColumn("gap", F.col("median_pos") - F.col("median_neg"))


def rerank_delta(before: DataFrame, after: DataFrame, positives: DataFrame, depths: tuple[int, ...] = DEPTHS, per: str = "id_object") -> DataFrame:
    """(object, k, before, after, delta) of recall at each depth."""
    a, b = recall_at(before, positives, depths, per), recall_at(after, positives, depths, per)
    long = lambda d, name: d.select(per, F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"recall_at_{k}").alias(name)) for k in depths))).alias("x")).select(per, "x.*")
    return long(a, "before").join(long(b, "after"), [per, "k"]).withColumn("delta", F.col("after") - F.col("before"))


def gate(recalls: DataFrame, least: float = ACCEPTED_RECALL, recall: str = "recall") -> DataFrame:
    """(objects, mean_recall, passed): whether the mean recall is accepted."""
    return recalls.agg(F.count("*").alias("objects"), F.avg(recall).alias("mean_recall")).withColumn("passed", F.coalesce(F.col("mean_recall") >= least, F.lit(False)))


def agreement(model: DataFrame, regex: DataFrame, per: str = "id_object") -> DataFrame:
    """(object, both, model_only, regex_only) of two sets of (object, id)."""
    j = model.select(per, "id", F.lit(1).alias("m")).distinct().join(regex.select(per, "id", F.lit(1).alias("r")).distinct(), [per, "id"], "full")
    m, r = F.col("m").isNotNull(), F.col("r").isNotNull()
    return j.groupBy(per).agg(F.count_if(m & r).alias("both"), F.count_if(m & ~r).alias("model_only"), F.count_if(~m & r).alias("regex_only"))


def control_check(controls: DataFrame, labels: DataFrame, per: str = "id_object") -> DataFrame:
    """(object, found, confirmed, strict, pct): documents with an unmistakable name, and how many are labelled so.

    controls: object, id; labels: id, label_objects, mention_objects.  pct is a whole number, cut off.
    """
    j = controls.join(labels, "id")
    strict = F.array_contains("label_objects", F.col(per))
    any_of = strict | F.coalesce(F.array_contains("mention_objects", F.col(per)), F.lit(False))
    g = j.groupBy(per).agg(F.count("*").alias("found"), F.count_if(any_of).alias("confirmed"), F.count_if(strict).alias("strict"))
    return g.withColumn("pct", F.expr("confirmed * 100 div found"))


def consistency(first: DataFrame, second: DataFrame) -> DataFrame:
    """(n, same_order, same_set) of the label_objects of two passes over (id, label_objects)."""
    j = first.select("id", F.col("label_objects").alias("a")).join(second.select("id", F.col("label_objects").alias("b")), "id")
    return j.agg(F.count("*").alias("n"), F.count_if(F.col("a") == F.col("b")).alias("same_order"), F.count_if(F.array_sort(F.array_distinct("a")) == F.array_sort(F.array_distinct("b"))).alias("same_set"))


def stratified(rows: DataFrame, stratum: str, size: int, key: str = "id", seed: int = 0) -> DataFrame:
    """Up to ``size`` rows of each stratum, the same for a seed."""
    order = W.partitionBy(stratum).orderBy(keys.drawn(key, seed), key)
    return rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= size).drop("_n")


def cutoff_sweep(ranked: DataFrame, keyword: DataFrame, vetoed: DataFrame, positives: DataFrame, grid: list[tuple[int, int, float]], per: str = "id_object") -> DataFrame:
    """(min_keep, max_keep, min_ratio, selected, recall, precision): the same candidates under each cut-off."""
    from functools import reduce

    from .retrieval import adaptive_cutoff

    parts = []
    for lo, hi, ratio in grid:
        cut = adaptive_cutoff(ranked, lo, hi, ratio, per)
        sel = ranked.join(cut, per).where("rank <= cutoff").select(per, "id").union(keyword.select(per, "id")).distinct().join(vetoed, [per, "id"], "left_anti")
        q = set_quality(sel, positives, sel.select("id"), per=per)
        parts.append(macro(q, "selected", "recall", "precision").select(F.lit(lo).alias("min_keep"), F.lit(hi).alias("max_keep"), F.lit(ratio).alias("min_ratio"), "selected", "recall", "precision"))
    return reduce(DataFrame.unionByName, parts)
