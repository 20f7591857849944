"""Rules around mentions of a brand: sentiment of each mention, effect on each goal."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rules

#: Characters around a mention, for its text, its mood and a goal's signal.
FRAGMENT = (80, 120)
MOOD = (160, 240)
SIGNAL = (220, 320)
MOST_MENTIONS = 12


@dataclass(frozen=True)
class GoalRules:
    """Patterns of one goal; ``open``: a mention of the brand is enough; suppressors silence signals (``quiet``) or the goal itself (``off``)."""

    goal: str
    positive: str
    negative: str
    open: bool = False
    quiet: str | None = None
    off: str | None = None


@dataclass(frozen=True)
class BrandRules:
    brand: str
    positive: str
    negative: str
    paid: str
    furniture: str | None = None
    goals: Mapping[int, GoalRules] = field(default_factory=dict)


def _has(text: Column, pattern: str | None) -> Column:
    """Whether a pattern is found, case as Unicode has it; no pattern is never found."""
    return text.rlike(rules.FLAGS + pattern) if pattern else F.lit(False)


def _spots(text: Column, pattern: str) -> Column:
    """array<struct<a, b>>: first and last + 1 character of each match, from what stands between them."""
    found = F.regexp_extract_all(text, F.lit(f"{rules.FLAGS}({pattern})"), 1)
    between = F.slice(F.split(text, f"{rules.FLAGS}(?:{pattern})"), 1, F.size(found))
    cut = F.arrays_zip(between.alias("before"), found.alias("match"))
    empty = F.array().cast("array<struct<a: int, b: int>>")

    def add(spots: Column, x: Column) -> Column:
        a = F.coalesce(F.try_element_at(spots, F.lit(-1))["b"], F.lit(0)) + F.length(x["before"])
        return F.concat(spots, F.array(F.struct(a.alias("a"), (a + F.length(x["match"])).alias("b"))))

    return F.aggregate(cut, empty, add)


def _around(text: Column, spot: Column, reach: tuple[int, int]) -> Column:
    a = F.greatest(spot["a"] - reach[0], F.lit(0))
    return text.substr(a + 1, spot["b"] + reach[1] - a)


def mentions_in(text: Column, r: BrandRules) -> Column:
    """array<struct<text, sentiment, confidence>>: distinct mentions with their mood, bad words near by before good ones.

    A null text has none.  Of mentions that read alike the first stands, MOST_MENTIONS at most.
    """

    def told(whole: Column) -> Column:
        def one(spot: Column) -> Column:
            near = _around(whole, spot, MOOD)
            mood = F.when(_has(near, r.negative), "negative").when(_has(near, r.positive), "positive").otherwise("neutral")
            shown = F.trim(F.regexp_replace(_around(whole, spot, FRAGMENT), r"(?U)\s+", " "))
            return F.struct(shown.alias("text"), mood.alias("sentiment"), F.when(mood == "neutral", 0.6).otherwise(0.7).alias("confidence"))

        return F.filter(F.transform(_spots(whole, r.brand), one), lambda x: x["text"] != "")

    def first(all_: Column) -> Column:
        return F.transform(F.array(F.transform(all_, lambda x: x["text"])), lambda texts: F.filter(all_, lambda x, k: F.array_position(texts, x["text"]) == k + 1))[0]

    # Texts and lists are elements of arrays of one, so that lambdas do not work them out again.
    made = F.transform(F.array(F.coalesce(text, F.lit(""))), told)
    return F.slice(F.transform(made, first)[0], 1, MOST_MENTIONS)


def mentions(docs: DataFrame, text: str, r: BrandRules) -> DataFrame:
    """docs with ``mentions``: array<struct<text, sentiment, confidence>>."""
    return docs.withColumn("mentions", mentions_in(F.col(text), r))


def impacts(pairs: DataFrame, r: BrandRules) -> DataFrame:
    """pairs (id, id_goal, title, content) with impact, signal_strength, confidence, is_paid; null for a goal without rules.

    Signals are looked for around mentions, in the text without furniture; what silences them,
    the goal itself and payment in the whole text.
    """
    whole = F.concat_ws("\n", F.coalesce("title", F.lit("")), F.coalesce("content", F.lit("")))
    shown = pairs.withColumn("_whole", whole)
    signal = F.regexp_replace("_whole", f"{rules.FLAGS}{r.furniture}", "") if r.furniture else F.col("_whole")
    # The text is the element of an array of one, so that the lambda does not make it again for each mention.
    around = F.transform(F.array(signal), lambda text: F.transform(_spots(text, r.brand), lambda spot: _around(text, spot, SIGNAL)))[0]
    shown = shown.withColumn("_near", around)
    cases = F.lit(None)
    for goal, g in reversed(r.goals.items()):
        off = _has(F.col("_whole"), g.off)
        loud = ~(off | _has(F.col("_whole"), g.quiet))
        about = (F.size("_near") > 0) & (F.lit(True) if g.open else ~off & _has(F.col("_whole"), g.goal))
        near = lambda p: F.exists("_near", lambda w: _has(w, p))
        impact = F.when(about & loud & near(g.negative), "negative").when(about & loud & near(g.positive), "positive").otherwise("neutral")
        cases = F.when(F.col("id_goal") == goal, F.struct(impact.alias("impact"), F.when(about, "direct").otherwise("indirect").alias("signal_strength"))).otherwise(cases)
    moved = F.col("_found.impact") != "neutral"
    found = shown.withColumn("_found", cases).select(
        *pairs.columns, "_found.impact", "_found.signal_strength", F.when(moved, 0.7).when(~moved, 0.6).alias("confidence"), F.when(moved.isNotNull(), (moved & _has(F.col("_whole"), r.paid)).cast("int")).alias("is_paid")
    )
    return found


def relevance_matrix(docs: DataFrame, goals: DataFrame, text: Column, key: str = "id") -> DataFrame:
    """(id, id_goal, relevance) of every document and goal: any keyword in the text; goals without keywords are left out.

    goals: id_goal, keywords array; a small catalog.
    """
    from .retrieval import small

    words = goals.withColumn("keywords", rules.keyword_array(F.col("keywords"))).where(F.size("keywords") > 0).select("id_goal", "keywords")
    low = docs.select(F.col(key).alias("id"), F.lower(text).alias("low"))
    return low.crossJoin(small(words)).select("id", "id_goal", F.exists("keywords", lambda w: F.contains(F.col("low"), w)).alias("relevance"))


def reset_irrelevant(labels: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Labels of irrelevant pairs set to defaults; ``changed`` tells which rows differ."""
    rel = F.coalesce("relevance", F.lit(False))
    new = {c: F.when(rel, F.col(c)).otherwise(F.lit(v)) for c, v in defaults.items()}
    changed = F.lit(False)
    for c, v in defaults.items():
        changed = changed | (~rel & ~F.col(c).eqNullSafe(F.lit(v)))
    return labels.withColumns({"changed": changed} | new)
