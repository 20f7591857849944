"""Rule catalogs: patterns as data, compiled to column expressions.

A pattern is a regular expression that Java takes; matching ignores case and knows all
letters of Unicode.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLAGS = "(?iuU)"
#: Fixed values of the junk rule.
MIN_BODY_HITS = 2
MAX_TERMS = 5
LEAD_CHARS = 300


@dataclass(frozen=True)
class JunkRules:
    """Junk categories in the order in which they are tried, and the guard that overrules them."""

    categories: Mapping[str, tuple[str, ...]]
    guard: tuple[str, ...] = ()


#: A small catalog in Latin letters; real ones are read from a table (see ``from_rows``).
DEMO_RULES = JunkRules(
    {
        "shouting": (r"[a-z]+!!",),
        "symbols": (r"[a-z]+[$]{3}", r"[a-z]+[%]{3}"),
        "insults": (r"idiot", r"moron", r"scum", r"pathetic"),
    },
    guard=(r"license",),
)


def from_rows(rows: Iterable[Mapping], fallback_guard: tuple[str, ...] = (), by_name: bool = True) -> JunkRules:
    """Rules of a catalog table (category, patterns, is_active, is_business_guard)."""
    active = [r for r in rows if r.get("is_active", True)]
    active = sorted(active, key=lambda r: r["category"]) if by_name else active
    guard = next((tuple(r["patterns"]) for r in active if r.get("is_business_guard")), fallback_guard)
    return JunkRules({r["category"]: tuple(r["patterns"]) for r in active if not r.get("is_business_guard")}, guard)


def alternation(patterns: Iterable[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def whole_words(patterns: Iterable[str]) -> str:
    """Any of the patterns, not inside a word."""
    return rf"{FLAGS}(?<!\w)(?:{'|'.join(patterns)})(?!\w)"


def to_java(pattern: str) -> str:
    """A pattern of another dialect: its word boundaries, and case and letters as Unicode has them."""
    return FLAGS + re.sub(r"\\[yY]", lambda m: r"\b" if m[0] == r"\y" else r"\B", pattern)


def terms(text: Column, pattern: str, most: int = MAX_TERMS) -> Column:
    """First ``most`` different matches, whatever their case, as they stand first."""
    found = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({pattern})"), 1), lambda m: F.regexp_replace(F.trim(m), r"\s+", " "))
    found = F.filter(found, lambda m: m != "")
    # A short list of what is kept is looked through for each match, never all matches for each other.
    none = F.array().cast("array<string>")
    return F.aggregate(found, none, lambda kept, m: F.when((F.size(kept) >= most) | F.exists(kept, lambda k: F.lower(k) == F.lower(m)), kept).otherwise(F.concat(kept, F.array(m))))


def with_junk(docs: DataFrame, title: str, text: str, rules: JunkRules, name: str = "junk") -> DataFrame:
    """``docs`` with struct<category, matched_terms, title_match_count, body_match_count> of the first category that fires, or null.

    A category fires on one match in the title or two different ones in the text.  Matches
    are columns of their own first, so that each pattern runs once over a text.
    """
    both = F.concat_ws("\n", F.nullif(F.col(title), F.lit("")), F.nullif(F.col(text), F.lit("")))
    allowed = F.trim(F.coalesce(F.col(text), F.lit(""))) != ""
    if rules.guard:
        allowed = allowed & ~both.rlike(whole_words(rules.guard))
    # Terms are looked for only where any category can fire and no guard stands.
    every = [p for patterns in rules.categories.values() for p in patterns]
    found = docs.withColumn("_open", allowed & both.rlike(whole_words(every)) if every else F.lit(False))
    for k, patterns in enumerate(rules.categories.values()):
        p = whole_words(patterns)
        found = found.withColumns({f"_title_{k}": F.when(F.col("_open"), terms(F.col(title), p)), f"_text_{k}": F.when(F.col("_open"), terms(F.col(text), p))})
    cases = F.when(~F.col("_open"), F.lit(None))
    for k, category in enumerate(rules.categories):
        in_title, in_text = F.col(f"_title_{k}"), F.col(f"_text_{k}")
        more = F.filter(in_text, lambda m: ~F.exists(in_title, lambda t: F.lower(t) == F.lower(m)))  # noqa: B023
        shown = F.struct(F.lit(category).alias("category"), F.slice(F.concat(in_title, more), 1, MAX_TERMS).alias("matched_terms"), F.size(in_title).alias("title_match_count"), F.size(in_text).alias("body_match_count"))
        cases = cases.when((F.size(in_title) > 0) | (F.size(in_text) >= MIN_BODY_HITS), shown)
    return found.withColumn(name, cases).select(*(F.col(f"`{c}`") for c in docs.columns), name)


def tags(text: Column, patterns: Mapping[str | int, str]) -> Column:
    """Names of the patterns that are found, in the catalog's order."""
    return F.array_compact(F.array(*(F.when(text.rlike(FLAGS + p), F.lit(k)) for k, p in patterns.items())))


def triage(docs: DataFrame, title: str, text: str, broad: Iterable[str], objects: Iterable[str], min_hits: int = 3, lead: int = LEAD_CHARS) -> DataFrame:
    """topic_hits, in_title, first_pos, in_lead, has_object, kept, hits_bucket of every document."""
    from ..functions import keys

    b, o = FLAGS + alternation(broad), FLAGS + alternation(objects)
    body = F.concat(F.coalesce(F.col(title), F.lit("")), F.lit("\n"), F.coalesce(F.col(text), F.lit("")))
    count = lambda c, p: F.regexp_count(c, F.lit(p))
    at = lambda p: F.regexp_instr(F.coalesce(F.col(text), F.lit("")), F.lit(p))
    first = F.when(at(b) > 0, at(b)).when(at(o) > 0, at(o)).otherwise(0) - 1
    out = docs.withColumns(
        {
            "topic_hits": count(body, b) + count(body, o),
            "in_title": F.coalesce(F.col(title).rlike(b) | F.col(title).rlike(o), F.lit(False)),
            "first_pos": first,
            "has_object": body.rlike(o),
        }
    )
    out = out.withColumn("in_lead", (F.col("first_pos") >= 0) & (F.col("first_pos") < lead))
    kept = F.col("has_object") | F.col("in_title") | (F.col("topic_hits") >= min_hits) | (F.col("in_lead") & (F.col("topic_hits") >= 2))
    return out.withColumn("kept", kept).withColumn("hits_bucket", keys.hits_bucket(F.col("topic_hits")))


def any_keyword(text: Column, words: Column) -> Column:
    """Whether any of an array of lower-case keywords stands in the text."""
    # Lower case is made once a text, as the element of an array, not once a keyword.
    return F.exists(F.array(F.lower(text)), lambda t: F.exists(words, lambda w: F.contains(t, w)))


def keyword_array(words: Column) -> Column:
    """Trimmed, lower-case, distinct keywords."""
    return F.array_distinct(F.filter(F.transform(words, lambda w: F.lower(F.trim(w))), lambda w: w != ""))


def corpus_filter(docs: DataFrame, text: str, source_type: str, words: list[str], types: list[str]) -> DataFrame:
    """``drop_reason``: keyword_miss before source_type_miss, null if kept; no keywords pass all."""
    from ..functions import keys

    low = [w.strip().lower() for w in words if w and w.strip()]
    hit = reduce(lambda a, b: a | b, (F.contains(F.lower(F.col(text)), F.lit(w)) for w in low)) if low else F.lit(True)
    allowed = keys.source_type_key(F.col(source_type)).isin(*(t.strip().lower() for t in types)) if types else F.lit(True)
    return docs.withColumn("drop_reason", F.when(~F.coalesce(hit, F.lit(False)), "keyword_miss").when(~F.coalesce(allowed, F.lit(False)), "source_type_miss"))


def all_of(conditions: Iterable[Column | None]) -> Column:
    """Conjunction of the predicates that are given; absent ones pass."""
    return reduce(lambda a, b: a & b, (c for c in conditions if c is not None), F.lit(True))


def between_optional(column: Column, low=None, high=None) -> Column:
    return all_of([column >= low if low is not None else None, column <= high if high is not None else None])


def queue_row(docs: DataFrame, title: str, text: str, controls: Mapping[int, str], head: int = 2000) -> DataFrame:
    """``docs`` with text_head, text_length, truncated and control_objects: what a labelling queue shows of a document.

    Controls are looked for in the whole text, however little of it is shown.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    whole = F.concat_ws(" ", F.coalesce(F.col(title), F.lit("")), body)
    return docs.withColumns({"text_head": F.substring(body, 1, head), "text_length": F.length(body), "truncated": F.length(body) > head, "control_objects": F.array_sort(tags(whole, controls))})
