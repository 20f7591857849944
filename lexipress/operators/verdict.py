"""One verdict for every raw post: empty, foreign, junk, duplicate or kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.lineage import bounded_batches, cut, spread
from . import dedup, rules


def kept_rows(drop_reason: str = "drop_reason", is_duplicate: str = "is_duplicate") -> Column:
    """Live rows: not dropped, no duplicate."""
    return F.col(drop_reason).isNull() & ~F.col(is_duplicate)


def embeddable(embedding: str = "embedding", content: str = "clean_content") -> Column:
    return kept_rows() & F.col(embedding).isNull() & F.col(content).isNotNull()


def is_junk(drop_reason: str = "drop_reason") -> Column:
    return F.startswith(F.col(drop_reason), F.lit("junk:"))


def pending(raw: DataFrame, verdicts: DataFrame, key: str = "id_raw_post", limit: int | None = None) -> DataFrame:
    """Raw posts without a verdict, in id order if limited."""
    left = raw.join(verdicts.select(key), key, "left_anti")
    return left.orderBy(key).limit(limit) if limit is not None else left


def cleaned(raw: DataFrame, native: bool = False) -> DataFrame:
    """raw (id_raw_post, time_post, title, content) with clean_title and clean_text.

    native: without NFKC and entities, all in the JVM.
    """
    if native:
        chain = lambda c: T.cut_furniture(T.tidy_spaces(T.strip_tags(F.coalesce(c, F.lit("")))))
        return raw.withColumn("clean_title", F.nullif(chain(F.col("title")), F.lit(""))).withColumn("clean_text", chain(F.col("content")))
    return raw.withColumn("clean_title", T.clean_title("title")).withColumn("clean_text", T.clean_text("content"))


def first_reason(clean: DataFrame, junk_rules: rules.JunkRules, target: str, other: str, names: tuple[str, str]) -> DataFrame:
    """clean with drop_reason of the checks that look at one post: empty_clean_text, non_<language>, junk:<category>."""
    lang = T.language(F.col("clean_text"), target, other, names)
    reason = F.when(F.col("clean_text") == "", "empty_clean_text").when(T.foreign(F.col("clean_text"), lang, target, other, names[0]), "non_russian" if names[0] == "ru" else f"non_{names[0]}").otherwise(F.concat(F.lit("junk:"), F.col("junk.category")))
    return rules.with_junk(clean, "clean_title", "clean_text", junk_rules).withColumn("lang", lang).withColumn("drop_reason", reason)


def verdicts(raw: DataFrame, junk_rules: rules.JunkRules = rules.DEMO_RULES, target: str = "а-яё", other: str = "a-z", names: tuple[str, str] = ("ru", "en"), threshold: float = dedup.THRESHOLD, index: dedup.NearIndex | None = None, run: str = "0", native: bool = False) -> DataFrame:
    """id_raw_post, time_post, drop_reason, is_duplicate, clean_content, content_hash, dup_score, id_canonical.

    ``raw``: id_raw_post, time_post, title, content.  ``index``: kept posts of earlier runs,
    the only originals besides the kept posts of this run, which are added to it under the
    name ``run``; a run in slices gives what one run over all gives, if slices follow the
    ids, and cleans and shingles new posts only.  Duplicates carry drop_reason 'duplicate'.
    """
    bounded_batches(raw.sparkSession)
    clean = first_reason(cleaned(spread(raw), native), junk_rules, target, other, names)
    clean = cut(clean.select("id_raw_post", "time_post", "clean_title", "clean_text", "drop_reason"))
    alive = clean.where("drop_reason is null").select(F.col("id_raw_post").alias("id"), "time_post", T.joined_content(F.col("clean_title"), F.col("clean_text")).alias("clean_content"), T.exact_hash(F.col("clean_title"), F.col("clean_text")).alias("content_hash"))
    alive = cut(alive)
    found = dedup.near_duplicates(alive, threshold, index, run)
    live = alive.join(found, "id").select(
        F.col("id").alias("id_raw_post"), "time_post",
        F.when(~F.col("kept"), "duplicate").alias("drop_reason"), (~F.col("kept")).alias("is_duplicate"),
        F.when(F.col("kept"), F.col("clean_content")).alias("clean_content"), F.when(F.col("kept"), F.col("content_hash")).alias("content_hash"),
        F.round("score", 3).alias("dup_score"), F.col("canonical").alias("id_canonical"),
    )
    null = lambda kind: F.lit(None).cast(kind)
    dropped = clean.where("drop_reason is not null").select("id_raw_post", "time_post", "drop_reason", F.lit(False).alias("is_duplicate"), null("string").alias("clean_content"), null("string").alias("content_hash"), null("double").alias("dup_score"), null("long").alias("id_canonical"))
    return live.unionByName(dropped)


def with_entry(rows: DataFrame) -> DataFrame:
    """What the near-duplicate search needs of rows (id, clean_content), signatures too."""
    return dedup.entries(rows, with_signature=True)


def clean_step(rows: DataFrame, target: str = "а-яё", other: str = "a-z", names: tuple[str, str] = ("ru", "en")) -> DataFrame:
    """(id, clean_title, clean_text, lang, status, reason) of rows (id, title, text, payload): the cleaning step by itself, for exports.

    A post without a text of its own has that of its JSON payload.  status: cleaned, failed
    (nothing is left) or filtered_out (another language); ids are unique.
    """
    own = F.when(F.trim(F.coalesce("text", F.lit(""))) != "", F.col("text"))
    bare = rows.select("id", "title", own.alias("own"), "payload")
    fallback = T.payload_texts(bare.where("own is null").select("id", "payload")).withColumnRenamed("text", "other")
    whole = bare.join(fallback, "id", "left").select("id", "title", F.coalesce("own", "other").alias("content"))
    clean = cleaned(spread(whole)).select("id", "clean_title", "clean_text").withColumn("lang", T.language(F.col("clean_text"), target, other, names))
    away = T.foreign(F.col("clean_text"), F.col("lang"), target, other, names[0])
    reason = F.when(F.col("clean_text") == "", "empty_clean_text").when(away, f"non_{'russian' if names[0] == 'ru' else names[0]}_text")
    status = F.when(F.col("clean_text") == "", "failed").when(away, "filtered_out").otherwise("cleaned")
    return clean.select("*", status.alias("status"), reason.alias("reason"))


def agreement(old: DataFrame, new: DataFrame, key: str = "id_raw_post", tolerance: float = 0.005) -> DataFrame:
    """n, mismatches, rate, passed of two verdict tables, compared by category."""
    category = lambda d, r: F.when(F.col(d), "duplicate").otherwise(F.coalesce(r, F.lit("kept")))
    a = old.select(key, category("is_duplicate", F.col("drop_reason")).alias("a"))
    b = new.select(key, category("is_duplicate", F.col("drop_reason")).alias("b"))
    both = a.join(b, key).agg(F.count("*").alias("n"), F.count_if(F.col("a") != F.col("b")).alias("mismatches"))
    return both.withColumn("rate", F.col("mismatches") / F.nullif(F.col("n"), F.lit(0))).withColumn("passed", F.coalesce(F.col("rate") <= tolerance, F.lit(True)))
