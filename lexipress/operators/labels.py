"""The labelling chain: gate, staged calls to an injected labeller, checkpoints, roll-ups."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys, payloads
from ..plans.lineage import cut

#: Words of a row of CSV predictions.
IMPACT_CODES = {"neutral": 0, "positive": 1, "negative": 2}
SIGNAL_TEXTS = {"direct": "direct", "indirect": "indirect"}

ENRICHED = "array<struct<source_kind: string, source_value: string, importance: string, include: boolean, reason: string>>"


def ranking_rows(goals: DataFrame, column: str = "source_rankings") -> DataFrame:
    """(id_goal, source_kind, source_value, source_key, rank_score, rank_position, include, reason) of JSON rankings.

    Without an own ``include`` a source is included unless its importance is under 2.
    """
    rows = goals.select("id_goal", F.posexplode(F.from_json(column, ENRICHED)).alias("at", "r"))
    kind = F.coalesce(F.nullif(keys.ranking_kind(F.col("r.source_kind")), F.lit("")), F.lit("source_type"))
    rows = rows.withColumn("source_kind", kind).withColumn("rank_score", keys.importance(F.col("r.importance"))).withColumn("source_value", F.trim("r.source_value"))
    rows = rows.withColumn("source_key", keys.ranking_key(F.col("source_kind"), F.col("source_value"))).where("source_key <> ''")
    include = F.coalesce(F.col("r.include"), F.col("rank_score").isNull() | (F.col("rank_score") >= 2))
    return rows.select("id_goal", "source_kind", "source_value", "source_key", "rank_score", (F.col("at") + 1).alias("rank_position"), include.alias("include"), "r.reason")


def ranking_gate(docs: DataFrame, rankings: DataFrame, goals: DataFrame, ignore_types: bool = True) -> DataFrame:
    """(id, id_goal, allowed, reason) of every document and goal.

    docs: id and arrays source, domain, source_type of keys.  Exclusion beats inclusion; a
    goal without rankings allows all, and so does one of source types alone for a document
    that has none (``ignore_types``); otherwise what matches nothing is not allowed.
    """
    from .retrieval import small

    known = docs.select("id", F.explode(F.array(*(F.struct(F.lit(k).alias("source_kind"), F.col(k).alias("all")) for k in keys.RANKING_KINDS))).alias("x")).select("id", "x.source_kind", F.explode("x.all").alias("source_key"))
    met = known.join(rankings, ["source_kind", "source_key"]).groupBy("id", "id_goal").agg(F.bool_or(~F.col("include")).alias("excluded"), F.bool_or("include").alias("included"))
    shape = rankings.groupBy("id_goal").agg(F.bool_and(F.col("source_kind") == "source_type").alias("types_only"))
    pairs = docs.select("id", (F.size("source_type") > 0).alias("has_type")).crossJoin(small(goals.select("id_goal").join(shape, "id_goal", "left")))
    j = pairs.join(met, ["id", "id_goal"], "left")
    ignored = F.lit(ignore_types) & F.col("types_only") & ~F.col("has_type")
    reason = F.when(F.col("types_only").isNull(), "no_rankings_for_goal").when(ignored, "ignored_source_type_rankings").when(F.col("excluded"), "excluded_by_source_ranking").when(F.col("included"), "included_by_source_ranking").otherwise("no_matching_source_ranking")
    return j.select("id", "id_goal", reason.alias("reason")).withColumn("allowed", ~F.col("reason").isin("excluded_by_source_ranking", "no_matching_source_ranking"))


Labeller = Callable[[str, dict], str]


def run_step(rows: DataFrame, step: str, labeller: Labeller, check: Callable[[dict, dict], object], saved: DataFrame | None = None, retries: int = 3) -> DataFrame:
    """(id, id_goal, step, payload, error) of one step, for rows (id, id_goal, text, …).

    Saved payloads of the same document, goal and step are used again and call nobody.  A
    reply that breaks its contract is asked for again, ``retries`` times at most.  Calls happen
    here, once a row: later actions read what was written.
    """
    keys_ = ["id", "id_goal"]
    todo = rows if saved is None else rows.join(saved.where(F.col("step") == step).select(*keys_), keys_, "left_anti")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for row in part.to_dict("records"):
                payload, error = None, None
                for _ in range(max(1, retries)):
                    try:
                        payload, error = json.dumps(check(payloads.unpack(labeller(step, row)), row), ensure_ascii=False), None
                        break
                    except Exception as e:  # noqa: BLE001  an external call may fail in any way
                        error = str(e)
                out.append((row["id"], row["id_goal"], payload, error))
            yield pd.DataFrame(out, columns=["id", "id_goal", "payload", "error"]).astype({"id": "int64", "id_goal": "int32", "payload": object, "error": object})

    done = cut(todo.mapInPandas(run, "id long, id_goal int, payload string, error string").withColumn("step", F.lit(step)))
    if saved is None:
        return done.select("id", "id_goal", "step", "payload", "error")
    old = saved.where(F.col("step") == step).join(rows.select(*keys_), keys_, "left_semi")
    return old.select("id", "id_goal", "step", "payload", F.lit(None).cast("string").alias("error")).unionByName(done)


def label_documents(docs: DataFrame, goals: DataFrame, gate: DataFrame, labeller: Labeller, saved: DataFrame | None = None) -> dict[str, DataFrame]:
    """Relevance once a document, impact for each relevant goal, paid flag and tonality only where it moves.

    docs: id, text.  gate: what ``ranking_gate`` returns.
    """
    allowed = gate.where("allowed").select("id", "id_goal")
    known = allowed.groupBy("id").agg(F.sort_array(F.collect_set("id_goal")).alias("goals"))
    asked = docs.select("id", "text").join(known, "id").withColumn("id_goal", F.lit(0))
    relevance = run_step(asked, "relevance", labeller, lambda p, r: payloads.relevance(p, r["text"] or "", list(r["goals"])), saved)
    pairs = relevance.where("payload is not null").select("id", F.explode(F.from_json("payload", "matches array<struct<kr_id: int>>")["matches"]["kr_id"]).alias("id_goal"))
    impact = run_step(pairs.join(docs.select("id", "text"), "id"), "impact", labeller, lambda p, r: payloads.impact(p, r["text"] or ""), saved)
    moved = impact.where(F.get_json_object("payload", "$.impact").isin("positive", "negative")).select("id", "id_goal").join(docs.select("id", "text"), "id")
    paid = run_step(moved, "paid", labeller, lambda p, r: payloads.paid_flag(p), saved)
    tone = run_step(moved, "tonality", labeller, lambda p, r: payloads.tonality(p, r["text"] or ""), saved)
    return {"relevance": relevance, "impact": impact, "paid": paid, "tonality": tone}


def roll_up(docs: DataFrame, impacts: DataFrame) -> DataFrame:
    """(id, status, reason, n_positive, n_negative, n_neutral) of each document."""
    n = impacts.groupBy("id").agg(*(F.count_if(F.col("impact") == k).alias(f"n_{k}") for k in payloads.IMPACTS))
    j = docs.select("id").join(n, "id", "left").na.fill(0, [f"n_{k}" for k in payloads.IMPACTS])
    total = F.col("n_positive") + F.col("n_negative") + F.col("n_neutral")
    return j.withColumn("status", F.when(total > 0, "labelled").otherwise("skipped")).withColumn("reason", F.when(total == 0, "no_relevant_goals"))


def semantics_roll_up(docs: DataFrame, labels: DataFrame, found: DataFrame) -> DataFrame:
    """(id, status, reason, label_count, entity_counts, event_count) of each document (id) after its semantics step.

    labels: id, a row a label.  found: id, entities (array of names by group), events (array).  A
    document without labels has failed, whatever was found; one with labels is enriched once
    something was stored for it, and pending until then.
    """
    counts = F.struct(*(F.coalesce(F.size(F.col("entities")[g]), F.lit(0)).alias(g) for g in payloads.ENTITY_GROUPS))
    stored = found.select("id", F.lit(True).alias("_there"), counts.alias("entity_counts"), F.coalesce(F.size("events"), F.lit(0)).alias("event_count"))
    j = docs.select("id").join(labels.groupBy("id").agg(F.count("*").alias("label_count")), "id", "left").na.fill(0, ["label_count"]).join(stored, "id", "left")
    status = F.when(F.col("label_count") == 0, "failed").when(F.col("_there"), "enriched").otherwise("pending")
    shown = lambda c: F.when(status == "enriched", F.col(c)).alias(c)
    return j.select("id", status.alias("status"), F.when(F.col("label_count") == 0, "missing_document_labels").alias("reason"), "label_count", shown("entity_counts"), shown("event_count"))


def next_stage(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that go on: those with a label."""
    return docs.join(labels.select("id"), "id", "left_semi")


def label_context(labels: DataFrame, goals: DataFrame) -> DataFrame:
    """(id, context): a document's labels, one a line, in the order of goals."""
    line = F.format_string("%d. %s: %s", F.col("id_goal"), F.col("goal"), F.col("impact"))
    rows = labels.join(goals, "id_goal").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("id_goal", line.alias("line")))).alias("all"))
    return rows.select("id", F.array_join(F.transform("all", lambda x: x["line"]), "\n").alias("context"))


def goal_catalog(goals: DataFrame) -> DataFrame:
    """One row: all active goals, one a line, in order."""
    rows = goals.where("active").agg(F.sort_array(F.collect_list(F.struct("id_goal", F.concat_ws(". ", F.col("id_goal").cast("string"), "goal").alias("line")))).alias("all"))
    return rows.select(F.array_join(F.transform("all", lambda x: x["line"]), "\n").alias("catalog"), F.size("all").alias("n"))


def missing_enrichment(goals: DataFrame, trial: str = "trial_run") -> DataFrame:
    return goals.where(F.col("enrichment").isNull() | (F.col("enriched_by") == trial))


def predictions(rows: DataFrame) -> DataFrame:
    """rows (impact, signal_strength) with impact_code (0 if unknown) and signal_text."""
    return rows.withColumn("impact_code", F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in IMPACT_CODES.items() for x in kv)), F.col("impact")), F.lit(0))).withColumn("signal_text", F.coalesce(keys.mapped(F.col("signal_strength"), SIGNAL_TEXTS), F.lit("")))


def cleaned_labels(replies: DataFrame, queue: DataFrame, catalog: set[int]) -> DataFrame:
    """(id, label_objects, mention_objects, confidence) of replies (id, events, mentions, confidence).

    Unknown documents and objects are dropped, an event is no mention, confidence is high, low or null.
    """
    known = F.array(*(F.lit(x) for x in sorted(catalog)))
    e = F.array_sort(F.array_intersect(F.coalesce("events", F.array().cast("array<int>")), known))
    m = F.array_sort(F.array_except(F.array_intersect(F.coalesce("mentions", F.array().cast("array<int>")), known), e))
    return replies.join(queue.select("id"), "id", "left_semi").select("id", e.alias("label_objects"), m.alias("mention_objects"), F.when(F.col("confidence").isin("high", "low"), F.col("confidence")).alias("confidence"))


def call_log(step: str, started: float, ended: float, prompt: str, reply: str | None, error: str | None) -> dict:
    """A row of the call log."""
    return {"step": step, "seconds": round(ended - started, 3), "prompt_chars": len(prompt), "reply_chars": len(reply or ""), "success": error is None, "error": error}


def labelled_posts(labels: DataFrame, goals: DataFrame, clean: DataFrame, raw: DataFrame) -> DataFrame:
    """Labels (id, id_goal) with their goal, clean row and raw post (id_raw_post); rows that lack one go."""
    posts = clean.join(raw, "id_raw_post").withColumnRenamed("id_raw_post", "id")
    return labels.join(goals, "id_goal").join(posts, "id")
