"""Vector search in passes, stories against a rule in id order, pair scores over windows, edit distances."""

import random
import subprocess
import sys

import numpy as np
import pytest
from lexipress.operators import dedup, edits, retrieval, stories, windows
from lexipress.plans import queries as plans
from pyspark.sql import functions as F


def points(n, dims, seed, kinds=4, spread=0.25):
    r = np.random.default_rng(seed)
    middles = r.normal(size=(kinds, dims))
    return [(i, (middles[i % kinds] + r.normal(scale=spread, size=dims)).tolist()) for i in range(n)]


@pytest.mark.parametrize("rows, held", [(10_000, 4_000_000), (3, 4_000_000), (10_000, 0)])
def test_vector_search_equals_all_pairs(spark, monkeypatch, rows, held):
    """One pass or several, pools that are compacted or none: the same best."""
    monkeypatch.setattr(retrieval, "CATALOG_ROWS", rows)
    monkeypatch.setattr(retrieval, "HELD", held)
    docs, asked = points(300, 8, 1), points(9, 8, 2)
    odd = [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [1.0] * 3), (904, []), (905, [None] * 8)]
    d = spark.createDataFrame(docs + docs[:1] + odd, "id long, embedding array<double>").repartition(5)
    q = spark.createDataFrame(asked + odd, "id_object int, query_embedding array<double>")
    got = {}
    for x in retrieval.vector_channel(d, q, 5, digits=9).collect():
        got.setdefault(x["id_object"], []).append((x["rank"], x["id"], x["score"]))
    unit = lambda v: np.array(v) / np.linalg.norm(v)
    for o, v in asked:
        want = sorted((-round(float(unit(v) @ unit(w)), 9), i) for i, w in docs + docs[:1])[:5]
        assert [(i, pytest.approx(s, abs=1e-8)) for _, i, s in sorted(got[o])] == [(i, -s) for s, i in want]
    assert {x[1] for x in got[903]} == {903} and not {900, 901, 902, 904, 905} & got.keys()


def sequential_stories(slices, threshold):
    """Stories one vector after another: first against those before the slice, then against founders of the slice."""
    found, told = {}, {}  # story: sum, size, first, last
    unit = lambda v: np.array(v) / np.linalg.norm(v)
    for day, rows in slices:
        centroids = {c: unit(s[0]) for c, s in found.items()}
        founders, joined = {}, {}
        for i, v in sorted(rows):
            u = unit(v)
            best = max(((round(float(u @ c), 9), -k) for k, c in centroids.items()), default=(-2, 0))
            if best[0] < threshold:
                best = max(((round(float(u @ c), 9), -k) for k, c in founders.items()), default=(-2, 0))
            if best[0] < threshold:
                founders[i] = u
                best = (1.0, -i)
            joined[i] = (-best[1], best[0])
        for i, v in sorted(rows):
            told[i] = joined[i]
            s = found.setdefault(joined[i][0], [np.zeros(len(v)), 0, day, day])
            s[0], s[1], s[3] = s[0] + unit(v), s[1] + 1, day
    return told, {c: (s[1], s[2], s[3]) for c, s in found.items()}


@pytest.mark.parametrize("block", [1024, 7])
def test_stories_equal_the_rule_in_id_order(spark, monkeypatch, block):
    monkeypatch.setattr(stories, "BLOCK", block)
    rows = points(90, 6, 5, kinds=7, spread=0.3)
    random.Random(1).shuffle(rows)
    days = ["2024-01-01", "2024-01-02", "2024-01-05"]
    slices = [(d, rows[k * 30 : k * 30 + 30]) for k, d in enumerate(days)]
    df = spark.createDataFrame([(i, d, v) for d, part in slices for i, v in part] + [(999, days[0], None), (998, days[1], [0.0] * 6)], "id long, day string, embedding array<double>")
    grown, members = stories.run(spark, df.withColumn("day", F.col("day").cast("date")), days, 0.85)
    told, found = sequential_stories(slices, 0.85)
    assert {r["id"]: (r["id_cluster"], pytest.approx(r["score"], abs=1e-8)) for r in members.collect()} == told
    assert {r["id_cluster"]: (r["size"], str(r["first_day"]), str(r["last_day"])) for r in grown.collect()} == found
    goals = spark.createDataFrame([(1, rows[0][1])], "id_goal int, query_embedding array<double>")
    near = {r["id_cluster"] for r in stories.goal_matches(grown, goals, 0.8).collect()}
    assert near and near < found.keys()


def test_centroids_do_not_pass_the_driver(spark, monkeypatch):
    """The nearest of many centroids, block by block: no table of them is collected."""
    monkeypatch.setattr(retrieval, "BLOCK_BYTES", 8 * 6 * 40)
    rows, own = points(120, 6, 3, kinds=9, spread=0.4), points(70, 6, 4, kinds=9, spread=0.4)
    own += [(i + 1000, v) for i, v in own[:5]]  # of equal centroids the smaller counts
    a = spark.createDataFrame([*rows, (5000, [0.0] * 6), (5001, None), (5002, [1.0])], "id long, embedding array<double>")
    b = spark.createDataFrame([*own, (5000, [0.0] * 6)], "id_cluster long, centroid array<double>")
    for name in ("toArrow", "toPandas"):
        monkeypatch.setattr(type(a), name, lambda *_: pytest.fail("a table came to the driver"))
    found = retrieval.nearest(a, b)
    monkeypatch.undo()
    unit = lambda v: np.array(v) / np.linalg.norm(v)
    best = {i: max((round(float(unit(v) @ unit(c)), 9), -j) for j, c in own) for i, v in rows}
    assert {r["id"]: (r["score"], -r["id_cluster"]) for r in found.collect()} == {i: (pytest.approx(s, abs=2e-9), j) for i, (s, j) in best.items()}


@pytest.mark.parametrize("block", [61, 31, 21, 16, 13])
def test_blocks_in_a_ring_meet_once_and_are_not_broadcast(spark, monkeypatch, block):
    """One to five blocks: every pair once, and no side of repeated blocks is collected by the driver."""
    monkeypatch.setattr(stories, "BLOCK", block)
    rows = points(61, 6, 8, kinds=5, spread=0.4)
    d = spark.createDataFrame(rows, "id long, embedding array<double>")
    found = stories.near_pairs(d, 0.8)
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows}
    want = {(a, b): pytest.approx(float(unit[a] @ unit[b]), abs=1e-8) for a in unit for b in unit if a < b and round(float(unit[a] @ unit[b]), 9) >= 0.8}
    got = [((r["a"], r["b"]), r["score"]) for r in found.collect()]
    assert len(got) == len(want) and dict(got) == want
    near = retrieval.nearest(d, d.select(F.col("id").alias("id_cluster"), F.col("embedding").alias("centroid")))
    for plan in (found, near):
        assert "Broadcast" not in plan._jdf.queryExecution().executedPlan().toString()


def test_story_query_counts_every_vector(spark, sf_dir):
    rows = plans.QUERIES["story_clusters"](spark, sf_dir).collect()
    sizes = {}
    for r in rows:
        sizes[r["id_cluster"]] = sizes.get(r["id_cluster"], 0) + 1
    assert all(r["size"] == sizes[r["id_cluster"]] for r in rows) and len(rows) == plans.vectors(spark, sf_dir).count()


def test_windows_of_texts(spark):
    df = spark.createDataFrame([("",), ("abc",), ("a" * 10,), ("0123456789x",)], "t string")
    got = [[(w["window"], w["text"]) for w in r[0]] for r in df.select(windows.text_windows(F.col("t"), 10, 7)).collect()]
    assert got == [[(0, "")], [(0, "abc")], [(0, "a" * 10)], [(0, "0123456789"), (1, "789x")]]


def test_window_scores(spark, tmp_path):
    """Cached windows are not asked for, a refused batch leaves its documents where they are."""
    seen = tmp_path / "seen"

    def scorer(query, texts):
        with open(seen, "a") as f:
            f.writelines(f"{query}:{t}\n" for t in texts)
        if query == "bad":
            raise OSError
        return [float(t.count("x")) for t in texts]

    docs = spark.createDataFrame([(1, "xxxx......xx"), (2, "x"), (3, None), (4, "..........xxxxx")], "id long, text string")
    asked = spark.createDataFrame([(1, "good"), (2, "bad")], "id_object int, query string")
    ranked = spark.createDataFrame([(o, i, i) for o in (1, 2) for i in (1, 2, 3, 4)], "id_object int, id long, rank int")
    cache = spark.createDataFrame([(1, 1, "m", 0, 9.0), (1, 2, "old", 0, 9.0), (2, 3, "m", 0, 0.5)], "id_object int, id long, model string, window int, score double")
    scores, new = windows.window_scores(ranked, asked, docs, scorer, "m", cache, 10, 10, batch=1)
    got = {(r["id_object"], r["id"]): (r["score"], r["window"]) for r in scores.collect()}
    assert got == {(1, 1): (9.0, 0), (1, 2): (1.0, 0), (1, 3): (0.0, 0), (1, 4): (5.0, 1), (2, 3): (0.5, 0)}
    order = {(r["id_object"], r["rank"]): r["id"] for r in retrieval.rerank(ranked, scores).collect()}
    assert [order[1, k] for k in (1, 2, 3, 4)] == [1, 4, 2, 3] and [order[2, k] for k in (1, 2, 3, 4)] == [3, 1, 2, 4]
    asked_for = seen.read_text().splitlines()
    assert "good:xxxx......" not in asked_for and len([s for s in asked_for if s.startswith("good")]) == new.count() == 5
    new.collect(), scores.collect()
    assert seen.read_text().splitlines() == asked_for


def test_edits_and_words_disagree(spark):
    """Words in another order have one set and many edits; a changed letter in each word the other way round."""
    base = "alpha beta gamma delta epsilon zeta eta theta"
    texts = [(1, base), (2, " ".join(reversed(base.split()))), (3, base.replace("a", "b")), (4, base + "!"), (5, None), (6, ""), (7, "")]
    df = spark.createDataFrame(texts, "id long, text string")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (1, 5), (6, 7), (1, 6)], "a long, b long")
    assert {(r["a"], r["b"]): r["distance"] for r in edits.confirmed(pairs, df, 0.1).collect()} == {(1, 4): 1, (6, 7): 0}
    assert {(r["a"], r["b"]) for r in edits.confirmed(pairs, df, 0.3).collect()} == {(1, 3), (1, 4), (6, 7)}


def test_nothing_here_needs_llm():
    code = "import sys; sys.modules['lexipress.llm'] = None; from lexipress.plans import queries; assert len(queries.QUERIES) > 120"
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120, cwd=__file__.rsplit("/tests/", 1)[0])
    assert dedup.THRESHOLD
