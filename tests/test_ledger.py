"""External calls are counted: each request once, whatever happens afterwards."""

import json

import pytest
from lexipress.operators import labels, ledger, retrieval
from pyspark.sql import functions as F


class Counter:
    """Counts calls of workers, a line each in a file that all append to."""

    def __init__(self, path):
        self.path = str(path)

    def note(self, *what):
        with open(self.path, "a") as f:
            f.write("".join(f"{w}\n" for w in what))

    def seen(self):
        try:
            with open(self.path) as f:
                return sorted(f.read().split("\n")[:-1])
        except FileNotFoundError:
            return []


def requests(spark, names):
    return spark.createDataFrame([(k, n) for k, n in enumerate(names)], "id int, prompt string")


def test_each_prompt_is_asked_once(spark, tmp_path):
    count, book = Counter(tmp_path / "seen"), ledger.Ledger(spark, str(tmp_path / "book"))

    def call(prompts):
        count.note(*prompts)
        return [p.upper() for p in prompts]

    asked = requests(spark, ["a", "b", "a", None, "c"])
    found = book.ask(asked, "s", "m", call, batch=2)
    for _ in range(3):  # any number of actions
        assert {r["id"]: r["reply"] for r in found.collect()} == {0: "A", 1: "B", 2: "A", 3: None, 4: "C"}
    assert count.seen() == ["a", "b", "c"]
    book.ask(requests(spark, ["c", "d"]), "s", "m", call).count()
    assert count.seen() == ["a", "b", "c", "d"]
    ledger.Ledger(spark, str(tmp_path / "book")).ask(asked, "s", "other", call).count()  # another model is another request
    assert count.seen() == ["a", "a", "b", "b", "c", "c", "d"]


def test_refused_replies_are_asked_again(spark, tmp_path):
    count, book = Counter(tmp_path / "seen"), ledger.Ledger(spark, str(tmp_path / "book"))

    def call(prompts):
        before = count.seen()
        count.note(*prompts)
        return [str(before.count(p)) for p in prompts]

    def third(reply, prompt):
        if prompt == "hard" and reply != "2" or prompt == "never":
            raise ValueError("too early")
        return reply

    found = book.ask(requests(spark, ["easy", "hard", "never"]), "s", "m", call, third, batch=1)
    assert {r["prompt"]: r["reply"] for r in found.collect()} == {"easy": "0", "hard": "2", "never": None}
    assert count.seen() == ["easy"] + ["hard"] * 3 + ["never"] * 3
    errors = book.rows("s").where("reply is null").collect()
    assert len(errors) == 5 and {r["error"] for r in errors} == {"too early"}


@pytest.mark.parametrize("small", [0, 1000])
def test_rounds_store_digests_and_no_prompts(spark, tmp_path, monkeypatch, small):
    """Long prompts are not written by rounds, and later rounds ask only what was refused."""
    monkeypatch.setattr(ledger, "SMALL", small)
    stored, real = [], ledger.cut
    monkeypatch.setattr(ledger, "cut", lambda df: (stored.append(df.columns), real(df))[1])
    count, book = Counter(tmp_path / "seen"), ledger.Ledger(spark, str(tmp_path / "book"))
    names = [f"{k}" for k in range(12)]
    rows = spark.createDataFrame([(k, f"{n}:" + "x" * 5000) for k, n in enumerate([*names, *names[:3]])] + [(99, None)], "id int, prompt string")

    def call(prompts):
        count.note(*(p.split(":")[0] for p in prompts))
        return [p.split(":")[0] for p in prompts]

    def odd(reply, prompt):
        if int(reply) % 2 == 0:
            raise ValueError("even")
        return reply

    found = book.ask(rows, "s", "m", call, odd, batch=4, rounds=2).collect()
    assert {r["id"]: r["reply"] for r in found} == {k: n if int(n) % 2 else None for k, n in enumerate([*names, *names[:3]])} | {99: None}
    assert count.seen() == sorted(names + [n for n in names if int(n) % 2 == 0])
    assert stored and not any("prompt" in c for c in stored)


def test_a_failed_run_keeps_what_was_paid(spark, tmp_path):
    """A worker dies in the middle: the next run asks for the rest alone."""
    count, book = Counter(tmp_path / "seen"), ledger.Ledger(spark, str(tmp_path / "book"))

    def call(prompts):
        if len(count.seen()) >= 4 and not (tmp_path / "well").exists():
            raise SystemExit("gone")
        count.note(*prompts)
        return prompts

    rows = requests(spark, [f"p{k}" for k in range(12)]).coalesce(1)
    with pytest.raises(Exception, match="gone|SystemExit|crashed|Python worker"):
        book.ask(rows, "s", "m", call, batch=1)
    paid = count.seen()
    assert len(paid) >= 4
    (tmp_path / "well").touch()
    assert book.ask(rows, "s", "m", call, batch=1).where("reply is not null").count() == 12
    assert count.seen() == sorted(f"p{k}" for k in range(12))


def test_scores_are_made_once(spark, tmp_path):
    count = Counter(tmp_path / "seen")

    def scorer(id_object, batch):
        count.note(*(f"{id_object}:{i}" for i, _ in batch))
        return {i: 8.0 for i, _ in batch}

    docs = spark.createDataFrame([(i, f"t{i}", "alpha text", [1.0, float(i)]) for i in range(6)], "id long, title string, clean_content string, embedding array<double>")
    catalog = spark.createDataFrame([(1, "alpha", "", "about", [1.0, 0.0])], "id_object int, keywords string, negative_filter string, search_description string, query_embedding array<double>")
    cache = spark.createDataFrame([(1, 0, "m", 9.0)], "id_object int, id long, model string, score double")
    found = retrieval.filter_objects(docs, catalog, cache, scorer, "m", depth=4)
    for name in ("scores", "new_scores", "relevant", "candidates"):
        found[name].count(), found[name].collect()
    assert count.seen() == [f"1:{i}" for i in range(1, 6)]


def test_labels_and_query_vectors_are_made_once(spark, tmp_path):
    count = Counter(tmp_path / "seen")

    def labeller(step, row):
        count.note(f"{step}:{row['id']}:{row['id_goal']}")
        if step == "relevance":
            return json.dumps({"matches": [{"kr_id": 1, "evidence": ["bank"], "rationale": "r", "confidence": 0.9}]})
        return json.dumps({"impact": "positive", "is_paid_news": False, "mentions": []})

    docs = spark.createDataFrame([(1, "a bank"), (2, "the bank")], "id long, text string")
    gate = docs.select("id", F.lit(1).alias("id_goal"), F.lit(True).alias("allowed"))
    found = labels.label_documents(docs, None, gate, labeller)
    for df in found.values():
        df.count(), df.collect()
    seen = count.seen()
    assert seen and len({s for s in seen if s.startswith("relevance")}) == 2
    before = len(seen)
    for df in found.values():
        df.collect()
    assert len(count.seen()) == before

    def embedder(texts, role):
        count.note(*(f"{role}:{t}" for t in texts))
        return [[3.0, 4.0]] * len(texts)

    objects = spark.createDataFrame([(1, "one", None), (2, "two", [1.0, 0.0])], "id_object int, search_description string, query_embedding array<float>")
    every, new = retrieval.with_query_vectors(objects, embedder, 2)
    for df in (every, new, every):
        df.collect()
    assert [s for s in count.seen() if s.startswith("query")] == ["query:one"]
