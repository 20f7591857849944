"""Stems against known pairs, covers against a brute force, and what a query reads of the index."""

import random
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from lexipress.functions import stems
from lexipress.operators import fulltext
from pyspark.sql import functions as F

RUSSIAN = """вагоны вагон, важнейшие важн, важничал важнича, валандался валанда, валентина валентин, валерианой валериан, валяется валя, падавших пада, пакостный пакостн, подвижность подвижн, новости новост, новостями новост,
банками банк, сбербанка сбербанк, говоривший говор, кредиты кредит, кредитование кредитован, ёлки елк, п п, стр стр"""
ENGLISH = """consistency consist, consisted consist, knightly knight, generously generous, generate generat, running run, happy happi, skies sky, national nation, relational relat, hopping hop, hoped hope, conditional condit, kneeling kneel,
licenses licens, agreed agre, fly fli, say say, boys boy, cries cri, ties tie, gas gas, this this, kiwis kiwi, hopefully hope, electricity electr, adjustment adjust, news news, proceed proceed, o'neil's o'neil"""


@pytest.mark.parametrize("stem, pairs", [(stems.russian, RUSSIAN), (stems.english, ENGLISH)])
def test_stems(stem, pairs):
    for pair in pairs.split(","):
        word, want = pair.split()
        assert stem(word) == want, word


def test_stem_by_script():
    assert [stems.stem(w) for w in ("the", "для", "банков", "banks", "x9", "naïve", "日本")] == [None, None, "банк", "bank", "x9", "naïve", "日本"]


@settings(max_examples=300, deadline=None)
@given(st.text("абвгеиоующыстнйьюяabcdegilnsty'", max_size=14))
def test_stemming_any_word_ends(word):
    """No word breaks the rules, and no stem is longer than its word but by an e."""
    for stem in (stems.russian, stems.english):
        assert len(stem(word)) <= len(word) + 1


def brute(words, groups):
    """Score of one document: every stretch that holds a word of each group and no shorter one that does."""
    at = sorted({i for i, w in enumerate(words, 1) for g in groups if w in g})
    if len(groups) == 1:
        return 0.1 * len(at)
    full = [(a, b) for a in at for b in at if a <= b and all(any(words[i - 1] in g for i in at if a <= i <= b) for g in groups)]
    least = [c for c in full if not any(d != c and d[0] >= c[0] and d[1] <= c[1] for d in full)]
    return sum(0.1 / (1 + (b - a) - (sum(a <= i <= b for i in at) - 1)) for a, b in least)


def test_covers_equal_brute_force(spark, tmp_path):
    r = random.Random(3)
    texts = {i: [r.choice("abcdefgh") * 3 for _ in range(r.randint(0, 40))] for i in range(60)}
    groups = {1: [["aaa", "bbb"]], 2: [["aaa"], ["bbb", "ccc"]], 3: [["ddd"], ["aaa", "ddd"], ["eee"]], 4: [["zzz"], ["aaa"]], 5: [["aaa", "aaa"]]}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()] + [(99, None), (None, "aaa")], "id long, text string")
    index = fulltext.Index(spark, str(tmp_path / "index"), 4, stems.same).add(docs)
    found = {(x["id_object"], x["id"]): x["score"] for x in index.search(groups).collect()}
    want = {(o, i): round(s, 6) for o, g in groups.items() for i, w in texts.items() if (s := brute(w, g))}
    assert found == pytest.approx(want, abs=1e-6)
    some = index.search({1: groups[1]}, k=3, universe=docs.where("id < 9")).collect()
    best = sorted((-round(brute(texts[i], groups[1]), 6), i) for i in range(9) if brute(texts[i], groups[1]))[:3]
    assert [(x["id"], x["rank"]) for x in sorted(some, key=lambda x: x["rank"])] == [(i, k) for k, (_, i) in enumerate(best, 1)]


def test_common_words_keep_their_places(spark, tmp_path):
    """A word that is never searched for is noise in a cover all the same."""
    docs = spark.createDataFrame([(1, "bank of the loans"), (2, "banks loan"), (3, "the of")], "id long, text string")
    index = fulltext.Index(spark, str(tmp_path / "index"), 2).add(docs)
    found = {x["id"]: x["score"] for x in index.search({1: fulltext.all_of("Bank", "loaned")}).collect()}
    assert found == {1: pytest.approx(0.1 / 3, abs=1e-6), 2: 0.1}
    assert index.search({1: fulltext.any_of("the, of"), 2: []}).count() == 0


def test_a_query_reads_its_own_buckets(spark, tmp_path):
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * 7 + k) % 300}" for k in range(50))) for i in range(200)], "id long, text string")
    index = fulltext.Index(spark, str(tmp_path / "index"), 32, stems.same).add(docs)
    plan = index.read(["w5"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket", plan) and "PushedFilters: [IsNotNull(term), EqualTo(term,w5)]" in plan
    files = index.read(["w5"]).select(F.input_file_name().alias("f")).distinct().collect()
    assert len({x["f"].split("bucket=")[1].split("/")[0] for x in files}) == 1
    every = len(list((tmp_path / "index").glob("bucket=*")))
    assert every > 20


def test_documents_are_added_later(spark, tmp_path):
    index = fulltext.Index(spark, str(tmp_path / "index"), 4)
    index.add(spark.createDataFrame([(1, "первый банк")], "id long, text string")).add(spark.createDataFrame([(2, "банки и банкам")], "id long, text string"))
    found = defaultdict(list)
    for x in index.search({1: fulltext.any_of("банк")}).collect():
        found[x["id_object"]].append((x["rank"], x["id"], x["score"]))
    assert sorted(found[1]) == [(1, 2, 0.2), (2, 1, 0.1)]
