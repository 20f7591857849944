"""Source divergence against a direct sum over all terms, and against its SQL."""

import re
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest
from lexipress.llm import divergence


def brute(rows, least_docs, top):
    """All of the audit's rows in plain Python."""
    word = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, docs, groups = defaultdict(Counter), Counter(), set()
    for lang, source, text in ((a or "", b or "", c or "") for a, b, c in rows):
        groups.add((lang, source))
        terms = word.findall(text.translate(lower))
        counts[lang, source].update(terms)
        docs.update((lang, t) for t in set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (at, t), n in docs.items() if at == lang and n >= least_docs]
        own = {s: counts[lang, s] for at, s in groups if at == lang}

        def p(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        ps, q = {s: p(c) for s, c in own.items()}, p(sum(own.values(), Counter()))
        for s in own:
            far = [(-sum(abs(ps[s][t] - ps[o][t]) for t in kept), o.encode()) for o in own if o != s]
            more = [(q[t] - ps[s][t], t.encode()) for t in kept if own[s][t] and ps[s][t] > q[t]]
            for part, values, limit in (("pair", far, None), ("term", more, top)):
                out += [(lang, s, part, i.decode(), -v, k) for k, (v, i) in enumerate(sorted(values)[:limit], 1)]
    return sorted(out)


ROWS = (
    [("en", f"s{k % 7}", f"Common word{k % 3} été{k % 5} x{k} THE the") for k in range(60)]
    + [("en", "s0", "common " * 40), ("en", None, None), (None, "s1", "solo"), (None, None, ""), ("", "s9", "Solo SOLO"), ("de", "only", "ein wort ein")]
    + [("de", f"q{k}", f"ein wort w{k % 4} ÄÖ") for k in range(9)]
    + [("fr", "a", "123 456"), ("fr", "b", "--")]
)


@pytest.mark.parametrize("light, slab, block", [(16, 4096, 128), (0, 2, 2), (3, 1, 3), (1000, 8, 1)])
def test_equals_brute_force(spark, light, slab, block):
    """Whatever is heavy or light and however tiles are cut, sums are the same."""
    docs = spark.createDataFrame([(*r, 1) for r in ROWS], "lang string, source string, text string, rank int").repartition(3)
    found = sorted(tuple(r) for r in divergence.audit(docs, least_docs=2, top=4, light=light, slab=slab, block=block).collect())
    assert found == brute(ROWS, 2, 4)


def test_all_light_when_the_share_allows(spark, monkeypatch):
    monkeypatch.setattr(divergence, "LIGHT_SHARE", 1)
    docs = spark.createDataFrame(ROWS, "lang string, source string, text string")
    found = sorted(tuple(r) for r in divergence.audit(docs, least_docs=2, top=4, light=1000, block=2).collect())
    assert found == brute(ROWS, 2, 4)


def test_counts_beyond_a_long(spark):
    """p is exact where a thousand million times a count leaves 64 bits."""
    x = spark.createDataFrame([(20_000_000_000, 70_000_000_001, 3)], "n long, total long, v long")
    assert x.select(divergence._p("n", "total", "v")).head()[0] == 1 + 1_000_000_000 * 20_000_000_005 // 70_000_000_016


def test_terms_of_pieces():
    column = pa.array(["Aé1b", None, "", "b", "\x00c d", "日本x"])
    words, rows = divergence._terms(column)
    assert list(zip(rows.tolist(), words.cast(pa.string()).to_pylist(), strict=True)) == [(0, "aé"), (0, "b"), (3, "b"), (4, "c"), (4, "d"), (5, "日本x")]
    words, rows = divergence._terms(column.slice(3, 2))
    assert words.cast(pa.string()).to_pylist() == ["b", "c", "d"] and rows.tolist() == [0, 1, 1]


def test_a_long_text_is_counted_whole(spark):
    docs = spark.createDataFrame([("en", "a", "long text " * 2_000_000), ("en", "b", "text")], "lang string, source string, text string")
    found = {(r["source"], r["term"]): (r["n"], r["docs"]) for r in divergence.term_counts(docs).collect()}
    assert found == {("a", "long"): (2_000_000, 1), ("a", "text"): (2_000_000, 1), ("b", "text"): (1, 1)}


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    found = divergence.op11_divergence(spark, sf_dir)
    assert sorted(map(tuple, found.collect())) == sorted(con.execute(divergence.OP11_SQL).fetchall()) != []
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
