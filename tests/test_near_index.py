"""Near duplicates against the sequential rule: whole tables, crowded bands, stored index."""

import random
import re

import numpy as np
import pytest
from lexipress.functions import minhash
from lexipress.functions import text as T
from lexipress.operators import dedup, verdict
from lexipress.plans import queries as plans
from pyspark.sql import functions as F


def sequential(rows, threshold=0.7):
    """(canonical, score) of (id, near_doc, hash) one after another: hash first, then the best kept post of a shared band."""
    kept, hashes, by_band, out = {}, {}, {}, {}
    for i, near, h in sorted(rows):
        shingles = np.array(sorted(T.shingle_set(near)))
        own = minhash.band_names(minhash.signature(shingles)) if len(near.split()) >= 8 else []
        if h is not None and h in hashes:
            out[i] = (hashes[h], 1.0)
            continue
        met = {k for b in own for k in by_band.get(b, ())}
        scored = [(len(np.intersect1d(kept[k], shingles)) / len(np.union1d(kept[k], shingles)), -k) for k in met]
        best = max((x for x in scored if x[0] >= threshold), default=None)
        if best:
            out[i] = (-best[1], round(best[0], 3))
            continue
        out[i], kept[i] = None, shingles
        if h is not None:
            hashes[h] = i
        for b in own:
            by_band.setdefault(b, []).append(i)
    return out


def found_of(df):
    return {r["id"]: None if r["kept"] else (r["canonical"], round(r["score"], 3)) for r in df.collect()}


def words(r, n):
    return " ".join("".join(r.choice("абвгдежзик") for _ in range(r.randint(3, 7))) for _ in range(n))


def crowd(seed, n=70):
    """Near copies of three texts, some of near copies of near copies, some alone, some equal."""
    r = random.Random(seed)
    bases, out = [words(r, 60) for _ in range(3)], []
    for i in range(n):
        text = r.choice(bases).split() if r.random() < 0.8 else words(r, 50).split()
        for _ in range(r.choice((0, 1, 4, 12))):
            text[r.randrange(len(text))] = words(r, 1)
        if r.random() < 0.2:
            bases.append(" ".join(text))
        out.append((i, " ".join(text)))
    return [*out, (n, out[3][1]), (n + 1, "мало слов"), (n + 2, ""), (n + 3, None)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, clean_content string").withColumn("content_hash", T.exact_hash(F.lit(""), F.col("clean_content")))


def wanted(df):
    return sequential([(r["id"], r["near"] or "", r["content_hash"]) for r in df.withColumn("near", T.near_document(F.col("clean_content"))).collect()])


@pytest.mark.parametrize("leaders", [1, 3, 64])
def test_crowded_bands_equal_the_sequential_rule(spark, leaders):
    df = frame(spark, crowd(leaders))
    want = wanted(df)
    assert found_of(dedup.near_duplicates(df, leaders=leaders)) == want
    assert sum(v is not None for v in want.values()) > 20


def test_a_crowded_band_makes_no_pairs_of_all(spark):
    """Copies of one text with one word changed: the first leads, the others leave."""
    r = random.Random(2)
    base = words(r, 80).split()
    rows = [(i, " ".join(base[:40] + [words(r, 1)] + base[41:])) for i in range(60)]
    sets = dedup.cut(dedup.entries(frame(spark, rows)))
    pairs = dedup.alike_pairs(sets, leaders=2)
    assert 59 <= pairs.count() < 60 * 59 / 2 / 4
    assert dedup.resolve(sets, pairs).where("kept").count() == 1


def test_a_set_is_sent_once_to_its_cell(spark, tmp_path, monkeypatch):
    """Sixty texts of one kind: a set does not travel with each of its pairs, and posts alone have none made."""
    r = random.Random(4)
    base = words(r, 80).split()
    rows = [(i, " ".join(base[:40] + [words(r, 1)] + base[41:])) for i in range(60)] + [(100 + i, words(r, 60)) for i in range(20)]
    df = frame(spark, rows)
    sets = dedup.cut(dedup.entries(df))
    pairs = spark.createDataFrame([(a, b) for a in range(60) for b in range(a + 1, 60)], "a long, b long")
    seen, made = str(tmp_path / "seen"), []
    real, count = dedup._scored_cells, dedup._made

    def counted(*a):
        run = real(*a)

        def noted(pairs, sets):
            with open(seen, "a") as f:
                f.write(f"{sets.num_rows}\n")
            return run(pairs, sets)

        return noted

    monkeypatch.setattr(dedup, "_scored_cells", counted)
    monkeypatch.setattr(dedup, "CELL", 30)
    found = {(x["a"], x["b"]): x["score"] for x in dedup.confirmed(pairs, sets, 0.0).collect()}
    with open(seen) as f:
        assert sum(map(int, f)) <= 60 * 3
    of = {x["id"]: set(np.frombuffer(x["shingles"], np.uint32).tolist()) for x in sets.collect()}
    assert found == {(a, b): len(of[a] & of[b]) / len(of[a] | of[b]) for a in range(60) for b in range(a + 1, 60)}
    monkeypatch.setattr(dedup, "_made", lambda rows, *a, **k: (made.append((rows.count(), k or a)), count(rows, *a, **k))[1])
    dedup.near_duplicates(df).count()
    assert made[0][1] == (False, False) and 55 <= made[1][0] <= 60


def test_whole_table_equals_the_sequential_rule(spark, sf_dir):
    d = plans.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("clean_content"))
    df = d.withColumn("content_hash", T.exact_hash(F.lit(""), F.col("clean_content")))
    got = {r["id"]: None if r["kept"] else (r["canonical"], r["score"]) for r in plans.QUERIES["near_duplicates"](spark, sf_dir).collect()}
    assert got == wanted(df)


def test_verdicts_of_a_whole_table(spark, sf_dir):
    """What the checks of single posts leave alive is kept or a duplicate by the sequential rule."""
    rows = {r["id_raw_post"]: r for r in plans.QUERIES["verdicts"](spark, sf_dir).collect()}
    raw = plans.posts(spark, sf_dir).collect()
    assert len(rows) == len(raw)
    alive, hashed = [], {}
    for p in raw:
        title, body = T.clean_text_value(p["title"]) or None, T.clean_text_value(p["content"])
        if rows[p["id_raw_post"]]["drop_reason"] in (None, "duplicate"):
            assert body
            alive.append((p["id_raw_post"], f"{title}\n\n{body}" if title else body))
            hashed[p["id_raw_post"]] = (title, body)
    df = spark.createDataFrame([(i, c, *hashed[i]) for i, c in alive], "id long, clean_content string, title string, body string")
    want = wanted(df.withColumn("content_hash", T.exact_hash(F.col("title"), F.col("body"))))
    assert {i: None if rows[i]["drop_reason"] is None else (rows[i]["id_canonical"], rows[i]["dup_score"]) for i, _ in alive} == want


def test_slices_through_the_index_equal_one_run(spark, tmp_path, monkeypatch):
    """Each slice shingles its own posts alone, a repeated slice changes nothing."""
    rows = crowd(5)
    made = []
    real = dedup.entries
    monkeypatch.setattr(dedup, "entries", lambda rows, *a, **k: (made.append(rows.count()), real(rows, *a, **k))[1])
    index, found = dedup.NearIndex(spark, str(tmp_path / "index"), 8), {}
    for n, part in enumerate((rows[:30], rows[30:50], rows[50:], rows[50:])):
        found |= found_of(dedup.near_duplicates(frame(spark, part), index=index, run=str(n if n < 3 else 2)))
    df = frame(spark, rows)
    assert found == wanted(df)
    assert 25 <= made[0] <= 30 and made[1] <= 20 and made[2] == made[3] <= 24
    kept = sum(v is None for v in found.values())
    assert index._read("sets", "id long, n int", "id", None, None).count() == kept


def test_new_posts_meet_their_own_buckets(spark, tmp_path):
    index = dedup.NearIndex(spark, str(tmp_path / "index"), 256)
    index.add(dedup.entries(frame(spark, crowd(6))), "0")
    one = dedup.cut(dedup.entries(frame(spark, [(900, crowd(6)[0][1])])))
    read = index._read("bands", "id long, n int, band long", "band", dedup.bands(one), None)
    files = {r["f"] for r in read.select(F.input_file_name().alias("f")).distinct().collect()}
    assert 1 <= len({f.split("bucket=")[1].split("/")[0] for f in files}) <= 32
    assert re.search(r"PartitionFilters: \[[^]]*bucket", read._jdf.queryExecution().executedPlan().toString())
    assert {r["a"] for r in index.pairs(one).collect()} >= {0}


def test_band_codes_are_equal_where_bands_are():
    r = np.random.default_rng(1)
    values, bounds = r.integers(0, 1 << 32, 500, dtype=np.uint64), np.array([0, 100, 100, 250, 500])
    sigs = minhash.signatures(values, bounds)
    for k in range(4):
        assert (sigs[k] == minhash.signature(values[bounds[k] : bounds[k + 1]])).all()
    near = sigs[[0, 0]].copy()
    near[1, 4] ^= np.uint64(1)
    codes = minhash.band_codes(near)
    assert (codes[0] == codes[1]).tolist() == [k != 1 for k in range(32)]
    assert len(set(minhash.band_codes(sigs).ravel().tolist())) == 4 * 32


def test_by_signature_of_a_whole_table(spark, sf_dir):
    got = {r["id"]: r["canonical"] for r in plans.QUERIES["near_duplicates_by_signature"](spark, sf_dir).collect()}
    exact = {r["id"]: r["canonical"] for r in plans.QUERIES["near_duplicates"](spark, sf_dir).collect()}
    assert got.keys() == exact.keys() and sum((got[i] is None) == (exact[i] is None) for i in got) >= 0.95 * len(got)


def test_whole_texts_are_compared(spark):
    """Texts that begin alike for more than 4000 characters and go on differently are no duplicates; those that differ at first only are."""
    r = random.Random(9)
    head, tail = words(r, 1000), words(r, 8000)
    df = frame(spark, [(1, f"{head} {words(r, 4000)}"), (2, f"{head} {words(r, 4000)}"), (3, f"{words(r, 1000)} {tail}"), (4, f"{words(r, 1000)} {tail}")])
    assert len(head) > 4000
    got = found_of(dedup.near_duplicates(df))
    assert [got[k] is None for k in (1, 2, 3, 4)] == [True, True, True, False] and got[4][0] == 3


def test_bitmaps_prove_no_alike_pair_away():
    """What bitmaps say two sets hold together is never more than they do."""
    r = np.random.default_rng(3)
    for n, more in ((1, 0), (40, 3), (500, 900), (5000, 70), (3000, 9000)):
        pool = np.unique(r.integers(0, 1 << 32, n + more, dtype=np.uint64)).astype(np.uint32)
        a, b = pool[: len(pool) - more // 2], pool[more // 3 :]
        union = len(np.union1d(a, b))
        assert max(len(a), len(b)) * 0.8 <= dedup._least_union(dedup._marked(a), dedup._marked(b)) <= union


def test_a_cell_has_a_bound_of_bytes(spark, monkeypatch):
    """Few large sets fill a block as many small ones do."""
    r = random.Random(4)
    base = words(r, 80).split()
    sets = dedup.cut(dedup.entries(frame(spark, [(i, " ".join(base[:40] + [words(r, 1)] + base[41:])) for i in range(40)])))
    pairs = spark.createDataFrame([(a, b) for a in range(40) for b in range(a + 1, 40)], "a long, b long")
    want = {(x["a"], x["b"], x["score"]) for x in dedup.confirmed(pairs, sets, 0.0).collect()}
    monkeypatch.setattr(dedup, "CELL_BYTES", sets.agg(F.sum("n")).head()[0] * 4 // 8)
    assert dedup._homes(pairs, sets.select("id", (F.col("n") * 4).alias("bytes"))).select("block").distinct().count() >= 2
    assert {(x["a"], x["b"], x["score"]) for x in dedup.confirmed(pairs, sets, 0.0).collect()} == want and len(want) == 780


def test_copies_are_told_before_sets_are_made(spark, monkeypatch):
    """Copies are never shingled."""
    df, made, real = frame(spark, [(i, words(random.Random(i % 5), 40)) for i in range(50)]), [], dedup._made
    monkeypatch.setattr(dedup, "_made", lambda rows, *a, **k: (made.append(rows.count()), real(rows, *a, **k))[1])
    got = found_of(dedup.near_duplicates(df))
    assert made[0] == 5 and all(got[i] == (None if i < 5 else (i % 5, 1.0)) for i in range(50))
