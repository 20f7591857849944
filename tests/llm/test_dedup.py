import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from lexipress.llm import simhash, substring_dedup, textkernel
from lexipress.llm.components import components
from tests.llm.fixtures import DOCS, documents, extra_columns, words


def linked(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, sf_dir):
    for docs in (extra_columns(documents(spark)), spark.read.parquet(f"{sf_dir}/documents.parquet")):
        rows = docs.select("doc_id", "text").collect()
        fps = [plain_fingerprint(r["text"]) for r in rows]
        of = linked(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
        least = {}
        for r, c in zip(rows, of, strict=True):
            if r["doc_id"] is not None:
                least[c] = min(least.get(c, r["doc_id"]), r["doc_id"])
        want = sorted((str(r["doc_id"]), f"{f:016x}", least[c]) for r, f, c in zip(rows, fps, of, strict=True))
        assert sorted((str(r[0]), r[1], r[2]) for r in simhash.near_duplicates(docs).collect()) == want
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_crowded_buckets(spark):
    r = random.Random(1)
    centre = r.getrandbits(64)
    fps = {centre}
    for _ in range(150):  # a dense ball, links of which chain
        x = r.choice(list(fps))
        for _ in range(r.randrange(1, 4)):
            x ^= 1 << r.randrange(64)
        fps.add(x)
    fps |= {r.getrandbits(64) for _ in range(200)}
    fps = [simhash._signed(x) for x in sorted(fps)]
    of = linked(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if ((fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= 2])
    edges = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"))
    got = {row["node"]: row["component"] for row in components(edges).collect()}
    same = {}
    for x, c in zip(fps, of, strict=True):
        same.setdefault(c, set()).add(got.get(x, x))
    assert all(len(s) == 1 for s in same.values()) and len({next(iter(s)) for s in same.values()}) == len(same)


def test_components_of_a_path(spark):
    n = 300
    order = random.Random(3).sample(range(n), n)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (1001, 1000)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert all(got[i] == 0 for i in range(n)) and got[1000] == got[1001] == 1000


@given(st.lists(st.text(alphabet=st.sampled_from(list("aB1 \n\t.é日")), max_size=30) | st.none(), max_size=6))
@settings(max_examples=150, deadline=None)
def test_word_hashes(texts):
    for kind, pattern in ((textkernel.SPACED, r"[^\x20\x09-\x0D]+"), (textkernel.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        (h,), ends = textkernel.words(pa.array(texts, pa.string()), kind)
        want = [re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), t or "") if kind is textkernel.ALNUM else t or "") for t in texts]
        flat = [w for row in want for w in row]
        assert ends.tolist() == np.cumsum([len(w) for w in want]).tolist() and len(h) == len(flat)
        assert len(set(zip(flat, h.tolist(), strict=True))) == len(set(flat)) == len(set(h.tolist()))


def test_long_words_and_slices(monkeypatch):
    monkeypatch.setattr(textkernel, "SLICE", 64)
    texts = ["a" * 1000 + " b " + "c" * 70, "b", "", "x y " * 100, "c" * 70]
    (h,), ends = textkernel.words(pa.array(texts), textkernel.SPACED)
    assert ends.tolist() == [3, 4, 4, 204, 205] and h[1] == h[3] and h[2] == h[204]


@given(st.lists(st.integers(0, 3), min_size=13, max_size=13), st.lists(st.integers(0, 3), max_size=20), st.lists(st.integers(0, 3), max_size=20), st.lists(st.integers(0, 3), max_size=20), st.lists(st.integers(0, 3), max_size=20))
@settings(max_examples=500, deadline=None)
def test_equal_windows_have_equal_anchors(window, a, b, c, d):
    names = np.array([11, 22, 33, 44], dtype=np.uint64)
    one, two = (substring_dedup.anchors(names[np.array(x)]) for x in (a + window + b, c + window + d))
    assert one[len(a)] == two[len(c)]


def plain_dedup(rows):
    seen = {}
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    for (d, _), w in zip(rows, split, strict=True):
        for i in range(len(w) - 12) if d is not None else ():
            k = tuple(w[i : i + 13])
            seen[k] = min(seen.get(k, d), d)
    out = []
    for (d, _), w in zip(rows, split, strict=True):
        gone = set()
        for i in range(len(w) - 12) if d is not None else ():
            if seen[tuple(w[i : i + 13])] < d:
                gone |= set(range(i, i + 13))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((str(d), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_substring_dedup(spark, sf_dir):
    more = [(30 + i, words(30, 50 + i, 3)) for i in range(40)] + [(80, "a " * 200), (79, "b " * 3 + words(40, 1)), (90, words(60, 1).replace("w1", "w2"))]
    for docs in (extra_columns(documents(spark, more)), spark.read.parquet(f"{sf_dir}/documents.parquet")):
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        for bits in (27, 6):
            got = substring_dedup.remove_repeats(docs, bitmap_bits=bits).collect()
            assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == plain_dedup(rows)
    assert substring_dedup.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


def near_pairs(n, changes, size=400):
    """Texts in pairs: ``size`` words, and the same with so many of them changed, far from each other; Jaccard of five-word shingles."""
    r = random.Random(11)
    texts = []
    for g in range(n):
        w = [f"p{g}x{k}" for k in range(size)]
        other = list(w)
        for k in r.sample(range(10, size - 10, 10), changes):  # no shingle holds two
            other[k] = f"q{g}x{k}"
        texts += [" ".join(w), " ".join(other)]
    return texts, (size - 4 - 5 * changes) / (size - 4 + 5 * changes)


def kept_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    return sorted(r["doc_id"] for r in simhash.keep_one(docs).collect())


def test_similar_pairs_are_linked_at_any_size(spark):
    """Candidates do not depend on how many documents there are: the words of a pair find it."""
    texts, similarity = near_pairs(40, 8)
    assert 0.8 < similarity < 0.83
    assert kept_of(spark, texts) == list(range(0, 80, 2))
    for more in (0, 4000):  # documents unlike any other
        others = [(10_000 + k, " ".join(f"o{k}x{i}" for i in range(12))) for k in range(more)]
        docs = spark.createDataFrame(list(enumerate(texts)) + others, "doc_id long, text string").repartition(4)
        kept = [r["doc_id"] for r in simhash.keep_one(docs).collect()]
        assert sorted(i for i in kept if i < 10_000) == list(range(0, 80, 2)) and len(kept) == 40 + more


def test_similarity_is_decided_exactly(spark):
    at, similarity = near_pairs(20, 8, 364)
    assert similarity == 0.8
    assert kept_of(spark, at) == list(range(0, 40, 2))
    under, similarity = near_pairs(20, 9, 364)
    assert 0.77 < similarity < 0.8
    assert kept_of(spark, under) == list(range(40))


def test_crowded_buckets_of_unlike_texts(spark, monkeypatch):
    """Texts of one template that differ more or less: components as of all pairs, in blocks of a few members."""
    rng = random.Random(5)
    texts = []
    for g in range(3):
        base = [f"t{g}x{k}" for k in range(200)]
        for k in range(40):
            own = list(base)
            for at in rng.sample(range(200), rng.choice((1, 2, 3, 6))):
                own[at] = f"v{g}x{rng.randrange(4) if k % 2 else k}"
            texts.append(" ".join(own))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(196)} for t in texts]
    pairs = [(a, b) for a in range(len(texts)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = sorted(set(linked(len(texts), pairs)))
    assert 3 < len(want) < 100
    assert kept_of(spark, texts) == want
    for name, few in (("FEW", 2), ("PART", 8), ("HASHES", 1000), ("LEADERS", 1)):
        monkeypatch.setattr(simhash, name, few)
    assert kept_of(spark, texts) == want


def test_keep_one_links_by_fingerprint(spark):
    """Groups as of all pairs: fingerprints at most two bits apart, or sets of a similarity of 0.8; either finds pairs that the other lacks."""
    rng = random.Random(21)
    pool = [f"v{k}" for k in range(5000)]
    texts = ["", " \n", "one two", "One  TWO", "a " * 40, "a " * 55 + "b " * 30]
    for g in range(12):  # a passage over and over, and an end of its own: nearly one fingerprint, sets unlike
        block = " ".join(rng.sample(pool, 9))
        texts += [" ".join([block] * 60 + rng.sample(pool, n)) for n in (12, 14, 16)]
    crowd = rng.sample(pool, 300)  # distinct fingerprints of one bucket, more than are paired off
    for k in range(simhash.PAIRED + 10):
        texts.append(" ".join([*crowd, f"end{k}"]))
    texts += near_pairs(10, 8)[0] + near_pairs(10, 9, 364)[0] + [words(60, k) for k in range(20)]

    fps = [simhash.fingerprint(t, 5) for t in texts]
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    group, by_print, by_set = list(range(len(texts))), 0, 0
    for j in range(len(texts)):
        for i in range(j):
            near = (fps[i] ^ fps[j]).bit_count() <= 2
            both = len(sets[i] | sets[j])
            like = len(sets[i] & sets[j]) >= 0.8 * both if both else True
            by_print, by_set = by_print + (near and not like), by_set + (like and not near)
            if (near or like) and group[i] != group[j]:
                a, b = sorted((group[i], group[j]))
                group = [a if x == b else x for x in group]
    assert by_print >= 10 and by_set >= 10
    assert kept_of(spark, texts) == sorted(set(group))
