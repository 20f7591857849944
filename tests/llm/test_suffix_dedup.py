"""Suffix-array deduplication against counts of all windows, and its sorting against sorted()."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from lexipress.llm import common, suffix_dedup


def brute(texts, window):
    """Kept bytes and removed runs of each text, by counting every window."""
    blobs = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + window] for b in blobs for i in range(len(b) - window + 1))
    out = []
    for b in blobs:
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                gone[i : i + window] = True
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def texts_of(seed):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 9))) for _ in range(60)]
    passage = " ".join(r.choice(words) for _ in range(40))
    texts = [" ".join(r.choice(words) for _ in range(r.randint(0, 90))) for _ in range(25)]
    texts += [f"{r.choice(words)} {passage} {r.choice(words)} {t}" for t in texts[:8]]  # one passage in many contexts
    texts += [texts[0] + passage, texts[0] + passage, passage * 3, "ab" * 150, "x" * 400, "x" * 90, "", None]
    near = list(passage * 2)
    near[len(near) // 2] = "#"
    return [*texts, "".join(near)]


def got(df):
    return {r["doc_id"]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("window, gram, crowd", [(40, 8, 1 << 22), (40, 24, 200), (64, 16, 0), (33, 33, 1 << 22)])
def test_equals_brute_force(spark, window, gram, crowd):
    texts = texts_of(window)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = got(suffix_dedup.remove_repeats(docs, window, gram, crowd=crowd))
    for k, want in enumerate(brute(texts, window)):
        assert (*found[k][:4], bytes(found[k][4])) == want, texts[k]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=12, max_size=60).map(lambda b: bytes(x % 3 + 97 for x in b)), min_size=1, max_size=12))
def test_suffixes_are_sorted(blobs):
    window = 12
    data = np.frombuffer(b"".join(blobs) + bytes(window + 8), dtype=np.uint8)
    sizes = np.array([len(b) for b in blobs])
    starts = np.concatenate([b + np.arange(n - window + 1) for b, n in zip(np.cumsum(sizes) - sizes, sizes, strict=True)])
    groups = np.sort(starts % 2)
    order, same = suffix_dedup.sort_suffixes(data, starts, groups, window, shallow=8)
    keys = [(groups[i], bytes(data[starts[i] : starts[i] + window])) for i in order]
    assert keys == sorted(keys)
    assert same.tolist() == [i > 0 and keys[i] == keys[i - 1] for i in range(len(keys))]


def test_deep_groups_are_ordered_by_tries():
    """Suffixes that differ at every depth beyond the shallow one."""
    base = bytes(range(97, 123)) * 8
    blobs = [base[:k] + c + base[k + 1 :] for k in range(16, 200, 7) for c in (b"A", b"z", b"~")] + [base, base]
    data = np.frombuffer(b"".join(blobs) + bytes(208), dtype=np.uint8)
    starts = np.arange(len(blobs)) * len(base)
    order, same = suffix_dedup.sort_suffixes(data, starts, np.zeros(len(blobs), dtype=int), 200)
    keys = [blobs[i][:200] for i in order]
    assert keys == sorted(keys) and same.sum() == sum(a == b for a, b in zip(keys, keys[1:], strict=False))


def test_a_long_text_is_read_in_slices(spark):
    r = random.Random(5)
    part = "".join(r.choice("abcdefgh ") for _ in range(500))
    long = part + "".join(r.choice("ijklmnop ") for _ in range((1 << 20) - 700)) + part + "".join(r.choice("qrst ") for _ in range(900_000)) + part
    found = got(suffix_dedup.remove_repeats(spark.createDataFrame([(1, long), (2, "short")], "doc_id long, text string")))
    assert found[1][1] >= 1500 and found[1][2] == 3 and found[1][0] == len(long) and found[2][:3] == (5, 0, 0)


def test_rows(spark):
    """Null and repeated ids, equal rows, clashing names, an empty table."""
    a, b = "left " * 60, "".join(random.Random(1).choice("xyzuvw ") for _ in range(300))
    rows = [(None, b, 1), (None, None, 2), (7, b, 3), (7, b, 4), (7, "other", 5), (8, a, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    found = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffix_dedup.remove_repeats(docs).collect())
    assert found == [(0, 0, 0, 0), (0, 300, 300, 1), (7, 5, 0, 0), (7, 300, 300, 1), (7, 300, 300, 1), (8, 300, 300, 1)]
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_query(spark, sf_dir):
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    found = got(suffix_dedup.op13_suffix_dedup(spark, sf_dir))
    want = brute([r["text"] for r in docs], suffix_dedup.WINDOW)
    assert {r["doc_id"]: w[:4] for r, w in zip(docs, want, strict=True)} == found
