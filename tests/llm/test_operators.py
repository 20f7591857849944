"""PII, license scan, WARC, decontamination, quality and the pipeline, on hostile rows and against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from lexipress.llm import common, decontaminate, license_scan, pii, quality, queries, simhash, warc
from tests.llm.fixtures import DOCS, documents, extra_columns, words
from tests.llm.test_tokens import reference_ids


def plain_base(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


PII_TEXTS = [
    "a@b.c.d, x@y a.b+c@d-e.f.g@h.i @z.z a@@b.c",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0004 1.2.3 9.9.9.9.",
    "4111 1111 1111 1111, 4111-1111-1111-1112; 41111111111111114111111111111111 0000000000000",
    "+1 (743) 555-3824 +49.30.1234567 +1 +12345678 ++123456789 +1----------2",
]


@given(st.text(alphabet=st.sampled_from(list("aZ09.@-+ ()%_é\n1234")), max_size=80) | st.sampled_from(PII_TEXTS))
@settings(max_examples=800, deadline=None)
def test_base_spans(text):
    assert pii.base_spans(text) == plain_base(text)


def test_field_on_unseen_sentences():
    field, right, wrong = pii.trained(), 0, 0
    for text, spans in pii._sentences(300, 12345):
        tokens, segments = pii.lattice(text, 0, len(text), [])
        got = {(tokens[i][0], tokens[j - 1][1], y) for i, j, y in field.decode(len(tokens), segments)}
        right, wrong = right + len(got & set(spans)), wrong + len(got ^ set(spans))
    assert wrong <= 0.06 * right


def test_decoding_is_the_best_choice():
    """The dynamic programme against all choices of segments."""
    field = pii.trained()
    for text in ["call (743) 555-3824 or 743-555-3824", "4111111111111111 4111111111111111", "ssn 123-45-6789 a [at] b [dot] com"]:
        tokens, segments = pii.lattice(text, 0, len(text), [])
        scored = [(i, j, y, field.weights[field.known(f)].sum(axis=0)[y]) for i, j, f in segments for y in range(len(pii.KINDS))]

        def best(at, was):
            if at == len(tokens):
                return 0.0, []
            out, end = len(pii.KINDS), best(at + 1, len(pii.KINDS))
            options = [(field.follow[was, out] + end[0], end[1])]
            for i, j, y, s in scored:
                if i == at and s > -2:
                    rest = best(j, y)
                    options.append((field.follow[was, y] + s + rest[0], [(i, j, y), *rest[1]]))
            return max(options, key=lambda o: o[0])

        assert field.decode(len(tokens), segments) == best(0, len(pii.KINDS))[1]


def test_pii_rows(spark):
    more = [(100 + k, t) for k, t in enumerate(PII_TEXTS)] + [(110, "tel (743) 555-3824 at noon, 日本 token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\""), (111, "9" * 3000 + "." + "1 " * 500 + "@" * 300)]
    docs = documents(spark, more)
    got = sorted(map(tuple, pii.find(extra_columns(docs)).collect()), key=str)
    want = []
    for r in docs.collect():
        base = plain_base(r["text"] or "")
        n = [sum(k == kind for k, _, _ in base) for kind in ("email", "ip", "card", "phone")]
        want.append((r["doc_id"], *n, hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()))
    assert [g[:6] for g in got] == [w for w in sorted(want, key=str)] or sorted((g[:6] for g in got), key=str) == sorted(want, key=str)
    spans = {g[0]: g[6] for g in got}
    assert spans[110].startswith("phone:4:18,secret:")
    for g in got:
        assert pii.find(spark.createDataFrame([], DOCS)).count() == 0
        break
    clean = pii.redact_texts(docs).where("doc_id = 110").head()
    assert clean["text"] == 'tel [PHONE] at noon, 日本 token = "[SECRET]"' and clean["n_chars"] == len(clean["text"])
    assert pii.redact_texts(docs).where("doc_id = 8").head()["text"] is None


def plain_license(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for phrase, label in license_scan.PHRASES.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_license_scan(spark, sf_dir):
    notice = next(t for t, x in license_scan.NOTICES.items() if x == "isc")
    more = [
        (100, "Released under the MIT License. MIT license; mit-license"),
        (101, "GNU General  Public\nLicense GNU GENERAL PUBLIC LICENSE gnu general gnu public license"),
        (102, "CC BY-NC 4.0 cc by cc.by ccby Apache Licenseé apache license"),
        (103, "so: " + notice.replace("modify", "change it or") + " ok"),
        (104, "mit license"),
        (104, "mit license"),
        (105, "apache " + "license apache " * 3000),
    ]
    for docs in (extra_columns(documents(spark, more)), spark.read.parquet(f"{sf_dir}/documents.parquet")):
        got = [(str(r["doc_id"]), r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in license_scan.scan(docs).collect()]
        assert sorted(got, key=str) == sorted(((str(r["doc_id"]), *plain_license(r["text"])) for r in docs.select("doc_id", "text").collect()), key=str)
    rows = {r["doc_id"]: r for r in license_scan.scan(documents(spark, more)).collect()}
    assert rows[103]["labels"] == "isc" and 0.7 <= rows[103]["score"] < 1 and rows[104]["score"] == 1.0
    assert rows[102]["labels"] == "apache,cc-by,cc-by-nc" and rows[1]["labels"] == "" and rows[1]["score"] == 0.0
    assert license_scan.scan(spark.createDataFrame([], DOCS)).count() == 0


def test_copies_of_a_notice_side_by_side(spark):
    r = random.Random(5)
    texts = {
        1: ("mozilla public license mozilla public license", "mpl", 1.0),
        2: ("all rights reserved. all rights reserved.", "proprietary", 1.0),
        3: ("cc by nc cc by nc", "cc-by,cc-by-nc", 1.0),
        4: ("cc by or cc by sa 4 0", "cc-by,cc-by-sa", 1.0),
        5: ("mozilla x public license", "", 0.0),
        6: ("plain words alone", "", 0.0),
    }
    both = {**license_scan.PHRASES, **license_scan.NOTICES}
    want = {k: (set(x.split(",")) - {""}, y) for k, (_, x, y) in texts.items()}
    for k in range(40):  # whole notices in a row, some with words between
        chosen = r.choices(list(both), k=r.randrange(1, 6))
        texts[100 + k] = (r.choice(("; ", " pad ")).join(chosen), None, None)
        text = f" {' '.join(re.findall('[a-z0-9]+', texts[100 + k][0]))} "
        want[100 + k] = ({x for t, x in both.items() if f" {t} " in text}, 1.0)
    docs = spark.createDataFrame([(k, t[0].title()) for k, t in texts.items()], "doc_id long, text string")
    for row in license_scan.scan(docs).collect():
        got, (labels, score) = set(row["labels"].split(",")) - {""}, want[row["doc_id"]]
        assert row["score"] == score and (got >= labels if row["doc_id"] >= 100 else got == labels), (texts[row["doc_id"]], row)


def test_license_scan_is_native(spark, sf_dir):
    plan = queries.queries()["op3_license_scan"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_warc(spark):
    long = "<p>é</p>" * 200
    rows = [(1, "http://a/\r\nX: y", long), (2, None, long), (3, "u", long), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""), (None, "u", long), (3, "u", long), (8, "u", "a\r\n\r\n" * 300), (None, "u", "z" * 2000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as digest", "1 as size", "'r' as record_id", "2 as original")
    manifest = warc.write_archives(pages, archives=2)
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.read_archives(manifest).collect()), key=str)
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        ids = [p for p, _, h in rows if h == html and p is not None]
        original = max(ids, default=None) if len(data) >= 1000 else None
        revisit = original is not None and (page is None or page < original)
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", original if revisit else None))
    assert got == sorted(want, key=str)
    payloads = {r["page_id"]: r["payload"] for r in warc.read_archives(manifest, with_payload=True).collect() if r["record_type"] == "response" and r["page_id"]}
    assert bytes(payloads[3]) == long.encode() and bytes(payloads[8]) == rows[9][2].encode()
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_damaged_archives():
    import io

    record = warc.encode_record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None, warc.DATE)
    (member,) = warc.read_members(io.BytesIO(record))
    assert warc.parse_record(member)[1] == b"payload"
    with pytest.raises(ValueError):
        list(warc.read_members(io.BytesIO(record[:-9])))


def contaminated(doc, item):
    if len(item) < decontaminate.SHORTEST:
        return bool(item) and doc == item
    if len(item) < decontaminate.STRETCH:
        return any(sum(x == y for x, y in zip(doc[i : i + len(item)], item, strict=True)) >= len(item) - 1 for i in range(len(doc) - len(item) + 1))
    for d in range(-len(item), len(doc)):
        lo, hi = max(0, -d), min(len(item), len(doc) - d)
        equal = [item[j] == doc[j + d] for j in range(lo, hi)]
        if any(sum(equal[k : k + decontaminate.STRETCH]) >= decontaminate.EQUAL for k in range(len(equal) - decontaminate.STRETCH + 1)):
            return True
    return False


def test_decontamination(spark, sf_dir):
    r = random.Random(4)
    items = [words(n, 100 + n, 5000).split() for n in (1, 3, 5, 6, 7, 8, 9, 10, 11, 25, 40)]
    items += [items[-1]]
    docs = [(3000 + k, ", ".join(i[: 4 + k])) for k, i in enumerate(items)]  # short items are whole documents
    for k in range(60):  # one unequal word and two, and an end that is missing
        i = list(items[2 + k % 5])
        for at in r.sample(range(len(i)), 1 + (k % 7 == 0)):
            i[at] = "sub"
        docs.append((4000 + k, "pad " + " ".join(i[: len(i) - (k % 11 == 0)])))
    docs += [(1000 + k, " ".join(["pad"] * 5 + i + ["pad"] * 3)) for k, i in enumerate(items)]
    for k in range(60):
        i = list(r.choice(items[7:]))
        for _ in range(r.randrange(0, 1 + len(i) // 4)):
            i[r.randrange(len(i))] = f"sub{r.randrange(99)}"
        a = r.randrange(0, max(1, len(i) - 8))
        docs.append((2000 + k, words(20, 300 + k) + " " + " ".join(i[a:]) + ", " + words(5, 400 + k)))
    benchmark = spark.createDataFrame([(k, " ".join(i).upper()) for k, i in enumerate(items)] + [(50, None), (51, "")], "item_id long, text string").selectExpr("*", "'x' as words", "1 as at", "'q' as name")
    frame = documents(spark, docs)
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    want = {(str(d), k) for d, t in ((r["doc_id"], r["text"]) for r in frame.collect()) for k, i in enumerate(items) if contaminated(split(t), i)}
    got = decontaminate.overlaps(extra_columns(frame), benchmark).collect()
    assert {(str(g["doc_id"]), g["item_id"]) for g in got} == want and len(want) > 20
    assert all(g["n_equal"] >= 0.8 * g["n_words"] or g["n_words"] < 15 for g in got)
    left = decontaminate.decontaminate(frame, benchmark)
    assert left.columns == frame.columns
    bad = {d for d, _ in want}
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(r["doc_id"]) for r in frame.collect() if str(r["doc_id"]) not in bad)
    assert decontaminate.overlaps(frame, benchmark.limit(0)).count() == 0 and decontaminate.overlaps(frame.limit(0), benchmark).count() == 0


def test_seeds_miss_nothing():
    from itertools import combinations

    for bad in combinations(range(10), 2):
        assert any(not {o + p for p in m} & set(bad) for m in decontaminate.SEEDS for o in range(10 - m[-1]))


def test_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = {r["doc_id"]: r for r in queries.queries()["op10_quality"](spark, "/root/testdata/sf0.01").collect()}
    assert len(rows) == docs.count()
    truth = [(rows[r["doc_id"]]["predicted"], r["quality"]) for r in labels.collect() if rows[r["doc_id"]]["held_out"]]
    assert np.mean([p == q for p, q in truth]) >= 0.95
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())


def plain_features(text):
    """Counts of words and of three-character shapes, by the rules of the docstring, in plain Python."""
    out = np.zeros(quality.FEATURES)
    data = text.encode()
    for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", data):
        (h,), _ = quality.textkernel.words(pa.array([w.lower().decode()]), quality.textkernel.ALNUM)
        out[int(h[0]) >> (64 - quality.WORD_BITS)] += 1
    shape = [0x30 if 48 <= c < 58 else 0x41 if 65 <= c < 91 else 0x61 if 97 <= c < 123 or c >= 128 else 0x20 if c in (9, 11, 12, 13) else c for c in data]
    for x, y, z in zip(shape, shape[1:], shape[2:], strict=False):
        out[(1 << quality.WORD_BITS) + ((((x << 16) + (y << 8) + z) * 0x9E3779B97F4A7C15 % 2**64) >> (64 - quality.SHAPE_BITS))] += 1
    return out


def test_scores_against_brute_force(spark, sf_dir):
    """Every neighbour by every cosine, one document at a time, and votes of all ties."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    copies = docs.where("doc_id < 40").selectExpr("doc_id + 100000 as doc_id", "text")  # rows as near as each other
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = quality.fit(docs.union(copies), labels.union(labels.where("doc_id < 40").selectExpr("doc_id + 100000", "quality")), per_label=60)
    half = 1 << quality.WORD_BITS
    for row in quality.score(docs.orderBy("doc_id").limit(60), model).collect():
        x = np.log1p(plain_features(row["text"] or "")) * model.idf
        for part in (x[:half], x[half:]):
            part /= max(np.linalg.norm(part), 1e-12)
        v = (x - model.centre) @ model.project
        cosine = [float(v @ u) / max(np.linalg.norm(v), 1e-12) for u in model.vectors]
        last = sorted(cosine)[-quality.NEIGHBOURS]
        votes = [(max(c, 1e-6) ** 4 * s, y) for c, s, y in zip(cosine, model.stands_for, model.labels, strict=True) if c >= last - 1e-6]
        assert abs(row["quality_score"] - sum(w * y for w, y in votes) / sum(w for w, _ in votes)) < 2e-3


def test_many_rows_of_one_labelled_id(spark):
    docs = spark.createDataFrame([(1, f"text {k} of many") for k in range(300)] + [(k, words(30, k)) for k in range(2, 20)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 20)], "doc_id long, quality int")
    assert len(quality.fit(docs, labels).labels) <= 19


def test_quality_edges(spark):
    docs = extra_columns(documents(spark))
    labels = spark.createDataFrame([(1, 1), (2, None), (4, 0), (4, 1), (None, 1), (999, 0), (6, 1)], "doc_id long, quality int")
    scored = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(scored) == docs.count() and all(0 <= r["quality_score"] <= 1 for r in scored) and "clash" in scored[0].asDict().values()
    none = quality.score(docs, quality.fit(docs, labels.limit(0))).collect()
    assert {r["quality_score"] for r in none} == {0.5}
    assert quality.score(docs.limit(0), quality.fit(docs.limit(0), labels)).count() == 0


def test_keep_one(spark):
    docs = documents(spark)
    kept = simhash.keep_one(docs)
    found = {(r["doc_id"]): r["component_id"] for r in simhash.near_duplicates(docs.where("doc_id is not null and doc_id not in (5, 7)")).collect()}
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == docs.columns and None not in ids and ids.count(7) == 1
    assert {i for i in ids if i not in (5, 7)} <= {i for i, c in found.items() if i == c}
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_similar_groups(spark):
    r = random.Random(8)

    def changed(text, share):
        w = text.split()
        for k in r.sample(range(len(w)), int(len(w) * share)):
            w[k] = f"new{r.randrange(10**6)}"
        return " ".join(w)

    rows = []
    for g in range(12):  # groups of a text, near copies and a far one
        base = words(400, 900 + g, 5000)
        rows += [(g * 10, base), (g * 10 + 1, changed(base, 0.005)), (g * 10 + 2, changed(base, 0.01)), (g * 10 + 3, base.upper()), (g * 10 + 5, changed(base, 0.15))]
    crowd = words(500, 77, 5000)
    rows += [(1000 + k, changed(crowd, 0.008)) for k in range(150)] + [(2000 + k, crowd) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    kept = sorted(x["doc_id"] for x in simhash.keep_one(docs).collect())
    assert kept == sorted([g * 10 + k for g in range(12) for k in (0, 5)] + [1000])
    small = simhash.PART
    try:
        simhash.PART = 40  # crowded buckets in several parts
        assert sorted(x["doc_id"] for x in simhash.keep_one(docs).collect()) == kept
    finally:
        simhash.PART = small


def test_pipeline_stages_take_hostile_rows(spark, sf_dir):
    import corpus_pipeline as pipeline

    docs = documents(spark)
    for column in ("_key", "_digest", "_id", "quality_score", "_lexi_0", "_again", "rank", "node", "digest", "item_id"):
        docs = docs.withColumn(column, docs["lang"])
    for _, stage in pipeline.STAGES[:-1]:
        made = stage(spark, docs, sf_dir)
        assert made.columns == docs.columns and made.count() <= docs.count()
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    assert pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= docs.count()


def test_pipeline(spark, sf_dir):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    was = docs.collect()
    for name, stage in pipeline.STAGES[:-1]:
        docs = common.materialise(stage(spark, docs, sf_dir), name)
        now = docs.collect()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and len({r["doc_id"] for r in now}) == len(now)
        assert {r["doc_id"] for r in now} <= {r["doc_id"] for r in was}
        if name == "pii":
            assert len(now) == len(was) and not any(pii.base_spans(r["text"]) for r in now)
        else:
            assert {tuple(r) for r in now} < {tuple(r) for r in was}
        was = now
    rows = pipeline.run(spark, sf_dir).collect()
    tokens = {r["doc_id"]: len(reference_ids("word_bpe_49k.json", r["text"])) for r in was}
    got = {}
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == tokens


def test_leading_vectors_are_those_of_the_dense_solver():
    """Also of eigenvalues that are equal, or fewer than asked for; a fit has no second copy of the sample."""
    import tracemalloc

    import numpy as np

    r = np.random.default_rng(3)
    for spread in (np.linspace(30, 0.1, 1200), np.repeat(np.linspace(30, 1, 40), 30), np.r_[np.ones(5), np.zeros(1195)]):
        q = np.linalg.qr(r.standard_normal((1200, 1200)))[0]
        gram = ((q * spread) @ q.T).astype(np.float32)
        want = np.linalg.eigvalsh(gram.astype(np.float64))[-20:]
        values, vectors = quality._leading(gram, 20)
        assert np.allclose(values, want, atol=1e-5) and np.allclose(vectors.T @ vectors, np.eye(20), atol=1e-8)
        assert np.allclose(gram.astype(np.float64) @ vectors, vectors * values, atol=1e-5)
    counts = r.poisson(0.2, (600, quality.FEATURES)).astype(np.float32)
    tracemalloc.start()
    try:
        quality.Model(counts, np.arange(600) % 2, np.ones(600), 15, 48)
        assert tracemalloc.get_traced_memory()[1] < counts.nbytes
    finally:
        tracemalloc.stop()
