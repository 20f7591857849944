import numpy as np
from lexipress.llm import embedding_dedup, hnsw
from tests.llm.test_dedup import linked


def plain(rows, threshold=0.93):
    usable = []
    for i, v, label in rows:
        ok = i is not None and label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        usable.append(np.array(v, dtype=np.float32).astype(np.float64) if ok else None)
    pairs, links = [], [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if usable[a] is not None and usable[b] is not None and rows[a][2] == rows[b][2] and len(usable[a]) == len(usable[b]):
                c = usable[a] @ usable[b] / np.sqrt((usable[a] @ usable[a]) * (usable[b] @ usable[b]))
                if c >= threshold:
                    pairs.append((a, b))
                    links[a] += 1
                    links[b] += 1
    of = linked(len(rows), pairs)
    least = {}
    for k, c in enumerate(of):
        if rows[k][0] is not None:
            least[c] = min(least.get(c, rows[k][0]), rows[k][0])
    return sorted((str(rows[k][0]), links[k], str(least.get(c)), rows[k][0] == least.get(c)) for k, c in enumerate(of))


def got(frame):
    return sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in frame.collect())


def test_against_all_pairs(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert got(embedding_dedup.near_duplicates(df)) == plain(rows)
    assert got(embedding_dedup.near_duplicates(df, shard=20)) == plain(rows)


def test_hostile_rows(spark):
    r = np.random.default_rng(1)
    rows, centre = [], r.normal(size=8)
    for i in range(400):
        base = centre if i % 3 == 0 else r.normal(size=8)  # a third is one dense group
        rows.append((i, (base + r.normal(size=8) * 0.1).astype(np.float32).tolist(), i % 2))
    rows += [(500 + i, rows[0][1], 0) for i in range(30)]  # exact copies
    rows += [(600, None, 0), (601, [], 0), (602, [0.0] * 8, 0), (603, [float("nan")] + [1.0] * 7, 0), (604, [float("inf")] + [1.0] * 7, 0), (605, [None] + [1.0] * 7, 0), (606, rows[0][1], None), (None, rows[0][1], 0)]
    rows += [(607, rows[0][1][:5], 0), (608, [x * 3e30 for x in rows[0][1]], 0), (609, [1e-30] + [0.0] * 7, 0), (5, rows[9][1], 1), (5, rows[9][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "'x' as node", "'y' as shard", "1 as links")
    assert got(embedding_dedup.near_duplicates(df)) == plain(rows)
    assert got(embedding_dedup.near_duplicates(df, shard=64)) == plain(rows)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_audited_recall():
    r = np.random.default_rng(2)
    centres = hnsw.unit(r.normal(size=(900, 32)))
    x = np.concatenate([centres, *(hnsw.unit(centres[: 900 // k] + r.normal(size=(900 // k, 32)) * 0.03) for k in (1, 2, 3)), hnsw.unit(centres[:1] + r.normal(size=(300, 32)) * 0.02)])
    x = x[r.permutation(len(x))].astype(np.float32)
    graph = hnsw.Graph(x)
    a, b = embedding_dedup.links_of(graph, x, 0.93, embedding_dedup.audited_beam(graph, x, 0.93))
    true = x @ x.T >= 0.93
    found = np.zeros_like(true)
    found[a, b] = True
    assert (found & true).sum() >= 0.995 * true.sum()


def test_tiny_graphs():
    for n in (1, 2, 3, 40):
        x = hnsw.unit(np.random.default_rng(n).normal(size=(n, 4))).astype(np.float32)
        ids, _ = hnsw.Graph(x).search(x, n)
        assert all(set(row) == set(range(n)) for row in ids.tolist())
