"""Embedding near-duplicates through navigable small-world graphs, one for each shard.

Vectors of one label (and length) are folded by value and dealt over shards of bounded
size; each shard gets a graph.  Every shard of a label is queried with all the label's
vectors, block by block.  A block first audits the graph: a fixed choice of its queries
is also compared with the whole shard, and the beam is doubled until the audit's recall
passes.  A query that finds half its beam within the threshold then meets the whole shard,
so a dense group is never cut off.  What is found is verified in double
precision and united: a task passes on one edge for each vector it linked, and components
are found over all edges.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, hnsw
from .components import components

THRESHOLD = 0.93
#: Vectors of a shard on average, and queries of a block.
SHARD = 8192
FIRST_BEAM = 16
AUDITED = 256
RECALL = 0.99
#: A single-precision similarity may be so much less than the exact one.
_SLACK = 1e-4

_INDEX = "label long, dim int, shard int, graph binary"
_FOUND = "node long, links long, least long"


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float32) for v in column])


def _build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("node", kind="stable")
    exact = _stack(rows["embedding"])
    graph = hnsw.Graph(hnsw.unit(exact).astype(np.float32))
    blob = pickle.dumps((graph, rows["node"].to_numpy(), rows["copies"].to_numpy(), exact), protocol=5)
    return pd.DataFrame({"label": [key[0]], "dim": [key[1]], "shard": [key[2]], "graph": [blob]})


def audited_beam(graph: hnsw.Graph, q: np.ndarray, threshold: float, beam: int = FIRST_BEAM, recall: float = RECALL) -> int:
    """Least doubling of ``beam`` that passes the audit.

    AUDITED queries are compared with the whole shard; the share ``recall`` of their
    neighbours within the threshold, as many as half a beam holds, must be found.  Where
    the sample has few neighbours within the threshold, looser ones are audited with them.
    """
    n = len(graph.x)
    chosen = q[np.unique(np.linspace(0, len(q) - 1, AUDITED).astype(np.int64))]
    sims = chosen @ graph.x.T
    order = np.argsort(-sims, axis=1, kind="stable")
    for loose in (0.0, 0.1, 0.2):
        within = (sims >= threshold - loose).sum(axis=1)
        if (within > 1).sum() >= 8:  # a query is its own neighbour
            break
    while beam < n:
        ids, _ = graph.search(chosen, beam)
        want = hit = 0
        for row, found in enumerate(ids):
            true = graph.order[order[row, : min(beam // 2, int(within[row]))]]
            want, hit = want + len(true), hit + len(np.intersect1d(true, found))
        if hit >= recall * want:
            break
        beam *= 2
    return min(beam, n)


def links_of(graph: hnsw.Graph, q: np.ndarray, threshold: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) pairs whose similarity reaches the threshold, less the slack.

    A query half of whose beam is within the threshold stands in a dense group: its beam is
    widened to the whole shard, which is a comparison with all of it, in blocks.
    """
    ids, sims = graph.search(q, beam)
    within = (sims >= threshold - _SLACK) & (ids >= 0)
    dense = within.sum(axis=1) * 2 >= beam
    at, k = np.nonzero(within & ~dense[:, None])
    rows, nodes = [at], [ids[at, k]]
    todo = np.flatnonzero(dense)
    for k in range(0, len(todo), 512):
        at, node = np.nonzero(q[todo[k : k + 512]] @ graph.x.T >= threshold - _SLACK)
        rows.append(todo[k : k + 512][at])
        nodes.append(graph.order[node])
    return np.concatenate(rows), np.concatenate(nodes)


def _query(threshold: float, recall: float):
    def run(key: tuple, queries: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"node": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64"), "least": pd.Series(dtype="int64")})
        if not len(queries) or not len(index):
            return empty
        graph, nodes, copies, exact = pickle.loads(index["graph"].iloc[0])  # noqa: S301  made by _build
        own = queries["node"].to_numpy()
        q = hnsw.unit(_stack(queries["embedding"]))
        q32 = q.astype(np.float32)
        a, b = links_of(graph, q32, threshold, audited_beam(graph, q32, threshold, recall=recall))
        whole = hnsw.unit(exact)
        cosine = np.concatenate([np.zeros(0), *(np.einsum("ij,ij->i", q[a[k : k + 65536]], whole[b[k : k + 65536]]) for k in range(0, len(a), 65536))])
        good = (cosine >= threshold) & (own[a] != nodes[b])
        a, b = a[good], b[good]
        if not len(a):
            return empty
        links = np.bincount(a, weights=copies[b], minlength=len(own)).astype(np.int64)
        # One edge for each vector: to the least one of its links within this task.
        ids, flat = np.unique(np.concatenate((own[a], nodes[b])), return_inverse=True)
        x, y = flat[: len(a)], flat[len(a) :]
        least = np.arange(len(ids))
        while True:
            low = np.minimum(least[x], least[y])
            before = least.copy()
            np.minimum.at(least, x, low)
            np.minimum.at(least, y, low)
            least = least[least]
            if (least == before).all():
                break
        counted = dict(zip(own.tolist(), links.tolist(), strict=True))
        return pd.DataFrame({"node": ids, "links": [counted.get(i, 0) for i in ids.tolist()], "least": ids[least]})

    return run


def _shards_of(nodes: DataFrame, shard: int) -> DataFrame:
    # Counted by label and length, joined by label alone (the length is no key): Spark can then split a hot label.
    sizes = nodes.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard).cast("int").alias("shards")).withColumnRenamed("dim", "of_dim")
    return nodes.join(sizes, "label").where("(dim ^ of_dim) = 0").select("node", "first", "copies", "label", "dim", "shards", "embedding")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, shard: int = SHARD, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding, label).

    Two vectors are linked when their labels are equal and not null, their lengths are
    equal and their cosine in double precision reaches ``threshold``.  A vector that is
    null, empty, zero, or holds null or non-finite components, or has a null label or
    vec_id, is linked with nothing; its component is itself.  Equal vectors are folded
    before the search and counted as links of each other.  Rows that share a vec_id are
    rows of their own and links of each other if their vectors are.  Other columns are not
    read; an empty table gives no rows.
    """
    spark: SparkSession = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"), F.col("label").cast("long").alias("label"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = common.materialise(rows.withColumn("good", good), "vectors")
    usable = rows.where("good").select("vec_id", "label", "embedding")
    # Nodes are named by what they are: a vec_id may occur twice.
    folded = usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies")).withColumn("node", F.xxhash64("label", "embedding"))
    nodes = common.materialise(_shards_of(folded.withColumn("dim", F.size("embedding")), shard), "nodes")
    placed = nodes.withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int"))
    index = common.materialise(placed.select("label", "dim", "shard", "node", "copies", "embedding").groupBy("label", "dim", "shard").applyInPandas(_build, _INDEX), "graphs")
    block = F.pmod(F.xxhash64("node", F.lit(1)), F.col("shards")).cast("int")
    asked = nodes.withColumn("block", block).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).select("label", "dim", "shard", "block", "node", "embedding")
    sizes = nodes.select("label", "dim", "shards").distinct()
    answering = index.join(sizes, ["label", "dim"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).select("label", "dim", "shard", "block", "graph")
    keys = ["label", "dim", "shard", "block"]
    found = asked.groupBy(*keys).cogroup(answering.groupBy(*keys)).applyInPandas(_query(threshold, recall), _FOUND)
    found = common.materialise(found, "found")
    united = common.materialise(components(found.where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))), "components")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    by_value = nodes.select("label", "embedding", "node", "first", "copies").join(links, "node", "left").join(united, "node", "left").withColumn("component", F.coalesce("component", "node"))
    by_value = common.materialise(by_value, "linked")
    smallest = by_value.groupBy("component").agg(F.min("first").alias("component_id"))
    by_value = by_value.join(smallest, "component").select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    told = rows.where("good").join(by_value, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return told.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``embeddings``: links, component and whether a vector is its component's smallest."""
    return near_duplicates(common.read_table(spark, sf_dir, "embeddings"))
