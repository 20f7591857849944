"""Centroid clustering by ball k-means, in whole numbers.

A cluster is a ball: its centroid and the distance to its farthest member.  Only centroids
nearer than twice that radius are its *neighbours*; no member can be closer to another one.
Half the distance to the nearest neighbour bounds the *stable core*, whose members stay
without a comparison; a member of the *annulus* between half the distances to its m-th and
next neighbour is compared with the m nearest alone.  Squared distances are exact integers,
so cores and annuli never decide differently from a comparison with every centroid.

Vectors are packed into blocks of ``BLOCK`` and written once, bucketed by block.  A round
reads them beside the small table of the last round's state, bucketed alike, and writes the
next state: each vector's cluster and the block's sums and radii of every cluster.  What
reaches the driver in a round has a size of clusters times components.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

CLUSTERS = 8
ROUNDS = 10
SEED = 3
COMPONENTS = 64
SCALE = 1024
#: Vectors of a block.
BLOCK = 4096
#: Components under this size have squared distances that fit a long.
LARGEST = 1 << 17

_PACKED = "ids array<long>, vectors binary"
_STATE = pa.schema([("block", pa.int64()), ("clusters", pa.binary()), ("summary", pa.list_(pa.int64()))])
_STATE_DDL = "block long, clusters binary, summary array<long>"
#: A cluster's numbers in a summary: its vectors, their squared distances summed, the largest of these, and the sums of all components.
_WIDTH = 3 + COMPONENTS


def _pack(batches):
    """Blocks of vectors as whole numbers."""
    for batch in batches:
        for k in range(0, batch.num_rows, BLOCK):
            part = batch.slice(k, BLOCK)
            values = part.column("vector").flatten().to_numpy(zero_copy_only=False)
            whole = np.floor(SCALE * values.astype(np.float64)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([part.column("vec_id").to_pylist()], type=pa.list_(pa.int64())), pa.array([whole.tobytes()], type=pa.binary())], ["ids", "vectors"])


class Balls:
    """Centroids, and for each ball the neighbours that its members can be closer to, nearest first."""

    def __init__(self, centroids: np.ndarray, radii: np.ndarray | None):
        """``radii``: bounds of the squared radii around these centroids, or None where nothing is known."""
        self.centroids = centroids
        apart = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
        self.neighbours, self.gaps = [], []
        for own in range(len(centroids)):
            order = np.argsort(apart[own], kind="stable")
            order = order[order != own]
            if radii is not None:
                order = order[apart[own, order] <= 4 * radii[own]]
            self.neighbours.append(order)
            self.gaps.append(apart[own, order])

    def assign(self, vectors: np.ndarray, was: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid (the smaller number of equal ones) and squared distance, from the balls the vectors were in."""
        cluster, best = was.copy(), np.zeros(len(vectors), dtype=np.int64)
        for own in range(len(self.centroids)):
            members = np.flatnonzero(was == own)
            if not len(members):
                continue
            inside = vectors[members]
            near = ((inside - self.centroids[own]) ** 2).sum(axis=1)
            # How many neighbours are at most twice as far from the centroid as the member is: its annulus.
            ring = np.searchsorted(self.gaps[own], 4 * near, side="right")
            chosen = np.full(len(members), own)
            for k in range(int(ring.max())):
                at = np.flatnonzero(ring > k)
                other = self.neighbours[own][k]
                far = ((inside[at] - self.centroids[other]) ** 2).sum(axis=1)
                closer = (far < near[at]) | ((far == near[at]) & (other < chosen[at]))
                near[at[closer]], chosen[at[closer]] = far[closer], other
            cluster[members], best[members] = chosen, near
        return cluster, best


def _vectors(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=np.int32).reshape(-1, COMPONENTS).astype(np.int64)


def _round(balls: Balls, first: bool):
    """States of blocks after an assignment to these balls."""
    k = len(balls.centroids)

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                vectors = _vectors(batch.column("vectors")[row].as_py())
                was = np.zeros(len(vectors), dtype=np.int64) if first else np.frombuffer(batch.column("clusters")[row].as_py(), dtype=np.uint16).astype(np.int64)
                cluster, near = balls.assign(vectors, was)
                summary = np.zeros((k, _WIDTH), dtype=np.int64)
                for c in np.unique(cluster).tolist():
                    own = cluster == c
                    summary[c, :3] = own.sum(), near[own].sum(), near[own].max()
                    summary[c, 3:] = vectors[own].sum(axis=0)
                yield common.batch_of(_STATE, ([batch.column("block")[row].as_py()], [cluster.astype(np.uint16).tobytes()], [summary.ravel()]))

    return run


def _final(balls: Balls, inertia: list[int], digests: list[str]):
    """A row a vector, from the clusters of the last assignment."""
    spec = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64()), ("cluster_inertia", pa.int64()), ("inertia", pa.int64()), ("centroid_sha256", pa.string())])

    def run(batches):
        per, names = np.array(inertia, dtype=np.int64), np.array(digests, dtype=object)
        for batch in batches:
            for row in range(batch.num_rows):
                vectors = _vectors(batch.column("vectors")[row].as_py())
                cluster = np.frombuffer(batch.column("clusters")[row].as_py(), dtype=np.uint16).astype(np.int64)
                near = ((vectors - balls.centroids[cluster]) ** 2).sum(axis=1)
                yield common.batch_of(spec, (batch.column("ids")[row].as_py(), cluster, near, per[cluster], np.full(len(cluster), sum(inertia)), names[cluster]))

    return run


class _Bucketed:
    """Tables of the shared folder, bucketed by block, so that joins by block move no vectors."""

    def __init__(self, spark: SparkSession):
        self.spark, self.buckets, self.tables = spark, common.shuffle_partitions(spark), {}

    def write(self, df: DataFrame, kind: str) -> DataFrame:
        name, uri = f"lexipress_{kind}_{uuid.uuid4().hex[:12]}", common.scratch(self.spark, kind)
        with common.shuffles_dropped(self.spark):
            df.repartition(self.buckets, "block").write.option("path", uri).bucketBy(self.buckets, "block").sortBy("block").saveAsTable(name)
        self.tables[name] = uri
        return self.spark.table(name)

    def drop(self, df_name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {df_name}")
        common.drop_scratch(self.tables.pop(df_name))


def _summary(state: DataFrame, clusters: int) -> list[tuple[int, int, int, list[int]]]:
    """Of each cluster: its vectors, their squared distances summed, the largest, and the sums of all components."""
    places = state.select(F.posexplode("summary").alias("k", "x")).groupBy("k").agg(F.sum(F.col("x").cast("decimal(38, 0)")).alias("sum"), F.max("x").alias("max"))
    with common.shuffles_dropped(state.sparkSession):
        found = {r["k"]: r for r in places.collect()}
    at = [[found[c * _WIDTH + k] for k in range(_WIDTH)] for c in range(clusters)]
    return [(int(r[0]["sum"]), int(r[1]["sum"]), r[2]["max"], [int(x["sum"]) for x in r[3:]]) for r in at]


def _root(x: int) -> int:
    """A whole number not under the square root of ``x``."""
    return int(np.sqrt(float(x)) * (1 + 1e-9)) + 1


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, pruned: bool = True) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector of (vec_id, embedding).

    Kept are vectors of exactly ``COMPONENTS`` components, none null, non-finite or of a size of
    2**17 or more (their squared distances do not fit a long); the others give no row.  Rows that
    share a vec_id are vectors of their own; one with a null vec_id is clustered like any other but
    is never a first centroid unless there are too few.  Fewer vectors than clusters: so many
    clusters.  Equal distances go to the smaller number, a cluster without vectors keeps its
    centroid.  No kept vector gives no rows; other columns are not read.  ``pruned=False`` compares
    with every centroid, for tests.
    """
    spark: SparkSession = vectors.sparkSession
    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    fine = (F.size("vector") == COMPONENTS) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST))
    source = source.where(F.coalesce(fine, F.lit(False)))

    order = [F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).asc_nulls_last(), F.col("vector").asc()]
    with common.shuffles_dropped(spark):
        first = [r["vector"] for r in source.orderBy(*order).select("vector").limit(clusters).collect()]
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = np.floor(SCALE * np.array(first, dtype=np.float64)).astype(np.int64)

    common.small_batches(spark)
    tables = _Bucketed(spark)
    with common.rows_in_a_batch(spark, BLOCK):
        packed = tables.write(source.mapInArrow(_pack, _PACKED).withColumn("block", F.monotonically_increasing_id()), "vectors")
    state, radii = None, None
    for turn in range(rounds + 1):
        balls = Balls(centroids, radii if pruned else None)
        rows = packed.select("block", "vectors")
        if state is not None:
            # The state is the small side: a table of its bucket is built, the vectors stream past it.
            rows = rows.join(state.select("block", "clusters").hint("shuffle_hash"), "block")
        with common.rows_in_a_batch(spark, 1):
            new = tables.write(rows.mapInArrow(_round(balls, state is None), _STATE_DDL), "state")
        if state is not None:
            tables.drop(before)
        state, before = new, list(tables.tables)[-1]
        found = _summary(state, len(centroids))
        if turn < rounds:
            moved = np.array([[x // n for x in sums] if n else old for (n, _, _, sums), old in zip(found, centroids.tolist(), strict=True)], dtype=np.int64)
            # A ball around the moved centroid: its radius has grown by the way at most.
            ways = ((moved - centroids) ** 2).sum(axis=1).tolist()
            radii = np.array([(_root(reach) + _root(way)) ** 2 for (_, _, reach, _), way in zip(found, ways, strict=True)], dtype=np.int64)
            centroids = moved
    inertia = [spread for _, spread, _, _ in found]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = packed.join(state.select("block", "clusters").hint("shuffle_hash"), "block")
    return rows.mapInArrow(_final(Balls(centroids, None), inertia, digests), "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")


def op12_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``embeddings``: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    return cluster(common.read_table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """Every assignment compares with every centroid; the rounds are written one after the other."""
    steps = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), vec_id) - 1 AS r, vec_id, x, list_dot_product(x, x) AS xx FROM (SELECT vec_id, list_transform(embedding, lambda e: floor({SCALE} * CAST(e AS DOUBLE))) AS x FROM embeddings
  WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda e: isfinite(e))) = {COMPONENTS}))""",
        f"c0 AS MATERIALIZED (SELECT r AS c, x, xx FROM kept WHERE r < {CLUSTERS})",
    ]
    for k in range(ROUNDS + 1):
        steps.append(f"a{k} AS MATERIALIZED (SELECT v.r, arg_min(c.c, (v.xx - 2 * list_dot_product(v.x, c.x) + c.xx, c.c)) AS c, min(v.xx - 2 * list_dot_product(v.x, c.x) + c.xx) AS d FROM kept v CROSS JOIN c{k} c GROUP BY v.r)")
        if k < ROUNDS:
            mean = f"SELECT c, list(m ORDER BY i) AS x FROM (SELECT a.c, i, floor(sum(x[i]) / count(*)) AS m FROM a{k} a JOIN kept USING (r), generate_series(1, {COMPONENTS}) t(i) GROUP BY ALL) GROUP BY c"
            steps.append(f"c{k + 1} AS MATERIALIZED (SELECT c, x, list_dot_product(x, x) AS xx FROM (SELECT o.c, coalesce(n.x, o.x) AS x FROM c{k} o LEFT JOIN ({mean}) n USING (c)))")
    last = f"""SELECT v.vec_id, a.c::INTEGER AS cluster, a.d::BIGINT AS distance, sum(a.d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia, sum(a.d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(list_transform(c.x, lambda e: CAST(e AS BIGINT)), ',')) AS centroid_sha256 FROM a{ROUNDS} a JOIN kept v USING (r) JOIN c{ROUNDS} c USING (c)"""
    return "WITH " + ",\n".join(steps) + "\n" + last


OP12_SQL = _sql()
