"""Full-text search: a stored positional index and cover-density ranking.

The index has a row for each term of each document with the places where it stands.  It is
written partitioned by a bucket of the term and sorted by term within files, so that a query
reads the buckets of its own terms alone and skips most row groups of those.

A query is a list of groups of words: a document must hold a word of every group.  A *cover*
is a shortest stretch of a document that does.  The score is a tenth of the sum, over all
covers, of ``1 / (1 + words of no query term within the cover)``; for a query of one group
every place is a cover, so that the score tells how often its words occur.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import stems
from .retrieval import DEPTH, top_k

#: Fixed values of the ranking: weight of a place, least letters of a query word.
WEIGHT = 0.1
LEAST_LETTERS = 3
BUCKETS = 64
#: Files of a bucket at most: a term of very many documents is spread over so many tasks.
SPREAD = 8

Query = list[list[str]]
_POSTINGS = "id long, term string, places array<int>"
_SPEC = pa.schema([("id", pa.int64()), ("term", pa.string()), ("places", pa.list_(pa.int32()))])


def any_of(text: str) -> Query:
    """One group of all words of a text that have three letters or more."""
    return [[w for w in dict.fromkeys(re.split(r"[^\w]+", text.lower())) if len(w) >= LEAST_LETTERS]]


def all_of(*texts: str) -> Query:
    """A group for each text."""
    return [any_of(t)[0] for t in texts]


def _posting_rows(stem: Callable[[str], str | None]):
    word = re.compile(r"\w+")

    def run(batches):
        for batch in batches:
            for id_, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = pa.array(word.findall((text or "").lower()), type=pa.string()).dictionary_encode()
                if not len(words):
                    continue
                # Each different word is stemmed once; a common word stands nowhere but keeps its place.
                terms = pa.array([stem(w) for w in words.dictionary.to_pylist()], type=pa.string())
                table = pa.table({"term": terms.take(words.indices), "place": pa.array(range(1, len(words) + 1), type=pa.int32())})
                found = table.filter(pc.is_valid(table["term"])).group_by("term", use_threads=False).aggregate([("place", "list")])
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(id_, pa.int64()), found.num_rows), found["term"].combine_chunks(), found["place_list"].combine_chunks()], schema=_SPEC)

    return run


def postings(docs: DataFrame, text: str = "text", key: str = "id", stem: Callable[[str], str | None] = stems.stem) -> DataFrame:
    """(id, term, places) of every term of every document; places count words from 1."""
    rows = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_posting_rows(stem), _POSTINGS)


def bucket(term: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


class Index:
    """A stored index under ``path``; a document is added once."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, stem: Callable[[str], str | None] = stems.stem):
        self.spark, self.path, self.buckets, self.stem = spark, path, buckets, stem

    def add(self, docs: DataFrame, text: str = "text", key: str = "id") -> Index:
        """Store the postings of documents that are not in the index yet."""
        rows = postings(docs, text, key, self.stem).withColumn("bucket", bucket(F.col("term"), self.buckets))
        dealt = rows.repartition("bucket", F.pmod(F.xxhash64("id"), F.lit(SPREAD)))
        dealt.sortWithinPartitions("bucket", "term", "id").write.mode("append").partitionBy("bucket").parquet(self.path)
        return self

    def read(self, terms: Iterable[str]) -> DataFrame:
        """(id, term, places) of these terms; other buckets are not listed, let alone read."""
        wanted = sorted(set(terms))
        table = self.spark.read.schema(f"{_POSTINGS}, bucket int").parquet(self.path)
        if not wanted:
            return table.select("id", "term", "places").limit(0)
        # The buckets of a handful of words are worked out by Spark, as they were when they were written.
        names = self.spark.createDataFrame([(t,) for t in wanted], "term string").select(bucket(F.col("term"), self.buckets).alias("b"))
        buckets = sorted({r["b"] for r in names.collect()})
        return table.where(F.col("bucket").isin(buckets) & F.col("term").isin(wanted)).select("id", "term", "places")

    def search(self, queries: dict[int, Query], k: int = DEPTH, universe: DataFrame | None = None) -> DataFrame:
        """(id_object, id, score, rank): the k best documents of each query, ties by the smaller id.

        A query without a group, or with one whose words are all too common, finds nothing.
        """
        stemmed = {o: [[s for s in dict.fromkeys(map(self.stem, group)) if s is not None] for group in q] for o, q in queries.items()}
        stemmed = {o: q for o, q in stemmed.items() if q and all(q)}
        rows = [(o, g, t, len(q)) for o, q in stemmed.items() for g, group in enumerate(q) for t in group]
        found = self.read(t for _, _, t, _ in rows)
        if universe is not None:
            found = found.join(universe.select("id"), "id", "left_semi")
        wanted = self.spark.createDataFrame(rows, "id_object int, part int, term string, parts int")
        hits = found.join(F.broadcast(wanted), "term")  # the words of the queries
        scores = cover_scores(hits, max(map(len, stemmed.values()), default=0))
        return top_k(scores.withColumn("score", F.round("score", 6)), k, "id_object")


def cover_scores(hits: DataFrame, most: int) -> DataFrame:
    """(id_object, id, score) of hits (id_object, id, part, parts, places) by cover density; no query has over ``most`` parts."""
    at = hits.select("id_object", "id", "part", "parts", F.explode("places").alias("place"))
    # A word of two groups stands in one place.
    whole = at.groupBy("id_object", "id", "parts", "place").agg(F.collect_set("part").alias("of"))
    scores = whole.where("parts = 1").groupBy("id_object", "id").agg((F.count("*") * F.lit(WEIGHT)).alias("score"))
    if most < 2:
        return scores
    several = whole.where("parts > 1")
    # A document without a word of every group goes before any place is sorted.
    enough = several.groupBy("id_object", "id", "parts").agg(F.size(F.array_distinct(F.flatten(F.collect_set("of")))).alias("n")).where("n = parts").select("id_object", "id")
    order = W.partitionBy("id_object", "id").orderBy("place")
    numbered = several.join(enough, ["id_object", "id"]).withColumn("nth", F.row_number().over(order))
    # The last place of each part so far: the farthest back of them begins the cover that ends here.
    so_far, here = order.rowsBetween(W.unboundedPreceding, W.currentRow), F.struct("place", "nth")
    last = {f"last_{p}": F.last(F.when(F.array_contains("of", p), here), ignorenulls=True).over(so_far) for p in range(most)}
    ends = numbered.withColumns(last)
    known = F.array_compact(F.array(*last))
    ends = ends.withColumn("start", F.when(F.size(known) == F.col("parts"), F.array_min(known))).withColumn("before", F.lag("start").over(order))
    # The first end of each start is a cover; later ones hold it.
    covers = ends.where(F.col("start").isNotNull() & (F.col("before").isNull() | (F.col("before.place") < F.col("start.place"))))
    noise = (F.col("place") - F.col("start.place")) - (F.col("nth") - F.col("start.nth"))
    return scores.unionByName(covers.groupBy("id_object", "id").agg(F.sum(F.lit(WEIGHT) / (F.lit(1) + noise)).alias("score")))
