"""Source divergence audit: how far the term frequencies of a language's sources lie apart.

Two sources of a language differ by the sum of ``|p - q|`` over all kept terms, where a
term that a source lacks still has the source's least ``p`` (its *base*).  The sum is split
by how many sources have a term:

* a **heavy** term, one that many sources of its language have, goes into dense numpy tiles:
  a slab of terms by a block of sources against another block, all cells filled;
* a **light** term has a short posting list.  Were it in no source, it would add the distance
  of the two bases; each posting and each pair within a posting list corrects that.

Both parts are sums of integers, so adding them gives the exact distance.  Tiles are bounded
in both directions, posting lists by ``LIGHT``; terms, groups and tiles are shuffled by Spark,
nothing is broadcast by hand or collected.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common, textkernel

LEAST_DOCS = 30
TOP_TERMS = 50
#: Scale of p and what is added to every count.
SCALE = 1_000_000_000
SMOOTH = 5
#: Sources of a posting list at most, and the share of a language's sources (one in so many): terms beyond either are heavy.
LIGHT = 16
LIGHT_SHARE = 4
#: Terms of a slab and sources of a block, on average; both are dealt by hash.
SLAB = 4096
BLOCK = 128
#: Bytes of words whose terms are told apart at once.
_PIECE = 8 << 20

#: Letters and all beyond ASCII, A-Z in lower case.
LETTERS = textkernel.byte_class([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)], lower=True)
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _terms(column: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Every term of a string column in order, and the row it is in."""
    is_word, value = LETTERS
    data, offsets = textkernel.buffers(column)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    inside = np.concatenate(([False], is_word[data], [False]))
    # Rows touch in the buffer, so a word may begin, and the one before end, where a row does.
    border = np.zeros(len(data) + 1, dtype=bool)
    border[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | border))
    starts = starts[starts < len(data)]
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | border))
    kept = value[data[inside[1:-1]]]
    rows = np.searchsorted(offsets, starts, side="right") - 1
    limits = np.concatenate(([0], np.cumsum(ends - starts)))
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(limits.astype(np.int64)), pa.py_buffer(kept))
    return words.dictionary_encode(), rows


def _count(batches):
    """Counts of (lang, source, term) within each piece of a batch: occurrences, and documents that have it."""
    for batch in batches:
        _, offsets = textkernel.buffers(batch.column("text"))
        row = 0
        while row < batch.num_rows:
            to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _PIECE, side="right")) - 1)
            piece = batch.slice(row, to - row)
            row = to
            words, rows = _terms(piece.column("text"))
            if not len(words):
                continue
            group = pa.StructArray.from_arrays([piece.column("lang"), piece.column("source")], ["lang", "source"])
            langs, sources = (piece.column(c).dictionary_encode() for c in ("lang", "source"))
            number = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
            numbers, first, of_row = np.unique(number, return_index=True, return_inverse=True)
            size, codes = len(words.dictionary), words.indices.to_numpy().astype(np.int64)
            # Once for each document, then over the documents of each group.
            pair, n = np.unique(rows * size + codes, return_counts=True)
            cell, back = np.unique(of_row[pair // size] * size + pair % size, return_inverse=True)
            total = np.bincount(back, weights=n, minlength=len(cell)).astype(np.int64)
            docs = np.bincount(back, minlength=len(cell))
            at = group.take(pa.array(first[cell // size]))
            yield common.batch_of(_COUNTS, (at.field("lang"), at.field("source"), words.dictionary.take(pa.array(cell % size)).cast(pa.string()), total, docs))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group and the documents that have it."""
    common.small_batches(docs.sparkSession)
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    found = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _p(n: str, total: str, terms: str) -> F.Column:
    """1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * terms)), in whole numbers of any size that counts have."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10, 0)) * cast({n} + {SMOOTH} as decimal(19, 0))) div cast(greatest({total} + {SMOOTH} * {terms}, 1) as decimal(19, 0))")


_TILE = "lang string, a string, b string, part long"


def _tile(key: tuple, table: pd.DataFrame) -> pd.DataFrame:
    """Partial sums of one slab for the pairs of two blocks; rows: a source's base (term null) and its cells.

    In the slab of light terms, which has number -1, a row is a value that ``m`` of the source's terms have.
    """
    lang, slab, i, j = key
    of = {side: table[table["block"] == side] for side in {i, j}}
    bases = {side: t[t["term"].isna()].drop_duplicates("source").set_index("source")["p"] for side, t in of.items()}
    left, right = bases[i], bases[j]
    base_a, base_b = left.to_numpy(np.int64), right.to_numpy(np.int64)
    apart = np.abs(base_a[:, None] - base_b[None, :])
    if slab < 0:
        found = apart * int(table["light"].iloc[0])
        found = found + _shifts(of[i], left.index, base_a, base_b) + _shifts(of[j], right.index, base_b, base_a).T
    else:
        cells = table[table["term"].notna()]
        terms = pd.Index(cells["term"].unique())
        a, b = (_dense(of[side], bases[side], terms) for side in (i, j))
        found = np.stack([np.abs(b - row).sum(axis=1) for row in a]) if len(a) else apart[:0]
    x, y = np.meshgrid(left.index.to_numpy(object), right.index.to_numpy(object), indexing="ij")
    once = x < y if i == j else np.ones(x.shape, dtype=bool)
    # The smaller name stands first, so that a pair has one key in every slab.
    x, y = x[once], y[once]
    swap = x > y
    return pd.DataFrame({"lang": lang, "a": np.where(swap, y, x), "b": np.where(swap, x, y), "part": found[once].astype(np.int64)})


def _dense(rows: pd.DataFrame, bases: pd.Series, terms: pd.Index) -> np.ndarray:
    """Sources by terms: p of every cell, the source's base where it lacks the term."""
    cells = rows[rows["term"].notna()]
    out = np.repeat(bases.to_numpy(np.int64)[:, None], len(terms), axis=1)
    out[bases.index.get_indexer(cells["source"]), terms.get_indexer(cells["term"])] = cells["p"].to_numpy(np.int64)
    return out


def _shifts(rows: pd.DataFrame, names: pd.Index, own: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Sums of |p - other base| - |own base - other base| over each source's light terms, for every other base."""
    out = np.zeros((len(own), len(others)), dtype=np.int64)
    cells = rows[rows["term"].notna()]
    at = names.get_indexer(cells["source"])
    p, m = cells["p"].to_numpy(np.int64), cells["m"].to_numpy(np.int64)
    for k in range(len(own)):
        here = at == k
        for start in range(0, int(here.sum()), SLAB):
            q, n = p[here][start : start + SLAB], m[here][start : start + SLAB]
            out[k] += ((np.abs(q[:, None] - others[None, :]) - np.abs(own[k] - others)[None, :]) * n[:, None]).sum(axis=0)
    return out


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, light: int = LIGHT, slab: int = SLAB, block: int = BLOCK) -> DataFrame:
    """lang, source, part, item, value, rank of every (lang, source) group of ``docs``.

    Part ``pair`` has every other source of the language and the distance to it, part ``term``
    the ``top`` terms that the group has more often than its language.  A null lang, source or
    text counts as empty; a group without terms is a group, a language without kept terms gives
    distances of zero.  Ties go to the smaller item by UTF-8 bytes.  Repeated rows count each;
    long texts are counted piece by piece; an empty table gives no rows; other columns are not read.
    """
    counts = common.materialise(term_counts(docs), "terms")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("of_lang"), F.count("*").alias("sources")).where(F.col("docs") >= least_docs)
    cells = common.materialise(counts.drop("docs").join(kept.drop("docs"), ["lang", "term"]), "kept")

    every = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    per_lang = every.groupBy("lang").agg(F.count("*").alias("groups"))
    one_each = cells.groupBy("lang", "term").agg(F.first("of_lang").alias("of_lang"), F.first("sources").alias("sources"))
    is_heavy = F.col("sources") > F.least(F.lit(light), F.greatest(F.lit(1), F.floor(F.col("groups") / LIGHT_SHARE)))
    of_terms = one_each.join(per_lang, "lang").groupBy("lang").agg(F.sum("of_lang").alias("lang_total"), F.count("*").alias("v"), F.count(F.when(~is_heavy, 1)).alias("light"))
    langs = per_lang.join(of_terms, "lang", "left").na.fill(0)
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = every.join(totals, ["lang", "source"], "left").na.fill(0).join(langs, "lang")
    blocks = F.ceil(F.col("groups") / block).cast("long")
    groups = groups.withColumn("base", _p("0", "total", "v")).withColumn("blocks", blocks).withColumn("block", F.expr("pmod(xxhash64(source), blocks)"))
    groups = groups.withColumn("slabs", F.ceil((F.col("v") - F.col("light")) / slab).cast("long"))
    groups = common.materialise(groups, "groups")

    known = cells.join(groups, ["lang", "source"]).withColumn("p", _p("n", "total", "v")).withColumn("heavy", is_heavy)
    known = common.materialise(known.select("lang", "source", "term", "n", "p", "base", "heavy", "light", "block", "blocks", "slabs", _p("of_lang", "lang_total", "v").alias("q")), "cells")

    pairs = common.materialise(_distances(groups, known), "distances")
    both = pairs.select("lang", F.explode(F.array(*(F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in (("a", "b"), ("b", "a"))))).alias("x"), "value")
    order = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = both.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value").withColumn("rank", F.row_number().over(order))
    more = known.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = more.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.unionByName(terms)


def _distances(groups: DataFrame, known: DataFrame) -> DataFrame:
    """(lang, a, b, value) of every two sources a < b of a language."""
    on = ["lang", "source", "block", "blocks", "light", "term", "p", "m"]
    nothing, one = F.lit(None).cast("string").alias("term"), F.lit(1).cast("long").alias("m")
    # A source's base belongs to each of its tiles; a dense cell to one slab, a light value to slab -1.
    base = groups.where("groups > 1").select("lang", "source", "block", "blocks", "light", nothing, F.col("base").alias("p"), one, F.explode(F.expr("sequence(-1L, slabs - 1)")).alias("slab"))
    dense = known.where("heavy").select(*on[:6], "p", one, F.expr("pmod(xxhash64(term), slabs)").alias("slab"))
    folded = known.where("not heavy").groupBy("lang", "source", "block", "blocks", "light", "p").agg(F.count("*").alias("m"))
    light = folded.select(*on[:5], F.lit("").alias("term"), "p", "m", F.lit(-1).cast("long").alias("slab"))
    rows = base.unionByName(dense).unionByName(light)
    # A row meets every block: its tile is that of the two block numbers.
    met = rows.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    met = met.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    tiles = met.select("lang", "slab", "i", "j", "source", "block", "term", "p", "m", "light").groupBy("lang", "slab", "i", "j").applyInPandas(_tile, _TILE)

    posting = F.sort_array(F.collect_list(F.struct("source", "p", "base")))
    lists = known.where("not heavy").groupBy("lang", "term").agg(posting.alias("list")).where("size(list) > 1")
    first = lists.select("lang", "list", F.posexplode("list").alias("k", "x"))
    second = first.select("lang", "x", F.explode(F.expr("slice(list, k + 2, size(list))")).alias("y"))
    gap = F.expr("abs(x.p - y.p) - abs(x.p - y.base) - abs(x.base - y.p) + abs(x.base - y.base)")
    corrections = second.select("lang", F.col("x.source").alias("a"), F.col("y.source").alias("b"), gap.alias("part"))
    return tiles.unionByName(corrections).groupBy("lang", "a", "b").agg(F.sum("part").alias("value"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: lang, source, part, item, value, rank."""
    return audit(common.read_table(spark, sf_dir, "documents"))


OP11_SQL = f"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
n AS (SELECT row_number() OVER () AS r, * FROM d),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM n),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT r) >= {LEAST_DOCS}),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
langs AS (SELECT lang, sum(n)::BIGINT AS total, count(*) AS v FROM kept GROUP BY 1),
cells AS (SELECT g.lang, g.source, k.term, k.n AS of_lang, coalesce(c.n, 0) AS n FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
sums AS (SELECT lang, source, sum(n)::BIGINT AS total FROM cells GROUP BY ALL),
p AS MATERIALIZED (SELECT c.lang, c.source, c.term, c.n, 1 + ({SCALE}::BIGINT * (c.n + {SMOOTH})) // (s.total + {SMOOTH} * l.v) AS p, 1 + ({SCALE}::BIGINT * (c.of_lang + {SMOOTH})) // (l.total + {SMOOTH} * l.v) AS q
  FROM cells c JOIN sums s USING (lang, source) JOIN langs l USING (lang)),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(far.value, 0)::BIGINT AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}"""
