"""License scans by diagonal voting, in DataFrame operations alone.

Every pair of neighbouring words of a document is hashed and joined to the places of
that pair in license templates.  A pair at word p that meets place t of a template
votes for the diagonal p - t; pairs of one passage vote for one diagonal, inserted or
dropped words move it a little.  Votes are summed by diagonal, neighbouring diagonals
are merged into spans, and spans are verified: the words of a base phrase must all
stand in a row, and a span of a longer notice must hold enough of its pairs in few
enough words.  Diagonals that hold the same place of a template are different copies and
are not merged, and each diagonal is verified by itself too.

The templates are fixed text below, so the table of their pairs is bounded and broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common

#: Phrases that decide base labels when their words stand in a row.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Sentences of well-known license notices.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit",
    "licensed under the apache license version 2 0 you may not use this file except in compliance with the license": "apache",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "you should have received a copy of the gnu general public license along with this program": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "proprietary",
}

#: Diagonals no further apart than this are one span: words put in or left out.
DRIFT = 3
#: A notice is verified with this share of its pairs, within this many times its words.
COVER = 0.7
LONGER = 1.5
#: ASCII characters that part words; all beyond ASCII are word characters.
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _pair_hash(a, b) -> Column:
    return F.xxhash64(a, b)


def templates(spark: SparkSession) -> DataFrame:
    """(pair, word_a, word_b, template, t, label, exact, n_pairs): places of all pairs of all templates."""
    rows = []
    for k, (text, label, exact) in enumerate([(p, x, True) for p, x in PHRASES.items()] + [(p, x, False) for p, x in NOTICES.items()]):
        w = text.split()
        if len(w) > 64:
            raise ValueError("a template's pairs are bits of one long")
        rows += [(w[i], w[i + 1], k, i, label, exact, len(w) - 1) for i in range(len(w) - 1)]
    table = spark.createDataFrame(rows, "word_a string, word_b string, template int, t int, label string, exact boolean, n_pairs int")
    return table.withColumn("pair", _pair_hash("word_a", "word_b"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    score is the best covered share of a template, 1 for a base place.  A null text has
    no words.  Rows of one doc_id are told apart by their text; rows equal in both get
    equal results, one each.  Other columns are not read.  An empty table gives no rows;
    a long text is one row of words until it is exploded.
    """
    spark: SparkSession = docs.sparkSession
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), _UPPER, _LOWER)
    # Split drops nothing but the gaps; words never are empty, so empty parts stand for text ends alone.
    words = F.filter(F.split(text, _GAPS), lambda w: w != "")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"), F.coalesce(F.length("text"), F.lit(-1)).alias("size"), words.alias("words"))
    # One more, empty, word: every document has a row at word 0, which carries it through.
    pairs = F.arrays_zip(F.concat("words", F.array(F.lit(""))).alias("a"), F.slice(F.concat("words", F.array(F.lit(""))), 2, F.size("words") + 1).alias("b"))
    each = base.select("doc_id", "digest", "size", F.size("words").cast("long").alias("n_words"), F.posexplode(pairs).alias("p", "w"))
    each = each.select("doc_id", "digest", "size", "n_words", "p", F.col("w.a").alias("a"), F.col("w.b").alias("b"))
    found = each.withColumn("pair", _pair_hash("a", "b")).join(F.broadcast(templates(spark)), "pair", "left")
    found = found.where("p = 0 or template is not null")
    met = F.col("template").isNotNull() & (F.col("a") == F.col("word_a")) & (F.col("b") == F.col("word_b"))
    key = ["doc_id", "digest", "size", "n_words"]
    votes = found.select(*key, F.when(met, F.col("template")).alias("template"), F.when(met, F.col("p") - F.col("t")).alias("diagonal"), F.when(met, F.col("label")).alias("label"), F.when(met, F.col("exact")).alias("exact"), F.when(met, F.col("n_pairs")).alias("n_pairs"), F.when(met, F.col("p")).alias("p"), F.when(met, F.col("t")).alias("t"), (F.col("p") == 0).alias("head"))
    # Template places are under 63, so a diagonal's votes are bits of one long.
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("t"))
    head = F.count(F.when(F.col("head"), 1))
    # A pair at word 0 that meets several templates is several rows; copies of a row are told by any one of them.
    lines = votes.groupBy(*key, "template", "diagonal", "label", "exact", "n_pairs").agg(F.bit_or(bit).alias("bits"), F.min("p").alias("first"), F.max("p").alias("last"), head.alias("heads"))
    near = W.partitionBy(*key, "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(near)
    again = F.col("bits").bitwiseAND(F.lag("bits").over(near)) != 0
    fresh = F.col("exact") | gap.isNull() | again | (gap > DRIFT) | (F.col("first") - F.lag("last").over(near) > DRIFT + F.col("n_pairs"))
    cover = F.bit_count("bits") / F.col("n_pairs")
    fits = (cover >= COVER) & (F.col("last") - F.col("first") + 1 <= LONGER * F.col("n_pairs"))
    holds = F.when(F.col("exact"), F.bit_count("bits") == F.col("n_pairs")).otherwise(fits)
    spans = lines.withColumn("span", F.sum(F.when(fresh, 1).otherwise(0)).over(near)).withColumn("alone", F.when(holds, cover))
    spans = spans.groupBy(*key, "template", "span", "label", "exact", "n_pairs").agg(F.bit_or("bits").alias("bits"), F.min("first").alias("first"), F.max("last").alias("last"), F.max("heads").alias("heads"), F.max("alone").alias("alone"))
    placed = holds & F.col("exact")
    share = F.greatest(F.when(holds, cover), "alone")
    out = spans.groupBy(*key).agg(
        F.count(F.when(placed, 1)).alias("n_base"),
        F.min(F.when(placed, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(placed, F.col("first"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(placed, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(share.isNotNull(), F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(share), F.lit(0.0)).alias("score"),
        F.max("heads").alias("copies"),
    )
    each_row = F.explode(F.sequence(F.lit(1).cast("long"), F.greatest(F.col("copies"), F.lit(1))))
    return out.withColumn("_", each_row).drop("_", "copies", "digest", "size")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: words, base places, labels and score."""
    return scan(common.read_table(spark, sf_dir, "documents"))
