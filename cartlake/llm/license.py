"""License phrases and notices in texts, by voting of k-gram hashes on diagonals.

Every pair of consecutive words (k = 2) of a text is hashed and joined with the pairs of
the templates, a table of fixed size that is broadcast. A match at word p of the text and
word t of a template votes for the diagonal p - t. A base phrase stands where all its
pairs vote for one diagonal. A notice may have words put in or left out, so its votes on
diagonals up to ``GAP`` apart are merged to a band. A band is verified: the most
pairs that stand in the template's order, each counted once, within one span of the text
(``span``). The notice is reported if that is ``SHARE`` of its pairs. A word that alone tells two notices
apart (nc, sa) is in two pairs, and no template is so long that it may miss both of a word's pairs and
differ from another by that word. The matched words themselves are compared, so no hash decides alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP, SHARE = 2, 0.8
#: (label, base, words)
TEMPLATES = (
    ("cc-by", True, "cc by"),
    ("gpl", True, "general public license"),
    ("reserved", True, "all rights reserved"),
    ("apache-2.0", False, "licensed under the apache license version 2 0"),
    ("mit", False, "released under the mit license"),
    ("mit", False, "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("bsd", False, "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc", False, "licensed under cc by nc 4 0"),
    ("cc-by-sa", False, "licensed under cc by sa 4 0"),
    ("gpl-notice", False, "this work is licensed under the gnu general public license version 3"),
    ("mpl-2.0", False, "this source code form is subject to the terms of the mozilla public license v 2 0"),
)


def span(pairs: int) -> int:
    """Text positions that a notice may take: its pairs, and ``GAP`` words for each that it may miss."""
    return pairs + GAP * (pairs - math.ceil(SHARE * pairs))


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, SEPARATORS), lambda w: w != "")


def template_grams(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """(gram, first, second, template, at): the word pairs of each template; template -1, with
    no words, is met by every text once."""
    rows = [(None, None, -1, 0)]
    for number, (_, _, text) in enumerate(templates):
        own = text.split()
        rows += [(a, b, number, at) for at, (a, b) in enumerate(zip(own, own[1:]))]
    table = spark.createDataFrame(rows, "first string, second string, template int, at int")
    return table.select(F.xxhash64("first", "second").alias("gram"), "first", "second", "template", "at")


def votes(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """(rid, doc_id, n_words, template, diagonal, votes, places), and for every row one of template -1."""
    split = docs.select("doc_id", words(F.col("text")).alias("words")).withColumn("rid", F.monotonically_increasing_id())
    pairs = F.zip_with(
        "words", F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))),
        lambda a, b: F.struct(a.alias("first"), b.alias("second")),
    )
    nothing = F.lit(None).cast("string")
    pairs = split.select(
        "rid", "doc_id", F.size("words").cast("long").alias("n_words"),
        F.concat(pairs, F.array(F.struct(nothing.alias("first"), nothing.alias("second")))).alias("pairs"),
    )
    rolled = pairs.select("rid", "doc_id", "n_words", F.posexplode("pairs").alias("place", "pair")).select(
        "rid", "doc_id", "n_words", "place",
        F.col("pair.first").alias("a"), F.col("pair.second").alias("b"), F.xxhash64("pair.first", "pair.second").alias("gram"),
    )
    grams = template_grams(docs.sparkSession, templates)
    met = rolled.join(F.broadcast(grams), "gram").filter(F.col("a").eqNullSafe(F.col("first")) & F.col("b").eqNullSafe(F.col("second")))
    diagonal = F.when(F.col("template") >= 0, F.col("place") - F.col("at")).otherwise(F.lit(0))
    return met.groupBy("rid", "doc_id", "n_words", "template", diagonal.alias("diagonal")).agg(
        F.count("*").alias("votes"), F.collect_list("place").alias("places")
    )


def in_order(met: Column, pairs: Column) -> Column:
    """The length of the longest row of votes (place, back: the template's position, negated) in
    which place and position both grow."""
    # Votes of one place come by falling position, so a row takes one of them at most.
    def step(best: Column, vote: Column) -> Column:
        before = F.coalesce(F.array_max(F.slice(best, 1, -vote["back"])), F.lit(0))
        return F.transform(best, lambda x, i: F.when(i == -vote["back"], F.greatest(x, before + 1)).otherwise(x))

    return F.aggregate(F.array_sort(met), F.array_repeat(F.lit(0), pairs.cast("int")), step, F.array_max)


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts all places of base phrases, first_word and last_word are their least and
    greatest start (words from 0; null without one). ``score`` is the greatest share of a
    template's pairs that is met, in the template's order and within a span for notices, 1 for a
    whole phrase. Null and empty texts have no words.
    Repeated rows, and rows without doc_id, each give a row; an empty table gives an empty
    result; other columns are not read.
    """
    spark = docs.sparkSession
    sizes = spark.createDataFrame(
        [(-1, "", False, 1, 1)]
        + [(i, label, base, n := len(text.split()) - 1, span(n)) for i, (label, base, text) in enumerate(templates)],
        "template int, label string, base boolean, pairs long, span int",
    )
    widest = max([span(len(text.split()) - 1) for _, _, text in templates], default=1)
    cast = votes(docs, templates).join(F.broadcast(sizes), "template")
    line = Window.partitionBy("rid", "template").orderBy("diagonal")
    band = Window.partitionBy("rid", "template", "band")
    banded = (
        cast.withColumn("new", F.coalesce((F.col("diagonal") - F.lag("diagonal").over(line) > GAP).cast("int"), F.lit(0)))
        .withColumn("band", F.when(F.col("base"), F.col("diagonal")).otherwise(F.sum("new").over(line)))
        .withColumn("verify", ~F.col("base") & (F.col("template") >= 0) & (F.sum("votes").over(band) > 1))
    )
    # Of what is verified every vote is a row, and meets those that follow within a span.
    single = banded.withColumn("place", F.explode_outer(F.when(F.col("verify"), F.col("places"))))
    follow = F.collect_list(F.when(F.col("verify"), F.struct("place", (F.col("diagonal") - F.col("place")).alias("back"))))
    followed = single.withColumn("met", follow.over(band.orderBy("place").rangeBetween(0, widest - 1)))
    near = F.filter("met", lambda v: v["place"] < F.col("place") + F.col("span"))
    merged = (
        followed.withColumn("row", F.when(F.col("verify"), in_order(near, F.col("pairs"))))
        .groupBy("rid", "doc_id", "n_words", "template", "label", "base", "pairs", "band")
        .agg(F.coalesce(F.max("row").cast("long"), F.sum("votes")).alias("votes"))
        .withColumn("share", F.when(F.col("template") < 0, 0.0).otherwise(F.least(F.lit(1.0), F.col("votes") / F.col("pairs"))))
    )
    whole = F.col("base") & (F.col("votes") == F.col("pairs"))
    found = whole | (~F.col("base") & (F.col("template") >= 0) & (F.col("share") >= SHARE))

    def names(which: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")

    return merged.groupBy("rid", "doc_id", "n_words").agg(
        F.sum(whole.cast("long")).alias("n_base"),
        F.min(F.when(whole, F.col("band"))).cast("long").alias("first_word"),
        F.max(F.when(whole, F.col("band"))).cast("long").alias("last_word"),
        names(whole).alias("base_labels"), names(found).alias("labels"), F.max("share").alias("score"),
    ).drop("rid")


def _values(templates=TEMPLATES) -> str:
    return ", ".join(
        f"({i}, '{label}', {str(base).lower()}, '{text}', {span(len(text.split()) - 1)})" for i, (label, base, text) in enumerate(templates)
    )


#: The same rows from DuckDB. A band is verified here too: of its votes from one
#: place on (``near``, each by place, then falling position) the longest row is built vote by vote,
#: ``best`` holding the longest that ends at each position.
SQL = rf"""
WITH t(template, label, base, phrase, span) AS (VALUES {_values()}),
tw AS (SELECT template, label, base, span, string_split(phrase, ' ') AS w FROM t),
tg AS (SELECT template, label, base, span, len(w) - 1 AS pairs, w[i] AS a, w[i + 1] AS b, i AS pos
  FROM (SELECT *, unnest(range(1, len(w))) AS i FROM tw)),
d AS (SELECT row_number() OVER () AS rid, doc_id,
  list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
g AS (SELECT rid, w[i] AS a, w[i + 1] AS b, i FROM (SELECT rid, w, unnest(range(1, len(w))) AS i FROM d)),
p AS MATERIALIZED (SELECT rid, template, label, base, pairs, span, i AS place, pos, i - pos AS diagonal FROM g JOIN tg USING (a, b)),
v AS (SELECT rid, template, label, base, pairs, diagonal, count(*) AS votes FROM p GROUP BY ALL),
n AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER line > {GAP} THEN 1 ELSE 0 END AS new FROM v
  WINDOW line AS (PARTITION BY rid, template ORDER BY diagonal)),
b AS (SELECT *, CASE WHEN base THEN diagonal ELSE sum(new) OVER (PARTITION BY rid, template ORDER BY diagonal) END AS band FROM n),
c AS (SELECT rid, template, label, base, pairs, band, sum(votes) AS votes, NOT base AND sum(votes) > 1 AS verify
  FROM b GROUP BY rid, template, label, base, pairs, band),
met AS (SELECT p.*, band FROM p JOIN b USING (rid, template, diagonal) JOIN c USING (rid, template, band) WHERE verify),
f AS (SELECT rid, template, band, pairs, list_sort(list({{'place': y.place, 'back': -y.pos}})) AS near
  FROM (SELECT DISTINCT rid, template, band, pairs, span, place FROM met) x JOIN met y USING (rid, template, band, pairs)
  WHERE y.place BETWEEN x.place AND x.place + x.span - 1 GROUP BY rid, template, band, pairs, x.place),
r AS (SELECT rid, template, band, list_max(list_reduce(
    list_prepend(list_transform(range(pairs), lambda z: 0::BIGINT), list_transform(near, lambda y: [(-y.back)::BIGINT])),
    lambda best, x: list_transform(best, lambda y, i: CASE WHEN i = x[1] THEN greatest(y, 1 + coalesce(list_max(best[1:x[1] - 1]), 0)) ELSE y END))) AS row FROM f),
o AS (SELECT rid, template, band, max(row) AS row FROM r GROUP BY rid, template, band),
m AS (SELECT rid, template, label, base, band, least(1.0::DOUBLE, coalesce(row, votes)::DOUBLE / pairs) AS share, base AND votes = pairs AS whole
  FROM c LEFT JOIN o USING (rid, template, band))
SELECT d.doc_id, any_value(len(d.w))::BIGINT AS n_words, count(*) FILTER (whole)::BIGINT AS n_base,
  (min(band) FILTER (whole))::BIGINT AS first_word, (max(band) FILTER (whole))::BIGINT AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (whole), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (whole OR (NOT base AND share >= {SHARE})), '') AS labels,
  coalesce(max(share), 0.0)::DOUBLE AS score
FROM d LEFT JOIN m USING (rid) GROUP BY d.rid, d.doc_id
"""
