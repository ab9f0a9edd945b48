"""License scan by diagonal voting, in DataFrame operations only.

Every run of ``GRAM`` consecutive words of a document meets, by hash and then word for word, the
places in license templates with the same words. A meeting at document word i and template word j
votes for the diagonal i - j; a text that follows a template puts its votes on one diagonal, and
an inserted or missing word moves them to a neighbouring one. Neighbouring diagonals are merged
and a span is verified by the share of the template's words that its votes cover.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourloom.llm.common import text_of

GRAM = 3
#: Diagonals of one template that are at most so far apart belong to one span.
NEIGHBOUR = 3
#: Share of a template's words that a span must cover to give its label.
COVERAGE = 0.7

#: Phrases whose exact places are counted, with their labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

#: Wording of public licenses, in words as the scan sees them.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction including "
            "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
            "of the software and to permit persons to whom the software is furnished to do so subject to the "
            "following conditions"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in "
                 "compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("gpl", "gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("mpl-2", "mozilla public license version 2"),
    ("cc-by-sa", "cc by sa"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by", "creative commons attribution"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("all-rights-reserved", "all rights reserved"),
)

_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words after lower-casing A-Z. Of all other letters only the Kelvin sign has an ASCII lower
    case; it is put aside for another letter, so no other letter can pass for an ASCII one."""
    lowered = F.lower(F.replace(text, F.lit("K"), F.lit("é")))
    return F.array_remove(F.split(lowered, _NOT_WORD), "")


def grams(df: DataFrame, keep: list[str], position: str) -> DataFrame:
    """``keep``, ``position``, h, g0..g2 for every run of three words of the array column w."""
    n = F.greatest(F.size("w") - (GRAM - 1), F.lit(0))
    zipped = F.arrays_zip(*[F.slice("w", F.lit(i + 1), n).alias(f"g{i}") for i in range(GRAM)])
    out = df.select(*keep, F.posexplode(zipped).alias(position, "g"))
    out = out.select(*keep, position, *[F.col("g")[f"g{i}"].alias(f"g{i}") for i in range(GRAM)])
    return out.withColumn("h", F.xxhash64("g0", "g1", "g2"))


def template_grams(spark: SparkSession) -> DataFrame:
    """(template, label, exact, length, j, h, g0..g2) of the fixed list: a few hundred rows."""
    listed = [(label, True, text) for label, text in PHRASES] + [(label, False, text) for label, text in TEMPLATES]
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(exact).alias("exact"),
                              F.lit(text).alias("t")) for i, (label, exact, text) in enumerate(listed)])
    table = spark.range(1).select(F.inline(rows)).select(
        "template", "label", "exact", words_of(F.col("t")).alias("w"))
    return grams(table.withColumn("length", F.size("w")), ["template", "label", "exact", "length"], "j")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_words, n_base (exact places of PHRASES), first_word
    and last_word (least and greatest start of those, else null), base_labels, labels (both sorted,
    comma-joined), score (greatest covered share of a template, 0 to 1).

    A null text is empty: no words, empty labels, score 0. A null id stays null; repeated rows give
    repeated results (rows alike in id and text share one scan); other columns are left out; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col).cast("string"), text).alias("k"),
                       text.alias("t"))
    counted = rows.select("id", "k", F.regexp_count("t", F.lit(_WORD)).cast("long").alias("n_words"))
    # the template list is fixed, a few hundred rows: a bounded broadcast
    placed = F.broadcast(template_grams(spark).alias("p"))
    met = (grams(rows.select("k", words_of(F.col("t")).alias("w")), ["k"], "i").alias("d")
           .join(placed, (F.col("d.h") == F.col("p.h")) & (F.col("d.g0") == F.col("p.g0"))
                 & (F.col("d.g1") == F.col("p.g1")) & (F.col("d.g2") == F.col("p.g2")))
           .select("k", "template", "label", "exact", "length", "j", (F.col("i") - F.col("j")).alias("diagonal")))
    # votes of a diagonal: a set of template places, so rows that repeat a text change nothing
    votes = met.groupBy("k", "template", "label", "exact", "length", "diagonal").agg(F.collect_set("j").alias("js"))
    by_template = Window.partitionBy("k", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(by_template) > NEIGHBOUR).cast("int")
    merged = (votes.withColumn("span", F.sum(F.coalesce(apart, F.lit(0))).over(
                  by_template.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy("k", "template", "label", "exact", "length", "span")
              .agg(F.array_distinct(F.flatten(F.collect_set("js"))).alias("js"),
                   F.sum((F.size("js") == F.col("length") - (GRAM - 1)).cast("long")).alias("places"),
                   F.min(F.when(F.size("js") == F.col("length") - (GRAM - 1), F.col("diagonal"))).alias("first"),
                   F.max(F.when(F.size("js") == F.col("length") - (GRAM - 1), F.col("diagonal"))).alias("last")))
    covered = F.size(F.array_distinct(F.flatten(F.transform("js", lambda j: F.array(*[j + i for i in range(GRAM)])))))
    spans = merged.withColumn("share", covered / F.col("length"))
    base = F.col("exact") & (F.col("places") > 0)
    label = F.when(F.when(F.col("exact"), F.col("places") > 0).otherwise(F.col("share") >= coverage), F.col("label"))
    found = spans.groupBy("k").agg(
        F.sum(F.when(base, F.col("places"))).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"), F.max(F.when(base, F.col("last"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(label)), ",").alias("labels"), F.max("share").alias("score"))
    return counted.join(found, "k", "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.least(F.coalesce("score", F.lit(0.0)), F.lit(1.0)).alias("score"))
