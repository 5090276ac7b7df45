"""License notices in texts: stated phrases, and an exact set-similarity join with templates.

Everything is DataFrame operations. A block is a line, as the set of its words. A template is
found in a block if the block holds at least CONTAINMENT of the template's words. Words are put
into one global order, rarest in the corpus first. A block that meets the threshold must hold a
word of the template's prefix (its first |T| - needed + 1 words in that order); it needs enough
words (length filter); and behind the first common word enough must be left on both sides
(positional filter). What passes is counted out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dayshape.llm.common import PLAIN, stored

# The phrases whose places are counted, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Sentences of common notices, by the label that a block with one of them gets.
TEMPLATES = {
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-terms": "you may not use this file except in compliance with the license",
    "bsd-terms": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by-notice": "licensed under cc by nc 4 0",
    "gpl-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-terms": "you can redistribute it and or modify it under the terms of the gnu general public license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mit-notice": "released under the mit license",
    "rights-reserved": "all rights reserved no part may be reproduced without written permission",
}
CONTAINMENT = 0.8


def plain_text(text: Column) -> Column:
    """A-Z lower-cased and other ASCII characters but letters, digits and line ends made spaces."""
    changed = [b for b in range(128) if PLAIN[b] != b and b != 10]
    return F.translate(text, "".join(map(chr, changed)), "".join(chr(PLAIN[b]) for b in changed))


def with_words(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, row, n_words, places, blocks): one row per row of docs.

    row is a hash of the text, so that rows which repeat a doc_id stay apart. places are structs
    (label, at) of the stated phrases; blocks are the words of each line that are in vocabulary.
    """
    lines = "transform(split(plain, '\n'), l -> filter(split(l, ' '), x -> x <> ''))"
    starts = ", ".join(f"'{p.split()[0]}'" for p in PHRASES)
    hits = []
    for phrase, label in PHRASES.items():
        follows = " and ".join(f"get(words, i + {k}) = '{w}'" for k, w in enumerate(phrase.split()))
        hits.append(f"transform(filter(likely, i -> {follows}), i -> struct('{label}' as label, cast(i as long) as at))")
    known = ", ".join(f"'{w}'" for w in vocabulary)
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .select("doc_id", F.xxhash64("text").alias("row"), plain_text(F.col("text")).alias("plain"))
        .select("doc_id", "row", F.expr(lines).alias("lines"))
        .select("doc_id", "row", "lines", F.flatten("lines").alias("words"))
        .withColumn("likely", F.expr(f"filter(transform(words, (x, i) -> if(x in ({starts}), i, null)), i -> i is not null)"))
        .select(
            "doc_id",
            "row",
            F.size("words").cast("long").alias("n_words"),
            F.expr(f"concat({', '.join(hits)})").alias("places"),
            F.expr(f"transform(lines, l -> array_intersect(array({known}), l))").alias("blocks"),
        )
    )


def template_words(spark, templates: dict[str, str]) -> DataFrame:
    """(template, word, n_all, needed): the distinct words of each template."""
    rows = []
    for label, text in sorted(templates.items()):
        found = sorted(set(text.split()))
        needed = -(-round(CONTAINMENT * 1000) * len(found) // 1000)
        rows += [(label, word, len(found), needed) for word in found]
    return spark.createDataFrame(rows, "template string, word string, n_all int, needed int")


def found_templates(found: DataFrame, templates: dict[str, str]) -> DataFrame:
    """(doc_id, row, template, contained): templates with a block of that row, and the best share."""
    blocks = found.select("doc_id", "row", F.posexplode("blocks").alias("block", "own")).where(F.size("own") > 0)
    # Global order: the rarest word first. At most as many rows as the templates have words.
    counts = blocks.select(F.explode("own").alias("word")).groupBy("word").count()
    place = F.row_number().over(Window.orderBy(F.coalesce("count", F.lit(0)), "word"))
    parts = template_words(found.sparkSession, templates)
    order = parts.select("word").distinct().join(counts, "word", "left").select("word", place.alias("place"))
    at = F.row_number().over(Window.partitionBy("template").orderBy("place"))
    ordered = parts.join(order, "word").withColumn("i", at)
    prefix = ordered.where("i <= n_all - needed + 1").select("template", "word", "i", "n_all", "needed")
    whole = ordered.groupBy("template").agg(F.collect_list("word").alias("t"))
    prefix = stored(prefix.join(whole, "template"), "prefixes")
    order = stored(order, "word-order")

    # Blocks with a word of any prefix, at a length that can do for that template.
    shortest = prefix.groupBy("word").agg(F.min("needed").alias("least"))
    likely = (
        blocks.withColumn("word", F.explode("own"))
        .join(F.broadcast(shortest), "word")
        .where("size(own) >= least")
        .select("doc_id", "row", "block", "own")
        .distinct()
    )
    # Their words in the global order, and each word's place in it.
    keys = ["doc_id", "row", "block", "own"]
    sorted_words = F.array_sort(F.collect_list(F.struct("place", "word"))).alias("own_sorted")
    ranked = (
        likely.withColumn("word", F.explode("own"))
        .join(F.broadcast(order), "word")
        .groupBy(keys)
        .agg(sorted_words)
        .select("doc_id", "row", "block", "own", F.posexplode("own_sorted").alias("j", "s"))
        .select("doc_id", "row", "block", "own", (F.col("j") + 1).alias("j"), F.col("s.word").alias("word"))
    )
    return (
        ranked.join(F.broadcast(prefix), "word")
        .where("size(own) >= needed")
        .where("1 + least(n_all - i, size(own) - j) >= needed")
        .withColumn("shared", F.size(F.array_intersect("own", "t")))
        .where("shared >= needed")
        .groupBy("doc_id", "row", "template")
        .agg(F.max(F.col("shared") / F.col("n_all")).alias("contained"))
    )


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row per row of docs: counts and places of stated phrases, labels, and a score.

    n_base counts the places where a phrase's words stand one after the other; first_word and
    last_word are the smallest and largest start, null without a place. base_labels and labels are
    distinct, sorted and comma-joined; labels also has the templates found. score is 1 with a
    place, else the largest share of a found template that a block holds, else 0. A null text
    counts as empty: no words and empty labels. Repeated rows and null ids are kept.
    """
    vocabulary = sorted({word for text in templates.values() for word in text.split()})
    found = stored(with_words(docs, vocabulary), "license-words")
    extra = (
        found_templates(found, templates)
        .groupBy("doc_id", "row")
        .agg(F.collect_set("template").alias("more"), F.max("contained").alias("contained"))
        .withColumnsRenamed({"doc_id": "id", "row": "r"})
    )
    base = found.select(
        "doc_id",
        "row",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.at").alias("first_word"),
        F.array_max("places.at").alias("last_word"),
        F.array_sort(F.array_distinct("places.label")).alias("own"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("row") == F.col("r"))
    none = F.expr("cast(array() as array<string>)")
    return base.join(extra, same, "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("own", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("own", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("contained", F.lit(0.0))).alias("score"),
    )


def op7(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """License phrases and notices in all documents."""
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet") if docs is None else docs)
