"""License scans by diagonal voting, in DataFrame operations only.

Every run of three words of a document is hashed and joined with the runs of the license templates. A hit at word
p of the document and word t of a template votes for the diagonal p - t. Votes are summed per diagonal, neighbouring
diagonals (a word put in or left out) are merged, and the spans that come out are verified by the share of the
template they cover. Base phrases are templates that must be covered whole on one diagonal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.local import local_frame

# Phrases and the labels they stand for; a base phrase counts only where its words stand consecutively.
BASE = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
# Notices as their licenses word them.
NOTICES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2"),
    ("lgpl-3", "under the terms of the gnu lesser general public license version 3"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

GRAM = 3
#: Share of a template's runs that a span must cover.
COVER = 0.8
#: Diagonals at most this far apart are one span.
NEAR = 3
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Up to so many template runs are broadcast, at some 100 bytes each; more are joined by a shuffle.
BROADCAST_RUNS = 50_000


#: The run that heads every document's list and stands for the document itself.
HEAD = 0


def template_runs(spark: SparkSession, base: Sequence[tuple[str, str]], notices: Sequence[tuple[str, str]]) -> DataFrame:
    """run (hash), words, template, t (place in it), runs (how many it has), label, base; template -1 meets each document's head."""
    rows = [([""] * GRAM, -1, 0, 0, "", False)]
    for k, (label, phrase) in enumerate([*base, *notices]):
        words = phrase.split()
        if len(words) < GRAM:
            raise ValueError(f"a template needs {GRAM} words: {phrase!r}")
        rows += [(words[t : t + GRAM], k, t, len(words) - GRAM + 1, label, k < len(base)) for t in range(len(words) - GRAM + 1)]
    runs = local_frame(spark, rows, "words array<string>, template int, t int, runs int, label string, base boolean")
    hashed = F.xxhash64(*[F.col("words")[i] for i in range(GRAM)])
    runs = runs.select("*", F.when(F.col("template") < 0, F.lit(HEAD).cast("long")).otherwise(hashed).alias("run"))
    return F.broadcast(runs) if len(rows) <= BROADCAST_RUNS else runs


def scan_licenses(
    docs: DataFrame,
    base: Sequence[tuple[str, str]] = BASE,
    notices: Sequence[tuple[str, str]] = NOTICES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts all places of base phrases, first_word and last_word are the smallest and largest word they start
    at (null without any). labels adds the notices found to base_labels. score is the best cover of any span, 0
    without one. A null text counts as empty: no words, empty labels. Null ids and repeated rows give a row each; an
    empty table gives none. Only the id and the text are looked at.

    The text is read once. What is shuffled, once and by document, is one head per document and the verified hits.
    """
    # lower() also folds other scripts, which changes neither the cuts (no sign outside ASCII becomes a separator)
    # nor matches with the templates, and it runs at a fraction of the cost of translate().
    text = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    own = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("own"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("said"))
    run = F.transform("said", lambda w, i: F.xxhash64(w, F.get("said", i + 1), F.get("said", i + 2)))
    placed = own.select("doc_id", "own", "said", F.posexplode(F.concat(F.array(F.lit(HEAD).cast("long")), run)).alias("p", "run"))
    same = F.slice("said", F.greatest("p", F.lit(1)), GRAM) == F.col("words")
    hits = placed.join(template_runs(docs.sparkSession, base, notices), "run")
    hits = hits.filter(F.when(F.col("template") < 0, F.col("p") == 0).otherwise((F.col("p") > 0) & same))
    hits = hits.select("doc_id", "own", F.size("said").cast("long").alias("n_words"), "template", "runs", "label", "base", "t", (F.col("p") - 1).alias("p"))
    hits = hits.repartition("doc_id", "own")

    document = ["doc_id", "own", "n_words"]
    template = [*document, "template", "runs", "label", "base"]
    votes = hits.groupBy(*template, (F.col("p") - F.col("t")).alias("diagonal")).agg(
        F.collect_set("t").alias("ts"), F.min("p").alias("start"), F.max("p").alias("end"), F.count("*").alias("copies")
    )
    along = Window.partitionBy(*template).orderBy("diagonal")
    apart = F.col("base") | F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > NEAR, F.lit(True))
    votes = votes.withColumn("first", apart.cast("int")).withColumn("span", F.sum("first").over(along))
    spans = votes.groupBy(*template, "span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("ts")))).alias("covered"), F.min("start").alias("start"), F.max("end").alias("end"), F.max("copies").alias("copies")
    )
    cover = F.when(F.col("template") >= 0, F.col("covered") / F.col("runs"))
    within = F.col("end") - F.col("start") + 1 <= 1.5 * F.col("runs") + NEAR
    holds = F.when(F.col("base"), F.col("covered") == F.col("runs")).otherwise((cover >= COVER) & within)
    at_base = F.when(F.col("base") & holds, F.col("start").cast("long"))
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    found = spans.groupBy(*document).agg(
        F.count(at_base).alias("n_base"),
        F.min(at_base).alias("first_word"),
        F.max(at_base).alias("last_word"),
        joined(F.when(at_base.isNotNull(), F.col("label"))).alias("base_labels"),
        joined(F.when(holds, F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(holds, cover)), F.lit(0.0)).alias("score"),
        F.max(F.when(F.col("template") < 0, F.col("copies"))).alias("copies"),
    )
    repeated = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return repeated.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
