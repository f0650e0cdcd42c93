"""License scans by diagonal voting, in DataFrame operations only.

Every rolling word k-gram of a document is joined to the positions where a
template has the same k-gram. Hits vote for their diagonal (document position less
template position); neighbouring diagonals are merged, so small insertions or
deletions do not split a match; a span counts once enough of the template's words
stand in it. k-grams are compared word by word after the hash join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .native import literal_rows, words_of

# Phrases that name a license, with its label.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
# Well-known opening or notice sentences of licenses, with the label.
NOTICES = (
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution international license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
_SHORT, _LONG = 2, 4


def _grams(spark, phrases, notices) -> DataFrame:
    """(hash, template, label, whole, n, k, at, gram): one row per template position."""
    rows = []
    for kind, k, templates in ((True, _SHORT, phrases), (False, _LONG, notices)):
        for i, (label, text) in enumerate(templates):
            n = len(text.split(" "))
            if not k <= n <= 60:
                raise ValueError(f"a template of this kind has {k} to 60 words: {text!r}")
            rows.append((i if kind else 1000 + i, label, kind, n, k, text))
    t = literal_rows(spark, rows, ["template", "label", "whole", "n", "k", "text"]).withColumn("w", F.split("text", " "))
    t = t.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("k"))).alias("at")).withColumn("gram", F.slice("w", F.col("at") + 1, F.col("k")))
    short, long = (F.xxhash64(*(F.get("gram", F.lit(j)) for j in range(k))) for k in (_SHORT, _LONG))
    return t.select(F.when(F.col("whole"), short).otherwise(long).alias("hash"), "template", "label", "whole", "n", "k", "at", "gram")


def scan_licenses(docs: DataFrame, *, phrases=PHRASES, notices=NOTICES, least: float = 0.6, drift: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scan every whole text; one row per input row.

    Phrases count wherever their words stand consecutively. Notices count if at
    least the share ``least`` of their words is found on diagonals at most
    ``drift`` apart. The template table is a constant, so its broadcast is bounded.

    Null texts are empty (no words, no labels, score 0); null ids pass through;
    repeated rows give repeated results; an empty table gives no rows; other
    columns are ignored. Returns doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, spans (label, first word, end word, coverage).
    """
    grams = _grams(docs.sparkSession, phrases, notices)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("uid"), words_of(F.col(text_col)).alias("words"))
    at = rows.select("doc_id", "uid", "words", F.size("words").cast("long").alias("n_words"), F.posexplode_outer("words").alias("i", "_w"))
    word = lambda j: F.get("words", F.col("i") + j)
    hashes = F.array(*(F.xxhash64(*(word(j) for j in range(k))) for k in (_SHORT, _LONG)))
    keyed = at.select("doc_id", "uid", "words", "n_words", "i", F.posexplode(hashes).alias("_which", "hash"))
    g = grams.select(F.col("hash").alias("g_hash"), "template", "label", "whole", "n", "k", F.col("at").alias("g_at"), "gram")
    hit = (keyed["hash"] == g["g_hash"]) & (F.slice("words", F.col("i") + 1, F.col("k")) == F.col("gram"))
    # A document's first row stays without a hit too, so that each row has a result.
    found = keyed.join(F.broadcast(g), hit, "left_outer").where(F.col("template").isNotNull() | (F.coalesce("i", F.lit(0)) == 0) & (F.col("_which") == 0))
    votes = found.groupBy("uid", "doc_id", "n_words", "template", "label", "whole", "n", "k", (F.col("i") - F.col("g_at")).alias("diagonal")).agg(
        F.bit_or(F.expr("shiftleft(1L, g_at)")).alias("seen"), F.min("i").alias("low"), F.max("i").alias("high")
    )
    by_template = Window.partitionBy("uid", "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(by_template)
    apart = F.when(F.col("whole") | step.isNull() | (step > drift), 1).otherwise(0)
    spans = votes.withColumn("_new", apart).withColumn("span", F.sum("_new").over(by_template))
    merged = spans.groupBy("uid", "doc_id", "n_words", "template", "label", "whole", "n", "k", "span").agg(F.bit_or("seen").alias("seen"), F.min("low").alias("low"), (F.max("high") + F.first("k")).alias("high"))
    covered = F.col("seen")
    for j in range(1, _LONG):
        covered = covered.bitwiseOR(F.when(F.col("k") > j, F.shiftleft("seen", j)).otherwise(F.lit(0).cast("long")))
    share = F.bit_count(covered) / F.col("n")
    judged = merged.withColumn("share", share).withColumn("ok", (F.col("share") >= F.when(F.col("whole"), 1.0).otherwise(least)))
    base = F.col("ok") & F.col("whole")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return judged.groupBy("uid", "doc_id", "n_words").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("low").cast("long"))).alias("first_word"),
        F.max(F.when(base, F.col("low").cast("long"))).alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined(F.when(F.col("ok"), F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(F.col("ok") | ~F.col("whole"), F.col("share"))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("ok"), F.struct("low", "high", "label", "share")))).alias("spans"),
    ).drop("uid")
