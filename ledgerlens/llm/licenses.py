"""License scans: a positional index of rare words, verified by mandatory phrases.

1. Document counts of all licence words are taken over all documents; they give each
   word's weight (inverse document frequency, in thousandths). A template posts its
   ``RAREST`` words of highest weight, each with its place.
2. A file that holds a phrase some template must hold looks up its words in those
   postings. Places of file and template are subtracted; words of one template that agree
   in the difference stand as they stand in the template. Their weight, against that of
   all the template posts, is the score: it depends on no other template and on no other
   word of the file. Words that no template finds rare enough to post are not looked up.
3. A template that scores ``ENOUGH`` counts.

Base labels come from phrases alone. Files without the first word of any phrase skip
all steps but the counting; all steps are DataFrame functions.

Null or empty texts have no words and no label. Ids may be null or repeated, equal rows
give equal results, an empty table gives an empty result. Only the two named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.staging import staged

# Upper-case and lower-case letters that are made equal, and what separates words.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_CLASS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"

# Base phrases and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


class Template(NamedTuple):
    label: str
    text: str
    must_hold: str


# Wording of widespread licence notices, lower case, with a phrase each must hold.
TEMPLATES = [
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    Template("apache", "licensed under the apache license version 2 0", "apache license"),
    Template("gpl", "this work is licensed under the gnu general public license version 3", "general public license"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license", "mozilla public license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    Template("cc-by", "creative commons attribution 4 0 international license", "creative commons attribution 4"),
    Template("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind", "warranties or conditions of any kind"),
    Template("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "endorse or promote products"),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", "lesser general public license"),
    Template("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", "affero general public license"),
    Template("epl", "made available under the terms of the eclipse public license", "eclipse public license"),
    Template("zlib", "in no event will the authors be held liable for any damages arising from the use of this software", "liable for any damages arising from the use"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
]

#: Words that a template posts, those of highest weight.
RAREST = 12
#: Part of a template's weight that must be found in place, in hundredths.
ENOUGH = 60


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, BETWEEN_CLASS + "+"), "")


def postings(weight: Mapping[str, int]) -> list[tuple[str, int, int, int, int]]:
    """Word, template, place, weight and the template's whole weight, of each template's ``RAREST`` places; the first places on a tie."""
    rows = []
    for number, t in enumerate(TEMPLATES):
        rarest = sorted(enumerate(t.text.split()), key=lambda at: (-weight[at[1]], at[0]))[:RAREST]
        whole = sum(weight[w] for _, w in rarest)
        rows += [(w, number, place, weight[w], whole) for place, w in rarest]
    return rows


def _places(words: str, phrase: str) -> str:
    """SQL of the places where a phrase's words stand one after the other."""
    parts = phrase.split()
    same = " AND ".join(f"{words}[i + {k}] = '{p}'" if k else f"{words}[i] = '{p}'" for k, p in enumerate(parts))
    return f"IF(size({words}) >= {len(parts)}, filter(sequence(0, size({words}) - {len(parts)}), i -> {same}), array())"


def scanned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and matches (label, place, score)."""
    spark = docs.sparkSession
    vocabulary = sorted({w for t in TEMPLATES for w in t.text.split()} | {w for p in BASE_PHRASES for w in p.split()})
    openers = sorted({p.split()[0] for p in BASE_PHRASES} | {t.must_hold.split()[0] for t in TEMPLATES})
    listed = ", ".join(f"'{w}'" for w in vocabulary)
    opening = ", ".join(f"'{w}'" for w in openers)
    read = docs.select(docs[doc_id].alias("doc_id"), words_of(docs[text]).alias("w"))
    known = F.expr(f"array_intersect(w, array({listed}))")
    read = read.withColumn("known", known)
    read = read.select(
        "doc_id",
        F.size("w").cast("bigint").alias("n_words"),
        "known",
        F.when(F.arrays_overlap("known", F.expr(f"array({opening})")), F.col("w")).alias("w"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Written once: the rows' numbers are then fixed.
    files = staged(read, "license-files")

    n_files = files.agg(F.count("*")).first()[0]
    held = {r["word"]: r["n"] for r in files.select(F.explode("known").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    weight = {w: 1 + round(1000 * max(0.0, math.log((n_files + 1) / (held.get(w, 0) + 1)))) for w in vocabulary}

    posted = postings(weight)
    # At most RAREST rows for each template.
    index = spark.createDataFrame(posted, "word string, template int, at int, weight bigint, best bigint")
    rare = ", ".join(f"'{w}'" for w in sorted({row[0] for row in posted}))

    candidates = files.filter("w IS NOT NULL")
    base = F.array_sort(F.flatten(F.array(*(F.expr(_places("w", p)) for p in BASE_PHRASES))))
    base_labels = F.filter(F.array(*(F.when(F.size(F.expr(_places("w", p))) > 0, F.lit(label)) for p, label in BASE_PHRASES.items())), lambda x: x.isNotNull())
    verified = F.array(*(F.size(F.expr(_places("w", t.must_hold))) > 0 for t in TEMPLATES))
    judged = staged(candidates.select("row", "w", base.alias("base"), base_labels.alias("base_labels"), verified.alias("verified")), "license-candidates")

    # Templates whose phrase is missing cannot count, so only the others are aligned.
    possible = judged.filter(F.exists("verified", lambda v: v))
    looked_up = possible.select("row", "verified", F.posexplode("w").alias("place", "word")).filter(f"word IN ({rare})")
    at_word = F.broadcast(index.withColumnRenamed("word", "_word"))
    aligned = looked_up.join(at_word, (F.col("word") == F.col("_word")) & F.get("verified", F.col("template"))).groupBy("row", "template", (F.col("place") - F.col("at")).alias("shift"))
    sums = aligned.agg(F.sum("weight").alias("weight"), F.max("best").alias("best"))
    scores = sums.withColumn("score", F.col("weight") / F.col("best"))
    one = Window.partitionBy("row", "template").orderBy(F.col("score").desc(), "shift")
    scores = scores.withColumn("nth", F.row_number().over(one)).filter("nth = 1")
    label_of = F.array(*(F.lit(t.label) for t in TEMPLATES))
    entry = F.struct(F.get(label_of, F.col("template")).alias("label"), F.col("shift").alias("place"), "score", "template")
    per_file = staged(scores.groupBy("row").agg(F.array_sort(F.collect_list(entry)).alias("found")), "license-scores")

    joined = judged.select("row", "base", "base_labels").join(per_file, "row", "left")
    passed = F.filter(F.coalesce("found", F.array()), lambda m: m["score"] * 100 >= ENOUGH)
    joined = joined.withColumn("matches", passed)
    results = joined.select(
        "row",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min("base").cast("bigint").alias("first_word"),
        F.array_max("base").cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base_labels")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", F.transform("matches", lambda m: m["label"]))), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"),
        "matches",
    )
    whole = files.select("doc_id", "n_words", "row").join(staged(results, "license-results"), "row", "left")
    return whole.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        "matches",
    )
