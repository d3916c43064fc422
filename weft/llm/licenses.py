"""2. Licence scan by a positional rare-token index, in DataFrame operations only.

One pass over the texts keeps, per row, the places of the licence words (the templates' and
phrases' vocabulary, a fixed small set). Everything after that works on those places:

* base phrases: places where a phrase's words stand consecutively;
* templates: the inverse document frequency of every licence word is counted over all rows;
  every place of a licence word looks up the template postings (word -> template, position);
  hits are intersected by relative position (the place minus the template's position), and a
  template is found where the IDF found at one relative position
  reaches ``SHARE`` of the template's whole and every mandatory key phrase stands within it.

Defined results: null and empty texts have no words and no labels (empty strings, nulls for
first_word and last_word, score 0); each row is judged by itself, so repeated rows and null
ids keep their rows; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.session import shared_path

SHARE = 0.6
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The contract's phrases and labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Wording of public licence notices; the key phrases must all be there.
TEMPLATES = {
    "gpl": ("This program is free software you can redistribute it and/or modify it under the terms of the GNU General Public License "
            "as published by the Free Software Foundation", ["gnu general public license", "free software foundation"]),
    "lgpl": ("This library is free software you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
             "as published by the Free Software Foundation", ["gnu lesser general public license"]),
    "agpl": ("under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
             ["gnu affero general public license"]),
    "apache-2.0": ("Licensed under the Apache License Version 2.0", ["apache license version 2 0"]),
    "mit": ("Permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
            ["permission is hereby granted free of charge", "associated documentation files"]),
    "mit-notice": ("Released under the MIT License", ["mit license"]),
    "gpl-notice": ("This work is licensed under the GNU General Public License version 3", ["gnu general public license version 3"]),
    "bsd": ("Redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
            ["redistribution and use in source and binary forms"]),
    "isc": ("Permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted",
            ["permission to use copy modify"]),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License v 2 0", ["mozilla public license"]),
    "unlicense": ("This is free and unencumbered software released into the public domain", ["unencumbered software released into the public domain"]),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0", ["cc by nc"]),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0", ["cc by sa"]),
    "cc0": ("CC0 1.0 Universal public domain dedication", ["cc0 1 0 universal"]),
    "proprietary": ("All rights reserved", ["all rights reserved"]),
}
# Words too common to be looked up in the index; they only stand in phrases.
WEAK = set("a all and any are as by can for free in into is it met of or person that the this to under use v with without you 0 1 2 3 4".split())


def _split(text: str) -> list[str]:
    return "".join(c.lower() if c.isalnum() else " " for c in text).split()


def vocabulary() -> tuple[list[str], list[str]]:
    """(strong, weak) licence words."""
    words = {w for t, keys in TEMPLATES.values() for part in (t, *keys) for w in _split(part)} | {w for p in BASE for w in p.split()}
    return sorted(words - WEAK), sorted(words & WEAK)


def _places(found, phrase: list[str]):
    """Starts of a phrase among (pos, w) places."""
    first = F.filter(found, lambda x, i: _follows(found, i, x, phrase))
    return F.transform(first, lambda x: x.pos)


def _follows(found, i, x, phrase: list[str]):
    ok = x.w == phrase[0]
    for k, w in enumerate(phrase[1:], 1):
        nxt = F.get(found, i + k)
        ok = ok & (nxt.w == w) & (nxt.pos == x.pos + k)
    return F.coalesce(ok, F.lit(False))


def places(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, found): found holds (pos, w) of every licence word, in order."""
    strong, weak = vocabulary()
    phrase_words = F.array(*map(F.lit, strong))
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.regexp_extract_all(text, F.lit(WORDS), F.lit(0)).alias("words"))
    known = F.create_map(*(x for w in strong + weak for x in (F.lit(w), F.lit(True))))
    marked = F.transform("words", lambda w, i: F.struct(i.alias("pos"), w.alias("w")))
    some = F.filter(marked, lambda x: known[x.w].isNotNull())
    return rows.select("doc_id", F.size("words").cast("long").alias("n_words"),
                       F.when(F.arrays_overlap("words", phrase_words), some).alias("found"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    spark = docs.sparkSession
    path = shared_path(spark, f"licences-{uuid.uuid4().hex}")
    places(docs).withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    marked = rows.where("found is not null")
    strong, _ = vocabulary()
    total = rows.count()
    df = {r["w"]: r["n"] for r in marked.select(F.explode(F.array_distinct("found.w")).alias("w"))
          .groupBy("w").agg(F.count("*").alias("n")).collect()}  # one row per licence word at most
    idf = {w: math.log(1 + (total - df.get(w, 0) + 0.5) / (df.get(w, 0) + 0.5)) for w in strong}
    postings = [(name, i, w, idf[w]) for name, (text, _) in TEMPLATES.items() for i, w in enumerate(_split(text)) if w in idf]
    whole = {name: sum(p[3] for p in postings if p[0] == name) for name in TEMPLATES}
    index = F.broadcast(spark.range(1).select(F.inline(F.array(*(F.struct(  # a fixed table
        F.lit(t).alias("template"), F.lit(p).alias("tpos"), F.lit(w).alias("w"), F.lit(x).alias("idf")) for t, p, w, x in postings)))))

    hits = (marked.select("row", F.explode(F.filter("found", lambda x: F.array_contains(F.array(*map(F.lit, strong)), x.w))).alias("x"))
            .select("row", "x.pos", "x.w").join(index, "w")
            .groupBy("row", "template", (F.col("pos") - F.col("tpos")).alias("at")).agg(F.sum("idf").alias("idf")))
    full = F.create_map(*(F.lit(x) for kv in whole.items() for x in kv))
    hits = hits.withColumn("share", F.col("idf") / full[F.col("template")]).where(F.col("share") >= SHARE)
    spans = {name: len(_split(text)) for name, (text, _) in TEMPLATES.items()}
    phrases = [(name, p) for name, (_, keys) in TEMPLATES.items() for p in keys]
    there = marked.select("row", F.array(*(F.struct(F.lit(n).alias("template"), F.lit(p).alias("phrase"), _places(F.col("found"), p.split()).alias("p"))
                                           for n, p in phrases)).alias("keys"))
    there = there.select("row", F.explode("keys").alias("k")).select("row", "k.template", "k.phrase", F.explode("k.p").alias("p"))
    span = F.create_map(*(F.lit(x) for kv in spans.items() for x in kv))
    sure = (hits.join(there, ["row", "template"]).where((F.col("p") >= F.col("at") - 2) & (F.col("p") <= F.col("at") + span[F.col("template")]))
            .groupBy("row", "template", "at", "share").agg(F.countDistinct("phrase").alias("n")))
    need = F.create_map(*(F.lit(x) for name, (_, keys) in TEMPLATES.items() for x in (name, len(keys))))
    label = F.regexp_replace("template", "-notice$", "")
    found = (sure.where(F.col("n") == need[F.col("template")]).groupBy("row")
             .agg(F.collect_set(label).alias("extra"), F.max("share").alias("share")))  # a template's name at most once
    out = rows
    for i, p in enumerate(BASE):
        out = out.withColumn(f"b{i}", F.coalesce(F.when(F.col("found").isNotNull(), _places(F.col("found"), p.split())),
                                                 F.array().cast("array<int>")))
    every = F.concat(*(F.col(f"b{i}") for i in range(len(BASE))))
    base = F.array_compact(F.array(*(F.when(F.size(f"b{i}") > 0, name) for i, name in enumerate(BASE.values()))))
    out = out.withColumn("all", every).withColumn("base", base).drop("found").join(found, "row", "left")
    return out.select(
        "doc_id", "n_words", F.size("all").cast("long").alias("n_base"), F.array_min("all").cast("long").alias("first_word"),
        F.array_max("all").cast("long").alias("last_word"), F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", F.coalesce("extra", F.array().cast("array<string>"))))), ",").alias("labels"),
        F.least(F.coalesce("share", F.lit(0.0)), F.lit(1.0)).alias("score"))
