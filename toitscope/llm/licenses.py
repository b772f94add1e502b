"""Licence scan: lines and licence files against templates by TF-IDF cosine, then inheritance along directories.

Only DataFrame functions. The terms of a line are its runs of letters a-z and digits; a term weighs its count times
its inverse document frequency, counted over all documents for terms of the templates, and taken as that of an
unseen term for others. A line can reach the least similarity with a template only if it has one of the template's
anchors: the heaviest terms, without which what is left is too light. So whole texts are searched for anchors, and
only lines that have one are weighed, each distinct line once.

A file without a licence of its own takes that of the nearest directory above it whose licence file has one.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toitscope.llm.shared import staged, text_of

LEAST = 0.6

#: Notices by which licences are known, by public identifier.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met",
    ),
    ("Proprietary", "All rights reserved."),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice)([.][^/]*)?$"


def terms(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.translate(str.maketrans(UPPER, LOWER)))


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def term_text(lower: Column) -> Column:
    """Terms with one space between them."""
    return F.trim(F.regexp_replace(lower, "[^a-z0-9]+", " "))


def anchors_of(weights: dict[str, float], least: float) -> list[str]:
    """Heaviest terms of a template; a line without any of them has a smaller cosine than ``least``."""
    light = sum(w * w for w in weights.values())
    bound = least * least * light * (1 - 1e-9)
    out = []
    for term, w in sorted(weights.items(), key=lambda x: (-x[1], x[0])):
        if light < bound:
            break
        out.append(term)
        light -= w * w
    return out


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    path_column: str = "path",
    text_column: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES,
    least: float = LEAST,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, path, license, similarity, origin, license_path``.

    ``origin`` is ``own`` for a licence found in the file's lines (or, in a licence file, in its whole text),
    ``inherited`` for that of the nearest directory above with a licence file, which ``license_path`` names, and
    ``none``. The template with the greatest cosine of at least ``least`` wins, then the first licence by name, then
    the first path. A null or empty text has no licence of its own; a file with a null path neither inherits nor
    gives; null ids and repeated rows are rows like others; other columns are not read.
    """
    spark = docs.sparkSession
    read = docs.select(
        F.col(id_column).alias("doc_id"), F.col(path_column).alias("path"), text_of(text_column).alias("text")
    )
    vocabulary = sorted({term for _, text in templates for term in terms(text)})
    known = F.array(*[F.lit(term) for term in vocabulary])
    seen = read.select(F.explode(F.array_intersect(F.split(term_text(lowered(F.col("text"))), " "), known)).alias("term"))
    # One row per term of the templates and the number of documents: bounded by the templates.
    with_term = {row["term"]: row["count"] for row in seen.groupBy("term").count().collect()}
    total = read.count()
    unseen = math.log(1 + total) + 1
    idf = {term: math.log((1 + total) / (1 + with_term.get(term, 0))) + 1 for term in vocabulary}
    weights = [{t: n * idf[t] for t, n in Counter(terms(text)).items()} for _, text in templates]
    anchors = sorted({term for w in weights for term in anchors_of(w, least)})
    pattern = f"(^|[^a-z0-9])({'|'.join(anchors)})($|[^a-z0-9])"

    lower = lowered(F.col("text"))
    hit = F.lit(False)
    for term in anchors:
        hit = hit | F.contains(lower, F.lit(term))
    is_licence = F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False))
    lines = F.filter(F.split(lower, "\n"), lambda line: line.rlike(pattern))
    segments = F.transform(F.concat(lines, F.when(is_licence, F.array(lower)).otherwise(F.array())), term_text)
    rows = staged(
        read.select(
            "doc_id", "path", F.when(hit, F.array_distinct(segments)).otherwise(F.array().cast("array<string>")).alias("segments")
        ),
        "licence-segments",
    ).withColumn("row", F.monotonically_increasing_id())
    rows = staged(rows, "licence-rows")

    weight_of = spark.createDataFrame([(t, idf[t]) for t in vocabulary], "term string, idf double")
    named = [
        (i, name, term, w, math.sqrt(sum(x * x for x in ws.values())))
        for i, ((name, _), ws) in enumerate(zip(templates, weights, strict=True))
        for term, w in ws.items()
    ]
    template = spark.createDataFrame(named, "template int, license string, term string, weight double, norm double")
    # A segment may be a whole long text: its terms carry its digest, and so does all that follows.
    found = rows.select("row", F.explode("segments").alias("text")).withColumn("segment", F.md5("text"))
    counted = (
        found.groupBy("segment")
        .agg(F.first("text").alias("text"))
        .select("segment", F.explode(F.split("text", " ")).alias("term"))
        .groupBy("segment", "term")
        .agg(F.count("*").alias("tf"))
    )
    # Both broadcast tables come from the templates, not from the corpus.
    weighed = staged(
        counted.join(F.broadcast(weight_of), "term", "left").select(
            "segment", "term", (F.col("tf") * F.coalesce("idf", F.lit(unseen))).alias("w")
        ),
        "licence-terms",
    )
    norms = weighed.groupBy("segment").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("own_norm"))
    dots = (
        weighed.join(F.broadcast(template), "term")
        .groupBy("segment", "template", "license", "norm")
        .agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    )
    cosine = F.round(F.col("dot") / F.col("norm") / F.col("own_norm"), 6)
    best_line = staged(
        dots.join(norms, "segment")
        .withColumn("cosine", cosine)
        .where(F.col("cosine") >= least)
        .groupBy("segment")
        .agg(F.min(F.struct((-F.col("cosine")).alias("far"), "license")).alias("best")),
        "licence-lines",
    )
    best = found.select("row", "segment").join(best_line, "segment").groupBy("row").agg(F.min("best").alias("best"))
    directory = F.regexp_replace("path", "/?[^/]*$", "")
    own = staged(
        rows.join(best, "row", "left").select(
            "doc_id", "path", directory.alias("directory"), F.col("best.license").alias("license"), (-F.col("best.far")).alias("similarity")
        ),
        "licence-own",
    )
    given = (
        own.where(F.col("license").isNotNull() & F.col("path").rlike(LICENCE_FILE))
        .groupBy("directory")
        .agg(F.min(F.struct((-F.col("similarity")).alias("far"), "license", "path")).alias("gift"))
    )
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    ancestors = (
        own.select("directory").where("directory is not null").distinct()
        .select("directory", F.explode(F.array_distinct(above)).alias("ancestor"))
    )
    nearest = staged(
        ancestors.join(given.select(F.col("directory").alias("ancestor"), "gift"), "ancestor")
        .groupBy("directory")
        .agg(F.max_by("gift", F.length("ancestor")).alias("gift")),
        "licence-directories",
    )
    inherits = F.col("license").isNull() & F.col("gift").isNotNull()
    return own.join(nearest, "directory", "left").select(
        "doc_id",
        "path",
        F.when(inherits, F.col("gift.license")).otherwise(F.col("license")).alias("license"),
        F.when(inherits, -F.col("gift.far")).otherwise(F.col("similarity")).alias("similarity"),
        F.when(inherits, "inherited").when(F.col("license").isNotNull(), "own").otherwise("none").alias("origin"),
        F.when(inherits, F.col("gift.path")).otherwise(F.when(F.col("license").isNotNull(), F.col("path"))).alias("license_path"),
    )
