"""Licences of files: sparse TF-IDF cosine to templates, inherited from the nearest directory."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, settled, store

# The usual notices and opening lines of public licences.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this"
                   " file except in compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
            " and associated documentation files (the \"Software\"), to deal in the Software without"
            " restriction, including without limitation the rights to use, copy, modify, merge, publish,"
            " distribute, sublicense, and/or sell copies of the Software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of"
                " the GNU General Public License as published by the Free Software Foundation, either"
                " version 3 of the License, or (at your option) any later version"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are"
                     " permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0"
                     " International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
            " without fee is hereby granted"),
]
# A line is compared if it has one of these; every template does.
SIGNALS = ["license", "licensed", "licence", "licenced", "permission", "redistribution", "software",
           "public", "copyright"]
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|unlicense|notice)([.-].*)?$"
_TOKEN = r"[^a-z0-9.\-]+"
# Words of a text whose windows are laid at a time.
CHUNK = 2_000


def _tokens(text):
    """Lower-case words of a line; dots and hyphens only inside."""
    split = F.split(F.lower(text), _TOKEN)
    return F.filter(F.transform(split, lambda w: F.trim(w, F.lit(".-"))), lambda w: w != "")


def _passages(texts, is_line):
    return F.transform(texts, lambda x: F.struct(x.alias("line"), F.lit(is_line).alias("is_line")))


def _template_words():
    return [[w for w in (x.strip(".-") for x in re.split(_TOKEN, body.lower())) if w] for _, body in TEMPLATES]


def _chunks(words):
    """The words in stretches of CHUNK, each with what windows around its words reach on both sides."""
    reach = max(map(len, _template_words()))
    return F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(F.size(words), F.lit(1)) - 1) / CHUNK).cast("int")),
        lambda c: F.struct(
            F.slice(words, F.greatest(c * CHUNK - reach, F.lit(0)) + 1, F.least(c * CHUNK, F.lit(reach)) + CHUNK + reach)
            .alias("words"),
            F.least(c * CHUNK, F.lit(reach)).alias("begin"),
        ),
    )


def _windows(words, first):
    """Windows of each template's length around every signal that the template has, as texts.

    Signals are those among the CHUNK words from ``first`` on.
    """
    laid = {}
    for own in _template_words():
        for at, word in enumerate(own):
            if word in SIGNALS:
                laid.setdefault(word, set()).add((at, len(own)))
    laid["licence"], laid["licenced"] = laid["license"], laid["licensed"]
    pair = lambda at, n: F.struct(F.lit(at).alias("at"), F.lit(n).alias("n"))
    layouts = lambda word: F.coalesce(*[
        F.when(word == signal, F.array(*[pair(*p) for p in sorted(places)])) for signal, places in laid.items()
    ])
    marked = F.filter(
        F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
        lambda x: x["w"].isin(*laid) & (x["i"] >= first) & (x["i"] < first + CHUNK),
    )

    def window(i, p):
        begin = F.greatest(i - p["at"], F.lit(0))
        return F.array_join(F.slice(words, begin + 1, i - p["at"] + p["n"] - begin), " ")

    return F.flatten(F.transform(marked, lambda x: F.transform(layouts(x["w"]), lambda p: window(x["i"], p))))


def license_lines(df: DataFrame, key: str, text: str, min_cosine: float) -> DataFrame:
    """Per key, the best template of any of its lines: ``key, licence, cosine``.

    Weights are term frequency times log inverse document frequency, where the
    documents are all lines with a signal and the templates. Texts of any length
    are compared by lines, by blocks between blank lines, as a whole, and by
    windows as long as a template, laid so that a signal of the template falls on
    the same word in the text, so line breaks don't matter. A very long text takes time and rows in
    proportion to its length: windows are made for a stretch of its words at a time.
    """
    spark = df.sparkSession
    templates = spark.createDataFrame(
        [(i, name, text) for i, (name, text) in enumerate(TEMPLATES)], "t int, name string, body string"
    )
    signal = r"(?i)\b(" + "|".join(SIGNALS) + r")\b"
    has_signal = lambda x: x.rlike(signal)
    # Equal passages of a text are one; strings are told apart by hashing, structs would be pair by pair.
    whole = df.where(has_signal(F.col(text))).select(F.col(key).alias("key"), F.col(text).alias("text"))
    blocks = F.transform(
        F.concat(F.filter(F.split("text", r"\n[\x20\x09-\x0D]*\n"), has_signal), F.array("text")),
        lambda x: F.regexp_replace(x, SPACE_CLASS + "+", " "),
    )
    as_lines = whole.select("key", F.inline(F.concat(
        _passages(F.array_distinct(F.filter(F.split("text", "\n"), has_signal)), True),
        _passages(F.array_distinct(blocks), False),
    )))
    worded = settled(whole.select("key", _tokens(F.col("text")).alias("words")), ["key"], ["words"])
    chunks = worded.select("key", F.inline(_chunks(F.col("words"))))
    as_windows = chunks.select(
        "key", F.explode(F.array_distinct(_windows(F.col("words"), F.col("begin")))).alias("line"), F.lit(False).alias("is_line")
    )
    lines = as_lines.unionByName(as_windows)
    # Equal passages of any number of files are compared once.
    lines = store(lines, "lines")
    distinct = store(
        lines.groupBy("line").agg(F.max("is_line").alias("is_line")).withColumn("l", F.xxhash64("line")),
        "distinct_lines",
    )
    terms = (
        distinct.select("l", "is_line", F.explode(_tokens(F.col("line"))).alias("term"))
        .groupBy("l", "is_line", "term").agg(F.count("*").cast("double").alias("tf"))
    )
    terms = store(terms, "terms")
    wanted = templates.select("t", "name", F.explode(_tokens(F.col("body"))).alias("term")).groupBy(
        "t", "name", "term").agg(F.count("*").cast("double").alias("tf"))
    wanted = store(wanted, "template_terms")
    n_lines = distinct.where("is_line").count() + len(TEMPLATES)
    df_of = (
        terms.where("is_line").select("term").unionByName(wanted.select("term"))
        .groupBy("term").agg((F.log(F.lit(float(n_lines)) / F.count("*")) + 1).alias("idf"))
    )
    df_of = store(df_of.withColumnRenamed("term", "_term"), "idf")
    # A word that no compared line has counts as in one.
    rarest = F.log(F.lit(float(n_lines))) + 1
    weigh = lambda t: t.join(df_of, F.col("term") == F.col("_term"), "left").withColumn(
        "w", F.col("tf") * F.coalesce("idf", rarest)).drop("_term", "idf", "tf")
    weighed = weigh(terms)
    norms = weighed.groupBy(F.col("l").alias("_l")).agg(F.sqrt(F.sum(F.col("w") ** 2)).alias("norm"))
    # One row per template and term: a fixed table.
    template_weights = weigh(wanted).withColumnsRenamed({"term": "_t_term", "w": "tw"})
    template_norms = template_weights.groupBy(F.col("t").alias("_t")).agg(
        F.sqrt(F.sum(F.col("tw") ** 2)).alias("t_norm"))
    dots = (
        weighed.join(F.broadcast(template_weights), F.col("term") == F.col("_t_term"))
        .groupBy("l", "t", "name").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
        .join(F.broadcast(template_norms), F.col("t") == F.col("_t"))
        .join(norms, F.col("l") == F.col("_l"))
        .select("l", "name", (F.col("dot") / (F.col("norm") * F.col("t_norm"))).alias("cosine"))
        .where(F.col("cosine") >= min_cosine)
    )
    best = store(
        dots.groupBy(F.col("l").alias("_l")).agg(
            F.max("cosine").alias("cosine"), F.max_by("name", F.struct("cosine", "name")).alias("licence")
        ), "best",
    )
    return (
        lines.join(best, F.xxhash64("line") == F.col("_l"))
        .groupBy("key")
        .agg(F.max_by("licence", F.struct("cosine", "licence")).alias("licence"),
             F.max("cosine").alias("cosine"))
    )


def scan_licenses(
    df: DataFrame,
    min_cosine: float = 0.7,
    path_col: str = "path",
    text_col: str = "text",
) -> DataFrame:
    """The licence of every file: its own notice, or that of the nearest directory above it.

    Own: the template nearest to any passage of the whole text, by cosine of
    sparse TF-IDF vectors, from ``min_cosine`` on. A licence file is one named
    like one (LICENSE, COPYING ...) with a licence of its own; it governs its
    directory and all below it, and the file nearest to another decides (then
    the smallest name). Directories are matched by joins on the paths of all
    directories, not of all files. Adds ``licence, cosine, origin`` ('own',
    'inherited', or NULL with the other two) to every row.

    NULL and empty texts have no licence of their own and may inherit; a NULL
    path inherits nothing. Rows with the same path and text get the same result;
    ties between templates go to the last name in order. An empty table gives
    an empty result. All columns stay, those named like the new ones are
    replaced.
    """
    kept = [c for c in df.columns if c not in ("licence", "cosine", "origin")]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    path = F.col(f"`{path_col}`").cast("string")
    base = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_file"), path.alias("_path"), text.alias("_text"),
        F.xxhash64(F.coalesce(path, F.lit("")), F.octet_length(text), text).alias("_key"),
    )
    keyed = base.select("_key", "_path", "_text")
    own = store(license_lines(keyed, "_key", "_text", min_cosine), "own").withColumnsRenamed(
        {"key": "_of", "licence": "_own", "cosine": "_own_cosine"})
    # Directories: '' is the one above all.
    directory = F.regexp_replace(F.regexp_replace("_path", r"[^/]*$", ""), r"/$", "")
    name = F.regexp_extract("_path", r"([^/]*)$", 1)
    files = (
        keyed.where(F.col("_path").isNotNull() & name.rlike(LICENCE_FILE)).select("_key", "_path")
        .join(own, F.col("_key") == F.col("_of"))
        .groupBy(directory.alias("_governed"))
        .agg(F.min_by(F.struct("_own", "_own_cosine"), "_path").alias("_given"))
    )
    files = store(files, "licence_files")
    directories = store(
        keyed.where(F.col("_path").isNotNull()).select(directory.alias("dir")).distinct(), "directories"
    )
    parts = F.split("dir", "/")
    above = directories.select(
        "dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth")
    ).select("dir", "depth", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/").alias("_above"))
    nearest = store(
        above.join(files, F.col("_above") == F.col("_governed"))
        .groupBy(F.col("dir").alias("_dir")).agg(F.max_by("_given", "depth").alias("_given")),
        "nearest",
    )
    joined = base.join(own, F.col("_key") == F.col("_of"), "left").join(
        nearest, directory == F.col("_dir"), "left"
    )
    has_own = F.col("_own").isNotNull()
    return joined.select(
        "_file.*",
        F.coalesce("_own", "_given._own").alias("licence"),
        F.coalesce("_own_cosine", "_given._own_cosine").alias("cosine"),
        F.when(has_own, "own").when(F.col("_given").isNotNull(), "inherited").alias("origin"),
    )
