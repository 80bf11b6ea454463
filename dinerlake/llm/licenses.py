"""Licence scanning: TF-IDF cosine to templates, then inheritance along directories.

Passages that may state a licence (lines with a licence word, the lines and paragraphs around them, comment
blocks, whole licence files) become sparse term vectors, weighted by the inverse frequency of a term among
all passages, and are compared with the templates; whole licence files also with the full texts in
``licence_texts``.  A file without a licence of its own takes that of the nearest directory
above it that holds a licence file.  DataFrame operations only.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dinerlake.llm.common import numbered, written

LEAST = 0.5
LEAST_TEXT = 0.85  # of a full text: licences share much of their wording
CUE = r"(?i)licen[cs]|copyright|spdx|copyleft|public domain|permission is hereby|redistribution and use"
COMMENT = r"^\s*(?:#|//|/?\*|--|;|%)"
LICENCE_FILE = r"(?i)(?:^|/)(?:un)?(?:licen[cs]e|copying|notice)[^/]*$"
# Possessive: a long chain of numbers is taken in one loop, without the matcher's stack.
TERM = r"[a-z0-9]+(?:\.[0-9]+)*+"

# A licence's short name and how files usually state it.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files, to deal in the Software without restriction"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met: neither the name of the copyright holder"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation, either version 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation; either version 2"),
    ("GPL-1.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation; either version 1"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-1.0", "GNU General Public License Version 1, February 1989"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "Lesser General Public License as published by the Free Software Foundation, either version 3"),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
     "Lesser General Public License as published by the Free Software Foundation; either version 2.1"),
    ("LGPL-2.0", "GNU Library General Public License Version 2, June 1991"),
    ("LGPL-2.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
     "Library General Public License as published by the Free Software Foundation; either version 2"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "Affero General Public License as published by the Free Software Foundation, either version 3"),
    ("GFDL-1.3", "GNU Free Documentation License Version 1.3, 3 November 2008"),
    ("GFDL-1.2", "GNU Free Documentation License Version 1.2, November 2002"),
    ("Artistic-1.0-Perl", "Licensed under the Artistic License"),
    ("MPL-1.1", "Mozilla Public License Version 1.1"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may "
     "not use this file except in compliance with the License"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0 Creative Commons Attribution 4.0 International"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0 Creative Commons Attribution ShareAlike"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("ISC", "Licensed under the ISC License"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)


def full_texts() -> list[tuple[str, str]]:
    """Licences and their full texts; a variant's file name has a suffix after the licence's name."""
    found = resources.files("dinerlake.llm") / "licence_texts"
    return [(f.name.removesuffix(".txt").removesuffix("-plain"), f.read_text("utf-8"))
            for f in sorted(found.iterdir(), key=lambda f: f.name) if f.name.endswith(".txt")]


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def passages(files: DataFrame) -> DataFrame:
    """Rows (path, passage, text): what may state a licence."""
    cued = numbered(
        files.where(F.col("text").rlike(CUE)
                    | (F.col("path").rlike(LICENCE_FILE) & (F.length("text") > 0)))
        .select("path", "text"),
        "cued",
    )
    lines = cued.select("path", "rid", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    cue = F.col("line").rlike(CUE)
    single = lines.where(cue).select(
        "path", F.concat_ws(":", F.lit("line"), "rid", "pos").alias("passage"), F.col("line").alias("text"))
    # A statement may run over several lines: the lines beside a cue, and its paragraph with the title above.
    joined = (
        around(cued, "near", r"\n", 1, 1).unionByName(around(cued, "paragraph", r"\n[ \t\r]*\n\s*", 0, 0))
        .unionByName(around(cued, "titled", r"\n[ \t\r]*\n\s*", 1, 0))
    )
    rank = F.row_number().over(Window.partitionBy("rid").orderBy("pos"))
    blocks = (
        lines.where(F.col("line").rlike(COMMENT)).withColumn("run", F.col("pos") - rank)
        .groupBy("path", "rid", "run")
        .agg(F.array_join(F.array_sort(F.collect_list(F.struct("pos", "line")))["line"], " ").alias("text"),
             F.count("*").alias("n"))
        .where((F.col("n") > 1) & F.col("text").rlike(CUE))
        .select("path", F.concat_ws(":", F.lit("block"), "rid", "run").alias("passage"), "text")
    )
    whole = cued.where(F.col("path").rlike(LICENCE_FILE)).select(
        "path", F.concat_ws(":", F.lit("file"), "rid").alias("passage"), "text")
    return single.unionByName(joined).unionByName(blocks).unionByName(whole)


def around(cued: DataFrame, kind: str, between: str, before: int, after: int) -> DataFrame:
    """Pieces of a text that hold a cue, each joined with its neighbours; a text of one piece has none."""
    at = F.posexplode(F.filter(F.sequence(F.lit(0), F.size("pieces") - 1),
                               lambda i: F.col("pieces")[i].rlike(CUE))).alias("place", "at")
    pieces = cued.select("path", "rid", F.split("text", between).alias("pieces")).where(F.size("pieces") > 1)
    first = F.greatest(F.col("at") - before, F.lit(0))
    return pieces.select("path", "rid", "pieces", at).select(
        "path", F.concat_ws(":", F.lit(kind), "rid", "at").alias("passage"),
        F.array_join(F.slice("pieces", first + 1, F.col("at") - first + 1 + after), " ").alias("text"))


def weighted(counts: DataFrame, idf: DataFrame) -> DataFrame:
    """Term counts (name, term, n) with their weights scaled to length 1 per name."""
    weights = counts.join(idf, "term").select("name", "term", ((1 + F.log("n")) * F.col("idf")).alias("w"))
    norms = weights.groupBy("name").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weights.join(norms, "name").select("name", "term", (F.col("w") / F.col("norm")).alias("w"))


def own_licenses(files: DataFrame) -> DataFrame:
    """Rows (path, license, score): the template most like a passage of the file, if like enough."""
    found = written(passages(files), "passages")
    counts = written(
        found.select("path", F.col("passage").alias("name"), F.explode(terms(F.col("text"))).alias("term"))
        .groupBy("path", "name", "term").agg(F.count("*").alias("n")),
        "terms",
    )
    spark = files.sparkSession
    known = [(*t, False) for t in TEMPLATES] + [(*t, True) for t in full_texts()]
    templates = spark.createDataFrame(
        [(i, *t) for i, t in enumerate(known)], "name int, license string, text string, whole boolean")
    marks = templates.select("name", F.explode(terms(F.col("text"))).alias("term")).groupBy(
        "name", "term").agg(F.count("*").alias("n"))
    total = found.agg(F.count("*")).first()[0] + len(known)
    frequency = counts.select("term").unionByName(marks.select("term")).groupBy("term").agg(
        F.count("*").alias("df"))
    idf = written(
        frequency.select("term", (F.log(F.lit(1.0 + total) / (1 + F.col("df"))) + 1).alias("idf")), "idf")
    left = weighted(counts.select("name", "term", "n"), idf)
    right = weighted(marks, idf).join(templates.select("name", "whole"), "name").select(
        F.col("name").alias("template"), "whole", "term", F.col("w").alias("v"))
    # The templates are the fixed list above and the full texts: some ten thousand terms.  Full texts are
    # compared with whole licence files only.
    scores = left.withColumn("file", F.col("name").startswith("file:")).join(F.broadcast(right), "term").where(
        F.col("file") | ~F.col("whole")).groupBy("name", "template").agg(
        F.sum(F.col("w") * F.col("v")).alias("score"))
    best = scores.withColumn("score", F.round("score", 6)).join(
        F.broadcast(templates.select(F.col("name").alias("template"), "license", "whole")), "template"
    ).where(F.col("score") >= F.when(F.col("whole"), LEAST_TEXT).otherwise(LEAST))
    paths = counts.select("path", "name").distinct()
    return written(
        paths.join(best, "name").groupBy("path").agg(
            F.max(F.struct("score", (-F.col("template")).alias("order"), "license")).alias("top"))
        .select("path", "top.license", "top.score"),
        "licences",
    )


def parents(path: str) -> Column:
    """Every directory above a path, the root as an empty text."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1),
                       lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def license_scan(files: DataFrame) -> DataFrame:
    """One row per file: path, license, score, origin (own, inherited or none) and directory (of the licence file
    inherited from).

    Rows with the same path share a licence, the best found.  A NULL text states nothing but may inherit; a
    NULL path neither holds nor inherits one.  Ties go to the earlier template, then nothing depends on the
    order of rows.  An empty table gives no rows; other columns are ignored.
    """
    files = files.select("path", "text")
    own = own_licenses(files)
    above = own.where(F.col("path").rlike(LICENCE_FILE)).select(
        F.element_at(parents("path"), -1).alias("directory"),
        F.struct("score", F.col("license").alias("license")).alias("held"),
    ).groupBy("directory").agg(F.max("held").alias("held"))
    above = written(above, "held")
    paths = files.select("path").distinct()
    orphans = written(paths.join(own, "path", "left_anti").where(F.col("path").isNotNull()), "orphans")
    climbs = orphans.select("path", F.posexplode(parents("path")).alias("depth", "directory"))
    inherited = climbs.join(above, "directory").groupBy("path").agg(
        F.max(F.struct("depth", "directory", "held")).alias("near")
    ).select("path", "near.held.license", "near.held.score", F.lit("inherited").alias("origin"),
             "near.directory")
    known = written(
        own.select("path", "license", "score", F.lit("own").alias("origin"),
                   F.lit(None).cast("string").alias("directory")).unionByName(inherited),
        "known",
    )
    return files.select("path").join(known, "path", "left").select(
        "path", "license", "score", F.coalesce("origin", F.lit("none")).alias("origin"), "directory")
