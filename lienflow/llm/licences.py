"""Licence scan: TF-IDF cosine of licence notices to templates, then inheritance from the nearest directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lienflow.llm.common import stored


#: Least cosine to a template.
LEAST_COSINE = 0.6

#: Lines with one of these words make up a document's notice.
NOTICE = r"licen[sc]e|copyright|spdx|permission is hereby granted|without warranty|redistribution and use|all rights reserved"

# Usual short notices of public licences.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Licensed under the MIT License.",
        "Released under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "GPL-3.0": [
        "Licensed under the GNU General Public License v3.0.",
        "Licensed under the GPL-3.0.",
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."],
    "CC0-1.0": ["CC0 1.0 Universal Public Domain Dedication, no copyright.", "SPDX-License-Identifier: CC0-1.0"],
    "Proprietary": ["All rights reserved.", "Copyright. All rights reserved.", "Proprietary and confidential, all rights reserved."],
}

_TERMS = "regexp_extract_all(lower({0}), '[a-z0-9]+(?:[.-][a-z0-9]+)*', 0)"


def notice(text: str) -> str:
    """SQL: the lines of the text that speak of a licence, null where there are none."""
    lines = f"filter(split({text}, '\\\\n'), l -> l rlike '(?i){NOTICE}')"
    return f"if({text} rlike '(?i){NOTICE}', nullif(trim(array_join({lines}, ' ')), ''), null)"


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(licence, i, text) for licence, texts in TEMPLATES.items() for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "licence string, variant int, text string")


def score_notices(notices: DataFrame) -> DataFrame:
    """notice, licence, cosine: the nearest template of each different notice; ``notices`` has the column notice.

    Terms weigh their count times ln((1 + N) / (1 + df)) + 1, over the N templates, so a score does not depend on the
    other documents.  Of equally near templates the first name counts.  The templates are a table of this module, so
    their terms can be broadcast.
    """
    spark = notices.sparkSession
    model = (
        _templates(spark)
        .select("licence", "variant", F.explode(F.expr(_TERMS.format("text"))).alias("term"))
        .groupBy("licence", "variant", "term")
        .agg(F.count("*").alias("tf"))
    )
    frequency = model.groupBy("term").agg(F.count("*").alias("df"))
    documents = sum(map(len, TEMPLATES.values()))
    idf = f"tf * (ln((1 + {documents}) / (1 + coalesce(df, 0))) + 1) AS weight"

    terms = notices.select("notice", F.explode(F.expr(_TERMS.format("notice"))).alias("term"))
    counted = terms.groupBy("notice", "term").agg(F.count("*").alias("tf"))
    weighed = counted.join(F.broadcast(frequency), "term", "left").selectExpr("notice", "term", idf)
    norms = weighed.groupBy("notice").agg(F.sqrt(F.sum(F.expr("weight * weight"))).alias("norm"))

    model = model.join(F.broadcast(frequency), "term").selectExpr("licence", "variant", "term", idf)
    lengths = model.groupBy("licence", "variant").agg(F.sqrt(F.sum(F.expr("weight * weight"))).alias("length"))
    model = model.join(F.broadcast(lengths), ["licence", "variant"]).selectExpr(
        "licence", "variant", "term", "weight / length AS part"
    )
    dots = (
        weighed.join(F.broadcast(model), "term")
        .groupBy("notice", "licence", "variant")
        .agg(F.sum(F.expr("weight * part")).alias("dot"))
    )
    best = dots.join(norms, "notice").selectExpr("notice", "licence", "round(dot / norm, 6) AS cosine")
    return best.groupBy("notice").agg(
        F.min(F.struct((-F.col("cosine")).alias("order"), "licence")).alias("b")
    ).selectExpr("notice", "b.licence AS licence", "-b.order AS cosine")


def scan_licences(
    documents: DataFrame, path: str, licence_file: str, least_cosine: float = LEAST_COSINE
) -> DataFrame:
    """doc_id, path, licence, cosine, origin of each row.

    ``path`` is SQL for a document's path, ``licence_file`` SQL over the column ``path`` that tells licence files.
    A document's own notice decides (origin "own"); else the licence file of the nearest directory above it, its
    own directory first (origin "inherited"); else there is none (origin "none").  Of several licence files in a
    directory the nearest to its template counts, then the first path.  Null and empty texts have no notice, null
    paths no directory.  Different notices are scored once, and directories rather than documents walk up the paths.
    """
    rows = documents.select("doc_id", F.expr(path).alias("path"), F.expr(notice("text")).alias("notice")).withColumn(
        # A file at the top of the tree lies in the directory '', which is above all others.
        "directory",
        F.expr("CASE WHEN path LIKE '%/%' THEN regexp_extract(path, '^(.*)/[^/]*$', 1) WHEN path <> '' THEN '' END"),
    )
    rows = stored(rows, "notices")
    notices = rows.filter("notice IS NOT NULL").select("notice").distinct()
    scored = stored(score_notices(stored(notices, "different")).filter(F.col("cosine") >= least_cosine), "scored")
    # Rows without a notice, nearly all, are spread by a key that no notice has.  What is joined with them is stored:
    # the runtime splits a hot key only where both sides of a join come straight from a shuffle.
    spread = F.coalesce("notice", F.concat(F.lit("none:"), F.xxhash64("doc_id", "path").cast("string")))
    own = rows.withColumn("notice", spread).join(scored, "notice", "left")
    files = (
        own.filter(f"licence IS NOT NULL AND directory IS NOT NULL AND ({licence_file})")
        .groupBy("directory")
        .agg(F.min(F.struct((-F.col("cosine")).alias("order"), "path", "licence")).alias("f"))
        .selectExpr("directory AS ancestor", "f.licence AS inherited")
    )
    parts = "split(directory, '/')"
    above = f"transform(sequence(0, size({parts})), i -> struct(i AS depth, array_join(slice({parts}, 1, i), '/') AS ancestor))"
    nearest = (
        rows.filter("directory IS NOT NULL")
        .select("directory")
        .distinct()
        .selectExpr("directory", f"inline({above})")
        .join(files, "ancestor")
        .groupBy("directory")
        .agg(F.max(F.struct("depth", "inherited")).alias("a"))
        .selectExpr("directory", "a.inherited AS inherited")
    )
    return own.join(stored(nearest, "nearest"), "directory", "left").selectExpr(
        "doc_id",
        "path",
        "coalesce(licence, inherited) AS licence",
        "cosine",
        "CASE WHEN licence IS NOT NULL THEN 'own' WHEN inherited IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin",
    )
