"""Licence scan (native): TF-IDF cosine to templates, inherited along paths.

Units of a text are its lines that hold a licence term, its blocks (runs of lines
between blank ones, without comment marks) that hold one, and the whole text of a
licence file.  Whole texts are read.  Each distinct unit is compared with the licence
templates (short notices, SPDX lines, standard headers, licence texts and titles):
sparse TF-IDF vectors, document frequencies counted over the units of all documents,
cosine by joining on tokens.  A file with a unit above ``threshold`` has that licence.
A licence file covers its directory; a file without a licence of its own inherits
from its nearest ancestor directory that a licence file covers, by joining the
prefixes of its path.

Defined results: null and empty texts have no unit and may inherit; rows of one path
are one file (its best unit counts for all of them), null paths too, which have no
ancestors; of several licence files in a directory the best match counts, then the
first path; equal cosines go to the first licence; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, n_words, small

# Notices by which the licences are declared, their standard headers, the
# licence texts that are short and the titles of those that are long.
TEMPLATES = {
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license. Redistribution and use in source and binary forms are permitted.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Released to the public domain under CC0 1.0 Universal."],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL-3.0": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ],
    "MIT": [
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        'MIT License Copyright (c) Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Mozilla Public License Version 2.0",
    ],
    "Proprietary": ["Copyright. All rights reserved."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
}
# Forms of an SPDX identifier.
SPDX_FORMS = ["", "-only", "-or-later"]
TERMS = r"(?i)licen[cs]e|copyright|all rights reserved|public domain|creative commons|spdx"
BROADCAST_ROWS = 200_000


def _tokens(line: Column) -> Column:
    """Lower-case words; dots, plus signs and hyphens inside a word are part of it."""
    return F.filter(F.split(F.lower(line), r"[^\p{L}\p{N}.+-]+|[.+-]+(?=[^\p{L}\p{N}]|$)"), lambda t: t != "")


def _templates(spark) -> DataFrame:
    """(licence, template): SPDX lines are one template per form of the identifier."""
    rows = [(k, t) for k, texts in sorted(TEMPLATES.items()) for t in texts]
    rows += [(k, f"SPDX-License-Identifier: {k}{form}") for k in sorted(TEMPLATES) for form in SPDX_FORMS if k != "Proprietary"]
    return spark.createDataFrame(rows, "licence string, template string")


def units(files: DataFrame) -> DataFrame:
    """(path, unit, line) of every unit of ``files`` (path, text, is_file); ``unit`` is
    the digest of ``line``, the unit's text."""
    has_term = lambda c: F.rlike(c, F.lit(TERMS))
    bare = F.regexp_replace("text", r"(?m)^[ \t\r/*#;%<!-]+|[ \t\r*]+$", "")
    found = files.where(has_term(F.col("text"))).withColumn("bare", bare)
    lines, blocks = F.filter(F.split("bare", "\n"), has_term), F.filter(F.split("bare", r"\n\n+"), has_term)
    whole = F.when(F.coalesce("is_file", F.lit(False)), F.array("bare")).otherwise(F.array())
    found = found.select("path", F.explode(F.array_distinct(F.concat(lines, blocks, whole))).alias("line"))
    return found.select("path", F.unhex(F.sha2("line", 256)).alias("unit"), "line")


def matched(found: DataFrame, threshold: float) -> DataFrame:
    """(unit, licence, cosine) of the distinct units above the threshold."""
    counted = cut(found.groupBy("unit").agg(F.count("*").alias("n"), F.first("line").alias("line")))
    tokens = counted.select("unit", "n", F.explode(_tokens(F.col("line"))).alias("token"))
    terms = cut(tokens.groupBy("unit", "n", "token").agg(F.count("*").alias("tf")))
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all")).first()["all"]
    df = terms.groupBy("token").agg(F.sum("n").alias("df"))
    idf = lambda d: F.log(F.lit(1.0 + total) / (F.lit(1.0) + F.coalesce(d, F.lit(0)))) + 1.0
    weights = terms.join(df, "token").select("unit", "token", (F.col("tf") * idf(F.col("df"))).alias("w"))
    t = _templates(found.sparkSession).select("licence", "template", F.explode(_tokens(F.col("template"))).alias("token"))
    t = t.groupBy("licence", "template", "token").agg(F.count("*").alias("tf"))
    t = t.join(df, "token", "left").select("licence", "template", "token", (F.col("tf") * idf(F.col("df"))).alias("tw"))
    t = t.withColumn("t_norm", F.sqrt(F.sum(F.col("tw") * F.col("tw")).over(Window.partitionBy("licence", "template"))))
    # one row: the templates that hold each token, at most as many as the texts above have words
    t = t.groupBy("token").agg(F.collect_list(F.struct(F.xxhash64("licence", "template").alias("no"), "licence", "tw", "t_norm")).alias("held"))
    t = F.broadcast(cut(t))
    joined = weights.join(t, "token", "left")
    # a unit's length counts all of its tokens, the products only those of templates
    norms = joined.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = joined.where("held is not null").select("unit", "w", F.explode("held").alias("h")).groupBy("unit", "h.no").agg(
        F.first("h.licence").alias("licence"), F.sum(F.col("w") * F.col("h.tw")).alias("dot"), F.first("h.t_norm").alias("t_norm"))
    scored = dots.join(norms, "unit").select("unit", "licence", F.round(F.col("dot") / (F.col("norm") * F.col("t_norm")), 6).alias("cosine"))
    return scored.where(F.col("cosine") >= threshold).groupBy("unit").agg(
        F.max("cosine").alias("cosine"), F.min_by("licence", F.struct(-F.col("cosine"), F.col("licence"))).alias("licence"))


def licences(files: DataFrame, is_licence_file: Column, threshold: float = 0.6) -> DataFrame:
    """(path, licence, cosine, how, from_dir) of every distinct path; ``files``
    has path and text; ``how`` is own, inherited or none."""
    marked = files.select("path", "text", is_licence_file.alias("is_file"))
    found = cut(units(marked))
    best = small(cut(matched(found, threshold)), BROADCAST_ROWS)
    own = found.select("path", "unit").join(best, "unit").groupBy("path").agg(
        F.max("cosine").alias("cosine"), F.min_by("licence", F.struct(-F.col("cosine"), F.col("licence"))).alias("licence"))
    own = cut(own.withColumnRenamed("path", "own_path"))
    names = cut(marked.groupBy("path").agg(F.coalesce(F.bool_or("is_file"), F.lit(False)).alias("is_file")))
    all_ = names.join(own, F.col("path").eqNullSafe(F.col("own_path")), "left").drop("own_path")
    parent = F.regexp_replace("path", "/[^/]*$", "")
    covers = all_.where("is_file and licence is not null").withColumn("dir", parent)
    pick = F.row_number().over(Window.partitionBy("dir").orderBy(F.desc("cosine"), "path"))
    covers = covers.withColumn("r", pick).where("r = 1").select("dir", F.col("licence").alias("dir_licence"), F.col("cosine").alias("dir_cosine"))
    covers = small(cut(covers), BROADCAST_ROWS)

    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda d: F.array_join(F.slice(parts, F.lit(1), d), "/"))
    bare = all_.where("licence is null and path like '%/%'").select("path", F.explode_outer(above).alias("dir"))
    near = bare.join(covers, "dir").groupBy("path").agg(F.max_by(F.struct("dir", "dir_licence", "dir_cosine"), F.length("dir")).alias("up"))
    out = all_.join(near, "path", "left")  # null paths have no ancestors
    how = F.when(F.col("licence").isNotNull(), "own").when(F.col("up").isNotNull(), "inherited").otherwise("none")
    return out.select("path", F.coalesce("licence", "up.dir_licence").alias("licence"), F.coalesce("cosine", "up.dir_cosine").alias("cosine"),
                      how.alias("how"), F.col("up.dir").alias("from_dir"))


def document_paths(docs: DataFrame) -> DataFrame:
    """Adds ``path`` to documents, which have none: source / language / hundred of
    ids / id.  Short texts with a notice stand for licence files."""
    level = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("_"))
    path = F.concat_ws("/", level("source"), level("lang"), F.coalesce((F.floor(F.col("doc_id") / 100)).cast("string"), F.lit("_")), level("doc_id"))
    return docs.withColumn("path", path)


def short(text: Column, words: int = 200) -> Column:
    return n_words(text) < words
