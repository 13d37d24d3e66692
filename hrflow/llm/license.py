"""Licences of files: TF-IDF cosine of headers and licence files to templates, inherited by folder.

A header is a run of lines of a text that speaks of a licence; a licence file is a text that has a
licence and consists mostly of such lines, is named like one, or is close as a whole to the whole
text of a licence. Word weights are counted over all texts; the headers of a text,
each by itself and all together, their sentences and overlapping windows of their words are
compared with every template by cosine over sparse TF-IDF vectors, and the text gets the best
one above the threshold. A file without a licence of its own takes that of the nearest folder above it that
holds a licence file: distinct folders are joined to their ancestors, the longest match wins.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import materialise

#: Identifiers and typical wording (fixed values).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0",
    "MIT": "Released under the MIT License. Permission is hereby granted, free of charge, to any person obtaining a copy of "
           "this software and associated documentation files, to deal in the software without restriction",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3. This program is free software: you can "
               "redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
               "Software Foundation, either version 3 of the License",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
               "Public License as published by the Free Software Foundation; version 2 of the License",
    "LGPL-3.0": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                "General Public License, version 3",
    "AGPL-3.0": "Licensed under the GNU Affero General Public License, version 3",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                    "that the following conditions are met: BSD 3-Clause License, neither the name of the copyright holder",
    "BSD-2-Clause": "BSD 2-Clause License. Redistributions of source code must retain the above copyright notice, this list "
                    "of conditions and the following disclaimer",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "ISC": "ISC License. Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee",
    "CC-BY-4.0": "Licensed under CC BY 4.0. This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0. Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0. Creative Commons Attribution-NonCommercial 4.0 International License",
    "CC0-1.0": "CC0 1.0 Universal public domain dedication, no rights reserved",
    "Unlicense": "This is free and unencumbered software released into the public domain",
}
#: Whole licence texts without title, holder and year (fixed values).
_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\""
_BSD_HEAD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
             "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
             "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
             "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
             "with the distribution. ")
_BSD_NAME = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
             "products derived from this software without specific prior written permission. ")
_BSD_TAIL = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
             "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
             "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
             "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
             "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
             "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
             "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
WHOLE_TEXTS = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
           "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
           "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
           "and this permission notice shall be included in all copies or substantial portions of the Software. "
           + _AS_IS + ", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
           "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
           "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
           "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
           "provided that the above copyright notice and this permission notice appear in all copies. " + _AS_IS + " AND THE "
           "AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
           "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
           "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
           "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause": _BSD_HEAD + _BSD_TAIL,
    "BSD-3-Clause": _BSD_HEAD + _BSD_NAME + _BSD_TAIL,
}
#: Least cosine of a whole text to a whole licence, and names of licence files.
WHOLE_COSINE = 0.8
NAME = r"(?i)(^|/)(un)?(licen[sc]es?|copying|notice)([._-][^/]*)?$"
#: A line that may belong to a licence header.
LINE = r"(?i)licen[sc]e|licensed|copyright|spdx|public domain|creative commons|redistribut|permission is hereby|all rights reserved|\bcc[ -]?(by|0)\b"
TERM = r"[a-z0-9]+"
#: Windows of longer headers (words, step), and the least cosine of a window: fixed wording without a name stays below.
WINDOWS = ((8, 2), (24, 8))
WINDOW_COSINE = 0.5


def _terms(text) -> F.Column:
    """Single terms and neighbouring pairs."""
    one = F.regexp_extract_all(F.lower(text), F.lit(TERM), 0)
    two = F.when(F.size(one) > 1, F.zip_with(F.slice(one, 1, F.greatest(F.size(one) - 1, F.lit(0))),
                                             F.slice(one, 2, F.greatest(F.size(one) - 1, F.lit(0))),
                                             lambda a, b: F.concat(a, F.lit(" "), b)))
    return F.concat(one, F.coalesce(two, F.array().cast("array<string>")))


def _pieces(headers: DataFrame) -> DataFrame:
    """``c, header``: all headers of a text, each of them, their sentences and their windows; ``c`` is ``h#kind#number``."""
    speaks = lambda x: F.rlike(x, F.lit(LINE))
    runs = F.split("header", r"\n\n")
    sentences = F.filter(F.flatten(F.transform(runs, lambda x: F.split(x, r"(?<=[.:;])\s+"))), speaks)

    def cut(run, n: int, step: int):
        words = F.split(F.trim(run), r"\s+")
        at = F.when(F.size(words) > n, F.sequence(F.lit(1), F.size(words), F.lit(step)))
        return F.coalesce(F.transform(at, lambda i: F.array_join(F.slice(words, i, n), " ")), F.array().cast("array<string>"))

    windows = F.filter(F.flatten(F.transform(runs, lambda x: F.concat(*[cut(x, *w) for w in WINDOWS]))), speaks)
    kinds = [("text", F.array_distinct(F.concat(F.array("header"), runs, sentences))), ("window", F.array_distinct(windows))]
    out = [headers.select("h", F.posexplode(pieces)).select(F.concat_ws("#", "h", F.lit(kind), "pos").alias("c"), F.col("col").alias("header"))
           for kind, pieces in kinds]
    return out[0].unionByName(out[1])


def _vector(headers: DataFrame, key: str, idf: DataFrame, unknown: float | None = None) -> DataFrame:
    """Unit TF-IDF rows ``(key, term, w)``; terms outside ``idf`` weigh ``unknown`` (None: they are left out)."""
    tf = headers.select(key, F.explode(_terms(F.col("header"))).alias("term")).groupBy(key, "term").count()
    w = tf.join(idf, "term", "inner" if unknown is None else "left")
    w = w.withColumn("w", (1 + F.log("count")) * F.coalesce("idf", F.lit(unknown)))
    norm = w.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return w.join(norm, key).select(key, "term", (F.col("w") / F.col("norm")).alias("w"))


def _whole(texts: DataFrame, idf: DataFrame, total: int, licences: dict[str, str]) -> DataFrame:
    """``t, whole, whole_cosine``: of distinct texts ``(t, header)`` those close to a whole licence text.

    Common words of the licences that hardly differ from one to the next weigh little, so weights of
    1 at least keep the length of the wording in the score.
    """
    weight = idf.select("term", F.greatest("idf", F.lit(1.0)).alias("idf"))
    known = texts.sparkSession.createDataFrame(sorted(licences.items()), "license string, header string")
    unknown = max(1.0, math.log(1.0 + total))
    theirs = materialise(_vector(known, "license", weight, unknown), "license-whole")  # fixed texts
    mine = _vector(texts, "t", weight, unknown)
    cosine = mine.alias("x").join(theirs.alias("y"), "term").groupBy("t", "license").agg(
        F.round(F.sum(F.col("x.w") * F.col("y.w")), 9).alias("cosine"))
    return (cosine.where(F.col("cosine") >= WHOLE_COSINE).groupBy("t")
            .agg(F.min(F.struct((-F.col("cosine")).alias("m"), "license")).alias("b"))
            .select("t", F.col("b.license").alias("whole"), (-F.col("b.m")).alias("whole_cosine")))


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", threshold: float = 0.35,
         templates: dict[str, str] | None = None, whole_texts: dict[str, str] | None = None) -> DataFrame:
    """``path, own_license, similarity, license, inherited_from`` per distinct path.

    Texts of one path are one file; NULL texts count as empty, rows with a NULL path are left out.
    Ties between templates go to the first identifier in order. A text that is as a whole close to one of
    ``WHOLE_TEXTS`` has that licence. A licence file is such a text, or one with a licence that is called LICENSE,
    COPYING or NOTICE or whose licence lines hold at least half of its non-blank characters; of several
    in one folder the smallest path counts. Every line of the whole text is looked at. Other columns are ignored.
    """
    spark = files.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    lines = F.transform(F.split(text, r"\r?\n"), lambda x: F.when(F.rlike(x, F.lit(LINE)), x).otherwise(""))
    header = F.trim(F.regexp_replace(F.array_join(lines, "\n"), r"\n{2,}", "\n\n"), F.lit("\n"))  # runs of lines
    rows = files.where(F.col(f"`{path_col}`").isNotNull()).select(
        F.col(f"`{path_col}`").cast("string").alias("path"), header.alias("header"),
        F.length(F.regexp_replace(text, r"\s+", "")).alias("chars"))
    text_rows = files.where(F.col(f"`{path_col}`").isNotNull()).where(header != "").select(
        F.col(f"`{path_col}`").cast("string").alias("path"), F.sha2(text, 256).alias("t"), text.alias("header"))
    rows = materialise(rows.groupBy("path").agg(
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("header") != "", F.col("header")))), "\n\n").alias("header"),
        F.sum("chars").alias("chars")), "license-files")
    # equal headers are scored once
    headers = rows.where("header != ''").groupBy("header").agg(F.count("*").alias("files")).withColumn(
        "h", F.sha2("header", 256))
    headers = materialise(headers, "license-headers")
    known = spark.createDataFrame(sorted((templates or TEMPLATES).items()), "license string, header string")
    known = known.withColumn("header", F.explode(F.split("header", r"(?<=[.:;]) +"))).withColumn(
        "part", F.concat_ws("#", "license", F.sha2("header", 256)))
    total = rows.count()
    df = (headers.select("files", F.explode(F.array_distinct(_terms(F.col("header")))).alias("term"))
          .groupBy("term").agg(F.sum("files").alias("df")))
    vocabulary = known.select(F.explode(_terms(F.col("header"))).alias("term")).distinct()
    idf = materialise(vocabulary.join(df, "term", "full").select(
        "term", F.log((1.0 + total) / (1 + F.coalesce("df", F.lit(0)))).alias("idf")).where("idf > 0"), "license-idf")
    mine = _vector(materialise(_pieces(headers), "license-pieces"), "c", idf)
    theirs = materialise(_vector(known, "part", idf), "license-templates")  # a few hundred rows of fixed text
    cosine = (mine.alias("x").join(theirs.alias("y"), "term").groupBy("c", "part")
              .agg(F.sum(F.col("x.w") * F.col("y.w")).alias("cosine")))
    least = F.when(F.substring_index(F.substring_index("c", "#", 2), "#", -1) == "window",
                   max(threshold, WINDOW_COSINE)).otherwise(threshold)
    cosine = cosine.where(F.round("cosine", 9) >= least).withColumn("h", F.substring_index("c", "#", 1))
    best = (cosine.withColumn("license", F.substring_index("part", "#", 1)).groupBy("h", "license")
            .agg(F.round(F.max("cosine"), 9).alias("cosine")).where(F.col("cosine") >= threshold)
            .groupBy("h").agg(F.min(F.struct((-F.col("cosine")).alias("m"), "license")).alias("b"))
            .select("h", F.col("b.license").alias("own_license"), (-F.col("b.m")).alias("similarity")))
    # whole texts with licence words: equal ones are scored once
    of_path = materialise(text_rows, "license-texts")
    whole = _whole(of_path.groupBy("t").agg(F.first("header").alias("header")), idf, total, whole_texts or WHOLE_TEXTS)
    whole = (of_path.select("path", "t").join(whole, "t").groupBy("path")
             .agg(F.min(F.struct((-F.col("whole_cosine")).alias("m"), "whole")).alias("b"))
             .select("path", F.col("b.whole").alias("whole"), (-F.col("b.m")).alias("whole_cosine")))
    whole = materialise(whole, "license-whole-found")
    own = rows.select("path", "chars", F.when(F.col("header") != "", F.sha2("header", 256)).alias("h"),
                      F.length(F.regexp_replace("header", r"\s+", "")).alias("licensed"))
    # files without a header take no part in the join: their NULL keys would meet in one task
    bare = own.where("h is null").drop("h").withColumns({"own_license": F.lit(None).cast("string"),
                                                         "similarity": F.lit(None).cast("double")})
    scored = own.where("h is not null").join(best, "h", "left").drop("h").join(whole, "path", "left")
    scored = (scored.withColumns({"own_license": F.coalesce("whole", "own_license"), "similarity": F.coalesce("whole_cosine", "similarity"),
                                  "whole": F.col("whole").isNotNull()}).drop("whole_cosine"))
    own = materialise(scored.unionByName(bare.withColumn("whole", F.lit(False))), "license-own")
    folder = F.regexp_replace("path", r"/?[^/]*$", "")
    is_licence = F.col("whole") | F.rlike("path", F.lit(NAME)) | F.expr("2 * licensed >= chars")
    holders = (own.where(F.col("own_license").isNotNull() & is_licence)
               .select(folder.alias("above"), "path", "own_license")
               .groupBy("above").agg(F.min(F.struct("path", "own_license")).alias("b"))
               .select("above", F.col("b.own_license").alias("found"), F.col("b.path").alias("found_at")))
    # each folder once, however many files it holds
    missing = own.where("own_license is null").withColumn("folder", folder)
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    near = (missing.select("folder").distinct().select("folder", F.explode(F.array_distinct(above)).alias("above"))
            .join(holders, "above").groupBy("folder")
            .agg(F.max(F.struct(F.length("above").alias("n"), "found", "found_at")).alias("b"))
            .select("folder", F.col("b.found").alias("license"), F.col("b.found_at").alias("inherited_from")))
    near = materialise(near, "license-folders")
    none = F.lit(None).cast("string")
    known = own.where("own_license is not null").withColumns({"license": F.col("own_license"), "inherited_from": none})
    names = ["path", "own_license", "similarity", "license", "inherited_from"]
    return known.select(*names).unionByName(missing.join(near, "folder", "left").select(*names))
