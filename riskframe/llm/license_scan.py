"""License scan: MinHash bands over overlapping text windows, then exact containment.

Templates (texts or notices of licenses) and documents become words (runs of letters
and digits, lower-cased) and ``SHINGLE``-word shingles.  A template belongs to the
window class with the greatest length ``L`` for which it has at least ``L + stride - 1``
words.  Template windows of ``L`` words start at every word, document windows at every
``stride``-th, so wherever a document holds ``L + stride - 1`` unbroken words of a
template, one of its windows equals a template window and all bands collide; other
windows collide in one of ``BANDS`` bands of one MinHash row with probability
1 - (1 - J)^BANDS.  At a containment of 0.8 spread evenly over a template, unbroken
stretches of that length remain, so retrieval is certain there.

Retrieved places are verified: the share of the template's distinct shingles that
occur in the document around the place (the template's length and a fifth more on
either side) must reach ``containment``.

Only DataFrame functions run.  Templates are a parameter; their band rows are broadcast
only when counted at ``BROADCAST_BANDS`` or fewer, else the join shuffles.

Defined results: null and empty texts match nothing; templates shorter than
``SHINGLE`` words are refused; repeated rows with one id are reported once; a null id
is reported like any other; extra columns are not read.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm._common import cut, file_backed, hold, located, pick, table

SHINGLE, CONTAINMENT, BANDS = 5, 0.8, 4
#: (window length in words, stride)
CLASSES = ((5, 1), (8, 2), (16, 4))
BROADCAST_BANDS = 200_000
#: Documents with a shingle of a template (about 100 bytes each), and retrieved places (16 bytes), up to which they
#: are broadcast to the text scan.
BROADCAST_DOCS, BROADCAST_PLACES = 50_000, 400_000

# Public license notices.
TEMPLATES = {
    "mit-line": "Released under the MIT License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
           "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
           "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
           "this permission notice shall be included in all copies or substantial portions of the Software.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
           "provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
           "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
           "conditions and the following disclaimer.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                  "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
           "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
               "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
            "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "agpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "bsd-3-clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                    "derived from this software without specific prior written permission.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
                 "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
                 "commercial or non-commercial, and by any means.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
            "any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
            "including commercial applications, and to alter it and redistribute it freely.",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4.0-long-line": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
}


def bodies() -> dict[str, str]:
    """The whole texts of public licenses, by file name in the folder beside this module."""
    folder = Path(__file__).parent / "licenses"
    return {f"{p.stem.lower()}-text": p.read_text(encoding="utf-8") for p in sorted(folder.glob("*.txt"))}


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _shingle_hashes(words: str) -> Column:
    return F.when(F.size(words) >= SHINGLE, F.transform(
        F.sequence(F.lit(0), F.size(words) - SHINGLE), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE)])))


def _window_bands(starts: Column, length: int, b: int, wide: int) -> Column:
    """Bands of the windows at ``starts``.  The permuted hashes are bound once, by a
    lambda over a one-element array; as a column they would be evaluated per window."""
    permuted = F.transform("h", lambda x: F.xxhash64(x, F.lit(b)))
    return F.get(F.transform(F.array(permuted), lambda p: F.transform(starts, lambda i: F.struct(
        i.alias("pos"), F.xxhash64(F.array_min(F.slice(p, i + 1, wide)), F.lit(length * 1000 + b)).alias("band")))), 0)


def _bands(rows: DataFrame, key: list[str], classes, stride_one: bool) -> DataFrame:
    """(key..., bands array<struct<pos, band>>): ``band`` hashes class, band number and the
    window's least permuted shingle.  ``rows`` has ``h``, the shingle hashes."""
    parts = []
    for length, stride in classes:
        step, wide = (1 if stride_one else stride), length - SHINGLE + 1
        if wide == 1:  # one shingle: its hash is the least under any permutation
            parts.append(F.transform("h", lambda x, i: F.struct(i.alias("pos"), F.xxhash64(x, F.lit(SHINGLE)).alias("band"))))
            continue
        starts = F.sequence(F.lit(0), F.greatest(F.size("h") - wide, F.lit(0)), F.lit(step))
        for b in range(BANDS):
            parts.append(_window_bands(starts, length, b, wide))
    return hold(rows.select(*key, "h"), "bands", F.concat(*parts)).select(*key, "bands")


def band_templates(spark: SparkSession, templates: dict[str, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(license, number, n_words, shingles), (number, o, band) and (h), the shingle hashes, of the templates."""
    pairs = F.array(*[F.struct(F.lit(k).alias("license"), F.lit(i).alias("number"), F.lit(v).alias("text")) for i, (k, v) in enumerate(sorted(templates.items()))])
    t = spark.range(1).select(F.explode(pairs).alias("t")).select("t.license", "t.number", _words(F.col("t.text")).alias("words"))
    t = cut(t.withColumn("h", _shingle_hashes("words")).withColumn("n_words", F.size("words")))
    short = [r[0] for r in t.filter(F.col("n_words") < SHINGLE).select("license").collect()]
    if short:
        raise ValueError(f"templates shorter than {SHINGLE} words: {short}")
    bands = None
    for k, (length, stride) in enumerate(CLASSES):
        least, most = length + stride - 1, CLASSES[k + 1][0] + CLASSES[k + 1][1] - 1 if k + 1 < len(CLASSES) else 1 << 30
        own = t.filter((F.col("n_words") >= least) & (F.col("n_words") < most))
        part = _bands(own, ["number"], [(length, stride)], stride_one=True).select("number", F.explode("bands").alias("b"))
        part = part.select("number", F.col("b.pos").alias("o"), "b.band")
        bands = part if bands is None else bands.unionByName(part)
    return t.select("license", "number", "n_words", _shingles(F.col("words")).alias("shingles")), cut(bands.distinct()), t.select("h")


def _shingles(words: Column) -> Column:
    """The distinct shingles themselves."""
    return F.when(F.size(words) >= SHINGLE, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size(words) - SHINGLE + 1), lambda i: F.array_join(F.slice(words, i, SHINGLE), " ")))
    ).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(id, license, containment, first_word): the verified matches, a row per id and
    license; ``first_word`` is the first verified place (in words of the document)."""
    spark = docs.sparkSession
    shapes, bands, hashed_templates = band_templates(spark, templates or TEMPLATES)
    rows = located(file_backed(pick(docs, id_col, text_col))).select(id_col, F.col(text_col).alias("text"), "_path", "_row")
    hashed = lambda df: hold(hold(df.select("_path", "_row", "text"), "words", _words(F.col("text"))).select("_path", "_row", "words")
                             .filter(F.size("words") >= SHINGLE), "h", _shingle_hashes("words")).select("_path", "_row", "h")
    # a band collides where both windows have the same least shingle: documents without any shingle of a template have no place
    known = cut(hashed_templates.select(F.explode("h").alias("x")).distinct())
    few_known = known.count() <= BROADCAST_BANDS
    share = hashed(rows).select("_path", "_row", F.explode("h").alias("x")).join(F.broadcast(known) if few_known else known, "x", "left_semi")
    share = cut(share.select("_path", "_row").distinct())
    near = rows.join(F.broadcast(share) if share.count() <= BROADCAST_DOCS else share, ["_path", "_row"], "left_semi")
    n_bands = bands.count()
    windows = _bands(hashed(near), ["_path", "_row"], CLASSES, stride_one=False)
    windows = windows.select("_path", "_row", F.explode("bands").alias("b")).select("_path", "_row", "b.pos", "b.band")
    right = F.broadcast(bands) if n_bands <= BROADCAST_BANDS else bands
    places = (windows.join(right, "band").select("_path", "_row", "number", (F.col("pos") - F.col("o")).alias("at")).distinct()
              .groupBy("_path", "_row").agg(F.collect_list(F.struct("number", "at")).alias("places")))
    places = cut(places)  # no more entries a row than the document has windows
    few = (places.agg(F.sum(F.size("places"))).first()[0] or 0) <= BROADCAST_PLACES
    found = rows.join(F.broadcast(places) if few else places, ["_path", "_row"])
    each = hold(found.select(id_col, "text", "places"), "words", _words(F.col("text"))).select(id_col, "words", F.explode("places").alias("p"))
    small = shapes.agg(F.sum(F.size("shingles"))).first()[0] <= BROADCAST_BANDS
    each = each.join(F.broadcast(shapes) if small else shapes, F.col("p.number") == F.col("number"))
    more = F.floor(F.col("n_words") / 5).cast("int") + 1
    begin = F.greatest(F.col("p.at") - more, F.lit(0))
    end = F.least(F.col("p.at") + F.col("n_words") + more, F.size("words"))
    each = hold(each, "around", F.slice("words", begin + 1, F.greatest(end - begin, F.lit(0))))
    around = F.col("around")
    each = each.select(id_col, "license", F.greatest(F.col("p.at"), F.lit(0)).alias("at"),
                       (F.size(F.array_intersect("shingles", _shingles(around))) / F.size("shingles")).alias("share"))
    return (each.filter(F.col("share") >= containment).groupBy(id_col, "license")
            .agg(F.max("share").alias("containment"), F.min("at").cast("long").alias("first_word")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), TEMPLATES | bodies())
