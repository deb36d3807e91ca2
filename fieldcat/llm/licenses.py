"""License scans, in DataFrame functions only: MinHash bands over overlapping text windows
retrieve templates, exact shingle containment verifies them.

Words are runs of letters and digits, lower-cased; a shingle is ``WIDTH`` words. Templates
fall into classes by length: the next power of two, L. For each class a text is cut into
windows of 2 L words, each overlapping the next by half, so every passage as long as a
template lies whole in some window. Only shingles that a template of the class holds can be
shared; they make a window's set. The MinHash of that set is compared with the templates' in
``BANDS`` bands of one row. A template of the class has more than L / 2 words and a window
2 L, so a window with the share ``CONTAINED`` of a template's shingles has Jaccard similarity
s of 0.15 or more with it, and retrieval fails with (1 - s) ** BANDS: below 4e-7 at 90 bands
(at s = 0.5, 1e-27). A retrieved template matches if the window holds at least the share of
its shingles, counted exactly.

Defined results: null and empty texts match nothing. Rows given twice match twice. A template
that several windows hold is reported once per row, with its largest share and first window.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 3
BANDS = 90
CONTAINED = 0.8

#: Notices by license (fixed values).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
}


def words(text: Column) -> Column:
    """Words of a text, none for null."""
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(of: str) -> Column:
    """Hashes of all shingles of the word hashes in column ``of``, in text order."""
    parts = ", ".join(["x", *[f"{of}[i + {k}]" for k in range(1, WIDTH)]])
    return F.expr(f"if(size({of}) < {WIDTH}, cast(array() as array<bigint>), "
                  f"transform(slice({of}, 1, size({of}) - {WIDTH - 1}), (x, i) -> xxhash64({parts})))")


def least(of: str) -> Column:
    """The MinHash of the set in column ``of``: a value for each band."""
    return F.expr(f"transform(sequence(0, {BANDS - 1}), k -> array_min(transform({of}, s -> xxhash64(k, s))))")


def template_table(spark, templates: Mapping[str, str]) -> tuple[DataFrame, list[int]]:
    """(template, length, held) with the class length, and all shingles of the templates; the
    templates are a parameter, so their number is the caller's bound."""
    rows = spark.createDataFrame(list(templates.items()), "template string, text string")
    rows = rows.withColumn("hash", F.transform(words(F.col("text")), lambda w: F.xxhash64(w))).select(
        "template", F.expr("shiftleft(1, cast(ceil(log2(size(hash))) as int))").alias("length"), F.array_distinct(shingles("hash")).alias("held"))
    got = [tuple(r) for r in rows.where("size(held) > 0").collect()]
    return spark.createDataFrame(got, rows.schema), sorted({h for r in got for h in r[2]})


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, contained: float = CONTAINED) -> DataFrame:
    """(doc_id, template, containment, place) of every match; ``place`` is the first word of
    the first window with the largest containment."""
    table, vocabulary = template_table(docs.sparkSession, templates)
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("hash"))
    rows = rows.select("doc_id", "row", shingles("hash").alias("all"))
    # places of shingles that templates hold, each in the two windows of a class that cover it
    known = F.transform("all", lambda h, i: F.when(h.isin(vocabulary), F.struct(i.alias("i"), h.alias("h"))))
    rows = rows.select("doc_id", "row", F.explode(F.filter(known, lambda x: x.isNotNull())).alias("k")).select("doc_id", "row", "k.i", "k.h")
    classes = table.select("length", F.explode("held").alias("h")).distinct()
    rows = rows.join(F.broadcast(classes), "h").select("doc_id", "row", "h", "length", F.explode(F.expr(
        "if(i < length, array(0), array(i div length - 1, i div length))")).alias("at"))
    windows = rows.groupBy("doc_id", "row", "length", "at").agg(F.collect_set("h").alias("held"))
    bands = windows.withColumn("least", least("held")).select("doc_id", "row", "length", "at", "held", F.posexplode("least").alias("band", "value"))
    marks = table.withColumn("least", least("held")).select("template", "length", F.col("held").alias("whole"), F.posexplode("least").alias("band", "value"))
    got = bands.join(F.broadcast(marks), ["length", "band", "value"]).select(
        "doc_id", "row", "template", (F.col("at") * F.col("length")).alias("place"),
        (F.size(F.array_intersect("held", "whole")) / F.size("whole")).alias("containment"))
    best = got.where(F.col("containment") >= contained).groupBy("row", "doc_id", "template").agg(
        F.max(F.struct("containment", (-F.col("place")).alias("back"))).alias("best"))
    return best.select("doc_id", "template", F.col("best.containment").alias("containment"), (-F.col("best.back")).alias("place"))
