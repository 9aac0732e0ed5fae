"""License notices found by MinHash bands over overlapping windows, verified by exact containment.

Windows are as long as a template and overlap in all but one word. Windows that share less than half a
template's shingles with all templates are left out beforehand; a window that contains four fifths of a
template shares more. MinHash signatures of the others are cut into bands, and a window meets the templates
of its size that share a band. A window that holds four fifths of a template's shingles has a Jaccard
similarity of two thirds at least; two such sets share one of 16 bands of two with a probability of 0.9999.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shingles import DOC, item_windows, joined, sized_items, sized_shingles, small, with_words
from tidemark.llm.tables import renamed, settled

BANDS = 16
ROWS = 2

# The wording of common notices.
TEMPLATES = (
    ("all-rights-reserved", "All rights reserved"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0-header",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "apache-2.0-warranty",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is"
        " distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See"
        " the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
    ),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation",
    ),
    ("mit", "Released under the MIT License"),
    (
        "mit-permission",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
)


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "license_id string, text string")


def license_matches(
    documents: DataFrame, licenses: DataFrame, shingle: int = 5, containment: float = 0.8
) -> DataFrame:
    """One row per document and license whose template one of its windows contains.

    ``licenses`` has the columns license_id and text. Columns: doc_id, text_key (a hash of the text), license_id,
    start_word and window_words of the best window (the first of equal ones) and containment, the share of the
    template's distinct shingles in it, at least the parameter. A template of fewer words than a shingle is one
    shingle; templates and documents without words match nothing. NULL texts have no words, NULL ids are kept,
    rows that repeat an id and a text count once.
    """
    if containment < 0.5:
        raise ValueError("windows are chosen for a containment of at least 0.5")
    texts = with_words(documents)
    items = sized_items(renamed(licenses, {"license_id": "item_id", "text": "text"}), shingle)
    items = settled(items, "templates")
    sizes = sorted(row["k"] for row in items.select("k").distinct().collect()) or [shingle]
    known = reduce(DataFrame.union, [sized_shingles(items, k, "item_id", "n", "k") for k in sizes])
    known = settled(known, "template-shingles")
    windows = settled(reduce(DataFrame.union, [item_windows(texts, known, k) for k in sizes]), "windows")
    window = (*DOC, "n", "start")
    shingles = settled(reduce(DataFrame.union, [sized_shingles(windows, k, *window) for k in sizes]), "shingles")
    found = joined(_bands(shingles, *window), small(_bands(known, "item_id", "n")), "n", "band", "key")
    candidates = found.select(*window, "item_id").distinct()
    totals = known.groupBy("item_id").agg(F.count_distinct("shingle").alias("total"))
    wanted = known.select("item_id", "shingle").distinct().join(totals, "item_id")
    shared = (
        joined(shingles.drop("pos").distinct(), candidates, *window)
        .join(small(settled(wanted, "wanted")), ["item_id", "shingle"])
        .groupBy(*window, "item_id")
        .agg((F.count(F.lit(1)) / F.first("total")).alias("containment"))
        .where(F.col("containment") >= containment)
    )
    best = F.max_by(F.struct("start", "n", "containment"), F.struct("containment", -F.col("start"))).alias("best")
    return shared.groupBy(*DOC, "item_id").agg(best).select(
        *DOC,
        F.col("item_id").alias("license_id"),
        F.col("best.start").alias("start_word"),
        F.col("best.n").alias("window_words"),
        "best.containment",
    )


def _bands(shingles: DataFrame, *keys: str) -> DataFrame:
    """The bands of the MinHash signature of each group of shingles."""
    least = [F.min(F.xxhash64("shingle", F.lit(n))).alias(f"m{n}") for n in range(BANDS * ROWS)]
    bands = [
        F.struct(F.lit(n).alias("band"), F.xxhash64(*[f"m{n * ROWS + row}" for row in range(ROWS)]).alias("key"))
        for n in range(BANDS)
    ]
    return shingles.groupBy(*keys).agg(*least).select(*keys, F.inline(F.array(*bands)))
