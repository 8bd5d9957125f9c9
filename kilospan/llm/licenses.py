"""Licence notices by a trained paragraph classifier, in DataFrame operations only.

A paragraph (line) becomes the hashed counts of its words and word pairs. A multinomial
logistic regression with an L1 penalty, so most weights are zero, is fitted on the notices
below and on lines of the corpus without any licence word (up to MAX_NEGATIVES, the first
in hash order). It tells the family and the class ``none``.

Two checks follow. The unknown class is calibrated: a probability below what nearly all
training notices reach is not trusted with a family. And the words of the paragraph are
compared with the notices of the predicted family. A paragraph that looks like a licence
but fails a check is ``unknown``; one that shares hardly a word with the notices is none.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilospan.llm.common import kept

FEATURES = 1 << 14
MAX_NEGATIVES = 2000
CONFIRMED = 0.5
RELATED = 0.2
NONE, UNKNOWN = "none", "unknown"

# Families and the wording of their usual notices.
NOTICES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "This project is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "Distributed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GNU GPL version 2 or later.",
        "Released under the GPLv3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "Released under the LGPL.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Licensed under the 3-clause BSD license.",
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Released under the Creative Commons BY-NC license; no commercial use.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This is an open access article distributed under the terms of the Creative Commons Attribution License.",
    ],
    "public-domain": [
        "This work has been dedicated to the public domain under CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain.",
        "No rights reserved. CC0.",
    ],
    "proprietary": [
        "All rights reserved. No part of this publication may be reproduced or transmitted in any form without prior written permission.",
        "This software is proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
        "Copyright. All rights reserved.",
    ],
}
# Sentences that use the same words but are no notices.
OTHERS = [
    "The city council granted a driving license to every new member of the public.",
    "He holds a general licence and works for a software company under contract.",
    "Version 2.0 of the report will be released under a new name.",
    "The terms of the agreement were published in the public record.",
    "She was awarded the commons prize for attribution of early works.",
    "The foundation will distribute free copies of the book.",
    "Conditions for use of the library are displayed at the entrance.",
    "You can find the file in the source folder.",
]
CUES = r"(?i)licen[cs]e|copyright|spdx|rights reserved|warrant|creative commons|public domain|redistribut|permission"


def grams(text: Column) -> Column:
    """Lower-case words and pairs of neighbours."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*"), F.lit(0))
    pairs = F.transform(
        F.when(F.size(words) > 1, F.arrays_zip(
            F.slice(words, 1, F.size(words) - 1).alias("a"), F.slice(words, 2, F.size(words) - 1).alias("b")
        )),
        lambda p: F.concat_ws(" ", p["a"], p["b"]),
    )
    return F.concat(words, F.coalesce(pairs, F.array().cast("array<string>")))


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Lines with a letter or digit, numbered within their document."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.posexplode(F.split(F.col(text_col), "\n")).alias("paragraph", "text"),
    ).where(F.col("text").rlike("[A-Za-z0-9]"))


def training_rows(lines: DataFrame, max_negatives: int = MAX_NEGATIVES) -> DataFrame:
    """(family, text): the notices, and lines of the corpus without a cue as ``none``."""
    spark = lines.sparkSession
    fixed = [(f, t) for f, texts in NOTICES.items() for t in texts]
    fixed += [(NONE, t) for t in OTHERS]
    plain = (
        lines.where(~F.col("text").rlike(CUES))
        .select(F.lit(NONE).alias("family"), F.substring("text", 1, 2000).alias("text"))
        .orderBy(F.xxhash64("text"), "text")
        .limit(max_negatives)
    )
    return _literal_rows(spark, fixed, "family", "text").union(plain)


def _literal_rows(spark, rows: list[tuple[str, str]], *names: str) -> DataFrame:
    """A fixed table as literals of the plan."""
    cells = [F.struct(*[F.lit(x).alias(n) for x, n in zip(row, names)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*cells)))


class Classifier:
    def __init__(self, rows: DataFrame):
        self.families = [NONE, *sorted(NOTICES)]
        index = F.array_position(F.array(*[F.lit(f) for f in self.families]), F.col("family")) - 1
        even = F.when(F.col("family") == NONE, F.lit(1.0)).otherwise(F.lit(20.0))
        table = rows.select(
            "family", index.cast("double").alias("label"), even.alias("weight"), grams(F.col("text")).alias("grams")
        )
        self.hash = HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)
        train = self.hash.transform(kept(table, "notices").coalesce(2))
        fit = LogisticRegression(
            family="multinomial", weightCol="weight", regParam=0.002, elasticNetParam=0.5, maxIter=40
        )
        self.model = fit.fit(train)
        # calibration: what all but a few training notices reach
        own = self.scored(train.select("family", "label", "features")).where(F.col("family") != NONE)
        share = F.element_at("p", (F.col("label") + 1).cast("int"))
        low = own.agg(F.percentile_approx(share, 0.02, 10000)).first()[0]
        self.least = max(0.3, min(0.9, 0.8 * (low or 0.0)))

    def scored(self, rows: DataFrame) -> DataFrame:
        out = self.model.transform(rows)
        return out.withColumn("p", vector_to_array("probability")).drop(
            "rawPrediction", "probability", "prediction", "features"
        )


def license_paragraphs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    max_negatives: int = MAX_NEGATIVES,
) -> DataFrame:
    """One row per licence paragraph: doc_id, paragraph (line number from 0), family,
    score (probability that it is a licence notice), similarity (share of its words and
    pairs that notices of the family have), text.

    Null, empty and blank texts have no paragraphs. Repeated rows and null ids give rows
    like others. Without documents the result is empty.
    """
    lines = paragraphs(docs, id_col, text_col)
    known = Classifier(training_rows(lines, max_negatives))
    spark = docs.sparkSession
    notices = [(f, t) for f, texts in NOTICES.items() for t in texts]
    wording = _literal_rows(spark, notices, "known", "notice").groupBy("known").agg(
        F.array_distinct(F.flatten(F.collect_list(grams(F.col("notice"))))).alias("wording")
    )
    rows = known.hash.transform(
        lines.select("doc_id", "paragraph", "text", grams(F.col("text")).alias("grams"))
    )
    scored = known.scored(rows).withColumn("score", 1 - F.element_at("p", 1))
    scored = scored.where(F.col("score") >= known.least)
    families = F.array(*[F.lit(f) for f in known.families[1:]])
    shares = F.slice("p", 2, len(known.families) - 1)
    scored = scored.withColumn("likely", F.array_max(shares)).withColumn(
        "family", F.element_at(families, F.array_position(shares, F.col("likely")).cast("int"))
    )
    # one short row per family: a fixed table, so it is broadcast
    met = scored.join(F.broadcast(wording), F.col("family") == F.col("known"))
    alike = F.size(F.array_intersect("grams", "wording")) / F.size(F.array_distinct("grams"))
    sure = (F.col("likely") >= known.least) & (F.col("similarity") >= CONFIRMED)
    return met.withColumn("similarity", alike).where(F.col("similarity") >= RELATED).select(
        "doc_id", "paragraph",
        F.when(sure, F.col("family")).otherwise(UNKNOWN).alias("family"),
        "score", "similarity", "text",
    )
