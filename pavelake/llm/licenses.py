"""Licence scan: lines and blocks of lines compared with licence templates by the Dice coefficient of word bigrams.

Two sets of bigrams can only reach the threshold if their sizes are close, so a unit is compared with the templates of
its size class alone, and units too short or too long for every template are never taken apart. All of it is
DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pavelake.llm.common import kept, small, text_or_empty

DICE = 0.8

# Notices by which works are put under a licence, as their authors or stewards word them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

# Names of licences that a file may state in a line of its own.
STATED = ("0BSD AGPL-3.0 Apache-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-SA-4.0 CC0-1.0 EPL-2.0 GPL-2.0 "
          "GPL-3.0 ISC LGPL-2.1 LGPL-3.0 MIT MPL-2.0 Unlicense Zlib").split()
TEMPLATES += tuple((name, f"SPDX-License-Identifier: {name}") for name in STATED)


def templates(spark: SparkSession) -> DataFrame:
    """(license_id, text) of the notices above. Any table of this form will do in its place."""
    return spark.createDataFrame(list(TEMPLATES), "license_id string, text string")


def _words(text: Column) -> Column:
    """Runs of letters and digits in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _bigrams(words: str) -> Column:
    """Distinct hashes of neighbouring words; one word makes one."""
    size = F.size(words)
    none = F.array().cast("array<int>")
    starts = F.when(size == 0, none).when(size == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), size - 2))
    return F.array_distinct(F.transform(starts, lambda i: F.xxhash64(F.get(F.col(words), i), F.get(F.col(words), i + 1))))


def _units(rows: DataFrame) -> DataFrame:
    """(row, unit, place, text): every line, and every block of two or more lines between blank lines, by its number."""
    line = rows.select("row", "key", F.lit("line").alias("unit"), F.posexplode(F.split("text", "\n")).alias("place", "part"))
    block = rows.select("row", "key", F.lit("block").alias("unit"), F.posexplode(F.split("text", r"\n[\x20\x09\x0D]*\n")).alias("place", "part"))
    return line.unionByName(block.where(F.trim("part").contains("\n")))


def scan(docs: DataFrame, licences: DataFrame | None = None, key: str = "doc_id", text: str = "text", least: float = DICE) -> DataFrame:
    """(key, unit, place, license_id, dice): the licence nearest to each line or block that reaches the threshold.

    Of equally near licences the first by name is told. Lines and blocks are numbered from 0; a block is told beside
    its lines. Null and empty texts have no notice, and templates without a word or a name are passed over. Equal rows
    and rows with a null key are told each. Every line of every text is looked at, however long the text.
    """
    spark = docs.sparkSession
    known = (templates(spark) if licences is None else licences).where("license_id IS NOT NULL AND text IS NOT NULL")
    known = known.select("license_id", F.explode(F.array(_words(F.col("text")))).alias("words")).select(
        "license_id", _bigrams("words").alias("grams"))
    known = known.where(F.size("grams") > 0).distinct().withColumn("template", F.monotonically_increasing_id())
    known = kept(known.select("template", "license_id", F.size("grams").alias("of"), F.explode("grams").alias("gram")))
    sizes = known.agg(F.min("of").alias("low"), F.max("of").alias("high"), F.count("*").alias("n")).first()
    ratio = least / (2 - least)
    low, high = (sizes["low"] or 1) * ratio, (sizes["high"] or 0) / ratio
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), text_or_empty(text).alias("text"))
    # words and bigrams leave through generators: else they would be made anew for each use, even for each bigram
    units = _units(rows).select("row", "key", "unit", "place", F.explode(F.array(_words(F.col("part")))).alias("words"))
    # distinct bigrams are fewer than words, so only a lower bound can be told before they are made
    taken = units.where(F.size("words") >= low).select("row", "key", "unit", "place", F.explode(F.array(_bigrams("words"))).alias("grams"))
    taken = taken.withColumn("size", F.size("grams")).where(F.col("size").between(low - 1e-9, high + 1e-9))
    each = taken.select("row", "key", "unit", "place", "size", F.explode("grams").alias("gram"))
    hits = each.join(small(known, sizes["n"]), "gram").where(
        F.col("size").between(F.col("of") * ratio - 1e-9, F.col("of") / ratio + 1e-9))
    shared = hits.groupBy("row", "key", "unit", "place", "template", "license_id", "size", "of").agg(F.count("*").alias("both"))
    near = shared.withColumn("dice", 2 * F.col("both") / (F.col("size") + F.col("of"))).where(F.col("dice") >= least)
    best = near.groupBy("row", "key", "unit", "place").agg(
        F.max("dice").alias("dice"), F.min(F.struct(-F.col("dice"), F.col("license_id"))).alias("first"))
    return best.select(F.col("key").alias(key), "unit", "place", F.col("first.license_id").alias("license_id"), "dice")
