"""License scan: MinHash bands over overlapping text windows, exact shingle containment.

Templates are put in size classes (powers of two words).  A text is cut into windows that start every quarter of the
class.  Those a quarter longer than the class hold any passage of a template's length whole; those twice as long as
the class hold a notice with words inserted, up to 1.75 classes, wherever it starts, and count where no shorter one
holds enough.  A short window shares at least 0.29 of all shingles involved with a template contained to 0.8, and one
of 32 bands of one row then collides with a probability above 0.99998; a long one 0.19, and one of 64 bands collides
with a probability above 0.99999.  Containment of the template's shingles in the window decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.scratch import stored
from kerbside.llm.shingle_windows import TEXT, shingle_hits, shingles, text_id, window_hashes, with_word_hashes

WINDOWS = ((5, 32), (8, 64))  # quarters of the class, and bands
SMALLEST_CLASS = 8

# Notices and opening passages of public licenses.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."),
    "MIT": "Released under the MIT License",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:"),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."),
    "BSD text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."),
    "ISC text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."),
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def templates(spark: SparkSession) -> DataFrame:
    """The built-in templates as (license, text)."""
    return spark.createDataFrame(list(TEMPLATES.items()), "license string, text string")


def min_hashes(shingle_column: str, bands: int) -> Column:
    """One minimum per band; null for a window without shingles."""
    return F.array(*[F.array_min(F.transform(shingle_column, lambda s: F.xxhash64(s, F.lit(band)))) for band in range(bands)])


def license_matches(docs: DataFrame, licenses: DataFrame, text: str = "text", key: str = "doc_id", name: str = "license",
                    license_text: str = "text", size: int = 3, containment: float = 0.8) -> DataFrame:
    """doc_id, license, window_start (words) and containment: each template found in each document, at the window
    that holds most of its shingles (the first of equals), a long window only where no short one holds enough.

    Words are lower-cased runs of letters and digits.  Templates of fewer than ``size`` words are found nowhere,
    null texts hold nothing, and repeated rows each have their rows.
    """
    known = with_word_hashes(licenses.select(F.col(name).alias("license"), F.col(license_text).alias("_text")), "_text").drop("_text")
    smallest_power = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("hashes")))).cast("int")
    named = stored(known.where(F.size("hashes") >= size).select(
        "license", F.greatest(F.lit(SMALLEST_CLASS), smallest_power).alias("class"),
        F.array_distinct(shingles("hashes", size)).alias("template")), "templates")
    reference = stored(named.select("class", F.explode("template").alias("h")).distinct(), "template-shingles")
    hits = stored(shingle_hits(docs, reference, size, text).select(*TEXT, "class", "pos"), "template-hits")

    shares = [_shares(docs, hits, named, quarters, bands, size, text).where(F.col("share") >= containment).select(
        *TEXT, "license", F.lit(quarters).alias("quarters"), (-F.col("share")).alias("less"), "start") for quarters, bands in WINDOWS]
    best = shares[0].unionByName(shares[1]).groupBy(*TEXT, "license").agg(F.min(F.struct("quarters", "less", "start")).alias("best"))
    found = stored(best.select(*TEXT, "license", F.col("best.start").alias("window_start"), (-F.col("best.less")).alias("containment")), "licenses")
    return docs.select(F.col(key).alias("doc_id"), *text_id(F.col(text))).join(found, TEXT).drop(*TEXT)


def _shares(docs: DataFrame, hits: DataFrame, named: DataFrame, quarters: int, bands: int, size: int, text: str) -> DataFrame:
    """t1, t2, license, start and share of the template's shingles, for windows of so many quarters of the class."""
    offered_bands = stored(named.select("*", min_hashes("template", bands).alias("template_minima")), "template-bands")

    # Starts of the windows that hold the place, one each stride.
    stride = (F.col("class") / 4).cast("int")
    placed = hits.select(*TEXT, "class", "pos", stride.alias("stride"), (stride * quarters).alias("length"))
    first = F.greatest(F.lit(0), F.ceil((F.col("pos") + size - F.col("length")) / F.col("stride"))).cast("int")
    near = placed.select(*TEXT, "class", "length", "stride", first.alias("first"), F.floor(F.col("pos") / F.col("stride")).cast("int").alias("last")).distinct()
    numbered = near.select(*TEXT, "class", "length", "stride", F.explode(F.sequence("first", "last")).alias("number"))
    windows = stored(numbered.select(*TEXT, "class", "length", (F.col("number") * F.col("stride")).alias("start")).distinct(), "windows")
    own = window_hashes(docs, windows, text)
    looked_at = own.select(*TEXT, "class", "start", F.array_distinct(shingles("hashes", size)).alias("window"))
    signed = stored(looked_at.select("*", min_hashes("window", bands).alias("minima")), "window-bands")

    asked = signed.select("*", F.posexplode("minima").alias("band", "value"))
    offered = offered_bands.select("*", F.posexplode("template_minima").alias("band", "value"))
    first_band = F.array_position(F.zip_with("minima", "template_minima", lambda x, y: x == y), True) - 1
    met = asked.join(offered, ["class", "band", "value"]).where(F.col("band") == first_band)
    share = F.size(F.array_intersect("window", "template")) / F.size("template")
    return met.select(*TEXT, "license", "start", share.alias("share"))
