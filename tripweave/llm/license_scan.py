"""License scans (operator 3), DataFrame functions only.

A text is lower-cased and cut into words (letters and digits) and these into
3-grams.  A template of ``n`` 3-grams is compared with overlapping windows of
``width(n)`` 3-grams that start at every ``stride(n)``-th place; the first and last
ones reach over the ends of the text.  A document holds a template if it, or with
``in_window`` one of its windows, holds ``containment_pct`` percent of the
template's distinct 3-grams.

Retrieval is MinHash with one permutation: the lowest bits of a 3-gram's hash are
its band, and the MinHash of a template or window in a band is the smallest hash
of that band.  A window retrieves a template when they agree in a band.  Of a
text, only 3-grams that are a template's MinHash can agree, so these are looked
up, and those windows around each collide in which no smaller hash of its band
stands: the bands are joined without writing a signature per window.  Every
retrieved template is verified by the exact share of its distinct 3-grams.

The settings: templates of up to ``SHORT`` 3-grams have windows of their own
length at every place, so an exact copy has the same 3-grams and agrees in all
bands: none is missed.  For all others ``miss_estimate(n)`` is the chance that a
window which holds just enough agrees in none of the bands: below one in a
million at 80 percent for every ``n``.

Templates are a table (license_id, text); the default has the notices and headers
below and the whole texts in ``licenses/``.  Index and 3-grams are broadcast,
with checked bounds on the number of templates and of their 3-grams.  A document
is looked up within its row, so only retrieved windows become rows, and only
verified ones are shuffled.

Rows: null and empty texts, and those without a 3-gram, match nothing; null or
empty templates are ignored; repeated rows are matched each; a null doc_id is
reported as null; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Notices in common use, by the identifier of their licence.
NOTICES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
           "that the following conditions are met.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
#: Standard headers and statements, by licence; they name their version themselves.
_GNU = (" This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details. "
        "You should have received a copy of the GNU {0} along with this {1}")
_FSF = "it under the terms of the GNU {0} as published by the Free Software Foundation{1}"
_LATER = ", either version {} of the License, or (at your option) any later version."
_OLD = "; either version {} of the License, or (at your option) any later version."
_GPL, _LGPL, _AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"
_FREE = "This {} is free software: you can redistribute it and/or modify "
HEADERS = {
    "GPL-2.0": _FREE.format("program").replace(":", ";") + _FSF.format(_GPL, _OLD.format(2)) + _GNU.format(_GPL, "program"),
    "GPL-2.0-only": _FREE.format("program").replace(":", ";") + _FSF.format(_GPL, "; version 2 of the License.")
                    + _GNU.format(_GPL, "program"),
    "GPL-3.0": _FREE.format("program") + _FSF.format(_GPL, _LATER.format(3)) + _GNU.format(_GPL, "program"),
    "LGPL-2.1": _FREE.format("library").replace(":", ";") + _FSF.format(_LGPL, _OLD.format("2.1"))
                + _GNU.format(_LGPL, "library").replace("program", "library"),
    "LGPL-3.0": _FREE.format("program") + _FSF.format(_LGPL, _LATER.format(3)) + _GNU.format(_LGPL, "program"),
    "AGPL-3.0": _FREE.format("program") + _FSF.format(_AGPL, _LATER.format(3)) + _GNU.format(_AGPL, "program"),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                  "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                  "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                  "permissions and limitations under the License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
               "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
               "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy "
               "at https://www.boost.org/LICENSE_1_0.txt)",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "MIT": "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-SA-3.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
                       "International License.",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
               "to this work.",
}
#: Whole texts, a file each.
TEXTS = Path(__file__).with_name("licenses")
GRAM = 3
#: MinHashes of a template or window, by the lowest bits of a hash.
BAND_BITS = 8
BANDS = 1 << BAND_BITS
#: 3-grams of a short template.
SHORT = 16
MAX_TEMPLATES = 10_000
#: Distinct 3-grams of all templates.
MAX_GRAMS = 1_000_000


def default_templates() -> dict[str, str]:
    """Notices by the identifier of their licence, headers and whole texts by
    that and their kind."""
    return (NOTICES | {f"{k}/header": t for k, t in HEADERS.items()}
            | {f"{p.stem}/text": p.read_text("utf-8") for p in sorted(TEXTS.glob("*.txt"))})


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(default_templates().items()), "license_id string, text string")


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def gram_hashes(text: Column) -> Column:
    """64-bit hashes of the word 3-grams of a text, in order."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return _let(words, lambda w: F.when(F.size(w) < GRAM, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(w) - GRAM), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(GRAM)]))))


def width(n: int) -> int:
    """3-grams of a window for a template of ``n``: as many for a short one, else
    room for a quarter more."""
    return n if n <= SHORT else n + n // 4


def stride(n: int) -> int:
    """Distance of windows: half of that room, so a text that grew by an eighth
    lies whole in one of them."""
    return max((width(n) - n) // 2, 1)


def miss_estimate(n: int, containment_pct: int = 80) -> float:
    """Chance, for random hashes, that a window which holds just enough of ``n``
    distinct 3-grams has the template's MinHash in no band.  The window and the
    template have ``need`` in common and ``union - need`` not; a band that holds a
    common one agrees if its smallest 3-gram of either is common."""
    need = max(-(-containment_pct * n // 100), 1)
    union = width(n) + n - need
    if union == need:     # the same 3-grams, the same MinHashes
        return 0.0
    bands = BANDS * (1 - (1 - 1 / BANDS) ** need)     # that hold a common 3-gram, on average
    others = (union - need) / BANDS
    return (others / (need / bands + others)) ** bands


def _index(grams: list[list[int]]) -> tuple[int, list[int], list[int], list[int]]:
    """(bits, starts, hashes, templates): the MinHashes of each template in buckets
    by ``bits`` bits above those of the band."""
    entries = []
    for k, own in enumerate(grams):
        smallest: dict[int, int] = {}
        for h in own:
            smallest[h % BANDS] = min(h, smallest.get(h % BANDS, h))
        entries += [(h, k) for h in smallest.values()]
    bits = max((4 * len(entries)).bit_length(), 4)
    hashes = np.array([h for h, _ in entries], np.int64)
    bucket = (hashes // BANDS) % (1 << bits)
    order = np.argsort(bucket, kind="stable")
    starts = np.searchsorted(bucket[order], np.arange((1 << bits) + 1))
    return bits, starts.tolist(), hashes[order].tolist(), [entries[i][1] for i in order]


def scan(docs: DataFrame, texts: DataFrame | None = None, containment_pct: int = 80,
         in_window: bool = False) -> DataFrame:
    """(doc_id, license_id, first_word, shared, template_grams, containment) of
    every retrieved template of which the document holds ``containment_pct`` percent
    or more; with ``in_window`` one window of it must, and the row is that of the
    window that holds most, the first if there are several.  ``first_word`` is the
    place of the first 3-gram of the template, there or in the document."""
    spark = docs.sparkSession
    texts = templates(spark) if texts is None else texts
    known = (texts.select("license_id", gram_hashes(F.col("text")).alias("g"))
             .select("license_id", F.size("g").alias("n"), F.array_distinct("g").alias("g")).filter("n > 0")
             .limit(MAX_TEMPLATES + 1))
    n, total = known.agg(F.count("*"), F.sum(F.size("g"))).first()
    if n > MAX_TEMPLATES or (total or 0) > MAX_GRAMS:
        raise ValueError(f"more than {MAX_TEMPLATES} templates, or {MAX_GRAMS} 3-grams in them")
    found = known.collect()     # bounded just above
    bits, *index = _index([r["g"] for r in found])
    index += [[width(r["n"]) for r in found], [stride(r["n"]) for r in found]]
    wanted = spark.createDataFrame([tuple(index)], "starts array<int>, hashes array<bigint>, of array<int>, "
                                                   "widths array<int>, strides array<int>")
    grams_of = spark.createDataFrame([(k, r["license_id"], r["g"]) for k, r in enumerate(found)],
                                     f"template int, license_id {known.schema['license_id'].dataType.simpleString()}, "
                                     "t_grams array<bigint>")

    def windows(grams: Column, i: Column, template: Column) -> Column:
        """Starts of the template's windows whose MinHash is the 3-gram at ``i``:
        those between its next smaller neighbours of the same band."""
        own, w, step = F.get(grams, i), F.get("widths", template), F.get("strides", template)
        smaller = lambda p: (F.pmod(F.get(grams, p), F.lit(BANDS)) == F.pmod(own, F.lit(BANDS))) & (F.get(grams, p) < own)
        left = F.array_max(F.filter(F.sequence(F.greatest(i - w + 1, F.lit(0)), i), smaller))
        right = F.array_min(F.filter(F.sequence(i, F.least(i + w - 1, F.size(grams) - 1)), smaller))
        low = F.greatest(i - w + 1, F.coalesce(left + 1, i - w + 1))
        high = F.least(i, F.coalesce(right - w, i))
        first = F.ceil(low / step).cast("int") * step
        return _let(first, lambda a: F.when(a <= high, F.sequence(a, F.greatest(high, a), step)).otherwise(
            F.array().cast("array<int>")))

    def retrieved(grams: Column) -> Column:
        """(template, start, window) of each window that collides with its template, or
        (template, 0, all) of each template with such a window."""
        bucket = lambda g: F.shiftright(g, BAND_BITS).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
        start = lambda g, k: F.get("starts", bucket(g) + k)
        occupied = F.filter(F.sequence(F.lit(0), F.size(grams) - 1),
                            lambda i: start(F.get(grams, i), 1) > start(F.get(grams, i), 0))
        hits = F.flatten(F.transform(occupied, lambda i: F.flatten(F.transform(
            F.filter(F.sequence(start(F.get(grams, i), 0), start(F.get(grams, i), 1) - 1),
                     lambda j: F.get("hashes", j) == F.get(grams, i)),
            lambda j: F.transform(windows(grams, i, F.get("of", j)), lambda a: F.struct(
                F.get("of", j).alias("template"), a.alias("start")))))))
        if not in_window:
            whole = F.transform(F.array_distinct(F.transform(hits, lambda h: h["template"])), lambda t: F.struct(
                t.alias("template"), F.lit(0).alias("start"), grams.alias("window")))
            return F.when(F.size(grams) == 0, F.array()).otherwise(whole)
        cut = F.transform(F.array_distinct(hits), lambda h: F.struct(
            h["template"].alias("template"), F.greatest(h["start"], F.lit(0)).alias("start"),
            F.slice(grams, F.greatest(h["start"], F.lit(0)) + 1,
                    F.get("widths", h["template"]) + F.least(h["start"], F.lit(0))).alias("window")))
        return F.when(F.size(grams) == 0, F.array()).otherwise(cut)

    # one expression per text, evaluated once: no filter stands above it that
    # could be pushed down as a copy of it, hence the outer explode
    looked_up = _let(gram_hashes(F.col("text")), retrieved)
    best = F.max_by(F.struct("shared", "template_grams", "first_word"), F.struct("shared", -F.col("first_word")))
    return (docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
            .crossJoin(F.broadcast(wanted)).select("doc_id", "row", looked_up.alias("x"))
            .select("doc_id", "row", F.explode_outer("x").alias("h"))
            .select("doc_id", "row", "h.*")
            .join(F.broadcast(grams_of), "template")
            .select("doc_id", "row", "license_id", "start", "window", "t_grams", F.size("t_grams").alias("template_grams"),
                    F.size(F.array_intersect("t_grams", "window")).alias("shared"))
            .filter(100 * F.col("shared") >= containment_pct * F.col("template_grams"))
            .select("doc_id", "row", "license_id", "shared", "template_grams", (F.col("start") + F.array_position(
                F.transform("window", lambda g: F.array_contains("t_grams", g)), True).cast("int") - 1).alias("first_word"))
            .groupBy("doc_id", "row", "license_id").agg(best.alias("b"))
            .select("doc_id", "license_id", "b.first_word", "b.shared", "b.template_grams",
                    (F.col("b.shared") / F.col("b.template_grams")).alias("containment")))
