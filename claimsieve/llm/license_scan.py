"""License notices in texts: MinHash bands over overlapping windows retrieve templates, containment verifies.

Everything is DataFrame expressions. Texts become lower-case words of letters and digits and these
become hashes of five-word shingles, once for all templates. Per class of template length, windows
over the shingles overlap so far that every run as long as a template, and a quarter longer, lies
inside one of them.

The MinHash of a window takes one hash a shingle: the leading bits of the hash are the band, and the
smallest hash of a band is its value. The smallest hashes of the bands that the shingles of a window
and a template occupy are a random draw, without putting back, from those shingles, so a window that
holds enough of a template to match shares no band value with it with a chance that
``chance_of_miss`` works out; the number of bands is the least that keeps the accepted one. Windows
that share a band value with a template are compared with it exactly: the share of the template's
shingles that the window contains. A band value of a template is one of its shingles, so windows are
laid only where a text has such a shingle.

Texts are scanned only if they contain one of a few words. The words are chosen so that no match is
lost: of every template more than a share of ``1 - containment`` of the shingles contain one, so a
text without them cannot contain enough.

Templates are a parameter of bounded size and are broadcast; texts are not shuffled before the
matches are counted.

Defined results: NULL, empty and short texts match nothing; ties between windows go to the first;
repeated rows are matched each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsieve.llm.common import columns_of

SHINGLE = 5
MAX_TEMPLATES = 2_000
#: Shingles of all templates together: what is broadcast stays below some 10 MB.
MAX_SHINGLES = 500_000

# Licences and customary notices, as their licences word them. Where two licences share most of a text, the
# template is a passage that tells them and their versions apart.
TEMPLATES = (
    ("MIT", "released", "Released under the MIT License."),
    ("MIT", "licensed", "Licensed under the MIT License."),
    ("MIT", "distributed", "Distributed under the MIT License."),
    ("MIT", "terms", "subject to the terms of the MIT License"),
    (
        "MIT",
        "grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    (
        "MIT",
        "whole",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND,"
        " EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR"
        " PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,"
        " DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN"
        " CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "whole",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies. THE"
        " SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING"
        " ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,"
        " DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR"
        " PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN"
        " CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("ISC", "licensed", "Licensed under the ISC License"),
    (
        "0BSD",
        "grant",
        "with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\"",
    ),
    (
        "BSD",
        "grant",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
    ),
    (
        "BSD",
        "disclaimer",
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,"
        " EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
        " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF"
        " LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY"
        " WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "BSD-2-Clause",
        "second clause",
        "and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS",
    ),
    ("BSD-2-Clause", "licensed", "licensed under the BSD 2-Clause License"),
    (
        "BSD-3-Clause",
        "third clause",
        "nor the names of its contributors may be used to endorse or promote products derived from this software without"
        " specific prior written permission.",
    ),
    ("BSD-3-Clause", "licensed", "licensed under the BSD 3-Clause License"),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0"),
    (
        "Apache-2.0",
        "header",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on"
        " an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License"
        " for the specific language governing permissions and limitations under the License.",
    ),
    (
        "Apache-2.0",
        "copyright grant",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual,"
        " worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare"
        " Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such"
        " Derivative Works in Source or Object form.",
    ),
    (
        "GPL-2.0",
        "version",
        "terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the"
        " License",
    ),
    ("GPL-2.0", "notice", "under the GNU General Public License, version 2"),
    (
        "GPL-3.0",
        "version",
        "terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the"
        " License",
    ),
    ("GPL-3.0", "notice", "under the GNU General Public License, version 3"),
    (
        "GPL-3.0",
        "preamble",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses"
        " for most software and other practical works are designed to take away your freedom to share and change the"
        " works.",
    ),
    (
        "LGPL-2.1",
        "version",
        "terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1"
        " of the License",
    ),
    (
        "LGPL-3.0",
        "version",
        "terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3"
        " of the License",
    ),
    (
        "AGPL-3.0",
        "version",
        "terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3"
        " of the License",
    ),
    (
        "GPL family",
        "warranty",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the"
        " implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    (
        "MPL-2.0",
        "header",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at",
    ),
    (
        "EPL-2.0",
        "header",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License"
        " 2.0 which is available at",
    ),
    (
        "BSL-1.0",
        "header",
        "Distributed under the Boost Software License, Version 1.0.",
    ),
    (
        "Zlib",
        "grant",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be"
        " held liable for any damages arising from the use of this software. Permission is granted to anyone to use"
        " this software for any purpose, including commercial applications, and to alter it and redistribute it freely,"
        " subject to the following restrictions",
    ),
    (
        "Unlicense",
        "grant",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,"
        " publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,"
        " for any purpose, commercial or non-commercial, and by any means.",
    ),
    ("CC-BY-4.0", "short", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "notice", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-3.0", "short", "Licensed under CC BY-SA 3.0"),
    (
        "CC-BY-SA-3.0",
        "notice",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License",
    ),
    ("CC-BY-SA-4.0", "short", "Licensed under CC BY-SA 4.0"),
    (
        "CC-BY-SA-4.0",
        "notice",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    ("CC-BY-NC-4.0", "short", "Licensed under CC BY-NC 4.0"),
    (
        "CC-BY-NC-4.0",
        "notice",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    ("CC-BY-ND-4.0", "short", "Licensed under CC BY-ND 4.0"),
    (
        "CC-BY-ND-4.0",
        "notice",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    ),
    ("CC-BY-NC-SA-4.0", "short", "Licensed under CC BY-NC-SA 4.0"),
    (
        "CC-BY-NC-SA-4.0",
        "notice",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    ),
    ("CC-BY-NC-ND-4.0", "short", "Licensed under CC BY-NC-ND 4.0"),
    (
        "CC-BY-NC-ND-4.0",
        "notice",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International"
        " License",
    ),
    (
        "CC0-1.0",
        "waiver",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this"
        " work",
    ),
    ("all rights reserved", "notice", "No part of this publication may be reproduced, distributed, or transmitted"),
)


@dataclass(frozen=True)
class Scan:
    """Least containment, and the accepted chance that a window that matches shares no band with its template."""

    containment: float = 0.8
    miss: float = 1e-6


@dataclass(frozen=True)
class WindowClass:
    """Windows for templates of ``most`` shingles at most and more than half of that; 2 ** ``band_bits`` bands."""

    most: int
    width: int
    stride: int
    band_bits: int


def plain_words(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def shingles(words: list[str]) -> list[str]:
    return [" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]


def chance_of_miss(shared: int, others: int, bands: int) -> float:
    """The chance that no band's smallest hash is one of ``shared`` shingles, where ``others`` are on one side only."""
    every = shared + others
    occupied = np.zeros(every + 1)  # occupied[n]: the chance that the shingles so far lie in n bands
    occupied[0] = 1.0
    steps = np.arange(every + 1)
    for _ in range(every):
        stays = occupied * steps / bands
        moves = occupied * np.maximum(bands - steps, 0) / bands
        occupied = stays + np.concatenate([[0.0], moves[:-1]])
    drawn = np.cumprod(np.maximum(others - steps[:-1], 0) / (every - steps[:-1]))  # n + 1 draws, none of them shared
    return float(occupied[1:] @ drawn)


@cache
def window_class(n_shingles: int, how: Scan) -> WindowClass:
    """Width, stride and bands for templates whose size rounds up to the same power of two.

    More shared shingles and fewer others never raise the chance of a miss, so it is taken for the
    shared ones of the shortest template and the others of the longest.
    """
    most = 1 << (n_shingles - 1).bit_length()
    least = most // 2 + 1 if most > 1 else 1
    stride = -(-least // 2)
    width = -(-5 * most // 4) + stride - 1
    shared = math.ceil(how.containment * least - 1e-9)
    others = width - shared + most - math.ceil(how.containment * most - 1e-9)
    bits = next(b for b in range(1, 62) if chance_of_miss(shared, others, 1 << b) <= how.miss)
    return WindowClass(most, width, stride, bits)


def telling_words(templates: Sequence[tuple[str, str, str]], how: Scan) -> list[str]:
    """Words, the longest first, until so many shingles of every template hold one that no match can do without."""
    chosen: set[str] = set()
    for _, _, text in templates:
        parts = set(shingles(plain_words(text)))
        for word in sorted(set(plain_words(text)), key=lambda w: (w not in chosen, -len(w), w)):
            held = sum(any(w in chosen for w in p.split()) for p in parts)
            if held > (1 - how.containment) * len(parts) + 1e-9:
                break
            chosen.add(word)
    return sorted(chosen)


def shingle_hashes(words: str) -> Column:
    n = F.size(words) - (SHINGLE - 1)
    of_words = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)])
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), of_words))


def word_list(lower: str) -> Column:
    """The words of a lower-case text."""
    return F.filter(F.split(F.regexp_replace(lower, r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def sketch_of(window: Column, band_bits: int) -> Column:
    """The smallest hash of every band that the window occupies; a band is the leading bits of a hash."""
    in_order = F.array_sort(F.array_distinct(window))
    new_band = lambda h, before: F.shiftright(h, 64 - band_bits) != F.shiftright(before, 64 - band_bits)
    return F.filter(in_order, lambda h, i: (i == 0) | new_band(h, F.get(in_order, i - 1)))


def _windows(shingles: str, hits: str, kind: WindowClass, values: list[int]) -> Column:
    """(most, start, window) for every window of the class that holds one of ``values``; ``hits`` are places."""
    own = F.filter(hits, lambda i: F.get(shingles, i).isin(values))
    first = lambda i: F.greatest(F.lit(0), F.ceil((i - (kind.width - 1)) / kind.stride).cast("int"))
    spots = F.transform(own, lambda i: F.sequence(first(i), F.floor(i / kind.stride).cast("int")))
    return F.transform(
        F.array_distinct(F.flatten(spots)),
        lambda k: F.struct(
            F.lit(kind.most).alias("most"),
            (k * kind.stride).alias("start"),
            F.slice(shingles, k * kind.stride + 1, kind.width).alias("window"),
        ),
    )


def template_rows(spark: SparkSession, templates: Sequence[tuple[str, str, str]], how: Scan) -> DataFrame:
    """(template, license, notice, most, parts, sketch): shingle hashes and bands, one row per template."""
    if not 0 < len(templates) <= MAX_TEMPLATES:
        raise ValueError(f"from 1 to {MAX_TEMPLATES} templates")
    rows = [
        (i, name, part, window_class(len(set(shingles(plain_words(text)))) or 1, how).most, text)
        for i, (name, part, text) in enumerate(templates)
    ]
    if any(len(plain_words(text)) < SHINGLE for _, _, text in templates):
        raise ValueError(f"a template needs {SHINGLE} words")
    if sum(len(plain_words(text)) for _, _, text in templates) > MAX_SHINGLES:
        raise ValueError(f"at most {MAX_SHINGLES} shingles of templates")
    names = ("template", "license", "notice", "most", "text")
    made = spark.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rows])))
    made = made.withColumn("text", F.lower("text")).withColumn("words", word_list("text")).withColumn("parts", F.array_distinct(shingle_hashes("words")))
    return made.withColumn("sketch", _sketch("parts", sorted({r[3] for r in rows}), how)).drop("text", "words")


def _sketch(window: str, classes: list[int], how: Scan) -> Column:
    """The sketch of a window of the row's class ``most``."""
    sketch = F.lit(None).cast("array<long>")
    for most in classes:
        of_class = sketch_of(F.col(window), window_class(most, how).band_bits)
        sketch = F.when(F.col("most") == most, of_class).otherwise(sketch)
    return sketch


def license_matches(docs: DataFrame, templates: Sequence[tuple[str, str, str]] = TEMPLATES, how: Scan = Scan(),
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, license, notice, containment, first_word and n_windows for every row and template that match."""
    spark = docs.sparkSession
    known = template_rows(spark, templates, how)
    sketches = known.select("most", "sketch").collect()  # at most MAX_SHINGLES values
    values = {most: sorted({v for s in sketches if s["most"] == most for v in s["sketch"]}) for most in {s["most"] for s in sketches}}
    named = columns_of(docs, doc_id=id_col, text=text_col)
    lower = named.select("doc_id", F.monotonically_increasing_id().alias("row"), F.lower("text").alias("small"))
    telling = F.lit(False)
    for word in telling_words(templates, how):
        telling = telling | F.col("small").contains(word)
    parts = lower.where(telling).select("row", "doc_id", word_list("small").alias("words"))
    parts = parts.select("row", "doc_id", shingle_hashes("words").alias("shingles"))
    known_value = lambda i: F.get("shingles", i).isin(sorted({v for of_class in values.values() for v in of_class}))
    places = F.filter(F.sequence(F.lit(0), F.size("shingles") - 1), known_value)
    parts = parts.select("row", "doc_id", "shingles", places.alias("hits"))
    laid = F.concat(*[_windows("shingles", "hits", window_class(most, how), values[most]) for most in sorted(values)])
    # explode_outer: a plain explode has its input computed a second time, to filter the rows by its size
    windows = parts.select("row", "doc_id", F.explode_outer(laid).alias("w")).where("w is not null").select("row", "doc_id", "w.*")
    near = windows.select("*", F.explode_outer(_sketch("window", sorted(values), how)).alias("band"))
    bands = known.select("template", "most", F.explode_outer("sketch").alias("band"))
    retrieved = near.join(F.broadcast(bands), ["most", "band"]).drop("most", "band")
    checked = retrieved.join(F.broadcast(known.drop("most", "sketch")), "template")
    share = F.size(F.array_intersect("window", "parts")) / F.size("parts")
    checked = checked.select("row", "doc_id", "template", "license", "notice", "start", share.alias("containment")).distinct()
    checked = checked.where(F.col("containment") >= how.containment - 1e-9)
    best = F.max(F.struct("containment", (-F.col("start")).alias("from")))
    matches = checked.groupBy("row", "doc_id", "template", "license", "notice").agg(
        best.alias("best"), F.count(F.lit(1)).alias("n_windows")
    )
    return matches.select(
        "doc_id", "license", "notice", F.col("best.containment").alias("containment"),
        (-F.col("best.from")).cast("long").alias("first_word"), "n_windows",
    )
