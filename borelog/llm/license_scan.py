"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

DataFrame operations only; a row is scanned where it lies, without a shuffle or a join. A text is cut into windows for
each size class of the templates, each half as long again as the longest template of its class and starting every half
template, so that every passage of a template's length lies whole in some window. Only windows with a phrase that every
match must hold one of are hashed.
"""

import itertools
import json
import math

from pyspark.sql import Column, DataFrame, functions as F

WIDTH = 3
CONTAINMENT = 0.8
MISS = 1e-4

# Notices, opening passages and, where they are short, whole texts of public licenses.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "mit-notice": "Released under the MIT License.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."
    ),
    "lgpl-3.0-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ),
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "agpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "epl-2.0-notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
        "PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES "
        "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE."
    ),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY "
        "THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
        "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
        "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE."
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for "
        "any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated "
        "but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being "
        "the original software. 3. This notice may not be removed or altered from any source distribution."
    ),
}


def template_words(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text).lower().split()


def template_shingles(words: list[str]) -> list[str]:
    return sorted({" ".join(words[i : i + WIDTH]) for i in range(max(1, len(words) - WIDTH + 1))})


def anchors(templates: dict[str, str], containment: float) -> list[str]:
    """Phrases one of which every match must hold: more shingles of each template than a match may lack.

    Phrases that serve another template come first, then those of the most letters, as long words are rare ones.
    """
    chosen: set[str] = set()
    for name in sorted(templates):
        own = template_shingles(template_words(templates[name]))
        enough = math.floor((1 - containment) * len(own) + 1e-9) + 1
        chosen |= set(sorted(own, key=lambda s: (s not in chosen, -len(s), s))[:enough])
    return sorted(chosen)


def anchor_pattern(phrases: list[str]) -> str:
    """A regular expression that finds any of the phrases in a lowered text, grouped by their first letters."""
    gap = lambda phrase: phrase.replace(" ", "[^a-z0-9]++")
    groups = itertools.groupby(sorted(p for p in phrases if p), key=lambda p: p[0])
    parts = [f"{first}(?:{'|'.join(gap(p[1:]) for p in same)})" for first, same in groups]
    return f"(?<![a-z0-9])(?:{'|'.join(parts) or '(?!)'})(?![a-z0-9])"


def size_classes(templates: dict[str, str]) -> dict[int, list[str]]:
    """Templates by the length in words of the longest of their class; a class spans at most a factor of two."""
    lengths = sorted((len(template_words(t)), name) for name, t in templates.items())
    classes: dict[int, list[str]] = {}
    while lengths:
        longest = lengths[-1][0]
        classes[longest] = [name for n, name in lengths if 2 * n > longest]
        lengths = [x for x in lengths if 2 * x[0] <= longest]
    return classes


def bands_needed(containment: float, miss: float) -> int:
    """Bands of one row with which a match escapes with a chance of ``miss`` at most.

    The least similar match is that of a template half as long as the longest of its class, in a full window.
    """
    similarity = 0.5 * containment / (1.5 + 0.5 * (1 - containment))
    return math.ceil(math.log(miss) / math.log(1 - similarity))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shingles(words: Column) -> Column:
    n = F.size(words)
    whole = F.array(F.array_join(words, " "))
    parts = F.transform(F.sequence(F.lit(1), n - WIDTH + 1), lambda i: F.array_join(F.slice(words, i, WIDTH), " "))
    return F.when(n > WIDTH, F.array_distinct(parts)).otherwise(whole)


def _mins(shingles: Column, bands: int) -> Column:
    """The least hash of the shingles under each band's number."""
    hashes = F.transform(shingles, lambda s: F.xxhash64(s))
    least = lambda hs, i: F.array_min(F.transform(hs, lambda h: F.xxhash64(h, i)))
    return _let(hashes, lambda hs: F.transform(F.sequence(F.lit(1), F.lit(bands)), lambda i: least(hs, i)))


def _template_array(spark, templates, bands: int) -> Column:
    """The templates with their band values as one constant; Spark itself hashes them, a row each."""
    rows = [(n, longest, template_shingles(template_words(templates[n]))) for longest, names in size_classes(templates).items() for n in names]
    table = spark.createDataFrame(rows, "name string, longest int, shingles array<string>")
    made = table.select("name", "longest", "shingles", _mins(F.col("shingles"), bands).alias("mins")).collect()
    schema = "array<struct<name: string, longest: int, shingles: array<string>, mins: array<bigint>>>"
    return F.from_json(F.lit(json.dumps([r.asDict() for r in made])), schema)


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT, miss: float = MISS) -> DataFrame:
    """Licenses in whole texts: a row per row of ``docs`` (doc_id, text) with doc_id and ``matches``.

    ``matches`` has (name, containment, start) for each template of which some window holds at least ``containment`` of the
    distinct shingles of three words; the fullest window counts, the first of equal ones, and ``start`` is its first word.
    Words are runs of letters a-z and digits after A-Z are lowered. A match that begins and ends in one window's reach is
    missed with a chance of ``miss`` at most. A NULL or empty text has no match; a NULL doc_id and repeated rows are kept;
    an empty table gives an empty result; other columns are ignored.
    """
    templates = TEMPLATES if templates is None else templates
    bands = bands_needed(containment, miss)
    known = _template_array(docs.sparkSession, templates, bands)
    lowered = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    phrases = F.lit(anchor_pattern(anchors(templates, containment)))
    words = F.split(F.trim(F.regexp_replace(lowered, "[^a-z0-9]+", " ")), " ", -1)
    none = F.from_json(F.lit("[]"), "array<struct<name: string, containment: double, start: int>>")

    def windows(longest: int) -> Column:
        step, size = max(1, longest // 2), longest + max(1, longest // 2)
        starts = F.sequence(F.lit(0), F.size("words") - 1, F.lit(step))
        return F.transform(starts, lambda s: F.struct(
            F.lit(longest).alias("longest"), s.alias("start"), F.slice("words", s + 1, size).alias("words")
        ))

    signed = lambda w: F.struct(w["longest"], w["start"], w["words"], _mins(_shingles(w["words"]), bands).alias("mins"))

    def verified(w):
        meets = lambda t: (t["longest"] == w["longest"]) & F.exists(F.zip_with(t["mins"], w["mins"], lambda a, b: a == b), lambda x: x)
        share = lambda t: F.size(F.array_intersect(t["shingles"], _shingles(w["words"]))) / F.size(t["shingles"])
        return F.transform(F.filter(known, meets), lambda t: F.struct(
            t["name"].alias("name"), share(t).alias("containment"), w["start"].alias("start")
        ))

    def fullest(best, m):
        """The better of each template's matches so far and one more."""
        same = F.filter(best, lambda b: b["name"] == m["name"])
        better = F.size(F.filter(same, lambda b: b["containment"] >= m["containment"])) == 0
        rest = F.filter(best, lambda b: b["name"] != m["name"])
        return F.when(better, F.concat(rest, F.array(m))).otherwise(best)

    rows = docs.select("doc_id", F.when(F.rlike(lowered, phrases), words).alias("words"))
    rows = rows.withColumn("windows", F.concat(*[windows(n) for n in size_classes(templates)]))
    rows = rows.withColumn("windows", F.filter("windows", lambda w: F.rlike(F.array_join(w["words"], " "), phrases)))
    rows = rows.withColumn("windows", F.transform("windows", signed))
    rows = rows.withColumn("matches", F.filter(F.flatten(F.transform("windows", verified)), lambda m: m["containment"] >= containment))
    matches = F.array_sort(F.aggregate("matches", none, fullest))
    return rows.select("doc_id", F.coalesce(matches, none).alias("matches"))
