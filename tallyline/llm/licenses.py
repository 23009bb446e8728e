"""License scans: normalised text against license templates by the Dice coefficient over word bigrams.

Every line and every paragraph of a whole text is compared, unless it has none of the words without which no template can match. Dice of
t or more bounds the ratio of the two numbers of bigrams, so only templates of a fitting size are compared. Every sentence of the text is compared
too, and every window of as many words as a template has, if the text shares enough bigrams with that template at all. Everything is a
DataFrame expression.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least Dice coefficient of a match.
LEAST = 0.8

#: Statements and texts of common licenses.
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("all-rights-reserved", "All rights reserved."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included "
        'in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR '
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
        "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        'that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR '
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
        "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
        "THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the "
        "copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without "
        "specific prior written permission.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
        "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",
    ),
]
#: Identifiers of the SPDX list; each makes a template of a header line.
SPDX = [
    "MIT", "ISC", "Zlib", "Unlicense", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
    "GPL-3.0-or-later", "LGPL-3.0-only", "AGPL-3.0-only", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
]
TEMPLATES += [(name, f"SPDX-License-Identifier: {name}") for name in SPDX]


def normal(text: Column) -> Column:
    """Lower case, every run of other characters than letters and digits one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def bigrams(text: Column) -> Column:
    """Distinct word bigrams of a normalised text; one word alone counts as a bigram of its own."""
    words = F.filter(F.split(text, " "), lambda w: w != "")

    def pairs(w: Column) -> Column:
        return F.when(F.size(w) < 2, w).otherwise(
            F.array_distinct(F.transform(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1))))
        )

    return F.element_at(F.transform(F.array(words), pairs), 1)


def _plain_bigrams(text: str) -> list[str]:
    """What ``bigrams(normal(text))`` gives for a template, whose letters are those of ASCII; in order of first appearance."""
    words = [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]
    return list(dict.fromkeys(map(" ".join, zip(words[:-1], words[1:], strict=True)))) if len(words) > 1 else words


def _templates() -> Column:
    """An array of (license, grams, length: bigrams with repeats) that the optimizer folds into one constant: one JSON text, not thousands of expressions."""
    rows = []
    for name, text in TEMPLATES:
        n = len([w for w in re.split(r"[^a-z0-9]+", text.lower()) if w])
        rows.append({"license": name, "grams": _plain_bigrams(text), "length": n - 1})
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<license: string, grams: array<string>, length: int>>")


def _every_gram() -> Column:
    """All bigrams of all templates, each once, as one constant."""
    return F.from_json(F.lit(json.dumps(list(dict.fromkeys(g for _, text in TEMPLATES for g in _plain_bigrams(text))))), "array<string>")


def anchors(least: float = LEAST) -> list[str]:
    """Words of which every text that matches a template has at least one.

    A Dice coefficient of ``least`` leaves at most a share of 1 - least / (2 - least) of a template's bigrams missing. So if some of
    its words touch more bigrams than that, one of these words must be there. Long words are taken first.
    """
    out: set[str] = set()
    for _, text in TEMPLATES:
        words = [x for x in re.split(r"[^a-z0-9]+", text.lower()) if x]
        grams = set(zip(words[:-1], words[1:], strict=True)) or {(words[0],)}
        touched: set[tuple] = set()
        for w in sorted(set(words), key=lambda w: (w not in out, -len(w), w)):
            if len(touched) > len(grams) * (1 - least / (2 - least)):
                break
            out.add(w)
            touched |= {g for g in grams if w in g}
    return sorted(out)


def any_of(words: list[str]) -> str:
    """A pattern of any of some words, those of one first letter together, so that most places of a text fail at once."""
    letters = sorted({w[0] for w in words})
    return "|".join(f"{a}(?:{'|'.join(w[1:] for w in words if w[0] == a)})" for a in letters)


def best_match(unit: Column, least: float = LEAST) -> Column:
    """The best template for one piece of text as (dice, license), null if none reaches ``least``. Ties go to the later name."""
    ratio = least / (2 - least)

    def compare(grams: Column) -> Column:
        n = F.size(grams)
        fitting = F.filter(_templates(), lambda t: (F.size(t["grams"]) >= n * ratio) & (F.size(t["grams"]) * ratio <= n))
        scored = F.transform(
            fitting,
            lambda t: F.struct(
                (F.lit(2.0) * F.size(F.array_intersect(grams, t["grams"])) / (n + F.size(t["grams"]))).alias("dice"), t["license"].alias("license")
            ),
        )
        return F.array_max(F.filter(scored, lambda s: s["dice"] >= least))

    return F.element_at(F.transform(F.array(bigrams(normal(unit))), compare), 1)


def best_window(stretch: Column, least: float = LEAST) -> Column:
    """The best template for any window of a stretch as (dice, license), null if none reaches ``least``.

    Windows have a template's number of words, or are the whole of a shorter stretch. Dice of ``least`` needs a share of
    least / (2 - least) of the template's bigrams, so a stretch with fewer of them is left out, and so are windows with none.
    """
    ratio = least / (2 - least)
    known, every = _templates(), _every_gram()

    def bound(value: Column, then) -> Column:
        return F.element_at(F.transform(F.array(value), then), 1)

    def in_order(words: Column) -> Column:
        return F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda x, i: F.concat_ws(" ", x, F.get(words, i + 1)))

    def of_template(grams: Column, t: Column) -> Column:
        hits = F.filter(F.transform(grams, lambda g, i: F.when(F.array_contains(t["grams"], g), i)), lambda i: i.isNotNull())
        last = F.greatest(F.size(grams) - t["length"], F.lit(0))
        starts = F.array_distinct(F.flatten(F.transform(hits, lambda p: F.sequence(F.greatest(F.lit(0), F.least(p - t["length"] + 1, last)), F.least(p, last)))))
        dice = lambda w: F.lit(2.0) * F.size(F.array_intersect(w, t["grams"])) / (F.size(w) + F.size(t["grams"]))
        best = F.array_max(F.transform(starts, lambda at: bound(F.array_distinct(F.slice(grams, at + 1, t["length"])), dice)))
        return F.struct(best.alias("dice"), t["license"].alias("license"))

    def compare(grams: Column) -> Column:
        def among(shared: Column) -> Column:
            open_ = F.filter(known, lambda t: F.size(F.array_intersect(shared, t["grams"])) >= F.size(t["grams"]) * ratio)
            return F.array_max(F.filter(F.transform(open_, lambda t: of_template(grams, t)), lambda s: s["dice"] >= least))

        return bound(F.array_intersect(grams, every), among)

    return bound(bound(F.split(normal(stretch), " "), in_order), compare)


def scan(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, license and dice of the best match (null if none) and n_matches for every row.

    n_matches counts lines and paragraphs that match, and stretches between those in which a sentence or a window matches. Null and
    empty texts match nothing; repeated rows stay; columns other than doc_id and text are not read. A paragraph of one line counts
    once, as that line.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.split("text", "\n", -1)
    paragraphs = F.filter(F.split("text", r"\n[ \t\r]*\n", -1), lambda p: F.contains(F.trim(p), F.lit("\n")))
    # a regular expression over the text, then over each piece, spares most the splitting into bigrams
    word = rf"(?:^|[^\p{{L}}\p{{N}}])(?:{any_of(anchors(least))})(?![\p{{L}}\p{{N}}])"
    none = F.array().cast("array<string>")
    units = F.when(F.col("open"), F.filter(F.concat(paragraphs, lines), lambda u: F.lower(u).rlike(word))).otherwise(none)
    found = F.filter(F.transform(units, lambda u: F.struct(u.alias("unit"), best_match(u, least).alias("match"))), lambda m: m["match"].isNotNull())
    rows = docs.select("doc_id", text.alias("text"), F.lower(text).rlike(word).alias("open")).select("*", found.alias("found"))

    # the text without what matched: each line between line feeds of its own, the gaps marked by a character that is not in the text
    apart = lambda x: F.concat(F.lit("\n"), F.replace(x, F.lit("\n"), F.lit("\n\n")), F.lit("\n"))
    plain = apart(F.replace(F.col("text"), F.lit("\0"), F.lit(" ")))
    rest = F.aggregate("found", plain, lambda t, m: F.replace(t, apart(F.replace(m["unit"], F.lit("\0"), F.lit(" "))), F.lit("\n\0\n")))
    stretches = F.when(F.col("open"), F.filter(F.split(rest, "\0", -1), lambda x: F.lower(x).rlike(word))).otherwise(none)

    def inside(stretch: Column) -> Column:
        sentences = F.filter(F.split(stretch, r"(?<=[.!?;:])\s+", -1), lambda x: F.lower(x).rlike(word))
        return F.array_max(F.array_append(F.transform(sentences, lambda x: best_match(x, least)), best_window(stretch, least)))

    # the best match may cross lines that match less well; the count is of the stretches without them
    rows = rows.select("*", F.when(F.col("open"), inside(F.col("text"))).alias("whole"))
    apart_from = F.size(F.filter(F.transform(stretches, inside), lambda m: m.isNotNull()))
    best = F.array_max(F.array_append(F.transform("found", lambda m: m["match"]), F.col("whole")))
    more = F.when(F.size("found") > 0, apart_from).otherwise(F.col("whole").isNotNull().cast("int"))
    rows = rows.select("doc_id", best.alias("best"), (F.size("found") + more).cast("long").alias("n_matches"))
    return rows.select("doc_id", F.col("best")["license"].alias("license"), F.col("best")["dice"].alias("dice"), "n_matches")
