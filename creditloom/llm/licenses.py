"""License scans: normalised text against license templates, by Dice over word bigrams.

Text is put in lower case, and everything but letters, digits and line feeds becomes a blank. Its
lines, its paragraphs (cut at blank lines) and the text as a whole are compared with the templates:
twice the number of common distinct word bigrams, divided by the sum of both numbers.

Two sets can only reach the threshold if neither is much larger than the other. That gives each
template bounds on the number of bigrams; a part outside all bounds is left out before its bigrams
are made (by its number of words, and its number of distinct words, between which the number of
distinct bigrams lies), and a template is compared with parts inside its own bounds only. Parts of
equal words count once.

Everything is one projection per row, without a shuffle; the templates are a short list given by
the caller. Defined results: null and empty texts, and those of a single word, match nothing;
repeated rows are reported each; a template of under two words is refused. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Notices and full texts of public licenses.
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "MIT-notice": "Released under the MIT License.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR"
        " DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF"
        " MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,"
        " DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS"
        " OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS"
        " ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the \"Software\"), to deal in the Software"
        " without restriction, including without limitation the rights to use, copy, modify, merge,"
        " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons"
        " to whom the Software is furnished to do so, subject to the following conditions: The above"
        " copyright notice and this permission notice shall be included in all copies or substantial"
        " portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND,"
        " EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS"
        " FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT"
        " HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF"
        " CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR"
        " THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the"
        " terms of the GNU Affero General Public License as published by the Free Software"
        " Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this'
        " file except in compliance with the License. You may obtain a copy of the License at"
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met: 1. Redistributions of"
        " source code must retain the above copyright notice, this list of conditions and the"
        " following disclaimer. 2. Redistributions in binary form must reproduce the above"
        " copyright notice, this list of conditions and the following disclaimer in the"
        " documentation and/or other materials provided with the distribution. THIS SOFTWARE"
        ' IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR'
        " IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF"
        " MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT"
        " SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,"
        " INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED"
        " TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR"
        " BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN"
        " CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN"
        " ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH"
        " DAMAGE."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met: 1. Redistributions of"
        " source code must retain the above copyright notice, this list of conditions and the"
        " following disclaimer. 2. Redistributions in binary form must reproduce the above"
        " copyright notice, this list of conditions and the following disclaimer in the"
        " documentation and/or other materials provided with the distribution. 3. Neither the"
        " name of the copyright holder nor the names of its contributors may be used to"
        " endorse or promote products derived from this software without specific prior"
        " written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND"
        ' CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT'
        " LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR"
        " PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE"
        " LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL"
        " DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;"
        " LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY"
        " THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING"
        " NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF"
        " ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "CC-BY-4.0-text": (
        "This work is licensed under a Creative Commons Attribution 4.0 International"
        " License."
    ),
    "CC-BY-NC-4.0-text": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0"
        " International License."
    ),
    "CC-BY-ND-4.0-text": (
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0"
        " International License."
    ),
    "CC-BY-SA-4.0-text": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0"
        " International License."
    ),
    "GPL-2.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the"
        " terms of the GNU General Public License as published by the Free Software"
        " Foundation, either version 2 of the License, or (at your option) any later version."
    ),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the"
        " terms of the GNU General Public License as published by the Free Software"
        " Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "LGPL-2.1-header": (
        "This library is free software: you can redistribute it and/or modify it under the"
        " terms of the GNU Lesser General Public License as published by the Free Software"
        " Foundation, either version 2.1 of the License, or (at your option) any later"
        " version."
    ),
    "LGPL-3.0-header": (
        "This library is free software: you can redistribute it and/or modify it under the"
        " terms of the GNU Lesser General Public License as published by the Free Software"
        " Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
        " If a copy of the MPL was not distributed with this file, You can obtain one at"
        " https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is"
        " free to copy, modify, publish, use, compile, sell, or distribute this software,"
        " either in source code form or as a compiled binary, for any purpose, commercial or"
        " non-commercial, and by any means. In jurisdictions that recognize copyright laws,"
        " the author or authors of this software dedicate any and all copyright interest in"
        " the software to the public domain. We make this dedication for the benefit of the"
        " public at large and to the detriment of our heirs and successors. We intend this"
        " dedication to be an overt act of relinquishment in perpetuity of all present and"
        ' future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS'
        ' IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO'
        " THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND"
        " NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR"
        " OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,"
        " OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE"
        " SOFTWARE."
    ),
}


def template_bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a template, normalised as texts are."""
    words = re.sub(r"[\W_]+", " ", text.lower()).split()
    found = sorted({f"{a} {b}" for a, b in zip(words, words[1:])})
    if not found:
        raise ValueError("a template needs two words")
    return found


def size_bounds(number: int, threshold: float) -> tuple[int, int]:
    """Smallest and largest number of bigrams with which ``number`` ones can reach the threshold."""
    ratio = (2 - threshold) / threshold
    return math.ceil(number / ratio - 1e-9), math.floor(number * ratio + 1e-9)


def _parts(text: Column) -> Column:
    """Lines, paragraphs and whole of a normalised text, each once, as arrays of words.

    Only line feeds and single blanks separate words, so lines are cut at blanks, and paragraphs and
    the whole are put together from their lines.
    """

    def lines(part: Column) -> Column:
        return F.transform(F.split(part, "\n"), lambda line: F.trim(line))

    def together(part: Column) -> Column:
        return F.array_join(F.filter(lines(part), lambda line: line != ""), " ")

    paragraphs = F.transform(F.split(text, "\n *\n[ \n]*"), together)
    parts = F.array_distinct(F.concat(lines(text), paragraphs, F.array(together(text))))
    return F.transform(parts, lambda part: F.split(part, " "))


def _merged(bounds: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping ranges put together."""
    ranges: list[tuple[int, int]] = []
    for low, high in sorted(bounds):
        if ranges and low <= ranges[-1][1]:
            ranges[-1] = (ranges[-1][0], max(high, ranges[-1][1]))
        else:
            ranges.append((low, high))
    return ranges


def scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = 0.8,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``license_id``, ``dice`` and ``n_parts`` for each row and template it matches.

    ``dice`` is the largest over the parts of the text that reach the threshold, ``n_parts`` their
    number.
    """
    sets = {name: template_bigrams(value) for name, value in sorted(templates.items())}
    bounds = {name: size_bounds(len(found), threshold) for name, found in sets.items()}
    ranges = _merged(bounds.values())

    def possible(words: Column) -> Column:
        # the distinct bigrams number at most this, and at least the distinct words less one
        number = F.size(words) - 1
        distinct = F.size(F.array_distinct(words)) - 1
        inside = [(number >= a) & ((number <= b) | (distinct <= b)) for a, b in ranges]
        return reduce(or_, inside)

    def bigrams(words: Column) -> Column:
        number = F.size(words) - 1
        pairs = F.zip_with(
            F.slice(words, 1, number),
            F.slice(words, 2, number),
            lambda a, b: F.concat(a, F.lit(" "), b),
        )
        return F.array_distinct(pairs)

    normal = F.regexp_replace(
        F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), r"[^\p{L}\p{N}\n]+", " "
    )
    known = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.transform(F.filter(_parts(normal), possible), bigrams).alias("parts"),
    )

    def reached(name: str) -> Column:
        """The similarities of the parts that reach the threshold."""
        wanted = F.array(*(F.lit(b) for b in sets[name]))
        low, high = bounds[name]

        def dice(part: Column) -> Column:
            common = F.size(F.array_intersect(part, wanted))
            inside = (F.size(part) >= low) & (F.size(part) <= high)
            return F.when(inside, 2.0 * common / (F.size(part) + len(sets[name])))

        return F.filter(F.transform("parts", dice), lambda d: d >= threshold)

    # a projection of its own, so that nothing is computed again for each use
    found = known.select(
        "doc_id", *(reached(name).alias(f"reached_{k}") for k, name in enumerate(sets))
    )
    matches = F.array(
        *(
            F.struct(
                F.lit(name).alias("license_id"),
                F.array_max(f"reached_{k}").alias("dice"),
                F.size(f"reached_{k}").cast("long").alias("n_parts"),
            )
            for k, name in enumerate(sets)
        )
    )
    return found.select("doc_id", F.inline(F.filter(matches, lambda m: m["n_parts"] > 0)))
