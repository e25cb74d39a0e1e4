"""Licence scan of a tree of files: sparse TF-IDF cosine to templates, then inheritance along directories.

Every line of a file that holds a cue word, and every stretch of words, across line ends, that lies around a cue word as
a template does, is compared with the licence templates, as sparse vectors of term counts weighted by inverse document
frequency; the frequencies are counted over all files. The best template at ``THRESHOLD`` or more is the file's own
licence; a full text, which tells licences with a common beginning apart, goes before short forms. A licence or notice file speaks for its directory: a file without a licence of its
own takes that of the nearest directory above it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campflow.llm.common import free_name, stage, utf8_texts

THRESHOLD = 0.75

#: Short forms of public licences, as headers state them.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met.",
        "Use of this source code is governed by a BSD-style license.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "Licensed under the Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "Licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "Licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
}
_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES,"
    " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
    " DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
    " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
    " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,"
    " WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE"
    " OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of"
    " conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright"
    " notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided"
    " with the distribution. "
)


def _gnu(kind: str, version: str) -> str:
    return (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General"
        f" Public License as published by the Free Software Foundation, either version {version} of the License, or (at"
        " your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY"
        " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU"
        f" {kind}General Public License for more details."
    )


#: Full texts and headers, without the copyright line.
FULL: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
        " to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above"
        " copyright notice and this permission notice shall be included in all copies or substantial portions of the"
        " Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT"
        " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT"
        " SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION"
        " OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER"
        " DEALINGS IN THE SOFTWARE.",
    ),
    "BSD-2-Clause": (_BSD + _AS_IS,),
    "BSD-3-Clause": (
        _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or"
        " promote products derived from this software without specific prior written permission. " + _AS_IS,
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
        " \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the"
        " specific language governing permissions and limitations under the License.",
    ),
    "GPL-3.0": (_gnu("", "3"),),
    "GPL-2.0": (_gnu("", "2"),),
    "LGPL-3.0": (_gnu("Lesser ", "3"),),
    "LGPL-2.1": (_gnu("Lesser ", "2.1"),),
    "AGPL-3.0": (_gnu("Affero ", "3"),),
}
#: The heads of licence files.
HEADS: dict[str, tuple[str, ...]] = {
    "MIT": ("The MIT License (MIT)", "MIT License"),
    "GPL-3.0": ("GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",),
    "GPL-2.0": ("GNU GENERAL PUBLIC LICENSE Version 2, June 1991",),
    "LGPL-3.0": ("GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",),
    "LGPL-2.1": ("GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",),
    "AGPL-3.0": ("GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",),
    "Apache-2.0": ("Apache License Version 2.0, January 2004",),
    "MPL-2.0": ("Mozilla Public License Version 2.0",),
    "BSD-2-Clause": ("BSD 2-Clause License",),
    "BSD-3-Clause": ("BSD 3-Clause License",),
}
#: Shorter templates are compared with whole lines only: in running text they are names.
WINDOW_WORDS = 4
#: Fixed: a line is looked at if one of these begins a word of it.
CUES = r"licen[cs]|spdx|redistribut|permission|permitted|copyright"
_CUE = re.compile(rf"\b(?:{CUES})".encode(), re.IGNORECASE)
#: Fixed: names of files that speak for their directory.
NOTICE = r"^(?:licen[cs]e|copying|notice|unlicense)(?:[.\-].*)?$"
_CUE_WORD = re.compile(CUES)
_TERM = re.compile(r"[^\W_]+(?:\.[0-9]+)*")


def terms(text: str) -> list[str]:
    """Lower-case words and version numbers, and the pairs of neighbours."""
    return _with_pairs(_TERM.findall(text.lower()))


def _with_pairs(words: list[str]) -> list[str]:
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def _vocabulary() -> set[str]:
    return {t for _, form, _ in _forms() for t in terms(form)}


def _forms() -> list[tuple[str, str, bool]]:
    """Name, text, and whether it is a full text."""
    return [(name, form, kind is FULL) for kind in (FULL, TEMPLATES, HEADS) for name, forms in kind.items() for form in forms]


def _cue_lines(text: bytes) -> list[str]:
    """The lines of a text that hold a cue. The whole text is searched; lines without a cue are not taken apart."""
    out, at = [], 0
    while hit := _CUE.search(text, at):
        begin, end = text.rfind(b"\n", 0, hit.start()) + 1, text.find(b"\n", hit.start())
        end = len(text) if end < 0 else end
        out.append(text[begin:end].decode("utf-8", "replace"))
        at = end
    return out


def term_frequencies(files: DataFrame) -> DataFrame:
    """``term, n``: in how many of all files a term of the templates appears; ``term`` null counts all files."""
    wanted = _vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: Counter[str | None] = Counter()
            for text in utf8_texts(batch.column(0)):
                n.update(wanted.intersection(terms(text.decode("utf-8", "replace"))))
                n[None] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["term", "n"])

    return files.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


class _Matcher:
    """Cosines of lines to the templates. A term that no template has weighs as one that a single file has."""

    def __init__(self, frequency: dict[str | None, int]) -> None:
        n = frequency.get(None, 0)
        self.rare = math.log((n + 1) / 2) + 1
        self.weight = {t: math.log((n + 1) / (frequency.get(t, 0) + 1)) + 1 for t in _vocabulary()}
        self.forms = [(name, self._vector(terms(form)), full) for name, form, full in _forms()]
        self.places: list[tuple[int, dict[str, list[int]]]] = []  # number of words, and where cue words stand
        for _, form, _ in _forms():
            words = _TERM.findall(form.lower())
            cues: dict[str, list[int]] = {}
            for i, w in enumerate(words if len(words) >= WINDOW_WORDS else []):
                if _CUE_WORD.match(w):
                    cues.setdefault(w, []).append(i)
            self.places.append((len(words), cues))

    def _vector(self, found: list[str]) -> dict[str, float]:
        counts = Counter(found)
        v = {t: n * self.weight.get(t, self.rare) for t, n in counts.items()}
        size = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {t: x / size for t, x in v.items()}

    def best(self, lines: list[str], text: str = "") -> tuple[str | None, float]:
        """The best of ``lines``, compared whole, and of the windows of ``text``."""
        top: dict[bool, tuple[float, str | None]] = {True: (0.0, None), False: (0.0, None)}

        def compare(v: dict[str, float], name: str, form: dict[str, float], full: bool) -> None:
            score, (most, now) = sum(x * v[t] for t, x in form.items() if t in v), top[full]
            if score > most + 1e-12 or (abs(score - most) <= 1e-12 and now is not None and name < now):
                top[full] = (score, name)

        for line in dict.fromkeys(lines):
            v = self._vector(terms(line))
            for form in self.forms:
                compare(v, *form)
        words = _TERM.findall(text.lower())
        cues = [(i, w) for i, w in enumerate(words) if _CUE_WORD.match(w)]
        for form, (n, places) in zip(self.forms, self.places):
            # a window lies so that a cue word of the text is at the place of the same word in the template
            for begin in {i - place for i, w in cues for place in places.get(w, ())}:
                compare(self._vector(_with_pairs(words[max(begin, 0) : max(begin + n, 0)])), *form)
        score, name = top[True] if top[True][0] >= THRESHOLD else max(top.values(), key=lambda found: found[0])
        return (name if score >= THRESHOLD else None), score

    def of_text(self, text: bytes) -> tuple[str | None, float]:
        lines = _cue_lines(text)
        return self.best(lines, text.decode("utf-8", "replace")) if lines else (None, 0.0)


def own_licences(files: DataFrame) -> DataFrame:
    """``files`` without ``text``, with ``own_licence`` (null: none) and ``score``, the best cosine."""
    frequency = {row.term: row.n for row in term_frequencies(files).collect()}  # as many as the templates have terms
    named = free_name(files, "_found")

    def run(texts: pd.Series) -> pd.DataFrame:
        matcher = _Matcher(frequency)
        found = [matcher.of_text((t or "").encode()) for t in texts]
        return pd.DataFrame(found, columns=["own_licence", "score"])

    out = files.withColumn(named, F.pandas_udf(run, "own_licence string, score double")("text"))
    return out.withColumns({c: F.col(f"{named}.{c}") for c in ("own_licence", "score")}).drop(named, "text")


def scan(files: DataFrame) -> DataFrame:
    """``files`` (path, text) without ``text``, with ``own_licence, score, licence, inherited_from``.

    ``licence`` is the file's own, or else that of the notice files of the nearest directory above it that has one,
    which ``inherited_from`` names (empty: the root). Where notice files of a directory differ, the name that comes first in the alphabet
    stands. Null and empty texts have no licence of their own. Null paths have no directory and inherit nothing. Rows
    that repeat a path are treated one by one; extra columns are carried, those with the name of a new one replaced.
    """
    found = stage(own_licences(files), "own_licences")
    directory = F.regexp_replace("path", "/?[^/]*$", "")
    name = F.lower(F.regexp_extract("path", "[^/]*$", 0))
    spoken = (
        found.filter(name.rlike(NOTICE) & F.col("own_licence").isNotNull())
        .groupBy(directory.alias("above")).agg(F.min("own_licence").alias("licence"))
    )
    parts = F.split("directory", "/")
    ways = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    dirs = found.select(directory.alias("directory")).filter("directory is not null").distinct()
    near = (
        dirs.select("directory", F.explode(F.array_distinct(ways)).alias("above")).join(stage(spoken, "notices"), "above")
        .groupBy("directory").agg(F.max_by(F.struct("licence", "above"), F.length("above")).alias("near"))
    )
    inner = free_name(found, "_directory")
    given = near.select(F.col("directory").alias(inner), F.col("near").alias(free_name(found, "_near")))
    out = found.join(stage(given, "inherited"), directory == F.col(inner), "left")
    near_column = F.col(given.columns[1])
    return out.withColumns({
        "licence": F.coalesce("own_licence", near_column["licence"]),
        "inherited_from": F.when(F.col("own_licence").isNull(), near_column["above"]),
    }).drop(*given.columns)
