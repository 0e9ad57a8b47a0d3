"""Licence scan: Dice coefficients of word bigrams against licence templates.

A document is compared as a whole, by paragraphs (blank lines between) and by
lines. A unit is normalised (A-Z lower-cased, words of letters, digits and
non-ASCII characters) to its set U of word bigrams; with a template's set T its
Dice coefficient is 2|U and T| / (|U| + |T|). As |U and T| is at most the smaller
size, only templates of sizes from |U| t/(2-t) to |U| (2-t)/t can reach t: the
templates lie sorted by size and these bounds cut out the candidates. A unit is left
at once if the bigrams that it shares with all templates together are too few for
the least candidate, and a document if they are too few for each template.

Each unit names its best template (the first by name among equals) if that reaches
``THRESHOLD``. The templates are short notices, standard file headers and full texts,
fixed (150 kB); marks of comments are no words, so that they don't count. Texts are
read in one map without a shuffle.

A unit is a whole text, paragraph or line: of a notice within a longer line or
paragraph, or of several in one line, each is not looked for.

Defined results: NULL and empty texts, and units of fewer than two words, match
nothing; without a match ``licenses`` and ``best`` are empty and ``best_dice`` is 0;
repeated rows are judged row by row; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import ids_and_bytes
from strata.llm.decontaminate import words_of
from strata.llm.license_texts import TEXTS

THRESHOLD = 0.8
FOUND = "doc_id long, n_units long, licenses string, best string, best_dice double"
PARAGRAPH = re.compile(rb"\n[ \t\r]*\n")

# Notices of common licences, by SPDX name.
NOTICES = {
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3.",
                 "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License, or (at your option) any later version."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License."],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.",
                     "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["This work is dedicated to the public domain under CC0 1.0 Universal."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.",
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License, "
                "or (at your option) any later version."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "LGPL-2.1": ["This work is licensed under the GNU Lesser General Public License, version 2.1."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions:"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

TEMPLATES = {name: notices + TEXTS.get(name, []) for name, notices in NOTICES.items()}


def bigrams(words: list[bytes]) -> set[tuple[bytes, bytes]]:
    return set(zip(words, words[1:]))


class Scan:
    def __init__(self, templates: dict[str, list[str]], threshold: float):
        self.threshold = threshold
        own = [(bigrams(words_of(text.encode())), name) for name, texts in templates.items() for text in texts]
        self.templates = sorted(((len(b), name, b) for b, name in own), key=lambda t: t[:2])
        self.sizes = [size for size, _, _ in self.templates]
        self.every = frozenset().union(*(b for _, _, b in self.templates))
        #: so many of a template's bigrams are in every unit that reaches the threshold
        self.least = [size * threshold / (2 - threshold) - 1e-9 for size in self.sizes]

    def best(self, unit: bytes) -> tuple[float, str] | None:
        """(Dice, name) of the best template that reaches the threshold."""
        words = words_of(unit)
        shared = self.every.intersection(zip(words, words[1:]))
        if not shared:
            return None
        size, t = len(bigrams(words)), self.threshold
        low = bisect_left(self.sizes, size * t / (2 - t) - 1e-9)
        high = bisect_right(self.sizes, size * (2 - t) / t + 1e-9)
        if low >= high or 2.0 * len(shared) / (size + self.sizes[low]) < t:
            return None
        dice = [(2.0 * len(shared & b) / (size + n), name) for n, name, b in self.templates[low:high]]
        return min((d for d in dice if d[0] >= t), key=lambda d: (-d[0], d[1]), default=None)

    def document(self, data: bytes) -> list[tuple[float, str]]:
        words = words_of(data)
        shared = self.every.intersection(zip(words, words[1:]))
        fit = self.templates[:bisect_right(self.least, len(shared))]
        if not any(len(shared & b) >= least for (_, _, b), least in zip(fit, self.least)):
            return []
        lines, paragraphs = data.split(b"\n"), PARAGRAPH.split(data)
        units = [data] + (paragraphs if len(paragraphs) > 1 else []) + (lines if len(lines) > 1 else [])
        return [b for b in map(self.best, units) if b]

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [self.document(x) for x in batch.column("data").to_pylist()]
            best = [min(f, key=lambda d: (-d[0], d[1]), default=(0.0, "")) for f in found]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(f) for f in found], pa.int64()),
                pa.array([",".join(sorted({n for _, n in f})) for f in found], pa.string()),
                pa.array([n for _, n in best], pa.string()), pa.array([d for d, _ in best], pa.float64())],
                names=["doc_id", "n_units", "licenses", "best", "best_dice"])


def scan(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_units (units that match), licenses (names, comma-joined), best,
    best_dice: one row per document."""
    return ids_and_bytes(docs).mapInArrow(Scan(templates, threshold), FOUND)
