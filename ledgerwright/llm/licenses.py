"""Licence scans: TF-IDF cosine of headers and licence files to templates, then the nearest directory's licence."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, by_value, durable, small_batches

#: Notices by which the licences announce themselves.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT"],
}
#: Longer headers and whole texts, over any number of lines: (text, terms that a block must have too).
BLOCKS = {
    "Apache-2.0": [(
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        {"apache", "2.0"},
    )],
    "BSD-3-Clause": [(
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission.",
        {"neither", "endorse"},
    )],
    "GPL-3.0": [(
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        {"gnu", "general", "3"},
    )],
    "MIT": [(
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        {"hereby", "granted", "sublicense"},
    )],
}
#: Titles, by which only a text that begins with one is licensed.
TITLES = {
    "Apache-2.0": ["Apache License Version 2.0, January 2004"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License"],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0 International"],
    "CC-BY-NC-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International"],
    "GPL-3.0": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "MIT": ["MIT License", "The MIT License"],
}
#: Terms of other licences that differ from a template by little else.
OTHERS = {"lesser", "library", "affero"}
#: Least cosine of a header to a template.
HEADER = 0.75
#: Names of files that license their directory and what is below it.
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice|unlicense)([.\-_].*)?$"
TERM = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")


def terms(text: str) -> list[str]:
    return TERM.findall(text.lower())


def listed() -> list[tuple[str, str, frozenset[str], bool]]:
    """(licence, text, terms needed, whether only the beginning counts) of all templates."""
    notices = [(name, n, frozenset(), False) for name, texts in TEMPLATES.items() for n in texts]
    blocks = [(name, n, frozenset(needed), False) for name, texts in BLOCKS.items() for n, needed in texts]
    return notices + blocks + [(name, n, frozenset(terms(n)), True) for name, texts in TITLES.items() for n in texts]


VOCABULARY = sorted({t for _, n, *_ in listed() for t in terms(n)})


class Templates:
    """Sparse TF-IDF vectors of the templates, over their own terms."""

    def __init__(self, idf: dict[str, float], other: float):
        self.idf, self.other = idf, other
        self.names = [name for name, notices in TEMPLATES.items() for _ in notices]
        self.vectors = [self.vector(n) for notices in TEMPLATES.values() for n in notices]
        #: All templates, the notices first: (licence, vector, number of terms, terms needed, only at the beginning).
        self.all = [(name, self.vector(n), len(terms(n)), needed, begins) for name, n, needed, begins in listed()]

    def vector(self, text: str) -> dict[str, float]:
        v = {t: n * self.idf.get(t, self.other) for t, n in Counter(terms(text)).items()}
        norm = sum(x * x for x in v.values()) ** 0.5
        return {t: x / norm for t, x in v.items()} if norm else {}

    def best(self, text: str) -> tuple[str | None, float]:
        """The template nearest to a line, and the cosine; of equal ones the first."""
        v = self.vector(text)
        cosines = [sum(x * v.get(t, 0.0) for t, x in w.items()) for w in self.vectors]
        k = int(np.argmax(cosines))
        return (self.names[k], cosines[k]) if cosines[k] > 0 else (None, 0.0)

    def reach(self, held: set[str], k: int) -> float:
        """The greatest cosine that terms among `held` can have with template k of all."""
        return sum(x * x for t, x in self.all[k][1].items() if t in held) ** 0.5

    def find(self, text: str, threshold: float) -> tuple[str | None, float]:
        """The licence nearest to any line or block of a text, and the cosine; (None, 0) if none can reach the threshold.

        A block is as many terms in a row as a template has, over any lines.
        """
        words = terms(text)
        held = set(words)
        may = [k for k in range(len(self.all)) if self.all[k][3] <= held and self.reach(held, k) >= threshold - 1e-9]
        if not may:
            return None, 0.0
        found: tuple[str | None, float] = (None, 0.0)
        for line in text.split("\n"):
            of_line = set(terms(line))
            if any(self.reach(of_line, k) >= threshold - 1e-9 for k in may if k < len(self.vectors)):
                got = self.best(line)
                if got[1] > found[1]:
                    found = got
        for k in may:
            name, vector, length, needed, begins = self.all[k]
            got = self.block(words[:length] if begins else words, vector, length, needed)
            if got > found[1] + 1e-9:
                found = (name, got)
        return found

    def block(self, words: list[str], vector: dict[str, float], length: int, needed: frozenset[str]) -> float:
        """The greatest cosine of `length` terms in a row that have the needed ones, and none of other licences."""
        weight = {t: self.idf.get(t, self.other) for t in set(words)}
        count: Counter[str] = Counter()
        best = dot = square = 0.0
        for i, t in enumerate(words):
            square += (2 * count[t] + 1) * weight[t] ** 2
            dot += weight[t] * vector.get(t, 0.0)
            count[t] += 1
            if i >= length:
                gone = words[i - length]
                square -= (2 * count[gone] - 1) * weight[gone] ** 2
                dot -= weight[gone] * vector.get(gone, 0.0)
                count[gone] -= 1
            if (i >= length - 1 or i == len(words) - 1) and dot > best * square**0.5:
                if all(count[n] for n in needed) and not (needed and any(count[o] for o in OTHERS)):
                    best = dot / square**0.5
        return best


def statistics(files: DataFrame, text_col: str) -> Templates:
    """Inverse document frequencies of the templates' terms over all the texts.

    Only the counts of the templates' own terms, a few dozen, come to the driver; every other
    term weighs as one that no text has.
    """
    small_batches(files.sparkSession)
    known = frozenset(VOCABULARY)

    @F.pandas_udf("array<string>")
    def held(text: pd.Series) -> pd.Series:
        return pd.Series([sorted(known.intersection(terms(t))) if isinstance(t, str) else [] for t in text], dtype=object)

    # the empty term stands for the text itself
    each = files.select(F.explode(F.concat(F.array(F.lit("")), held(F.col(f"`{text_col}`").cast("string")))).alias("term"))
    counts = {r["term"]: r["count"] for r in each.groupBy("term").count().collect()}
    total = counts.get("", 0)
    idf = {t: float(np.log((1 + total) / (1 + counts.get(t, 0))) + 1) for t in VOCABULARY}
    return Templates(idf, float(np.log(1 + total) + 1))


def scan(files: DataFrame, *, path_col: str = "path", text_col: str = "text", threshold: float = HEADER) -> DataFrame:
    """files with own_license, similarity, license and license_from (columns of these names are replaced).

    own_license: the template nearest to any line, or to any block of as many terms as the
    template has, of the whole text, if the cosine reaches the threshold; titles of licences count
    where a text begins with them. similarity: that cosine, or 0 where the text lacks the terms to
    reach the threshold with any template. Other files take the licence of the nearest directory above them that holds a
    licence file (by its name) with a licence of its own; of several in one directory the most
    similar counts, then the first by name. license_from: that directory, or the path itself.

    Distinct directories are joined with the licensed ones level by level upwards in one join;
    files are joined with what their directory got. Null texts have no licence of their own,
    files with a null path inherit none; repeated rows each get their result, and columns of other names stay.
    Very long texts are scanned whole, empty ones have no licence of their own, and an empty table gives an empty result.
    """
    small_batches(files.sparkSession)
    templates = statistics(files, text_col)

    @F.pandas_udf("name string, similarity double")
    def nearest(text: pd.Series) -> pd.DataFrame:
        out = []
        for t in text:
            out.append(templates.find(t, threshold) if isinstance(t, str) else (None, 0.0))
        return pd.DataFrame(out, columns=["name", "similarity"])

    path, text = F.col(f"`{path_col}`").cast("string"), F.col(f"`{text_col}`").cast("string")
    added = ("own_license", "similarity", "license", "license_from")
    kept = [c for c in files.columns if c in (path_col, text_col) or c not in added]
    own = files.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("file"), path.alias("path"), nearest(text).alias("near"))
    name = F.when(F.col("near.similarity") >= threshold, F.col("near.name"))
    parts = F.split("path", "/")
    folder = F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")
    marked = own.select("file", "path", name.alias("own_license"), F.col("near.similarity").alias("similarity"), folder.alias("license_dir"))

    grants = marked.where(F.element_at(parts, -1).rlike(LICENCE_FILE) & F.col("own_license").isNotNull())
    first = F.min(F.struct((-F.col("similarity")).alias("s"), F.col("path").alias("p"), F.col("own_license").alias("granted")))
    grants = durable(grants.groupBy(F.col("license_dir").alias("above")).agg(first.alias("x")).select("above", "x.granted"))
    up = F.split("license_dir", "/")
    every = F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(up)), lambda n: F.array_join(F.slice(up, 1, n), "/")))
    dirs = marked.select("license_dir").where("license_dir IS NOT NULL").distinct()
    above = dirs.select("license_dir", F.explode(F.array_distinct(every)).alias("above")).join(broadcast_if_small(grants), "above")
    near = above.groupBy("license_dir").agg(F.max(F.struct(F.length("above").alias("n"), "above", "granted")).alias("x"))
    near = durable(near.select("license_dir", "x.above", "x.granted"))
    out = marked.join(broadcast_if_small(near), "license_dir", "left").select(
        "file",
        "own_license",
        "similarity",
        F.coalesce("own_license", "granted").alias("license"),
        F.when(F.col("own_license").isNotNull(), F.col("path")).otherwise(F.col("above")).alias("license_from"),
    )
    return out.select("file.*", *[c for c in added if c not in kept])


by_value(__name__)
