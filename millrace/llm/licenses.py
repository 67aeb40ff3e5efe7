"""License scans: MinHash over overlapping windows retrieves templates, exact shingle containment verifies them.

Templates are sorted into size classes by their number of shingles. For a class of up to s shingles, a text is read
in windows of 2s shingles that start every s shingles, so any stretch of up to s shingles lies whole in one window.
A window that holds at least ``least`` of a template has a Jaccard similarity of at least

    j = least * t / (2s + t - least * t)

with it, t being the template's distinct shingles. With bands of one row, the chance that none of b bands meets is
(1 - j) ** b; b is chosen so that this stays under ``miss`` for the smallest j of any template. Windows that meet a
template in a band are then verified on the words themselves: every run of up to s shingles that holds enough of the
template's distinct shingles, and one with each of its version words, is a stretch. Licenses of a family share most of
their words, so of stretches that overlap the one with the highest containment counts; stretches apart from each other
are rows of their own.

Words are lower-cased and freed of punctuation at both ends. One pass in Arrow batches, no shuffle; minima of windows
come from minima of blocks, so a text costs a few array operations per band whatever its length.

Defined cases: a text that is null or has no word has no match and no row. At equal containment the stretch that holds
more shingles counts, then the shorter, the first, and the license first by name. Repeated rows are scanned each. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from math import ceil, log, log2

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.shingles import mixed, slices, split_words, word_hashes
from millrace.llm.text import ship

#: Notices by which works are licensed, as their stewards word them.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "MIT-0": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    "Apache-1.1": (
        "This product includes software developed by the Apache Software Foundation (http://www.apache.org/).",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    "GPL-1.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 1, or (at your option) any later "
        "version.",
    ),
    "LGPL-2.0": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at "
        "your option) any later version.",
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version.",
    ),
    "LGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ),
    "GFDL-1.2": (
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free "
        "Documentation License, Version 1.2 or any later version published by the Free Software Foundation;",
    ),
    "GFDL-1.3": (
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free "
        "Documentation License, Version 1.3 or any later version published by the Free Software Foundation;",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission.",
    ),
    "BSD-4-Clause": (
        "All advertising materials mentioning features or use of this software must display the following "
        "acknowledgement: This product includes software developed by",
    ),
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "PostgreSQL": (
        "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without "
        "fee, and without a written agreement is hereby granted, provided that the above copyright notice and this "
        "paragraph and the following two paragraphs appear in all copies.",
    ),
    "Zlib": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions:",
    ),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        'and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, '
        "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit "
        "third-parties to whom the Software is furnished to do so, all subject to the following:",
    ),
    "MPL-1.1": (
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not "
        "use this file except in compliance with the License.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "EPL-1.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "v1.0 which accompanies this distribution",
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    "CDDL-1.0": (
        "The contents of this file are subject to the terms of the Common Development and Distribution License (the "
        '"License"). You may not use this file except in compliance with the License.',
    ),
    "EUPL-1.2": (
        "Licensed under the EUPL, Version 1.2 or - as soon they will be approved by the European Commission - subsequent "
        'versions of the EUPL (the "Licence"); You may not use this work except in compliance with the Licence.',
    ),
    "Artistic-2.0": (
        "you can redistribute it and/or modify it under the terms of the Artistic License 2.0.",
    ),
    "OFL-1.1": ("This Font Software is licensed under the SIL Open Font License, Version 1.1.",),
    "AFL-3.0": ("Licensed under the Academic Free License version 3.0",),
    "CC0-1.0": (
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights "
        "to this software to the public domain worldwide. This software is distributed without any warranty.",
        "has waived all copyright and related or neighboring rights to this work.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-ND-4.0": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "CC-BY-NC-SA-4.0": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-ND-4.0": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ),
    "CC-BY-3.0": ("This work is licensed under a Creative Commons Attribution 3.0 Unported License.",),
    "CC-BY-SA-3.0": ("This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}

#: Words of a template that tell versions of a license apart.
VERSION = re.compile(r"v?[0-9][0-9.]*")
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
#: A window's value in a band where it has no shingle.
NOTHING = np.uint64((1 << 64) - 1)


@dataclass(frozen=True)
class Settings:
    words: int = 3
    least: float = 0.8
    miss: float = 1e-4


PRODUCTION = Settings()


def plain_words(text: str) -> list[str]:
    return [w for w in (EDGES.sub("", x) for x in text.lower().split()) if w]


def grams(words: list[str], k: int) -> list[tuple[str, ...]]:
    return list(zip(*(words[i:] for i in range(k)), strict=False))


@dataclass(frozen=True)
class Template:
    license: str
    number: int
    shingles: frozenset
    length: int

    @cached_property
    def versions(self) -> list[frozenset]:
        """For each version word, the shingles that hold it."""
        words = sorted({w for g in self.shingles for w in g if VERSION.fullmatch(w)})
        return [frozenset(g for g in self.shingles if w in g) for w in words]

    @property
    def step(self) -> int:
        """Shingles of the size class, repeats included: the next power of two."""
        return 1 << ceil(log2(self.length))


def bands(settings: Settings, templates: list[Template]) -> int:
    """One-row bands needed for every template, from its own size."""
    worst = 1.0
    for t in templates:
        have = settings.least * len(t.shingles)
        worst = min(worst, have / (2 * t.step + len(t.shingles) - have))
    return ceil(log(settings.miss) / log(1 - worst))


def collision(settings: Settings, template: Template, n: int) -> float:
    """The least chance that a window with enough of the template meets it in one of n bands."""
    have = settings.least * len(template.shingles)
    return 1 - (1 - have / (2 * template.step + len(template.shingles) - have)) ** n


@dataclass(frozen=True)
class Stretch:
    """A run of words that holds enough of a template."""

    license: str
    number: int
    held: int
    share: float
    first: int
    n_words: int


def stretches(settings: Settings, template: Template, words: list[str], place: int) -> Iterator[Stretch]:
    """From every shingle of the template in ``words``: the run of at most ``step`` shingles, up to the last new one.

    A run counts if it holds enough of the template, and a shingle of each of its version words.
    """
    hits = [(i, g) for i, g in enumerate(grams(words, settings.words)) if g in template.shingles]
    size = len(template.shingles)
    if len({g for _, g in hits}) / size < settings.least:
        return
    for n, (first, _) in enumerate(hits):
        held, last = set(), first
        for i, g in hits[n : n + template.step]:
            if i >= first + template.step:
                break
            if g not in held:
                held.add(g)
                last = i
        if len(held) / size >= settings.least and all(v & held for v in template.versions):
            yield Stretch(template.license, template.number, len(held), len(held) / size, place + first, last + settings.words - first)


def best(found: Iterable[Stretch]) -> list[Stretch]:
    """Of stretches that overlap, the one with the highest containment; then the one that holds more, the shorter, the first."""
    starts: list[int] = []
    kept: list[Stretch] = []
    for s in sorted(found, key=lambda s: (-s.share, -s.held, s.n_words, s.first, s.license, s.number)):
        at = bisect(starts, s.first)
        if (at == 0 or kept[at - 1].first + kept[at - 1].n_words <= s.first) and (at == len(kept) or s.first + s.n_words <= starts[at]):
            starts.insert(at, s.first)
            kept.insert(at, s)
    return kept


class Scanner:
    def __init__(self, settings: Settings, templates: dict[str, tuple[str, ...]]) -> None:
        self.settings = settings
        self.templates = [
            Template(name, n, frozenset(own), len(own))
            for name, texts in templates.items()
            for n, t in enumerate(texts)
            if (own := grams(plain_words(t), settings.words))
        ]
        self.bands = bands(settings, self.templates)
        rng = np.random.default_rng(77)
        self.factors = rng.integers(1, 1 << 63, self.bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.steps = sorted({t.step for t in self.templates})
        self.minima: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for step in self.steps:
            own = [n for n, t in enumerate(self.templates) if t.step == step]
            hashes = [self.hashed(list(self.templates[n].shingles)) for n in own]
            self.minima[step] = []
            for f in self.factors:
                low = np.array([self.mix(h, f).min() for h in hashes])
                order = np.argsort(low)
                self.minima[step].append((low[order], np.array(own)[order]))

    def hashed(self, shingles: list[tuple[str, ...]]) -> np.ndarray:
        flat = np.array([w for s in shingles for w in s], dtype=object)
        each = pd.util.hash_array(flat, categorize=False).reshape(len(shingles), self.settings.words)
        return self.joined([each[:, k] for k in range(self.settings.words)])

    @staticmethod
    def joined(columns: list[np.ndarray]) -> np.ndarray:
        with np.errstate(over="ignore"):
            out = columns[0].copy()
            for c in columns[1:]:
                out = out * np.uint64(0x9DDFEA08EB382D69) + c
            return mixed(out)

    @staticmethod
    def mix(h: np.ndarray, factor: np.uint64) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = h * factor
            return x ^ (x >> np.uint64(31))

    def candidates(self, h: np.ndarray) -> set[tuple[int, int]]:
        """(first shingle of the window, template) of all that meet in a band; h: shingles of texts laid end to end."""
        out: set[tuple[int, int]] = set()
        if not len(h):
            return out
        for k, factor in enumerate(self.factors):
            low, size = self.mix(h, factor), 1
            for step in self.steps:
                while size < step:  # minima of blocks of twice the size
                    if len(low) % 2:
                        low = np.append(low, NOTHING)
                    low, size = np.minimum(low[::2], low[1::2]), 2 * size
                two = np.minimum(low, np.append(low[1:], NOTHING))
                keys, own = self.minima[step][k]
                at = np.minimum(np.searchsorted(keys, two), len(keys) - 1)
                for b in np.flatnonzero(keys[at] == two):
                    for n in own[keys == two[b]]:
                        out.add((int(b) * step, int(n)))
        return out

    def scan(self, texts: pa.Array) -> Iterator[tuple[int, str, int, float, int, int]]:
        """(text, license, template, containment, first word, words) of every stretch that is left after ``best``."""
        words, counts = self.words(texts)
        k = self.settings.words
        if len(words) < k:
            return
        h = word_hashes(words)
        h = self.joined([h[i : len(h) - k + 1 + i] for i in range(k)])
        ends = np.cumsum(counts)
        found: dict[int, set[Stretch]] = {}
        for first, n in self.candidates(h):
            t = self.templates[n]
            stop = min(first + 2 * t.step + k - 1, len(words))
            held = words.slice(first, stop - first)
            names = held.dictionary.take(held.indices).to_pylist()
            # A window may run over the end of a text: each text in it is looked at by itself.
            at = first
            while at < stop:
                doc = int(np.searchsorted(ends, at, "right"))
                end = min(stop, int(ends[doc]))
                place = at - int(ends[doc] - counts[doc])
                found.setdefault(doc, set()).update(stretches(self.settings, t, names[at - first : end - first], place))
                at = end
        for doc in sorted(found):
            for s in best(found[doc]):
                yield doc, s.license, s.number, s.share, s.first, s.n_words

    @staticmethod
    def words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        words, counts = split_words(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
        bare = [EDGES.sub("", w) for w in words.dictionary.to_pylist()]
        names, index = np.unique(np.array(bare, dtype=object), return_inverse=True) if bare else (np.array([], dtype=object), np.zeros(0, dtype=np.int64))
        each = index[words.indices.to_numpy(zero_copy_only=False)] if len(words) else index
        solid = np.array([bool(n) for n in names], dtype=bool)[each] if len(names) else np.zeros(0, dtype=bool)
        owner = np.repeat(np.arange(len(counts)), counts)
        counts = np.bincount(owner[solid], minlength=len(counts)).astype(np.int64)
        return pa.DictionaryArray.from_arrays(pa.array(each[solid].astype(np.int32)), pa.array(names.tolist(), pa.large_string())), counts


def scan(
    spark: SparkSession,
    docs: DataFrame,
    settings: Settings = PRODUCTION,
    templates: dict[str, tuple[str, ...]] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document and stretch: doc_id, license, template (its number), containment, first_word, n_words."""
    ship(spark)
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = dict(slim.dtypes)["doc_id"]

    def run(batches):
        scanner = Scanner(settings, templates or TEMPLATES)
        for batch in batches:
            for a, b in slices(batch.column(1)):
                rows = list(scanner.scan(batch.column(1).slice(a, b - a)))
                columns = list(zip(*rows, strict=True)) or [(), (), (), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).take(pa.array(columns[0], pa.int64())),
                        pa.array(columns[1], pa.string()),
                        pa.array(columns[2], pa.int32()),
                        pa.array(columns[3], pa.float64()),
                        pa.array(columns[4], pa.int64()),
                        pa.array(columns[5], pa.int64()),
                    ],
                    names=["doc_id", "license", "template", "containment", "first_word", "n_words"],
                )

    return slim.mapInArrow(run, f"doc_id {kind}, license string, template int, containment double, first_word long, n_words long")
