"""License scans: MinHash bands over overlapping windows of text retrieve templates, exact containment verifies them.

Words are runs of letters and digits in lower case, shingles are five words (a shorter template is one shingle of all
its words). For a template of T shingles the text is covered by windows that start every T / 4 shingles and are long
enough (1.5 T and up to a step more) that a notice of up to 1.2 T shingles lies whole in one. A window that holds at
least 80 % of the template's shingles has a similarity of at least 0.8 / 1.95 = 0.41 with it, so with 24 bands of one row
it is missed with probability (1 - 0.41)**24 = 3e-6 at most.
A template that shares a band with a window is verified by exact containment
of its shingles in the window. Only windows that hold one of the shingles at which a template takes its minimum hashes
can share a band, so the hashes of other windows are never computed.

Licenses share wordings, so at a place the template wins of which most shingles are there: a window that holds a template
in part gives way to a hit of another template that holds more shingles on more than half of its words. Whole templates
are always reported.

Only ``TEMPLATES`` are found: notices, short wordings, SPDX lines and a characteristic passage of whole license texts.

Defined results: very long texts are scanned whole, window by window; null and empty texts match nothing; rows that are equal or share an id are scanned each and reported
once an id and license; null ids are reported with a null id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import odd_multipliers, small_batches, word_codes

SHINGLE = 5
PERCENT = 80
BANDS = 24

#: Notices as their licenses word them.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-text": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "GPL-3.0-text": "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
    "GPL-2.0-text": "By contrast, the GNU General Public License is intended to guarantee your freedom to share and change free software--to make sure the software is free for all its users.",
    "AGPL-3.0-text": "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software.",
    "LGPL-3.0-text": "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below.",
    "LGPL-2.1-text": "By contrast, the GNU General Public Licenses are intended to guarantee your freedom to share and change free software--to make sure the software is free for all its users.",
    "Apache-2.0-text": "\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document. \"Licensor\" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "EPL-2.0-text": "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (\"AGREEMENT\"). ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT.",
    **{
        f"CC-{code}-text": f"This work is licensed under a Creative Commons {name} 4.0 International License." for code, name in (
            ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
    },
    **{f"CC-{code}-4.0": f"Licensed under CC {code} 4.0." for code in ("BY-ND", "BY-NC-SA", "BY-NC-ND")},
    **{
        f"{name}-{verb}{number}": f"{verb} under the {wording}" for verb in ("licensed", "distributed", "released", "available")
        for name, wordings in {
            "MIT": ["MIT License"], "Apache-2.0": ["Apache License 2.0", "Apache 2.0 License"], "ISC": ["ISC License"],
            "BSD": ["BSD License"], "BSD-2-Clause": ["BSD 2-Clause License"], "BSD-3-Clause": ["BSD 3-Clause License"],
            "GPL-3.0": ["GPLv3", "GPL v3"], "GPL-2.0": ["GPLv2", "GPL v2"], "LGPL-3.0": ["LGPLv3", "LGPL v3"],
            "LGPL-2.1": ["LGPLv2.1", "LGPL v2.1"], "AGPL-3.0": ["AGPLv3", "AGPL v3"], "MPL-2.0": ["Mozilla Public License 2.0"],
            "EPL-2.0": ["Eclipse Public License 2.0"], "Unlicense": ["Unlicense"],
        }.items() for number, wording in enumerate(wordings) if (name, verb) != ("MIT", "released")
    },
    **{
        f"{name}-spdx": f"SPDX-License-Identifier: {name}" for name in (
            "MIT", "Apache-2.0", "GPL-3.0", "GPL-2.0", "LGPL-3.0", "LGPL-2.1", "AGPL-3.0", "MPL-2.0", "EPL-2.0", "ISC", "Unlicense",
            "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0")
    },
}

_WORD = re.compile(r"[^\W_]+")
_STEPS = np.array(odd_multipliers(SHINGLE, 21), np.uint64)
_A = np.array(odd_multipliers(BANDS, 22), np.uint64)


def _shingles(codes: np.ndarray, size: int) -> np.ndarray:
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = (out ^ codes[k: k + n]) * _STEPS[k]
        out ^= out >> np.uint64(29)
    return out


def _hashed(shingles: np.ndarray) -> np.ndarray:
    return ((shingles[None, :] * _A[:, None]) >> np.uint64(32)).astype(np.uint32)


class Scanner:
    """Finds templates in texts. Templates are grouped by shingle length and number of shingles."""

    def __init__(self, templates: dict[str, str], percent: int = PERCENT):
        self.percent = percent
        self.groups: dict[tuple[int, int], list[tuple[str, np.ndarray, np.ndarray, np.ndarray]]] = {}
        for name, text in sorted(templates.items()):
            words = _WORD.findall(text.lower())
            if words:
                size = min(SHINGLE, len(words))
                members = np.unique(_shingles(_codes(words), size))
                hashed = _hashed(members)
                self.groups.setdefault((size, len(members)), []).append((name, members, members[hashed.argmin(1)], hashed.min(1)))
        self.lookup = {
            size: np.unique(np.concatenate([t[2] for key, group in self.groups.items() if key[0] == size for t in group]))
            for size in {key[0] for key in self.groups}
        }

    def find(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(license, containment, first word, last word) of the best window of each license that wins at its place."""
        words = _WORD.findall(text.lower()) if text else []
        if not words:
            return []
        codes = _codes(words)
        shingles = {size: _shingles(codes, size) for size in self.lookup}
        spots = {size: np.flatnonzero(np.isin(x, self.lookup[size])) for size, x in shingles.items()}
        hits = []
        for (size, count), group in self.groups.items():
            if len(spots[size]):
                hits += [hit for t in group for hit in self._hits(shingles[size], spots[size], size, count, *t)]
        out: dict[str, tuple] = {}
        for hit in hits:
            name, held, count, first, last = hit
            beaten = held < count and any(
                other[1] > held and other[0] != name and 2 * (min(last, other[4]) - max(first, other[3]) + 1) > last - first + 1 for other in hits)
            if not beaten and (name not in out or held > out[name][1]):
                out[name] = hit
        return [(name, held / count, first, last) for name, held, count, first, last in out.values()]

    def _hits(self, shingles, spots, size, count, name, members, minimal, least):
        """The windows that hold enough of a template, among those that share a band with it."""
        step = max(1, count // 4)
        span = -(-(count + step - 1 + count // 5) // step)  # in steps
        last = spots[np.isin(shingles[spots], minimal)] // step
        starts = np.unique((last[:, None] - np.arange(span)[None, :]).ravel())
        out = []
        for start in starts[starts >= 0] * step:
            window = shingles[start: start + span * step]
            if not (_hashed(window).min(1) == least).any():
                continue
            inside = np.isin(window, members)
            held = len(np.unique(window[inside]))
            if 100 * held >= self.percent * count:
                at = np.flatnonzero(inside) + start
                out.append((name, held, count, int(at[0]), int(at[-1]) + size - 1))
        return out


def _codes(words: list[str]) -> np.ndarray:
    return word_codes([w.encode() for w in words])


def scan_licenses(documents: DataFrame, templates: dict[str, str] = TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """doc_id, license, containment, first_word and last_word, a row an id and license."""
    small_batches(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType

    def scan(batches):
        scanner = Scanner(templates, percent)
        for batch in batches:
            yield pd.DataFrame(
                [(doc, *hit) for doc, text in zip(batch["doc_id"], batch["text"]) for hit in scanner.find(text)],
                columns=["doc_id", "license", "containment", "first_word", "last_word"],
            ).astype({"containment": float, "first_word": "int32", "last_word": "int32"})

    texts = documents.select(F.col("doc_id").cast("string"), "text").filter(F.col("text").isNotNull())  # null ids stay null
    hits = texts.mapInPandas(scan, "doc_id string, license string, containment double, first_word int, last_word int")
    order = F.struct((-F.col("containment")).alias("_less"), "first_word", "last_word", "containment")
    best = hits.withColumn("doc_id", F.col("doc_id").cast(kind)).groupBy("doc_id", "license").agg(F.min(order).alias("_hit"))
    return best.select("doc_id", "license", "_hit.containment", "_hit.first_word", "_hit.last_word")
