"""Licence scan: normalised text against licence templates by Dice coefficient.

Text is lower-cased and cut into words of ASCII letters and digits; a word of three or
more digits becomes ``#``, so years do not matter but versions do. A segment and a
template are compared by their sets of word bigrams: 2 * common / (size + size). A
document's segments are its lines, its paragraphs (between empty lines), the whole text,
and for each template every run of the template's own number of words that begins with
one of its bigrams (the text's end may cut it short), so a notice is found inside a line
and across lines. A match must also hold the template's ``must`` words: those of the
licence's name, which tell licences apart whose texts differ in one word.

At a threshold t only templates of between t / (2 - t) and (2 - t) / t times a
segment's size can match, and a match has at least t * m / (2 - t) bigrams of a
template of m; both bounds prune exactly, before sets are compared.

Cases: a null text counts as empty; segments of fewer than two words have no bigrams
and match nothing; among equal coefficients the template of more words wins, then the
first id; very long texts are scanned whole; repeated rows are scanned each; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fraudlake.llm.common import offsets_of, text_slices
from fraudlake.llm.words import BASE, mix, word_hashes, words_of


class Template(NamedTuple):
    name: str
    text: str
    must: tuple[str, ...]


# fixed values: SPDX ids of public licences and the names that projects give them
NAMES = {
    "0BSD": ["the Zero-Clause BSD License", "the BSD Zero Clause License"],
    "AGPL-3.0": ["the GNU Affero General Public License, version 3", "the GNU Affero General Public License v3.0", "the GNU AGPL v3", "AGPLv3"],
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License", "Apache 2.0"],
    "Artistic-2.0": ["the Artistic License 2.0"],
    "BSD-2-Clause": ["the BSD 2-Clause License", "the Simplified BSD License", "the BSD 2-Clause \"Simplified\" License"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "the New BSD License", "the BSD 3-Clause \"New\" or \"Revised\" License"],
    "BSL-1.0": ["the Boost Software License, Version 1.0"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "the Creative Commons CC0 1.0 Universal Public Domain Dedication"],
    "EPL-1.0": ["the Eclipse Public License 1.0", "the Eclipse Public License v1.0"],
    "EPL-2.0": ["the Eclipse Public License 2.0", "the Eclipse Public License v2.0"],
    "EUPL-1.2": ["the European Union Public Licence 1.2", "the EUPL 1.2"],
    "GPL-2.0": ["the GNU General Public License, version 2", "the GNU General Public License v2.0", "the GNU GPL v2", "GPLv2"],
    "GPL-3.0": ["the GNU General Public License, version 3", "the GNU General Public License v3.0", "the GNU GPL v3", "GPLv3"],
    "ISC": ["the ISC License"],
    "LGPL-2.0": ["the GNU Library General Public License, version 2", "the GNU Library General Public License v2.0", "the GNU LGPL v2"],
    "LGPL-2.1": ["the GNU Lesser General Public License, version 2.1", "the GNU Lesser General Public License v2.1", "the GNU LGPL v2.1", "LGPLv2.1"],
    "LGPL-3.0": ["the GNU Lesser General Public License, version 3", "the GNU Lesser General Public License v3.0", "the GNU LGPL v3", "LGPLv3"],
    "MIT": ["the MIT License", "the MIT Licence", "the Expat License"],
    "MPL-1.1": ["the Mozilla Public License 1.1", "the Mozilla Public License, version 1.1"],
    "MPL-2.0": ["the Mozilla Public License 2.0", "the Mozilla Public License, version 2.0", "the Mozilla Public License, v. 2.0"],
    "Unlicense": ["the Unlicense"],
    "Zlib": ["the zlib License", "the zlib/libpng License"],
}
CC_PARTS = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
CC_KINDS = ["BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"]
CC_VERSIONS = {"2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}
WORDINGS = ["Licensed under {}", "Released under {}", "Distributed under {}", "Available under {}", "under the terms of {}"]
PLAIN = {"the", "a", "license", "licence", "version", "v"}

# fixed values: public licence texts and notices, whole or the passages that mark them
PASSAGES = [
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", ("affero",)),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", ("affero", "3")),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION", ("apache",)),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.', ("apache",)),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0', ("apache",)),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\"", ()),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", ("neither", "endorse")),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\"", ("neither", "endorse")),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003", ("boost",)),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal", ("cc0",)),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", ("waived",)),
    ("EPL-1.0", "Eclipse Public License - v 1.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE", ("eclipse", "1")),
    ("EPL-2.0", "Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE", ("eclipse", "2")),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0", ("eclipse", "2")),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", ("2",)),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", ("general", "2")),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", ("3", "29")),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", ("general", "3")),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", ()),
    ("LGPL-2.0", "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991", ("library", "2")),
    ("LGPL-2.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", ("general", "2")),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", ("lesser",)),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", ("lesser", "2")),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", ("lesser", "3")),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", ("lesser", "3")),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.', ()),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License.", ("mozilla", "1")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", ("mozilla", "2")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("mozilla", "2")),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", ("unencumbered",)),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.", ("authors",)),
]


def plain_words(text: str) -> list[str]:
    """The normalised words of one text."""
    return ["#" if re.fullmatch("[0-9]{3,}", w) else w for w in re.findall("[a-z0-9]+", text.lower())]


def licence_names() -> dict[str, list[str]]:
    """Names by id: the fixed ones and the Creative Commons family by its parts."""
    out = dict(NAMES)
    for version, reach in CC_VERSIONS.items():
        for kind in CC_KINDS:
            long = "-".join(CC_PARTS[p] for p in kind.split("-"))
            titles = [f"Creative Commons {long} {version}", f"Creative Commons {long} {version} {reach}"]
            out[f"CC-{kind}-{version}"] = [f"CC {kind} {version}", *(f"{a} {t} License" for t in titles for a in ("the", "a"))]
    return out


def all_templates() -> list[Template]:
    """Every name in every wording, SPDX lines, and the passages; a text stands once."""
    rows = [(k, w.format(n), tuple(sorted(set(plain_words(n)) - PLAIN))) for k, names in licence_names().items() for n in names for w in WORDINGS]
    rows += [(k, f"SPDX-License-Identifier: {k}", tuple(sorted(set(plain_words(k))))) for k in licence_names()]
    return [Template(*r) for r in {tuple(plain_words(r[1])): r for r in rows + PASSAGES}.values()]


TEMPLATES = all_templates()
SCHEMA = "doc_id long, license_id string, dice double, line_matches long"
NUMBER = mix(np.array([2], dtype=np.uint64))


def _word_table() -> np.ndarray:
    table = np.zeros(256, dtype=np.uint8)
    table[48:58] = table[97:123] = 1
    return table


def _hashed_words(texts: pa.Array):
    """Words and their hashes; words of three or more digits alone share one."""
    w = words_of(texts, _word_table())
    h = word_hashes(w)
    letters = np.concatenate([[0], np.cumsum(w.data > 57)])
    h[(letters[w.end] == letters[w.start]) & (w.end - w.start >= 3)] = NUMBER
    return w, h


def _grams(h: np.ndarray) -> np.ndarray:
    return mix(h[:-1] * BASE + h[1:])


def _paragraphs(breaks: np.ndarray, n: int) -> np.ndarray:
    """Starts of paragraphs: behind each pair of line breaks, pairs taken from the left."""
    starts, last = [], -2
    for at in breaks[:-1][np.diff(breaks) == 1].tolist():
        if at - last >= 2:
            starts.append(at + 2)
            last = at
    return np.array(starts, dtype=np.int64)


class Known:
    """The templates' bigram sets, and an index from each bigram to its templates."""

    def __init__(self, templates: list[Template], threshold: float):
        self.names = [t.name for t in templates]
        hashed = [_hashed_words(pa.array([t.text]))[1] for t in templates]
        self.words = np.array([len(h) for h in hashed], dtype=np.int64)
        self.sets = [set(_grams(h).tolist()) for h in hashed]
        self.must = [set(_hashed_words(pa.array([" ".join(t.must)]))[1].tolist()) for t in templates]
        self.size = np.array([len(g) for g in self.sets], dtype=np.int64)
        self.threshold = threshold
        # a little below the bound, so rounding never prunes a match
        self.need = np.maximum(1, np.ceil(self.size * threshold / (2 - threshold) - 1e-9)).astype(np.int64)
        pairs = sorted((g, k) for k, s in enumerate(self.sets) for g in s)
        grams = np.array([g for g, _ in pairs], dtype=np.uint64)
        self.owner = np.array([k for _, k in pairs], dtype=np.int64)
        self.every, first = np.unique(grams, return_index=True)
        self.first = np.append(first, len(grams))

    def dice(self, k: int, own: set, words: np.ndarray) -> float:
        """The coefficient of a segment's bigrams and template ``k``, 0 below the threshold."""
        m, s, t = len(self.sets[k]), len(own), self.threshold
        if m * t > s * (2 - t) + 1e-9 or s * t > m * (2 - t) + 1e-9:
            return 0.0
        dice = 2.0 * len(own & self.sets[k]) / (s + m)
        return dice if dice >= t and self.must[k].issubset(words.tolist()) else 0.0

    def hits(self, gram: np.ndarray, valid: np.ndarray):
        """(position, template) of every bigram that a template has."""
        at = np.minimum(np.searchsorted(self.every, gram), len(self.every) - 1)
        pos = np.flatnonzero((self.every[at] == gram) & valid)
        lo, n = self.first[at[pos]], self.first[at[pos] + 1] - self.first[at[pos]]
        inside = np.arange(n.sum()) - np.repeat(offsets_of(n)[:-1], n)
        return np.repeat(pos, n), self.owner[np.repeat(lo, n) + inside]


def _groups(key: np.ndarray, pos: np.ndarray, template: np.ndarray, known: Known):
    """(template, positions ascending) for each pair of key and template with enough hits."""
    order = np.lexsort((pos, template, key))
    key, pos, template = key[order], pos[order], template[order]
    new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (template[1:] != template[:-1])])) if len(key) else key
    stop = np.append(new[1:], len(key))
    for i in np.flatnonzero(stop - new >= known.need[template[new]]).tolist():
        yield int(template[new[i]]), pos[new[i] : stop[i]]


def scan(docs: DataFrame, templates: list[Template] = TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """(doc_id, license_id, dice, line_matches) of every document.

    ``license_id`` and ``dice``: the best match of any segment (null and 0 without one);
    ``line_matches``: lines that match a template as a whole.
    """

    def task(batches):
        known = Known(templates, threshold)
        for batch in batches:
            for part in text_slices(batch):
                w, h = _hashed_words(part.column("text"))
                n = part.num_rows
                best: list[tuple] = [(0.0, 0, "")] * n
                lines = np.zeros(n, dtype=np.int64)
                matched: set = set()  # first words of lines that match
                if len(h) > 1:
                    gram = _grams(h)
                    row = np.repeat(np.arange(n), np.diff(w.first))
                    pos, template = known.hits(gram, row[1:] == row[:-1])

                    def keep(dice, k, r):
                        best[r] = min(best[r], (-dice, -int(known.words[k]), known.names[k]))

                    breaks = np.flatnonzero(w.data == 10)
                    for kind, cuts in (("line", breaks), ("paragraph", _paragraphs(breaks, len(w.data))), ("text", breaks[:0])):
                        segment = row.astype(np.int64) * (len(cuts) + 1) + np.searchsorted(cuts, w.start, side="right")
                        first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
                        last = np.append(first[1:], len(h))  # words first..last-1 are the segment's
                        of = np.searchsorted(first, pos, side="right") - 1
                        inside = pos + 1 < last[of]
                        size = last[of] - first[of] - 1
                        inside &= size * (2 - threshold) + 1e-9 >= known.size[template] * threshold
                        seen, own = -1, set()
                        for k, at in _groups(of[inside], pos[inside], template[inside], known):
                            i = int(np.searchsorted(first, at[0], side="right")) - 1
                            if i != seen:
                                seen, own = i, set(gram[first[i] : last[i] - 1].tolist())
                            dice = known.dice(k, own, h[first[i] : last[i]])
                            if dice:
                                keep(dice, k, row[first[i]])
                                if kind == "line":
                                    matched.add(int(first[i]))
                    lines = np.bincount(row[sorted(matched)], minlength=n) if matched else lines
                    for k, at in _groups(row[pos], pos, template, known):
                        r = row[at[0]]
                        stop = np.minimum(at + known.words[k], w.first[r + 1])
                        # hits of the template in the window; no window can have more of its bigrams
                        reach = np.searchsorted(at, stop - 1) - np.arange(len(at))
                        top = 0.0
                        for i in np.argsort(-reach, kind="stable").tolist():
                            c = min(int(reach[i]), int(known.size[k]))
                            if c < known.need[k] or 2.0 * c / (c + known.size[k]) <= top:
                                break
                            dice = known.dice(k, set(gram[at[i] : stop[i] - 1].tolist()), h[at[i] : stop[i]])
                            if dice > top:
                                top = dice
                                keep(dice, k, r)
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        pa.array([name or None for *_, name in best], pa.string()),
                        pa.array([abs(d) for d, *_ in best], pa.float64()),
                        pa.array(lines, pa.int64()),
                    ],
                    names=["doc_id", "license_id", "dice", "line_matches"],
                )

    return docs.select("doc_id", "text").mapInArrow(task, SCHEMA)
