"""License texts in documents: MinHash bands over text windows, then exact containment.

Words are read in lower case and without punctuation; shingles are five words, or the whole
template where it is shorter. For a template of n words the windows are a quarter of its shingles
longer and start that far apart, so any passage as long as the template lies whole in one window.
A window holding 0.8 of the template's shingles then has a Jaccard similarity to it of at least
0.6, and with 16 bands of two MinHash values a band agrees with probability above 0.999. A window
without any shingle of a template cannot agree in a band and is not hashed.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.decontaminate import SHINGLE_WORDS, position_ranges
from paperloom.llm.shared import share
from paperloom.llm.text import Words, grams, mix, slices

CONTAINMENT = 0.8
BANDS, ROWS = 16, 2
_FILTER_BITS = 18
FOUND = "struct<license:string,start:bigint,words:bigint,containment:double>"

# License names with the statements and notices they are recognised by.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Released under MIT license.",
        "Licensed under MIT.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "SPDX-License-Identifier: MIT",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under Apache 2.0.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
        "REPRODUCTION, AND DISTRIBUTION",
        '"License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 '
        "through 9 of this document.",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, "
        "worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare "
        "Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such "
        "Derivative Works in Source or Object form.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "GPL-2.0": [
        "Licensed under GPLv2.",
        "Licensed under the GPLv2.",
        "This work is licensed under the GNU General Public License, version 2.",
        "The licenses for most software are designed to take away your freedom to share and change it. By contrast, "
        "the GNU General Public License is intended to guarantee your freedom to share and change free software--to "
        "make sure the software is free for all its users.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, "
        "or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-2.0",
    ],
    "GPL-3.0": [
        "Licensed under GPLv3.",
        "Licensed under the GPLv3.",
        "This work is licensed under the GNU General Public License, version 3.",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0",
    ],
    "GPL-2.0-only": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License version 2 as published by the Free Software Foundation.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; version 2 of the License.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "GPL-3.0-only": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, version 3 of the License.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, "
        "specifically designed to ensure cooperation with the community in the case of network server software.",
        "SPDX-License-Identifier: AGPL-3.0",
    ],
    "AGPL-3.0-only": ["SPDX-License-Identifier: AGPL-3.0-only"],
    "AGPL-3.0-or-later": ["SPDX-License-Identifier: AGPL-3.0-or-later"],
    "GPL-2.0-or-later": ["SPDX-License-Identifier: GPL-2.0-or-later"],
    "GPL-3.0-or-later": ["SPDX-License-Identifier: GPL-3.0-or-later"],
    "LGPL-2.1-only": ["SPDX-License-Identifier: LGPL-2.1-only"],
    "LGPL-2.1-or-later": ["SPDX-License-Identifier: LGPL-2.1-or-later"],
    "LGPL-3.0-only": ["SPDX-License-Identifier: LGPL-3.0-only"],
    "LGPL-3.0-or-later": ["SPDX-License-Identifier: LGPL-3.0-or-later"],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, "
        "or (at your option) any later version.",
        "SPDX-License-Identifier: LGPL-2.1",
    ],
    "LGPL-3.0": [
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
        "SPDX-License-Identifier: LGPL-3.0",
    ],
    "BSD-3-Clause": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "BSD-2-Clause": ["SPDX-License-Identifier: BSD-2-Clause"],
    "BSL-1.0": [
        "Boost Software License - Version 1.0 - August 17th, 2003",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        'and accompanying documentation covered by this license (the "Software") to use, reproduce, display, '
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software",
        "Distributed under the Boost Software License, Version 1.0.",
        "SPDX-License-Identifier: BSL-1.0",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
        "rights to this software to the public domain worldwide. This software is distributed without any warranty.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
        # The sentence that this license's own notice begins with.
        "All rights reserved. Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
        "Licensed under the BSD License.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ],
    "CC-BY-4.0": ["SPDX-License-Identifier: CC-BY-4.0", "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["SPDX-License-Identifier: CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["SPDX-License-Identifier: CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
    "Proprietary": ["All rights reserved."],
}


#: Licenses whose statements differ by a version or a word, or hold another's; only these dispute a passage.
FAMILY = {name: "GPL" if "GPL" in name else "CC" for name in TEMPLATES if "GPL" in name or name.startswith("CC")}
FAMILY |= {"BSD": "BSD", "Proprietary": "BSD"}


def minhash_bands(shingles: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """The band values of each row of shingle hashes; only valid shingles count."""
    keys = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    least = np.full((len(shingles), BANDS * ROWS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for number, key in enumerate(keys):
        values = np.where(valid, mix(shingles ^ key), np.iinfo(np.uint64).max)
        least[:, number] = values.min(axis=1)
    pairs = least.reshape(len(shingles), BANDS, ROWS)
    return mix(pairs[:, :, 0] * np.uint64(31) + pairs[:, :, 1] + np.arange(BANDS, dtype=np.uint64))


class SizeTemplates:
    """The templates with one number of words."""

    def __init__(self, words: int, templates: list[tuple[str, np.ndarray]]):
        self.words, self.width = words, min(SHINGLE_WORDS, words)
        self.names = [name for name, _ in templates]
        self.shingles = [np.unique(grams(hashes, self.width)) for _, hashes in templates]
        self.known = np.unique(np.concatenate(self.shingles))
        self.step = max(1, (words - self.width) // 4)
        self.window = words + self.step - 1
        self.bands: dict[int, list[int]] = {}
        for number, own in enumerate(self.shingles):
            for value in minhash_bands(own[None, :], np.ones((1, len(own)), dtype=bool))[0]:
                self.bands.setdefault(int(value), []).append(number)
        self.values = np.array(sorted(self.bands), dtype=np.uint64)

    def windows(self, hits: np.ndarray, text: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows that a hit lies in, and their texts; windows start on steps from their text's first word."""
        reach = self.window - self.width
        offset = hits - first[text]
        low = np.maximum(0, -(-(offset - reach) // self.step))
        high = offset // self.step + 1
        steps, owner = position_ranges(low, high)
        starts = first[text[owner]] + steps * self.step
        starts, place = np.unique(starts, return_index=True)
        return starts, text[owner][place]


def _undisputed(found: dict[str, list[tuple]]) -> list[dict]:
    """The best window of each license, without those that another license of its family fits better.

    A window is disputed when more than half of its matched shingles stand between the first and
    last matched shingle of a window of that other license with a larger share, or an equal share of
    a longer template. A license goes only when all its windows are disputed.
    """

    shares = {name: np.array([w[0][0] for w in windows]) for name, windows in found.items()}
    sizes = {name: np.array([w[0][1] for w in windows]) for name, windows in found.items()}
    ranges = {name: np.array([(w[3][0], w[3][-1] + 1) for w in windows]) for name, windows in found.items()}

    def disputed(name: str, rank: tuple, places: np.ndarray) -> bool:
        for other in found:
            if other != name and FAMILY.get(other, other) == FAMILY.get(name, name):
                better = (shares[other] > rank[0]) | ((shares[other] == rank[0]) & (sizes[other] > rank[1]))
                low, high = np.searchsorted(places, ranges[other][better].T)
                if (2 * (high - low) > len(places)).any():
                    return True
        return False

    listed = []
    for name, windows in sorted(found.items()):
        for rank, start, length, places in sorted(windows, key=lambda w: w[0], reverse=True):
            if not disputed(name, rank, places):
                listed.append({"license": name, "start": start, "words": length, "containment": rank[0]})
                break
    return listed


class LicenseIndex:
    """Templates by number of words."""

    def __init__(self, templates: dict[str, list[str]]):
        rows = [(name, text) for name, texts in templates.items() for text in texts]
        words = Words(pa.array([text for _, text in rows], pa.string()), "plain")
        hashes, sizes = words.hashes(), {}
        for row, (name, _) in enumerate(rows):
            own = hashes[words.first[row] : words.first[row + 1]]
            if len(own):
                sizes.setdefault(len(own), []).append((name, own))
        self.sizes = [SizeTemplates(n, found) for n, found in sorted(sizes.items())]
        self.filters = {s.width: np.zeros(1 << _FILTER_BITS, dtype=bool) for s in self.sizes}
        for size in self.sizes:
            self.filters[size.width][size.known >> np.uint64(64 - _FILTER_BITS)] = True

    def find(self, texts: pa.Array, threshold: float) -> list[list[dict]]:
        """For each text its licenses, each with its best undisputed window, the first of equal ones."""
        words = Words(texts, "plain")
        hashes, first = words.hashes(), words.first
        text_of, found = words.text_of(), [{} for _ in range(words.texts)]
        spots = {}
        for width, maybe in self.filters.items():
            all_grams = grams(hashes, width)
            place = np.flatnonzero(maybe[all_grams >> np.uint64(64 - _FILTER_BITS)])
            place = place[place + width <= first[text_of[place] + 1]]
            spots[width] = (all_grams, place)
        for size in self.sizes:
            all_grams, place = spots[size.width]
            hits = place[np.isin(all_grams[place], size.known)]
            starts, owner = size.windows(hits, text_of[hits], first)
            across = np.arange(size.window - size.width + 1)
            for at in range(0, len(starts), 4096):
                some, text = starts[at : at + 4096], owner[at : at + 4096]
                spot = some[:, None] + across
                valid = spot + size.width <= first[text + 1][:, None]
                shingles = all_grams[np.minimum(spot, max(0, len(all_grams) - 1))]
                bands = minhash_bands(shingles, valid)
                agreed = np.isin(bands, size.values)
                for window in np.flatnonzero(agreed.any(axis=1)):
                    own = shingles[window][valid[window]]
                    for number in {n for b in bands[window][agreed[window]] for n in size.bands[int(b)]}:
                        share = float(np.isin(size.shingles[number], own).mean())
                        name = size.names[number]
                        start = int(some[window] - first[text[window]])
                        rank = (share, size.words, -start)
                        if share >= threshold - 1e-12:
                            length = min(size.window, int(first[text[window] + 1] - some[window]))
                            places = start + np.flatnonzero(valid[window] & np.isin(shingles[window], size.shingles[number]))
                            found[text[window]].setdefault(name, []).append((rank, start, length, places))
        return [_undisputed(own) for own in found]


def with_licenses(
    docs: DataFrame,
    text: str = "text",
    templates: dict[str, list[str]] | None = None,
    threshold: float = CONTAINMENT,
    licenses: str = "licenses",
) -> DataFrame:
    """The documents with the licenses their whole texts state or hold, an array of ``FOUND``.

    A license is listed once per document, with the window that holds most of one of its templates:
    the window's first word (counted from 0), its number of words, and the share of the template's
    distinct shingles in it. Where two licenses of one family, such as two versions, match the same
    passage, only the one with the larger share is listed; any other license is kept. NULL or empty texts hold none. Repeated rows are searched each for
    itself, other columns are kept, one named like ``licenses`` is replaced. Documents are not moved;
    the templates are a fixed list of a few pages.
    """
    docs = docs.drop(licenses)
    names = docs.columns
    shared = share(docs.sparkSession, LicenseIndex(TEMPLATES if templates is None else templates))
    keys = ["license", "start", "words", "containment"]
    kind = pa.list_(pa.struct(list(zip(keys, [pa.string(), pa.int64(), pa.int64(), pa.float64()]))))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared()
        for batch in batches:
            for part in slices(batch, text):
                found = pa.array(index.find(part.column(text), threshold), kind)
                yield pa.RecordBatch.from_arrays([*part.columns, found], [*names, licenses])

    return docs.mapInArrow(search, docs.withColumn(licenses, F.array().cast(f"array<{FOUND}>")).schema)
