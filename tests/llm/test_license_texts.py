import pyarrow as pa
import pytest
from conftest import SMALL

from paperloom.llm import licenses

GPL2 = licenses.TEMPLATES["GPL-2.0"][1]
GPL3 = licenses.TEMPLATES["GPL-3.0"][1]
INDEX = licenses.LicenseIndex(licenses.TEMPLATES)


def names(text):
    return [found["license"] for found in INDEX.find(pa.array([text]), licenses.CONTAINMENT)[0]]


def test_verified_licenses_of_other_families_stay():
    gpl = GPL2.replace("This program", "Foo")
    assert names(f"All rights reserved. {gpl}") == ["GPL-2.0", "Proprietary"]
    assert names(f"Released under the MIT License. {gpl.replace('or (at', 'or else (at')}") == ["GPL-2.0", "MIT"]


def test_versions_dispute_a_passage_but_not_each_other_elsewhere():
    assert names("This work is licensed under the GNU General Public License, version 3.") == ["GPL-3.0"]
    assert names(f"{GPL2} {GPL3}") == ["GPL-2.0", "GPL-3.0"]
    assert names("Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0.") == ["CC-BY-4.0", "CC-BY-SA-4.0"]
    # A better version elsewhere in the text does not hide a passage of its own.
    assert names("This work is licensed under the GNU General Public License, version 3. " + "word " * 99 + GPL2) == ["GPL-2.0", "GPL-3.0"]


@pytest.mark.parametrize("name", ["GPL-2.0-only", "GPL-3.0-only", "AGPL-3.0", "LGPL-2.1", "LGPL-3.0", "BSD-3-Clause", "EPL-2.0", "CC0-1.0"])
def test_notices_are_told_apart(name):
    for notice in licenses.TEMPLATES[name]:
        assert names(f"Here begins a file. {notice} Here it goes on.") == [name]
    for known in ("MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0"):
        assert all(names(f"Here begins a file. {notice} Here it goes on.") == [known] for notice in licenses.TEMPLATES[known])


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("SPDX-License-Identifier: BSD-3-Clause", ["BSD-3-Clause"]),
        ("SPDX-License-Identifier: BSD-2-Clause", ["BSD-2-Clause"]),
        ("// SPDX-License-Identifier: ISC\n", ["ISC"]),
        ("SPDX-License-Identifier: CC-BY-4.0", ["CC-BY-4.0"]),
        ("SPDX-License-Identifier: GPL-2.0-or-later", ["GPL-2.0-or-later"]),
        ("SPDX-License-Identifier: LGPL-2.1-only", ["LGPL-2.1-only"]),
        ("SPDX-License-Identifier: AGPL-3.0-only", ["AGPL-3.0-only"]),
        ("Released under MIT license", ["MIT"]),
        ("Licensed under GPLv3", ["GPL-3.0"]),
        ("Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/\n\nTERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION", ["Apache-2.0"]),
        ("Distributed under the Boost Software License, Version 1.0.", ["BSL-1.0"]),
        ("Copyright (c) 2020 Foo. All rights reserved. Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", ["BSD"]),
        ("All rights reserved.", ["Proprietary"]),
    ],
)
def test_statements_are_named(text, want):
    assert names(text) == want
    assert names("Some words before it. " + text + "\nAnd some after it.") == want


def test_a_reservation_elsewhere_stays_beside_bsd():
    header = licenses.TEMPLATES["BSD"][0]
    assert names(f"All rights reserved. {header}") == ["BSD"]
    assert names(f"{header} " + "word " * 60 + "All rights reserved.") == ["BSD", "Proprietary"]


def shingles(words):
    width = min(licenses.SHINGLE_WORDS, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def plain(text):
    return "".join(c if ord(c) > 127 or c.isalnum() else " " for c in text.translate({65 + i: 97 + i for i in range(26)})).split(" ")


def test_documents_against_every_window(spark):
    """Each template against every run of as many words of each document that holds one of its shingles."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: {x.license for x in r.licenses} for r in licenses.with_licenses(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()}
    known = [(name, [w for w in plain(t) if w]) for name, texts in licenses.TEMPLATES.items() for t in texts]
    family, seen = licenses.FAMILY, 0
    for row in rows:
        words, held = [w for w in plain(row.text or "") if w], set()
        every = {n: shingles(words[:0]) | {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} for n in {min(5, len(t)) for _, t in known}}
        for name, template in known:
            own, width = shingles(template), min(5, len(template))
            if len(own & every[width]) < 0.8 * len(own):
                continue
            size = len(template)
            if any(len(own & shingles(words[i : i + size])) >= 0.8 * len(own) for i in range(max(1, len(words) - size + 1))):
                held.add(name)
        seen += bool(held)
        missed = held - found[row.doc_id]
        assert all(any(family.get(m, m) == family.get(f, f) for f in found[row.doc_id]) for m in missed), row.doc_id
        assert not found[row.doc_id] or held or found[row.doc_id] <= {n for n, t in known if len(shingles(t) & every[min(5, len(t))]) >= 0.8 * len(shingles(t))}
    assert seen > 5
