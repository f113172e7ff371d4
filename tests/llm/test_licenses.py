import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.llm import license_rules, licenses
from tests.llm.conftest import DOCUMENT, rows

BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    places = [(k, label) for p, label in BASE.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
    starts = [k for k, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(w), len(places), min(starts, default=None), max(starts, default=None), labels


def digest(df):
    return licenses.summary(licenses.scan(df))


def test_base_places_equal_brute_force(documents):
    found = {r.doc_id: r for r in digest(documents).collect()}
    for r in documents.collect():
        f = found[r.doc_id]
        assert (f.n_words, f.n_base, f.first_word, f.last_word, f.base_labels) == brute(r.text)
        assert set(f.base_labels.split(",")) <= set(f.labels.split(",")) | {""} and 0 <= f.score <= 1


# Text, labels of the rules alone.
CASES = [
    ("Released under the MIT License.", "mit"),
    ("Licensed under the Apache License, Version 2.0.", "apache-2"),
    ("SPDX-License-Identifier: Apache-2.0", "apache-2"),
    ("SPDX-License-Identifier: GPL-3.0-only", "gpl-3"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
    ("licensed under the GNU Lesser General Public License version 2.1", "lgpl-2.1"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc-4"),
    ("licensed under a Creative Commons Attribution-ShareAlike 3.0 licence", "cc-by-sa-3"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this", "mit"),
    ("the Mozilla Public License applies", "mpl"),
    ("All rights reserved.", "all-rights-reserved"),
    # The public-domain notice stands inside the text of the unlicense.
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("licensed under the two-clause BSD license", "bsd-2-clause"),
    ("published under the ISC licence", "isc"),
    ("License: Apache-2.0", "apache-2"),
    ('license = "MIT"', "mit"),
    ("GPL-3.0-only", "gpl-3"),
    ("CC BY-SA 4.0", "cc-by-sa-4"),
    ("under a CC BY 4.0 licence", "cc-by-4"),
    ("under the LGPL v2.1 or later", "lgpl-2.1"),
    ("Licence :: MPL 2.0", "mpl-2"),
    ("https://opensource.org/licenses/MIT", "mit"),
    ("http://www.gnu.org/licenses/gpl-2.0.html", "gpl-2"),
    ("If a copy of the MPL was not distributed with this file, You can obtain one at", "mpl-2"),
    ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "bsd"),
    ("GPL", ""),
    ("cc by the way", ""),
    ("version 2.0 of the program", ""),
    ("a driving license and 2 0 others", ""),
    ("the mit students", ""),
    ("Er geht mit dem Hund, sie mit der Katze; keine Lizenz.", ""),
    ("the license of the car", ""),
]


@pytest.mark.parametrize(("text", "labels"), CASES)
def test_rules(text, labels):
    region = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.translate(LOWER))
    found = licenses.resolve(licenses.match_rules(region))
    rules = licenses._rules()[0]
    assert ",".join(sorted({rules[n].label for _, _, n in found})) == labels


def test_every_match_holds_a_trigger_and_the_key():
    rules = licenses._rules()[0]
    assert len(rules) > 300
    for rule in rules:
        needed = license_rules.required(rule.expression.pattern[len(" (?:") : -len(")(?= )")])
        assert rule.key in needed and set(needed) & set(license_rules.TRIGGERS), rule


def test_containment():
    rules = licenses._rules()[0]
    weak = len(rules) - 1
    assert licenses.resolve([(3, 9, 0), (4, 6, weak), (8, 12, weak), (3, 9, 0)]) == [(3, 9, 0), (8, 12, weak)]


def quadratic(found):
    rules, kept = licenses._rules()[0], []
    for begin, end, number in sorted(set(found), key=lambda x: (rules[x[2]].priority, x[0] - x[1], x[0], x[2])):
        if not any(b <= begin and end <= e for b, e, _ in kept):
            kept.append((begin, end, number))
    return sorted(kept)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 9), st.integers(0, 1000)), max_size=60))
def test_containment_equals_comparing_all(matches):
    found = [(b, b + n, k) for b, n, k in matches]
    assert licenses.resolve(found) == quadratic(found)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(" ".join(t for t, _ in CASES).split()) | st.sampled_from(["mit license", "gpl 3 0"]), max_size=60))
def test_matches_equal_trying_every_rule_everywhere(texts):
    region = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", " ".join(texts).translate(LOWER))
    text, spaces = f" {' '.join(region)} ", [0]
    for word in region:
        spaces.append(spaces[-1] + len(word) + 1)
    expected = {
        (spaces.index(m.start()), spaces.index(m.end()) - 1, number)
        for number, rule in enumerate(licenses._rules()[0])
        for m in rule.expression.finditer(text)
    }
    assert set(licenses.match_rules(region)) == expected


def test_rules_differ():
    rules = licenses._rules()[0]
    assert len({r.expression.pattern for r in rules}) == len(rules)


def test_time_grows_with_the_number_of_matches(spark):
    """Three megabytes of licence phrases and nothing else."""
    text = " ".join(t for t, labels in CASES if labels)
    text = text * (3 * 2**20 // len(text))
    df = spark.createDataFrame([(1, text)], DOCUMENT.split(", lang")[0])
    digest(df.limit(0)).collect()
    started = time.perf_counter()
    (row,) = digest(df).collect()
    assert time.perf_counter() - started < 90
    assert set(row.labels.split(",")) >= {label for _, label in CASES if label}


def test_odd_documents(odd, clashing):
    found = rows(digest(odd))
    assert found == rows(digest(clashing))
    by_id = {r[0]: r for r in found}
    assert by_id[1][1:] == (0, 0, None, None, "", "", 0.0) == by_id[2][1:]
    assert digest(odd.limit(0)).collect() == []
