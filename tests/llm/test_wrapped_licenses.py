"""Licence texts wrapped at any width are found, and gaps count from the end of a sentence."""

import textwrap

import pytest

from karyolytics.llm import licenses


@pytest.mark.parametrize("rule", licenses.RULES, ids=lambda r: "+".join(r[1]))
def test_wrapped_at_any_width(rule):
    name, ids = rule
    text = ". ".join(licenses.SENTENCES[k][0].capitalize() for k in ids) + "."
    for width in (12, 20, 30, 38, 60, 80):
        wrapped = textwrap.fill(text, width, break_long_words=False)
        assert [(a, n) for a, _, n in licenses.match(licenses.sentence_ids(wrapped))] == [(name, len(ids))], width


def test_gap_from_the_end():
    s = licenses.SENTENCES
    grant = textwrap.fill(s["mit-grant"][0], 30)
    for lines, found in ((0, True), (5, True), (13, True), (14, False), (40, False)):
        got = licenses.match(licenses.sentence_ids("\n".join([grant, *["other words"] * lines, s["mit-notice"][0]])))
        assert bool(got) == found, lines


@pytest.mark.parametrize("text,want", [
    ("ISC License", "ISC"), ("Mozilla Public License 2.0", "MPL-2.0"), ("SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0-or-later"), ("// SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
    ("Licensed under the Eclipse Public License - v 2.0", None), ("Licensed under the Eclipse Public License 2.0.", "EPL-2.0"), ("Released under the GNU Affero General Public License, version 3.", "AGPL-3.0-only"),
    ("This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.", "LGPL-2.1-or-later"),
    ("A licence to print money.", None), ("She had a driving license.", None),
])
def test_names(text, want):
    assert [a for a, *_ in licenses.match(licenses.sentence_ids(text))] == ([want] if want else [])


def test_every_sentence_has_a_cue():
    assert all(any(c in x for c in licenses.CUES) for v in licenses.SENTENCES.values() for x in v)
