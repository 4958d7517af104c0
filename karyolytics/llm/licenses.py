"""Licence scan by sentences and ordered rules.

A text is cut into sentences; each is normalised (lower case, words only, names of holders and years as placeholders) and
looked up among known licence sentences. The identifiers found, in order and with their places, are matched against
rules: sequences of identifiers that name a licence, tried longest first at each place, with at most 13 unknown
sentences or lines between the end of one and the next. Sentences that no rule takes are reported as unmatched evidence.

All known sentences hold a cue, so a text without any cue needs no cutting; that saves time and changes no result.

Cases: null and empty texts have no sentences; sentences of any length are read whole; repeated rows each have a row; a
licence found several times is listed once, in order of first place, with its count; an empty table gives an empty result;
columns other than identifier and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Known sentences in normalised form, by identifier. <v> stands for a version number, <who> for a holder.
SENTENCES = {
    "mit-name": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "distributed under the mit license", "the mit license", "mit license", "spdx license identifier mit"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "as-is": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement", "the software is provided as is without warranty of any kind"],
    "apache-2-name": ["licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license", "released under the apache license version 2 0", "apache license version 2 0", "this project is licensed under the apache license version 2 0", "spdx license identifier apache 2 0"],
    "apache-comply": ["you may not use this file except in compliance with the license"],
    "apache-copy": ["you may obtain a copy of the license at http www apache org licenses license 2 0", "you may obtain a copy of the license at"],
    "apache-basis": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "gpl-3-name": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "released under the gnu general public license version 3", "gnu general public license version 3", "spdx license identifier gpl 3 0 only"],
    "gpl-2-name": ["this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2", "gnu general public license version 2", "spdx license identifier gpl 2 0 only"],
    "gpl-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"],
    "gpl-hope": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "gpl-see": ["see the gnu general public license for more details"],
    "bsd-grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd-endorse": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd-name": ["licensed under the bsd license", "bsd license", "licensed under the bsd 3 clause license"],
    "cc-by": ["licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "cc-by-sa": ["licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "cc-by-nc": ["licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "cc0": ["licensed under cc0 1 0", "this work is dedicated to the public domain under cc0 1 0 universal license"],
    "mpl-2": ["this source code form is subject to the terms of the mozilla public license v 2 0", "licensed under the mozilla public license version 2 0"],
    "copyright": ["copyright <who>", "copyright c <who>"],
    "all-rights": ["all rights reserved copyright <who>"],
}
#: Ordered rules, each a licence and the identifiers that make it up.
RULES = [
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-name", "mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("Apache-2.0", ("apache-2-name", "apache-comply", "apache-copy", "apache-basis")),
    ("Apache-2.0", ("apache-2-name", "apache-comply")),
    ("GPL-or-later", ("gpl-free", "gpl-hope", "gpl-see")),
    ("GPL-or-later", ("gpl-free", "gpl-hope")),
    ("GPL-or-later", ("gpl-free",)),
    ("MIT", ("mit-name",)),
    ("Apache-2.0", ("apache-2-name",)),
    ("GPL-3.0", ("gpl-3-name",)),
    ("GPL-2.0", ("gpl-2-name",)),
    ("BSD", ("bsd-name",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC0-1.0", ("cc0",)),
    ("MPL-2.0", ("mpl-2",)),
]
#: Names of licences in normalised form, by SPDX identifier.
NAMES = {
    "MIT": ["mit license"],
    "ISC": ["isc license"],
    "Apache-2.0": ["apache license 2 0", "apache license version 2 0", "apache 2 0 license"],
    "GPL-2.0-only": ["gnu gpl version 2 license"],
    "GPL-2.0-or-later": ["gnu general public license version 2 or later", "gnu general public license v2 0 or later"],
    "GPL-3.0-only": ["gnu gpl version 3 license"],
    "GPL-3.0-or-later": ["gnu general public license version 3 or later", "gnu general public license v3 0 or later"],
    "LGPL-2.1-only": ["gnu lesser general public license version 2 1", "gnu lesser general public license v2 1"],
    "LGPL-2.1-or-later": ["gnu lesser general public license version 2 1 or later"],
    "LGPL-3.0-only": ["gnu lesser general public license version 3", "gnu lesser general public license v3 0"],
    "LGPL-3.0-or-later": ["gnu lesser general public license version 3 or later"],
    "AGPL-3.0-only": ["gnu affero general public license version 3", "gnu affero general public license v3 0"],
    "AGPL-3.0-or-later": ["gnu affero general public license version 3 or later"],
    "MPL-1.1": ["mozilla public license version 1 1", "mozilla public license 1 1"],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license 2 0"],
    "EPL-1.0": ["eclipse public license version 1 0", "eclipse public license 1 0", "eclipse public license v1 0"],
    "EPL-2.0": ["eclipse public license version 2 0", "eclipse public license 2 0", "eclipse public license v2 0"],
    "BSD-2-Clause": ["bsd 2 clause license", "simplified bsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "new bsd license", "revised bsd license"],
    "Unlicense": ["unlicense"],
    "Zlib": ["zlib license"],
    "BSL-1.0": ["boost software license version 1 0", "boost software license 1 0"],
    "Artistic-2.0": ["artistic license 2 0", "artistic license version 2 0"],
    "EUPL-1.2": ["european union public license version 1 2", "european union public license 1 2"],
    "CC0-1.0": ["cc0 1 0 universal license"],
    "CC-BY-4.0": ["creative commons attribution 4 0 international license"],
    "CC-BY-SA-4.0": ["creative commons attribution sharealike 4 0 international license"],
    "CC-BY-NC-4.0": ["creative commons attribution noncommercial 4 0 international license"],
    "CC-BY-ND-4.0": ["creative commons attribution noderivatives 4 0 international license"],
}
#: Sentences that name a licence.
NAMED = ["licensed under the {}", "released under the {}", "distributed under the {}", "published under the {}", "available under the {}", "licensed under the terms of the {}", "this project is licensed under the {}", "this work is licensed under the {}", "this software is licensed under the {}", "this file is licensed under the {}", "the {}", "{}"]
#: What a work of the free software foundation's licences says of itself.
OR_LATER = "this {} is free software you can redistribute it and or modify it under the terms of the gnu {} general public license as published by the free software foundation either version {} of the license or at your option any later version"
_TABLE = {s for v in SENTENCES.values() for s in v}
for _spdx, _names in NAMES.items():
    _made = [t.format(n) for n in _names for t in NAMED] + ["spdx license identifier " + " ".join(re.findall("[a-z0-9]+", _spdx.lower()))]
    if _kind := {"LG": "lesser", "AG": "affero"}.get(_spdx[:2]) if _spdx.endswith("or-later") else None:
        _made += [OR_LATER.format(w, _kind, _spdx.split("-")[1].removesuffix(".0").replace(".", " ")) for w in ("program", "library")]
    if _made := [s for s in dict.fromkeys(_made) if s not in _TABLE]:
        SENTENCES[f"name:{_spdx}"] = _made
        RULES.append((_spdx, (f"name:{_spdx}",)))
SENTENCES["isc-grant"] = ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"]
SENTENCES["unlicense-free"] = ["anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"]
SENTENCES["unlicense-domain"] = ["this is free and unencumbered software released into the public domain"]
RULES += [("ISC", ("isc-grant",)), ("Unlicense", ("unlicense-domain", "unlicense-free"))]
CUES = ("licens", "permi", "warrant", "copyright", "redistribut", "unencumbered", "anyone is free")
#: Places from the end of one sentence of a rule to the next one, at most: 13 unknown sentences or lines lie between them.
GAP = 14

_KNOWN = {s: k for k, v in SENTENCES.items() for s in v}
#: All beginnings of known sentences, by whole words.
_BEGINS = {" ".join(w[:n]) for w in map(str.split, _KNOWN) for n in range(1, len(w))}
_BREAK = re.compile(r"\n|(?<!\d)[.:;!?]+(?=\s|$)|(?<=\d)[.:;!?]+(?=\s|$)")
_WORD = re.compile(r"[a-z0-9]+")
_HOLDER = re.compile(r"^((?:all rights reserved )?copyright(?: c)?) .+$")
_BY_FIRST = {}
for _licence, _ids in sorted(RULES, key=lambda r: -len(r[1])):
    _BY_FIRST.setdefault(_ids[0], []).append((_licence, _ids))


def normalise(sentence: str) -> str:
    s = " ".join(_WORD.findall(sentence.lower()))
    return s if s in _KNOWN else _HOLDER.sub(r"\1 <who>", s)


def sentence_ids(text: str) -> list[tuple[int, str, int]]:
    """(first part, identifier, last part) of known sentences. They may run over any number of line ends: parts are joined
    as long as their words begin a known sentence, and the longest one counts.
    """
    if not any(c in (low := text.lower()) for c in CUES):
        return []
    parts = [s for s in _BREAK.split(low) if s.strip()]
    out, i = [], 0
    while i < len(parts):
        found = (i, got) if (got := _KNOWN.get(normalise(parts[i]))) is not None else None
        joined, k = " ".join(_WORD.findall(parts[i])), i
        while joined in _BEGINS and k + 1 < len(parts):
            k += 1
            joined = " ".join([joined, *_WORD.findall(parts[k])])
            if (got := _KNOWN.get(joined)) is not None:
                found = (k, got)
        if found:
            out.append((i, found[1], found[0]))
            i = found[0]
        i += 1
    return out


def match(ids: list[tuple[int, str, int]], gap: int = GAP) -> list[tuple[str, int, int]]:
    """(licence, first place, sentences) of rules in order; each sentence serves one rule."""
    out, i = [], 0
    while i < len(ids):
        for licence, rule in _BY_FIRST.get(ids[i][1], ()):
            if len(rule) <= len(ids) - i and all(ids[i + j][1] == rule[j] for j in range(len(rule))) and all(ids[i + j][0] - ids[i + j - 1][2] <= gap for j in range(1, len(rule))):
                out.append((licence, ids[i][0], len(rule)))
                i += len(rule)
                break
        else:
            i += 1
    return out


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_sentences (known ones), n_matches, n_unmatched, licenses (list of names joined by commas, with counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column(1).to_pylist():
                ids = sentence_ids(t or "")
                got = match(ids)
                names: dict[str, int] = {}
                for licence, _, _ in got:
                    names[licence] = names.get(licence, 0) + 1
                rows.append((len(ids), len(got), len(ids) - sum(k for *_, k in got), ",".join(f"{k}:{n}" for k, n in names.items())))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())], ["id", "n_sentences", "n_matches", "n_unmatched", "licenses"])

    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, "id long, n_sentences long, n_matches long, n_unmatched long, licenses string")
