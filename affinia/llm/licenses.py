"""Licence scans: known licence sentences, then ordered rules over the recognised sentences.

Known are the headers, notices or grants of Apache-2.0, MIT, ISC, BSD-2-Clause and BSD-3-Clause (with
any holder's name), Zlib, BSL-1.0, GPL-2.0 and 3.0 (only, or later), LGPL-2.1 and 3.0, AGPL-3.0,
MPL-2.0, EPL-2.0, CC-BY, CC-BY-SA and CC-BY-NC 4.0, CC0-1.0 and Unlicense, and SPDX lines that name
any of these; the bodies of the long licences are not.

A text is cut into sentences at line ends and at ``. ! ? ;`` or ``:`` followed by a blank, and once more with
single line ends taken as blanks, for sentences that run over lines. Every sentence is normalised
(A-Z to lower case, comment marks and everything but ASCII letters and digits to one blank) and
looked up among the known ones. The recognised identifiers, by their place in the text, form a
sequence; a rule names a licence by identifiers that must follow one another in that sequence.

Defined cases: null and empty texts have no sentences and no licence; repeated rows are answered
row by row; a licence found more than once is named once; empty tables give empty results; other
columns are carried or ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from affinia.llm.common import annotate

# Sentences of public licences and of the notices that name them.
SENTENCES = {
    "apache2-notice": "Licensed under the Apache License, Version 2.0",
    "apache2-header-1": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache2-header-2": "you may not use this file except in compliance with the License",
    "apache2-header-3": "You may obtain a copy of the License at",
    "apache2-header-4": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "apache2-header-5": "See the License for the specific language governing permissions and limitations under the License",
    "mit-notice": "Released under the MIT License",
    "mit-notice-2": "Licensed under the MIT License",
    "mit-title": "The MIT License (MIT)",
    "mit-title-2": "MIT License",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions',
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-warranty": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS',
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl-free": "This program is free software",
    "gpl3-only": "you can redistribute it and/or modify it under the terms of the GNU General Public License version 3 as published by the Free Software Foundation",
    "gpl2-only": "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
    "lgpl-free": "This library is free software",
    "lgpl-terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "lgpl3-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "agpl3-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl3-redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "gpl-details": "See the GNU General Public License for more details",
    "later-2": "either version 2 of the License, or (at your option) any later version",
    "later-2.1": "either version 2.1 of the License, or (at your option) any later version",
    "later-3": "either version 3 of the License, or (at your option) any later version",
    "epl2-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
    "zlib-warranty": "This software is provided 'as-is', without any express or implied warranty",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "bsl1-notice": "Distributed under the Boost Software License, Version 1.0",
    "bsl1-grant": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following',
    "cc0-title": "CC0 1.0 Universal",
    "mpl2-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mpl2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at",
    "cc-by-nc4-notice": "Licensed under CC BY-NC 4.0",
    "cc-by4-notice": "Licensed under CC BY 4.0",
    "cc-by-sa4-notice": "Licensed under CC BY-SA 4.0",
    "cc-by4-work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "unlicense-release": "This is free and unencumbered software released into the public domain",
    "unlicense-anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
}

# Fixed values: (licence, identifiers that must follow one another).
RULES = [
    ("Apache-2.0", ("apache2-notice",)),
    ("Apache-2.0", ("apache2-header-1", "apache2-header-2")),
    ("Apache-2.0", ("apache2-header-4", "apache2-header-5")),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-notice-2",)),
    ("MIT", ("mit-grant", "mit-condition")),
    ("ISC", ("isc-grant", "isc-warranty")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("GPL-3.0", ("gpl3-notice",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-redistribute")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-terms", "later-2")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-terms", "later-3")),
    ("GPL-3.0-only", ("gpl-free", "gpl3-only")),
    ("GPL-2.0-only", ("gpl-free", "gpl2-only")),
    ("LGPL-2.1-or-later", ("lgpl-free", "lgpl-terms", "later-2.1")),
    ("LGPL-3.0-or-later", ("lgpl-free", "lgpl-terms", "later-3")),
    ("LGPL-3.0-or-later", ("lgpl-free", "lgpl3-redistribute")),
    ("LGPL-3.0-or-later", ("gpl-free", "lgpl3-redistribute")),
    ("AGPL-3.0-or-later", ("gpl-free", "agpl3-redistribute")),
    ("EPL-2.0", ("epl2-terms",)),
    ("Zlib", ("zlib-warranty", "zlib-grant")),
    ("BSL-1.0", ("bsl1-notice",)),
    ("BSL-1.0", ("bsl1-grant",)),
    ("CC0-1.0", ("cc0-title",)),
    ("CC0-1.0", ("cc0-waiver",)),
    ("MPL-2.0", ("mpl2-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc4-notice",)),
    ("CC-BY-4.0", ("cc-by4-notice",)),
    ("CC-BY-4.0", ("cc-by4-work",)),
    ("CC-BY-SA-4.0", ("cc-by-sa4-notice",)),
    ("Unlicense", ("unlicense-release",)),
]

# Sentences with a name in them, after normalising.
PATTERNS = [
    ("bsd-endorse", "neither the name", re.compile(
        r"neither the names? of .{1,200} nor the names of (?:its|their|the) contributors may be used to endorse or "
        r"promote products derived from this software without specific prior written permission"
    )),
    ("cc0-waiver", "to the extent possible", re.compile(
        r"to the extent possible under law .{1,200} waived all copyright and related or neighboring rights to .{1,200}"
    )),
]
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([^\r\n]{1,200})")
_SPDX_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9.+-]*[A-Za-z0-9+]")
SPDX_NAMES = {licence.lower(): licence for licence, _ in RULES} | {
    "gpl-2.0": "GPL-2.0-only", "gpl-2.0+": "GPL-2.0-or-later", "gpl-3.0+": "GPL-3.0-or-later",
    "lgpl-2.1": "LGPL-2.1-only", "lgpl-2.1-only": "LGPL-2.1-only", "lgpl-2.1+": "LGPL-2.1-or-later",
    "lgpl-3.0": "LGPL-3.0-only", "lgpl-3.0-only": "LGPL-3.0-only", "lgpl-3.0+": "LGPL-3.0-or-later",
    "agpl-3.0": "AGPL-3.0-only", "agpl-3.0-only": "AGPL-3.0-only",
}
RULES += [(licence, (f"spdx-{licence}",)) for licence in sorted(set(SPDX_NAMES.values()))]

_BREAK = r"[.!?;:]+(?=[ \t\r\n]|$)"
_MARK = r"[ \t]*(?:#+|//+|\*+|;+|--+)?[ \t]*"  # of a comment line
_LINES = re.compile(_BREAK + r"|[\r\n]+")
_WRAPPED = re.compile(_BREAK + rf"|\r?\n(?:{_MARK}\r?\n)+")
_WRAP_MARKS = re.compile(r"\r?\n" + _MARK)
_OTHER = re.compile(r"[^a-z0-9]+")


def normalised(sentence: str) -> str:
    """Lower case, every run of other characters than ASCII letters and digits one blank."""
    return _OTHER.sub(" ", sentence.encode().lower().decode()).strip()


KNOWN: dict[str, str] = {}
for _name, _text in SENTENCES.items():
    # A known sentence may itself hold breaks ("... Foundation; either version 2 ..."): the text is
    # cut there, so the sentence is known by its longest piece.
    KNOWN.setdefault(max(map(normalised, _LINES.split(_text)), key=len), _name)
LONGEST = max(map(len, KNOWN))


def sentences(text: str) -> list[tuple[int, str]]:
    """(start, identifier) of the recognised sentences, by start."""
    found = set()
    for pattern in (_LINES, _WRAPPED):
        at = 0
        for m in [*pattern.finditer(text), None]:
            end = m.start() if m else len(text)
            if 10 < end - at <= 4 * LONGEST:
                piece = text[at:end]
                if pattern is _WRAPPED:
                    piece = _WRAP_MARKS.sub(" ", piece)
                plain = normalised(piece)
                name = KNOWN.get(plain) or _named(plain)
                if name:
                    lead = len(piece) - len(piece.lstrip()) if pattern is _LINES else _lead(text, at)
                    found.add((at + lead, name))
            at = m.end() if m else end
    for m in _SPDX.finditer(text) if "SPDX-" in text else ():
        for one in _SPDX_ID.finditer(text, m.start(1), m.end(1)):
            name = SPDX_NAMES.get(one[0].lower())
            if name:
                found.add((one.start(), f"spdx-{name}"))
    return sorted(found)


def _named(plain: str) -> str | None:
    """The identifier of a sentence that is known but for a name in it."""
    for name, start, pattern in PATTERNS:
        if plain.startswith(start) and pattern.fullmatch(plain):
            return name
    return None


def _lead(text: str, at: int) -> int:
    end = at
    while end < len(text) and text[end] in " \t\r\n":
        end += 1
    return end - at


def licences(names: list[str]) -> list[str]:
    """Licences whose rules hold somewhere in the sequence. A rule inside another held one of more
    sentences at the same place says nothing of its own (BSD-2-Clause inside BSD-3-Clause)."""
    held = []
    for licence, rule in RULES:
        for i in range(len(names) - len(rule) + 1):
            if tuple(names[i:i + len(rule)]) == rule:
                held.append((licence, i, i + len(rule)))
    return sorted({
        licence for licence, a, b in held
        if not any(x <= a and b <= y and (y - x) > (b - a) for _, x, y in held)
    })


_RESULT = T.StructType([
    T.StructField("sentence_ids", T.ArrayType(T.StringType())),
    T.StructField("sentence_starts", T.ArrayType(T.IntegerType())),
    T.StructField("licences", T.ArrayType(T.StringType())),
])


def scan(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``row`` (the carried columns) and ``result``: recognised sentences, their starts, licences."""

    def fn(texts: list) -> list[dict]:
        out = []
        for text in texts:
            found = sentences(text) if text else []
            names = [name for _, name in found]
            out.append({
                "sentence_ids": names, "sentence_starts": [at for at, _ in found],
                "licences": licences(names),
            })
        return out

    return annotate(docs, fn, _RESULT, carry)
