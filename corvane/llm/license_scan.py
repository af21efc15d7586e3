"""Licence recognition by sentence rules: normalised sentences map to known identifiers, and ordered rules over the
identifiers name the licences.

A sentence ends at an empty line or after . ! ? ; and white space, and a known one may also end or begin at any line
break, so wrapped sentences and notices on a line of their own are both found, the longest first. It is normalised to
words of letters, digits, dots inside numbers and hyphens, in lower case; marks that lead comment lines are no words.
Places are given in pieces, lines cut at the ends of sentences. A rule is a licence and the identifiers it needs in
order, with at most GAP other sentences between two of them. Rules are tried from the longest to the shortest, ties in
order of name; sentences that a rule used are not used again. A reservation of rights names a text proprietary only if
no licence is found in it and no copyright line stands before it. The time taken follows the length of the text.

Null and empty texts hold no licence; repeated sentences may match again; extra columns are left behind.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import over_batches, texts

#: Other sentences that may stand between two of a rule.
GAP = 2
_ENDS = re.compile(r"(\n+|(?<=[.!?;])\s+)")
_LEADER = re.compile(r"\s*(?:dnl|@?rem)\s", re.I)
_WORDS = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")

# Opening sentences of common licences, and the rules over them.
SENTENCES = {
    "apache-2-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2-grant": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-2-use": "you may not use this file except in compliance with the License.",
    "apache-2-copy": "You may obtain a copy of the License at",
    "as-is-basis": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "mit-notice": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-keep": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "gpl-2-work": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software;",
    "gpl-2-later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-3-later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-2-whole": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.",
    "gpl-3-whole": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "cc-by-4": "Licensed under CC BY 4.0.",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0.",
    "cc-by-nd-4": "Licensed under CC BY-ND 4.0.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-name": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "reserved": "All rights reserved.",
    "apache-title": "Apache License Version 2.0, January 2004",
    "apache-terms": "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "apache-spdx": "SPDX-License-Identifier: Apache-2.0",
    "mit-spdx": "SPDX-License-Identifier: MIT",
    "gpl-2-spdx": "SPDX-License-Identifier: GPL-2.0-only",
    "gpl-2-later-spdx": "SPDX-License-Identifier: GPL-2.0-or-later",
    "gpl-3-spdx": "SPDX-License-Identifier: GPL-3.0-only",
    "gpl-3-later-spdx": "SPDX-License-Identifier: GPL-3.0-or-later",
    "bsd-2-spdx": "SPDX-License-Identifier: BSD-2-Clause",
    "bsd-3-spdx": "SPDX-License-Identifier: BSD-3-Clause",
    "mpl-2-spdx": "SPDX-License-Identifier: MPL-2.0",
    "isc-spdx": "SPDX-License-Identifier: ISC",
    "apache-notice-long": "This project is licensed under the Apache License, Version 2.0.",
    "mit-project": "This project is licensed under the MIT License.",
    "mit-software": "This software is released under the MIT License.",
    "gpl-2-title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "gpl-3-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "lgpl-2-1-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "lgpl-3-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "agpl-3-title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "library-free": "This library is free software;",
    "lgpl-2-1-later": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl-3-later": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    "lgpl-3-whole": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl-3-whole": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl-3-only": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version 3.",
    "agpl-3-spdx": "SPDX-License-Identifier: AGPL-3.0-only",
    "agpl-3-later-spdx": "SPDX-License-Identifier: AGPL-3.0-or-later",
    "lgpl-2-1-spdx": "SPDX-License-Identifier: LGPL-2.1-only",
    "lgpl-2-1-later-spdx": "SPDX-License-Identifier: LGPL-2.1-or-later",
    "lgpl-3-spdx": "SPDX-License-Identifier: LGPL-3.0-only",
    "lgpl-3-later-spdx": "SPDX-License-Identifier: LGPL-3.0-or-later",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-grant-and": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "unlicense-free": "This is free and unencumbered software released into the public domain.",
    "unlicense-anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-liable": "In no event will the authors be held liable for any damages arising from the use of this software.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "boost-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "boost-notice": "Distributed under the Boost Software License, Version 1.0.",
    "boost-grant": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:',
    "epl-2-made": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
    "epl-2-spdx": "SPDX-License-Identifier: EPL-2.0",
    "epl-1-made": "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at",
    "cc0-work": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.",
    "cc0-title": "CC0 1.0 Universal",
    "cc0-licensed": "Licensed under CC0 1.0.",
    "cc-by-4-title": "Creative Commons Attribution 4.0 International Public License",
    "cc-by-4-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-nd-4-work": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "cc-by-nc-sa-4-work": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "cc-by-nc-nd-4-work": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "cc-by-nc-sa-4": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-4": "Licensed under CC BY-NC-ND 4.0.",
    "bsd-name-organization": "Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-advert": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "wtfpl": "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE",
    "artistic-2": "The Artistic License 2.0",
    "mit-0-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.',
}
RULES = (
    ("Apache-2.0", ("apache-2-grant", "apache-2-use", "apache-2-copy", "as-is-basis")),
    ("Apache-2.0", ("apache-2-grant", "apache-2-use")),
    ("Apache-2.0", ("apache-2-notice",)),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("GPL-2.0-only", ("gpl-2-work",)),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-2-later")),
    ("GPL-2.0-or-later", ("gpl-2-whole",)),
    ("GPL-3.0-only", ("gpl-3-work",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-3-later")),
    ("GPL-3.0-or-later", ("gpl-3-whole",)),
    ("MIT", ("mit-grant", "mit-keep", "mit-as-is")),
    ("MIT", ("mit-grant", "mit-keep")),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-notice",)),
    ("MPL-2.0", ("mpl-2",)),
    ("MPL-2.0", ("mpl-2-spdx",)),
    ("0BSD", ("0bsd-grant",)),
    ("AGPL-3.0-only", ("agpl-3-only",)),
    ("AGPL-3.0-only", ("agpl-3-spdx",)),
    ("AGPL-3.0-only", ("agpl-3-title",)),
    ("AGPL-3.0-or-later", ("agpl-3-later-spdx",)),
    ("AGPL-3.0-or-later", ("agpl-3-whole",)),
    ("Apache-2.0", ("apache-notice-long",)),
    ("Apache-2.0", ("apache-spdx",)),
    ("Apache-2.0", ("apache-title", "apache-terms")),
    ("Artistic-2.0", ("artistic-2",)),
    ("BSD-2-Clause", ("bsd-2-spdx",)),
    ("BSD-3-Clause", ("bsd-3-spdx",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name-organization")),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-name-organization")),
    ("BSL-1.0", ("boost-grant",)),
    ("BSL-1.0", ("boost-notice",)),
    ("BSL-1.0", ("boost-title",)),
    ("CC-BY-4.0", ("cc-by-4-title",)),
    ("CC-BY-4.0", ("cc-by-4-work",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-work",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd-4",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd-4-work",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4-work",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-4-work",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-work",)),
    ("CC0-1.0", ("cc0-licensed",)),
    ("CC0-1.0", ("cc0-title",)),
    ("CC0-1.0", ("cc0-work",)),
    ("EPL-1.0", ("epl-1-made",)),
    ("EPL-2.0", ("epl-2-made",)),
    ("EPL-2.0", ("epl-2-spdx",)),
    ("GPL-2.0-only", ("gpl-2-spdx",)),
    ("GPL-2.0-only", ("gpl-2-title",)),
    ("GPL-2.0-or-later", ("gpl-2-later-spdx",)),
    ("GPL-3.0-only", ("gpl-3-spdx",)),
    ("GPL-3.0-only", ("gpl-3-title",)),
    ("GPL-3.0-or-later", ("gpl-3-later-spdx",)),
    ("ISC", ("isc-grant",)),
    ("ISC", ("isc-grant-and",)),
    ("ISC", ("isc-spdx",)),
    ("LGPL-2.1-only", ("lgpl-2-1-spdx",)),
    ("LGPL-2.1-only", ("lgpl-2-1-title",)),
    ("LGPL-2.1-or-later", ("library-free", "lgpl-2-1-later")),
    ("LGPL-2.1-or-later", ("lgpl-2-1-later-spdx",)),
    ("LGPL-3.0-only", ("lgpl-3-spdx",)),
    ("LGPL-3.0-only", ("lgpl-3-title",)),
    ("LGPL-3.0-or-later", ("library-free", "lgpl-3-later")),
    ("LGPL-3.0-or-later", ("lgpl-3-later-spdx",)),
    ("LGPL-3.0-or-later", ("lgpl-3-whole",)),
    ("MIT", ("mit-project",)),
    ("MIT", ("mit-software",)),
    ("MIT", ("mit-spdx",)),
    ("MIT-0", ("mit-0-grant",)),
    ("Unlicense", ("unlicense-free",)),
    ("Unlicense", ("unlicense-free", "unlicense-anyone")),
    ("WTFPL", ("wtfpl",)),
    ("Zlib", ("zlib-as-is", "zlib-liable", "zlib-grant")),
)
#: A rule for texts without a licence.
RESERVED = ("Proprietary", "reserved")
_COPYRIGHT = re.compile(r"copyright|\(c\)|\u00a9", re.I)


def normal(sentence: str) -> str:
    return " ".join(_WORDS.findall(sentence.lower()))


def pieces(text: str) -> list[tuple[str, bool]]:
    """Pieces, and whether the next one may go on with the sentence: only a line break stands between."""
    cut = [*_ENDS.split(text), ""]
    out: list[tuple[str, bool]] = []
    for piece, end in zip(cut[::2], cut[1::2], strict=True):
        if piece and not piece.isspace():
            out.append((piece, end == "\n" and piece.rstrip()[-1] not in ".!?;"))
        elif out:
            out[-1] = (out[-1][0], False)
    return out


class Scanner:
    """Sentence table and rules; known sentences are cut as texts are, so each may be several pieces."""

    def __init__(self, sentences: dict[str, str] | None = None, rules=RULES, gap: int = GAP, reserved: tuple[str, str] | None = RESERVED):
        self.gap, self.reserved = gap, reserved
        self.known: dict[str, str] = {}
        self.parts: dict[str, list[str]] = {}
        for name, sentence in (sentences or SENTENCES).items():
            self.parts[name] = []
            for piece, _ in pieces(sentence):
                self.known.setdefault(normal(piece), f"{name}/{len(self.parts[name])}")
                self.parts[name].append(self.known[normal(piece)])
        self.rules = sorted(((licence, [x for s in needed for x in self.parts[s]]) for licence, needed in rules), key=lambda r: (-len(r[1]), r[0]))
        self.begun = {" ".join(words[:k]) for words in map(str.split, self.known) for k in range(1, len(words) + 1)}

    def identify(self, text: str) -> list[tuple[int, int, int, str]]:
        """(first piece, last piece, sentence number, identifier) of the known sentences."""
        out = []
        cut = pieces(text)
        k, number, inside = 0, 0, False
        while k < len(cut):
            words, last, found = normal(cut[k][0]), k, None
            if words not in self.begun and _LEADER.match(cut[k][0]):
                words = normal(_LEADER.sub("", cut[k][0], count=1))
            while words in self.begun:
                if words in self.known:
                    found = (last, self.known[words])
                more = normal(_LEADER.sub("", cut[last + 1][0], count=1)) if cut[last][1] else ""
                if not more:
                    break
                words, last = f"{words} {more}", last + 1
            if found:
                number += inside
                out.append((k, found[0], number, found[1]))
                k, number, inside = found[0] + 1, number + 1, False
            else:
                inside = cut[k][1] and bool(words)
                number += bool(words) and not inside
                k += 1
        return out

    def match(self, found: list[tuple[int, int, int, str]], text: str | None = None) -> list[tuple[int, int, str]]:
        """(first piece, last piece, licence), by place. text: looked at for copyright lines before a reservation."""
        used: set[int] = set()
        out = []
        at: dict[str, list[int]] = {}
        for k, (*_, name) in enumerate(found):
            at.setdefault(name, []).append(k)
        for licence, needed in self.rules:
            if any(name not in at for name in needed):
                continue
            for start in at[needed[0]]:
                if start in used:
                    continue
                chain = [start]
                for want in needed[1:]:
                    # each known sentence has a number of its own, so few are looked at
                    here, j = found[chain[-1]][2], chain[-1] + 1
                    while j < len(found) and found[j][2] - here <= self.gap + 1 and (j in used or found[j][3] != want):
                        j += 1
                    if j == len(found) or found[j][2] - here > self.gap + 1:
                        break
                    chain.append(j)
                if len(chain) == len(needed):
                    used.update(chain)
                    out.append((found[chain[0]][0], found[chain[-1]][1], licence))
        if not out and self.reserved:
            name = self.parts.get(self.reserved[1], [""])[0]
            lines = [p for p, _ in pieces(text)] if text and name in at else []
            for k in at.get(name, []):
                first, last, *_ = found[k]
                if not (lines and _COPYRIGHT.search(lines[max(0, first - 1)])):
                    out.append((first, last, self.reserved[0]))
        return sorted(out)


def scan(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """doc_id, n_sentences (known ones), licenses (distinct, in order of name), matches (licence:first:last)."""
    by = scanner or Scanner()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts_here = batch.column(1).to_pylist()
        ids = [by.identify(t) for t in texts_here]
        found = [by.match(x, t) for x, t in zip(ids, texts_here, strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([",".join(sorted({m[2] for m in f})) for f in found]), pa.array([",".join(f"{m[2]}:{m[0]}:{m[1]}" for m in f) for f in found])],
            ["doc_id", "n_sentences", "licenses", "matches"],
        )

    return over_batches(texts(docs), run, "doc_id long, n_sentences long, licenses string, matches string")
