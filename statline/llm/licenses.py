"""Licences by sentence rules: known sentences become identifiers, ordered rules match their sequence.

A text is cut into atoms at line ends and after sentence marks. Normalised (lower case, words and
numbers only, one spelling), an atom or a run of them that is a known licence sentence becomes that
sentence's identifier, so wrapped lines and comment marks do not matter. Runs of identifiers without
a strange atom between them are matched against the rules, first rule first; what no rule takes is
reported as a part of a licence.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import plain_strings, text_slices, workers_import_package

# Sentences of public licences, and their notices.
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-warranty": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "apache-grant": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl2-grant": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl3-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-see": "See the GNU General Public License for more details.",
    "gpl-copy": "You should have received a copy of the GNU General Public License along with this program.",
    "gnu-see": "If not, see https://www.gnu.org/licenses/.",
    "bsd-liability": "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "isc-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "isc-liability": "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "lgpl2-grant": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl-warranty": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "lgpl-see": "See the GNU Lesser General Public License for more details.",
    "lgpl-copy": "You should have received a copy of the GNU Lesser General Public License along with this library.",
    "lgpl-copy-program": "You should have received a copy of the GNU Lesser General Public License along with this program.",
    "agpl3-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl-see": "See the GNU Affero General Public License for more details.",
    "agpl-copy": "You should have received a copy of the GNU Affero General Public License along with this program.",
    "mpl-grant": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "epl-grant": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "cc0-grant": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.",
    "cc0-warranty": "This software is distributed without any warranty.",
    "cc0-copy": "You should have received a copy of the CC0 Public Domain Dedication along with this software.",
    "cc0-see": "If not, see https://creativecommons.org/publicdomain/zero/1.0/.",
    "unlicense-grant": "This is free and unencumbered software released into the public domain.",
    "unlicense-use": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "boost-grant": "Distributed under the Boost Software License, Version 1.0.",
    "boost-see": "(See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)",
    "boost-permission": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    "zlib-warranty": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-liability": "In no event will the authors be held liable for any damages arising from the use of this software.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "zlib-origin": "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
    "zlib-thanks": "If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.",
    "zlib-marked": "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
    "zlib-notice": "This notice may not be removed or altered from any source distribution.",
}
# Names that a one-line notice uses, by the licence's usual identifier.
NAMES = {
    "MIT": ("MIT License",),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License",),
    "BSD-3-Clause": ("BSD 3-Clause License",),
    "GPL-2.0": ("GNU General Public License, version 2", "GPL v2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GPL v3"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "LGPL v2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPL v3"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPL v3"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License, version 2.0"),
    "ISC": ("ISC License",),
    "Zlib": ("zlib License",),
    "BSL-1.0": ("Boost Software License 1.0",),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"),
    "Unlicense": ("Unlicense",),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
}
# Licence identifiers and exceptions that an SPDX expression may name.
SPDX_IDS = (
    "0BSD", "AFL-3.0", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-1.1", "Apache-2.0", "Artistic-2.0",
    "BSD-1-Clause", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "BSL-1.0", "CC-BY-3.0", "CC-BY-4.0", "CC-BY-NC-4.0",
    "CC-BY-SA-3.0", "CC-BY-SA-4.0", "CC0-1.0", "CDDL-1.0", "CDDL-1.1", "CECILL-2.1", "CPL-1.0", "ECL-2.0", "EPL-1.0", "EPL-2.0",
    "EUPL-1.2", "GFDL-1.3-only", "GFDL-1.3-or-later", "GPL-2.0", "GPL-2.0+", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0",
    "GPL-3.0+", "GPL-3.0-only", "GPL-3.0-or-later", "HPND", "ICU", "ISC", "LGPL-2.0-only", "LGPL-2.0-or-later", "LGPL-2.1",
    "LGPL-2.1+", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0",
    "MPL-1.1", "MPL-2.0", "MS-PL", "MulanPSL-2.0", "NCSA", "OFL-1.1", "OpenSSL", "PHP-3.01", "PostgreSQL", "PSF-2.0",
    "Python-2.0", "Ruby", "Unicode-3.0", "Unlicense", "UPL-1.0", "Vim", "W3C", "WTFPL", "X11", "Zlib", "ZPL-2.1",
)
SPDX_EXCEPTIONS = (
    "Autoconf-exception-3.0", "Bison-exception-2.2", "Classpath-exception-2.0", "GCC-exception-3.1", "LLVM-exception",
    "Linux-syscall-note", "OpenJDK-assembly-exception-1.0", "Font-exception-2.0", "Qt-GPL-exception-1.0",
)
SUBJECTS = ("", "This work is ", "This software is ", "This project is ", "This code is ")
VERBS = ("licensed", "released", "distributed", "available")
ARTICLES = ("", "the ", "the terms of the ")
#: First match wins; a rule takes its identifiers in this order, those with a question mark where they are there.
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-warranty", "bsd-liability?")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty", "bsd-liability?")),
    ("BSD-1-Clause", ("bsd-grant", "bsd-source", "bsd-warranty", "bsd-liability?")),
    ("Apache-2.0", ("apache-grant", "apache-copy", "apache-warranty", "apache-see")),
    ("GPL-3.0-or-later", ("gpl3-grant", "gpl-warranty", "gpl-see", "gpl-copy?", "gnu-see?")),
    ("GPL-2.0-or-later", ("gpl2-grant", "gpl-warranty", "gpl-see", "gpl-copy?", "gnu-see?")),
    ("LGPL-2.1-or-later", ("lgpl2-grant", "lgpl-warranty?", "lgpl-see?", "lgpl-copy?", "gnu-see?")),
    ("LGPL-3.0-or-later", ("lgpl3-grant", "gpl-warranty?", "lgpl-see?", "lgpl-copy-program?", "gnu-see?")),
    ("AGPL-3.0-or-later", ("agpl3-grant", "gpl-warranty?", "agpl-see?", "agpl-copy?", "gnu-see?")),
    ("MPL-2.0", ("mpl-grant", "mpl-copy?")),
    ("EPL-2.0", ("epl-grant",)),
    ("CC0-1.0", ("cc0-grant", "cc0-warranty?", "cc0-copy?", "cc0-see?")),
    ("Unlicense", ("unlicense-grant", "unlicense-use?")),
    ("BSL-1.0", ("boost-grant", "boost-see?")),
    ("BSL-1.0", ("boost-permission",)),
    ("Zlib", ("zlib-warranty", "zlib-liability", "zlib-grant", "zlib-origin", "zlib-thanks?", "zlib-marked", "zlib-notice")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("ISC", ("isc-grant", "isc-warranty?", "isc-liability?")),
    ("Apache-2.0", ("apache-grant",)),
    ("GPL-3.0-or-later", ("gpl3-grant",)),
    ("GPL-2.0-or-later", ("gpl2-grant",)),
)
PARTIAL = "part of a licence"
#: Every known sentence has one of these in the raw text too, so a text without any needs no closer look: each lies within
#: one word ("cc" with the mark or space after it), so it doesn't matter what stands between words. A long s (U+017F)
#: ends a word, but (?i) takes it for a letter.
ANCHORS = (r"(?i)licen[sc]e|permission|warrant|redistribut|copyright|gpl|cc0|cc(?:[^a-z0-9]|ſ)|liable|misrepresent|altered|"
           r"acknowledg|mozilla|commons|compiled|unencumbered")

_ATOM = re.compile(r"[^\n]+?(?:[.!?;:]+(?=\s|$)|(?=\n)|$)")
_WORD = re.compile(r"[a-z0-9]+")
_SPDX = re.compile(r"SPDX-Licen[cs]e-Identifier:[ \t]*", re.I)
_SPDX_TOKEN = re.compile(r"[ \t]*(\(|\)|[A-Za-z0-9][A-Za-z0-9.+-]*)")
_COPYRIGHT = re.compile(r"(copyright|c) (c )?(\d{4})\b|all rights reserved$")


def normal(text: str) -> list[str]:
    """Lower-case words and numbers, British spelling of the licence made American."""
    return [w.replace("licence", "license") for w in _WORD.findall(text.lower())]


def _known() -> dict[tuple[str, ...], str]:
    out = {tuple(normal(s)): k for k, s in SENTENCES.items()}
    for license_, names in NAMES.items():
        for name in names:
            for verb in VERBS:
                for subject in SUBJECTS:
                    for the in ARTICLES:
                        out.setdefault(tuple(normal(f"{subject}{verb} under {the}{name}")), f"notice {license_}")
            out.setdefault(tuple(normal(f"License: {name}")), f"notice {license_}")
    for license_ in SPDX_IDS:  # a + is no word: an identifier with it comes from ``spdx_expression``
        if not license_.endswith("+"):
            out.setdefault(tuple(normal(f"SPDX-License-Identifier: {license_}")), f"notice {license_}")
    out |= {tuple("http" if w == "https" else w for w in words): name for words, name in out.items() if "https" in words}
    return out


_IDS = {name.lower(): name for name in SPDX_IDS}
_EXCEPTIONS = {name.lower(): name for name in SPDX_EXCEPTIONS}


def spdx_expression(text: str, start: int) -> tuple[str, int] | None:
    """(expression in usual spelling, end) of the longest SPDX expression at ``start``: known identifiers, AND, OR, WITH, brackets.

    None where none starts there or a bracket stays open. What follows a whole expression (a comment's end) is left alone.
    """
    out, best, open_, at, wants = [], None, 0, start, True
    while m := _SPDX_TOKEN.match(text, at):
        word = m[1].lower()
        if wants and word == "(":
            open_ += 1
            out.append("(")
        elif wants and word in _IDS:
            out.append(_IDS[word])
            wants = False
        elif not wants and word == ")" and open_:
            open_ -= 1
            out.append(")")
        elif not wants and word in ("and", "or"):
            out.append(f" {word.upper()} ")
            wants = True
        elif not wants and word == "with" and (x := _SPDX_TOKEN.match(text, m.end())) and x[1].lower() in _EXCEPTIONS and out[-1] != ")":
            out.append(f" WITH {_EXCEPTIONS[x[1].lower()]}")
            m = x
        else:
            break
        at = m.end()
        if not wants and not open_:
            best = "".join(out), at
    return best


def taken(names: list[str | None], start: int, wanted: tuple[str, ...]) -> int:
    """How many of ``names`` from ``start`` on the rule takes; 0 where it doesn't apply."""
    at = start
    for w in wanted:
        if at < len(names) and names[at] == w.removesuffix("?"):
            at += 1
        elif not w.endswith("?"):
            return 0
    return at - start


class SentenceRules:
    def __init__(self, known: dict[tuple[str, ...], str] | None = None, rules=RULES):
        self.known = known or _known()
        self.rules = rules
        self.longest = max(map(len, self.known))
        self.starts = {k[:2] for k in self.known}

    def atoms(self, text: str) -> list[tuple[int, int, list[str]]]:
        """(start, end, words) of each atom but those of one number, which count the points of a list."""
        out = []
        for m in _ATOM.finditer(text):
            words = normal(m.group())
            if len(words) > 1 or words and not words[0].isdigit():
                out.append((m.start(), m.end(), words))
        return out

    def identifiers(self, text: str) -> list[tuple[str | None, int, int]]:
        """Identifier (None: unknown), start and end, in order; at each atom the longest known run wins.

        Copyright lines stand between sentences of all licences and are left out.
        """
        atoms, out, i = self.atoms(text), [], 0
        while i < len(atoms):
            # a tag may have a comment's words before it on its line
            tag = _SPDX.search(text, *atoms[i][:2]) if "spdx" in atoms[i][2] else None
            if tag and (spdx := spdx_expression(text, tag.end())):
                out.append((f"notice {spdx[0]}", tag.start(), spdx[1]))
                while i < len(atoms) and atoms[i][0] < spdx[1]:
                    i += 1
                continue
            words: list[str] = []
            best = None
            for j in range(i, len(atoms)):
                words = words + atoms[j][2]
                if len(words) > self.longest or tuple(words[:2]) not in self.starts and len(words) > 1:
                    break
                if (name := self.known.get(tuple(words))) is not None:
                    best = name, j
            if best:
                out.append((best[0], atoms[i][0], atoms[best[1]][1]))
                i = best[1] + 1
                continue
            if not _COPYRIGHT.match(" ".join(atoms[i][2])):
                out.append((None, atoms[i][0], atoms[i][1]))
            i += 1
        return out

    def match(self, text: str) -> list[tuple[str, int, int, list[str]]]:
        """(licence, start, end, identifiers) of each rule that applies, in order of the text."""
        found, out, i = self.identifiers(text), [], 0
        names = [f[0] for f in found]
        while i < len(found):
            if names[i] is None:
                i += 1
                continue
            if names[i].startswith("notice "):
                license_, n = names[i].removeprefix("notice "), 1
            else:
                license_, n = next(((license_, n) for license_, wanted in self.rules if (n := taken(names, i, wanted))), (PARTIAL, 1))
            out.append((license_, found[i][1], found[i + n - 1][2], names[i:i + n]))
            i += n
        return out


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, license, start, stop, sentences) of every licence statement in the whole texts of ``docs``.

    ``start`` and ``stop`` are character positions. Null, empty and licence-free texts have no row;
    repeated rows and null ids have theirs each.
    """
    workers_import_package(docs.sparkSession)

    def find(batches):
        rules = SentenceRules()
        for part in text_slices(batches):
            texts = plain_strings(part.column("text"))
            near = pc.indices_nonzero(pc.match_substring_regex(texts, ANCHORS))
            rows = [(i, *m) for i, t in zip(near.to_pylist(), texts.take(near).to_pylist()) for m in rules.match(t)]
            if rows:
                at, license_, start, stop, ids = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(at)), pa.array(license_), pa.array(start, pa.int64()),
                     pa.array(stop, pa.int64()), pa.array(ids, pa.list_(pa.string()))],
                    ["doc_id", "license", "start", "stop", "sentences"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        find, "doc_id long, license string, start long, stop long, sentences array<string>")
