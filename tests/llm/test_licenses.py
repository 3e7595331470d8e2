import pytest
from corpus_rows import odd_rows, rows_of

from statline.llm.licenses import ANCHORS, NAMES, PARTIAL, RULES as ALL_RULES, SENTENCES, SentenceRules, _known, normal, scan, spdx_expression

RULES = SentenceRules()


def by_trying_all(text: str) -> list[tuple[str | None, int, int]]:
    """Identifiers found by joining every run of atoms and looking for it among the known sentences."""
    atoms, out, i = RULES.atoms(text), [], 0
    while i < len(atoms):
        for j in range(len(atoms), i, -1):
            name = RULES.known.get(tuple(w for a in atoms[i:j] for w in a[2]))
            if name:
                out.append((name, atoms[i][0], atoms[j - 1][1]))
                i = j
                break
        else:
            if not (atoms[i][2][0] == "copyright" and any(w.isdigit() for w in atoms[i][2][:3]) or atoms[i][2] == ["all", "rights", "reserved"]):
                out.append((None, atoms[i][0], atoms[i][1]))
            i += 1
    return out


def wrapped(text: str, mark: str) -> str:
    """As a source file would have it: short lines, each after a comment mark."""
    lines, line = [], mark
    for word in text.split():
        if len(line) > 50:
            lines.append(line)
            line = mark
        line += " " + word
    return "\n".join([*lines, line])


MIT = " ".join(SENTENCES[k] for k in ("mit-grant", "mit-notice", "mit-warranty", "mit-liability"))
BSD2 = "{bsd-grant}\n 1. {bsd-source}\n 2. {bsd-binary}\n\n{bsd-warranty}".format(**SENTENCES)


@pytest.mark.parametrize("text, want", [
    ("Released under the MIT License.", ["MIT"]),
    ("prose.\nThis work is licensed under the GNU General Public License, version 3.\nprose", ["GPL-3.0"]),
    ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
    ("licenced under the Apache Licence, Version 2.0", ["Apache-2.0"]),
    ("SPDX-License-Identifier: BSD-2-Clause", ["BSD-2-Clause"]),
    ("Copyright (c) 2020 Somebody\n" + wrapped(MIT, " *"), ["MIT"]),
    (wrapped(BSD2, "#"), ["BSD-2-Clause"]),
    (SENTENCES["mit-grant"] + " Something else entirely. " + SENTENCES["mit-notice"], [PARTIAL, PARTIAL]),
    (SENTENCES["bsd-binary"], [PARTIAL]),
    ("We like the license of this text.", []),
    ("Permission was not granted.", []),
    ("", []),
])
def test_known_texts(text, want):
    assert [m[0] for m in RULES.match(text)] == want
    assert RULES.identifiers(text) == by_trying_all(text)


@pytest.mark.parametrize("text, want", [
    ("SPDX-License-Identifier: GPL-2.0-only", ["GPL-2.0-only"]),
    ("// SPDX-License-Identifier: Apache-2.0 OR MIT", ["Apache-2.0 OR MIT"]),
    ("/* SPDX-License-Identifier: LGPL-2.1-or-later */", ["LGPL-2.1-or-later"]),
    ("# spdx-license-identifier: (mit or apache-2.0) and gpl-2.0-only with classpath-exception-2.0\nprose",
     ["(MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0"]),
    ("SPDX-License-Identifier: GPL-2.0+", ["GPL-2.0+"]),
    ("SPDX-License-Identifier: MIT and more", ["MIT"]),
    ("SPDX-License-Identifier: (MIT OR", []),
    ("SPDX-License-Identifier: No-Such-1.0", []),
    ("SPDX-License-Identifier:", []),
    ("licensed under the terms of the MIT license", ["MIT"]),
    ("Released under CC0 1.0.", ["CC0-1.0"]),
    (wrapped(" ".join(SENTENCES[k] for k in ("mpl-grant", "mpl-copy")), "//"), ["MPL-2.0"]),
    (SENTENCES["mpl-grant"] + "\n" + SENTENCES["mpl-copy"].replace("https", "http"), ["MPL-2.0"]),
    (SENTENCES["unlicense-grant"] + "\n\n" + SENTENCES["unlicense-use"], ["Unlicense"]),
    (SENTENCES["boost-grant"] + "\n" + SENTENCES["boost-see"], ["BSL-1.0"]),
    (wrapped(" ".join(SENTENCES[k] for k in ("lgpl2-grant", "lgpl-warranty", "lgpl-see", "lgpl-copy")), " *"), ["LGPL-2.1-or-later"]),
    (BSD2 + "\n" + SENTENCES["bsd-liability"], ["BSD-2-Clause"]),
    ("{zlib-warranty} {zlib-liability}\n{zlib-grant}\n1. {zlib-origin} {zlib-thanks}\n2. {zlib-marked}\n3. {zlib-notice}".format(**SENTENCES), ["Zlib"]),
])
def test_notices_and_expressions(text, want):
    import re
    assert [m[0] for m in RULES.match(text)] == want
    assert not want or re.search(ANCHORS, text)


def test_places_of_expressions():
    text = "a\n// SPDX-License-Identifier: MIT OR ISC */ b\nSPDX-License-Identifier: MIT\n"
    assert [(m[0], text[m[1]:m[2]]) for m in RULES.match(text)] == [
        ("MIT OR ISC", "SPDX-License-Identifier: MIT OR ISC"), ("MIT", "SPDX-License-Identifier: MIT")]
    assert spdx_expression("MIT)", 0) == ("MIT", 3) and spdx_expression("OR MIT", 0) is None


def test_every_rule_is_found_in_its_own_text():
    """Each rule's sentences one after another, whole and without those that may be left out."""
    for i, (license_, wanted) in enumerate(ALL_RULES):
        for parts in (wanted, [w for w in wanted if not w.endswith("?")]):
            text = "\n".join(SENTENCES[w.removesuffix("?")] for w in parts)
            assert [m[0] for m in RULES.match(text)] == [license_], (license_, parts)
            assert RULES.identifiers(wrapped(text, "#"))[0][0] == wanted[0].removesuffix("?")
    assert {w.removesuffix("?") for _, wanted in ALL_RULES for w in wanted} == set(SENTENCES)


def test_every_sentence_passes_the_anchor():
    import re
    for words in _known():
        assert re.search(ANCHORS, " ".join(words)), words
    assert all(tuple(normal(s)) in RULES.known for s in SENTENCES.values()) and NAMES


def test_whole_table_equals_trying_all(spark):
    from statline.llm.queries import QUERIES
    mid = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{mid}/documents.parquet").collect()}
    got = sorted((r.doc_id, r.start, r.stop) for r in QUERIES["op8_license_scan"](spark, mid).collect())
    want = sorted((d, a, b) for d, t in texts.items() for name, a, b in by_trying_lines(t))
    assert got == want and got


def by_trying_lines(text: str):
    """These tables have notices of one line."""
    at = 0
    for line in text.split("\n"):
        name = RULES.known.get(tuple(normal(line)))
        if name:
            yield name, at, at + len(line)
        at += len(line) + 1


def test_odd_documents(spark, odd, clashing, empty):
    assert scan(odd).collect() == [] and scan(empty).collect() == []
    some = spark.createDataFrame([(1, MIT, "x"), (1, MIT, "x"), (None, "MIT. Released under the MIT License", "y")],
                                 "doc_id long, text string, license string")
    got = scan(some).collect()
    assert sorted((r.doc_id or 0, r.license) for r in got) == [(0, "MIT"), (1, "MIT"), (1, "MIT")]
    assert rows_of(scan(odd)) == rows_of(scan(clashing)) and len(odd_rows())


@pytest.mark.parametrize("between", ["-", "\n", "\n * ", "\t", "  ", "\u00a0", "\u2010", "_", "\u017f", " / "])
def test_whatever_stands_between_words_passes_the_anchor(between):
    import pyarrow as pa
    import pyarrow.compute as pc
    texts = [between.join(w.upper() if i % 2 else w for i, w in enumerate(words)) for words in _known()]
    near = pc.match_substring_regex(pa.array(texts), ANCHORS).to_pylist()
    assert [t for t, n in zip(texts, near) if not n] == []


def test_scan_finds_what_the_rules_find(spark):
    texts = ["Released under CC-BY 4.0.", "This work is distributed under CC-BY-SA 4.0", "Available under the CC-BY-NC 4.0.",
             "available under CC\u00a0BY 4.0", "Released under CC\n# BY 4.0", "Released under CC\tBY  4.0.", "released under cc_by 4.0"]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = sorted((r.doc_id, r.license, r.start, r.stop) for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(i, *m[:3]) for i, t in rows for m in RULES.match(t)]
    assert {i for i, *_ in got} == set(range(len(texts)))
