import pytest

from sensorloom.llm import licenses
from tests.conftest import plan, tuples

MIT = dict((i, s) for i, s in licenses.SENTENCES if i in ("mit-grant", "mit-notice"))
BSD = {i: s for i, s in licenses.SENTENCES if i.startswith("bsd")}

# Text to sentence identifiers and licenses.
TEXTS = {
    None: ("", ""),
    "": ("", ""),
    "A licensed plumber.": ("", ""),
    "x\nReleased under the MIT License.\ny": ("mit-short", "MIT"),
    "x y. Released  under the\tMIT license! z": ("mit-short", "MIT"),
    "LICENSED UNDER CC BY-NC 4.0.": ("cc-by-nc-4", "CC-BY-NC-4.0"),
    "Licensed under CC BY-NC 5.0.": ("", ""),
    " ".join(MIT.values()): ("mit-grant,mit-notice", "MIT"),
    "\n".join(MIT.values()): ("mit-grant,mit-notice", "MIT"),
    " ".join([BSD["bsd-grant"], BSD["bsd-source"], BSD["bsd-binary"]]): ("bsd-grant,bsd-source,bsd-binary", "BSD-2-Clause"),
    " ".join(BSD.values()): ("bsd-grant,bsd-source,bsd-binary,bsd-endorse", "BSD-3-Clause"),
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
    "the License.": ("apache2-short,apache2-use", "Apache-2.0"),
    "All rights reserved.\n" * 3 + "Licensed under CC BY 4.0.": ("reserved,reserved,reserved,cc-by-4", "CC-BY-4.0,All-Rights-Reserved"),
    BSD["bsd-binary"]: ("bsd-binary", ""),
    "license " * 50_000: ("", ""),
}


def scan(spark, rows):
    return licenses.license_scan(spark.createDataFrame(rows, "doc_id bigint, text string, licenses int"))


def test_texts(spark):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS)]
    got = {row["doc_id"]: row for row in scan(spark, rows).collect()}
    for i, (text, (ids, names)) in enumerate(TEXTS.items()):
        assert (got[i]["sentence_ids"], got[i]["licenses"]) == (ids, names), (text or "")[:80]
    assert [got[i]["n_unmatched"] for i, t in enumerate(TEXTS) if t == BSD["bsd-binary"]] == [1]


@pytest.mark.parametrize("identifier,sentence", licenses.SENTENCES)
def test_every_known_sentence_is_found_by_itself(spark, identifier, sentence):
    import re

    assert re.search(licenses.MENTIONS, sentence)
    assert licenses._plain(sentence) and dict((licenses._plain(s), i) for i, s in licenses.SENTENCES)[licenses._plain(sentence)] == identifier


def test_null_identifiers_repeated_rows_and_empty_table(spark):
    rows = [(None, "MIT License", 1), (1, "x", 1), (1, "x", 1)]
    assert [row[:2] for row in tuples(scan(spark, rows))] == [(1, ""), (1, ""), (None, "mit-short")]
    assert scan(spark, []).collect() == []
    df = spark.range(2).selectExpr("id as doc_id", "cast(id as string) as text")
    text = plan(licenses.license_scan(df))
    assert "Exchange" not in text and "Python" not in text


def test_every_known_sentence_and_rule_is_found_in_any_wrapping(spark):
    """On one line, wrapped at every width, wrapped in a comment, and between other sentences."""
    import textwrap

    wanted = []
    for identifier, sentence in licenses.SENTENCES:
        line = " ".join(sentence.split())
        inside = f"Some words. {line} More words." if line[-1] in ".:;" else line
        forms = {line, inside, f"Copyright 2020 Somebody\n{line}\nMore: words"}
        for width in (12, 30, 72):
            wrapped = textwrap.wrap(line, width, break_long_words=False)
            forms |= {"\n".join(wrapped), "\r\n".join(wrapped), "".join(f" * {x}\n" for x in wrapped)}
            forms.add(f"Title\n\n{chr(10).join(wrapped)} \n  \nAn end; and so on.")
        wanted += [(form, identifier) for form in sorted(forms)]
    got = scan(spark, [(i, text, 1) for i, (text, _) in enumerate(wanted)]).collect()
    assert {wanted[r["doc_id"]] for r in got if r["sentence_ids"] != wanted[r["doc_id"]][1]} == set()

    known = {identifier: " ".join(sentence.split()) for identifier, sentence in licenses.SENTENCES}
    texts = [(name, "\n".join(textwrap.fill(known[i], 60) for i in ids)) for name, ids in licenses.RULES]
    got = scan(spark, [(i, text, 1) for i, (_, text) in enumerate(texts)]).collect()
    assert {r["doc_id"]: (r["licenses"], r["n_unmatched"]) for r in got} == {i: (n, 0) for i, (n, _) in enumerate(texts)}


def test_a_sentence_is_whole_pieces_of_one_paragraph(spark):
    texts = ["Not released under the MIT License.", "Released under the MIT License of old.", "All rights\n\nreserved.", "All\nrights"]
    assert [row["sentence_ids"] for row in scan(spark, [(i, t, 1) for i, t in enumerate(texts)]).collect()] == [""] * 4


@pytest.mark.parametrize("name", licenses.SPDX)
def test_every_tag_has_a_rule(name):
    assert (name, [f"spdx:{name}"]) in licenses.RULES and licenses.known()[licenses._plain(f"SPDX-License-Identifier: {name}")] == f"spdx:{name}"


# Titles, tags and short forms of common licenses.
COMMON = {
    "// SPDX-License-Identifier: MIT": "MIT",
    "x\n/* SPDX-License-Identifier: (MIT OR Apache-2.0) */\ny": "MIT,Apache-2.0",
    "# SPDX-License-Identifier: GPL-2.0+ WITH Classpath-exception-2.0": "GPL-2.0-or-later",
    "SPDX-License-Identifier: LGPL-2.1": "LGPL-2.1-only",
    "SPDX-License-Identifier: MITX\nspdx-license-identifier: isc": "ISC",
    "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007": "GPL-3.0",
    "Mozilla Public License Version 2.0\n====": "MPL-2.0",
    "  Apache License\n  Version 2.0, January 2004\n  http://www.apache.org/licenses/": "Apache-2.0",
    "Eclipse Public License - v 2.0": "EPL-2.0",
    "CC0 1.0 Universal": "CC0-1.0",
    "This is free and unencumbered software released into the public domain.": "Unlicense",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public\n"
    "License as published by the Free Software Foundation; either\nversion 3 of the License, or (at your option) any later version.": "LGPL-3.0-or-later",
    "This project is released\nunder the BSD 3-Clause License.": "BSD-3-Clause",
    "The code is available under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
    "This program is licensed under\n\nthe MIT License": "",
    "Never released under the GPLv3 license.": "",
}


def test_common_licenses(spark):
    got = {r["doc_id"]: r["licenses"] for r in scan(spark, [(i, t, 1) for i, t in enumerate(COMMON)]).collect()}
    assert [got[i] for i in range(len(COMMON))] == list(COMMON.values())


def test_the_sql_sees_what_the_scan_sees(spark):
    """On all the texts above, known sentences run together in random order, wrapped at random, and marks between."""
    import random

    import duckdb
    import pyarrow as pa

    from sensorloom.llm import oracles

    rng = random.Random(8)
    known = [" ".join(s.split()) for _, s in licenses.SENTENCES]
    texts = [*TEXTS, *COMMON]
    for _ in range(400):
        words = " ".join(rng.choice([*known, "Some words.", "x:"]) + rng.choice(["", ".", ";"]) for _ in range(rng.randrange(1, 9))).split(" ")
        texts.append("".join(w + rng.choice([" "] * 12 + ["\n", " \n", "\r\n# ", "\n \n", "  ", "\t"]) for w in words))
    rows = [(i, t, 1) for i, t in enumerate(texts)]
    documents = pa.table({"doc_id": [i for i, *_ in rows], "text": texts})  # noqa: F841
    result = duckdb.sql(oracles.license_scan())
    order = [result.columns.index(c) for c in ("doc_id", "sentence_ids", "licenses", "n_sentences", "n_unmatched")]
    wanted = sorted(tuple(row[i] for i in order) for row in result.fetchall())
    got = sorted(tuple(r) for r in scan(spark, rows).collect())
    assert [(g, w, texts[g[0]]) for g, w in zip(got, wanted) if g != w][:2] == []
    assert sum(bool(row[2]) for row in got) > 100
