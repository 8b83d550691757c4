"""License scans by sentence recognition.

A text that mentions licensing at all is normalised (lower case, words only) and cut into pieces, at marks followed by
white space and at the ends of lines. Known license sentences are looked for as runs of whole pieces of one paragraph: a
sentence may be wrapped anywhere, and may hold marks inside. Of those that start with one piece, the longest is taken. How
a license's name is opened ("This work is licensed under the", "Released under") is normalised, too. Lines with an SPDX tag
are cut at the operators of their expression. The known sentences are one tree of words, written as a regular expression:
what they have in common at the start is compared once. The identifiers found, in order, are then
matched against ordered rules, each a sequence of identifiers; what a rule has matched is used up, so that a longer
license is not also reported as the shorter one it contains.

All of it happens within a row, by DataFrame functions: no shuffle, no Python.
"""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.frames import text_of

# Identifier and the sentence as licenses have it. Sentences are normalised before they are compared.
SENTENCES = [
    (
        "mit-grant",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
        permit persons to whom the Software is furnished to do so, subject to the following conditions:""",
    ),
    (
        "mit-notice",
        """The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software.""",
    ),
    ("apache2-short", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("apache2-use", "you may not use this file except in compliance with the License."),
    (
        "bsd-grant",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met:""",
    ),
    (
        "bsd-source",
        """Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer.""",
    ),
    (
        "bsd-binary",
        """Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
        following disclaimer in the documentation and/or other materials provided with the distribution.""",
    ),
    (
        "bsd-endorse",
        """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission.""",
    ),
    ("mpl2-short", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("isc-grant", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "cc0-dedication",
        """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to
        this software to the public domain worldwide.""",
    ),
    ("cc0-title", "CC0 1.0 Universal"),
    (
        "boost-grant",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
        accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute,
        and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the
        Software is furnished to do so, all subject to the following:""",
    ),
    (
        "zlib-grant",
        """Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
        alter it and redistribute it freely, subject to the following restrictions:""",
    ),
    (
        "postgres-grant",
        """Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and
        without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the
        following two paragraphs appear in all copies.""",
    ),
    (
        "epl2-grant",
        """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0
        which is available at""",
    ),
    ("epl2-title", "Eclipse Public License - v 2.0"),
    ("epl1-title", "Eclipse Public License - v 1.0"),
    ("apache2-title", "Apache License Version 2.0, January 2004"),
    ("gpl2-title", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("gpl3-title", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("lgpl21-title", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("lgpl3-title", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("agpl3-title", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("wtfpl-title", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE"),
    ("ofl-title", "SIL OPEN FONT LICENSE Version 1.1 - 26 February 2007"),
    ("reserved", "All rights reserved."),
    ("public-domain", "This work is in the public domain."),
]
# The names licenses go by, each alone or after "licensed under".
NAMES = [
    ("mit-short", ["MIT License", "The MIT License (MIT)", "Expat License"]),
    ("apache2-short", ["Apache License, Version 2.0", "Apache License 2.0", "Apache Software License 2.0"]),
    ("simplified-bsd-short", ["BSD 2-Clause License", "Simplified BSD License", "2-clause BSD License"]),
    ("new-bsd-short", ["BSD 3-Clause License", "New BSD License", "3-clause BSD License"]),
    ("isc-short", ["ISC License"]),
    ("gpl2-short", ["GNU General Public License, version 2", "GNU GPL v2", "GPLv2"]),
    ("gpl3-short", ["GNU General Public License, version 3", "GNU GPL v3", "GPLv3"]),
    ("lgpl21-short", ["GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1", "LGPLv2.1"]),
    ("lgpl3-short", ["GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPLv3"]),
    ("agpl3-short", ["GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPLv3"]),
    ("mpl2-short", ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"]),
    ("epl2-short", ["Eclipse Public License 2.0", "Eclipse Public License, version 2.0"]),
    ("boost-short", ["Boost Software License 1.0", "Boost Software License, Version 1.0", "Boost Software License - Version 1.0"]),
    ("zlib-short", ["zlib License"]),
    ("unlicense-short", ["Unlicense"]),
    ("artistic-short", ["Artistic License 2.0"]),
    ("cddl-short", ["Common Development and Distribution License 1.0"]),
    ("eupl-short", ["European Union Public Licence 1.2", "EUPL 1.2"]),
    ("odbl-short", ["Open Database License 1.0", "Open Database License"]),
    ("ofl-short", ["SIL Open Font License, Version 1.1", "SIL Open Font License 1.1"]),
    ("cc0-short", ["Creative Commons Zero v1.0 Universal", "CC0 1.0"]),
    ("cc-by-4", ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"]),
    ("cc-by-3", ["CC BY 3.0", "Creative Commons Attribution 3.0 Unported License"]),
    ("cc-by-sa-4", ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"]),
    ("cc-by-sa-3", ["CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 3.0 Unported License"]),
    ("cc-by-nd-4", ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"]),
    ("cc-by-nc-4", ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"]),
    ("cc-by-nc-sa-4", ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"]),
    ("cc-by-nc-nd-4", ["CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"]),
]
# The grant of the GNU licenses, with what is granted, the license's name and its versions.
GRANT = """This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name}General Public
License as published by the Free Software Foundation; {terms}."""
GNU = [("GPL", "", ["2", "3"]), ("LGPL", "Lesser ", ["2.1", "3"]), ("AGPL", "Affero ", ["3"])]
# Identifiers that an SPDX tag may name.
SPDX = """
MIT MIT-0 X11 Apache-1.1 Apache-2.0 BSD-2-Clause BSD-3-Clause BSD-4-Clause 0BSD ISC Zlib BSL-1.0 NCSA PostgreSQL curl
Unlicense WTFPL CC0-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC-BY-ND-4.0 CC-BY-NC-4.0 CC-BY-NC-SA-4.0 CC-BY-NC-ND-4.0
GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later
AGPL-3.0-only AGPL-3.0-or-later MPL-1.1 MPL-2.0 EPL-1.0 EPL-2.0 EUPL-1.2 CDDL-1.0 Artistic-2.0 PSF-2.0 OFL-1.1
OpenSSL PHP-3.01 Ruby ODbL-1.0 SSPL-1.0 BUSL-1.1 Elastic-2.0
""".split()
# License and the sentences it takes, in order; rules are tried from the top.
RULES = [
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("MIT", ["mit-short", "mit-grant", "mit-notice"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit-short"]),
    ("Apache-2.0", ["apache2-short", "apache2-use"]),
    ("Apache-2.0", ["apache2-short"]),
    ("Apache-2.0", ["apache2-title"]),
    ("BSD-2-Clause", ["simplified-bsd-short"]),
    ("BSD-3-Clause", ["new-bsd-short"]),
    ("GPL-2.0", ["gpl2-short"]),
    ("GPL-2.0", ["gpl2-title"]),
    ("GPL-3.0", ["gpl3-short"]),
    ("GPL-3.0", ["gpl3-title"]),
    ("LGPL-2.1", ["lgpl21-short"]),
    ("LGPL-2.1", ["lgpl21-title"]),
    ("LGPL-3.0", ["lgpl3-short"]),
    ("LGPL-3.0", ["lgpl3-title"]),
    ("AGPL-3.0", ["agpl3-short"]),
    ("AGPL-3.0", ["agpl3-title"]),
    ("MPL-2.0", ["mpl2-short"]),
    ("EPL-2.0", ["epl2-grant"]),
    ("EPL-2.0", ["epl2-short"]),
    ("EPL-2.0", ["epl2-title"]),
    ("EPL-1.0", ["epl1-title"]),
    ("ISC", ["isc-short", "isc-grant"]),
    ("ISC", ["isc-grant"]),
    ("ISC", ["isc-short"]),
    ("BSL-1.0", ["boost-short", "boost-grant"]),
    ("BSL-1.0", ["boost-grant"]),
    ("BSL-1.0", ["boost-short"]),
    ("Zlib", ["zlib-grant"]),
    ("Zlib", ["zlib-short"]),
    ("PostgreSQL", ["postgres-grant"]),
    ("Unlicense", ["unlicense"]),
    ("Unlicense", ["unlicense-short"]),
    ("WTFPL", ["wtfpl-title"]),
    ("OFL-1.1", ["ofl-title"]),
    ("OFL-1.1", ["ofl-short"]),
    ("Artistic-2.0", ["artistic-short"]),
    ("CDDL-1.0", ["cddl-short"]),
    ("EUPL-1.2", ["eupl-short"]),
    ("ODbL-1.0", ["odbl-short"]),
    ("CC0-1.0", ["cc0-title"]),
    ("CC0-1.0", ["cc0-dedication"]),
    ("CC0-1.0", ["cc0-short"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa-4"]),
    ("CC-BY-NC-ND-4.0", ["cc-by-nc-nd-4"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC-BY-SA-3.0", ["cc-by-sa-3"]),
    ("CC-BY-ND-4.0", ["cc-by-nd-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-3.0", ["cc-by-3"]),
    ("Public-Domain", ["public-domain"]),
    ("All-Rights-Reserved", ["reserved"]),
]

for _identifier, _names in NAMES:
    SENTENCES += [(_identifier, form.format(name)) for name in _names for form in ("{}", "Licensed under the {}.")]
for _family, _name, _versions in GNU:
    for _version in _versions:
        _grants = {"+": f"either version {_version} of the License, or (at your option) any later version", "": f"version {_version} of the License"}
        for _more, _terms in _grants.items():
            _identifier = f"{_family.lower()}-grant-{_version}{_more}"
            SENTENCES += [(_identifier, GRANT.format(what=what, name=_name, terms=_terms)) for what in ("program", "library", "software", "file")]
            _full = _version if "." in _version else f"{_version}.0"
            RULES += [(f"{_family}-{_full}-{'or-later' if _more else 'only'}", [_identifier])]
SENTENCES += [(f"spdx:{name}", f"SPDX-License-Identifier: {name}") for name in SPDX]
# A bare version is an old way to say "only".
SENTENCES += [(f"spdx:{name}", f"SPDX-License-Identifier: {name[:-5]}") for name in SPDX if name.endswith("-only")]
RULES += [(name, [f"spdx:{name}"]) for name in SPDX]
# A text without any of these cannot hold a known sentence.
MENTIONS = r"(?i)licen|permi|redistribution|endorse|rights[\W_]+reserved|free[\W_]+software|public[\W_]+domain|compliance|[ag]plv|\bMPL\b|\bCC\b|CC0|creative[\W_]+commons|\bEUPL\b|GNU"
SUBJECTS = "work|software|project|program|library|file|code|document|package|module|content|text|article|page"
VERBS = "licensed|released|distributed|available|published"

# All openings become this one.
OPENING = "licensed under "
# What stands between two words of a sentence.
GAP = r"[\x20\n]"


def opening(gap: str = " ") -> str:
    """How a sentence that names a license may open, as a regular expression; `gap` stands between words."""
    return rf"(?:(?:this|the) (?:{SUBJECTS}) is )?(?:{VERBS}) under (?:(?:the|a|an) )?".replace(" ", gap)


def pieces(text: Column) -> Column:
    """The text's words in lower case, one space between them, a line feed before and after each piece, two where a
    paragraph ends."""
    cut = F.regexp_replace(F.lower(_tags(text)), r"\n[\x20\x09-\x0D]*\n[\x20\x09-\x0D]*", "\n\n")
    cut = F.regexp_replace(cut, r"(?<=[.;:!?])[\x20\x09\x0B-\x0D]++(?!\n)", "\n")
    words = F.regexp_replace(cut, r"[^\p{L}\p{N}\n]+", " ")
    return F.regexp_replace(F.concat(F.lit("\n"), words, F.lit("\n")), r"\x20?\n\x20?", "\n")


def _tags(text: Column) -> Column:
    """Lines with an SPDX tag: a tag before each license of the expression, and `+` in words."""
    tagged = lambda line: F.regexp_replace(
        F.regexp_replace(line, r"([0-9])\+", "$1-or-later"), r"\x20+(?:OR|AND|WITH)\x20+", "\nSPDX-License-Identifier: "
    )
    is_tag = lambda line: F.contains(line, F.lit("SPDX-License-Identifier:"))
    lines = F.transform(F.split(text, "\n"), lambda line: F.when(is_tag(line), tagged(line)).otherwise(line))
    return F.when(is_tag(text), F.array_join(lines, "\n")).otherwise(text)


def _plain(sentence: str) -> str:
    words = " ".join("".join(c if c.isalnum() else " " for c in sentence.lower()).split())
    return re.sub("^" + opening(), OPENING, words)


def known() -> dict[str, str]:
    """Normalised sentences and their identifiers."""
    return {_plain(sentence): identifier for identifier, sentence in SENTENCES}


def either(gap: str) -> str:
    """The known sentences as one regular expression, longer ones first; `gap` stands between words."""

    def tree(sentences: list[str]) -> dict:
        root: dict = {}
        for sentence in sentences:
            node = root
            for word in sentence.split():
                node = node.setdefault(word, {})
            node[""] = {}
        return root

    def written(node: dict) -> str:
        ways = []
        for word in sorted(w for w in node if w):
            rest, after = word, node[word]
            while len(after) == 1 and "" not in after:
                ((word, after),) = after.items()
                rest += gap + word
            more = written({w: n for w, n in after.items() if w})
            ways.append(rest + (f"(?:{gap}{more})" + ("?" if "" in after else "") if more else ""))
        return f"(?:{'|'.join(ways)})" if len(ways) > 1 else "".join(ways)

    opened = [s.removeprefix(OPENING) for s in known() if s.startswith(OPENING)]
    return f"(?:{opening(gap)}{written(tree(opened))}|{written(tree([s for s in known() if not s.startswith(OPENING)]))})"


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: `doc_id`, `sentence_ids` (identifiers of the known sentences in order, comma-joined), `licenses` (names in
    the order of the rules, each once, comma-joined), `n_sentences` known and `n_unmatched`, those no rule has used.

    A null or empty text has none; a null identifier is carried; repeated rows are scanned one by one; other columns are
    ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("_text"))
    found = F.when(F.col("_text").rlike(MENTIONS), _identifiers(F.col("_text"))).otherwise(F.array().cast("array<string>"))
    rows = rows.select("doc_id", found.alias("_ids"))
    matched = rows.withColumn("_state", F.when(F.size("_ids") > 0, _matched(F.col("_ids"))))
    left = F.coalesce(F.col("_state.rest"), F.lit(","))
    return matched.select(
        "doc_id",
        F.array_join("_ids", ",").alias("sentence_ids"),
        F.coalesce(F.array_join(F.array_distinct("_state.names"), ","), F.lit("")).alias("licenses"),
        F.size("_ids").cast("bigint").alias("n_sentences"),
        F.size(F.filter(F.split(left, ","), lambda i: (i != "") & (i != "-"))).cast("bigint").alias("n_unmatched"),
    )


def _identifiers(text: Column) -> Column:
    """Known sentences are looked for from the left; one that is found is used up."""
    found = F.regexp_extract_all(pieces(text), F.lit(rf"\n({either(GAP)})(?=\n)"), F.lit(1))
    of = F.map_from_arrays(F.array(*map(F.lit, known())), F.array(*map(F.lit, known().values())))
    return F.transform(
        found, lambda s: F.element_at(of, F.regexp_replace(F.translate(s, "\n", " "), "^" + opening(), OPENING))
    )


def _matched(ids: Column) -> Column:
    """Rules from the top over `,a,b,`; matched identifiers become `-`."""
    joined = F.concat(F.lit(","), F.array_join(ids, ","), F.lit(","))
    rules = F.array(
        *(
            F.struct(F.lit(name).alias("name"), F.lit("," + ",".join(i) + ",").alias("sequence"))
            for name, i in RULES
        )
    )
    start = F.struct(joined.alias("rest"), F.array().cast("array<string>").alias("names"))

    def step(state, rule):
        # Twice, as neighbours share the comma between them.
        once = F.replace(state["rest"], rule["sequence"], F.lit(",-,"))
        return F.struct(
            F.replace(once, rule["sequence"], F.lit(",-,")).alias("rest"),
            F.when(F.contains(state["rest"], rule["sequence"]), F.concat(state["names"], F.array(rule["name"])))
            .otherwise(state["names"])
            .alias("names"),
        )

    return F.aggregate(rules, start, step)
