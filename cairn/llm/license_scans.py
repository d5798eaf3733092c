r"""License scans: known licence sentences become identifiers, ordered rules over them name licences.

A sentence ends after ``.``, ``!``, ``?``, ``:`` or ``;`` (and quotes or brackets that close there)
before a blank. It may also begin and end at a line feed, so that a notice on a line of its own needs
no full stop, while a sentence wrapped over several lines is still one. Normalised, A-Z are in lower
case and everything between letters and digits is one space, which takes comment signs away too. Every
known sentence found this way, from left to right, gives its identifier.

Rules are tried in their order. A rule matches where its identifiers follow one another, with any others
in between, and takes these away for the rules behind it: the three-clause licence is not the two-clause
one as well. Each document gets all licences whose rules match, sorted. A rule that begins with ``ALONE``
matches only where no rule before it did.

Whoever a names clause protects, however long the name, it is read as the copyright holder's, and what it protects as
software. A numbered third clause behind the two of the two-clause licence has an identifier of its own, taken from its
place, so that a text with another third clause is ``BSD-other``. A licence line of a source file (``SPDX``) that names
one licence is a sentence.

Null and empty texts have no sentence and no licence. Repeated rows are scanned each on its own. Other
columns are ignored. All is done by column functions; the tables are constants of the plan, and a text
without any of the few words that every known sentence needs is not cut at all.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.line_dedup import lower

# Sentences of public licence texts and notices, and their identifiers.
SENTENCES = {
    "Released under the MIT License": "mit-notice",
    "Licensed under the MIT License": "mit-notice",
    "This project is licensed under the MIT License": "mit-notice",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software": "mit-permission",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions": "mit-permission",
    "The software is provided as is, without warranty of any kind": "mit-as-is",
    "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement": "mit-as-is",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies": "isc-permission",
    "The software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "isc-as-is",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met": "bsd-permission",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer": "bsd-source",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution": "bsd-binary",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "Licensed under the Apache License, Version 2.0": "apache2-notice",
    "Licensed under the Apache License, Version 2.0 (the License)": "apache2-notice",
    "This work is licensed under the GNU General Public License, version 3": "gpl3-notice",
    "All rights reserved": "rights-reserved",
    "All advertising materials mentioning features or use of this software must display the following acknowledgement": "bsd-advertising",
    "Apache License Version 2.0, January 2004": "apache2-text",
    "GNU General Public License Version 2, June 1991": "gpl2-text",
    "GNU General Public License Version 3, 29 June 2007": "gpl3-text",
    "GNU Lesser General Public License Version 2.1, February 1999": "lgpl2.1-text",
    "GNU Lesser General Public License Version 3, 29 June 2007": "lgpl3-text",
    "GNU Affero General Public License Version 3, 19 November 2007": "agpl3-text",
    "Mozilla Public License Version 2.0": "mpl2-text",
    "This program is free software": "gpl-free",
    "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation": "gpl-terms",
    "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version": "gpl3-terms",
    "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version": "agpl3-terms",
    "This library is free software": "lgpl-free",
    "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation": "lgpl-terms",
    "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version": "gpl2-terms",
    "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 2 of the License": "gpl2-only-terms",
    "you can redistribute it and/or modify it under the terms of the GNU General Public License, version 2, as published by the Free Software Foundation": "gpl2-only-terms",
    "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation": "agpl-terms",
    "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version": "lgpl2.1-terms",
    "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version": "lgpl3-terms",
    "version 2 of the License": "version-2-only",
    "either version 3 of the License, or (at your option) any later version": "version-3",
    "either version 2 of the License, or (at your option) any later version": "version-2",
    "either version 2.1 of the License, or (at your option) any later version": "version-2.1",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v": "mpl-terms",
    "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/": "mpl2-copy",
    "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/": "mpl2-copy",
    "Licensed under CC BY-NC 4.0": "cc-by-nc4-notice",
    "Licensed under CC BY-SA 4.0": "cc-by-sa4-notice",
    "Licensed under CC BY 4.0": "cc-by4-notice",
    "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by4-notice",
    "This is free and unencumbered software released into the public domain": "unlicense-domain",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted": "0bsd-permission",
    "This software is provided as-is, without any express or implied warranty": "zlib-as-is",
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions": "zlib-permission",
    "Boost Software License - Version 1.0 - August 17th, 2003": "bsl1-text",
    "Distributed under the Boost Software License, Version 1.0": "bsl1-notice",
    "CC0 1.0 Universal": "cc0-text",
    "Licensed under CC0 1.0": "cc0-notice",
    "Eclipse Public License - v 2.0": "epl2-text",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0": "epl2-notice",
    "COMMON DEVELOPMENT AND DISTRIBUTION LICENSE (CDDL) Version 1.0": "cddl1-text",
    "PYTHON SOFTWARE FOUNDATION LICENSE VERSION 2": "psf2-text",
    "The Artistic License 2.0": "artistic2-text",
    "GNU Free Documentation License Version 1.3, 3 November 2008": "gfdl1.3-text",
    "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation": "gfdl1.3-notice",
}
#: Identifiers of the licence lines of source files, and the licences they stand for.
SPDX = {
    "0BSD": "0BSD", "AGPL-3.0-only": "AGPL-3.0", "AGPL-3.0-or-later": "AGPL-3.0", "Apache-2.0": "Apache-2.0", "Artistic-2.0": "Artistic-2.0",
    "BSD-2-Clause": "BSD-2-Clause", "BSD-3-Clause": "BSD-3-Clause", "BSD-4-Clause": "BSD-4-Clause", "BSL-1.0": "BSL-1.0", "CC-BY-4.0": "CC-BY-4.0",
    "CC-BY-NC-4.0": "CC-BY-NC-4.0", "CC-BY-SA-4.0": "CC-BY-SA-4.0", "CC0-1.0": "CC0-1.0", "CDDL-1.0": "CDDL-1.0", "EPL-2.0": "EPL-2.0",
    "GFDL-1.3-only": "GFDL-1.3", "GFDL-1.3-or-later": "GFDL-1.3", "GPL-2.0-only": "GPL-2.0-only", "GPL-2.0-or-later": "GPL-2.0", "GPL-3.0-only": "GPL-3.0",
    "GPL-3.0-or-later": "GPL-3.0", "ISC": "ISC", "LGPL-2.1-only": "LGPL-2.1", "LGPL-2.1-or-later": "LGPL-2.1", "LGPL-3.0-only": "LGPL-3.0",
    "LGPL-3.0-or-later": "LGPL-3.0", "MIT": "MIT", "MPL-2.0": "MPL-2.0", "PSF-2.0": "PSF-2.0", "Unlicense": "Unlicense", "Zlib": "Zlib",
}
SENTENCES |= {f"SPDX License Identifier {name}": f"spdx-{name}" for name in SPDX}
#: What stands in a cut text for a numbered third clause. Signs of the text itself are gone by then.
THIRD, THIRD_ID = "\x03", "bsd-third"
#: Licences and the identifiers that must follow one another, in the order in which they are tried.
ALONE = "alone"
RULES = (
    ("BSD-4-Clause", ("bsd-permission", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-names")),
    ("BSD-3-Clause", ("bsd-permission", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-other", ("bsd-permission", "bsd-source", "bsd-binary", "bsd-third")),
    ("BSD-2-Clause", ("bsd-permission", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-permission", "mit-as-is")),
    ("MIT", ("mit-notice",)),
    ("ISC", ("isc-permission", "isc-as-is")),
    ("Apache-2.0", ("apache2-notice",)),
    ("Apache-2.0", ("apache2-text",)),
    ("AGPL-3.0", ("gpl-free", "agpl3-terms")),
    ("AGPL-3.0", ("gpl-free", "agpl-terms", "version-3")),
    ("AGPL-3.0", ("agpl3-text",)),
    ("LGPL-3.0", ("lgpl-free", "lgpl-terms", "version-3")),
    ("LGPL-3.0", ("lgpl-free", "lgpl3-terms")),
    ("LGPL-3.0", ("gpl-free", "lgpl-terms", "version-3")),
    ("LGPL-3.0", ("gpl-free", "lgpl3-terms")),
    ("LGPL-3.0", ("lgpl3-text",)),
    ("LGPL-2.1", ("lgpl-free", "lgpl2.1-terms")),
    ("LGPL-2.1", ("lgpl2.1-text",)),
    ("LGPL-2.1", ("lgpl-free", "lgpl-terms", "version-2.1")),
    ("GPL-2.0", ("gpl-free", "gpl-terms", "version-2")),
    ("GPL-2.0", ("gpl-free", "gpl2-terms")),
    ("GPL-2.0", ("gpl2-text",)),
    ("GPL-2.0-only", ("gpl-free", "gpl-terms", "version-2-only")),
    ("GPL-2.0-only", ("gpl-free", "gpl2-only-terms")),
    ("GPL-3.0", ("gpl-free", "gpl-terms", "version-3")),
    ("GPL-3.0", ("gpl-free", "gpl3-terms")),
    ("GPL-3.0", ("gpl3-text",)),
    ("GPL-3.0", ("gpl3-notice",)),
    ("MPL-2.0", ("mpl-terms", "mpl2-copy")),
    ("MPL-2.0", ("mpl2-text",)),
    ("CC-BY-NC-4.0", ("cc-by-nc4-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa4-notice",)),
    ("CC-BY-4.0", ("cc-by4-notice",)),
    ("Unlicense", ("unlicense-domain",)),
    ("0BSD", ("0bsd-permission", "isc-as-is")),
    ("Zlib", ("zlib-as-is", "zlib-permission")),
    ("BSL-1.0", ("bsl1-text",)),
    ("BSL-1.0", ("bsl1-notice",)),
    ("CC0-1.0", ("cc0-text",)),
    ("CC0-1.0", ("cc0-notice",)),
    ("EPL-2.0", ("epl2-text",)),
    ("EPL-2.0", ("epl2-notice",)),
    ("CDDL-1.0", ("cddl1-text",)),
    ("PSF-2.0", ("psf2-text",)),
    ("Artistic-2.0", ("artistic2-text",)),
    ("GFDL-1.3", ("gfdl1.3-text",)),
    ("GFDL-1.3", ("gfdl1.3-notice",)),
    *((license_name, (f"spdx-{name}",)) for name, license_name in SPDX.items()),
    ("All-rights-reserved", (ALONE, "rights-reserved")),
)

# What cuts and normalises a text, in order. A control character is the end of a sentence; ends are doubled, so
# that two sentences that meet can have one each.
SENTENCE_END = r"""[.!?:;]["')\]]*[\x20\x09-\x0D]+"""
# A name goes to the end of its sentence; an abbreviation may end one, but no more than four of them.
STEPS = (
    (r"spdx-license-identifier:[ \t]*", "\nspdx license identifier "),
    (SENTENCE_END, "\x01"),
    (r"[^\p{L}\p{N}\x01\n]+", " "),
    (r" ?\x01[ \x01\n]*", "\x01\x01"),
    (r" ?\n[ \n]*", "\n\n"),
    (r"^ +| +$", ""),
    (
        r"neither[ \n]+the[ \n]+names?[ \n]+of[ \n]+[^\x01]+?(?:\x01\x01[^\x01]+?){0,4}?[ \n\x01]+nor[ \n]+the[ \n]+names[ \n]+of[ \n]+(?:its|their|any)[ \n]+contributors",
        "neither the name of the copyright holder nor the names of its contributors",
    ),
    (
        r"the[ \n]+names?[ \n]+of[ \n]+[^\x01]+?[ \n]+may[ \n]+not[ \n]+be[ \n]+used[ \n]+to[ \n]+endorse",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse",
    ),
    (r"products[ \n]+derived[ \n]+from[ \n]+this[ \n]+(?:library|program|package)", "products derived from this software"),
    (r"provided[ \n]+with[ \n]+the[ \n]+distribution\x01\x01 ?3\x01\x01", f"provided with the distribution\x01\x01{THIRD}\x01\x01"),
)


def normalised(sentence: str) -> str:
    return " ".join(re.findall(r"[a-z0-9]+", sentence.lower()))


def known_sentences(sentences: Mapping[str, str]) -> dict[str, str]:
    """Normalised sentences and their identifiers."""
    for sentence in sentences:
        if re.search(SENTENCE_END, sentence.strip() + "."):
            raise ValueError(f"more than one sentence: {sentence}")
    return {normalised(sentence): name for sentence, name in sentences.items()}


def cut_sentences(sentences: Mapping[str, str]) -> dict[str, str]:
    """What is looked for in a cut text: the sentences, and the third clause."""
    return known_sentences(sentences) | {THIRD: THIRD_ID}


def needed_words(sentences: Mapping[str, str]) -> list[str]:
    """Few words of which every sentence has one: the word that most sentences have, then of those without it."""
    left, chosen = [set(text.split()) for text in sentences], []
    while left:
        words = sorted({word for words in left for word in words if len(word) > 3} or set.union(*left))
        best = max(words, key=lambda word: sum(word in words for words in left))
        chosen.append(best)
        left = [words for words in left if best not in words]
    return chosen


def sentence_pattern(sentences: Mapping[str, str]) -> str:
    """Any known sentence between two ends, the longest first; a line feed may stand for a space inside."""
    texts = sorted(sentences, key=lambda text: (-len(text), text))
    return r"(?:\A|[\x01\n])(" + "|".join(text.replace(" ", r"(?: |\n\n)") for text in texts) + r")(?:\z|[\x01\n])"


def rule_pattern(identifiers: Sequence[str], group: str) -> tuple[str, str]:
    """A pattern over ``<id><id>...``, and what stays when its identifiers are taken away: the others and a ``!``."""
    alone = identifiers[0] == ALONE
    parts = [f"<{re.escape(name)}>" for name in identifiers[alone:]]
    if alone:
        return "^([^!]*?)" + "([^!]*?)".join(parts) + "([^!]*)$", "".join(f"{group}{i}" for i in range(1, len(parts) + 2)) + "!"
    return "(.*?)".join(parts), "".join(f"{group}{i}" for i in range(1, len(parts))) + "!"


def _found(text: Column, sentences: Mapping[str, str]) -> Column:
    plain = text
    for pattern, by in STEPS:
        plain = F.regexp_replace(plain, pattern, by)
    hits = F.regexp_extract_all(plain, F.lit(sentence_pattern(sentences)), F.lit(1))
    known = F.create_map(*(F.lit(x) for pair in sentences.items() for x in pair))
    return F.transform(hits, lambda hit: F.try_element_at(known, F.replace(hit, F.lit("\n\n"), F.lit(" "))))


def scan_licenses(
    documents: DataFrame, sentences: Mapping[str, str] = SENTENCES, rules: Sequence[tuple[str, Sequence[str]]] = RULES
) -> DataFrame:
    """``doc_id``, ``n_sentences`` (that are known), ``sentence_ids`` in order and ``licenses``."""
    known = known_sentences(sentences)
    cut = cut_sentences(sentences)
    text = lower(F.coalesce(F.col("text"), F.lit("")))
    may_hold = F.lit(False)
    for word in needed_words(known):
        may_hold |= F.contains(text, F.lit(word))
    ids = F.when(may_hold, _found(text, cut)).otherwise(F.array().cast("array<string>"))
    # A generator, so that the text is cut once, whatever is asked of the result.
    found = documents.select(F.col("doc_id").cast("long"), F.explode(F.array(ids)).alias("marks"))
    rest = F.array_join(F.transform("marks", lambda name: F.concat(F.lit("<"), name, F.lit(">"))), "")
    held = []
    for name, identifiers in rules:
        pattern, others = rule_pattern(identifiers, "$")
        held.append(F.when(rest.rlike(pattern), F.lit(name)))
        rest = F.regexp_replace(rest, pattern, others)
    # nobody wrote the mark of a third clause
    written = F.filter("marks", lambda name: name != THIRD_ID)
    licenses = F.when(F.size("marks") > 0, F.sort_array(F.array_distinct(F.array_compact(F.array(*held)))))
    return found.select(
        "doc_id",
        F.size(written).cast("long").alias("n_sentences"),
        written.alias("sentence_ids"),
        F.coalesce(licenses, F.array().cast("array<string>")).alias("licenses"),
    )


def licenses_sql(sentences: Mapping[str, str] = SENTENCES, rules: Sequence[tuple[str, Sequence[str]]] = RULES) -> str:
    """The same rows from ``documents`` in DuckDB's SQL, lists as text."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def controls(text: str) -> str:
        for sign in (1, 3, 10):
            text = text.replace(chr(sign), f"' || chr({sign}) || '")
        return text

    known = cut_sentences(sentences)
    plain = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    for pattern, by in STEPS:
        plain = f"regexp_replace({plain}, {quoted(pattern)}, {controls(quoted(by))}, 'g')"
    pairs = ", ".join(f"{controls(quoted(text))}: {quoted(name)}" for text, name in known.items())
    steps = [
        f"cut AS (SELECT doc_id, regexp_extract_all({plain}, {controls(quoted(sentence_pattern(known)))}, 1) AS hits FROM documents)",
        f"found AS (SELECT doc_id, list_transform(hits, lambda h: map_extract_value(MAP {{{pairs}}}, replace(h, chr(10) || chr(10), ' '))) AS ids FROM cut)",
        "s0 AS (SELECT doc_id, ids, coalesce('<' || array_to_string(ids, '><') || '>', '') AS rest, CAST([] AS VARCHAR[]) AS held FROM found)",
    ]
    for i, (name, identifiers) in enumerate(rules):
        pattern, others = rule_pattern(identifiers, "\\")
        steps.append(
            f"s{i + 1} AS (SELECT doc_id, ids, regexp_replace(rest, {quoted(pattern)}, {quoted(others)}, 'g') AS rest, "
            f"CASE WHEN regexp_matches(rest, {quoted(pattern)}) THEN list_append(held, {quoted(name)}) ELSE held END AS held FROM s{i})"
        )
    return (
        "WITH " + ",\n".join(steps) + f"\nSELECT doc_id, CAST(len(written) AS BIGINT) AS n_sentences, array_to_string(written, ',') AS sentence_ids, "
        f"array_to_string(list_sort(list_distinct(held)), ',') AS licenses FROM (SELECT *, list_filter(ids, lambda name: name <> {quoted(THIRD_ID)}) AS written FROM s{len(rules)})"
    )
