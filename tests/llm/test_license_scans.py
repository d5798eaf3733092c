import os
import random
import re

import duckdb
import pytest

from cairn.llm.license_scans import ALONE, RULES, SENTENCES, known_sentences, licenses_sql, needed_words, scan_licenses

SF_DIR = os.environ.get("CAIRN_SF_DIR", "/root/testdata/sf0.001")
MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software. And more."
AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", without warranty of any kind.'
GPL3 = """
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
"""
BSD = [
    "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n",
    " 1. Redistributions of source code must retain the above copyright notice,\n    this list of conditions and the following disclaimer.\n",
    """ 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
    the following disclaimer in the documentation and/or other materials provided with the distribution.\n""",
    """ 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
    products derived from this software without specific prior written permission.\n""",
]
CASES = [
    (None, ""), ("", ""), (" \n\t", ""), ("no licence", ""),
    ("Hello.\nReleased under the MIT License.", "MIT"), ("Hello\nReleased under the MIT License\nBye", "MIT"),
    (f"{MIT} {AS_IS}", "MIT"), (f"{AS_IS} {MIT}", ""), (f"{MIT}\nReleased under the MIT License\n{AS_IS}", "MIT"),
    ("Licensed under CC BY-NC 4.0. Licensed under the Apache License, Version 2.0.", "Apache-2.0,CC-BY-NC-4.0"),
    ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file', "Apache-2.0"),
    ("It was not released under the MIT License.", ""), ("Released under the MIT Licenses.", ""),
    (GPL3, "GPL-3.0"), (GPL3.replace("\n", "\r\n"), "GPL-3.0"), (GPL3.replace("version 3", "version 4"), ""),
    ("".join(BSD), "BSD-3-Clause"), ("".join(BSD[:3]), "BSD-2-Clause"), ("".join(BSD + BSD[:3]), "BSD-2-Clause,BSD-3-Clause"),
    ("".join(BSD + BSD), "BSD-3-Clause"), ("x " * 200_000 + "\nReleased under the MIT License.", "MIT"),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
     "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "LGPL-2.1"),
    (GPL3.replace("Foundation, either version 3", "Foundation; either version 2"), "GPL-2.0"),
    ("Released under the MIT License. Released under the MIT License.", "MIT"), ("日本語。\nLicensed under CC BY 4.0", "CC-BY-4.0"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, text, "x", 1) for i, (text, _) in enumerate(CASES)]
    return spark.createDataFrame([*rows, rows[4], (None, "Licensed under CC BY 4.0.", None, None)], "doc_id long, text string, licenses string, n_sentences int")


def test_license_scans(spark, docs):
    found = scan_licenses(docs).collect()
    assert len(found) == len(CASES) + 2
    assert {r.doc_id: ",".join(r.licenses) for r in found if r.doc_id is not None} == {i: want for i, (_, want) in enumerate(CASES)}
    assert [r.licenses for r in found if r.doc_id is None] == [["CC-BY-4.0"]]
    assert all(r.n_sentences == len(r.sentence_ids) for r in found)
    assert scan_licenses(docs.limit(0)).collect() == []


def test_license_scans_equal_their_sql(docs):
    connection = duckdb.connect()
    connection.register("documents", docs.select("doc_id", "text").toPandas())
    want = connection.execute(licenses_sql()).fetchall()
    got = [(r.doc_id, r.n_sentences, ",".join(r.sentence_ids), ",".join(r.licenses)) for r in scan_licenses(docs).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    clean = [(None if r[0] is None or r[0] != r[0] else int(r[0]), *r[1:]) for r in want]
    assert sorted(got, key=key) == sorted(clean, key=key)


def test_every_sentence_is_found_by_itself_and_needs_a_word(spark):
    known = known_sentences(SENTENCES)
    words = needed_words(known)
    assert all(any(word in text for word in words) for text in known)
    docs = spark.createDataFrame([(i, text + ".") for i, text in enumerate(SENTENCES)], "doc_id long, text string")
    names = list(SENTENCES.values())
    assert {r.doc_id: r.sentence_ids[-1:] for r in scan_licenses(docs).collect()} == {i: [name] for i, name in enumerate(names)}


def test_own_tables(spark):
    docs = spark.createDataFrame([(1, "House rules apply. Ask first.")], "doc_id long, text string")
    found = scan_licenses(docs, {"House rules apply": "house", "Ask first": "ask"}, [("House", ("house", "ask"))]).first()
    assert (found.n_sentences, found.sentence_ids, found.licenses) == (2, ["house", "ask"], ["House"])


MORE = [
    ("Prose.\nAll rights reserved.\nMore prose", "All-rights-reserved"), ("All rights reserved. All rights reserved.", "All-rights-reserved"),
    ("Copyright 2020 A. All rights reserved.\nReleased under the MIT License.", "MIT"), ("We hold that all rights reserved are kept.", ""),
    ("Released under the MIT License.\nAll rights reserved.", "MIT"), ("Copyright A. All rights reserved.\n" + "".join(BSD), "BSD-3-Clause"),
    ("".join(BSD).replace("the copyright holder", "the University of X"), "BSD-3-Clause"), ("".join(BSD).replace("the copyright holder", "Y Inc."), "BSD-3-Clause"),
    ("".join(BSD[:3]) + "3. The name of the author may not be used to endorse or promote products derived\nfrom this software without specific prior written permission.", "BSD-3-Clause"),
    ("".join(BSD[:3]) + "3. Users must dance.\n", "BSD-other"),
    ("".join(BSD[:3]) + "3. All advertising materials mentioning features or use of this software must display the following acknowledgement:\nX.\n" + BSD[3].replace("3.", "4."), "BSD-4-Clause"),
    (GPL3.replace("Foundation, either", "Foundation; either"), "GPL-3.0"), (GPL3.replace("version 3", "version 2"), "GPL-2.0"),
    (GPL3.replace("GNU General", "GNU Lesser General"), "LGPL-3.0"), (GPL3.replace("GNU General", "GNU Affero General").replace("Foundation, either", "Foundation; either"), "AGPL-3.0"),
    ("This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License version 2 as\npublished by the Free Software Foundation.", "GPL-2.0-only"),
    (GPL3.replace(", either version 3 of the License, or\n# (at your option) any later version.", "; version 2 of the License."), "GPL-2.0-only"),
    ("        GNU GENERAL PUBLIC LICENSE\n      Version 3, 29 June 2007\n\n Copyright", "GPL-3.0"), ("   Apache License\n   Version 2.0, January 2004\n", "Apache-2.0"),
]


def test_reserved_rights_other_clauses_and_versions(spark):
    docs = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(MORE)], "doc_id long, text string")
    got = sorted((r.doc_id, ",".join(r.sentence_ids), ",".join(r.licenses)) for r in scan_licenses(docs).collect())
    assert [r[2] for r in got] == [want for _, want in MORE]
    connection = duckdb.connect()
    connection.register("documents", docs.toPandas())
    assert sorted((r[0], r[2], r[3]) for r in connection.execute(licenses_sql()).fetchall()) == got


LONG_NAME = "the Regents of the University of a very long name, its many departments, " * 6 + "and their friends"
NEW = [
    ("".join(BSD).replace("the copyright holder", LONG_NAME), "BSD-3-Clause"), ("".join(BSD).replace("the copyright holder", "X Co. and Y Inc."), "BSD-3-Clause"),
    ("".join(BSD).replace("from this software", "from this library"), "BSD-3-Clause"), ("bsd third clause\nBSD third clause.", ""),
    ("".join(BSD[:3]) + "bsd third clause\n", "BSD-2-Clause"), ("".join(BSD[:3]) + "\x03\nMore.", "BSD-2-Clause"),
    ("// SPDX-License-Identifier: Apache-2.0\nint x;", "Apache-2.0"), ("# SPDX-License-Identifier:MIT", "MIT"), ("/* SPDX-License-Identifier: GPL-2.0-only */", "GPL-2.0-only"),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", ""), ("We read SPDX-License-Identifier: Zlib lines", ""), ("SPDX-License-Identifier: CC0-1.0. SPDX-License-Identifier: BSL-1.0.", "BSL-1.0,CC0-1.0"),
    ("Boost Software License - Version 1.0 - August 17th, 2003\n\nPermission", "BSL-1.0"), ("CC0 1.0 Universal\n\nStatement of Purpose", "CC0-1.0"),
    ("This software is provided 'as-is', without any express or implied\nwarranty. In no event. Permission is granted to anyone to use this software for any purpose,\nincluding commercial "
     "applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:\n1. x", "Zlib"),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
     "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.", "0BSD"),
    ("Eclipse Public License - v 2.0\n", "EPL-2.0"), ("The Artistic License 2.0\n", "Artistic-2.0"), ("neither the name of " * 400, ""), ("the name of " * 3000, ""),
]


def test_long_names_positions_and_more_licences(spark):
    docs = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(NEW)], "doc_id long, text string")
    got = sorted((r.doc_id, ",".join(r.sentence_ids), ",".join(r.licenses)) for r in scan_licenses(docs).collect())
    assert [r[2] for r in got] == [want for _, want in NEW]
    connection = duckdb.connect()
    connection.register("documents", docs.toPandas())
    assert sorted((r[0], r[2], r[3]) for r in connection.execute(licenses_sql()).fetchall()) == got
    bsd3 = scan_licenses(spark.createDataFrame([(1, "".join(BSD))], "doc_id long, text string")).first()
    assert bsd3.sentence_ids == ["bsd-permission", "bsd-source", "bsd-binary", "bsd-names"] and bsd3.n_sentences == 4


def plain_tokens(text):
    """Words, '.' for the end of a sentence and '/' for a line feed."""
    text = re.sub("spdx-license-identifier:[ \t]*", "\nspdx license identifier ", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    out, at = [], 0
    while at < len(text):
        if match := re.compile(r"[.!?:;][\"')\]]*[ \t-\r]+").match(text, at):
            out.append(".")
        elif match := re.compile(r"[^\W_]+").match(text, at):
            out.append(match.group())
        elif text[at] == "\n":
            out.append("/")
        at = match.end() if match else at + 1
    return out


def plain_scan(text):
    """Identifiers and licences of a text, token by token."""
    tokens = plain_tokens(text)
    stops, known = (".", "/"), {tuple(sentence.split()): name for sentence, name in known_sentences(SENTENCES).items()}

    def words_from(at, want):
        """The place after the wanted words, line feeds between them passed over; None if they are not there."""
        for k, word in enumerate(want):
            while k and at < len(tokens) and tokens[at] == "/":
                at += 1
            if at >= len(tokens) or (tokens[at] not in word if isinstance(word, tuple) else tokens[at] != word):
                return None
            at += 1
        return at

    def name_clause(at):
        """Tokens of a names clause, whoever it names, as those of the copyright holder's."""
        holder = "neither the name of the copyright holder nor the names of its contributors".split()
        if after := words_from(at, ["neither", "the", ("name", "names"), "of"]):
            dots, end = 0, after
            while end < len(tokens) and dots <= 5:
                rest = words_from(end, ["nor", "the", "names", "of", ("its", "their", "any"), "contributors"])
                if rest and end > after and tokens[end - 1] != "nor":
                    return holder, rest
                dots += tokens[end] == "." and tokens[end - 1] != "."
                end += 1
        if (after := words_from(at, ["the", ("name", "names"), "of"])) and not (at and tokens[at - 1] == "neither"):
            end = after
            while end < len(tokens) and tokens[end] != ".":
                rest = words_from(end, "may not be used to endorse".split())
                if rest and end > after:
                    return [*holder, *"may be used to endorse".split()], rest
                end += 1
        return None

    at = 0
    while at < len(tokens):
        if found := name_clause(at):
            tokens[at : found[1]] = found[0]
            at += len(found[0])
        else:
            at += 1
    for at in range(len(tokens)):
        if (end := words_from(at, ["products", "derived", "from", "this", ("library", "program", "package")])) is not None:
            tokens[end - 1] = "software"
    found, at = [], 0
    while at < len(tokens):
        if at and tokens[at - 1] not in stops or tokens[at] in stops:
            at += 1
            continue
        ends = [(end, name) for words, name in known.items() if (end := words_from(at, words)) and (end == len(tokens) or tokens[end] in stops)]
        if ends:
            at, name = max(ends)
            found.append(name)
            if name == "bsd-binary":
                third = at
                while third < len(tokens) and tokens[third] in stops:
                    third += 1
                if tokens[at : at + 1] == ["."] and tokens[third : third + 2] == ["3", "."]:
                    found.append("bsd-third")
        else:
            at += 1
    left, licences = list(found), set()
    for licence, wanted in RULES:
        if wanted[0] == ALONE:
            if not licences and all(name in left for name in wanted[1:]):
                licences.add(licence)
            continue
        while True:
            places, low = [], 0
            for name in wanted:
                if name not in left[low:]:
                    break
                places.append(left.index(name, low))
                low = places[-1] + 1
            if len(places) < len(wanted):
                break
            licences.add(licence)
            left = [name for k, name in enumerate(left) if k not in places]
    return [name for name in found if name != "bsd-third"], sorted(licences)


def test_license_scans_equal_a_plain_version(spark):
    tables = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").collect()]
    rng = random.Random(3)
    parts = [text for text, _ in [*CASES, *MORE, *NEW] if text and len(text) < 2000] + list(SENTENCES)
    mixed = [rng.choice(["", " ", "x "]).join(rng.choice([" ", "\n", ". ", ", ", ""]) + rng.choice(parts) for _ in range(rng.randrange(1, 6))) for _ in range(300)]
    texts = [text for text, _ in [*CASES, *MORE, *NEW]] + list(SENTENCES) + tables + mixed
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in scan_licenses(docs).collect():
        if r.doc_id is not None and len(texts[r.doc_id] or "") < 20_000:
            assert (r.sentence_ids, r.licenses) == plain_scan(texts[r.doc_id]), texts[r.doc_id]
