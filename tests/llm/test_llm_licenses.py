import re

import duckdb
import pytest

from tidemark.llm import licenses, sql

MIT = "\n".join(
    f"{licenses.SENTENCES[k][0]}\n" + ("\n" if k == "mit_title" else "")
    for k in ("mit_title", "mit_grant", "mit_notice", "mit_warranty", "mit_liability")
)


def wrapped(text, width=60):
    lines, now = [], ""
    for word in text.split():
        if len(now) + len(word) > width:
            lines.append(now)
            now = ""
        now = f"{now} {word}".strip()
    return "\n".join([*lines, now])


def brute(text):
    """(sentences, licences) by plain string work."""
    known = licenses.dictionary()
    ids = []
    tagged = re.sub(licenses.SPDX_TAG, "\x01\\1 ", text or "")
    for sentence in re.sub(licenses.BOUNDARY, lambda m: (m[1] or "") + "\x01", tagged).split("\x01"):
        name = known.get(licenses.normal(sentence))
        if name or "\n" not in sentence:
            ids += [name] if name else []
            continue
        lines = [x for x in map(licenses.normal, sentence.split("\n")) if x]
        k = 0
        while k < len(lines):
            ends = range(min(len(lines), k + licenses.longest()), k, -1)
            ends = [k + 1, *ends]  # the line alone before the longest
            last = next((e for e in ends if " ".join(lines[k:e]) in known), None)
            ids += [] if last is None else [known[" ".join(lines[k:last])]]
            k = k + 1 if last is None else last
    left, found = ids, set()
    for name, rule in licenses.RULES:
        used, at = set(), -1
        while True:
            places = []
            for want in rule:
                at = next((k for k in range(at + 1, len(left)) if left[k] == want), None)
                if at is None:
                    break
                places.append(at)
            if at is None:
                break
            found.add(name)
            used.update(places)
        left = [x for k, x in enumerate(left) if k not in used]
    return ids, sorted(found)


APACHE = " ".join(licenses.SENTENCES[k][0] for k in ("apache_header", "apache_comply", "apache_copy", "apache_basis"))
CASES = {
    "full": MIT,
    "wrapped": "MIT License\n" + wrapped(licenses.SENTENCES["mit_grant"][0]) + "\n"
    + "\n".join(wrapped(licenses.SENTENCES[k][0]) for k in ("mit_notice", "mit_warranty")),
    "out of order": licenses.SENTENCES["mit_warranty"][0] + " " + licenses.SENTENCES["mit_grant"][0],
    "references": "Prose here.\nReleased under the MIT License.\nMore prose. LICENSED under CC BY-NC 4.0. End",
    "two": "This work is licensed under the GNU General Public License, version 3. "
    "Licensed under the Apache License, Version 2.0.\nLicensed under the MIT License.",
    "bsd": "1. " + " ".join(licenses.SENTENCES[k][0] for k in ("bsd_grant", "bsd_source", "bsd_binary")),
    "apache inside mit": "MIT License\n\n" + APACHE + "\n\n" + MIT.split("\n\n", 1)[1],
    "cc inside mit": MIT.replace("\nThe above", "\nLicensed under CC BY 4.0.\nThe above"),
    "behind 40 lines": "prose\n" + "---\n" * 40 + "Released under CC0 1.0",
    "behind 3 lines": "prose\n---\n***\n###\nReleased under\nCC0 1.0",
    "lgpl": "This library is free software; you can redistribute it and/or\nmodify it under the terms of"
    " the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\n"
    "version 2.1 of the License, or (at your option) any later version.",
    "begins inside": "Heading\nyou can redistribute it and/or modify\nit under the terms of the GNU General"
    " Public License as published by the Free Software Foundation, either version 3 of the License, or (at"
    " your option) any later version",
    "rule twice": " ".join(licenses.SENTENCES[k][0] for k in ("bsd_grant", "bsd_grant", "bsd_source", "bsd_binary") * 2),
    "none": "A license is a thing. Nothing is licensed here.",
    "accents": "Ünder the lîcense.\nReleased under the MIT License",
    "long": "word word. " * 40_000 + "\nReleased under the MIT License.\n" + "x | y\n" * 5_000,
    "empty": "",
    "null": None,
}


def test_cases(spark):
    rows = [(k, t) for k, t in CASES.items()] * 2
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id string, text string, sentences string")
    found = [(r.doc.doc_id, (r.sentences, r.licences)) for r in licenses.scan(docs).collect()]
    assert sorted(found) == sorted((k, brute(t)) for k, t in rows)
    by_id = dict(found)
    assert by_id["full"][1] == ["MIT"] and by_id["wrapped"][1] == ["MIT"]
    assert by_id["out of order"][1] == [] and by_id["bsd"][1] == ["BSD-2-Clause"]
    assert by_id["apache inside mit"][1] == ["Apache-2.0", "MIT"]
    assert by_id["cc inside mit"][1] == ["CC-BY-4.0", "MIT"] and by_id["lgpl"][1] == ["LGPL-2.1"]
    assert by_id["behind 40 lines"][0] == by_id["behind 3 lines"][0] == ["cc0_reference"]
    assert by_id["begins inside"][0] == ["gpl_free"]
    assert by_id["references"][1] == ["CC-BY-NC-4.0", "MIT"]
    assert by_id["two"][1] == ["Apache-2.0", "GPL-3.0", "MIT"]


def test_sql_equals_the_scan_on_the_cases(spark):
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id INTEGER, text VARCHAR)")
    texts = [t for k, t in CASES.items() if k != "long"]
    db.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    want = {r[0]: (r[2], r[3]) for r in db.execute(sql.licences()).fetchall()}
    assert want == {k: tuple(",".join(x) for x in brute(t)) for k, t in enumerate(texts)}


def test_odd_and_empty_tables(odd_docs, no_docs):
    rows = licenses.scan(odd_docs).collect()
    assert len(rows) == odd_docs.count() and not any(r.sentences or r.licences for r in rows)
    assert licenses.scan(no_docs).collect() == []


def test_every_sentence_holds_a_marker_and_names_are_known():
    marks = licenses.markers()
    assert all(any(m in s for m in marks) for s in licenses.dictionary())
    assert {n for _, rule in licenses.RULES for n in rule} <= set(licenses.SENTENCES)


@pytest.mark.parametrize("name", sorted(licenses.SENTENCES))
def test_identifiers_fit_the_rule_pattern(name):
    assert re.fullmatch("[a-z0-9_]+", name)


def test_every_form_of_every_sentence_is_found_alone(spark):
    forms = [(name, form) for name, forms in licenses.SENTENCES.items() for form in forms]
    docs = spark.createDataFrame(forms, "doc_id string, text string")
    found = [(r.doc.doc_id, r.doc.text, r.sentences) for r in licenses.scan(docs).collect()]
    assert sorted(found) == sorted((name, form, [name]) for name, form in forms)


def test_spdx_lines(spark):
    tag = "SPDX-License-Identifier:"
    texts = {
        f"// {tag} MIT\npragma solidity;": ["MIT"],
        f"/* Copyright X. {tag}\tBSD-2-Clause */\nint main": ["BSD-2-Clause"],
        f"<!-- head\n  spdx-license-identifier : BSD-3-Clause -->\nprose": ["BSD-3-Clause"],
        f"dnl {tag} GPL-2.0-only\n# {tag} Apache-2.0\n": ["Apache-2.0", "GPL-2.0"],
        f"{tag}\nISC": ["ISC"],
        f"{tag}\n\nISC": [],
        f"{tag} MITRE": [],
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert {r.doc.text: r.licences for r in licenses.scan(docs).collect()} == texts


def test_wrapped_sentences_of_any_number_of_lines_between_others(spark):
    grant = licenses.SENTENCES["mit_grant"][0]
    texts = {
        "Heading\n" + grant.replace(" ", "\n"): ["mit_grant"],
        "Heading\n * " + grant.replace(" ", "\n *\n * "): ["mit_grant"],
        "One\n// Released under\n// the Apache License,\n// Version 2.0\nprose": ["apache_reference"],
        "Licensed under CC\n\tBY-NC 4.0\nprose\nLicensed\nunder CC BY 4.0\nprose": [
            "cc_by_nc_reference", "cc_by_reference",
        ],
        "not Released\nunder CC0 1.0\nprose\nReleased under CC0\n1.0 not": [],
        "prose\n" + "---\n" * 20_000 + "Released under\nCC0 1.0\n" + "---\n" * 20_000 + "x": ["cc0_reference"],
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert {r.doc.text: r.sentences for r in licenses.scan(docs).collect()} == texts
