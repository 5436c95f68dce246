"""Licence scans: known licence sentences, then ordered rules over their identifiers."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CUT = "\x01"
# A sentence ends at a mark before white space, or at a blank line.
BOUNDARY = r"([.!?;:])[\x20\x09-\x0D]+|\n[\x20\x09\x0B-\x0D]*\n"
# The colon of this tag ends no sentence, and whatever stands before the tag is another sentence.
SPDX_TAG = r"(?i)(SPDX-License-Identifier)[\x20\x09]*:"

# Sentences of public licence texts and notices.
SENTENCES: dict[str, tuple[str, ...]] = {
    "mit_title": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "mit_grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        ' software and associated documentation files (the "Software"), to deal in the Software'
        " without restriction, including without limitation the rights to use, copy, modify, merge,"
        " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons"
        " to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "mit_notice": (
        "The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software.",
    ),
    "mit_warranty": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,'
        " INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR"
        " PURPOSE AND NONINFRINGEMENT.",
    ),
    "mit_liability": (
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR"
        " OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT"
        " OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "mit_reference": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License.",
        "This work is licensed under the MIT License.",
        "Licensed under the MIT License (the License).",
        "SPDX-License-Identifier: MIT",
    ),
    "isc_title": ("ISC License", "The ISC License"),
    "isc_grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies.",
        "Permission to use, copy, modify, and distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies.",
    ),
    "isc_warranty": (
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO'
        " THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ),
    "isc_reference": ("SPDX-License-Identifier: ISC", "Licensed under the ISC License."),
    "bsd_grant": (
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met:",
    ),
    "bsd_source": (
        "Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer.",
        "1. Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer.",
    ),
    "bsd_binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of"
        " conditions and the following disclaimer in the documentation and/or other materials"
        " provided with the distribution.",
    ),
    "bsd_endorse": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to"
        " endorse or promote products derived from this software without specific prior written"
        " permission.",
    ),
    "bsd_reference": (
        "Licensed under the BSD License.",
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license that can be found in the"
        " LICENSE file.",
    ),
    "bsd2_reference": ("SPDX-License-Identifier: BSD-2-Clause",),
    "bsd3_reference": ("SPDX-License-Identifier: BSD-3-Clause",),
    "apache_header": (
        'Licensed under the Apache License, Version 2.0 (the "License");',
    ),
    "apache_comply": (
        "you may not use this file except in compliance with the License.",
    ),
    "apache_copy": ("You may obtain a copy of the License at",),
    "apache_basis": (
        "Unless required by applicable law or agreed to in writing, software distributed under the"
        ' License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,'
        " either express or implied.",
    ),
    "apache_reference": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
        "This work is licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "gpl_free": (
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version.",
        "it under the terms of the GNU General Public License as published by the Free Software"
        " Foundation, either version 3 of the License, or (at your option) any later version.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License"
        " as published by the Free Software Foundation, either version 3 of the License, or (at"
        " your option) any later version.",
    ),
    "lgpl3_free": (
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU Lesser General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or"
        " (at your option) any later version.",
    ),
    "lgpl_free": (
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public"
        " License as published by the Free Software Foundation;",
    ),
    "lgpl21_version": (
        "either version 2.1 of the License, or (at your option) any later version.",
    ),
    "lgpl21_reference": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "lgpl3_reference": (
        "Licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ),
    "agpl_free": (
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU Affero General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or"
        " (at your option) any later version.",
    ),
    "agpl_reference": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "epl2_terms": (
        "This program and the accompanying materials are made available under the terms of the"
        " Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "epl1_terms": (
        "All rights reserved. This program and the accompanying materials are made available under"
        " the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is"
        " available at http://www.eclipse.org/legal/epl-v10.html",
        "This program and the accompanying materials are made available under the terms of the"
        " Eclipse Public License v1.0 which accompanies this distribution, and is available at"
        " http://www.eclipse.org/legal/epl-v10.html",
        "SPDX-License-Identifier: EPL-1.0",
    ),
    "zlib_warranty": (
        "This software is provided 'as-is', without any express or implied warranty.",
    ),
    "zlib_liable": (
        "In no event will the authors be held liable for any damages arising from the use of this"
        " software.",
    ),
    "zlib_grant": (
        "Permission is granted to anyone to use this software for any purpose, including commercial"
        " applications, and to alter it and redistribute it freely, subject to the following"
        " restrictions:",
    ),
    "zlib_reference": ("SPDX-License-Identifier: Zlib", "Licensed under the zlib License."),
    "bsl_grant": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a"
        " copy of the software and accompanying documentation covered by this license (the"
        ' "Software") to use, reproduce, display, distribute, execute, and transmit the Software,'
        " and to prepare derivative works of the Software, and to permit third-parties to whom the"
        " Software is furnished to do so, all subject to the following:",
    ),
    "bsl_reference": (
        "Distributed under the Boost Software License, Version 1.0.",
        "SPDX-License-Identifier: BSL-1.0",
    ),
    "wtfpl_everyone": (
        "Everyone is permitted to copy and distribute verbatim or modified copies of this license"
        " document, and changing it is allowed as long as the name is changed.",
        "SPDX-License-Identifier: WTFPL",
    ),
    "gpl2_free": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License"
        " as published by the Free Software Foundation;",
    ),
    "gpl2_version": (
        "either version 2 of the License, or (at your option) any later version.",
    ),
    "gpl_hope": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    ),
    "gpl_merchant": (
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    "gpl_details": ("See the GNU General Public License for more details.",),
    "gpl3_reference": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "gpl2_reference": (
        "This work is licensed under the GNU General Public License, version 2.",
        "Licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
    ),
    "mpl_subject": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    ),
    "mpl_copy": (
        "If a copy of the MPL was not distributed with this file, You can obtain one at"
        " https://mozilla.org/MPL/2.0/.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at"
        " http://mozilla.org/MPL/2.0/.",
    ),
    "mpl_reference": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "unlicense_public": (
        "This is free and unencumbered software released into the public domain.",
    ),
    "unlicense_free": (
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software,"
        " either in source code form or as a compiled binary, for any purpose, commercial or"
        " non-commercial, and by any means.",
    ),
    "cc_by_reference": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc_by_sa_reference": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International"
        " License.",
    ),
    "cc_by_nc_reference": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International"
        " License.",
    ),
    "cc0_reference": (
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or"
        " neighboring rights to this work.",
    ),
}

# Licences by the identifiers their texts hold, in order of precedence. The
# identifiers of a rule follow one another; other sentences may stand between them.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("MIT", ("mit_title", "mit_grant", "mit_notice", "mit_warranty", "mit_liability")),
    ("MIT", ("mit_grant", "mit_notice", "mit_warranty", "mit_liability")),
    ("MIT", ("mit_grant", "mit_notice", "mit_warranty")),
    ("ISC", ("isc_title", "isc_grant", "isc_warranty")),
    ("ISC", ("isc_grant", "isc_warranty")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("Apache-2.0", ("apache_header", "apache_comply", "apache_copy", "apache_basis")),
    ("Apache-2.0", ("apache_header", "apache_comply")),
    ("AGPL-3.0", ("agpl_free",)),
    ("LGPL-3.0", ("lgpl3_free",)),
    ("LGPL-2.1", ("lgpl_free", "lgpl21_version")),
    ("EPL-2.0", ("epl2_terms",)),
    ("EPL-1.0", ("epl1_terms",)),
    ("Zlib", ("zlib_warranty", "zlib_liable", "zlib_grant")),
    ("Zlib", ("zlib_grant",)),
    ("BSL-1.0", ("bsl_grant",)),
    ("WTFPL", ("wtfpl_everyone",)),
    ("GPL-3.0", ("gpl_free", "gpl_hope", "gpl_merchant", "gpl_details")),
    ("GPL-3.0", ("gpl_free",)),
    ("GPL-2.0", ("gpl2_free", "gpl2_version", "gpl_hope", "gpl_merchant", "gpl_details")),
    ("GPL-2.0", ("gpl2_free", "gpl2_version")),
    ("MPL-2.0", ("mpl_subject", "mpl_copy")),
    ("MPL-2.0", ("mpl_copy",)),
    ("Unlicense", ("unlicense_public", "unlicense_free")),
    ("Unlicense", ("unlicense_public",)),
    ("MIT", ("mit_reference",)),
    ("ISC", ("isc_reference",)),
    ("BSD-3-Clause", ("bsd3_reference",)),
    ("BSD-2-Clause", ("bsd2_reference",)),
    ("BSD", ("bsd_reference",)),
    ("Apache-2.0", ("apache_reference",)),
    ("AGPL-3.0", ("agpl_reference",)),
    ("LGPL-3.0", ("lgpl3_reference",)),
    ("LGPL-2.1", ("lgpl21_reference",)),
    ("Zlib", ("zlib_reference",)),
    ("BSL-1.0", ("bsl_reference",)),
    ("GPL-3.0", ("gpl3_reference",)),
    ("GPL-2.0", ("gpl2_reference",)),
    ("MPL-2.0", ("mpl_reference",)),
    ("CC-BY-4.0", ("cc_by_reference",)),
    ("CC-BY-SA-4.0", ("cc_by_sa_reference",)),
    ("CC-BY-NC-4.0", ("cc_by_nc_reference",)),
    ("CC0-1.0", ("cc0_reference",)),
    ("MIT", ("mit_title",)),
    ("ISC", ("isc_title",)),
)


def normal(sentence: str) -> str:
    """Lower-case words and numbers, one blank apart."""
    return re.sub("[^a-z0-9]+", " ", sentence.translate(str.maketrans(UPPER, LOWER))).strip()


def dictionary() -> dict[str, str]:
    """Normalised sentence -> identifier."""
    return {normal(s): name for name, forms in SENTENCES.items() for s in forms}


def rule_pattern(names: Sequence[str]) -> str:
    """Matches these identifiers in this order; a group for the others between each two of them."""
    return "((?:<[a-z0-9_]+>)*?)".join(f"<{name}>" for name in names)


def rule_rest(names: Sequence[str], mark: str = "$") -> str:
    """What a match of `rule_pattern` leaves: the identifiers that are not its own."""
    return "".join(f"{mark}{k}" for k in range(1, len(names)))


def longest() -> int:
    """Words of the longest known sentence: it is wrapped over so many lines with words at most."""
    return max(len(s.split()) for s in dictionary())


def markers() -> list[str]:
    """Words of which every known sentence holds at least one: a cheap first test of a text."""
    left, found = [set(s.split()) for s in dictionary()], []
    while left:
        words = {w for s in left for w in s if len(w) > 6}
        found.append(min(words, key=lambda w: (-sum(w in s for s in left), w)))
        left = [s for s in left if found[-1] not in s]
    return found


def _normal(sentence: Column) -> Column:
    lowered = F.translate(sentence, UPPER, LOWER)
    return F.trim(F.regexp_replace(lowered, "[^a-z0-9]+", " "))


def _known(sentence: Column) -> Column:
    pairs = [F.lit(x) for pair in dictionary().items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), _normal(sentence))


def _from_line() -> str:
    """Matches the lines of a normalised passage from a line's begin to the end of that line or of a
    later one that hold a known sentence, the line alone before the longest."""
    known = "|".join(sorted(dictionary(), key=lambda s: (-len(s), s)))
    wrapped = known.replace(" ", r"(?: |\n++)")
    return rf"(?m)^((?:{known})$|(?:{wrapped})$)"


def _in_lines(sentence: Column) -> Column:
    """Identifiers of the known sentences that begin with a line, where the whole is not known.

    A sentence may be wrapped over any number of lines, and other lines may follow it. Its lines are
    used up, so it counts once, and none that begins inside it counts.
    """
    lowered = F.translate(sentence, UPPER, LOWER)
    blanks = F.regexp_replace(F.regexp_replace(lowered, "[^a-z0-9\n]+", " "), " ?\n ?", "\n")
    return F.transform(F.regexp_extract_all(F.trim(blanks), F.lit(_from_line()), F.lit(1)), _known)


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in its order."""
    tagged = F.regexp_replace(text, SPDX_TAG, CUT + "$1 ")
    sentences = F.split(F.regexp_replace(tagged, BOUNDARY, "$1" + CUT), CUT)
    found = F.flatten(
        F.transform(
            sentences,
            lambda s: F.when(_known(s).isNotNull() | ~s.contains("\n"), F.array(_known(s)))
            .otherwise(_in_lines(s)),
        )
    )
    return F.filter(found, lambda x: x.isNotNull())


def licences(ids: Column) -> Column:
    """Licences whose rules match, rules in order.

    Matches of a rule are taken from left to right. Their own identifiers serve no later rule;
    those between them stay, as they may be of another licence.
    """
    rules = F.array(
        *[
            F.struct(
                F.lit(n).alias("name"),
                F.lit(rule_pattern(r)).alias("form"),
                F.lit(rule_rest(r)).alias("rest"),
            )
            for n, r in RULES
        ]
    )
    start = F.struct(
        F.concat(F.lit("<"), F.array_join(ids, "><"), F.lit(">")).alias("left"),
        F.array().cast("array<string>").alias("found"),
    )

    def apply(state: Column, rule: Column) -> Column:
        hit = F.regexp_like(state["left"], rule["form"])
        return F.struct(
            F.when(hit, F.regexp_replace(state["left"], rule["form"], rule["rest"]))
            .otherwise(state["left"])
            .alias("left"),
            F.when(hit, F.array_append(state["found"], rule["name"]))
            .otherwise(state["found"])
            .alias("found"),
        )

    return F.array_sort(F.array_distinct(F.aggregate(rules, start, apply)["found"]))


def scan(docs: DataFrame) -> DataFrame:
    """(doc: the whole row, sentences, licences) for each row of `docs`, arrays of strings.

    Every text is read whole. A text without any marker word holds no known sentence and is not
    cut up. Null and empty texts have no licences; repeated rows are treated alike; an empty table
    gives an empty result; extra columns travel inside `doc`. DataFrame expressions only, one scan,
    no shuffle.
    """
    rows = docs.select(F.struct("*").alias("doc"))
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    marked = F.translate(text, UPPER, LOWER).rlike("|".join(markers()))
    nothing = F.array().cast("array<string>")
    rows = rows.withColumn("sentences", F.when(marked, sentence_ids(text)).otherwise(nothing))
    found = F.when(F.size("sentences") > 0, licences(F.col("sentences"))).otherwise(nothing)
    return rows.withColumn("licences", found)
