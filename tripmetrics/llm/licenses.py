"""Licence recognition by sentences, in DataFrame functions only.

Comment signs before lines are taken off. Normalised sentences are mapped to identifiers of known
licence sentences, of notices (``... released under the MIT License``, with any words before) and
of SPDX lines. The identifiers of a document, in order, are matched against ordered rules; the first
rule that matches names the licence. Sentences are cut twice, by lines and across them, so wrapped
and unwrapped texts match.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as f

from tripmetrics.llm.spans import let

# Sentences of public licences and licence notices, normalised.
SENTENCES = {
    "apache_line": "licensed under the apache license version 2 0",
    "apache_header": "licensed under the apache license version 2 0 the license",
    "apache_use": "you may not use this file except in compliance with the license",
    "apache_as_is": (
        "unless required by applicable law or agreed to in writing software distributed under "
        "the license is distributed on an as is basis without warranties or conditions of any "
        "kind either express or implied"
    ),
    "mit_line": "released under the mit license",
    "mit_licensed": "licensed under the mit license",
    "mit_grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software and to permit persons "
        "to whom the software is furnished to do so subject to the following conditions"
    ),
    "mit_notice": (
        "the above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the software"
    ),
    "gpl3_line": "this work is licensed under the gnu general public license version 3",
    "gpl_redistribute": (
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation either "
        "version 3 of the license or at your option any later version"
    ),
    "gpl_hope": (
        "this program is distributed in the hope that it will be useful but without any warranty "
        "without even the implied warranty of merchantability or fitness for a particular purpose"
    ),
    "cc_by_nc4": "licensed under cc by nc 4 0",
    "cc_by4": "licensed under cc by 4 0",
    "cc_by_sa4": "licensed under cc by sa 4 0",
    "isc_grant": (
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted provided that the above copyright notice and this "
        "permission notice appear in all copies"
    ),
    "rights": "all rights reserved",
}


def _plain(sentence: str) -> str:
    """``normalised`` of a sentence of ours."""
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


# More of them as the licences write them, cut where sentences are cut.
_WRITTEN = {
    "bsd_use": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "bsd_source": (
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer"
    ),
    "bsd_binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution"
    ),
    "bsd_name": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission"
    ),
    "gpl_hope_start": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"
    ),
    "gpl_terms": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation"
    ),
    "lgpl_terms": (
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation"
    ),
    "version2_later": "either version 2 of the License, or (at your option) any later version",
    "version21_later": "either version 2.1 of the License, or (at your option) any later version",
    "version3_later": "either version 3 of the License, or (at your option) any later version",
    "lgpl3_redistribute": (
        "This library is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version"
    ),
    "agpl_redistribute": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version"
    ),
    "mpl_subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "epl_available": (
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "cc0_dedicated": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related "
        "and neighboring rights to this software to the public domain worldwide"
    ),
    "unlicense_released": (
        "This is free and unencumbered software released into the public domain"
    ),
}
SENTENCES |= {name: _plain(text) for name, text in _WRITTEN.items()}
# SPDX identifiers, with the names that notices use for them.
NOTICED = {
    "MIT": ["MIT"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause", "2-clause BSD", "simplified BSD"],
    "BSD-3-Clause": ["BSD 3-Clause", "3-clause BSD", "new BSD", "modified BSD"],
    "ISC": ["ISC"],
    "GPL-2.0-only": ["GNU General Public License version 2", "GNU GPL version 2", "GPLv2", "GPL 2.0"],
    "GPL-3.0-only": ["GNU General Public License version 3", "GNU GPL version 3", "GPLv3", "GPL 3.0"],
    "GPL-2.0-or-later": [],
    "GPL-3.0-or-later": [],
    "LGPL-2.1-only": ["GNU Lesser General Public License version 2.1", "LGPL 2.1", "LGPLv2.1"],
    "LGPL-3.0-only": ["GNU Lesser General Public License version 3", "LGPL 3.0", "LGPLv3"],
    "LGPL-2.1-or-later": [],
    "LGPL-3.0-or-later": [],
    "AGPL-3.0-only": ["GNU Affero General Public License version 3", "AGPL 3.0", "AGPLv3"],
    "AGPL-3.0-or-later": [],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License, version 2.0", "EPL 2.0"],
    "CC0-1.0": ["CC0 1.0"],
    "CC-BY-4.0": ["CC BY 4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0"],
    "Unlicense": ["Unlicense"],
}
#: Normalised names in notices and SPDX lines, with the identifiers of these sentences.
NOTICES = {_plain(name): f"notice_{spdx}" for spdx, names in NOTICED.items() for name in names}
TAGS = {_plain(spdx): f"spdx_{spdx}" for spdx in NOTICED}
NOTICE = (
    "(?:^| )(?:licensed|released|distributed|available|published|provided|covered) under (?:the )?"
    f"(?:terms (?:and conditions )?of (?:the )?)?({'|'.join(NOTICES)})(?: licen[sc]e)?$"
)
TAG = f"(?:^| )spdx license identifier ({'|'.join(TAGS)})$"
#: Ordered: licence, and sentences that occur in this order, others between them or not.
RULES = [
    ("GPL-3.0-or-later", ["gpl_redistribute", "gpl_hope"]),
    ("GPL-3.0-or-later", ["gpl_redistribute"]),
    ("GPL-3.0", ["gpl3_line"]),
    ("Apache-2.0", ["apache_header", "apache_use", "apache_as_is"]),
    ("Apache-2.0", ["apache_header"]),
    ("Apache-2.0", ["apache_line"]),
    ("MIT", ["mit_grant", "mit_notice"]),
    ("MIT", ["mit_line"]),
    ("MIT", ["mit_licensed"]),
    ("ISC", ["isc_grant"]),
    ("CC-BY-NC-4.0", ["cc_by_nc4"]),
    ("CC-BY-SA-4.0", ["cc_by_sa4"]),
    ("CC-BY-4.0", ["cc_by4"]),
    ("GPL-2.0-or-later", ["gpl_terms", "version2_later"]),
    ("GPL-3.0-or-later", ["gpl_terms", "version3_later"]),
    ("LGPL-2.1-or-later", ["lgpl_terms", "version21_later"]),
    ("LGPL-3.0-or-later", ["lgpl_terms", "version3_later"]),
    ("LGPL-3.0-or-later", ["lgpl3_redistribute"]),
    ("AGPL-3.0-or-later", ["agpl_redistribute"]),
    ("BSD-3-Clause", ["bsd_use", "bsd_source", "bsd_binary", "bsd_name"]),
    ("BSD-2-Clause", ["bsd_use", "bsd_source", "bsd_binary"]),
    ("MPL-2.0", ["mpl_subject"]),
    ("EPL-2.0", ["epl_available"]),
    ("CC0-1.0", ["cc0_dedicated"]),
    ("Unlicense", ["unlicense_released"]),
    *[(name, [f"{kind}_{name}"]) for kind in ("spdx", "notice") for name in NOTICED],
    ("proprietary", ["rights"]),
]
#: What every known sentence contains, so that other documents are not cut.
HINT = (
    r"(?i)licen[sc]ed?|rights\s+reserved|permission|free\s+software|hope\s+that|released"
    r"|redistribut|either\s+version|unencumbered|neighboring\s+rights"
    r"|(?:available|published|provided|covered|distributed)[^A-Za-z0-9]+under"
)
# In Java's words possessive and only from where a run begins, so that long runs cost no more.
COMMENT = r"(?dm)^[ \t]*+(?:/\*++|\*++/?|//++|#++|--++|;++|%++|<!--)[ \t]?"
BLANKS = r"[ \t\x0b\f\r]++"
BY_LINES = r"(?<![.!?;])[.!?;]++[ \n]++| ?\n[ \n]*+"
ACROSS_LINES = r"(?<![.!?;])[.!?;]++[ \n]++| ?\n ?\n[ \n]*+"


def normalised(sentence: Column) -> Column:
    """Letters and digits of a sentence in lower case, single spaces between."""
    return f.trim(f.regexp_replace(f.lower(sentence), "[^a-z0-9]+", " "))


def identifiers(text: Column) -> Column:
    """Identifiers of the known sentences of ``text`` by both cuts, in order.

    Every place where sentences are cut across lines is also one by lines, so each sentence
    across lines is cut again by lines. One that is a single line counts once.
    """
    known, notices, tags = (
        f.create_map(*[f.lit(x) for entry in table.items() for x in entry])
        for table in ({s: name for name, s in SENTENCES.items()}, NOTICES, TAGS)
    )
    hinted = "(?:^| )(?:under|spdx) "

    def named(sentence: Column) -> Column:
        def looked_up(words: Column) -> Column:
            other = f.coalesce(
                f.try_element_at(notices, f.regexp_extract(words, NOTICE, 1)),
                f.try_element_at(tags, f.regexp_extract(words, TAG, 1)),
            )
            return f.coalesce(f.try_element_at(known, words), f.when(words.rlike(hinted), other))

        return let(normalised(sentence), looked_up)

    def both(sentence: Column) -> Column:
        lines = f.array_compact(f.transform(f.split(sentence, BY_LINES, -1), named))

        def merged(pair: Column) -> Column:
            whole, inside = pair["whole"], pair["lines"]
            # a notice with other words before it counts where no line says more
            lead = whole.rlike("^(?:notice|spdx)_") & (f.size(inside) > 0)
            known = f.coalesce(f.array_contains(inside, whole), f.lit(False))
            add = whole.isNotNull() & ~known & ~lead
            return f.when(add, f.concat(f.array(whole), inside)).otherwise(inside)

        return let(f.struct(named(sentence).alias("whole"), lines.alias("lines")), merged)

    bare = f.regexp_replace(f.regexp_replace(text, COMMENT, ""), BLANKS, " ")
    return f.flatten(f.transform(f.split(bare, ACROSS_LINES, -1), both))


def _pattern(sequence: list[str]) -> str:
    return " " + " (?:.* )?".join(sequence) + " "


def scan(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, license, licenses, n_sentences, sentence_ids.

    ``license`` is that of the first rule that matches (null: none), ``licenses`` all, in the
    order of the rules, comma-joined. ``sentence_ids`` are those found by lines and across them,
    by their places. Null and empty texts have none. Only doc_id and text are read. The time is
    linear in a text, however long; repeated rows get equal results, an empty table none.
    """
    text = f.coalesce("text", f.lit(""))
    empty = f.array().cast("array<string>")
    ids = docs.select(
        "doc_id", f.when(text.rlike(HINT), identifiers(text)).otherwise(empty).alias("ids")
    ).select(
        "doc_id",
        f.size("ids").cast("bigint").alias("n_sentences"),
        f.array_join("ids", " ").alias("sentence_ids"),
    )
    line = f.concat(f.lit(" "), f.col("sentence_ids"), f.lit(" "))
    # a sentence's closing space opens the next, so spaces are doubled for matching
    line = f.replace(line, f.lit(" "), f.lit("  "))
    matched = f.array_distinct(
        f.array_compact(
            f.array(*[f.when(line.rlike(_pattern(seq)), name) for name, seq in RULES])
        )
    )
    return ids.withColumn("matched", matched).select(
        "doc_id",
        f.get("matched", f.lit(0)).alias("license"),
        f.array_join("matched", ",").alias("licenses"),
        "n_sentences",
        "sentence_ids",
    )
