"""License scans by sentence rules.

A text is normalised (lower case, letters and digits only) with its breaks kept, known licence
sentences become identifiers, and the sequence of a text's identifiers is matched against ordered
rules. A sentence ends at ``. ! ?`` before white space and at a blank line. A single line break and
``;`` may end a sentence or lie inside one, so notices wrapped at any column, or behind comment
signs, are found like those on one line. All of it is column expressions: one pass over the text,
no shuffle, no Python.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sentence identifier → normalised sentences. Wording of the licences themselves.
SENTENCES = {
    "MITref": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license"],
    "MITperm": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"],
    "MITnotice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "AsIs": ["the software is provided as is without warranty of any kind", "this software is provided as is without warranty of any kind"],
    "Apache2ref": ["licensed under the apache license version 2 0", "licensed under the apache license version 2"],
    "ApacheUse": ["you may not use this file except in compliance with the license"],
    "GPL3ref": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3"],
    "GPL2ref": ["licensed under the gnu general public license version 2"],
    "GPLfree": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"],
    "GPLlater": ["either version 3 of the license or at your option any later version"],
    "BSDredist": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "CCBYNC4ref": ["licensed under cc by nc 4 0"],
    "CCBY4ref": ["licensed under cc by 4 0"],
    "CC0ref": ["licensed under cc0 1 0"],
}
#: Licence → identifiers that must follow one another in this order. Longer rules take precedence.
RULES = [
    ("MIT", ["MITperm", "MITnotice", "AsIs"]),
    ("MIT", ["MITperm", "MITnotice"]),
    ("GPL-3.0-or-later", ["GPLfree", "GPLlater"]),
    ("Apache-2.0", ["Apache2ref", "ApacheUse"]),
    ("Apache-2.0", ["Apache2ref"]),
    ("MIT", ["MITref"]),
    ("GPL-3.0", ["GPL3ref"]),
    ("GPL-2.0", ["GPL2ref"]),
    ("BSD", ["BSDredist"]),
    ("CC-BY-NC-4.0", ["CCBYNC4ref"]),
    ("CC-BY-4.0", ["CCBY4ref"]),
    ("CC0-1.0", ["CC0ref"]),
]
_GPL = "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"
_IMPLIED = "including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"
_FEE = "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"
_LESSER = "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"
_LATER = "of the license or at your option any later version"
_ENDORSE = "may be used to endorse or promote products derived from this software without specific prior written permission"
#: The same for whole sentences as the licences print them. ``oracle_sql`` knows ``SENTENCES`` and ``RULES`` only.
FULL_SENTENCES = {
    "MITref": ["this software is released under the mit license", "this software is licensed under the mit license", "this project is released under the mit license"],
    "MITperm": [SENTENCES["MITperm"][0] + " the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "MITnotice": ["the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software"],
    "AsIs": [
        *(x + tail for x in SENTENCES["AsIs"] for tail in (" express or implied", " express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement", " express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and non infringement")),
        *(f"this software is provided by {who} as is and any express or implied warranties {_IMPLIED}" for who in ("the copyright holders and contributors", "the copyright holder and contributors", "the author", "the authors", "the author and contributors", "the regents and contributors")),
    ],
    "Apache2ref": ["licensed under the apache license version 2 0 the license", "this project is licensed under the apache license version 2 0", "licensed under the apache license 2 0"],
    "GPLfree3": [_GPL + " either version 3 of the license or at your option any later version"],
    "GPLfree2": [_GPL + " either version 2 of the license or at your option any later version"],
    "GPLonly3": [_GPL + " version 3 of the license", _GPL + " version 3"],
    "GPLonly2": [_GPL + " version 2 of the license", _GPL + " version 2"],
    "CCBYNC4ref": [f"{w}licensed under a creative commons attribution noncommercial 4 0 international license" for w in ("", "this work is ")] + ["this work is licensed under cc by nc 4 0"],
    "CCBY4ref": [f"{w}licensed under a creative commons attribution 4 0 international license" for w in ("", "this work is ")] + ["this work is licensed under cc by 4 0"],
    "MPLform": ["this source code form is subject to the terms of the mozilla public license v"],
    "MPLcopy": [f"if a copy of the mpl was not distributed with this file you can obtain one at {scheme} mozilla org mpl 2 0" for scheme in ("http", "https")],
    "MPL2ref": [f"{w}licensed under the mozilla public license {v}" for w in ("", "this project is ") for v in ("2 0", "version 2 0")],
    "ISCperm": [f"{_FEE} provided that the above copyright notice and this permission notice appear in all copies"],
    "0BSDperm": [_FEE],
    "LGPLfree21": [f"this {w} is free software {_LESSER} either version 2 1 {_LATER}" for w in ("library", "program")],
    "LGPLfree3": [f"this {w} is free software {_LESSER} either version 3 {_LATER}" for w in ("library", "program")],
    "AGPLfree3": [_GPL.replace("gnu general", "gnu affero general") + f" either version 3 {_LATER}"],
    "AGPLonly3": [_GPL.replace("gnu general", "gnu affero general") + tail for tail in (" version 3 of the license", " version 3")],
    "BSDsource": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "BSDbinary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "BSDname": [
        *(f"neither the name of {who} nor the names of its contributors {_ENDORSE}" for who in ("the copyright holder", "the copyright holders", "the university", "the project", "the author")),
        "the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission",
    ],
    "Unlicense": ["this is free and unencumbered software released into the public domain"],
    "BSL1ref": ["distributed under the boost software license version 1 0"],
    "EPL2ref": [f"this program and the accompanying materials are made available under the terms of the eclipse public license {v}" for v in ("2 0", "v2 0", "2 0 which is available at https www eclipse org legal epl 2 0", "v2 0 which is available at https www eclipse org legal epl 2 0")],
    "CCBYSA4ref": [f"{w}licensed under {of}" for w in ("", "this work is ") for of in ("cc by sa 4 0", "a creative commons attribution sharealike 4 0 international license")],
}
FULL_RULES = [
    ("GPL-3.0-or-later", ["GPLfree3"]), ("GPL-2.0-or-later", ["GPLfree2"]), ("GPL-3.0", ["GPLonly3"]), ("GPL-2.0", ["GPLonly2"]), ("MPL-2.0", ["MPLform", "MPLcopy"]), ("MPL-2.0", ["MPL2ref"]),
    ("ISC", ["ISCperm"]), ("0BSD", ["0BSDperm"]), ("LGPL-2.1-or-later", ["LGPLfree21"]), ("LGPL-3.0-or-later", ["LGPLfree3"]), ("AGPL-3.0-or-later", ["AGPLfree3"]), ("AGPL-3.0", ["AGPLonly3"]),
    ("BSD-3-Clause", ["BSDredist", "BSDsource", "BSDbinary", "BSDname"]), ("BSD-2-Clause", ["BSDredist", "BSDsource", "BSDbinary"]), ("Unlicense", ["Unlicense"]), ("BSL-1.0", ["BSL1ref"]),
    ("EPL-2.0", ["EPL2ref"]), ("CC-BY-SA-4.0", ["CCBYSA4ref"]),
]
#: Names in ``SPDX-License-Identifier`` lines; those that end in ``-only`` have the rules' name without it.
SPDX = [
    "MIT", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later",
    "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "ISC", "MPL-2.0", "EPL-2.0", "BSL-1.0", "Zlib", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
]
FULL_SENTENCES |= {f"SPDX-{name}": ["spdx license identifier " + re.sub("[^a-z0-9]+", " ", name.lower())] for name in SPDX}
FULL_RULES += [(name.removesuffix("-only"), [f"SPDX-{name}"]) for name in SPDX]
#: What says that there is a licence, whichever; both engines run it on lower-cased text.
MENTION = r"licen[sc]ed[ \t\r\n]+under|spdx-license-identifier"


def all_sentences() -> dict[str, list[str]]:
    """``SENTENCES`` and ``FULL_SENTENCES`` by identifier."""
    return {k: SENTENCES.get(k, []) + FULL_SENTENCES.get(k, []) for k in [*SENTENCES, *(k for k in FULL_SENTENCES if k not in SENTENCES)]}


#: Words that other texts hold often; a gate takes one only where a sentence has no other.
ORDINARY = ["software", "provided", "without", "conditions", "following", "documentation", "international", "released", "distributed", "available", "program", "version", "project", "materials"]


def gate(sentences: list[str]) -> list[str]:
    """Words so that every sentence holds one: by turns the word with the most letters in sentences left, ``ORDINARY`` ones last."""
    left, words = set(sentences), []
    known = sorted({w for s in sentences for w in s.split(" ")})
    while left:
        held = {w: sum(w in s for s in left) * len(w) for w in known}
        words.append(max(known, key=lambda w: (held[w] > 0 and len(w) > 4 and w not in ORDINARY, held[w], w)))
        left = {s for s in left if words[-1] not in s}
    return words


def _marked(text: Column) -> Column:
    """Normalised words with one blank, a line break (which may end a sentence) or ``|`` (which does) between them."""
    s = F.regexp_replace(F.lower(text), "[^a-z0-9.!?;\n\r]+", " ")
    s = F.regexp_replace(s, "\r\n?", "\n")
    s = F.regexp_replace(s, "[ .!?;]*(?:\n[ .!?;]*\n|[.!?](?:[ \n]|$))[ .!?;\n]*", "|")
    s = F.regexp_replace(s, "[ .!?]*[;\n][ .!?;\n]*", "\n")
    return F.concat(F.lit("|"), F.trim(F.regexp_replace(s, "[ .!?]+", " ")), F.lit("|"))


def sentence_ids(text: Column, sentences: dict[str, list[str]] | None = None) -> Column:
    """Identifiers of the known sentences of ``text``, in order; other sentences are left out.

    Only texts that hold one of the words of ``gate`` are normalised.
    """
    known = {s: k for k, v in (sentences or all_sentences()).items() for s in v}
    table = F.create_map(*(F.lit(x) for s, k in known.items() for x in (s, k)))
    likely = F.lower(text).rlike("|".join(gate(sorted(known))))
    words = "|".join("[ \n]".join(map(re.escape, s.split(" "))) for s in sorted(known, key=len, reverse=True))
    hits = F.regexp_extract_all(_marked(text), F.lit(rf"(?<=[|\n])({words})(?=[|\n])"), F.lit(1))
    found = F.transform(hits, lambda s: table[F.translate(s, "\n", " ")])
    return F.when(likely, found).otherwise(F.array().cast("array<string>"))


def rule_matches(ids: Column, rules: list[tuple[str, list[str]]] | None = None) -> Column:
    """Licences whose rule matches a run of ``ids``, longest rule first; a matched run counts once."""
    rules = sorted(rules or RULES + FULL_RULES, key=lambda r: -len(r[1]))
    rest = F.concat(F.lit("|"), F.array_join(F.transform(ids, lambda x: F.concat(x, F.lit("|"))), "|"), F.lit("|"))
    hits = []
    for name, seq in rules:
        needle = "|" + "".join(f"{x}||" for x in seq)[:-1]
        hits.append(F.when(F.contains(rest, F.lit(needle)), F.lit(name)))
        rest = F.replace(rest, F.lit(needle), F.lit("|~|"))
    return F.array_distinct(F.array_compact(F.array(*hits)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: dict[str, list[str]] | None = None, rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """Return ``doc_id, sentence_ids array, licenses array, unknown_license boolean`` for each row.

    ``unknown_license``: the text says that it is under a licence (``MENTION``), but no rule matches.

    Null and empty texts have empty arrays; repeated rows give equal rows; ids may be null; an empty
    table gives no rows; other columns are ignored. ``licenses`` is in rule order, without repeats.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), sentence_ids(text, sentences).alias("sentence_ids"), F.lower(text).rlike(MENTION).alias("_mentions"))
    rows = rows.withColumn("licenses", rule_matches(F.col("sentence_ids"), rules))
    return rows.select("doc_id", "sentence_ids", "licenses", ((F.size("licenses") == 0) & F.col("_mentions")).alias("unknown_license"))


def oracle_sql() -> str:
    """The query of ``op1`` in DuckDB SQL."""
    known = {s: k for k, v in SENTENCES.items() for s in v}
    pairs = "map {" + ", ".join(f"'{s}': '{k}'" for s, k in known.items()) + "}"
    split = r"string_split_regex(coalesce(text, ''), '[\n\r]+|[.!?;][ \t]+')"
    ids = f"list_filter(list_transform({split}, lambda s: element_at({pairs}, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')))[1]), lambda k: k is not null)"
    step, hits = "'|' || array_to_string(list_transform(ids, lambda x: x || '|'), '|') || '|'", []
    ctes = [f"r0 as (select doc_id, ids, mentions, {step} as s from (select doc_id, {ids} as ids, regexp_matches(lower(coalesce(text, '')), '{MENTION}') as mentions from documents))"]
    for i, (name, seq) in enumerate(sorted(RULES, key=lambda r: -len(r[1]))):
        needle = "|" + "".join(f"{x}||" for x in seq)[:-1]
        ctes.append(f"r{i + 1} as (select * exclude (s), case when contains(s, '{needle}') then '{name}' end as h{i}, replace(s, '{needle}', '|~|') as s from r{i})")
        hits.append(f"h{i}")
    # keep the first of equal names, in rule order
    first = [f"case when {h} is not null and not coalesce({h} in ({', '.join(hits[:i])}), false) then {h} end" if i else h for i, h in enumerate(hits)]
    none = " and ".join(f"{h} is null" for h in hits)
    return f"with {', '.join(ctes)} select doc_id, mentions and {none} as unknown_license, coalesce(array_to_string(ids, ','), '') as sentence_ids, concat_ws(',', {', '.join(first)}) as licenses, cast(len(ids) as bigint) as n_sentences from r{len(hits)}"
