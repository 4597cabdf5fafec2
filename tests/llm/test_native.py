import os
import sys

import pytest
from propscan.llm import chat_rotation, license_scan, source_mixing, url_filter
from propscan.llm.queries import ORACLE_SQL, QUERIES
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))
from oracle import compare


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    assert compare(spark, QUERIES[name], ORACLE_SQL[name]) > 0


def test_license_rules(spark):
    perm, notice = license_scan.SENTENCES["MITperm"][0], license_scan.SENTENCES["MITnotice"][0]
    rows = [(1, f"x. {perm.title()}!\n{notice}."), (2, f"{notice}. {perm}"), (3, None), (4, ""), (5, "Licensed under the Apache License, Version 2.0"), (None, "Released under the MIT License.\nReleased under the MIT License.")]
    got = {r.doc_id: (r.sentence_ids, r.licenses) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string").withColumn("licenses", F.lit(1))).collect()}
    assert got == {1: (["MITperm", "MITnotice"], ["MIT"]), 2: (["MITnotice", "MITperm"], []), 3: ([], []), 4: ([], []), 5: (["Apache2ref"], ["Apache-2.0"]), None: (["MITref", "MITref"], ["MIT"])}


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0"""
GPL = """This program is free software%s you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation%s either version %d of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY."""


def test_verbatim_notices(spark):
    import textwrap

    want = {
        MIT: (["MITperm", "MITnotice", "AsIs"], ["MIT"]), BSD: (["BSDredist", "BSDsource"], ["BSD"]), APACHE: (["Apache2ref", "ApacheUse"], ["Apache-2.0"]),
        GPL % (":", ",", 3): (["GPLfree3"], ["GPL-3.0-or-later"]), GPL % (";", ";", 2): (["GPLfree2"], ["GPL-2.0-or-later"]),
    }
    wrap = lambda t, width, sign: "\n".join((sign + line).rstrip() for p in t.split("\n") for line in textwrap.wrap(p.strip(), width) or [""])
    forms = [lambda t: t, lambda t: wrap(t, 80, ""), lambda t: wrap(t, 60, "").replace("\n", "\r\n"), lambda t: wrap(t, 72, "# "), lambda t: "/*\n" + wrap(t, 76, " * ") + "\n */\nint x;", lambda t: f"Copyright (c) 2020 A. Body\n\n{t}\n"]
    rows = [(i, f(t)) for i, (t, f) in enumerate((t, f) for t in want for f in forms)]
    got = {r.doc_id: (r.sentence_ids, r.licenses) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i, _ in rows] == [want[t] for t in want for _ in forms]
    no = ["It isn't released under. The MIT License", "we never released under the MIT License", "released under\n\nthe MIT License", "released under the MIT License agreement"]
    assert all(not r.sentence_ids for r in license_scan.scan(spark.createDataFrame(list(enumerate(no)), "doc_id long, text string")).collect())
    lines = spark.createDataFrame([(1, "a b\nReleased under the MIT License\nc d; Licensed under CC0 1.0; e\rLicensed under CC BY 4.0")], "doc_id long, text string")
    assert license_scan.scan(lines).first().licenses == ["MIT", "CC-BY-4.0", "CC0-1.0"]
    import re

    known = [s for v in license_scan.all_sentences().values() for s in v]
    words = license_scan.gate(known)
    assert len(words) < 12 and not set(license_scan.ORDINARY) & set(words) and len(set(known)) == len(known)
    assert license_scan.gate(["provided"]) == ["provided"] and license_scan.gate([]) == []
    assert all(any(w in s for w in words) and re.fullmatch("[a-z0-9]+( [a-z0-9]+)*", s) for s in known)


MORE = {
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.": "MPL-2.0",
    'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED "AS IS"': "ISC",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.": "0BSD",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.": "LGPL-2.1-or-later",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": "AGPL-3.0-or-later",
    "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy": "Unlicense",
    "SPDX-License-Identifier: MIT": "MIT", "SPDX-License-Identifier: GPL-2.0-only": "GPL-2.0", "SPDX-License-Identifier: MPL-2.0": "MPL-2.0", "SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0", "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0",
}
CLAUSES = BSD + "\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
NAME = "\n\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."


def test_further_notices(spark):
    import textwrap

    want = MORE | {CLAUSES: "BSD-2-Clause", CLAUSES + NAME: "BSD-3-Clause"}
    wrap = lambda t, width, sign: "\n".join((sign + line).rstrip() for p in t.split("\n") for line in textwrap.wrap(p.strip(), width, break_on_hyphens=False, break_long_words=False) or [""])
    forms = [lambda t: t, lambda t: wrap(t, 70, "# "), lambda t: "/*\n" + wrap(t, 60, " * ") + "\n */\nint x;", lambda t: f"Copyright 2020 A\n\n{t}\n\nmain()"]
    rows = [(i, f(t)) for i, (t, f) in enumerate((t, f) for t in want for f in forms)]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(got[i].licenses, got[i].unknown_license) for i, _ in rows] == [([name], False) for name in want.values() for _ in forms]
    no = [("SPDX-License-Identifier: MIT OR Apache-2.0", True), ("It is licensed\n  under the Foo License.", True), ("SPDX-License-Identifier: GPL-2.0+", True), ("a licence to kill", False), ("", False), (None, False)]
    found = license_scan.scan(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(no)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r.licenses, r.unknown_license) for r in found] == [([], u) for _, u in no]


def test_license_edges(spark):
    d = spark.createDataFrame([(1, "x " * 500_000 + "\n\nReleased under the MIT License.")] * 2, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("sentence_ids", "licenses", "likely")})
    got = license_scan.scan(d).collect()
    assert [(r.doc_id, r.sentence_ids, r.licenses) for r in got] == [(1, ["MITref"], ["MIT"])] * 2
    assert license_scan.scan(d.limit(0)).count() == 0


def test_urls(spark):
    urls = ["http://A.Example.COM/en/71?x#y", "https://com/en/", "xcom://net/de/1", "https://a.example.net/de/8#z", None, "no scheme", "http://h?q=/a", "http://casino.example.org/es/", "http://notcom/en/", "http://x.com#f/en/"]
    d = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(d).collect()}
    assert got[0] == ("a.example.com", "/en/71", "example.com/en/7", "allow")
    assert got[1][:3] == ("com", "/en/", "com/en/") and got[3][2:] == ("example.net/de/8", "block") and got[2][2] == "net/de/"
    assert got[4][:3] == ("", "", None) and got[5][:2] == ("", "") and got[6][:2] == ("h", "") and got[7][2] == "org/es/" and got[8][2] is None and got[9][:2] == ("x.com", "")
    assert all(v[3] in ("allow", "block") for v in got.values())
    assert url_filter.judge(d.limit(0)).count() == 0
    full = QUERIES["op3_url_filters"](spark, "/root/testdata/sf0.01")
    assert full.count() == spark.read.parquet("/root/testdata/sf0.01/pages.parquet").count()


URL_SQL = r"""
with a as (select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, regexp_extract(rest, '^[^/?#]*') as raw, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from a),
u as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path from h),
r(verdict, rh, rp) as (values ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
m as (select u.*, rh || rp as rule, r.verdict, row_number() over (partition by page_id order by length(rh || rp) desc nulls last) as n from u left join r on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp))
select page_id, host, path, rule, verdict from m where n = 1"""


def test_urls_of_the_whole_table(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("create view pages as select * from '/root/testdata/sf0.1/pages.parquet'")
    want = {r[0]: r[1:] for r in con.execute(URL_SQL).fetchall()}
    got = {r.page_id: r for r in QUERIES["op3_url_filters"](spark, "/root/testdata/sf0.1").collect()}
    assert got.keys() == want.keys()
    for i, (h, p, rule, verdict) in want.items():
        assert (got[i].host, got[i].path, got[i].rule) == (h, p, rule) and got[i].verdict == (verdict or got[i].verdict)
    assert {r.verdict for r in got.values()} <= {"allow", "block"} and sum(r.rule is None for r in got.values()) > 100


def test_urls_learn_from_labels(spark):
    """Held-out URLs, by the trees alone: no rule decides them."""
    kind = lambda i: "block" if i % 3 == 0 else "allow"
    url = lambda i: f"http://win{i}-{i * 7919}-casino.example{i % 9}.xyz/a/b/c/{i * 104729}?id={i}&u={i * 3}&x=1" if i % 3 == 0 else f"https://news.site{i % 9}.org/article/story-{'abcdefghij'[i % 10]}"
    rows = spark.createDataFrame([(i, url(i), kind(i)) for i in range(1200)], "page_id long, url string, verdict string")
    held = url_filter.judge(rows.where("page_id % 4 = 1"), rules=[], labelled=rows.where("page_id % 4 <> 1")).collect()
    assert len(held) == 300 and sum(r.verdict == kind(r.page_id) for r in held) >= 295
    only = url_filter.judge(rows, rules=[], labelled=rows.where("verdict = 'block'")).select("verdict", "block_score").distinct().collect()
    assert [tuple(r) for r in only] == [("block", 1.0)]
    odd = rows.limit(5).union(rows.limit(5)).withColumns({c: F.lit("q") for c in ("host", "path", "rule", "suffix", "label", "features", "prediction")})
    odd = odd.union(odd.limit(1).withColumn("url", F.lit("http://h.com/" + "x9/" * 100_000)))
    got = url_filter.judge(odd).collect()
    assert len(got) == 11 and {r.block_score for r in got} == {0.0} and {r.verdict for r in got} == {"allow"}


def rotated(rows, block=64):
    """Brute force: (conversation, perspective) → rows in order."""
    clean = lambda t: t.replace("<|", "< |").replace("|>", "| >")
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((r[1] is not None, r[1] or 0), clean(r[2] or "unknown"), clean(r[3] or ""), r[1]) for r in rows if r[0] == conv)
        for p in {s for _, s, _, _ in own} - {"system"}:
            at, found = 0, []
            for k, (_, s, body, turn) in enumerate(own):
                head = "<|assistant|>\n" if s == p else "<|system|>\n" if s == "system" else f"<|user name={s}|>\n"
                seg = head + body + "<|end|>\n"
                mask = (at + len(head), at + len(seg) - 1) if s == p else (None, None)
                found.append((k, turn, "assistant" if s == p else s if s == "system" else "user", seg, at, *mask))
                at += len(seg)
            out[conv, p] = found
    return out


def test_rotation_equals_brute_force(spark):
    import random

    rnd = random.Random(5)
    rows = [(1, 0, "user", "hi"), (1, 1, None, None), (1, 200, "user", "x"), (1, 200, "user", "x"), (None, None, "bob", ""), (None, None, "bob", "zz"), (2, 0, "system", "s"), (3, 0, "a|>b", "x<|end|>\n<|assistant|>y"), (3, 1, "c", "<<||>>é" * 50), (3, -70, "c", "w" * 100_000)]
    rows += [(7, rnd.choice([None, *range(400)]), rnd.choice("abcde"), rnd.choice(["", "one", "two words", "drei 3"])) for _ in range(3000)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("block", "speaker", "base", "size", "perspective", "conv")})
    got = {}
    for r in chat_rotation.rotate(d).collect():
        got.setdefault((r.conv_id, r.perspective), []).append(tuple(r)[2:])
    want = rotated(rows)
    assert got.keys() == want.keys()
    for k in want:
        assert sorted(got[k], key=lambda x: x[0]) == want[k], k
    assert chat_rotation.rotate(d.limit(0)).count() == 0


def test_shortage_goes_to_siblings_first(spark):
    rows = [(i, "w " * 10, l, s) for i, (l, s) in enumerate([("a", "x")] * 2 + [("a", "y")] * 40 + [("b", "z")] * 40)] + [(900, None, None, None), (901, "", "a", "x")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = source_mixing.mix(d, {"lang": F.col("lang"), "source": F.col("source")}, [{}, {}], share=400 / 820, max_epochs=1)
    assert {(r.lang, r.source): r.n for r in got.groupBy("lang", "source").agg(F.sum("n_tokens").alias("n")).collect()} == {("a", "x"): 20, ("a", "y"): 180, ("b", "z"): 200}
    twice = source_mixing.mix(d, {"lang": F.col("lang")}, [{"b": 0.0}], share=1.0, max_epochs=2)
    assert {r.lang: r.n for r in twice.groupBy("lang").agg(F.sum("n_tokens").alias("n")).collect()} == {"a": 820}
    assert source_mixing.mix(d.limit(0), {"lang": F.col("lang")}, [{}]).count() == 0
    odd = d.withColumns({c: F.lit(1) for c in ("epoch", "slices", "_salt", "n_tokens", "base", "part")})
    once = source_mixing.mix(odd.union(odd), {"lang": F.col("lang")}, [{}], share=1.0, max_epochs=1, carry=("part",))
    assert once.count() == 164 and {r.part for r in once.collect()} == {1}
    nulls = spark.createDataFrame([(None, f"text {i % 50}", "a") for i in range(400)], "doc_id long, text string, lang string")
    half = source_mixing.mix(nulls, {"lang": F.col("lang")}, [{}], share=0.5, max_epochs=1).collect()
    assert sum(r.n_tokens for r in half) == 400 and sorted(r.start for r in half) == list(range(0, 400, 2))
