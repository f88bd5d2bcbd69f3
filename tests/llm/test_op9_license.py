import textwrap

import pytest

from lendspark.llm.licenses import KNOWN
from lendspark.llm.op9_license import known_digests, scan
from tests_llm_helpers import crowd

MIT, BSD3 = KNOWN[0][1], KNOWN[10][1]


def run(spark, texts):
    df = crowd(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    return {r["doc_id"]: (r["license_id"], r["notices"]) for r in scan(df, known_digests(spark)).collect()}


def test_whole_texts_in_many_spellings(spark):
    odd = "Copyright (c) 2020 Someone\n\n" + MIT.upper().replace(", ", " ,\n").replace("SUBLICENSE", "SUB-LICENCE")
    got = run(spark, [MIT, odd, "\n" + MIT.replace(" ", "  ") + "\n\n(c) 2001 A. Nother", BSD3.replace("copyright holder", "copyright owner"), MIT + " more", "Mit"])
    assert [got[i][0] for i in range(6)] == ["MIT", "MIT", "MIT", "BSD-3-Clause", None, None]


def test_notice_lines(spark):
    got = run(spark, ["Text.\nReleased under the MIT Licence!", "a Released under the MIT License.", "x\nlicensed under CC-BY-NC 4.0\nReleased under the MIT License.\nReleased under the MIT License."])
    assert got == {0: (None, "MIT"), 1: (None, ""), 2: (None, "CC-BY-NC-4.0,MIT")}


def test_defined_cases(spark):
    got = run(spark, [None, "", "...\n!", "word " * 100_000 + "\nReleased under the MIT License."])
    assert got == {0: (None, ""), 1: (None, ""), 2: (None, ""), 3: (None, "MIT")}
    rows = [(1, "Released under the MIT License.")] * 3 + [(None, "Released under the MIT License.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r["license_id"] for r in scan(df, known_digests(spark)).collect()] == ["MIT"] * 4
    assert scan(df.limit(0), known_digests(spark)).count() == 0
    with pytest.raises(ValueError):
        known_digests(spark, [("x", "y")] * 20_000)


def test_main_path_is_native(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = scan(df, known_digests(spark))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


ISC_AS_PUBLISHED = """Copyright (c) 2004-2010 by Some Consortium, Inc. ("SC")
Copyright The Other Authors

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""


def test_every_known_text_in_every_wrap(spark):
    wrap = lambda t, n: "\n".join(textwrap.fill(x, n, break_long_words=False, break_on_hyphens=False) for x in t.split("\n"))
    cases = [(i, wrap(t, n)) for i, t in KNOWN for n in range(12, 100)] + [("ISC", ISC_AS_PUBLISHED)]
    got = run(spark, [t for _, t in cases])
    assert [(n, i) for n, (i, _) in enumerate(cases) if got[n][0] != i] == []


def test_notice_on_the_licences_own_line(spark):
    heads = ["Copyright (c) 2020 A. Nother, Inc. ", "(c) 1999 X ", "© The Authors. All rights reserved. ", "Copyright 2001-2003 by X, Y and Z: "]
    cases = [(i, h + " ".join(t.split())) for i, t in KNOWN for h in heads]
    got = run(spark, [t for _, t in cases])
    assert [(n, i) for n, (i, _) in enumerate(cases) if got[n][0] != i] == []


def test_list_items_and_body_lines_are_no_notices(spark):
    got = run(spark, ["Copyright notice\n" + MIT, "(c) You must retain it.\n" + MIT, "All rights reserved by X\n" + MIT, "All rights reserved.\n" + MIT])
    assert [got[i][0] for i in range(4)] == [None, None, None, "MIT"]
