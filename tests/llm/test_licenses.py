import re
import textwrap

from patronlens.llm import known_licenses, licenses
from tests.llm.samples import AWKWARD, documents

ISC = licenses.NOTICES["ISC"][0]


def found_in(spark, rows, known=None):
    got = licenses.scan_licenses(documents(spark, rows), known if known is not None else licenses.notices(spark))
    return {r.doc_id: (r.licenses, r.license_lines) for r in got.collect()}


def test_whole_texts_in_any_dress(spark):
    dressed = "Copyright (c) 2020, Someone\n\n * " + ISC.upper().replace(",", " ,").replace("\n\n", "\n# \n//  ")
    assert found_in(spark, [(1, ISC), (2, dressed), (3, ISC + " And more.")]) == {1: (["ISC"], 0), 2: (["ISC"], 0), 3: ([], 0)}


def test_a_line_is_an_entire_text_but_a_part_of_one_is_not(spark):
    rows = [
        (1, "Some prose.\n  -- Released under the MIT Licence!\nMore prose.\nReleased under the MIT License."),
        (2, "It is released under the MIT License."),
        (3, "Licensed under the Apache License, v. 2.0\nLicensed under CC BY-NC 4.0."),
    ]
    assert found_in(spark, rows) == {1: (["MIT"], 1), 2: ([], 0), 3: (["Apache-2.0", "CC-BY-NC-4.0"], 2)}


def test_copyright_lines_and_spellings(spark):
    known = spark.createDataFrame([("A", "You may sub-license, non commercial use only."), ("B", "you may sublicense noncommercial use only"), ("C", None), ("D", " -- ")], "license_id string, text string")
    text = "(C) 1999 Them\n© us\nAll rights reserved.\nYOU MAY SUBLICENSE; NON-COMMERCIAL\nuse only"
    assert found_in(spark, [(1, text), (2, "copyrighted use only")], known) == {1: (["A", "B"], 0), 2: ([], 0)}


def test_awkward_rows(spark):
    df = documents(spark, AWKWARD, clashing=True)
    got = licenses.scan_licenses(df, licenses.notices(spark))
    rows = got.collect()
    assert got.columns == [*(c for c in df.columns if c != "digest"), "digest", "licenses", "license_lines"]
    assert len(rows) == len(AWKWARD) and all(r.document == "own document" and r.licenses == [] for r in rows)
    assert {r.doc_id for r in rows if r.digest is None} == {None, 1, 2, 3}
    assert licenses.scan_licenses(df.limit(0), licenses.notices(spark)).collect() == []
    repeated = found_in(spark, [(5, ISC), (5, ISC), (5, "other"), (None, ISC)])
    assert repeated[None] == (["ISC"], 0)
    assert licenses.scan_licenses(documents(spark, [(1, ISC)]), licenses.notices(spark).limit(0)).first().licenses == []


def test_no_python_in_the_plan(spark, capsys):
    licenses.scan_licenses(documents(spark, [(1, "a")]), licenses.notices(spark)).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_every_lead_in_and_version(spark):
    names = {
        "the Mozilla Public License, version 2.0": "MPL-2.0",
        "the GNU General Public License, version 2": "GPL-2.0",
        "the GNU General Public License, version 3": "GPL-3.0",
        "the GNU Lesser General Public License, version 2.1": "LGPL-2.1",
        "the GNU Lesser General Public License, version 3": "LGPL-3.0",
        "the Apache License, Version 2.0": "Apache-2.0",
        "the MIT License": "MIT",
        "the BSD 3-Clause License": "BSD-3-Clause",
        "the BSD 2-Clause License": "BSD-2-Clause",
        "CC0 1.0": "CC0-1.0",
        **{f"CC {parts} 4.0": f"CC-{parts}-4.0" for parts in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")},
    }
    cases = [(f"{lead} {name}.", found) for lead in ("Licensed under", "Released under", "This work is licensed under") for name, found in names.items()]
    got = found_in(spark, [(i, f"Prose.\n{text}\nMore.") for i, (text, _) in enumerate(cases)])
    assert got == {i: ([name], 1) for i, (_, name) in enumerate(cases)}


def test_whole_common_licences(spark):
    texts = known_licenses.whole_texts()
    assert set(texts) >= {"MIT", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "MPL-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "Unlicense", "CC0-1.0"}
    names = sorted(texts)
    rows = [(i, texts[name]) for i, name in enumerate(names)]
    rows += [(100 + i, "Copyright (c) 2021 Someone\n\n" + texts[name].upper()) for i, name in enumerate(names)]
    rows += [(200 + i, known_licenses.paragraphs(texts[name])) for i, name in enumerate(names)]
    rows += [(300 + i, texts[name] + "\nAnd one sentence more.") for i, name in enumerate(names)]
    rows += [(400, "MIT License\n\nCopyright (c) 2021 Someone\n\n" + texts["MIT"]), (401, texts["Apache-2.0"].split("   APPENDIX")[0])]
    got = found_in(spark, rows)
    for i, name in enumerate(names):
        assert got[i] == got[100 + i] == got[200 + i] == ([name], 0) and got[300 + i][0] == []
    assert got[400] == (["MIT"], 0) and got[401] == (["Apache-2.0"], 0)


OWN_STATEMENT = {"GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MPL-1.1"}  # state a copyright inside a paragraph


def rewrapped(text, width):
    """Each paragraph and list item filled to a width."""
    return "\n".join(textwrap.fill(line.strip(), width, break_long_words=False, break_on_hyphens=False) for line in known_licenses.paragraphs(text).split("\n"))


def test_whole_licences_wrapped_anywhere(spark):
    texts = {name: text for name, text in known_licenses.whole_texts().items() if name not in OWN_STATEMENT}
    cases = [(name, width) for name in sorted(texts) for width in range(60, 121, 1 if len(texts[name]) < 4000 else 6)]
    got = found_in(spark, [(i, rewrapped(texts[name], width)) for i, (name, width) in enumerate(cases)])
    assert [case for i, case in enumerate(cases) if got[i][0] != [case[0]]] == []


def test_lines_that_state_a_copyright(spark):
    stated = ["Copyright (c) 2020 Us", "copyright 1999-2001, us", "Copyright by us", " * © us", "(C) 2001 us", "Copyright [yyyy] [name]", "ALL RIGHTS RESERVED."]
    kept = ["copyright notice and this", "COPYRIGHT HOLDERS BE LIABLE", "(c) You must retain", "copyright owner or by an individual", "copyright.", "all rights reserved by law"]
    rows = list(enumerate(["some words", *(f"{line}\nsome words" for line in stated + kept)]))
    known = spark.createDataFrame([("K", "Some words.")], "license_id string, text string")
    got = {r.doc_id: (r.digest, r.license_lines) for r in licenses.scan_licenses(documents(spark, rows), known).collect()}
    same = [got[i + 1][0] == got[0][0] for i in range(len(stated + kept))]
    assert same == [True] * len(stated) + [False] * len(kept)
    assert {lines for _, lines in got.values()} == {1}
