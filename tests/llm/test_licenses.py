from pathlib import Path

import pytest

from tabloom.llm import licenses

GPL = "This work is licensed under the GNU General Public License, version 3."
MIT = "Released under the MIT License."


def scan(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "id long, path string, text string")
    return {r["id"]: (r["license"], r["origin"], r["from_dir"]) for r in licenses.scan(docs, **kw).collect()}


def test_headers_files_and_nearest_ancestors(spark):
    rows = [
        (1, "a/LICENSE", GPL),
        (2, "a/b/code.py", "print(1)\nprint(2)"),
        (3, "a/b/c/code.py", "# " + MIT + "\nimport os\n" + "x = 1\n" * 300),
        (4, "a/b/d/COPYING", MIT + " Permission is hereby granted, free of charge, to any person"),
        (5, "a/b/d/e/f/code.py", "x"),
        (6, "z/code.py", "no notice here"),
        (7, "ab/code.py", "a is not an ancestor of ab"),
        (8, None, None),
        (9, "top", ""),
    ]
    got = scan(spark, rows)
    assert got[1] == ("GPL-3.0", "header", None)
    assert got[2] == ("GPL-3.0", "inherited", "a")
    assert got[3] == ("MIT", "header", None)
    assert got[4][:2] == ("MIT", "header")
    assert got[5] == ("MIT", "inherited", "a/b/d")
    assert got[6] == got[7] == got[8] == got[9] == (None, None, None)


def test_a_licence_file_at_the_root_covers_everything(spark):
    got = scan(spark, [(1, "LICENSE", GPL), (2, "x/y/z", "body"), (3, None, "body")])
    assert got[2] == got[3] == ("GPL-3.0", "inherited", "")


def test_headers_over_several_lines(spark):
    split = "Licensed under the Apache License,\nVersion 2.0 (the License); you may not use this file\nexcept in compliance with the License."
    assert scan(spark, [(1, "f", split + "\n" + "word " * 500)])[1][0] == "Apache-2.0"


def test_a_cue_alone_is_no_licence(spark):
    assert scan(spark, [(1, "f", "He has a licence to drive a truck on every road of this island and of others.")])[1][0] is None


def test_long_texts_repeated_rows_clashes_and_empty_tables(spark):
    rows = [(1, "d/a", GPL + "\n" + "word " * 100_000), (2, "d/b", MIT), (2, "d/b", MIT)]
    docs = spark.createDataFrame(rows, "id long, path string, text string").selectExpr(
        "*", "'clash' AS license", "'clash' AS term", "'clash' AS doc", "'clash' AS from_dir"
    )
    out = licenses.scan(docs).collect()
    assert sorted((r["id"], r["license"]) for r in out) == [(1, "GPL-3.0"), (2, "MIT"), (2, "MIT")]
    assert licenses.scan(docs.limit(0)).count() == 0


def test_spdx_tags_name_the_licence_and_unknown_ones_none(spark):
    known = {"MIT": "MIT", "Apache-2.0": "Apache-2.0", "GPL-3.0-only": "GPL-3.0", "LGPL-3.0-or-later": "LGPL-3.0", "BSD-3-Clause": "BSD-3-Clause"}
    filler = "\nmit ihr und mit uns on this day\n" + "word " * 300
    rows = [(i, f"d{i}/f", f"// SPDX-License-Identifier: {name}{filler}") for i, name in enumerate(known)]
    rows += [(100, "u/f", "# SPDX-License-Identifier: GPL-2.0-only" + filler), (101, "v/f", "/* spdx-license-identifier:mit */" + filler)]
    got = {i: found[0] for i, found in scan(spark, rows).items()}
    assert [got[i] for i in range(len(known))] == list(known.values())
    assert got[100] is None and got[101] == "MIT"


def test_many_cue_lines_in_one_text(spark):
    lines = ["this licence line %d says nothing of use" % i for i in range(8000)]
    rows = [(1, "a/f", "\n".join(lines)), (2, "b/f", "\n".join([*lines, GPL])), (3, "c/f", "\n".join([*lines[:4000], MIT, *lines[4000:]]))]
    got = scan(spark, rows)
    assert [got[i][0] for i in (1, 2, 3)] == [None, "GPL-3.0", "MIT"]


COMMON = Path("/usr/share/common-licenses")
# file of the folder, licence that its title names
NAMED = {
    "Apache-2.0": "Apache-2.0",
    "Artistic": "Artistic-1.0",
    "CC0-1.0": "CC0-1.0",
    "GFDL-1.2": "GFDL-1.2",
    "GFDL-1.3": "GFDL-1.3",
    "GPL-1": "GPL-1.0",
    "GPL-2": "GPL-2.0",
    "GPL-3": "GPL-3.0",
    "LGPL-2": "LGPL-2.0",
    "LGPL-2.1": "LGPL-2.1",
    "LGPL-3": "LGPL-3.0",
    "MPL-1.1": "MPL-1.1",
    "MPL-2.0": "MPL-2.0",
}


def licence_rows():
    rows = [(i, f"p{i}/LICENSE", (COMMON / n).read_text()) for i, n in enumerate(NAMED)]
    rows += [(100 + i, f"p{i}/src/code.py", f"x = {i}") for i in range(len(NAMED))]
    return rows + [(1000 + i, f"other/{i}", f"filler text of document {i} about the sea and the ships") for i in range(500)]


@pytest.mark.skipif(not COMMON.is_dir(), reason="needs a folder of licence texts")
def test_whole_licence_texts_name_themselves_and_are_inherited(spark):
    whole = licenses.licence_texts(spark, str(COMMON)).filter(licenses.F.col("license").isin(*NAMED))
    got = scan(spark, licence_rows(), whole=whole)
    assert {n: got[i][:2] for i, n in enumerate(NAMED)} == {n: (v, "header") for n, v in NAMED.items()}
    assert {n: got[100 + i] for i, n in enumerate(NAMED)} == {n: (n, "inherited", f"p{i}") for i, n in enumerate(NAMED)}
    assert all(got[1000 + i][0] is None for i in range(500))


@pytest.mark.skipif(not COMMON.is_dir(), reason="needs a folder of licence texts")
def test_without_licence_texts_no_directory_inherits_a_wrong_licence(spark):
    got = scan(spark, licence_rows())
    assert {n: got[i][0] for i, n in enumerate(NAMED)} == NAMED
    assert all(got[100 + i][0] in (None, v) for i, v in enumerate(NAMED.values()))


def test_a_header_longer_than_a_run_is_read_to_the_end_of_its_block(spark):
    notice = licenses.TEMPLATES["MIT"][2].split()
    header = "\n".join("# " + " ".join(notice[i : i + 6]) for i in range(0, len(notice), 6))
    rows = [(1, "a/f", "#!/bin/sh\n\n" + header + "\n\n" + "word " * 500), (2, "b/f", "first line\n \t\n" + header)]
    rows += [(100 + i, f"c/{i}", "the software and the rights to use it") for i in range(50)]
    got = scan(spark, rows, least=0.9)
    assert got[1][0] == got[2][0] == "MIT"


def test_tags_of_older_licences_are_found_if_asked_for(spark):
    tags = [(name, tag) for name, known in licenses.OLDER_TAGS.items() for tag in known]
    rows = [(i, f"d{i}/f", f"# SPDX-License-Identifier: {tag}\n" + "word " * 300) for i, (_, tag) in enumerate(tags)]
    got = scan(spark, rows, templates=licenses.WITH_OLDER_TAGS)
    assert [got[i][0] for i in range(len(tags))] == [name for name, _ in tags]
