"""Licence scan: licence files, statements over several lines, inheritance over levels, row keys."""

from ledgerlake.llm import licenses

MIT = "MIT License\n\nCopyright (c) 2019 A. Writer\n\n" + licenses.FILES["MIT"]
PROSE = "the river ran past seven towns and every one of them kept a small market where people bought bread and told stories " * 30
GPL = ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software "
       "Foundation, Inc. <https://fsf.org/>\n" + licenses.FILES["GPL-3.0"].split("2007", 1)[1] + """
  To protect your rights, we need to prevent others from denying you these rights or asking you to surrender the rights.  Therefore, you
have certain responsibilities if you distribute copies of the software, or if you modify it: responsibilities to respect the freedom of others.
  For example, if you distribute copies of such a program, whether gratis or for a fee, you must pass on to the recipients the same freedoms
that you received.  You must make sure that they, too, receive or can get the source code.  And you must show them these terms so they know
their rights.
                       TERMS AND CONDITIONS
  0. Definitions.  "This License" refers to version 3 of the GNU General Public License.  "Copyright" also means copyright-like laws that
apply to other kinds of works, such as semiconductor masks.  "The Program" refers to any copyrightable work licensed under this License.
Each licensee is addressed as "you".  "Licensees" and "recipients" may be individuals or organizations.""")


def _scan(spark, rows, **kw):
    df = spark.createDataFrame([(i, f"/{p}", t) for i, p, t in rows], "doc_id bigint, path string, text string")
    return {(r.path[1:], r.doc_id): (r.license, r.how, r.from_dir) for r in licenses.scan(df.repartition(3), **kw).collect()}


def test_licence_files_speak_for_their_directories(spark):
    got = _scan(spark, [
        (1, "a/LICENSE", MIT), (2, "a/x.py", PROSE), (3, "a/deep/er/y.py", "nothing here"), (4, "b/LICENSE", licenses.FILES["MIT"]), (5, "b/z.py", None),
        (6, "c/LICENSE", licenses.FILES["BSD-3-Clause"]), (7, "c/w.py", ""), (8, "c/d/COPYING", GPL), (9, "c/d/v.py", "text"), (10, "c/d/e/u.py", "text"),
        (11, "e/t.py", PROSE), (12, "f/LICENSE", licenses.FILES["BSD-2-Clause"]), (13, "f/s.py", "text"), (14, "abc/r.py", "text")])
    assert got[("a/LICENSE", 1)][0] == "MIT" and got[("b/LICENSE", 4)][:2] == ("MIT", "file")
    assert got[("a/x.py", 2)] == ("MIT", "inherited", "/a") == got[("a/deep/er/y.py", 3)]
    assert got[("b/z.py", 5)] == ("MIT", "inherited", "/b")
    assert got[("c/w.py", 7)] == ("BSD-3-Clause", "inherited", "/c")
    assert got[("c/d/COPYING", 8)][0] == "GPL-3.0"
    assert got[("c/d/v.py", 9)] == got[("c/d/e/u.py", 10)] == ("GPL-3.0", "inherited", "/c/d")  # the nearest
    assert got[("f/s.py", 13)] == ("BSD-2-Clause", "inherited", "/f")
    assert got[("e/t.py", 11)] == (None, "none", None) == got[("abc/r.py", 14)]  # /a is not above /abc


def test_a_header_in_a_long_text_is_its_own_only(spark):
    got = _scan(spark, [(1, "a/x", PROSE + "\nReleased under the MIT License.\n" + PROSE), (2, "a/y", PROSE)])
    assert got[("a/x", 1)] == ("MIT", "header", None) and got[("a/y", 2)] == (None, "none", None)


def test_a_statement_over_two_lines(spark):
    one = "This work is licensed under the GNU\n\nGeneral Public License, version 3."
    got = _scan(spark, [(1, "a/x", PROSE + "\n" + one), (2, "b/x", "all rights of copyright\n" + PROSE)])
    assert got[("a/x", 1)][:2] == ("GPL-3.0", "header") and got[("b/x", 2)] == (None, "none", None)


def test_rows_are_judged_by_their_own_text(spark):
    df = spark.createDataFrame([(5, "/a/5", "Released under the MIT License."), (5, "/a/5", "Released under the MIT License."), (5, "/a/5", PROSE),
                                (None, "/_/_", "Licensed under the Apache License, Version 2.0."), (None, "/_/_", PROSE)], "doc_id bigint, path string, text string")
    got = sorted((r.doc_id or 0, r.license, r.how) for r in licenses.scan(df).collect())
    assert got == [(0, "Apache-2.0", "header"), (0, "Apache-2.0", "inherited"), (5, "MIT", "header"), (5, "MIT", "header"), (5, "MIT", "inherited")]


def test_layout_has_three_levels(spark):
    docs = spark.createDataFrame([(i, "t", "en", "s") for i in (0, 64, 65, 1024, 1025)] + [(None, "t", None, None)], "doc_id bigint, text string, lang string, source string")
    assert {r.path for r in licenses.as_files(docs).collect()} == {"/s/0", "/s/en/64", "/s/en/1/65", "/s/1024", "/s/en/16/1025", "/_/_/_/_"}


def test_an_upper_level_decides(spark):
    docs = spark.createDataFrame([(64, "Released under the MIT License.", "en", "s"), (65, "x", "en", "s"), (200, "x", "en", "s"), (201, "x", "fr", "s")],
                                 "doc_id bigint, text string, lang string, source string")
    got = {r.doc_id: (r.license, r.from_dir) for r in licenses.scan(licenses.as_files(docs)).collect()}
    assert got == {64: ("MIT", None), 65: ("MIT", "/s/en"), 200: ("MIT", "/s/en"), 201: (None, None)}
