from ledgerwright.llm import licenses

FILES = [
    ("LICENSE", "Released under the MIT License."),
    ("src/a.py", "code\nmore code"),
    ("src/b.py", "# Licensed under the Apache License, Version 2.0.\ncode"),
    ("src/vendor/COPYING.txt", "This work is licensed under the GNU General Public License, version 3."),
    ("src/vendor/x/y/c.c", "int main;"),
    ("src/vendored/d.c", "int main;"),
    ("src/e.py", None),
    (None, "code"),
    ("src/a.py", "code\nmore code"),
    ("f.txt", "Licensed under CC BY-NC 4.0."),
    ("g.txt", "we submit to committee"),
]


def test_headers_and_inheritance(spark):
    df = spark.createDataFrame([(*x, "q") for x in FILES], "path string, text string, license string")
    out = licenses.scan(df).collect()
    assert len(out) == len(FILES)
    got = {r["path"]: (r["own_license"], r["license"], r["license_from"]) for r in out}
    assert got["LICENSE"] == ("MIT", "MIT", "LICENSE")
    assert got["src/a.py"] == (None, "MIT", "")
    assert got["src/b.py"] == ("Apache-2.0", "Apache-2.0", "src/b.py")
    assert got["src/vendor/x/y/c.c"] == (None, "GPL-3.0", "src/vendor")
    assert got["src/vendored/d.c"] == (None, "MIT", "")
    assert got["src/e.py"] == (None, "MIT", "")
    assert got[None] == (None, None, None)
    assert got["f.txt"][0] == "CC-BY-NC-4.0" and got["g.txt"] == (None, "MIT", "")


def test_every_notice_is_its_own_nearest():
    t = licenses.Templates({w: 2.0 for w in licenses.VOCABULARY}, 5.0)
    for name, notices in licenses.TEMPLATES.items():
        for n in notices:
            got, cosine = t.best("## " + n)
            assert got == name and cosine > 0.99


def test_empty_table(spark):
    df = spark.createDataFrame([], "path string, text string")
    assert licenses.scan(df).count() == 0


def test_files_and_headers_of_several_lines():
    t = licenses.Templates({w: 2.0 for w in licenses.VOCABULARY}, 5.0)
    mit = "\n".join(f" * {line}" for line in licenses.BLOCKS["MIT"][0][0].replace(", ", ",\n").split("\n"))
    gpl = licenses.BLOCKS["GPL-3.0"][0][0]
    apart = "\n".join(f"# {x}" for x in gpl.replace("under the", "under\nthe").replace("published by", "published by\n").split("\n"))
    filler = "some words of a file " * 30
    for text, want in [
        ("MIT License\n\nCopyright (c) 2020 X", "MIT"),
        ("GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n" + filler, "GPL-3.0"),
        ("   Apache License\n  Version 2.0, January 2004\n" + filler, "Apache-2.0"),
        ("Copyright (c) 2020 X. Licensed under the MIT License.", "MIT"),
        (f"{filler} Licensed under the Apache License, Version 2.0. {filler}", "Apache-2.0"),
        ("# Licensed under the\n# Apache License,\n# Version 2.0.", "Apache-2.0"),
        (f"{filler}\n{mit}\n{filler}", "MIT"),
        (f"{filler}\n{apart}\n{filler}", "GPL-3.0"),
        ("redistributed\n" + licenses.BLOCKS["BSD-3-Clause"][0][0], "BSD-3-Clause"),
        ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", None),
        (gpl.replace("version 3", "version 2"), None),
        (filler + "\nunlike the MIT License\n" + filler, None),
    ]:
        got, cosine = t.find(text, licenses.HEADER)
        assert (got if cosine >= licenses.HEADER else None) == want, text[:80]


def test_lines_that_can_match_are_not_skipped():
    """Whatever `best` gives a line at the threshold or above, `find` gives at least."""
    t = licenses.Templates({w: 1.0 + len(w) for w in licenses.VOCABULARY}, 5.0)
    for notices in licenses.TEMPLATES.values():
        for n in notices:
            words = n.split()
            for gone in range(len(words)):
                line = " ".join(words[:gone] + words[gone + 1 :])
                name, cosine = t.best(line)
                if cosine >= licenses.HEADER:
                    assert t.find(f"ab\n{line}\ncd", licenses.HEADER)[1] >= cosine - 1e-9


def test_columns_of_any_name(spark):
    rows = [("a/LICENSE", "Released under the MIT License.", 1, "x", "y", "z", "w"), ("a/b.txt", "code", 2, "x", "y", "z", "w")]
    files = spark.createDataFrame(rows, "path string, text string, license_dir int, above string, granted string, license_near string, file string")
    out = {r["path"]: (r["license"], r["license_dir"], r["above"], r["granted"], r["license_near"], r["file"]) for r in licenses.scan(files).collect()}
    assert out == {"a/LICENSE": ("MIT", 1, "x", "y", "z", "w"), "a/b.txt": ("MIT", 2, "x", "y", "z", "w")}
