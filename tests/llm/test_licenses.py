from dinerlake.llm.licenses import license_scan


def scan(spark, rows):
    df = spark.createDataFrame(rows, "path string, text string, score int, name string")
    return sorted(((r.path or "", r.license, r.origin, r.directory) for r in license_scan(df).collect()), key=str)


FILES = [
    ("LICENSE", "Released under the MIT License.", 0, ""),
    ("a/b/COPYING", "This work is licensed under the GNU General Public License, version 3.", 0, ""),
    ("a/x.py", "code\n# Licensed under the Apache License, Version 2.0.\nmore code", 0, ""),
    ("a/y.py", "no words on it", 0, ""),
    ("a/b/c/d/z.py", None, 0, ""),
    ("a/b/c/d/z2.py", "", 0, ""),
    ("q/block.c", "// Redistribution and use in source and binary forms, with or without\n// modification, are permitted "
     "provided that the\n// following conditions are met: neither the name of the copyright holder\nint x;", 0, ""),
    (None, "Released under the MIT License.", 0, ""),
    ("dup", "Licensed under CC BY-NC 4.0.", 0, ""), ("dup", "plain", 0, ""),
    ("q/talk.txt", "We discussed whether a fishing licence is needed at the lake near the old mill in spring", 0, ""),
]


def test_own_and_inherited(spark):
    assert scan(spark, FILES) == sorted([
        ("LICENSE", "MIT", "own", None), ("a/b/COPYING", "GPL-3.0", "own", None), ("a/x.py", "Apache-2.0", "own", None),
        ("a/y.py", "MIT", "inherited", ""), ("a/b/c/d/z.py", "GPL-3.0", "inherited", "a/b"),
        ("a/b/c/d/z2.py", "GPL-3.0", "inherited", "a/b"), ("q/block.c", "BSD-3-Clause", "own", None),
        ("", None, "none", None), ("dup", "CC-BY-NC-4.0", "own", None), ("dup", "CC-BY-NC-4.0", "own", None),
        ("q/talk.txt", "MIT", "inherited", ""),
    ], key=str)


def test_empty_long_and_without_licence_files(spark):
    assert scan(spark, []) == []
    long = "word " * 300_000 + "\nReleased under the MIT License.\n" + "# note\n" * 20_000
    assert scan(spark, [("a", long, 0, ""), ("b", "x", 0, "")]) == [("a", "MIT", "own", None), ("b", None, "none", None)]


def test_long_chains_of_numbers(spark):
    chain = "Licensed under version 1" + ".1" * 300_000 + " of the MIT License."
    found = scan(spark, [("LICENSE", chain, 0, ""), ("a.py", "Released under the MIT License.", 0, "")])
    assert [f[0] for f in found] == ["LICENSE", "a.py"] and found[1][1] == "MIT"
