import time

import numpy as np

from coverloom.llm import licenses

SCHEMA = "doc_id bigint, text string, license string, lines string"


def scan(spark, texts):
    docs = spark.createDataFrame([(k, t, "x", "y") for k, t in enumerate(texts)], SCHEMA)
    return sorted(tuple(r) for r in licenses.scan(docs, licenses.known_licenses(spark)).collect())


def test_same_licence_in_other_words(spark):
    mit = licenses.KNOWN[0][1]
    texts = [
        "Copyright (c) 2020 Some One\n\n" + mit.upper().replace("LICENSE", "LICENCE"),
        "© 1999 me\n" + mit.replace(". ", ".\n").replace('"', "''").replace("sublicense", "sub-license"),
        mit + " And more.",
        "Some text.\nRELEASED under the MIT Licence!\nMore text.",
        "Licensed under CC BY-NC 4.0",
        None, "", "Copyright (c) 2020 Some One",
    ]
    assert scan(spark, texts) == [(0, "MIT", 0), (1, "MIT", 0), (3, "MIT", 2), (4, "CC-BY-NC-4.0", 0), (4, "CC-BY-NC-4.0", 1)]


def test_copies_and_no_rows(spark):
    assert len(scan(spark, ["Released under the MIT License."] * 3)) == 6
    assert scan(spark, []) == []


def test_equal_known_texts_are_one(spark):
    known = spark.createDataFrame([("b", "Some   terms"), ("a", "some TERMS."), ("c", "")], "license string, text string")
    docs = spark.createDataFrame([(1, "x\nSome terms", "", "")], SCHEMA)
    assert [tuple(r) for r in licenses.scan(docs, known).collect()] == [(1, "a", 2)]


def test_full_texts_and_titles(spark):
    full = {name: [t for n, t in licenses.KNOWN if n == name] for name, _ in licenses.KNOWN}
    long = {name: max(texts, key=len) for name, texts in full.items()}
    names = ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "Unlicense", "CC0-1.0"]
    found = scan(spark, [long[n] for n in names])
    assert [f for f in found if f[2] == 0] == [(k, n, 0) for k, n in enumerate(names)]
    assert {f[1] for f in found if f[0] == 0} == {"Apache-2.0"}


def test_wrapped_and_inside_longer_documents(spark):
    mit = licenses.KNOWN[0][1]
    words = mit.split()
    cut = words.index("COPYRIGHT")
    wrapped = "MIT License\n\nCopyright (c) 2020 Some One\n\n" + " ".join(words[:cut]) + "\n" + " ".join(words[cut:])
    inside = "A manual.\n\n" + wrapped + "\n\nThe end."
    texts = [wrapped, inside, inside.replace("The end.", "").replace("SOFTWARE.", "SOFTWARE. More."), "Released under\nthe MIT License.\nEnd"]
    assert scan(spark, texts) == [(0, "MIT", 0), (0, "MIT", 5), (1, "MIT", 3), (1, "MIT", 7), (3, "MIT", 1)]


def test_name_before_the_year(spark):
    mit = licenses.KNOWN[0][1]
    texts = [f"{notice}\n\n{mit}" for notice in ("Copyright Ann Example 2020", "Copyright Ann Example, 2018-2020. All rights reserved.", "Copyright, by Ann Example")]
    assert [f for f in scan(spark, texts) if f[2] == 0] == [(0, "MIT", 0), (1, "MIT", 0)]
    assert licenses.canonical_lines("copyright treaty adopted on 20 December 1996") != [""]


def test_runs_equal_brute_force():
    rng = np.random.default_rng(5)
    docs = [[str(rng.choice(["a", "b b", "", "abc", "a a"])) for _ in range(int(rng.integers(0, 14)))] for _ in range(40)]
    lengths = np.array([1, 3, 5, 9, 12])
    expected = []
    for d, lines in enumerate(docs):
        kept = [(k + 1, x) for k, x in enumerate(lines) if x]
        for i in range(len(kept)):
            for j in range(i, len(kept)):
                text = " ".join(x for _, x in kept[i : j + 1])
                if len(text) in lengths:
                    whole = (i, j) == (0, len(kept) - 1)
                    expected += [(d, 0, text)] * whole + [(d, kept[i][0], text)] * (not whole or i == j)
    digest = {}
    for window in (3, 1 << 20):
        found = list(zip(*(x.tolist() for x in licenses.runs_of(docs, lengths, window)), strict=True))
        assert sorted((d, p) for d, p, *_ in found) == sorted((d, p) for d, p, _ in expected)
        for (d, p, *h), (e, q, text) in zip(sorted(found, key=lambda f: f[:2]), sorted(expected, key=lambda f: f[:2]), strict=True):
            if sum(x[:2] == (d, p) for x in expected) == 1:
                assert digest.setdefault(text, h) == h
    assert len({tuple(h) for h in digest.values()}) == len(digest)


def test_many_short_lines_take_time_in_proportion(spark):
    known = np.array(sorted({len(" ".join(filter(None, licenses.canonical_lines(t)))) for _, t in licenses.KNOWN}))
    begun = time.perf_counter()
    licenses.runs_of([licenses.canonical_lines("the\n" * 100_000)], known)
    assert time.perf_counter() - begun < 30
    mit = licenses.KNOWN[0][1]
    assert scan(spark, ["permission\n" * 30_000 + mit + "\nthe" * 30_000]) == [(0, "MIT", 30_001)]


def test_null_ids(spark):
    docs = spark.createDataFrame([(None, "Licensed under CC BY 4.0.", "", ""), (None, None, "", "")], SCHEMA)
    found = [tuple(r) for r in licenses.scan(docs, licenses.known_licenses(spark)).collect()]
    assert sorted(found, key=repr) == [(None, "CC-BY-4.0", 0), (None, "CC-BY-4.0", 1)]
