from coverloom.llm import line_dedup

SCHEMA = "doc_id bigint, text string, source string, n_lines string, line string"


def test_lines_on_many_sites_go(spark):
    given = [(k, f"own {k}\n  Menu \nalso {k % 2}\n", f"s{k}", "x", "y") for k in range(4)]
    given += [(4, "Menu\n\nMenu", None, "x", "y"), (5, None, "s1", "x", "y"), (6, "", "s2", "x", "y"), (6, "", "s2", "x", "y")]
    given += [(7, "once\nfive sites", "s1", "x", "y")] + [(8, "five sites", f"s{k}", "x", "y") for k in range(4)]
    frame = spark.createDataFrame(given, SCHEMA)
    cleaned = line_dedup.remove_spread_lines(frame, sites=5)
    got = sorted((r.doc_id, r.text, r.n_lines, r.n_removed) for r in cleaned.collect() if r.text is not None)
    expected = [(k, f"own {k}\nalso {k % 2}\n", 4, 1) for k in range(4)]
    # "Menu" is on s0-s3 and the null site: five. "five sites" is on four.
    expected += [(4, "", 3, 2), (6, "", 1, 0), (6, "", 1, 0), (7, "once\nfive sites", 2, 0)] + [(8, "five sites", 1, 0)] * 4
    assert got == sorted(expected)
    assert [(r.doc_id, r.n_lines) for r in cleaned.filter("text is null").collect()] == [(5, 0)]
    assert sorted(cleaned.columns) == sorted(["doc_id", "text", "source", "line", "n_lines", "n_removed"])


def test_sketch_and_exact_counts_agree_near_and_far_from_the_limit(spark):
    given = [(1, "\n".join(f"line {n}" for n in range(1, 30) if n >= s), f"s{s}", "", "") for s in range(1, 30)]
    frame = spark.createDataFrame(given, SCHEMA)
    for sites in (2, 5, 20):
        kept = {line for r in line_dedup.remove_spread_lines(frame, sites).collect() for line in r.text.split("\n") if line}
        assert kept == {f"line {n}" for n in range(1, sites)}


def test_empty_table(spark):
    assert line_dedup.remove_spread_lines(spark.createDataFrame([], SCHEMA)).count() == 0
