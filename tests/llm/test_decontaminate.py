import random
import re

import numpy as np

from coverloom.llm import decontaminate
from coverloom.llm.decontaminate import tile

from conftest import TESTDATA

DOCS, ITEMS = "doc_id bigint, text string, row string, item string", "item_id bigint, text string, words string"


def plain_tiles(item, text, shortest):
    """Greedy string tiling without hashing: the longest free run again and again."""
    a, b, total = [False] * len(item), [False] * len(text), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and not a[i + n] and not b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < shortest:
            return total
        a[i : i + n] = b[j : j + n] = [True] * n
        total += n


def test_tiles_cover_what_plain_tiling_covers():
    pick = random.Random(4)
    for _ in range(60):
        item = [pick.randint(1, 12) for _ in range(pick.randint(3, 30))]
        cuts = [item[k : k + pick.randint(2, 9)] for k in range(0, len(item), 4)]
        pick.shuffle(cuts)
        text = [w for c in cuts for w in [*c, pick.randint(1, 30)]]
        tiles = tile(np.array(item, np.uint64), np.array(text, np.uint64), 3)
        for i, j, n in tiles:
            assert item[i : i + n] == text[j : j + n] and n >= 3
        assert len({k for i, _, n in tiles for k in range(i, i + n)}) == sum(n for *_, n in tiles) == len({k for _, j, n in tiles for k in range(j, j + n)})
        assert abs(sum(n for *_, n in tiles) - plain_tiles(item, text, 3)) <= 6  # the length falls in steps


def test_exact_changed_and_reordered_passages(spark):
    item = "One two three four five, six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen."
    w = re.findall(r"\w+", item)
    reordered = " ".join([*w[8:], "and", *w[:8]])
    given = [
        (1, "before " + item.upper().replace(" ", " -- ") + " after"), (2, reordered), (3, " ".join(w[:6]) + " other words here"),
        (4, " ".join(w[::-1])), (5, None), (6, ""), (None, item), (1, "clean under the same id"), (7, item), (7, item), (8, "x " * 60_000 + item),
    ]
    items = [(20, item, ""), (10, item.lower(), ""), (30, "too short", ""), (31, None, ""), (None, item + " more", "")]
    docs = spark.createDataFrame([(i, t, "r", "s") for i, t in given], DOCS)
    benchmark = spark.createDataFrame(items, ITEMS)
    found = decontaminate.contaminated(docs, benchmark).filter("item_id = 10").collect()
    assert sorted((r.doc_id or 0, round(r.coverage, 2)) for r in found) == [(0, 1.0), (1, 1.0), (2, 1.0), (7, 1.0), (7, 1.0), (8, 1.0)]
    clean = decontaminate.clean_documents(docs, benchmark)
    assert clean.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in clean.collect()) == sorted((i, t or "") for i, t in (given[2], given[3], given[4], given[5], given[7]))


def test_short_items_and_other_scripts(spark):
    latin = "one two three four five six seven eight"
    items = [
        (1, "too short"), (2, "这是一个测试题目，请选择正确的答案。"), (3, "これはペンです"), (4, "ประเทศไทยสวยงาม"), (5, latin), (6, "Paris"), (7, "—…!"), (8, "中文"),
    ]
    texts = {
        10: "this is TOO — short, yes", 11: "too very short", 12: "前文。这是一个测试题目,请选择正确的答案!后文", 13: "昨日、これはペンです。", 14: "xประเทศไทยสวยงามy",
        15: latin.replace(" ", "\u00a0"), 16: latin.replace(" ", "\u3000"), 17: "before—" + latin.replace(" ", "—") + "…after", 18: "in paris?", 19: "comparison", 20: "学中文吗", 21: "中 x 文", 22: "…",
    }
    docs = spark.createDataFrame([(i, t, "", "") for i, t in texts.items()], DOCS)
    benchmark = spark.createDataFrame([(i, t, "") for i, t in items], ITEMS)
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert found == {(10, 1), (12, 2), (13, 3), (14, 4), (15, 5), (16, 5), (17, 5), (18, 6), (20, 8)}
    assert {r.doc_id for r in decontaminate.clean_documents(docs, benchmark).collect()} == {11, 19, 21, 22}


def test_empty_tables(spark):
    docs, benchmark = spark.createDataFrame([(1, "a b c d e f", "", "")], DOCS), spark.createDataFrame([], ITEMS)
    assert decontaminate.contaminated(docs, benchmark).count() == 0
    assert decontaminate.contaminated(docs.limit(0), benchmark).count() == 0
    assert decontaminate.clean_documents(docs, benchmark).count() == 1


def test_finds_every_whole_passage_of_the_tables(spark):
    docs, benchmark = (spark.read.parquet(f"{TESTDATA}/{t}.parquet") for t in ("documents", "benchmark"))
    flat = lambda t: " ".join(["", *re.findall(r"[^\W_]+", (t or "").lower()), ""])
    texts = [(r.doc_id, flat(r.text)) for r in docs.collect()]
    expected = {(d, r.item_id) for r in benchmark.collect() for d, t in texts if flat(r.text) in t}
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert expected and expected == found
