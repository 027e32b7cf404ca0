import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from coverloom.llm import queries, resample
from coverloom.llm.common import table

from conftest import TESTDATA

DOCS, ITEMS = "doc_id bigint, text string, weight string, n string", "item_id bigint, text string"


def plain_features(text, n=2):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    return words, [zlib.crc32(" ".join(words[k : k + m]).encode()) % 10_000 for m in range(1, n + 1) for k in range(len(words) - m + 1)]


def plain(docs, items, share=25, least=20):
    rows = [(i, *plain_features(t)) for i, t in docs]
    s, t = Counter(b for *_, f in rows for b in f), Counter(b for x in items for b in plain_features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000))))
    found = []
    for i, words, f in rows:
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        found.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= least])
    able = sorted((r for r in found if r[4]), key=lambda r: (-r[3], math.inf if r[0] is None else r[0], r[2], r[1]))
    rank = {id(r): k for k, r in enumerate(able[: share * len(able) // 100], 1)}
    return sorted(((*r[:4], rank.get(id(r))) for r in found), key=repr)


def found(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize("length", [0, 1, 5, 255, 256, 257, 70_000, 16_777_216 + 300])
def test_shift_cancels_the_prefix(length):
    head, tail = b"some prefix", (b"abc\xff" * (length // 4 + 1))[:length]
    left = resample.shift(np.array([zlib.crc32(head)], np.uint32), np.array([length]))
    assert zlib.crc32(head + tail) ^ int(left[0]) == zlib.crc32(tail)


@pytest.mark.parametrize("segment", [1, 7, 1 << 20])
def test_features_equal_crcs_of_the_runs(monkeypatch, segment):
    monkeypatch.setattr(resample, "_SEGMENT", segment)
    for text in ("", " \n", "One", "The CAT sat, on\tthe été-mat 中文 x9", "a" * 700 + " b " * 300 + "ÀÉ" * 200, "\x00x\x7fy\x80z"):
        for n in (1, 2, 4):
            words, expected = plain_features(text, n)
            count, counts = resample.features(text, n)
            assert count == len(words) and (counts == np.bincount(np.array(expected, int), minlength=10_000)).all()


def test_query_equals_brute_force(spark):
    docs, items = table(spark, TESTDATA, "documents").collect(), table(spark, TESTDATA, "benchmark").collect()
    expected = plain([(r.doc_id, r.text) for r in docs], [r.text for r in items])
    assert found(queries.op12_importance_resampling(spark, TESTDATA)) == expected
    assert sum(r[4] is not None for r in expected) > 10


def test_nulls_ties_repeats_and_long_texts(spark):
    long = " ".join(f"w{k % 977}" for k in range(400_000))
    same = [(5, "x " * 30), (5, "x " * 30), (5, "y " * 30), (None, "x " * 25), (None, None)]
    docs = [(1, None), (2, ""), (3, "!?"), (4, long), (6, "a b " * 10), *same, *[(k, f"word{k % 3} " * 22) for k in range(10, 60)]]
    frame = spark.createDataFrame([(*d, "x", "y") for d in docs], DOCS)
    items = spark.createDataFrame([(1, "x x x"), (2, None), (None, "word1 word1")], ITEMS)
    expected = plain(docs, ["x x x", None, "word1 word1"])
    assert found(resample.resample(frame, items)) == expected
    drawn = resample.drawn_documents(frame, items)
    assert drawn.columns == frame.columns
    assert {r.doc_id for r in drawn.collect()} == {r[0] for r in expected if r[4] and r[0] is not None}


def test_empty_tables(spark):
    frame, items = spark.createDataFrame([(k, "a b " * 20, "", "") for k in range(8)], DOCS), spark.createDataFrame([], ITEMS)
    assert resample.resample(frame.limit(0), items).count() == 0
    assert found(resample.resample(frame, items)) == plain([(k, "a b " * 20) for k in range(8)], [])
