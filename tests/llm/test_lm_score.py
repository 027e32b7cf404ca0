import math
from collections import Counter

import numpy as np
import pytest

from coverloom.llm import lm_score

DOCS, LABELS = "doc_id bigint, text string, gram string", "doc_id bigint, quality int"


def test_words_equal_plain_bigrams(spark):
    texts = ["The cat sat.", "the cat", "zzz qqq", "", None, "été 中文，字", "The cat sat.", "word " * 4000]
    cut = [["the", "cat", "sat", "."], ["the", "cat"], ["zzz", "qqq"], [], [], ["été", "中", "文", "，", "字"], ["the", "cat", "sat", "."], ["word"] * 4000]
    good = [1, 1, 0, 0, 0, 0, 0, 0, 1]
    ids, texts, cut = [0, 1, 2, 3, 4, 5, 6, 7, 0], [*texts, texts[0]], [*cut, cut[0]]  # a repeated row counts twice
    pairs = [list(zip(["^", *c], [*c, "^"], strict=True)) for c in cut]
    size = len({w for p in pairs for w, _ in p})
    models = []
    for wanted in (good, [1] * 9):
        two = Counter(g for p, w in zip(pairs, wanted, strict=True) if w for g in p)
        one = Counter(g[0] for p, w in zip(pairs, wanted, strict=True) if w for g in p)
        models.append(lambda g, one=one, two=two: -math.log((two[g] + lm_score.ADDED) / (one[g[0]] + lm_score.ADDED * size)))
    expected = sorted((i, len(p), *(sum(map(f, p)) / len(p) for f in models)) for i, p in zip(ids, pairs, strict=True))
    docs = spark.createDataFrame([(i, t, "x") for i, t in zip(ids, texts, strict=True)], DOCS)
    labels = [(0, 1), (1, 1), (2, 0), (5, 1), (5, 0), (6, None), (None, 1), (99, 1)]
    found = sorted(tuple(r)[:4] for r in lm_score.score_words(docs, spark.createDataFrame(labels, LABELS)).collect())
    assert [f[:2] for f in found] == [e[:2] for e in expected]
    assert all(f[2:] == pytest.approx(e[2:]) for f, e in zip(found, expected, strict=True))
    row = lm_score.score_words(docs.filter("doc_id = 1"), spark.createDataFrame([], LABELS)).first()
    assert row.target_loss == pytest.approx(math.log(3))  # the, cat and the mark, in even shares
    assert lm_score.score_words(docs.limit(0), spark.createDataFrame([], LABELS)).count() == 0


def test_word_models_grow_with_the_corpus(spark):
    docs = spark.createDataFrame([(k, " ".join(f"w{k}x{j}" for j in range(50)), "") for k in range(40)], DOCS)
    labels = spark.createDataFrame([(1, 1)], LABELS)
    small, large = (lm_score.document_grams(docs.filter(f"doc_id < {n}"), lm_score.good_documents(labels)).select("gram").distinct().count() for n in (10, 40))
    assert large > 3.9 * small


def test_null_ids_clash_with_no_one(spark):
    docs = spark.createDataFrame([(None, "a b", "x"), (None, "c", "x"), (1, None, "x")], DOCS)
    found = lm_score.score_words(docs, spark.createDataFrame([(None, 1)], LABELS)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in found) == [(0, 2), (0, 3), (1, 1)]


def test_ngrams_move_once_per_group_and_packed(spark):
    docs = spark.createDataFrame([(k, " ".join(f"w{j}" for j in range(200)), "") for k in range(400)], DOCS)
    good = lm_score.good_documents(spark.createDataFrame([(1, 1)], LABELS))
    found = lm_score.document_grams(docs, good)
    assert found.select("gram").distinct().count() == 402  # 200 words and the mark, 201 bigrams
    assert found.count() <= 402 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    grams = np.sort(np.random.default_rng(1).integers(0, 1 << 64, 1 << 20, dtype=np.uint64))
    packed = lm_score.pack(np.diff(grams, prepend=np.uint64(0)))
    assert len(packed) < 6 * len(grams)
    for values in (grams, np.array([0, 1, (1 << 64) - 1], np.uint64), np.zeros(3, np.int64), np.empty(0, np.uint64)):
        assert (lm_score.unpack(lm_score.pack(values)) == values).all()
