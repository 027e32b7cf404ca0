import numpy as np
import pytest

from coverloom.llm import ann, queries

from conftest import TESTDATA

SCHEMA = "vec_id bigint, embedding array<float>, cell string, vector string"


def brute(vectors, step, k):
    found = {}
    for one in {i for i, _ in vectors if i % step == 0}:
        query = next(v for i, v in vectors if i == one)
        scored = sorted((-float((query * v).sum()), i) for i, v in vectors if i != one)
        found[one] = [(i, -s) for s, i in scored[:k]]
    return found


def test_walk_passes_pairs_by_falling_sum():
    rng = np.random.default_rng(2)
    left, right, sizes = rng.normal(size=7), rng.normal(size=5), rng.integers(0, 3, (7, 5))
    every = ann.walk(left, right, sizes, 10**9)
    assert set(every) == {(i, j) for i in range(7) for j in range(5) if sizes[i, j]}
    sums = [left[i] + right[j] for i, j in every]
    assert sums == sorted(sums, reverse=True)
    some = ann.walk(left, right, sizes, 6)
    assert some == every[: len(some)] and sum(sizes[p] for p in some) >= 6 > sum(sizes[p] for p in some[:-1])


@pytest.mark.parametrize("share", [0.75, 1.0])
def test_recall_against_brute_force(spark, share):
    rng = np.random.default_rng(1)
    vectors = [(i, (v / np.linalg.norm(v)).astype(np.float32).astype(float)) for i, v in enumerate(rng.normal(size=(400, 16)))]
    frame = spark.createDataFrame([(i, v.tolist(), "x", "y") for i, v in vectors], SCHEMA)
    found = {}
    for r in ann.search(frame, k=5, share=share).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    expected = brute(vectors, 20, 5)
    assert set(found) == set(expected) and all(len(f) == 5 for f in found.values())
    hits = np.mean([len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) / 5 for q in expected])
    assert hits >= 0.9
    if share == 1.0:
        assert all([i for i, _ in found[q]] == [i for i, _ in expected[q]] for q in expected)
        assert all(abs(s - t) < 1e-12 for q in expected for (_, s), (_, t) in zip(found[q], expected[q], strict=True))


def test_ties_copies_and_vectors_that_take_no_part(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 8)  # one vector's copies lie in many blocks
    same = [(i, [1.0, 0.0, 0.5, 0.0]) for i in range(60)]
    odd = [(100, None), (101, [0.0] * 4), (102, [1.0, None, 0.0, 0.0]), (103, [float("nan"), 1.0, 0.0, 0.0]), (104, [float("inf"), 0.0, 0.0, 0.0]),
           (105, [1.0, 2.0]), (None, [1.0, 0.0, 0.0, 0.0]), (0, [1.0, 0.0, 0.5, 0.0])]
    frame = spark.createDataFrame([(i, v, "", "") for i, v in [*same, *odd]], SCHEMA)
    found = ann.search(frame, k=4).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in found] == [
        *[(0, n, i, 1.25) for n, i in enumerate((1, 2, 3, 4), 1)],
        *[(20, n, i, 1.25) for n, i in enumerate((0, 0, 1, 2), 1)],
        *[(40, n, i, 1.25) for n, i in enumerate((0, 0, 1, 2), 1)],
    ]


def test_queries_are_dealt_out_too(spark, monkeypatch):
    rng = np.random.default_rng(9)
    vectors = [(i, rng.normal(size=6).astype(np.float32).astype(float)) for i in range(300)]
    frame = spark.createDataFrame([(i, v.tolist(), "", "") for i, v in vectors], SCHEMA)
    whole = sorted(map(tuple, ann.search(frame, k=4, step=3, share=1.0).collect()))
    monkeypatch.setattr(ann, "QUERY_ROWS", 7)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 11)
    assert sorted(map(tuple, ann.search(frame, k=4, step=3, share=1.0).collect())) == whole and len(whole) == 400


def test_few_rows_and_none(spark):
    assert ann.search(spark.createDataFrame([], SCHEMA)).count() == 0
    frame = spark.createDataFrame([(20, [1.0, 0.0], "", ""), (3, [0.5, 1.0], "", "")], SCHEMA)
    assert [tuple(r) for r in ann.search(frame).collect()] == [(20, 1, 3, 0.5)]


def test_repeated_query_id_cuts_no_neighbour(spark):
    rng = np.random.default_rng(3)
    near = [(i, (np.array([1.0, 0.0, 0.0, 0.0]) + rng.normal(size=4) * 0.1).tolist()) for i in range(1, 20)]
    frame = spark.createDataFrame([(i, v, "", "") for i, v in [*near, *[(0, [2.0, 0.0, 0.0, 0.0])] * 30]], SCHEMA)
    found = [r.vec_id for r in ann.search(frame, k=5, share=1.0, centroids=1).orderBy("rank").collect()]
    assert found == [i for i, v in sorted(near, key=lambda n: -2 * np.float32(n[1][0]))][:5]


def test_recall_of_the_query_on_the_table(spark):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{TESTDATA}/embeddings.parquet").collect() if r.vec_id is not None and r.embedding]
    found = {}
    for r in queries.op2_ann_multi_index(spark, TESTDATA).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    expected = brute(rows, ann.QUERY_STEP, ann.K)
    recall = np.mean([len(found[q] & {i for i, _ in near}) / len(near) for q, near in expected.items()])
    print("recall", len(rows), recall)
    assert recall >= 0.9
