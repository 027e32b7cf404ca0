import numpy as np
import pytest

from coverloom.llm import grid_join, queries

from conftest import TESTDATA

SCHEMA = "vec_id bigint, embedding array<float>, node string, vector string"


def plain(vectors):
    """Links and components from all cosines."""
    able = [k for k, (_, v) in enumerate(vectors) if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    near = {k: set() for k in range(len(vectors))}
    for length in {len(vectors[k][1]) for k in able}:
        mine = [k for k in able if len(vectors[k][1]) == length]
        x = np.array([vectors[k][1] for k in mine], np.float32).astype(float)
        x /= np.sqrt((x * x).sum(1, keepdims=True))
        for i, j in zip(*np.nonzero(np.triu(x @ x.T >= 0.9, 1)), strict=True):
            near[mine[i]].add(mine[j])
            near[mine[j]].add(mine[i])
    found, seen = [None] * len(vectors), set()
    for k in near:
        if k in seen:
            continue
        group, open_ = {k}, [k]
        while open_:
            for other in near[open_.pop()] - group:
                group.add(other)
                open_.append(other)
        seen |= group
        least = min((vectors[g][0] for g in group if vectors[g][0] is not None), default=None)
        for g in group:
            found[g] = (vectors[g][0], len(near[g]), least, vectors[g][0] is not None and vectors[g][0] == least)
    return sorted(found, key=repr)


def run(spark, vectors):
    frame = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", "y") for i, v in vectors], SCHEMA)
    found = grid_join.near_groups(frame)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_equals_all_pairs(spark, monkeypatch, spread):
    monkeypatch.setattr(grid_join, "BLOCK_ROWS", 40)
    monkeypatch.setattr(grid_join, "LEAF_ROWS", 8)
    monkeypatch.setattr(grid_join, "FAN_OUT", 3)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(25, 12)) * np.linspace(2, 0.1, 12)
    near = [centres[k % 25] + spread * 0.5 * rng.normal(size=12) * np.linalg.norm(centres[k % 25]) / 3 for k in range(500)]
    copies = [near[3]] * 70 + [2 * near[5], near[9] * 0.125]
    vectors = [(int(i), v.astype(np.float32)) for i, v in zip(rng.permutation(len(near) + len(copies)), [*near, *copies], strict=True)]
    assert run(spark, vectors) == plain(vectors)


def test_table_equals_all_pairs(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{TESTDATA}/embeddings.parquet").collect()]
    found = sorted((tuple(r) for r in queries.op11_embedding_near_dedup(spark, TESTDATA).collect()), key=repr)
    assert found == plain(rows)


def test_odd_vectors(spark):
    vectors = [
        (1, None), (2, [0.0] * 3), (3, [1.0, None, 0.0]), (4, [float("nan"), 1.0, 0.0]), (5, [float("inf"), 0.0, 0.0]), (6, []),
        (7, [1.0, 0.0, 0.0]), (8, [3e30, 0.0, 0.0]), (9, [1e-30, 0.0, 0.0]), (10, [1.0, 0.0]), (10, [1.0, 0.0]), (11, [0.9, 0.0]), (12, [-1.0, 0.0, 0.0]),
        (None, [0.0, 1.0, 0.0]), (None, [0.0, 1.0, 0.01]), (None, None), (13, [1.0, 0.0, 0.1]), (7, [0.0, 0.0, 1.0]),
    ]
    assert run(spark, vectors) == plain(vectors)


def test_limit_is_exact(spark):
    vectors = [(1, [3.0, 4.0]), (2, [4.0, 3.0]), (3, [1.0, 0.0]), (4, [9.0, np.sqrt(19.0) * (1 + 1e-6)]), (5, [9.0, np.sqrt(19.0) * (1 - 1e-6)])]
    assert run(spark, vectors) == plain(vectors)


def test_distant_intervals_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(grid_join, "BLOCK_ROWS", 10)
    monkeypatch.setattr(grid_join, "FAN_OUT", 2)
    rng = np.random.default_rng(6)
    vectors = [(k, np.eye(6)[k % 6] + 0.01 * rng.normal(size=6)) for k in range(600)]
    frame = spark.createDataFrame([(i, v.astype(np.float32).tolist(), "", "") for i, v in vectors], SCHEMA)
    eps = np.sqrt(0.2)
    _, distinct = grid_join.distinct_vectors(frame, "vec_id", "embedding")
    fitted = grid_join.fit_basis(distinct)
    blocks = grid_join.packed_blocks(grid_join.sequence(distinct, fitted, eps), fitted)
    n, pairs = blocks.count(), grid_join.block_pairs(blocks, eps).count()
    assert n == 60 and pairs < 0.25 * n * (n + 1) / 2


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == [(1, 0, 1, True)]
