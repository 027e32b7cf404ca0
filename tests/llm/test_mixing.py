import re

import pytest

from coverloom.llm import mixing

SCHEMA = "doc_id bigint, text string, source string"


def docs(spark, rows, extra=""):
    return spark.createDataFrame(rows, SCHEMA + extra)


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight, stopped at the limit, the excess shared again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] > most * sizes[s]}
        if not over:
            target |= {s: share * weight[s] for s in open_}
            break
        target |= {s: float(most * sizes[s]) for s in over}
        left -= sum(most * sizes[s] for s in over)
        open_ -= over
    return target


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("rows_per_slice", [2, 5000])
def test_budgets_are_met_exactly(spark, rows_per_slice):
    given = [(k, "w " * (k % 7), ("a", "b", "c", None, "é", "")[k % 6] if k % 3 else "a") for k in range(120)]
    given += [(5, "w w w", "a")] * 3 + [(None, "x y", "b"), (None, None, "b"), (7, None, None)]
    found = mixing.plan_mix(docs(spark, given), rows_per_slice=rows_per_slice).collect()
    assert sorted((r.doc_id or -1, r.size) for r in found) == sorted((g[0] or -1, words(g[1])) for g in given)
    sizes, taken = {}, {}
    for _, text, source in given:
        sizes[source] = sizes.get(source, 0) + words(text)
    targets = plain_targets(sizes)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(taken[s] == int(targets[s] + 0.5) for s in sizes)
    again = mixing.plan_mix(docs(spark, given).repartition(3), rows_per_slice=rows_per_slice).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))


def test_empty_table_and_texts_without_words(spark):
    assert mixing.plan_mix(docs(spark, [])).count() == 0
    found = mixing.plan_mix(docs(spark, [(1, " \t", "a"), (2, None, None)])).collect()
    assert [(r.size, r.target, r.taken) for r in found] == [(0, 0.0, 0)] * 2


def test_mixed_documents_keep_all_columns_however_named(spark):
    given = [(k, "w w", "a" if k < 9 else "b", k, "x") for k in range(10)]
    frame = docs(spark, given, ", size int, mix_row string")
    mixed = mixing.mixed_documents(frame)
    assert mixed.columns == frame.columns
    times = {r.doc_id: r.taken / r.size for r in mixing.plan_mix(frame).collect()}
    kept = [r.doc_id for r in mixed.collect()]
    assert {k: kept.count(k) for k in set(kept)} == {k: -(-t // 1) for k, t in times.items() if t > 0}
    assert kept.count(9) == 3 and "Python" not in mixed._jdf.queryExecution().toString()
