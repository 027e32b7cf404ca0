import zlib

import numpy as np
import pytest

from coverloom.llm import quality

from conftest import TESTDATA

DOCS = "doc_id bigint, text string, quality_score string, c0 string"


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_chunks_cover_the_whole_text():
    for size in (0, 1, quality.CHUNK, quality.CHUNK + 1, 5 * quality.CHUNK + 17):
        octets = np.random.default_rng(size).integers(97, 123, size, dtype=np.uint8)
        chunks = quality.chunks_of(octets.tobytes().decode())
        if size <= quality.CHUNK:
            assert len(chunks) == 1 and (chunks[0, :size] == octets).all() and (chunks[0, size:] == quality.PAD).all()
            continue
        starts = [*range(0, size - quality.CHUNK, quality.CHUNK - quality.OVERLAP), size - quality.CHUNK]
        assert len(chunks) == len(starts) and all((c == octets[s : s + quality.CHUNK]).all() for c, s in zip(chunks, starts, strict=True))


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    chunks, owner, label = rng.integers(90, 120, (3, quality.CHUNK)).astype(np.int16), np.array([0, 0, 1]), np.array([1.0, 0.0], np.float32)
    net = quality.ByteNet(3)

    def loss():
        odds = np.bincount(owner, net.chunk_scores(net.pooled(chunks)[0])) / np.bincount(owner)
        p, weight = 1 / (1 + np.exp(-odds.astype(float))), np.where(label > 0, 1, quality.REJECT_WEIGHT)
        return float((-(label * np.log(p) + (1 - label) * np.log(1 - p)) * weight).sum() / weight.sum())

    for weights, gradient in zip(net.weights(), net.gradients(chunks, owner, label), strict=True):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        before, step = weights[at], 1e-3
        weights[at] = before + step
        up = loss()
        weights[at] = before - step
        down = loss()
        weights[at] = before
        assert gradient[at] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=1e-4)


def test_learns_labels_without_the_held_out_fold(spark):
    pick = np.random.default_rng(5)
    def prose(): return " ".join("".join(pick.choice(list("aeiourstln"), 5)) for _ in range(int(pick.integers(5, 200))))
    def junk(): return " ".join("".join(pick.choice(list("AEIOURST"), 5)) + "!!" for _ in range(int(pick.integers(5, 200))))
    texts = {k: (junk() if k % 5 == 0 else prose()) for k in range(400)}
    docs = spark.createDataFrame([*[(k, t, "z", "y") for k, t in texts.items()], (None, "x", "z", "y"), (400, None, "z", "y"), (401, "", "z", "y")], DOCS)
    # Labels of the held-out fold are all wrong: learning from them would show.
    labels = [(k, int((k % 5 != 0) ^ held_out(k)), 0) for k in texts] + [(None, 1, 0), (3, None, 0), (9000, 1, 0)]
    found = quality.quality_scores(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    assert len(found) == 403 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    assert all(r.held_out == held_out(r.doc_id if r.doc_id is not None else "") for r in found)
    right = [r.predicted == int(r.doc_id % 5 != 0) for r in found if r.doc_id in texts and r.held_out]
    assert len(right) > 50 and np.mean(right) > 0.95
    kept = quality.score_quality(docs, 0.25)
    assert kept.columns == ["doc_id", "text", "c0", "quality_score"]


def test_a_byte_in_front_moves_no_score_far(spark):
    docs = [r.text or "" for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").orderBy("doc_id").collect()]
    net = quality.fit(spark.read.parquet(f"{TESTDATA}/documents.parquet"), spark.read.parquet(f"{TESTDATA}/labels.parquet"))
    plain, moved = quality.score_texts(net, docs), quality.score_texts(net, [" " + d for d in docs])
    assert np.abs(plain - moved).max() < 0.2 and np.quantile(np.abs(plain - moved), 0.9) < 0.02


def test_every_part_of_a_long_text_teaches():
    """What tells the labels apart stands in one chunk of a hundred."""
    rng = np.random.default_rng(8)
    def text(mark): return "".join(rng.choice(list("abcdefgh "), 480 * 40)) + mark * 60 + "".join(rng.choice(list("abcdefgh "), 480 * 5))
    labels = np.array([k % 2 for k in range(60)], np.float32)
    chunks = [quality.chunks_of(text("#$%&@!" if k else "")) for k in labels]
    seen = set()
    real = quality.ByteNet.gradients
    def watch(self, drawn, owner, label):
        seen.update(c.tobytes() for c in drawn)
        return real(self, drawn, owner, label)
    quality.ByteNet.gradients = watch
    try:
        quality.train(chunks, labels)
    finally:
        quality.ByteNet.gradients = real
    assert len(seen) > 0.99 * len({c.tobytes() for x in chunks for c in x})


def test_repeated_ids_and_very_long_texts(spark):
    docs = spark.createDataFrame([(2, "b" * 600, "", ""), (2, "a" * 600, "", ""), (3, "x " * 2_000_000, "", ""), (3, "x " * 2_000_000, "", "")], DOCS)
    chunks, labels = quality.training_sample(docs, spark.createDataFrame([(2, 1), (2, 1)], "doc_id bigint, quality int"))
    assert len(chunks) == 1 and (chunks[0] == ord("a")).all() and labels.tolist() == [1]
    scores = [r.quality_score for r in quality.score_quality(docs.filter("doc_id = 3"), quality.ByteNet()).collect()]
    assert scores[0] == scores[1]


def test_without_usable_labels(spark):
    docs = spark.createDataFrame([(1, "a", "", "")], DOCS)
    labels = "doc_id bigint, quality int"
    assert quality.quality_scores(docs, spark.createDataFrame([], labels)).first().score == 0.5
    one = [(k, 1) for k in range(2, 9)]
    assert quality.fit(docs, spark.createDataFrame([(1, 1)], labels)) in (0.5, 1.0)
    assert quality.fit(spark.createDataFrame([(k, "b", "", "") for k, _ in one], DOCS), spark.createDataFrame(one, labels)) == 1.0
    assert quality.quality_scores(docs.limit(0), spark.createDataFrame([], labels)).count() == 0
