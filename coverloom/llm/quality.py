"""A byte-level convolutional network in numpy that scores documents for quality.

A text is its UTF-8 bytes, cut into overlapping chunks that cover it whole. Learned filters,
each as wide as a few bytes, run over every chunk; the largest answer of each filter in a
chunk (max-pooling) goes through a small hidden layer into one chunk score; the mean chunk
score of a document is its log-odds. Filters are kept as one weight per place and byte value,
so a filter's answer is a sum of table rows and no byte is ever expanded into a vector.

Training reads a bounded sample of labelled documents: at most ``TRAIN_ROWS`` of them, the
first in the order of a hash of their id, with their whole texts. A step of stochastic gradient
descent draws documents and of each up to ``STEP_CHUNKS`` of all its chunks, anew every time, so
every part of a long text teaches and no document weighs more than another. Filters stand at
every byte, in training and in scoring, which reads every byte of every text.

Defined results: a null or empty text is one chunk of padding and gets a score like any other;
labels other than 0 and 1, null ids and documents labelled both ways teach nothing; of several
texts under one labelled id the smallest in byte order teaches; repeated rows get equal scores; with no usable label, or labels of one kind, the score is the share of
1 among them (0.5 with none); an empty table gives an empty result. Only doc_id and text of
the documents are read, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.llm.common import id_text, ship, text_of

TRAIN_ROWS = 8_000
# Chunks of one document that one step learns from, drawn from all of them.
STEP_CHUNKS = 3
KEEP_FROM = 0.3
# Rejected documents are the rarer kind; each counts this often in the loss.
REJECT_WEIGHT = 2.0
FOLDS = 5

CHUNK, OVERLAP = 512, 32
WIDTH, FILTERS, HIDDEN = 6, 32, 16
PAD = 256
_STEPS, _BATCH, _RATE = 300, 256, 0.005
_SPOTS = CHUNK - WIDTH + 1


def chunks_of(text: str) -> np.ndarray:
    """The chunks of a text as rows of byte values; the last one starts where it ends with
    the text, and short texts are padded."""
    octets = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if len(octets) <= CHUNK:
        only = np.full((1, CHUNK), PAD, np.int16)
        only[0, : len(octets)] = octets
        return only
    starts = np.arange(0, len(octets) - CHUNK, CHUNK - OVERLAP)
    starts = np.append(starts, len(octets) - CHUNK)
    return octets[starts[:, None] + np.arange(CHUNK)].astype(np.int16)


class ByteNet:
    """The network's weights; all of them are a few hundred kilobytes."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.filters = rng.normal(0, 0.3, (WIDTH, PAD + 1, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.hidden = rng.normal(0, FILTERS**-0.5, (FILTERS, HIDDEN)).astype(np.float32)
        self.hidden_bias = np.zeros(HIDDEN, np.float32)
        self.out = rng.normal(0, HIDDEN**-0.5, HIDDEN).astype(np.float32)
        self.out_bias = np.zeros(1, np.float32)

    def pooled(self, chunks: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """The largest answer of every filter in every chunk, and where it is."""
        best = np.empty((len(chunks), FILTERS), np.float32)
        where = np.empty((len(chunks), FILTERS), np.int64) if places else None
        for lo in range(0, len(chunks), 64):
            part = chunks[lo : lo + 64]
            answers = self.filters[0].take(part[:, :_SPOTS], axis=0)
            for j in range(1, WIDTH):
                answers += self.filters[j].take(part[:, j : j + _SPOTS], axis=0)
            if places:
                where[lo : lo + 64] = answers.argmax(axis=1)
            best[lo : lo + 64] = answers.max(axis=1)
        return best + self.bias, where

    def chunk_scores(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(np.maximum(pooled, 0) @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias

    def weights(self) -> list[np.ndarray]:
        return [self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def gradients(self, chunks: np.ndarray, owner: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        """Of the weighted mean log loss of the documents, whose chunks ``owner`` names."""
        docs = len(label)
        pooled, where = self.pooled(chunks, places=True)
        lit = np.maximum(pooled, 0)
        inner = np.maximum(lit @ self.hidden + self.hidden_bias, 0)
        count = np.bincount(owner, minlength=docs)
        odds = np.bincount(owner, inner @ self.out + self.out_bias, minlength=docs) / count
        weight = np.where(label > 0, 1, REJECT_WEIGHT)
        error = ((1 / (1 + np.exp(-odds)) - label) * weight / weight.sum())[owner] / count[owner]
        error = error.astype(np.float32)
        to_inner = error[:, None] * self.out * (inner > 0)
        to_pooled = (to_inner @ self.hidden.T) * (pooled > 0)
        steps = np.arange(FILTERS)
        filters = np.empty_like(self.filters)
        for j in range(WIDTH):
            byte = np.take_along_axis(chunks, where + j, axis=1).astype(np.int64)
            filters[j] = np.bincount((byte * FILTERS + steps).ravel(), to_pooled.ravel(), (PAD + 1) * FILTERS).reshape(PAD + 1, FILTERS)
        return [filters, to_pooled.sum(0), lit.T @ to_inner, to_inner.sum(0), inner.T @ error, error.sum(keepdims=True)]


def train(chunks: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> ByteNet | float:
    """Adam over shuffled batches of documents; the share of 1 if there is only one label."""
    if len(set(labels.tolist())) < 2:
        return float(labels.mean()) if len(labels) else 0.5
    rng, net = np.random.default_rng(seed), ByteNet(seed)
    first = [np.zeros_like(w) for w in net.weights()]
    second = [np.zeros_like(w) for w in net.weights()]
    size = min(_BATCH, max(32, len(labels) // 8))
    order = rng.permutation(len(labels))
    for step in range(1, _STEPS + 1):
        if len(order) < size:
            order = np.concatenate([order, rng.permutation(len(labels))])
        rows, order = order[:size], order[size:]
        rate = _RATE * (1 - step / _STEPS) + _RATE / 20
        drawn = [chunks[r] if len(chunks[r]) <= STEP_CHUNKS else chunks[r][rng.choice(len(chunks[r]), STEP_CHUNKS, replace=False)] for r in rows]
        owner = np.repeat(np.arange(len(rows)), list(map(len, drawn)))
        found = net.gradients(np.concatenate(drawn), owner, labels[rows])
        for w, g, m, v in zip(net.weights(), found, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def score_texts(net: ByteNet | float, texts: list[str | None]) -> np.ndarray:
    if isinstance(net, float):
        return np.full(len(texts), net)
    scores, held, owner = np.empty(len(texts)), [], []
    sums, counts = np.zeros(len(texts)), np.zeros(len(texts))

    def flush() -> None:
        if held:
            found = net.chunk_scores(net.pooled(np.concatenate(held))[0])
            np.add.at(sums, np.concatenate(owner), found)
            held.clear()
            owner.clear()

    for k, text in enumerate(texts):
        chunks = chunks_of(text or "")
        counts[k] = len(chunks)
        for lo in range(0, len(chunks), 4096):
            held.append(chunks[lo : lo + 4096])
            owner.append(np.full(len(held[-1]), k))
            if sum(map(len, held)) >= 4096:
                flush()
    flush()
    scores[:] = 1 / (1 + np.exp(-sums / counts))
    return scores


# ---- on Spark ------------------------------------------------------------------------


def _fold(column: str = "doc_id"):
    return F.crc32(id_text(column).cast("binary")) % FOLDS


def training_sample(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> tuple[list[np.ndarray], np.ndarray]:
    """Chunks and labels of the sample, without the held-out fold. What reaches the driver are the
    texts of at most ``most`` documents."""
    agreed = (
        labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).filter("quality = other")
    )
    picked = agreed.filter(_fold() != 0).select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = (
        docs.select("doc_id", text_of().alias("text")).join(F.broadcast(picked), "doc_id")
        .groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    )
    rows = sorted(texts.select("doc_id", F.col("quality").cast("int").alias("quality"), "text").toLocalIterator())
    return [chunks_of(r.text) for r in rows], np.array([r.quality for r in rows], np.float32)


def score_quality(docs: DataFrame, net: ByteNet | float, keep: list[str] | None = None) -> DataFrame:
    """The named columns of ``docs`` (all, if none are named) and ``quality_score``, which takes
    the place of a column of that name."""
    columns = [c for c in (docs.columns if keep is None else keep) if c != "quality_score"]
    shared = ship(docs.sparkSession).sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.concatenate([score_texts(shared.value, batch.column(0).slice(lo, 512).to_pylist()) for lo in range(0, batch.num_rows, 512)]) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(scores)], names)

    inner = [f"c{k}" for k in range(len(columns))]  # any names, clashing ones included, pass through by place
    renamed = docs.select(text_of().alias("text"), *[F.col(f"`{c}`").alias(n) for c, n in zip(columns, inner, strict=True)])
    names = [*inner, "quality_score"]
    schema = ", ".join(f"{n} {t}" for n, t in [*renamed.dtypes[1:], ("quality_score", "double")])
    return renamed.mapInArrow(run, schema).toDF(*columns, "quality_score")


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> ByteNet | float:
    return train(*training_sample(docs, labels, most))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = score_quality(docs, fit(docs, labels), ["doc_id"])
    return scored.select(
        "doc_id", (_fold() == 0).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= KEEP_FROM).cast("int").alias("predicted"),
    )
