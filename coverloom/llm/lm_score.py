"""Language-model scores: cross-entropy difference of two matched n-gram models.

Both models are word bigram models of the same
smoothing and vocabulary: the lower-cased words and signs of the whole corpus (single
characters in scripts without spaces), and one mark for the borders of a text. The background
model counts all documents, the target model the documents labelled good. A word w after u has
the probability (count(u w) + ``ADDED``) / (count(u) + ``ADDED`` * vocabulary). A document's
score is the mean over its words and closing mark of the target loss minus the background
loss, in nats: the lower, the more it reads like the target.

Documents are dealt into groups of a bounded size. A group's distinct bigrams and words with their
counts, sorted and cut into spans of hashes, are one packed row per span; the rows of a span add
up to both models there, a distributed table, and each row gets the sums of its n-grams back, in
its order. A group reads its texts again and scores them by what its spans returned. So
an n-gram moves once per group, at five to six bytes, and not once per document that holds it. The
number of distinct words reaches the driver. N-grams are 64-bit hashes.

Defined results: a null or empty text is one closing mark and is scored by it; labels other
than 0 and 1, null ids and documents labelled both ways make no target; a null id is scored as any
other; with no target text the target model is the even share; repeated rows count as often as they occur and get equal
scores; an empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.llm.common import settle, ship, text_of
from coverloom.llm.hashing import BY_SPACE, mix, signed, word_hashes, words_and_signs

# What every bigram of the vocabulary counts besides its occurrences.
ADDED = 0.1
# Bytes of text in a group of documents, about, and groups whose n-grams are as many as a span's.
GROUP_BYTES = 8 << 20
GROUPS_A_SPAN = 2
_EDGE = np.uint64(0x5851F42D4C957F2D)


def good_documents(labels: DataFrame) -> DataFrame:
    agreed = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return agreed.filter("quality = 1").select("doc_id")


def pack(values: np.ndarray) -> bytes:
    """Unsigned 64-bit integers as compressed byte planes; planes above the largest are left out."""
    width = -(-int(values.max(initial=0)).bit_length() // 8)
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return struct.pack("<QB", len(values), width) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(packed: bytes) -> np.ndarray:
    n, width = struct.unpack_from("<QB", packed)
    octets = np.zeros((n, 8), np.uint8)
    octets[:, :width] = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[9:]), np.uint8).reshape(width, n).T
    return octets.view("<u8").reshape(-1)


def word_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bigram and first word of every word and closing mark of the texts in a row, and where
    each text begins (one more at the end). Bigrams are even, their first words odd numbers."""
    words, at = word_hashes([words_and_signs(t) for t in texts], BY_SPACE)
    edged = np.insert(words, at, _EDGE)  # a mark before each text, the last one's end included
    first, second = edged[:-1], edged[1:]
    pairs = mix(first * np.uint64(0x9E3779B97F4A7C15) + mix(second)) & ~np.uint64(1)
    return pairs, first | np.uint64(1), at + np.arange(len(at))


def _span_cuts(grams: np.ndarray, spans: int) -> np.ndarray:
    """Where each span of sorted n-grams begins, and the end."""
    return np.searchsorted((grams >> np.uint64(32)) * np.uint64(spans) >> np.uint64(32), np.arange(spans + 1, dtype=np.uint64))


def _rows_and_good(docs: DataFrame, good: DataFrame, groups: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, text, row and grp of all documents; good_row and good_grp of those in ``good``.
    ``row`` is a key of id and text."""
    given = docs.select("doc_id", text_of().alias("text")).withColumn("row", F.xxhash64("doc_id", F.col("doc_id").isNull(), "text"))
    dealt = given.withColumn("grp", F.pmod("row", F.lit(groups)).cast("int"))
    wanted = dealt.select("doc_id", "row", "grp").join(good.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")
    return dealt, wanted.select(F.col("row").alias("good_row"), F.col("grp").alias("good_grp")).distinct()


def _count(spans: int):
    def run(docs: pa.Table, good: pa.Table) -> pa.Table:
        pairs, first, at = word_grams(docs["text"].to_pylist())
        wanted = np.repeat(np.isin(docs["row"].to_numpy(), good["good_row"].to_numpy()), np.diff(at))
        grams, n = np.unique(np.concatenate([pairs, first]), return_counts=True)
        wanted_n = np.zeros(len(grams), np.int64)
        found, found_n = np.unique(np.concatenate([pairs[wanted], first[wanted]]), return_counts=True)
        wanted_n[np.searchsorted(grams, found)] = found_n
        cuts, grp = _span_cuts(grams, spans), docs["grp"][0].as_py() if len(docs) else 0
        parts = [(k, slice(lo, hi)) for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if lo < hi]
        return pa.table({
            "span": pa.array([k for k, _ in parts], pa.int32()), "grp": pa.array([grp] * len(parts), pa.int32()),
            "grams": pa.array([pack(np.diff(grams[p], prepend=np.uint64(0))) for _, p in parts], pa.binary()),
            "n": pa.array([pack(n[p]) for _, p in parts], pa.binary()), "wanted": pa.array([pack(wanted_n[p]) for _, p in parts], pa.binary()),
        })

    return run


def group_grams(docs: DataFrame, good: DataFrame, groups: int, spans: int) -> DataFrame:
    """span, grp, grams, n, wanted: the sorted n-grams of a group of documents in a span, their
    counts there and those in the documents of ``good``, packed."""
    given, wanted = _rows_and_good(docs, good, groups)
    return given.groupBy("grp").cogroup(wanted.groupBy("good_grp")).applyInArrow(_count(spans), "span int, grp int, grams binary, n binary, wanted binary")


def _unpacked_grams(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed), dtype=np.uint64)


def _add(rows: pa.Table) -> pa.Table:
    """The sums of a span's n-grams, for each row in its order; the first row has the span's
    number of distinct words."""
    blocks = [_unpacked_grams(b) for b in rows["grams"].to_pylist()]
    cuts = np.cumsum([0, *map(len, blocks)])
    grams, place = np.unique(np.concatenate(blocks), return_inverse=True)
    words = int((grams & np.uint64(1)).sum())
    del blocks, grams
    found = {"span": rows["span"], "grp": rows["grp"], "words": pa.array([words, *[0] * (len(rows) - 1)], pa.int64())}
    for name in ("n", "wanted"):
        counts = np.concatenate([unpack(b) for b in rows[name].to_pylist()])
        sums = np.bincount(place, weights=counts).astype(np.int64)  # exact below 2**53
        found[name] = pa.array([pack(sums[place[lo:hi]]) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())
    return pa.table(found)


def document_grams(docs: DataFrame, good: DataFrame) -> DataFrame:
    """gram, grp, n, wanted: the distinct n-grams of every group of documents, a row each."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grp, grams, n, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                grams = signed(_unpacked_grams(grams))
                columns = [grams, np.full(len(grams), grp, np.int32), signed(unpack(n)), signed(unpack(wanted))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "grp", "n", "wanted"])

    packed = group_grams(docs, good, *_dealing(docs))
    return packed.select("grp", "grams", "n", "wanted").mapInArrow(run, "gram bigint, grp int, n bigint, wanted bigint")


def _dealing(docs: DataFrame) -> tuple[int, int]:
    """Groups and spans: as many as the texts' bytes ask for, and some for every task."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(-(-size // GROUP_BYTES), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return groups, -(-groups // GROUPS_A_SPAN)


def _score(size: int):
    def run(docs: pa.Table, sums: pa.Table) -> pa.Table:
        pairs, first, at = word_grams(docs["text"].to_pylist())
        grams, place = np.unique(np.concatenate([pairs, first]), return_inverse=True)
        losses, sums = [], sums.sort_by("span")
        for name in ("wanted", "n"):
            counts = np.concatenate([np.empty(0, np.uint64), *map(unpack, sums[name].to_pylist())])
            if len(counts) != len(grams):
                raise ValueError("the documents have changed while they were scored")
            two, one = np.log(counts + ADDED), np.log(counts + ADDED * size)
            loss = one[place[len(pairs) :]] - two[place[: len(pairs)]]
            losses.append(np.add.reduceat(loss, at[:-1]) / np.diff(at) if len(docs) else np.empty(0))
        target, background = losses
        return pa.table({
            "doc_id": docs["doc_id"], "n_tokens": pa.array(np.diff(at), pa.int64()),
            "target_loss": target, "background_loss": background, "loss_difference": target - background,
        })

    return run


def score_words(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, loss_difference of every document."""
    ship(docs.sparkSession)
    groups, spans = _dealing(docs)
    good = good_documents(labels)
    sums = group_grams(docs, good, groups, spans).groupBy("span").applyInArrow(_add, "span int, grp int, words bigint, n binary, wanted binary")
    sums = settle(sums, "word-models")
    size = sums.agg(F.sum("words")).first()[0] or 0
    given, _ = _rows_and_good(docs, good, groups)
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, n_tokens bigint, target_loss double, background_loss double, loss_difference double"
    return given.groupBy("grp").cogroup(sums.groupBy("grp")).applyInArrow(_score(size), columns)
