"""Importance resampling towards a target, with n-gram features read off prefix CRCs.

A text is lower-cased (A-Z only) and its words are joined by one space. The normalised text is
scanned once: behind every word the running CRC-32 is stored. The CRC of a run of words that
begins at byte s and ends at byte e follows from the two prefixes alone. Appending n bytes to a
prefix multiplies its CRC by x**(8 n) modulo the CRC polynomial over GF(2), so
``crc(s..e) = crc(0..e) xor shift(crc(0..s), e - s)``: the shifted first prefix cancels. Shifts
are table look-ups, one table per length below 256 and one per power of 256 beyond.

Every document becomes its distinct buckets and how often each occurs, at most ``buckets``
entries however long it is. Counts of all documents and of all target texts are summed per task
and then by bucket; a bucket's gain is the floored, scaled log ratio of both smoothed shares, a
document's weight the floored mean gain of its features. A Gumbel number from a hash of the id
is added, and the documents with the highest sums are drawn: a sample without replacement in
which weights are log odds.

Ranks need no global sort: scores are whole numbers of a bounded range, so the documents above
each score are counted, and only documents of one score are put in order among themselves.

Defined results: a null or empty text, or one without words, has no features, weight 0, and
counts among the documents only if it has enough words; a null id hashes as an empty one and
comes last among ties; repeated rows are separate documents with equal scores, ranked next to
each other; an empty target leaves smoothed shares of nothing; an empty table gives an empty
result. Only the id and text columns are read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverloom.llm.common import id_text, settle, ship, text_of

BUCKETS = 10_000
MAX_WORDS = 2
SHARE_PERCENT = 25
MIN_WORDS = 20
SEED = 7
SCALE = 1000
_POLYNOMIAL = 0xEDB88320
# Lower case for A-Z, a space for every ASCII character that is no letter and no digit.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SEGMENT = 1 << 20


# ---- CRCs ----------------------------------------------------------------------------


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the CRC's, lowest power in the highest bit."""
    found = 0
    while a:
        if a & 0x80000000:
            found ^= b
        a = (a << 1) & 0xFFFFFFFF
        b = (b >> 1) ^ (_POLYNOMIAL if b & 1 else 0)
    return found


def _shift_table(power: int) -> np.ndarray:
    """What each byte of a CRC becomes when it is multiplied by ``power``: 4 x 256 words."""
    bits = [_times(1 << k, power) for k in range(32)]
    table = np.zeros((4, 256), np.uint32)
    for place in range(4):
        for k in range(8):
            table[place, 1 << k : 2 << k] = table[place, : 1 << k] ^ np.uint32(bits[8 * place + k])
    return table


@cache
def _shift_tables(level: int) -> np.ndarray:
    """Tables for shifts by 0 to 255 times 256**level bytes."""
    step = 0x00800000  # x**8: one byte
    for _ in range(8 * level):
        step = _times(step, step)
    tables, power = [], 0x80000000
    for _ in range(256):
        tables.append(_shift_table(power))
        power = _times(power, step)
    return np.stack(tables)


def shift(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The part of a prefix's CRC that is left in it after so many more bytes."""
    found = _look_up(crcs, (lengths & 255).astype(np.int64), 0)
    for level in range(1, 5):
        digit = (lengths >> (8 * level)) & 255
        far = np.flatnonzero(digit)
        if len(far):
            found[far] = _look_up(found[far], digit[far].astype(np.int64), level)
    return found


def _look_up(crcs: np.ndarray, digit: np.ndarray, level: int) -> np.ndarray:
    flat, at = _shift_tables(level).reshape(-1), digit * 1024
    found = flat[at + (crcs & 255)]
    for place in range(1, 4):
        found ^= flat[at + (256 * place) + ((crcs >> np.uint32(8 * place)) & np.uint32(255))]
    return found


class Prefixes(NamedTuple):
    """The running CRC before and behind every word, and where words begin and end."""

    before: np.ndarray
    behind: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def prefixes(words: list[bytes], crc: int = 0, at: int = 0) -> Prefixes:
    """One scan over normalised text that goes on from a prefix of ``at`` bytes with this CRC."""
    sizes, run, seen = np.fromiter(map(len, words), np.int64, len(words)), zlib.crc32, []
    for word in words:
        if at:
            crc = run(b" ", crc)
        seen.append(crc)
        crc = run(word, crc)
        seen.append(crc)
        at = 1
    both, ends = np.array(seen, np.uint32), np.cumsum(sizes + 1) - 1
    return Prefixes(both[0::2], both[1::2], ends - sizes, ends)


def run_crcs(p: Prefixes, n: int) -> np.ndarray:
    """CRC of every run of ``n`` words, joined by single spaces."""
    count = len(p.starts) - n + 1
    if count <= 0:
        return np.empty(0, np.uint32)
    return p.behind[n - 1 :] ^ shift(p.before[:count], p.ends[n - 1 :] - p.starts[:count])


def _segments(octets: bytes) -> Iterator[list[bytes]]:
    """The words of a normalised text, in lists of about a megabyte."""
    lo = 0
    while lo < len(octets):
        hi = octets.find(b" ", lo + _SEGMENT)
        hi = len(octets) if hi < 0 else hi
        yield octets[lo:hi].split()
        lo = hi


def features(text: str, max_words: int = MAX_WORDS, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """The words of a text, and how often its n-grams fall into each bucket."""
    counts, words, tail = np.zeros(buckets, np.int64), 0, None
    for part in _segments(text.encode("utf-8", "surrogatepass").translate(_NORMAL)):
        if not part:
            continue
        p = prefixes(part, int(tail.behind[-1]), 1) if tail is not None else prefixes(part)
        fresh, words = len(part), words + len(part)
        if tail is not None:  # runs that begin before the segment
            gap = int(tail.ends[-1]) + 1
            p = Prefixes(*(np.concatenate([a, b + np.asarray(add, b.dtype)]) for a, b, add in zip(tail, p, (0, 0, gap, gap), strict=True)))
        for n in range(1, max_words + 1):
            crcs = run_crcs(p, n)
            fresh_runs = crcs[max(len(crcs) - fresh, 0) :]
            counts += np.bincount(fresh_runs % np.uint32(buckets), minlength=buckets)
        keep = max(max_words - 1, 1)
        tail = Prefixes(*(x[-keep:] for x in p))
        tail = tail._replace(starts=tail.starts - tail.starts[0], ends=tail.ends - tail.starts[0])
    return words, counts


# ---- on Spark ------------------------------------------------------------------------


def document_features(docs: DataFrame, columns: list[Column], max_words: int, buckets: int) -> DataFrame:
    """The given columns, n_words, and the distinct buckets of each text with their counts."""
    ship(docs.sparkSession)
    given = docs.select(text_of().alias("text"), *columns)
    names = given.columns[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                n_words, at, n = [], [], []
                for text in part.column(0).to_pylist():
                    words, counts = features(text, max_words, buckets)
                    found = np.flatnonzero(counts)
                    n_words.append(words)
                    at.append(found)
                    n.append(counts[found])
                offsets = pa.array(np.cumsum([0, *map(len, at)]), pa.int32())
                lists = [
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x or [[]]), kind))
                    for x, kind in ((at, pa.int32()), (n, pa.int64()))
                ]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(n_words, pa.int64()), *lists], [*names, "n_words", "at", "n"])

    kinds = ", ".join(f"{n} {t}" for n, t in given.dtypes[1:])
    return given.mapInArrow(run, f"{kinds}, n_words bigint, at array<int>, n array<bigint>")


def bucket_counts(featured: DataFrame, buckets: int) -> np.ndarray:
    """Features of all rows per bucket: summed in every task, then by bucket; ``buckets`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            at, n = batch.column(0).flatten(), batch.column(1).flatten()
            np.add.at(total, np.asarray(at), np.asarray(n))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], ["bucket", "n"])

    found, summed = np.zeros(buckets, np.int64), featured.select("at", "n").mapInArrow(run, "bucket int, n bigint")
    for bucket, n in summed.groupBy("bucket").agg(F.sum("n")).collect():
        found[bucket] = n
    return found


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the ratio of smoothed shares) of every bucket."""
    size = len(corpus)
    whole, wanted = int(corpus.sum()) + size, int(target.sum()) + size
    ratio = [(int(t) + 1) * whole / ((int(s) + 1) * wanted) for s, t in zip(corpus, target, strict=True)]
    return np.array([math.floor(SCALE * math.log(r)) for r in ratio], np.int64)


def gumbel(seed: int) -> Column:
    """The id's Gumbel number, scaled and floored."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id_text()).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def weighted(featured: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight."""
    shared = featured.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n = batch.column(2), np.asarray(batch.column(3).flatten())
            edges = np.concatenate([[0], np.cumsum(np.asarray(at.value_lengths()))]).astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(n * shared.value[np.asarray(at.flatten())])]).astype(np.int64)
            counts = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
            total, count = sums[edges[1:]] - sums[edges[:-1]], counts[edges[1:]] - counts[edges[:-1]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(count), pa.array(total // np.maximum(count, 1))], ["doc_id", "n_words", "n_features", "weight"]
            )

    kind = dict(featured.dtypes)["doc_id"]
    return featured.select("doc_id", "n_words", "at", "n").mapInArrow(run, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def resample(
    docs: DataFrame, target: DataFrame, share_percent: int = SHARE_PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
    max_words: int = MAX_WORDS, buckets: int = BUCKETS,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null if not drawn) of every document."""
    featured = settle(document_features(docs, [F.col("doc_id")], max_words, buckets), "resample-features")
    wanted = bucket_counts(document_features(target, [F.lit(0).alias("one")], max_words, buckets), buckets)
    found = weighted(featured, gains(bucket_counts(featured, buckets), wanted))
    scored = settle(found.withColumn("score", F.col("weight") + gumbel(seed)), "resample-scores")
    # One row per whole number between the lowest and the highest score.
    able = scored.filter(F.col("n_words") >= min_words)
    totals = able.groupBy("score").agg(F.count("*").alias("here"))
    above = totals.select("score", (F.sum("here").over(Window.orderBy(F.desc("score"))) - F.col("here")).alias("above"))
    most = share_percent * able.count() // 100
    # Only documents of scores that reach into the draw are put in order.
    reached = above.filter(F.col("above") < most)
    order = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "weight", "n_features")
    ranked = (
        able.join(reached, "score").withColumn("rank", F.col("above") + F.row_number().over(order))
        .withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")))
    )
    parts = ["doc_id", "n_features", "weight", "score", "rank"]
    rest = scored.join(reached.select("score", F.lit(True).alias("reached")), "score", "left")
    rest = rest.filter(F.col("reached").isNull() | (F.col("n_words") < min_words)).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*parts).unionByName(rest.select(*parts))


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of drawn ids with all their columns."""
    ranks = resample(docs, target, **options).filter(F.col("rank").isNotNull()).select("doc_id").distinct()
    return docs.join(ranks, "doc_id", "left_semi")
