"""Benchmark decontamination by greedy string tiling.

Texts are compared as lower-cased words without punctuation: white space and signs of all of
Unicode separate words, and in scripts without spaces every character is a word. Runs of
``SHORTEST`` words of the test items, or the whole of a shorter item, are the seeds. A fixed-size bit table of seed hashes (half a megabyte, however many
seeds there are) is sent to the executors; documents with a run in it become candidates, and a
join of their runs with the seeds gives the pairs of document and item. Each pair is tiled:
running Karp-Rabin finds the common runs of a length, the longest are marked first, marked
words are never used again, and the length falls until ``SHORTEST``. The share of an item's
words that is tiled does not depend on their order in the document, so shuffled passages
count. A document is contaminated by an item when that share reaches ``COVERAGE``.

Defined results: a null or empty text is clean; an item with fewer than ``SHORTEST`` words
contaminates the documents that hold all of it in a row, one without words none; items of equal words are one item under
their smallest id, items with a null id among them only if all have one; repeated document
rows are judged alike, each giving its row; ties between tiles go to the earlier place in the
item, then in the document; empty tables give an empty result. Only id and text columns are
read, so other columns may have any names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.llm.common import settle, ship, text_of
from coverloom.llm.hashing import BY_PUNCTUATION, plain_words, powers, signed, window_hashes, word_hashes

SHORTEST = 5
COVERAGE = 0.5
_FILTER_BITS = 22


# ---- greedy string tiling ------------------------------------------------------------


def _free_windows(words: np.ndarray, marked: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and Karp-Rabin values of the runs of ``size`` words without a marked one."""
    if len(words) < size:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    up, down = powers(len(words) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)])])
    taken = np.concatenate([[0], np.cumsum(marked)])
    starts = np.flatnonzero(taken[size:] == taken[:-size])
    return starts, (sums[starts + size] - sums[starts]) * down[starts]


def tile(item: np.ndarray, text: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """Tiles (place in item, place in text, length), longest first within each pass."""
    item_marked, text_marked = np.zeros(len(item), bool), np.zeros(len(text), bool)
    tiles: list[tuple[int, int, int]] = []
    size = max(shortest, min(len(item), len(text)) // 2)
    while True:
        starts, values = _free_windows(item, item_marked, size)
        at, found = _free_windows(text, text_marked, size)
        hit = np.isin(found, values)
        places: dict[int, list[int]] = {}
        for i, v in zip(starts.tolist(), values.tolist(), strict=True):
            places.setdefault(v, []).append(i)
        queue: list[tuple[int, int, int]] = []
        for j, v in zip(at[hit].tolist(), found[hit].tolist(), strict=True):
            for i in places[v]:
                if i and j and item[i - 1] == text[j - 1] and not item_marked[i - 1] and not text_marked[j - 1]:
                    continue  # part of a run that began earlier
                length = 0
                while (
                    i + length < len(item) and j + length < len(text) and item[i + length] == text[j + length]
                    and not item_marked[i + length] and not text_marked[j + length]
                ):
                    length += 1
                if length >= size:
                    queue.append((-length, i, j))
        heapq.heapify(queue)
        while queue:
            length, i, j = heapq.heappop(queue)
            length = -length
            free = ~(item_marked[i : i + length] | text_marked[j : j + length])
            if free.all():
                item_marked[i : i + length] = text_marked[j : j + length] = True
                tiles.append((i, j, length))
                continue
            # What is left of a run that a longer tile has cut into.
            edges = np.flatnonzero(np.diff(free.astype(np.int8), prepend=0, append=0))
            for lo, hi in zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True):
                if hi - lo >= size:
                    heapq.heappush(queue, (lo - hi, i + lo, j + lo))
        if size == shortest:
            return tiles
        size = max(shortest, size // 2)


# ---- on Spark ------------------------------------------------------------------------


def _items(benchmark: DataFrame, shortest: int) -> DataFrame:
    """item_id, words (hashes), seeds of every distinct item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, at = word_hashes([plain_words(t) for t in batch.column(1).to_pylist()], BY_PUNCTUATION)
            words = [signed(hashes[lo:hi]) for lo, hi in zip(at, at[1:], strict=False)]
            seeds = [signed(np.unique(window_hashes(w.view(np.uint64), min(shortest, len(w))))) if len(w) else w for w in words]
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, kind), pa.array(seeds, kind)], ["item_id", "words", "seeds"])

    given = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"))
    items = given.mapInArrow(run, "item_id bigint, words array<bigint>, seeds array<bigint>").filter(F.size("seeds") > 0)
    return items.groupBy("words", "seeds").agg(F.min("item_id").alias("item_id"))


def contaminated(docs: DataFrame, benchmark: DataFrame, shortest: int = SHORTEST, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, doc_text, item_id, coverage, n_tiles, longest_tile of every contaminated pair."""
    spark = ship(docs.sparkSession)
    items = settle(_items(benchmark, shortest).withColumn("item", F.xxhash64("words")), "tiling-items")
    slot = F.shiftrightunsigned("seed", 64 - _FILTER_BITS)
    seeds = items.select("item", F.explode("seeds").alias("seed"))
    sizes = sorted(r.size for r in items.select(F.least(F.size("words"), F.lit(shortest)).alias("size")).distinct().collect())
    bit = F.expr("shiftleft(1L, cast(slot % 64 as int))")
    # At most 2 ** 16 rows.
    cells = seeds.select(slot.alias("slot")).groupBy(F.expr("slot div 64").alias("cell")).agg(F.bit_or(bit).alias("bits")).collect()
    table = np.zeros(1 << (_FILTER_BITS - 6), np.int64)
    for cell, bits in cells:
        table[cell] = bits
    shared = spark.sparkContext.broadcast(np.unpackbits(table.view(np.uint8), bitorder="little"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        flags = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = part.column(1).to_pylist()
                words, at = word_hashes([plain_words(t) for t in texts], BY_PUNCTUATION)
                owners, values = [], []
                for size in sizes:
                    windows = window_hashes(words, size)
                    hits = np.flatnonzero(flags[(windows >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
                    owner = np.searchsorted(at, hits, side="right") - 1
                    inside = hits + size <= at[owner + 1]
                    owners.append(owner[inside])
                    values.append(windows[hits[inside]])
                if any(map(len, owners)):
                    owner, value = np.concatenate(owners), np.concatenate(values)
                    order = np.argsort(owner, kind="stable")
                    docs_hit, first = np.unique(owner[order], return_index=True)
                    runs = [signed(np.unique(v)) for v in np.split(value[order], first[1:])]
                    taken = part.take(pa.array(docs_hit))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row + lo + docs_hit), *taken.columns, pa.array(runs, pa.list_(pa.int64()))],
                        ["row", "doc_id", "doc_text", "seeds"],
                    )
            row += batch.num_rows

    candidates = settle(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
        .mapInArrow(find, "row bigint, doc_id bigint, doc_text string, seeds array<bigint>"),
        "tiling-candidates",
    )
    pairs = candidates.select("row", F.explode("seeds").alias("seed")).join(seeds, "seed").select("row", "item").distinct()
    per_doc = (
        pairs.join(items.select("item", "item_id", "words"), "item")
        .groupBy("row").agg(F.collect_list(F.struct("item_id", "words")).alias("items"))
    )
    tiled = candidates.select("row", "doc_id", "doc_text").join(per_doc, "row").select("doc_id", "doc_text", "items")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n, (doc_id, text, found) in enumerate(zip(*(c.to_pylist() for c in batch.columns), strict=True)):
                words, _ = word_hashes([plain_words(text)], BY_PUNCTUATION)
                for item in found:
                    asked = np.array(item["words"], np.int64).view(np.uint64)
                    tiles = tile(asked, words, min(shortest, len(asked)))
                    share = sum(t[2] for t in tiles) / len(asked)
                    if share >= (coverage if len(asked) >= shortest else 1):
                        out.append((n, doc_id, item["item_id"], share, len(tiles), max(t[2] for t in tiles)))
            if out:
                rows, doc_ids, item_ids, shares, counts, longest = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()), batch.column(1).take(pa.array(rows)), pa.array(item_ids, pa.int64()),
                        pa.array(shares, pa.float64()), pa.array(counts, pa.int64()), pa.array(longest, pa.int64()),
                    ],
                    ["doc_id", "doc_text", "item_id", "coverage", "n_tiles", "longest_tile"],
                )

    return tiled.mapInArrow(judge, "doc_id bigint, doc_text string, item_id bigint, coverage double, n_tiles bigint, longest_tile bigint")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows, all columns kept. Rows are told apart by id and
    a digest of the text, so that a clean text under a contaminated one's id stays."""
    digest = lambda c: F.md5(F.coalesce(F.col(c), F.lit("")).cast("binary"))
    key = lambda c: F.struct(F.col("doc_id").cast("long").alias("doc_id"), digest(c).alias("digest"))
    dirty = contaminated(docs, benchmark).select(key("doc_text").alias("tiling_row")).distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.struct(*columns).alias("tiling_doc"), key("text").alias("tiling_row"))
    return keyed.join(settle(dirty, "tiling-dirty"), "tiling_row", "left_anti").select("tiling_doc.*")
