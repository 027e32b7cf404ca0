"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut into two halves and each half is quantised with its own codebook; a cell is a
pair of centroids. The codebooks are fitted on a bounded sample (``FIT_ROWS`` vectors, the
first in the order of a hash of their id), every vector is indexed. A query ranks the
centroids of either half by inner product and walks the pairs in order of the summed value
with a heap, until the cells passed hold ``share`` of all vectors. Cells are Spark's groups:
queries that reach a cell meet its entries there in one matrix product per block, and the
entries kept are scored again on the original vectors in double precision.

A cell may hold any share of the data, and any share of the queries may reach it. Entries are
dealt out in blocks of at most about ``BLOCK_ROWS`` by a hash of the id, queries in blocks of at
most about ``QUERY_ROWS``, and every block of queries meets every block of entries of its cells,
so no task holds a whole hot cell or all queries that reach it.

Defined results: vectors that are null, zero, or hold null or non-finite components take no
part, nor do vectors whose length is not the most frequent one (the smaller on a tie); rows
with a null id take no part; a query meets every row but its own id; repeated rows are
separate candidates under one id; ties go to the smaller id; with no more than k candidates in
reach the walk goes on until k are found or the cells end; an empty table gives an empty
result. An id with several vectors that is a query is ranked as one query: its vectors' candidates
together. Only the id and vector columns are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coverloom.llm.common import settle, ship

K = 20
QUERY_STEP = 20
CENTROIDS = 16
FIT_ROWS = 20_000
SHARE = 0.75
BLOCK_ROWS = 2_000
QUERY_ROWS = 8_000
_ROUNDS = 12
# Matrix products may differ in the last bits; entries this close to the k-th are scored again.
_SLACK = 1e-9


# ---- codebooks and the walk ----------------------------------------------------------


def fit_codebook(halves: np.ndarray, centroids: int, seed: int = 5) -> np.ndarray:
    """Lloyd's algorithm with distinct starting points."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(halves, axis=0)
    book = distinct[rng.permutation(len(distinct))[:centroids]].copy()
    for _ in range(_ROUNDS):
        near = nearest(halves, book)
        sums = np.zeros_like(book)
        np.add.at(sums, near, halves)
        counts = np.bincount(near, minlength=len(book))
        book[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return book


def nearest(halves: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book * book).sum(1) - 2 * halves @ book.T).argmin(1)


def walk(left: np.ndarray, right: np.ndarray, sizes: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """Centroid pairs by falling summed value, until their cells hold ``enough`` entries. A
    pair enters the heap once both its predecessors have left it."""
    a, b = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
    heap, seen, found, held = [(-(left[a[0]] + right[b[0]]), 0, 0)], {(0, 0)}, [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        size = int(sizes[a[i], b[j]])
        if size:
            found.append((int(a[i]), int(b[j])))
            held += size
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (-(left[a[x]] + right[b[y]]), x, y))
    return found


# ---- on Spark ------------------------------------------------------------------------


def _spread(ids: np.ndarray, blocks: np.ndarray | int) -> np.ndarray:
    mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return mixed % np.asarray(blocks).astype(np.uint64)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def vector_type(vectors: DataFrame, column: str) -> str:
    return "array<float>" if dict(vectors.dtypes)[column] == "array<float>" else "array<double>"


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id and vector of the rows that take part; floats stay floats until they are used."""
    v, kind = F.col("vector"), vector_type(vectors, vector_column)
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = (
        vectors.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{vector_column}`").cast(kind).alias("vector"))
        .filter(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
        .withColumn("length", F.size("vector"))
    )
    usual = sound.groupBy("length").count().orderBy(F.desc("count"), "length").limit(1)
    return sound.join(F.broadcast(usual.select("length")), "length", "left_semi").select("vec_id", "vector")


def search(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = K, step: int = QUERY_STEP,
    share: float = SHARE, centroids: int = CENTROIDS,
) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by ``step``."""
    spark, kind = ship(vectors.sparkSession), vector_type(vectors, vector_column)
    rows = usable(vectors, id_column, vector_column)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).select("vector").toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    points = _matrix(sample.column("vector").combine_chunks())
    half = max(points.shape[1] // 2, 1)
    books = spark.sparkContext.broadcast((fit_codebook(points[:, :half], centroids), fit_codebook(points[:, half:], centroids)))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = books.value
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1))
                cell = nearest(x[:, :half], first) * len(second) + nearest(x[:, half:], second)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], ["vec_id", "vector", "cell"])

    entries = settle(rows.mapInArrow(cells, f"vec_id bigint, vector {kind}, cell int"), "ann-entries")
    # At most centroids ** 2 rows.
    sizes = np.zeros((len(books.value[0]), len(books.value[1])), np.int64)
    for cell, n in entries.groupBy("cell").count().collect():
        sizes[divmod(cell, sizes.shape[1])] = n
    enough = max(k + 1, int(np.ceil(share * sizes.sum())))
    blocks = -(-sizes // BLOCK_ROWS)

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = books.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            left, right = x[:, :half] @ first.T, x[:, half:] @ second.T
            row, cell, block = [], [], []
            share_of = _spread(np.asarray(batch.column(0)), query_blocks).astype(np.int32)
            for n in range(len(x)):
                for i, j in walk(left[n], right[n], sizes, enough):
                    for b in range(blocks[i, j]):
                        row.append(n)
                        cell.append(i * sizes.shape[1] + j)
                        block.append(b)
                if len(row) > 20_000 or n == len(x) - 1:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell, pa.int32()), pa.array(block, pa.int32()), pa.array(share_of[row]), *(c.take(pa.array(row, pa.int32())) for c in batch.columns[:2])],
                        ["cell", "block", "part", "query_id", "query"],
                    )
                    row, cell, block = [], [], []

    queries = entries.filter(F.col("vec_id") % step == 0).select("vec_id", "vector").distinct()
    query_blocks = max(-(-queries.count() // QUERY_ROWS), 1)
    per_cell = spark.sparkContext.broadcast(blocks.ravel().astype(np.int64))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, cell = np.asarray(batch.column(0)), np.asarray(batch.column(2))
            block = _spread(ids, per_cell.value[cell]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(block), batch.column(0), batch.column(1)], ["cell", "block", "vec_id", "vector"])

    dealt = entries.mapInArrow(deal, f"cell int, block int, vec_id bigint, vector {kind}")
    dealt = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    probed = queries.mapInArrow(probes, f"cell int, block int, part int, query_id bigint, query {kind}")

    def meet(asked: Iterator[pa.RecordBatch], held: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One block of entries and one of queries."""
        parts = [b for b in held if b.num_rows]
        if not parts:
            return
        ids = np.concatenate([np.asarray(b.column("vec_id")) for b in parts])
        x = np.concatenate([_matrix(b.column("vector")) for b in parts])
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        for batch in asked:
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            query_ids = np.asarray(batch.column("query_id")) if batch.num_rows else np.empty(0, np.int64)
            q = _matrix(batch.column("query")) if batch.num_rows else np.empty((0, x.shape[1]))
            for lo in range(0, len(q), 256):
                near = q[lo : lo + 256] @ x.T
                for n, (one, scores) in enumerate(zip(query_ids[lo : lo + 256], near, strict=True)):
                    own = slice(*np.searchsorted(ids, (one, one + 1)))
                    scores[own] = -np.inf  # all rows of the query's id, before the k-th of the others
                    others = len(scores) - (own.stop - own.start)
                    limit = -np.inf if others <= k else np.partition(scores, len(scores) - k)[len(scores) - k] - _SLACK
                    kept = np.flatnonzero((scores >= limit) & (ids != one))
                    exact = (x[kept] * q[lo + n]).sum(axis=1)
                    top = np.lexsort((ids[kept], -exact))[:k]
                    out.append((np.full(len(top), one), ids[kept][top], exact[top]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["query_id", "vec_id", "score"])

    found = probed.groupBy("cell", "block", "part").cogroup(dealt.groupBy("cell", "block", "part")).applyInArrow(
        lambda a, b: _as_table(meet(iter(a.to_batches()), iter(b.to_batches()))), "query_id bigint, vec_id bigint, score double"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _as_table(batches: Iterator[pa.RecordBatch]) -> pa.Table:
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    return pa.Table.from_batches(list(batches), schema)
