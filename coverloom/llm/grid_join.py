"""Near copies among embeddings by an epsilon grid order join.

Two vectors link when their cosine is at least ``cosine``, which for vectors of length 1 means a
distance of at most eps = sqrt(2 - 2 cosine). Equal vectors are taken together first, so a
vector that occurs a million times is one row with a count. The others are turned into their
leading principal dimensions, fitted on a bounded sample (any orthonormal directions give
the same links). A grid of cells eps wide on these dimensions orders them lexicographically: a
distributed range sort makes that one sequence, which is cut into blocks of ``BLOCK_ROWS``.

The join runs down a tree of sequence intervals. Each interval knows the box of its leading
coordinates and of the length that the other dimensions make up; a pair of intervals whose
boxes are more than eps apart is skipped, any other is taken apart into pairs of smaller
intervals. Above blocks that is a Spark join a level, inside a pair of blocks a recursion down
to ``LEAF_ROWS`` and then one matrix product. A pair of blocks gives back one count for each
vector with links and a spanning forest of the links, not the links, so a group of n near
copies costs rows in proportion to n. Cosines within 1e-9 of the limit are worked out again on
the original vectors.

If no leading dimension tells vectors apart, no interval can be skipped and the join compares
all pairs, in blocks; that is the price of exact links.

Defined results: vectors that are null, zero, or hold null or non-finite components link with
nothing and are a component each; vectors of different lengths do not link; rows with
a null id take part, and no component is named after them; repeated rows are separate vectors
that link with each other; an empty table gives an empty result. Only the id and vector
columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverloom.llm.ann import vector_type
from coverloom.llm.common import settle, ship
from coverloom.llm.components import components

COSINE = 0.9
BLOCK_ROWS = 8_192
LEAF_ROWS = 512
# Leading principal dimensions that make up the grid, and the sample they are fitted on.
DIMENSIONS = 8
FIT_ROWS = 20_000
# Intervals that one interval of the level above covers.
FAN_OUT = 8
_SLACK = 1e-9
_COORDINATES = DIMENSIONS + 1
_BITS = 33  # of monotonically_increasing_id, for the place in its partition


# ---- inside a pair of blocks ---------------------------------------------------------


class Block:
    """Vectors in sequence order with what the join needs to know of them."""

    def __init__(self, nodes: np.ndarray, copies: np.ndarray, vectors: np.ndarray, basis: np.ndarray):
        self.nodes, self.copies, self.vectors = nodes, copies, vectors
        self.unit = unit_vectors(vectors)
        places = coordinates(self.unit, basis)
        cuts = range(0, len(nodes), LEAF_ROWS)
        self.low = np.array([places[k : k + LEAF_ROWS].min(0) for k in cuts])
        self.high = np.array([places[k : k + LEAF_ROWS].max(0) for k in cuts])

    def leaf(self, k: int) -> slice:
        return slice(k * LEAF_ROWS, min((k + 1) * LEAF_ROWS, len(self.nodes)))


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)  # no square overflows or vanishes
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def coordinates(unit: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Leading coordinates, and the length of what they leave."""
    places = np.zeros((len(unit), _COORDINATES))
    places[:, : basis.shape[1]] = unit @ basis
    places[:, -1] = np.sqrt(np.maximum(1 - (places * places).sum(1), 0))
    return places


def gap(low: np.ndarray, high: np.ndarray, other_low: np.ndarray, other_high: np.ndarray) -> float:
    """Square of the smallest distance between points of two boxes."""
    apart = np.maximum(np.maximum(low - other_high, other_low - high), 0)
    return float((apart * apart).sum())


class Forest:
    """Roots of all rows of both blocks, and the unions that made them."""

    def __init__(self, rows: int):
        self.root = np.arange(rows)
        self.edges: list[tuple[int, int]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        left, right = self.root[a], self.root[b]
        differ = left != right
        if not differ.any():
            return
        new = {}

        def top(x: int) -> int:
            while x in new:
                x = new[x]
            return x

        for x, y in np.unique(np.stack([left[differ], right[differ]], 1), axis=0).tolist():
            x, y = sorted((top(x), top(y)))
            if x != y:
                new[y] = x
                self.edges.append((x, y))
        moved = np.arange(len(self.root))
        moved[list(new)] = [top(x) for x in new]
        self.root = moved[self.root]


def join_blocks(left: Block, right: Block | None, cosine: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of every row (left's rows, then right's), counted with copies, and a spanning
    forest of them. Without ``right``, left is joined with itself."""
    other, alone = (left, True) if right is None else (right, False)
    shift = 0 if alone else len(left.nodes)
    links, forest = np.zeros(shift + len(other.nodes), np.int64), Forest(shift + len(other.nodes))
    reach = 2 - 2 * cosine + _SLACK
    stack = [(0, len(left.low), 0, len(other.low))]
    while stack:
        a, b, c, d = stack.pop()
        if alone and d <= a:
            continue  # the mirror image is joined
        boxes = left.low[a:b].min(0), left.high[a:b].max(0), other.low[c:d].min(0), other.high[c:d].max(0)
        if not (alone and a < d and c < b) and gap(*boxes) > reach:
            continue
        if b - a > 1 or d - c > 1:
            if b - a >= d - c:
                half = (a + b) // 2
                stack += [(a, half, c, d), (half, b, c, d)]
            else:
                half = (c + d) // 2
                stack += [(a, b, c, half), (a, b, half, d)]
            continue
        if alone and c < a:
            continue
        rows, columns = left.leaf(a), other.leaf(c)
        near = left.unit[rows] @ other.unit[columns].T
        linked = near >= cosine
        close = np.abs(near - cosine) <= _SLACK
        if close.any():
            for i, j in zip(*np.nonzero(close), strict=True):
                linked[i, j] = exact_cosine(left.vectors[rows][i], other.vectors[columns][j]) >= cosine
        if alone and a == c:
            linked = np.triu(linked, 1)
        if linked.any():
            ones = linked.astype(np.float64)
            links[rows] += (ones @ other.copies[columns]).astype(np.int64)
            links[columns.start + shift : columns.stop + shift] += (left.copies[rows] @ ones).astype(np.int64)
            i, j = np.nonzero(linked)
            forest.add(i + rows.start, j + columns.start + shift)
    return links, forest.edges


def exact_cosine(x: np.ndarray, y: np.ndarray) -> float:
    return float((x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())))


# ---- on Spark ------------------------------------------------------------------------


def _sound(vector: Column) -> Column:
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, DataFrame]:
    """vec_id and the two hashes that name each row's vector (null if it takes no part), and
    one row per distinct vector with its smallest id and number of rows."""
    v = F.col(f"`{vector_column}`").cast(vector_type(vectors, vector_column))
    given = vectors.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), v.alias("vector"))
    # 128 bits: equal hashes are taken as equal vectors.
    hashes = [F.when(_sound(F.col("vector")), F.xxhash64(F.lit(k), "vector")).alias(f"h{k}") for k in (1, 2)]
    rows = given.select("vec_id", *hashes, "vector")
    distinct = (
        rows.filter("h1 is not null").groupBy("h1", "h2")
        .agg(F.any_value("vector").alias("vector"), F.min("vec_id").alias("least"), F.count("*").alias("copies"))
        .withColumn("length", F.size("vector"))
    )
    return rows.drop("vector"), distinct


def fit_basis(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """The most frequent length in a bounded sample and its leading principal directions."""
    sample = distinct.orderBy(F.xxhash64("h1"), "h1", "h2").limit(FIT_ROWS).select("length", "vector").toArrow()
    lengths = np.asarray(sample.column("length"))
    if not len(lengths):
        return 0, np.empty((0, 0))
    usual = int(np.bincount(lengths).argmax())
    mine = sample.filter(pa.array(lengths == usual)).column("vector").combine_chunks()
    unit = unit_vectors(np.asarray(mine.flatten(), np.float64).reshape(-1, usual))
    _, directions = np.linalg.eigh(unit.T @ unit)
    return usual, np.ascontiguousarray(directions[:, ::-1][:, :DIMENSIONS])


def _basis_for(length: int, fitted: tuple[int, np.ndarray]) -> np.ndarray:
    return fitted[1] if length == fitted[0] else np.eye(length)[:, :DIMENSIONS]


def sequence(distinct: DataFrame, fitted: tuple[int, np.ndarray], eps: float) -> DataFrame:
    """node, length, block and place of every distinct vector in epsilon grid order."""
    shared = distinct.sparkSession.sparkContext.broadcast(fitted)
    kind = dict(distinct.dtypes)["vector"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(batch.column("length"))
            places = np.zeros((len(lengths), _COORDINATES))
            for length in np.unique(lengths).tolist():
                mine = np.flatnonzero(lengths == length)
                x = np.asarray(batch.column("vector").take(pa.array(mine)).flatten(), np.float64).reshape(-1, length)
                places[mine] = coordinates(unit_vectors(x), _basis_for(length, shared.value))
            cells = [pa.FixedSizeListArray.from_arrays(pa.array(np.floor(places / width).astype(np.int32).ravel()), _COORDINATES).cast(pa.list_(pa.int32())) for width in (eps, eps / 4)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cells], [*batch.schema.names, "cell", "fine"])

    placed = distinct.mapInArrow(run, f"h1 bigint, h2 bigint, vector {kind}, least bigint, copies bigint, length int, cell array<int>, fine array<int>")
    # Twice as many ranges as blocks, as ranges are cut by a sample.
    ranges = max(2 * distinct.count() // BLOCK_ROWS, 1)
    order = ["length", "cell", "fine", "h1", "h2"]
    sorted_rows = placed.repartitionByRange(ranges, *order).sortWithinPartitions(*order).drop("cell", "fine")
    kept = settle(sorted_rows.withColumn("node", F.monotonically_increasing_id()), "grid-sequence")
    part = F.shiftright("node", _BITS).alias("part")
    # One row per range and length: where it begins, and how many of this length came before.
    sizes = kept.groupBy(part, "length").agg(F.min("node").alias("begin"), F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "length", "begin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = kept.withColumn("part", part).join(starts, ["part", "length"])
    place = F.col("before") + F.col("node") - F.col("begin")
    return placed.select("node", "h1", "h2", "least", "copies", "length", "vector", F.floor(place / BLOCK_ROWS).cast("long").alias("block"))


def packed_blocks(rows: DataFrame, fitted: tuple[int, np.ndarray]) -> DataFrame:
    """One row per block: its box and its vectors in order; at most ``BLOCK_ROWS`` of them."""
    shared = rows.sparkSession.sparkContext.broadcast(fitted)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        length, block = table.column("length")[0].as_py(), table.column("block")[0].as_py()
        x = np.asarray(table.column("vector").combine_chunks().flatten()).reshape(-1, length)
        places = coordinates(unit_vectors(x.astype(np.float64)), _basis_for(length, shared.value))
        row = {
            "length": length, "block": block, "nodes": np.asarray(table.column("node")).tobytes(),
            "copies": np.asarray(table.column("copies")).tobytes(), "vectors": x.tobytes(),
            **{f"low{k}": v for k, v in enumerate(places.min(0).tolist())}, **{f"high{k}": v for k, v in enumerate(places.max(0).tolist())},
        }
        return pa.Table.from_pylist([row], schema=_packed_schema())

    return rows.groupBy("length", "block").applyInArrow(run, f"length int, block bigint, nodes binary, copies binary, vectors binary, {_BOX}")


_BOX = ", ".join(f"{side}{k} double" for side in ("low", "high") for k in range(_COORDINATES))
_BOX_NAMES = [f"{side}{k}" for side in ("low", "high") for k in range(_COORDINATES)]


def _packed_schema() -> pa.Schema:
    return pa.schema([
        ("length", pa.int32()), ("block", pa.int64()), ("nodes", pa.binary()), ("copies", pa.binary()), ("vectors", pa.binary()),
        *[(n, pa.float64()) for n in _BOX_NAMES],
    ])


def block_pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """length, i, j of all pairs of blocks whose boxes are at most ``eps`` apart, i up to j."""
    levels = [settle(blocks.select("length", F.col("block").alias("k"), *_BOX_NAMES), "grid-boxes")]
    while levels[-1].agg(F.max("k")).first()[0] or 0:
        widest = [F.min(n).alias(n) for n in _BOX_NAMES[:_COORDINATES]] + [F.max(n).alias(n) for n in _BOX_NAMES[_COORDINATES:]]
        above = levels[-1].groupBy("length", F.floor(F.col("k") / FAN_OUT).cast("long").alias("k")).agg(*widest)
        levels.append(settle(above, "grid-boxes"))
    apart = sum(
        F.pow(F.greatest(F.col(f"i_low{k}") - F.col(f"j_high{k}"), F.col(f"j_low{k}") - F.col(f"i_high{k}"), F.lit(0.0)), 2) for k in range(_COORDINATES)
    )
    pairs = levels[-1].select("length", F.col("k").alias("i"), F.col("k").alias("j"))
    for level in reversed(levels[:-1]):
        def below(c: str) -> Column:
            return F.explode(F.sequence(F.col(c) * FAN_OUT, F.col(c) * FAN_OUT + FAN_OUT - 1))

        children = pairs.select("length", below("i").alias("i"), "j").select("length", "i", below("j").alias("j")).filter("i <= j")
        sides = [level.select("length", F.col("k").alias(s), *[F.col(n).alias(f"{s}_{n}") for n in _BOX_NAMES]) for s in ("i", "j")]
        near = children.join(sides[0], ["length", "i"]).join(sides[1], ["length", "j"]).filter(apart <= eps * eps + _SLACK)
        pairs = settle(near.select("length", "i", "j"), "grid-pairs")
    return pairs


def _joined_pairs(blocks: DataFrame, pairs: DataFrame, fitted: tuple[int, np.ndarray], kind: str, cosine: float) -> DataFrame:
    """node and its links in one pair of blocks, or node and other: an edge of the forest."""
    shared = blocks.sparkSession.sparkContext.broadcast(fitted)
    dtype = np.float32 if kind == "array<float>" else np.float64
    wanted = pairs.select("length", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    dealt = wanted.join(blocks.select("length", "block", "nodes", "copies", "vectors"), ["length", "block"])

    def run(table: pa.Table) -> pa.Table:
        length, sides = table.column("length")[0].as_py(), []
        for row in table.sort_by("block").select(["nodes", "copies", "vectors"]).to_pylist():
            x = np.frombuffer(row["vectors"], dtype).astype(np.float64).reshape(-1, length)
            sides.append(Block(np.frombuffer(row["nodes"], np.int64), np.frombuffer(row["copies"], np.int64).astype(np.float64), x, _basis_for(length, shared.value)))
        links, edges = join_blocks(sides[0], sides[1] if len(sides) > 1 else None, cosine)
        nodes, some = np.concatenate([s.nodes for s in sides]), np.flatnonzero(links)
        ends = np.array(edges, np.int64).reshape(-1, 2)
        return pa.table({
            "node": pa.array(np.concatenate([nodes[some], nodes[ends[:, 0]]])),
            "other": pa.array([None] * len(some) + nodes[ends[:, 1]].tolist(), pa.int64()),
            "links": pa.array(np.concatenate([links[some], np.zeros(len(ends), np.int64)])),
        })

    return dealt.groupBy("length", "i", "j").applyInArrow(run, "node bigint, other bigint, links bigint")


def near_groups(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    ship(vectors.sparkSession)
    eps, kind = float(np.sqrt(2 - 2 * cosine)), vector_type(vectors, vector_column)
    rows, distinct = distinct_vectors(vectors, id_column, vector_column)
    distinct = settle(distinct, "grid-vectors")
    fitted = fit_basis(distinct)
    placed = settle(sequence(distinct, fitted, eps), "grid-placed")
    blocks = settle(packed_blocks(placed, fitted), "grid-blocks")
    found = settle(_joined_pairs(blocks, block_pairs(blocks, eps), fitted, kind, cosine), "grid-links")
    links = found.filter("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = placed.select("node", "h1", "h2", "least", "copies").join(links, "node", "left").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("least").alias("component"))
    classes = named.join(names, "root").select("h1", "h2", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    shown = rows.join(classes, ["h1", "h2"], "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("h1").isNull(), F.col("vec_id")).otherwise(F.col("component")).alias("component_id"),
    )
    return shown.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
