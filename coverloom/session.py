"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime SQL settings every job of this package relies on.
#
# * skewJoin + forceOptimizeSkewedJoin: payments meet policies and members in N:1 left
#   joins. A policy or member holding a third of all payments makes one huge shuffle
#   partition on the payment side; AQE cuts it in pieces and rereads only the matching
#   dimension partition. "force" keeps that even if it costs a later shuffle.
# * fileCompressionFactor: a side is broadcast only if its estimated size is below
#   spark.sql.autoBroadcastJoinThreshold. Parquet is compressed, so the estimate is
#   scaled up before the check. No broadcast() hint appears anywhere in this package:
#   beyond the threshold every join falls back to a shuffle.
# * maxShuffledHashJoinLocalMapThreshold: once the shuffle has shown that every partition
#   of a side is small, hash that side in place of sorting both. Sizes are compressed ones
#   and a hash table cannot spill, so the limit is low; beyond it the join sorts, and spills.
# * shuffleDependency.fileCleanup: what a step has shuffled is deleted when it ends. Loads and
#   refreshes are many steps in one session, and their shuffles would add up on disk.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "8m",
    SHUFFLES_GO: "true",
    "spark.sql.sources.fileCompressionFactor": "3.0",
    # Month partitions such as 2001-09 are text and stay text.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Fixed when the session starts. Plans here have hundreds of column expressions; recording
# the Python line of each one takes longer than planning them.
START_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

MB = 1024 * 1024
PARTITION_BYTES = 192 * MB
# A query reads a few of a table's columns and shuffles fewer still.
SHUFFLED_SHARE = 0.25
# What one reducer is to read. Its sorts and hash tables together hold 20 to 27 times as many
# bytes as the compressed ones it reads.
REDUCER_BYTES = 16 * MB
# Columns derived from keys make the widest shuffle of a query up to this many times its input.
WIDEST = 10
# Beyond this many tasks on both sides of a shuffle, its bookkeeping outweighs its data.
MOST_TASKS = 100_000


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files below ``paths``, which may be patterns; no file is opened."""
    return spark.read.format("binaryFile").load(list(paths)).agg(F.sum("length")).first()[0] or 0


def fit_reducers(spark: SparkSession, input_bytes: int) -> SparkSession:
    """Shuffles so wide that the memory of a task does not grow with the input: AQE merges
    partitions up to ``REDUCER_BYTES``, but it does not cut those that begin larger."""
    wide = min(-(-input_bytes * WIDEST // REDUCER_BYTES), MOST_TASKS)
    first = max(wide, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(first))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(REDUCER_BYTES))
    return spark


def sizing(input_bytes: int, cores: int) -> dict[str, str]:
    """Scan and shuffle widths for a run over ``input_bytes``.

    The shuffle starts wide enough that no partition has to spill; AQE merges what turns out
    small up to the target size, and cuts what turns out heavy. Large inputs are scanned in
    larger splits, which keeps the number of map outputs in hand.
    """
    shuffle = -(-int(input_bytes * SHUFFLED_SHARE) // PARTITION_BYTES)
    split = min(max(input_bytes // MOST_TASKS, 128 * MB), 1024 * MB)
    return {
        "spark.sql.shuffle.partitions": str(min(max(cores, shuffle), MOST_TASKS)),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def open_session(
    app: str = "coverloom", master: str | None = None, input_bytes: int | None = None, cores: int = 8,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = {} if input_bytes is None else sizing(input_bytes, cores)
    for key, value in {**START_SETTINGS, **sized, **(settings or {})}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


# Folders made by this process, for clean_up.
_made: list[str] = []


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that all executors can reach, below ``spark.checkpoint.dir``, or below the
    warehouse where that is not set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
    _made.append(f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}")
    return _made[-1]


def written_once(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame``, worked out once and read from a shared folder by whoever uses it."""
    folder = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


@contextmanager
def written_for(frame: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """As ``written_once``, for the length of a with block: the folder goes at its end. For the
    steps of a build, whose shuffles and tables would add up on disk."""
    spark, folder = frame.sparkSession, shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(folder)
    try:
        yield spark.read.schema(frame.schema).parquet(folder)
    finally:
        discard(spark, folder)


def written_small(frame: DataFrame, purpose: str) -> DataFrame:
    """As ``written_once``, in as few files as the rows ask for. What a selective join has left is
    spread over all its tasks, and a table of many files looks large to Catalyst, which then
    shuffles whatever it meets. Beyond the broadcast threshold joins shuffle as ever."""
    return written_once(frame.hint("rebalance"), purpose)


def folders_made() -> int:
    return len(_made)


def discard(spark: SparkSession, folder: str) -> bool:
    """Deletes a folder that ``shared_folder`` has given out. Spark has no call of its own that
    deletes files, so this one needs the driver's JVM."""
    if folder in _made:
        _made.remove(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))


def clean_up(spark: SparkSession, keep: int = 0) -> int:
    """Deletes the folders that ``shared_folder`` has given out, but for the first ``keep``, once
    nothing reads them any more; how many."""
    gone = 0
    while len(_made) > keep:
        gone += discard(spark, _made[-1])
    return gone
