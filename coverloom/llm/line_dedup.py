"""Removal of boilerplate lines that are spread over many sites, in DataFrame functions only.

A HyperLogLog sketch of sites per line hash is merged by aggregation. A line whose estimate
is well above the limit is boilerplate, well below it is content, and only lines near the
limit get an exact distinct count. Sketches are merged before the shuffle, so a line in a
third of all documents arrives as one sketch per task.

Defined results: a line is compared without its outer white space, an empty line is never
removed, and the lines that stay keep their text; a null text has no lines and stays null; a
null source is a site of its own; repeated rows are cleaned alike; an empty table gives an
empty result. Columns other than text and source pass through the general form untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverloom.llm.common import settle

SITES = 5
LG_BUCKETS = 12
# Sketches of 2**12 buckets have a standard error of 1.6 %; six of those, and two sites at least.
NEAR_SHARE, NEAR_SITES = 0.1, 2

_BREAK = "\n"


def _trimmed(line: Column) -> Column:
    return F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


def _line_hash(line: Column) -> Column:
    return F.xxhash64(_trimmed(line))


def _lines(docs: DataFrame, *more: Column) -> DataFrame:
    site = F.coalesce(F.col("source"), F.lit("\0"))
    exploded = docs.filter("text is not null").select(site.alias("site"), *more, F.explode(F.split("text", _BREAK)).alias("line"))
    return exploded.filter(_trimmed(F.col("line")) != "").withColumn("line_hash", _line_hash(F.col("line"))).drop("line")


def spread_lines(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """line_hash of every line found on at least ``sites`` distinct sites."""
    near = max(NEAR_SITES, round(sites * NEAR_SHARE))
    lines = _lines(docs)
    estimated = settle(
        lines.groupBy("line_hash").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_BUCKETS)).alias("estimate"))
        .filter(F.col("estimate") >= sites - near),
        "line-spread",
    )
    sure = estimated.filter(F.col("estimate") > sites + near).select("line_hash")
    unsure = estimated.filter(F.col("estimate") <= sites + near).select("line_hash")
    exact = (
        lines.join(unsure, "line_hash", "left_semi").groupBy("line_hash").agg(F.countDistinct("site").alias("exact"))
        .filter(F.col("exact") >= sites).select("line_hash")
    )
    return sure.unionByName(exact)


def remove_spread_lines(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """All columns of ``docs`` with the cleaned text, then n_lines and n_removed, which take
    the place of columns of those names.

    The hashes to remove are gathered per document, so the text is moved once and never taken
    apart into rows that have to be put together again.
    """
    row_key = F.md5(F.concat_ws("|", F.coalesce("source", F.lit("\0")), F.col("text")).cast("binary"))
    spread = settle(spread_lines(docs, sites), "line-spread-kept")
    hits = (
        _lines(docs, row_key.alias("line_doc")).join(spread, "line_hash").select("line_doc", "line_hash").distinct()
        .groupBy("line_doc").agg(F.collect_list("line_hash").alias("line_hashes"))
    )
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    columns = [F.col(f"`{c}`") for c in names]
    found = docs.select(F.struct(*columns).alias("line_row"), F.split("text", _BREAK).alias("line_all"), row_key.alias("line_doc")).join(
        hits, "line_doc", "left"
    )
    goes = lambda line: F.coalesce(F.array_contains("line_hashes", _line_hash(line)) & (_trimmed(line) != ""), F.lit(False))
    kept = F.when(F.col("line_hashes").isNull(), F.col("line_all")).otherwise(F.filter("line_all", lambda line: ~goes(line)))
    found = found.withColumn("line_kept", kept)
    counted = lambda lines: F.coalesce(F.size(lines), F.lit(0)).cast("long")
    cleaned = [
        F.array_join("line_kept", _BREAK).alias(c) if c == "text" else F.col(f"line_row.`{c}`") for c in names
    ]
    lines = F.when(F.col("line_all").isNull(), F.lit(0)).otherwise(counted("line_all"))
    left = F.when(F.col("line_all").isNull(), F.lit(0)).otherwise(counted("line_kept"))
    return found.select(*cleaned, lines.cast("long").alias("n_lines"), (lines - left).cast("long").alias("n_removed"))
