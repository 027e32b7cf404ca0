"""Stored summaries that answer many questions without the fact they came from."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.functions import percent
from coverloom.operators.slicing import Slicers
from coverloom.plans.marts import count_rows

# ---- members billed, as bitmaps ------------------------------------------------------


def member_numbers(members: DataFrame) -> DataFrame:
    """member_id, agent_id and a number for every member. Members are sorted by agent, so those
    of one agent lie close together and share few bitmaps. The numbers depend on how the rows
    were dealt out: write them once and read them from there."""
    one_each = members.groupBy("member_id").agg(F.min("agent_id").alias("agent_id"))
    dealt = one_each.repartitionByRange("agent_id", "member_id").sortWithinPartitions("agent_id", "member_id")
    return dealt.withColumn("number", F.monotonically_increasing_id())


# A bucket is 32,768 members: 512 words of 64 bits.
_BITMAP_BYTES = 4096
# Rows with fewer words than this list them; the others are whole bitmaps.
_DENSE_WORDS = 64


def billed_members(payments: DataFrame, numbers: DataFrame) -> DataFrame:
    """Who was billed per agent, month and carrier: one row per bucket of 32,768 members. Bits
    are merged as words of 64 before and after they move, and a row is as wide as its members
    ask for: ``members`` is Spark's bitmap of 4,096 bytes where many words of the bucket are
    taken, otherwise two bytes of place and eight of bits for every word taken."""
    keys = ("agent_id", "due_period", "carrier", "bucket")
    position = F.bitmap_bit_position(F.col("number"))
    # Bytes of a bitmap count up, bits within a byte too: the word's first byte is its highest.
    bit = "bit_or(shiftleft(1L, cast((position % 64) ^ 56 as int)))"
    words = (
        payments.select("member_id", "due_period", "carrier").join(numbers, "member_id")
        .withColumns({"bucket": F.bitmap_bucket_number(F.col("number")), "position": position})
        .groupBy(*keys, F.expr("cast(position div 64 as int)").alias("word")).agg(F.expr(bit).alias("bits"))
    )
    gap = "x.word - if(i = 0, -1, words[i - 1].word) - 1"
    whole = f"rpad(array_join(transform(words, (x, i) -> repeat('0', 16 * ({gap})) || lpad(hex(x.bits), 16, '0')), ''), {2 * _BITMAP_BYTES}, '0')"
    listed = "array_join(transform(words, x -> lpad(hex(x.word), 4, '0') || lpad(hex(x.bits), 16, '0')), '')"
    return (
        words.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))
        .select(*keys, F.expr(f"unhex(if(size(words) < {_DENSE_WORDS}, {listed}, {whole}))").alias("members"))
    )


def _member_words(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """``keys``, bucket, word and bits of every word that ``billed_members`` has packed."""
    number = "cast(conv(hex(substring(members, {at}, {n})), 16, -10) as bigint)"
    whole = f"transform(sequence(0, {_BITMAP_BYTES // 8 - 1}), i -> struct(i as word, {number.format(at='8 * i + 1', n=8)} as bits))"
    place = f"cast({number.format(at='10 * i + 1', n=2)} as int)"
    listed = f"transform(sequence(0, length(members) div 10 - 1), i -> struct({place} as word, {number.format(at='10 * i + 3', n=8)} as bits))"
    words = F.explode(F.expr(f"if(length(members) = {_BITMAP_BYTES}, {whole}, {listed})"))
    return bitmaps.select(*keys, "bucket", words.alias("w")).select(*keys, "bucket", "w.word", "w.bits").filter("bits <> 0")


def count_members(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """Distinct members per ``keys``, exactly: words of one place merge, places add up."""
    merged = _member_words(bitmaps, *keys).groupBy(*keys, "bucket", "word").agg(F.bit_or("bits").alias("bits"))
    return merged.groupBy(*keys).agg(F.sum(F.bit_count("bits")).alias("active_members"))


def active_members(bitmaps: DataFrame, agents: DataFrame) -> DataFrame:
    """Members billed per quarter and agent tier, per year and carrier, and per agent's book."""
    period = F.col("due_period")
    quarter = F.concat(F.substring(period, 1, 4), F.lit("-Q"), F.ceil(F.substring(period, 6, 2).cast("int") / 3).cast("string"))
    timed = bitmaps.withColumns({"quarter": quarter, "year": F.substring(period, 1, 4)}).join(
        agents.select("agent_id", F.col("tier")), "agent_id", "left"
    )
    scopes = {
        "quarter_tier": count_members(timed, "quarter", "tier").select("active_members", F.col("quarter").alias("period"), F.col("tier").alias("name")),
        "year_carrier": count_members(timed, "year", "carrier").select("active_members", F.col("year").alias("period"), F.col("carrier").alias("name")),
        "book": count_members(timed, "agent_id").select("active_members", F.lit("all").alias("period"), F.col("agent_id").alias("name")),
    }
    stacked = [f.select(F.lit(scope).alias("scope"), "period", "name", "active_members") for scope, f in scopes.items()]
    return stacked[0].unionByName(stacked[1]).unionByName(stacked[2])


# ---- the slicer cube -----------------------------------------------------------------

# Slicer -> column of the payment fact. Every cuboid keeps the months.
DIMENSIONS = {"carriers": "carrier", "plan_types": "plan_type", "tiers": "agent_tier", "states": "state"}
# The lattice that is stored: the finest cuboid answers everything, the others what is asked most.
LATTICE = (
    ("carrier", "plan_type", "agent_tier", "state"), ("carrier", "plan_type", "agent_tier"), ("carrier", "plan_type"), ("carrier", "agent_tier"),
    ("agent_tier", "state"), ("carrier",), ("plan_type",), ("agent_tier",), ("state",), (),
)
_MONTHS = ["due_period", "due_year", "due_month"]
_MEASURES = ("total_billed", "total_collected", "total_uncollected", "failed_payments", "payments")


def cuboid_name(columns: Iterable[str]) -> str:
    return "-".join(c for c in DIMENSIONS.values() if c in set(columns)) or "months"


def revenue_cube(payments: DataFrame, lattice: Sequence[Sequence[str]] = LATTICE) -> DataFrame:
    """All cuboids stacked, ``cuboid`` naming each. The fact is summed up to the finest one
    first, and the grouping sets are taken from that: the fact is read and moved once."""
    keys = list(DIMENSIONS.values())
    finest = payments.groupBy(*_MONTHS, *keys).agg(
        F.sum("amount_due").alias("total_billed"), F.sum("amount_paid").alias("total_collected"), F.sum("payment_gap").alias("total_uncollected"),
        F.count_if("is_failed").alias("failed_payments"), count_rows().alias("payments"),
    )
    sets = [[F.col(c) for c in (*_MONTHS, *wanted)] for wanted in lattice]
    sums = [F.sum(m).cast("bigint" if m in ("failed_payments", "payments") else "decimal(22,2)").alias(m) for m in _MEASURES]
    cube = finest.groupingSets(sets, *_MONTHS, *keys).agg(*sums, *[F.grouping(c).alias(f"_{c}") for c in keys])
    names = F.concat_ws("-", *[F.when(F.col(f"_{c}") == 0, F.lit(c)) for c in keys])
    return cube.withColumn("cuboid", F.when(names == "", "months").otherwise(names)).drop(*[f"_{c}" for c in keys])


def write_cube(cube: DataFrame, folder: str) -> None:
    cube.hint("rebalance", "cuboid").write.mode("overwrite").partitionBy("cuboid").parquet(folder)


class CubeReader:
    """Answers slicers from the smallest stored cuboid that holds their columns."""

    def __init__(self, cube: DataFrame):
        self.cube = cube
        # One row per cuboid.
        self.sizes = {r.cuboid: r.n for r in cube.groupBy("cuboid").agg(count_rows().alias("n")).collect()}

    def route(self, slicers: Slicers) -> str:
        needed = {column for slicer, column in DIMENSIONS.items() if getattr(slicers, slicer) is not None}
        able = [name for name in self.sizes if needed <= (set(name.split("-")) - {"months"})]
        if not able:
            raise LookupError(f"no stored cuboid holds {sorted(needed)}")
        return min(able, key=lambda name: (self.sizes[name], name))

    def monthly_revenue(self, slicers: Slicers) -> DataFrame:
        """Q1 under the slicers, which have to name whole months; days need the fact."""
        for day, whole in ((slicers.start, slicers.start and slicers.start.day == 1), (slicers.end, slicers.end and (slicers.end + timedelta(days=1)).day == 1)):
            if day is not None and not whole:
                raise ValueError(f"{day} cuts a month, and the cube keeps whole months")
        rows = self.cube.filter(F.col("cuboid") == self.route(slicers))
        for day, keep in ((slicers.start, F.col("due_period").__ge__), (slicers.end, F.col("due_period").__le__)):
            rows = rows if day is None else rows.filter(keep(_month(day)))
        for slicer, column in DIMENSIONS.items():
            wanted = getattr(slicers, slicer)
            rows = rows if wanted is None else rows.filter(F.col(column).isin(*wanted))
        summed = rows.groupBy(*_MONTHS).agg(*[F.sum(m).alias(m) for m in _MEASURES])
        return summed.select(
            *_MONTHS, "total_billed", "total_collected", "total_uncollected", "failed_payments",
            percent(F.col("total_collected"), F.col("total_billed")).alias("collection_rate_pct"),
            percent(F.col("failed_payments"), F.col("payments")).alias("failure_rate_pct"),
        )


def _month(day: date) -> str:
    return f"{day:%Y-%m}"
