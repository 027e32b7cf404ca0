"""Incremental payments: new, corrected, late and repeated rows into the stored payments.

``payment_batches`` holds the rows of all loads, appended by month as plain Parquet. Every row
carries a load time stamped on it by its feed; the newest row of a payment wins, and among equal
load times the one with the greatest hash of its content. Running the same batch again, or
batches out of order, ends in the same payments.

Months can be read on their own: if a payment's newest row lies in another month, the months
of its older rows get a row that marks them as superseded, with the newest row's load time.
``current_payments`` takes the newest row of each payment in each month and leaves those marks
out. An append is all a load writes, and one that dies is finished by the next try: it adds
the rows and marks that are not there yet.

Rows without an id or without a load time cannot be merged: they go to the table
``payment_rejects``, once per distinct record, with the reason.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverloom.session import written_for
from coverloom.sources.store import Store

VERSION = "loaded_at"
BATCHES, REJECTS = "payment_batches", "payment_rejects"
NO_ID, NO_VERSION = "payment_id is missing", "load time is missing"
_MARKS = ("digest", "superseded")


def _rank() -> Column:
    return F.struct(VERSION, "digest")


def row_hash(columns: list[str]) -> Column:
    """Hashes skip nulls, so where they stand is hashed as well."""
    return F.xxhash64(*columns, F.concat(*[F.col(c).isNull().cast("string") for c in columns]))


def newest(batch: DataFrame) -> DataFrame:
    """One row per payment id, the newest, with its ``digest``. An aggregate, not a window:
    repeats of a hot id merge map-side."""
    stamped = batch.withColumn("digest", row_hash(sorted(batch.columns)))
    best = stamped.groupBy("payment_id").agg(F.max_by(F.struct(*[c for c in stamped.columns if c != "payment_id"]), _rank()).alias("_row"))
    return best.select(*[F.col("payment_id") if c == "payment_id" else F.col(f"_row.{c}") for c in stamped.columns])


def current_payments(rows: DataFrame) -> DataFrame:
    """The payments of whole months of ``payment_batches``, with their load time."""
    kept = [c for c in rows.columns if c not in ("payment_id", "due_period")]
    best = rows.groupBy("payment_id", "due_period").agg(F.max_by(F.struct(*kept), _rank()).alias("_row")).filter(~F.col("_row.superseded"))
    return best.select(*[c if c in ("payment_id", "due_period") else F.col(f"_row.{c}") for c in rows.columns if c not in _MARKS])


def rejected(batch: DataFrame) -> DataFrame:
    """reason, record (JSON) of rows that cannot be merged, each distinct record once."""
    nameless, undated = F.col("payment_id").isNull(), F.col(VERSION).isNull()
    # The filter is on columns, which Parquet answers from its statistics.
    return batch.filter(nameless | undated).select(
        F.when(nameless, NO_ID).otherwise(NO_VERSION).alias("reason"), F.to_json(F.struct(*sorted(batch.columns))).alias("record")
    ).distinct()


def first_rows(batch: DataFrame) -> DataFrame:
    """What an empty ``payment_batches`` gets of a batch."""
    good = batch.filter(F.col("payment_id").isNotNull() & F.col(VERSION).isNotNull())
    return newest(good).withColumn("superseded", F.lit(False))


def upsert_payments(store: Store, batch: DataFrame) -> list[str | None]:
    """Merges staged payments (with ``loaded_at``) into the stored payments.

    Returns the months that changed: those of new rows, and those that older rows of the same
    payments lie in, since a corrected due date moves a payment to another month.
    """
    # The batch is used several times below, and so are its newest rows: each is worked out once.
    with written_for(batch, "payments-batch") as arrived:
        _set_aside(store, rejected(arrived))
        with written_for(first_rows(arrived), "payments-newest") as incoming:
            return _merge(store, incoming)


def _merge(store: Store, incoming: DataFrame) -> list[str | None]:
    if not store.exists(BATCHES):
        store.append(BATCHES, incoming)
        return _in_order(store.periods(BATCHES))
    with written_for(missing_rows(store, incoming), "payments-added") as rows:
        touched = _in_order(row[0] for row in rows.select("due_period").distinct().collect())  # months: a bounded number of values
        if touched:
            store.append(BATCHES, rows)
        return touched


def missing_rows(store: Store, incoming: DataFrame) -> DataFrame:
    """What has to be added for ``incoming``, one row per payment: rows newer than those held,
    and marks for the months of older rows. Of the stored rows only id, load time, digest and
    month are read, and of those only the ids that arrived go on."""
    schema = incoming.schema
    places = ["payment_id", VERSION, "digest", "due_period", "superseded"]
    held = store.read(BATCHES, schema=schema).select(*places).join(incoming.select("payment_id"), "payment_id", "left_semi")
    place = F.struct(VERSION, "digest", "due_period", "superseded")
    stacked = held.withColumn("held", F.lit(True)).unionByName(incoming.select(*places, F.lit(False).alias("held")))
    seen = stacked.groupBy("payment_id").agg(
        F.max_by(place, F.struct(VERSION, "digest", ~F.col("superseded"))).alias("best"),
        F.collect_set(F.when(~F.col("superseded"), F.struct("due_period"))).alias("months"),
        F.collect_set(F.when(F.col("superseded"), F.struct(VERSION, "digest", "due_period"))).alias("marks"),
        F.max(F.when(F.col("held") & ~F.col("superseded"), _rank())).alias("known"),
        F.max(F.when(~F.col("held"), _rank())).alias("came"),
    )
    # A row that came is added if it is the best of its payment and not the best of those held.
    best = F.struct(F.col(f"best.{VERSION}").alias(VERSION), F.col("best.digest").alias("digest"))
    fresh = incoming.join(seen.filter((F.col("came") == best) & ~F.col("known").eqNullSafe(best)).select("payment_id"), "payment_id", "left_semi")
    wanted = F.transform(
        "months", lambda m: F.struct(F.col(f"best.{VERSION}").alias(VERSION), F.col("best.digest").alias("digest"), m["due_period"].alias("due_period"))
    )
    left_behind = F.filter(F.array_except(wanted, "marks"), lambda m: ~m["due_period"].eqNullSafe(F.col("best.due_period")))
    marks = seen.select("payment_id", F.explode(left_behind).alias("mark")).select("payment_id", "mark.*").withColumn("superseded", F.lit(True))
    return fresh.unionByName(marks, allowMissingColumns=True).select(*schema.fieldNames())


def _set_aside(store: Store, rows: DataFrame) -> None:
    if store.exists(REJECTS):
        rows = rows.join(store.read(REJECTS, schema=rows.schema), ["reason", "record"], "left_anti")
    if not rows.isEmpty():
        store.append(REJECTS, rows)


def _in_order(months: Iterable[str | None]) -> list[str | None]:
    return sorted(months, key=lambda month: (month is None, month or ""))
