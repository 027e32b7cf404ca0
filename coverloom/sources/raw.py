"""The five raw tables, from CSV, Parquet or a catalog."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from coverloom.schemas import RAW_SCHEMAS

BAD_RECORD = "_bad_record"


class RawTables:
    """The five raw tables by name: ``agents members policies payments cancellations``."""

    agents: DataFrame
    members: DataFrame
    policies: DataFrame
    payments: DataFrame
    cancellations: DataFrame

    def __getitem__(self, table: str) -> DataFrame:
        if table not in RAW_SCHEMAS:
            raise KeyError(table)
        return getattr(self, table)

    def of_members(self, members: DataFrame) -> RawTables:
        """Raw tables with at least the payments of ``members`` (member_id) and the policies these
        payments name. Sources that work their tables out can do with less than all."""
        return self

    def register_views(self, prefix: str = "raw_") -> None:
        for table in RAW_SCHEMAS:
            self[table].createOrReplaceTempView(prefix + table)


class GivenTables(RawTables):
    """Raw tables from frames that exist already."""

    def __init__(self, **frames: DataFrame):
        if set(frames) != set(RAW_SCHEMAS):
            raise ValueError(f"expected the tables {sorted(RAW_SCHEMAS)}")
        vars(self).update(frames)


def read_csv(spark: SparkSession, path: str, table: str, line_breaks: bool = False) -> DataFrame:
    """One raw CSV with a header and quoted fields. ``line_breaks`` allows them inside quotes,
    at the price that a file is read by one task; without, files are split. A value that does not fit its column
    stops the job that uses it: a silent NULL would turn into a wrong label in staging."""
    return _csv(spark, line_breaks).option("mode", "FAILFAST").schema(RAW_SCHEMAS[table]).csv(path)


def read_csv_split(
    spark: SparkSession, path: str, table: str, line_breaks: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Dirty feeds: (rows that fit the schema, rejected rows as the text that came).

    Everything is read as text and each value is tried against its type, because the CSV
    reader converts, and so checks, only the columns a query happens to use.
    """
    typed = RAW_SCHEMAS[table].fields
    text = StructType([StructField(f.name, StringType(), True) for f in typed])
    rows = (
        _csv(spark, line_breaks)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_RECORD)
        .schema(text.add(BAD_RECORD, StringType(), True))
        .csv(path)
    )
    misfit = reduce(or_, [_misfit(f) for f in typed], F.col(BAD_RECORD).isNotNull())
    good = rows.filter(~misfit).select(*[F.col(f.name).cast(f.dataType) for f in typed])
    return good, rows.filter(misfit)


def _misfit(field: StructField) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, BooleanType):
        # A cast would also take "yes", "t" or "1".
        fits = F.lower(value).isin("true", "false")
    else:
        fits = value.try_cast(field.dataType).isNotNull()
    return value.isNotNull() & ~fits


def _csv(spark: SparkSession, line_breaks: bool) -> DataFrameReader:
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", line_breaks)
        # Lines with too few or too many fields show up only if whole lines are parsed.
        .option("columnPruning", False)
    )


def read_raw(spark: SparkSession, base: str, fmt: str = "parquet", line_breaks: bool = False) -> RawTables:
    """``fmt``: ``parquet``, ``csv``, or ``table`` for ``base`` as a catalog schema name.
    ``line_breaks``: CSV files may have some inside quotes."""

    def one(table: str) -> DataFrame:
        if fmt == "table":
            return spark.table(f"{base}.{table}")
        if fmt == "csv":
            return read_csv(spark, f"{base}/{table}.csv", table, line_breaks)
        return spark.read.schema(RAW_SCHEMAS[table]).parquet(f"{base}/{table}.parquet")

    return GivenTables(**{table: one(table) for table in RAW_SCHEMAS})
