"""What the operators share: intermediate tables, the word rule, stable row keys."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coverloom.session import SHUFFLES_GO, written_once

# A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors' Python workers this package, once per application."""
    context = spark.sparkContext
    if not getattr(context, "coverloom_shipped", False):
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="coverloom-")) / "coverloom.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as packed:
            for file in sorted(package.rglob("*.py")):
                packed.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        context.coverloom_shipped = True
    return spark


def settle(frame: DataFrame, purpose: str) -> DataFrame:
    """Write a frame below ``spark.checkpoint.dir`` and read it back: it is computed once,
    and a lost executor costs a read instead of a recomputation. What it has shuffled goes when
    it is written, so the shuffles of an operator's steps do not add up on disk."""
    frame.sparkSession.conf.set(SHUFFLES_GO, "true")
    return written_once(frame, purpose)


def text_of(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def id_text(column: str = "doc_id") -> Column:
    """The id as text, null as empty: only for hashing."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
