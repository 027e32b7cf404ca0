from pyspark.sql import functions as F

from coverloom.llm.common import settle
from coverloom.session import SHUFFLES_GO


def test_a_settled_step_lets_its_shuffle_files_go(spark):
    before = spark.conf.get(SHUFFLES_GO)
    try:
        spark.conf.set(SHUFFLES_GO, "false")
        found = settle(spark.range(5000).groupBy((F.col("id") % 7).alias("k")).count(), "settled")
        assert spark.conf.get(SHUFFLES_GO) == "true"
        assert found.count() == 7 and found.agg(F.sum("count")).first()[0] == 5000
    finally:
        spark.conf.set(SHUFFLES_GO, before)
