from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def choose(branches: Iterable[tuple[Column, object]], default: object) -> Column:
    """First branch whose condition is true. A NULL condition is not true, so NULL input
    ends in ``default``: the business labels rely on that."""
    (first, value), *rest = branches
    chain = reduce(lambda acc, b: acc.when(b[0], b[1]), rest, F.when(first, value))
    return chain.otherwise(default)


def lookup(key: Column, table: Mapping[str, object], default: object = None) -> Column:
    return choose([(key == k, F.lit(v)) for k, v in table.items()], F.lit(default))
