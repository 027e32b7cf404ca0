from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Unicode calls white space. Spark's trim() strips U+0020 only.
WHITE_SPACE = "".join(
    chr(point)
    for point in (
        *range(0x0009, 0x000E), 0x0020, 0x0085, 0x00A0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
        0x205F, 0x3000,
    )
)


def strip_space(text: Column) -> Column:
    """Strip white space of every kind from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))
