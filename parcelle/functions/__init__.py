"""functions package."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def rnd(col: "str | Column", d: int = 2) -> Column:
    """Round to ``d`` decimals as scale -> round half away from zero -> unscale.

    Used on reported doubles so that the SQL oracle (same three IEEE steps)
    gives bit-identical values."""
    c = F.col(col) if isinstance(col, str) else col
    scale = float(10 ** d)
    v = F.round(c.cast("double") * F.lit(scale)) / F.lit(scale)
    return F.when(v == 0, F.lit(0.0)).otherwise(v)
