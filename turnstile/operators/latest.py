"""Latest version per key."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column], together: Sequence[str] = ()
) -> DataFrame:
    """One row per key, the first in the given order.

    The filter on the rank lets Spark keep one row per key on the map side
    (``WindowGroupLimit``), so a key with very many versions is cut down before
    the exchange. Give a total order: ties would be settled at random.

    together  some of the keys, to bring rows together by: a join on them that
              follows needs no exchange of its own then
    """
    if together:
        df = df.repartition(*together)
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return (
        df.withColumn("_version", F.row_number().over(order))
        .where(F.col("_version") == 1)
        .drop("_version")
    )
