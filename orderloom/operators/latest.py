"""Keep the newest row of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``newest_first`` order.

    The rank filter lets Spark cut every input partition to one row per key before
    the shuffle, so a key that holds most of the rows arrives as one row per task.
    """
    ranking = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(ranking)).where("_rank = 1").drop("_rank")


def latest_landed(raw: DataFrame, key: str) -> DataFrame:
    """The newest landed version of each business key.

    The source's own time decides, the load time where the source gives none. Equal
    times are settled by load time and then the row's content: reruns agree.
    """
    settled = ("source_updated_at", "ingested_at", "batch_date", key)
    content = [c for c in raw.columns if c not in settled]
    return latest_by_key(
        raw,
        [key],
        [
            F.coalesce("source_updated_at", "ingested_at").desc_nulls_first(),
            F.col("ingested_at").desc_nulls_last(),
            *[F.col(c).desc_nulls_last() for c in content],
        ],
    )


def latest_staged(staged: DataFrame, key: str) -> DataFrame:
    """The version of each key staged last, then that of the latest batch."""
    return latest_by_key(
        staged,
        [key],
        [F.col("loaded_at").desc_nulls_first(), F.col("batch_date").desc_nulls_first()],
    )
