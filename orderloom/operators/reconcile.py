"""Whether two layers hold the same rows, told by checksums that add up.

Each layer is folded to one row per batch and column: how many values it has, and the sum of
their hashes. Sums do not depend on order or partitioning and are folded before the shuffle, so
the layers are compared by a few rows per batch and never joined row by row. Equal rows have
equal sums; a lost row, a doubled one and a changed value each leave a different trace, in the
batch and column where they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOST, ADDED, CHANGED = "rows lost", "rows added", "values changed"
#: Sums of 64-bit hashes, exact for 10^18 rows.
SUM = "decimal(38,0)"


def _hash(column: str, kind: str) -> Column:
    """Of the value as text, so that a layer's own type does not matter; amounts without trailing zeros."""
    value = F.col(column)
    if kind.startswith("decimal"):
        value = value.cast("decimal(38,6)")
    return F.xxhash64(F.coalesce(value.cast("string"), F.lit("\x00")))


def checksums(df: DataFrame, batch: str, columns: Sequence[str]) -> DataFrame:
    """(batch, column_name, n, checksum): a row per batch and column."""
    kinds = dict(df.dtypes)
    sums = [F.sum(_hash(c, kinds[c]).cast(SUM)).cast(SUM).alias(f"sum {c}") for c in columns]
    folded = df.groupBy(F.col(batch).alias("batch")).agg(F.count(F.lit(1)).alias("n"), *sums)
    each = [F.struct(F.lit(c).alias("column_name"), F.col(f"`sum {c}`").alias("checksum")) for c in columns]
    return folded.select("batch", "n", F.explode(F.array(*each)).alias("c")).select("batch", "c.column_name", "n", "c.checksum")


def differences(expected: DataFrame, found: DataFrame) -> DataFrame:
    """(batch, column_name, expected_rows, found_rows, verdict) wherever two layers' checksums differ.

    NULL batches match. As long as there are batches, however long the layers are.
    """
    e, f = expected.alias("e"), found.alias("f")
    same = F.col("e.batch").eqNullSafe(F.col("f.batch")) & (F.col("e.column_name") == F.col("f.column_name"))
    rows = [F.coalesce(F.col(f"{side}.n"), F.lit(0)) for side in ("e", "f")]
    verdict = F.when(rows[0] > rows[1], LOST).when(rows[0] < rows[1], ADDED).otherwise(CHANGED)
    differ = (rows[0] != rows[1]) | ~F.col("e.checksum").eqNullSafe(F.col("f.checksum"))
    return e.join(f, same, "full_outer").where(differ).select(
        F.coalesce("e.batch", "f.batch").alias("batch"),
        F.coalesce("e.column_name", "f.column_name").alias("column_name"),
        rows[0].alias("expected_rows"),
        rows[1].alias("found_rows"),
        verdict.alias("verdict"),
    )


def located(found: DataFrame) -> DataFrame:
    """One row per batch: rows lost or added, or the columns whose values changed."""
    return found.groupBy("batch").agg(
        (F.max("found_rows") - F.max("expected_rows")).alias("rows_more"),
        F.max("verdict").alias("verdict"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("verdict") == CHANGED, F.col("column_name")))), ", ").alias("changed"),
    )
