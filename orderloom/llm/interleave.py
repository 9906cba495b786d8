"""Proportional stratified interleaving into shards.

Rows of a source are shuffled by a seeded hash and ranked; a row's fractional rank is its
rank over the size of its source, shifted by a phase of the source; all rows sorted by
fractional rank are cut into equal runs. Any stretch of fractions holds of every source its
share, to within one row, so every shard matches the mixture but for the few rows by which
rows of very small sources fall unevenly. Shard sizes differ by one row at most.

Nothing ranks a source in one task: a rank is the number of rows in earlier hash buckets
(counted, then summed over buckets) plus the place inside the bucket. The hash spreads a
source evenly, so a bucket has about ``per_bucket`` rows however large its source is; the
phase spreads small sources over the whole range as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import bits_for, quoted, shielded, whole
from orderloom.session import settle

ROWS_PER_BUCKET = 1_000
#: Beyond this many buckets each takes more rows: one task sums over all of them.
MOST_BUCKET_BITS = 20
WORKING = ("_stratum", "_u", "_bucket", "_size", "_rank", "_fraction", "_slice", "_position", "_shard", "before", "n")


def _stratum(column: Column) -> Column:
    """NULL is a stratum of its own."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), text))


def _preceding(counts: DataFrame, bucket: str, within: list[str]) -> DataFrame:
    """Adds ``before``: rows in earlier buckets."""
    order = Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))


def interleave(
    rows: DataFrame,
    shards: int,
    source_col: str,
    order_cols: list[str],
    seed: int = 0,
    per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Adds ``shard`` (int) and ``slot`` (long, gapless from 0 in a shard) to every row.

    ``order_cols`` make the order repeatable: rows that agree in all of them are
    interchangeable. Input columns named ``shard`` or ``slot`` are replaced, those named like a
    working column come back as they are. NULLs in any column are values like others. No rows
    give no rows.
    """
    rows, back = shielded(rows, *WORKING, *[f"_t{i}" for i in range(len(order_cols))])
    away = {v: k for k, v in back.items()}
    order_cols, source_col = [away.get(c, c) for c in order_cols], away.get(source_col, source_col)
    names = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    ties = [f"_t{i}" for i in range(len(order_cols))]
    seeded = F.xxhash64(F.lit(seed), *[quoted(c) for c in order_cols], quoted(source_col))
    base = settle(
        rows.select(
            *[quoted(c) for c in names],
            _stratum(quoted(source_col)).alias("_stratum"),
            seeded.alias("_u"),
            *[quoted(c).alias(t) for c, t in zip(order_cols, ties, strict=True)],
        )
    )
    total = base.count()
    bits = min(bits_for(total, per_bucket), MOST_BUCKET_BITS)
    top = F.shiftrightunsigned("_u", 64 - bits) if bits else F.lit(0).cast("long")
    base = base.withColumn("_bucket", top)

    counts = base.groupBy("_stratum", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy("_stratum").agg(F.sum("n").alias("_size"))
    offsets = _preceding(counts, "_bucket", ["_stratum"]).drop("n").join(sizes, "_stratum")
    place = Window.partitionBy("_stratum", "_bucket").orderBy("_u", *ties)
    ranked = base.join(settle(offsets), ["_stratum", "_bucket"]).withColumn(
        "_rank", F.col("before") + F.row_number().over(place) - 1
    )

    phase = F.pmod(F.xxhash64(F.lit(seed + 1), "_stratum"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    fraction = (F.col("_rank") + phase) / F.col("_size")
    ranked = ranked.withColumn("_fraction", fraction).withColumn(
        "_slice", F.floor(F.col("_fraction") * F.lit(1 << bits)).cast("long")
    )
    ranked = settle(ranked.drop("before", "_bucket", "_size"))
    starts = _preceding(ranked.groupBy("_slice").agg(F.count(F.lit(1)).alias("n")), "_slice", [])
    line = Window.partitionBy("_slice").orderBy("_fraction", "_stratum", "_rank")
    position = F.col("before") + F.row_number().over(line) - 1

    n, k = F.lit(max(total, 1)), F.lit(shards)
    shard = F.expr(f"_position * {shards} div {max(total, 1)}")
    first = F.ceil(F.col("_shard") * n / k).cast("long")
    return (
        ranked.join(settle(starts.drop("n")), "_slice")
        .withColumn("_position", position)
        .withColumn("_shard", shard)
        .select(
            *[quoted(c) for c in names],
            F.col("_shard").cast("int").alias("shard"),
            (F.col("_position") - first).cast("long").alias("slot"),
        )
        .withColumnsRenamed(back)
    )


def text_size(text: Column) -> Column:
    """Bytes of the text in UTF-8 plus one."""
    return (F.octet_length(whole(text)) + 1).cast("long")


def write_shards(rows: DataFrame, path: str) -> None:
    """One folder per shard, each sorted by slot; ``rows`` come from ``interleave``."""
    ordered = rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)
