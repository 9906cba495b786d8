"""Small helpers the operators share."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import configure

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A word is a run of anything but space and the controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


#: Of what workers get at a time, so that long texts do not add up.
BATCH_BYTES = 8 << 20
#: Of the text that a worker takes apart at a time: words as objects take ten times their bytes.
SLICE_BYTES = 1 << 20


def bounded(spark: SparkSession) -> SparkSession:
    """The required settings, and the bound on what workers get at a time."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def sliced(batch: pa.RecordBatch, text_at: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in order, in slices of about ``most`` bytes of text; a longer text is a slice by itself."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    slices = (np.cumsum(sizes) - sizes) // most
    edges = [0, *(np.flatnonzero(np.diff(slices)) + 1).tolist(), len(sizes)]
    for start, stop in zip(edges[:-1], edges[1:], strict=True):
        if stop > start:
            yield batch.slice(start, stop - start)


def whole(text: str | Column) -> Column:
    """The text, NULL as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else, whatever the language."""
    return F.translate(text, UPPER, UPPER.lower())


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id written as text, modulo ``folds``; no id is the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds))


def without(df: DataFrame, *names: str) -> list[str]:
    """The columns whose names an operator does not need for its own results."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def shielded(df: DataFrame, *reserved: str) -> tuple[DataFrame, dict[str, str]]:
    """The frame with columns named like an operator's own working columns renamed, and how to name them back."""
    taken = {n.lower() for n in reserved}
    away = {c: f"{c} (input)" for c in df.columns if c.lower() in taken}
    return df.withColumnsRenamed(away), {v: k for k, v in away.items()}


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def bits_for(rows: int, per_bucket: int) -> int:
    """Bits that cut ``rows`` evenly spread rows into buckets of about ``per_bucket``."""
    return max(0, math.ceil(math.log2(max(1, rows / per_bucket))))
