"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Only columns and joins: no Python touches a row. Each step keeps the rows whose key is
held by more than one row, so the classes of equal texts are counted from whole hashes of those
rows only whose length and prefix agree with another row. Marking the rows of a table by their
class is a join on the whole hash, which takes one of every row. The keys of a step are settled first: the planner then knows their size
and decides by it whether they travel to the rows or are joined by shuffle. Counting keys
aggregates before it shuffles, so a group of any size crosses as one row per task.

Texts are equal when they agree after lower-casing A-Z. NULL is the empty text. The row of
the largest id stays; NULL ids rank below all others. Rows that repeat id and text are
copies too: exactly one of them stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import ascii_lower, quoted, shielded, whole, without
from orderloom.session import settle

PREFIX_CHARS = 128
RESULT = ("keep_id", "group_size", "kept")
WORKING = ("_full_hash", "_keep_id", "_keep_rows", "_group_size", "_n")


def text_digest(text):
    """Hex SHA-256 of the normalised text."""
    return F.sha2(ascii_lower(whole(text)), 256)


def duplicate_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """(full_hash, keep_id, keep_rows, group_size) of every text that more than one row holds.

    ``keep_rows`` counts the rows that share the id that stays. Settled.
    """
    text = whole(quoted(text_col))
    rows = docs.select(
        quoted(id_col).alias("id"), text.alias("body"), F.octet_length(text).alias("n_bytes")
    )

    shared = rows.groupBy("n_bytes").count().where("count > 1").select("n_bytes")
    rows = rows.join(settle(shared), "n_bytes", "left_semi")

    prefix = F.xxhash64(ascii_lower(F.substring("body", 1, prefix_chars)))
    rows = rows.withColumn("prefix_hash", prefix)
    keys = ["n_bytes", "prefix_hash"]
    shared = rows.groupBy(*keys).count().where("count > 1").select(*keys)
    rows = rows.join(settle(shared), keys, "left_semi")

    return settle(
        rows.groupBy(text_digest(F.col("body")).alias("full_hash"), "id")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("full_hash")
        .agg(
            F.max("id").alias("keep_id"),
            F.coalesce(F.max_by("n", "id"), F.max("n")).alias("keep_rows"),
            F.sum("n").alias("group_size"),
        )
        .where("group_size > 1")
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """Every row with ``keep_id`` (id of the row that stays), ``group_size`` and ``kept``.

    Input columns of these three names are replaced, all others come back as they are, those
    named like a working column too. An empty table gives an empty table.
    """
    docs, back = shielded(docs, *WORKING)
    classes = duplicate_classes(docs, id_col, text_col, prefix_chars)
    own = without(docs, *RESULT)
    rows = docs.select(*[quoted(c) for c in own], text_digest(quoted(text_col)).alias("_full_hash"))
    marked = rows.join(
        classes.select(
            F.col("full_hash").alias("_full_hash"),
            F.col("keep_id").alias("_keep_id"),
            F.col("keep_rows").alias("_keep_rows"),
            F.col("group_size").alias("_group_size"),
            # Their number follows the corpus: joined by shuffle at every size.
        ).hint("merge"),
        "_full_hash",
        "left",
    )
    alone = F.col("_group_size").isNull()
    stays = alone | quoted(id_col).eqNullSafe(F.col("_keep_id"))

    def result(df: DataFrame, kept) -> DataFrame:
        return df.select(
            *[quoted(c) for c in own],
            F.when(alone, quoted(id_col)).otherwise(F.col("_keep_id")).alias("keep_id"),
            F.coalesce("_group_size", F.lit(1).cast("long")).alias("group_size"),
            kept.alias("kept"),
        )

    # Only rows that repeat the staying id need numbering; all others are decided by the join.
    if classes.where("keep_rows > 1").isEmpty():
        return result(marked, stays).withColumnsRenamed(back)
    repeated = stays & (F.coalesce("_keep_rows", F.lit(1)) > 1)
    number = F.row_number().over(Window.partitionBy("_full_hash").orderBy(F.lit(0)))
    once = result(marked.where(~repeated), stays)
    again = result(marked.where(repeated).withColumn("_n", number), F.col("_n") == 1)
    return once.unionByName(again).withColumnsRenamed(back)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns they came with."""
    marked = exact_dedup(docs, id_col, text_col).where("kept")
    return marked.select(*[quoted(c) for c in without(docs, *RESULT)])
