"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Sources share a budget of words by weight; a target stops where every document of its source
would be repeated ``most_repeats`` times, and what it cannot take the others share.

Documents of a source fall into blocks by a seeded hash, about ``block_words`` words each. A
source's target is so many passes over all its blocks and, of one more pass, the blocks that
come first in a seeded order; the last of them is taken in part, the document at its edge
too, so that a source gives its target to the word. Every (pass, block) is a draw.

Draws are dealt to the output shards by a tree: a node holds, of every source, how many draws
fall to its shards, and draws the left half's counts from the multivariate hypergeometric
distribution. All draws of a node's number are as likely as if one urn of all draws had been
shuffled, yet a shard finds its counts from the seed alone, walking from the root to its leaf.
A source's draws, in another seeded order, are cut by these counts: shards get disjoint draws
and shuffle the documents of theirs among themselves.

The driver holds a row per source (at most ``MOST_SOURCES``; more is an error). Blocks grow
with the corpus once there are ``MOST_BLOCKS`` of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.common import quoted, without
from orderloom.session import settle

MOST_SOURCES = 100_000
MOST_BLOCKS = 1 << 20
BLOCK_WORDS = 4_096
BLOCK_ROWS = 4_096
HASH_BITS = 40
RESULT = ("source_size", "target", "taken", "draws")


@dataclass(frozen=True)
class Source:
    """What the mixture knows of a source. ``words`` are taken in all, ``rest`` of them in the last pass."""

    name: str | None
    size: int
    rows: int
    target: Fraction
    blocks: int

    @property
    def words(self) -> int:
        return (2 * self.target.numerator + self.target.denominator) // (2 * self.target.denominator)

    @property
    def passes(self) -> int:
        return self.words // self.size if self.size else 0

    @property
    def rest(self) -> int:
        return self.words - self.passes * self.size


def seeded(seed: int, *columns: Column) -> Column:
    """``HASH_BITS`` bits of an MD5 over the seed and the columns; NULL is empty."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def shares(sizes: Sequence[int], weights: Sequence[Fraction], budget: Fraction, most_repeats: int) -> list[Fraction]:
    """The budget by weight; nobody gets more than ``most_repeats`` sizes, and others share what is left over."""
    target = [Fraction(0)] * len(sizes)
    open_, left = [i for i, w in enumerate(weights) if w > 0], Fraction(budget)
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] > most_repeats * sizes[i] * total]
        if not full:
            for i in open_:
                target[i] = left * weights[i] / total
            break
        for i in full:
            target[i] = Fraction(most_repeats * sizes[i])
        left -= sum(target[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return target


def sources_of(
    rows: DataFrame, weights: Sequence[int] | Mapping[str | None, int], budget: Fraction, most_repeats: int, block_words: int
) -> list[Source]:
    """The sources in code-point order, NULL last, with their targets. ``rows`` have (source, size)."""
    counted = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    found = [(r["source"], r["size"], r["rows"]) for r in counted.limit(MOST_SOURCES + 1).collect()]
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    found.sort(key=lambda s: (s[0] is None, (s[0] or "").encode()))
    if isinstance(weights, Mapping):
        given = [Fraction(weights.get(name, 0)) for name, _, _ in found]
    else:
        given = [Fraction(weights[i % len(weights)]) for i in range(len(found))]
    total, all_rows = sum(s for _, s, _ in found), sum(n for _, _, n in found)
    words_a_block = max(block_words, -(-total // MOST_BLOCKS))
    rows_a_block = max(BLOCK_ROWS, -(-all_rows // MOST_BLOCKS))
    targets = shares([s for _, s, _ in found], given, budget * total, most_repeats)
    return [
        Source(name, size, n, target, max(1, -(-size // words_a_block), -(-n // rows_a_block)))
        for (name, size, n), target in zip(found, targets, strict=True)
    ]


def leaf_counts(quotas: np.ndarray, shards: int, shard: int, seed: int) -> np.ndarray:
    """Draws of every source that fall to ``shard``: from the root to its leaf, halving the shards."""
    total, low, high = int(quotas.sum()), 0, shards
    held = quotas
    while high - low > 1:
        middle = (low + high) // 2
        n_left = total * middle // shards - total * low // shards
        random = np.random.Generator(np.random.PCG64([seed, low, high]))
        left = random.multivariate_hypergeometric(held, n_left, method="marginals")
        if shard < middle:
            held, high = left, middle
        else:
            held, low = held - left, middle
    return held


def _shard_ranges(spark: SparkSession, quotas: list[int], shards: int, seed: int) -> DataFrame:
    """(source_no, shard, low, high): the ranks, in its source's seeded order, of the draws a shard gets."""

    def walk(batches):
        held = np.array(quotas, np.int64)
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                counts = leaf_counts(held, shards, shard, seed)
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at.astype(np.int64)), pa.array(np.full(len(at), shard, np.int64)), pa.array(counts[at])],
                    names=["source_no", "shard", "n"],
                )

    counts = spark.range(shards).mapInArrow(walk, "source_no long, shard long, n long")
    up_to = F.sum("n").over(Window.partitionBy("source_no").orderBy("shard"))
    return counts.select("source_no", F.col("shard").cast("int").alias("shard"), (up_to - F.col("n")).alias("low"), up_to.alias("high"))


def mix(
    docs: DataFrame,
    shards: int,
    weights: Sequence[int] | Mapping[str | None, int],
    budget: Fraction = Fraction(3, 2),
    most_repeats: int = 2,
    source_col: str = "source",
    size_col: str = "size",
    order_cols: Sequence[str] = ("doc_id",),
    seed: int = 0,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Every row with its source's ``source_size`` and ``target``, the words ``taken`` of it, and its ``draws``.

    ``weights`` go round the sources in code-point order, NULL last, or are named. ``budget`` is
    a multiple of all sizes. A draw is (pass, shard, words): an appearance in a shard's output.
    ``order_cols`` make reruns agree: rows that agree in all of them are interchangeable.
    NULL sources are a source, NULL sizes are 0; a source of size 0 has target 0. Input
    columns named like a result are replaced. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    own = without(docs, *RESULT)
    base = settle(
        docs.select(
            F.struct(*[quoted(c) for c in own]).alias("row"),
            quoted(source_col).cast("string").alias("source"),
            F.coalesce(quoted(size_col), F.lit(0)).cast("long").alias("size"),
            seeded(seed, *[quoted(c) for c in order_cols]).alias("u"),
            F.struct(*[quoted(c) for c in order_cols]).alias("ties"),
        )
    )
    sources = sources_of(base, weights, Fraction(budget), most_repeats, block_words)
    known = spark.createDataFrame(
        [(i, s.name, s.size, float(s.target), s.blocks, s.passes, s.rest) for i, s in enumerate(sources)],
        "source_no long, name string, source_size long, target double, n_blocks long, passes long, rest long",
    )
    # A row per source: bounded by MOST_SOURCES.
    base = base.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("name"))).withColumn(
        "block", F.shiftright(F.col("u") * F.col("n_blocks"), HASH_BITS)
    )

    # The blocks of the last pass, in a seeded order: whole, in part, or not at all.
    in_source = Window.partitionBy("source_no")
    before = F.sum("words").over(in_source.orderBy("turn", "block")) - F.col("words")
    blocks = settle(
        base.groupBy("source_no", "block")
        .agg(F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("passes").alias("passes"))
        .withColumn("turn", seeded(seed + 1, F.col("source_no"), F.col("block")))
        .withColumn("wanted", F.least(F.greatest(F.col("rest") - before, F.lit(0)), F.col("words")))
    )
    in_part = (F.col("wanted") > 0) & (F.col("wanted") < F.col("words"))
    n_passes = F.col("passes") + F.when(F.col("wanted") > 0, 1).otherwise(0)
    draws = blocks.withColumn("pass", F.explode(F.sequence(F.lit(1), n_passes))).where(n_passes > 0)
    order = in_source.orderBy(seeded(seed + 2, F.col("source_no"), F.col("block"), F.col("pass")), "block", "pass")
    draws = settle(draws.select("source_no", "block", "pass", (F.row_number().over(order) - 1).cast("long").alias("rank")))

    quotas = [0] * len(sources)
    for r in draws.groupBy("source_no").count().collect():
        quotas[r["source_no"]] = r["count"]
    ranges = settle(_shard_ranges(spark, quotas, shards, seed))
    dealt = (
        draws.join(ranges, "source_no")
        .where((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
        .groupBy("source_no", "block")
        # One entry for each time a block is taken: at most most_repeats, and one.
        .agg(F.sort_array(F.collect_list(F.struct(F.col("pass"), F.col("shard")))).alias("dealt"))
    )

    # Blocks taken in part: one per source at most, so they fit a broadcast.
    edges = F.broadcast(blocks.where(in_part).select("source_no", "block", "wanted"))
    line = Window.partitionBy("source_no", "block").orderBy("u", "ties").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("size").over(line), F.lit(0))
    cut = base.join(edges, ["source_no", "block"]).withColumn(
        "last_words", F.least(F.greatest(F.col("wanted") - earlier, F.lit(0)), F.col("size"))
    )
    rest = base.join(edges, ["source_no", "block"], "left_anti").withColumn("last_words", F.col("size"))
    rows = rest.unionByName(cut.drop("wanted")).join(dealt, ["source_no", "block"], "left")
    last = F.col("passes") + 1
    each = F.transform(
        F.coalesce("dealt", F.array().cast("array<struct<pass:long,shard:int>>")),
        lambda d: F.struct(
            d["pass"].cast("int").alias("pass"),
            d["shard"].alias("shard"),
            F.when(d["pass"] == last, F.col("last_words")).otherwise(F.col("size")).alias("words"),
        ),
    )
    given = F.filter(each, lambda d: (d["words"] > 0) | (F.col("size") == 0))
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"])
    return rows.select("row.*", "source_size", "target", given.alias("draws")).select(
        *[quoted(c) for c in own], "source_size", "target", taken.alias("taken"), "draws"
    )


def appearances(mixed: DataFrame, order_cols: Sequence[str] = ("doc_id",), seed: int = 0) -> DataFrame:
    """A row for every draw, with ``pass``, ``shard``, ``words`` and the ``place`` of its shuffle in the shard."""
    own = without(mixed, "draws", "pass", "shard", "words", "place")
    each = mixed.select(*[quoted(c) for c in own], F.explode("draws").alias("draw")).select(*[quoted(c) for c in own], "draw.*")
    keys = [quoted(c) for c in order_cols]
    return each.withColumn("place", seeded(seed + 3, F.col("shard"), F.col("pass"), *keys))


def write_mix(mixed: DataFrame, path: str, order_cols: Sequence[str] = ("doc_id",), seed: int = 0) -> None:
    """One folder per shard; inside, documents in shuffled order over files of bounded size."""
    rows = appearances(mixed, order_cols, seed)
    dealt = rows.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place")
    dealt.write.partitionBy("shard").parquet(path)


ORACLE_SQL = f"""
WITH docs AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
        ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, {HASH_BITS // 4}))::BIGINT AS u,
        md5(coalesce(text, '')) AS digest
    FROM documents),
sources AS (
    SELECT *, [3, 1, 2][(source_no % 3 + 1)::INT] AS weight
    FROM (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_rows,
        row_number() OVER (ORDER BY source IS NULL, encode(coalesce(source, ''))) - 1 AS source_no FROM docs GROUP BY source)),
ranked AS (
    SELECT *, sum(source_size) OVER () AS total, sum(2 * source_size) OVER o - 2 * source_size AS above,
        sum(weight) OVER () - sum(weight) OVER o + weight AS weights
    FROM sources WINDOW o AS (ORDER BY source_size::DOUBLE / weight, source_no ROWS UNBOUNDED PRECEDING)),
flagged AS (
    SELECT *, (3 * total - 2 * above) * weight > 4 * source_size * weights AS full_ FROM ranked),
level AS (
    SELECT sum(weight) FILTER (WHERE NOT full_) AS weights, max(3 * total) - sum(4 * source_size) FILTER (WHERE full_) AS part,
        max(3 * total) AS whole_ FROM flagged),
targets AS (
    SELECT source, source_no, source_size,
        CASE WHEN full_ THEN 4 * source_size ELSE coalesce(part, whole_) * weight END::BIGINT AS num,
        CASE WHEN full_ THEN 2 ELSE 2 * l.weights END::BIGINT AS den,
        greatest(1, (source_size + b - 1) // b, (n_rows + r - 1) // r)::BIGINT AS n_blocks
    FROM flagged, level l,
        (SELECT greatest({BLOCK_WORDS}, (sum(source_size) + {MOST_BLOCKS - 1}) // {MOST_BLOCKS}) AS b,
            greatest({BLOCK_ROWS}, (sum(n_rows) + {MOST_BLOCKS - 1}) // {MOST_BLOCKS}) AS r FROM sources)),
passes AS (
    SELECT *, coalesce(words // nullif(source_size, 0), 0) AS passes, words - coalesce(words // nullif(source_size, 0), 0) * source_size AS rest
    FROM (SELECT *, (2 * num + den) // (2 * den) AS words FROM targets)),
placed AS (
    SELECT d.*, p.source_no, p.source_size, p.num::DOUBLE / p.den::DOUBLE AS target, p.passes, p.rest, (u * n_blocks) >> {HASH_BITS} AS block
    FROM docs d JOIN passes p ON d.source IS NOT DISTINCT FROM p.source),
blocks AS (
    SELECT *, sum(words) OVER (PARTITION BY source_no ORDER BY turn, block) - words AS before
    FROM (SELECT source_no, block, sum(size) AS words, any_value(rest) AS rest,
        ('0x' || substr(md5('1:' || source_no || ':' || block), 1, {HASH_BITS // 4}))::BIGINT AS turn FROM placed GROUP BY 1, 2)),
lined AS (
    SELECT p.*, least(greatest(b.rest - b.before, 0), b.words) AS wanted, b.words AS block_words,
        coalesce(sum(size) OVER (PARTITION BY p.source_no, p.block ORDER BY u, doc_id NULLS FIRST, digest
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
    FROM placed p JOIN blocks b USING (source_no, block))
SELECT doc_id, size, source_size, target,
    (passes * size + CASE WHEN wanted = block_words THEN size ELSE least(greatest(wanted - earlier, 0), size) END)::BIGINT AS taken
FROM lined
"""
