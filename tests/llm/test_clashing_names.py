"""Columns that are named like an operator's working columns come back as they were."""

from __future__ import annotations

import pytest

from orderloom.llm import chosen_path, exact_dedup, interleave, repeats

CASES = {
    "exact_dedup": (exact_dedup.WORKING, exact_dedup.drop_copies),
    "keep_one": (("_own_key", "_id", "_key"), chosen_path.keep_one),
    "repeats": (("_k1", "_k2", "k1", "k2", "_whole_sha256", "_whole_text", "kept_text"), lambda d: repeats.remove_repeats(d, replace_text=True)),
    "interleave": (("_t0", *interleave.WORKING), lambda d: interleave.interleave(d, 3, "_stratum", ["doc_id", "_u"])),
}


@pytest.mark.parametrize("case", CASES)
def test_clashing_columns(spark, case):
    names, operator = CASES[case]
    rows = [(i, f"text of {i} and a few more words {i * 7}", *[f"{n} {i}" for n in names]) for i in range(6)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names])
    left = operator(docs)
    assert set(docs.columns) <= set(left.columns)
    found = {r["doc_id"]: tuple(r[n] for n in names) for r in left.collect()}
    assert found == {r[0]: r[2:] for r in rows}
    assert operator(docs.limit(0)).count() == 0


def test_interleave_against_brute_force(spark):
    """Ranks by the seeded hash within a source, all rows by fractional rank, cut into equal runs."""
    from pyspark.sql import functions as F

    rows = [(i, ["a", "b", None][min(2, i % 10 // 6 + (i % 10 == 9))], i % 13) for i in range(500)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long")
    stratum = interleave._stratum(F.col("source"))
    hashed = frame.select(
        "doc_id",
        stratum.alias("s"),
        F.xxhash64(F.lit(0), "doc_id", "source").alias("u"),
        (F.pmod(F.xxhash64(F.lit(1), stratum), F.lit(1 << 20)) / F.lit(float(1 << 20))).alias("phase"),
    ).collect()
    by_source = {}
    for r in hashed:
        by_source.setdefault(r.s, []).append(r)
    line = []
    for s, held in by_source.items():
        held.sort(key=lambda r: (r.u % (1 << 64), r.doc_id))
        line += [((rank + r.phase) / len(held), s, rank, r.doc_id) for rank, r in enumerate(held)]
    line.sort()
    shards = 7
    expected, first = {}, {}
    for position, (_, _, _, doc_id) in enumerate(line):
        shard = position * shards // len(line)
        first.setdefault(shard, position)
        expected[doc_id] = (shard, position - first[shard])
    found = interleave.interleave(frame, shards, "source", ["doc_id"], per_bucket=20)
    assert {r.doc_id: (r.shard, r.slot) for r in found.collect()} == expected
