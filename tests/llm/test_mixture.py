from __future__ import annotations

import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import mixture

ROWS = "doc_id long, source string, size long, target string, shard string"


def make(spark, rows):
    return spark.createDataFrame([(d, s, n, "t", "s") for d, s, n in rows], ROWS)


def corpus(n=3000, seed=1):
    rng = random.Random(seed)
    return [(i, rng.choice(["a"] * 10 + ["b", "b", "c", None, "d"]), rng.randrange(1, 300) if i % 97 else 9_000) for i in range(n)]


def plain_targets(sizes, weights, budget, most):
    """By the wording: share, stop at the limit, share what is left over, until nobody is above."""
    target = [budget * w / sum(weights) for w in weights]
    stopped = set()
    while True:
        above = [i for i, t in enumerate(target) if t > most * sizes[i]]
        if not above:
            return target
        excess = sum(target[i] - most * sizes[i] for i in above)
        for i in above:
            target[i] = Fraction(most * sizes[i])
            stopped.add(i)
        free = [i for i in range(len(sizes)) if i not in stopped]
        for i in free:
            target[i] += excess * weights[i] / sum(weights[j] for j in free)


def test_shares():
    rng = random.Random(5)
    for _ in range(200):
        sizes = [rng.randrange(0, 1000) for _ in range(rng.randrange(1, 9))]
        weights = [Fraction(rng.randrange(1, 5)) for _ in sizes]
        budget = Fraction(3, 2) * sum(sizes)
        found = mixture.shares(sizes, weights, budget, 2)
        assert found == plain_targets(sizes, weights, budget, 2)
        assert sum(found) == budget and all(t <= 2 * s for t, s in zip(found, sizes, strict=True))


def test_every_source_meets_its_target(spark):
    rows = corpus()
    mixed = mixture.mix(make(spark, rows), 8, (3, 1, 2), block_words=512)
    assert mixed.columns == ["doc_id", "source", "size", "shard", "source_size", "target", "taken", "draws"]
    found = mixed.collect()
    assert sorted(r.doc_id for r in found) == [r[0] for r in rows]
    taken, sizes, targets = Counter(), Counter(), {}
    edges = Counter()
    for r in found:
        taken[r.source] += r.taken
        sizes[r.source] += r.size
        targets[r.source] = r.target
        assert r.taken == sum(d.words for d in r.draws) and 0 <= r.taken <= 2 * r.size
        assert len({d["pass"] for d in r.draws}) == len(r.draws) <= 2
        edges[r.source] += r.taken % r.size != 0
    names = ["a", "b", "c", "d", None]
    expected = plain_targets([sizes[s] for s in names], [3, 1, 2, 3, 1], Fraction(3, 2) * sum(sizes.values()), 2)
    for name, target in zip(names, expected, strict=True):
        assert targets[name] == float(target) and abs(taken[name] - target) <= 0.5
        assert {r.source_size for r in found if r.source == name} == {sizes[name]}
        assert edges[name] <= 1  # only the document at the edge is taken in part
    again = mixture.mix(make(spark, rows[::-1]).repartition(7), 8, (3, 1, 2), block_words=512)
    assert sorted(map(str, again.collect())) == sorted(map(str, found))


def test_shards_hold_the_mixture(spark):
    rows = corpus()
    mixed = mixture.mix(make(spark, rows), 4, (3, 1, 2), block_words=512)
    each = mixture.appearances(mixed)
    per_shard = {r["shard"]: r for r in each.groupBy("shard").agg(F.sum("words").alias("w"), F.count_if(F.col("source") == "a").alias("a")).collect()}
    assert set(per_shard) == {0, 1, 2, 3}
    words = [r["w"] for r in per_shard.values()]
    assert max(words) < 1.25 * min(words)
    assert max(r["a"] for r in per_shard.values()) < 1.6 * min(r["a"] for r in per_shard.values())
    # Nothing is drawn twice: a document of one pass is in one shard.
    assert each.groupBy("doc_id", "pass").count().where("count > 1").count() == 0
    assert sum(words) == mixed.agg(F.sum("taken")).first()[0]


def test_written_shards(spark, tmp_path):
    mixed = mixture.mix(make(spark, corpus(300)), 3, {"a": 1, "b": 2}, block_words=64)
    mixture.write_mix(mixed, str(tmp_path / "mix"))
    back = spark.read.parquet(str(tmp_path / "mix"))
    assert {r["shard"] for r in back.select("shard").distinct().collect()} == {0, 1, 2}
    assert {r["source"] for r in back.select("source").distinct().collect()} == {"a", "b"}  # no weight, nothing taken
    assert back.agg(F.sum("words")).first()[0] == mixed.agg(F.sum("taken")).first()[0]


@pytest.mark.parametrize("shards", [1, 2, 5, 8])
def test_leaves_of_the_tree_add_up(shards):
    quotas = np.array([40, 0, 7, 300, 1])
    leaves = np.array([mixture.leaf_counts(quotas, shards, s, seed=9) for s in range(shards)])
    assert (leaves.sum(0) == quotas).all() and (leaves >= 0).all()
    sums = leaves.sum(1)
    assert sums.max() - sums.min() <= 1
    assert (leaves == [mixture.leaf_counts(quotas, shards, s, seed=9) for s in range(shards)]).all()


def test_counts_are_hypergeometric():
    """Mean and variance of a shard's count of one source over many seeds."""
    quotas, shards = np.array([30, 70]), 4
    drawn = np.array([mixture.leaf_counts(quotas, shards, 2, seed)[0] for seed in range(3000)])
    assert abs(drawn.mean() - 7.5) < 0.15
    assert abs(drawn.var() - 25 * 0.3 * 0.7 * 75 / 99) < 0.35


def test_odd_rows(spark):
    rows = [(None, None, None), (None, None, None), (1, None, 0), (1, "x", 5), (1, "x", 5), (2, "", 7), (3, "x", 1_000_000), (4, "only empty", None)]
    found = mixture.mix(make(spark, rows), 3, (3, 1, 2), order_cols=["doc_id", "size"]).collect()
    assert len(found) == len(rows) and all(r.taken <= 2 * (r.size or 0) for r in found)
    per_source = Counter()
    for r in found:
        per_source[r.source] += r.taken
    assert all(abs(per_source[r.source] - r.target) <= 0.5 for r in found)
    assert mixture.mix(make(spark, []), 3, (3, 1, 2)).count() == 0
