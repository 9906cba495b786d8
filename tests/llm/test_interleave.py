from __future__ import annotations

from collections import Counter

import pytest

from orderloom.llm import interleave


@pytest.mark.parametrize("per_bucket", [7, 100_000])
def test_shards_are_even_gapless_and_match_the_mixture(documents, per_bucket):
    sources = ["hot"] * 300 + ["b"] * 81 + ["c"] * 20 + [None] * 40 + [f"single{i}" for i in range(20)]
    docs = documents([(i, f"text {i}", None, s) for i, s in enumerate(sources)])
    found = interleave.interleave(docs, 8, "source", ["doc_id"], per_bucket=per_bucket).collect()
    assert sorted(r.doc_id for r in found) == list(range(len(sources)))
    sizes = Counter(r["shard"] for r in found)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, size in sizes.items():
        assert sorted(r.slot for r in found if r["shard"] == shard) == list(range(size))
    mixture = Counter((r["shard"], r.source) for r in found)
    for source in ("hot", "b", "c", None):
        share = sources.count(source) / 8
        assert all(abs(mixture[shard, source] - share) <= 4 for shard in range(8))


def test_repeatable_and_seeded(documents, odd_rows):
    docs = documents(odd_rows)

    def order(seed):
        made = interleave.interleave(docs, 3, "source", ["doc_id", "text"], seed=seed).collect()
        return sorted((r["shard"], r.slot, str(r.doc_id), str(r.text)) for r in made)

    assert order(0) == order(0)
    assert len(order(0)) == len(odd_rows) and order(0) != order(5)


def test_empty_table(documents):
    assert interleave.interleave(documents([]), 8, "source", ["doc_id"]).count() == 0


def test_written_shards(spark, documents, tmp_path):
    made = interleave.interleave(documents([(i, "t", None, "s") for i in range(20)]), 4, "source", ["doc_id"])
    interleave.write_shards(made, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert Counter(r["shard"] for r in back.collect()) == {s: 5 for s in range(4)}
