from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from orderloom.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string, path string, place string"


def make(spark, rows):
    return spark.createDataFrame([(*r, "p", "q") for r in rows], TURNS)


def rebuilt_plainly(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}:{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, role, digest, text))
    own = {c: [(r, t) for _, _, r, _, t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def plain_trie(conversations):
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    sums = {}
    for path in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        below = [sums[c] for c in children[path]]
        sums[path] = ((sum(b[0] for b in below) or 1), (len(members[path]) - 1) * words + sum(b[1] for b in below))
    rows = []
    for path, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if len(conversations[c]) == len(path))
        rows.append(
            (min(held), len(path), min(members[path[:-1]]) if path else None, len(held), len(children[path]), *sums[path], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(rows, key=repr)


def found(frame, shard_ids=prefix_trie.SHARD_IDS):
    result = prefix_trie.trie(prefix_trie.with_shared_heads(prefix_trie.turns_of(frame)), shard_ids).drop("path", "parent")
    return sorted([tuple(r) for r in result.collect()], key=repr)


def conversations(n=90, seed=2):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), n):
        opening = ["hello there", "hello", " ", ""][c % 4]
        for turn in range(rng.choice([1, 1, 2, 4, 7])):
            text = opening if turn == 0 else rng.choice(["yes", "no  way", None, "a b c", opening])
            rows.append((c, turn, ["user", "assistant"][turn % 2], text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_ids", [7, 100, 1000])
def test_against_brute_force(spark, shard_ids):
    rows = conversations()
    assert found(make(spark, rows), shard_ids) == plain_trie(rebuilt_plainly(rows))


def test_a_prefix_that_all_share_and_deep_chains(spark):
    rows = [(c, t, "user", f"line {t} of all") for c in range(0, 60) for t in range(40 + c % 3)]
    rows += [(1000, t, "user", "x" if t % 2 else None) for t in range(700)]
    assert found(make(spark, rows), 10) == plain_trie(rebuilt_plainly(rows))


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "of no conversation"), (1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "b"), (1, 0, "assistant", "b"),
        (20, 5, "user", "w " * 50_000), (21, 0, "user", ""), (22, 0, "", ""), (23, None, None, None), (23, None, "a:1", "x"), (23, None, "a", "1:x"),
        (-3, 0, "user", "b"), (2**62, 1, "user", "big"), (40, 0, "user", "b"), (44, 1, "user", "b"),
        *[(c, 0, "user", "alone") for c in range(61, 70)],
    ]
    expected = rebuilt_plainly([r for r in rows if r[0] is None or r[0] >= 0])
    assert found(make(spark, [r for r in rows if r[0] is None or r[0] >= 0])) == plain_trie(expected)
    assert any(not turns for turns in expected.values())  # a conversation left without a turn
    assert len(found(make(spark, rows))) > 0
    assert found(make(spark, [])) == []


def test_shard_bitmaps():
    shard = prefix_trie.Shard([(5, ["a", "b"], [1, 1]), (7, ["a"], [1]), (9, ["c"], [2]), (11, [], [])])
    assert shard.postings[0, "a"] == 0b0011 and shard.ended == {2: 0b0001, 1: 0b0110, 0: 0b1000}
    nodes = {(depth, first): (n, ends) for _, _, depth, _, first, n, ends in shard.nodes()}
    assert nodes == {(0, 5): (4, "11"), (1, 5): (2, "7"), (2, 5): (1, "5"), (1, 9): (1, "9")}
