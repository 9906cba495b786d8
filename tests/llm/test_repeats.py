from __future__ import annotations

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from orderloom.llm import repeats


def brute(texts, length):
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        covered = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        kept = bytes(b for b, c in zip(t, covered, strict=True) if not c)
        spans = sum(c and not (i and covered[i - 1]) for i, c in enumerate(covered))
        out.append((len(t), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcd é") for _ in range(300)) for _ in range(6)]
    texts = []
    for _ in range(100):
        text = ""
        for _ in range(rng.randrange(1, 5)):
            a = rng.randrange(250)
            text += rng.choice(base)[a : rng.randrange(a, 300)] if rng.random() < 0.7 else "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60)))
        texts.append(text)
    return [*texts, "", "a" * 500, "xy" * 100, texts[3], texts[3], "a" * 39, "b" * 40, None]


@pytest.mark.parametrize("most_together", [repeats.MOST_TOGETHER, 1])
def test_against_brute_force(documents, most_together):
    texts = corpus(5)
    docs = documents(list(enumerate(texts)))
    found = repeats.remove_repeats(docs, shape=repeats.Shape(40, 10), most_together=most_together).collect()
    got = [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sorted(found, key=lambda r: r.doc_id)]
    assert got == brute([(t or "").encode() for t in texts], 40)


def test_long_texts_are_cut_into_segments_without_a_trace(monkeypatch):
    texts = [(t or "").encode() for t in corpus(6)]
    shape = repeats.Shape(40, 10)

    def anchors():
        hashes = repeats.Hashes(1)
        return sorted((int(t), int(p), int(g), int(c)) for part in repeats.anchors_of(texts, shape, hashes) for t, p, g, c in zip(*part, strict=True))

    whole = anchors()
    monkeypatch.setattr(repeats, "SEGMENT", 37)
    assert anchors() == whole and len(set(whole)) == len(whole)


def test_memory_of_hashing_is_bounded_whatever_the_text():
    rng = np.random.default_rng(3)
    texts = [rng.integers(97, 123, size, np.uint8).tobytes() for size in (6_000_000, *[3_000] * 1_000)]
    tracemalloc.start()
    found = sum(len(part[0]) for part in repeats.anchors_of(texts, repeats.Shape(), repeats.Hashes(1)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found > 50_000 and peak < 48 << 20


def test_a_run_too_short_in_words_stays(documents):
    rng = random.Random(4)
    shared = {n: "".join(rng.choice("abcdefg") for _ in range(n)) for n in (90, 450)}
    words = " ".join("".join(rng.choice("abcdefg") for _ in range(3)) for _ in range(30))
    texts = [f"{i}{i}{i} {part}" for part in (*shared.values(), words) for i in range(2)]
    left = repeats.remove_repeats(documents(list(enumerate(texts))), shape=repeats.Shape(80, 20), replace_text=True, words=20)
    got = {r.doc_id: (r.n_spans, len(r.text)) for r in left.collect()}
    assert got == {0: (0, 94), 1: (0, 94), 2: (1, 3), 3: (1, 3), 4: (1, 3), 5: (1, 3)}


def test_merging_shards_equals_sorting():
    rng = np.random.default_rng(7)
    data = rng.integers(97, 100, (500, 16), np.uint8)
    data[50:90] = data[10]
    words = data.view(">u8").astype(np.uint64)
    group = np.sort(rng.integers(0, 5, 500))
    shards = [s + repeats.sort_shard(words[s : s + 120], group[s : s + 120]) for s in range(0, 500, 120)]
    order, common = repeats.merge_shards(words, group, shards)
    keys = [(group[i], data[i].tobytes()) for i in order]
    assert keys == sorted(keys)
    for (g, a), (h, b), c in zip(keys, keys[1:], common[1:], strict=False):
        same = next((i for i in range(16) if a[i] != b[i]), 16)
        assert c == (same if g == h else -1)


def test_odd_rows_and_replaced_text(documents, odd_rows):
    docs = documents([*odd_rows, (50, "é" * 600), (51, "z" + "é" * 600)])
    left = repeats.remove_repeats(docs, replace_text=True)
    rows = left.collect()
    assert len(rows) == len(odd_rows) + 2 and left.columns.count("kept") == 1
    long = [r for r in rows if r.doc_id in (3, 4)]
    assert all(r.n_removed == r.n_bytes and r.text == "" for r in long)
    assert {r.text for r in rows if r.doc_id == 51} == {"z"}


def test_empty_table(documents):
    assert repeats.remove_repeats(documents([])).count() == 0
