from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderloom.llm import kneser_ney, queries

WORD = re.compile(r"[^\x20\t-\r]+")


def tokens(text):
    return [*WORD.findall((text or "").translate(kneser_ney.LOWER)), "</s>"]


def brute(rows, order):
    """(held out, tokens, known, training tokens, base score, score) of every (text, train) row."""
    counts = [None] + [Counter() for _ in range(order)]
    raw = Counter()
    for text, train in rows:
        words = ["<s>"] * (order - 1) + tokens(text)
        for k in range(order - 1, len(words) if train else 0):
            counts[order][tuple(words[k - order + 1 : k + 1])] += 1
            raw[words[k]] += 1
    for m in range(order - 1, 0, -1):
        for gram in counts[m + 1]:
            counts[m][gram[1:]] += 1
    lost, after = [None], [None]
    for m in range(1, order + 1):
        values = list(counts[m].values())
        lost.append(kneser_ney.discounts(np.array([values.count(k) for k in (1, 2, 3, 4)])))
        sums = defaultdict(lambda: [0, 0, 0, 0])
        for gram, count in counts[m].items():
            sums[gram[:-1]][0] += count
            sums[gram[:-1]][min(count, 3)] += 1
        after.append(sums)
    distinct, total = len(raw), sum(raw.values())

    def probability(gram, m):
        if m == 0:
            return 1 / (distinct + 1)
        gram = gram[-m:]
        sums = after[m].get(gram[:-1])
        lower = probability(gram, m - 1)
        if not sums:
            return lower
        count = counts[m].get(gram, 0)
        spare = sum(lost[m][k] * sums[k] for k in (1, 2, 3)) / sums[0]
        return max(count - lost[m][min(count, 3)], 0) / sums[0] + spare * lower

    out = []
    for text, train in rows:
        words = ["<s>"] * (order - 1) + tokens(text)
        grams = [tuple(words[k - order + 1 : k + 1]) for k in range(order - 1, len(words))]
        base = sum(math.log10((raw[g[-1]] + 0.5) / (total + 0.5 * (distinct + 1))) for g in grams)
        known = sum(raw[g[-1]] > 0 for g in grams)
        out.append((not train, len(grams), known, total, base, sum(math.log10(probability(g, order)) for g in grams)))
    return out


@pytest.mark.parametrize("order, share_bytes", [(2, 300), (3, 1000), (2, 1 << 24)])
def test_against_brute_force(documents, odd_rows, order, share_bytes):
    rng = random.Random(order)
    rows = [(i, " ".join(rng.choice("aAbcdefgh") + rng.choice(["", "x", "y"]) for _ in range(rng.randrange(30)))) for i in range(80)]
    rows += [(100 + i, r[1]) for i, r in enumerate(odd_rows)]
    train = F.col("doc_id") % 5 != 1
    found = kneser_ney.score(documents(rows), train, order=order, share_bytes=share_bytes).collect()
    wanted = brute([(t, i % 5 != 1) for i, t in rows], order)
    got = {r.doc_id: tuple(r)[1:] for r in found}
    assert len(found) == len(rows)
    for (doc_id, _), row in zip(rows, wanted, strict=True):
        assert got[doc_id][:4] == row[:4]
        np.testing.assert_allclose(got[doc_id][4:], row[4:], rtol=1e-9)


def test_probabilities_after_a_history_sum_to_one(documents):
    rows = [(1, "a b a c a b"), (2, "a b b c"), (3, "c a")]
    words = ["a", "b", "c", "never"]
    asked = [(10 + i, f"a {w}") for i, w in enumerate(words)] + [(20, "a")]
    found = kneser_ney.score(documents(rows + asked), F.col("doc_id") < 10).collect()
    score = {r.doc_id: r.score for r in found}
    before = brute([(t, i < 10) for i, t in rows + asked], 2)
    assert abs(score[20] - before[-1][5]) < 1e-9


def test_nulls_and_empty_tables(documents, odd_rows):
    found = kneser_ney.score(documents(odd_rows), F.lit(None).cast("boolean")).collect()
    assert len(found) == len(odd_rows) and {r.train_tokens for r in found} == {0} and {r.n_known for r in found} == {0}
    assert all(r.score == 0 for r in found)  # nothing known: one kind of token
    assert kneser_ney.score(documents([]), F.lit(True)).count() == 0


def test_sorted_hashes_are_mapped_and_found():
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 62, 1000).astype(np.uint64))
    with kneser_ney.SortedHashes(keys, np.arange(1000.0)) as held:
        assert isinstance(held.hashes, np.memmap)
        assert held.find(keys[[5, 999, 0]]).tolist() == [5.0, 999.0, 0.0]


@pytest.mark.parametrize("most_frequent", [3, 50_000])
def test_frequent_words_are_dealt_over_several_shares_and_change_nothing(documents, monkeypatch, most_frequent):
    monkeypatch.setattr(kneser_ney, "MOST_FREQUENT", most_frequent)
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["the", "the", "of", f"w{rng.randrange(40)}"]) for _ in range(rng.randrange(60)))) for i in range(60)]
    frequent = kneser_ney.frequent_words(documents(rows).select("text"), 12_000, len(rows), 9)
    the = frequent.find(np.array([kneser_ney.hash_of(b"the"), 12345], np.uint64))
    assert frequent.spread[the[0]] > 1 and the[1] == -1
    found = kneser_ney.score(documents(rows), F.col("doc_id") % 5 != 1, order=3, share_bytes=700).collect()
    wanted = brute([(t, i % 5 != 1) for i, t in rows], 3)
    got = {r.doc_id: tuple(r)[1:] for r in found}
    for (doc_id, _), row in zip(rows, wanted, strict=True):
        np.testing.assert_allclose(got[doc_id], row, rtol=1e-9)


def test_only_histories_of_spread_words_are_asked_for(documents):
    # Before, every share asked for all of its histories, and they came back.
    names = np.array([kneser_ney.START, kneser_ney.END, kneser_ney.hash_of(b"the")], np.uint64)
    rows = documents([(i, f"the a{i} b{i} the c{i} d{i}") for i in range(20)]).selectExpr("doc_id id", "text", "true train")
    for spread, histories in ((1, 0), (3, 1)):
        frequent = kneser_ney.Frequent(names, np.array([1, 1, spread]))
        dealt = rows.coalesce(1).mapInArrow(kneser_ney._deal(2, 3, frequent), "part int, uid bigint, kind int, body binary").collect()
        shares = [kneser_ney.Share([r["body"] for r in dealt if r["part"] == p and r["kind"] == 0], 2, frequent) for p in range(3)]
        assert {len(keys) for share in shares for keys, _ in share.asked()[1:]} == {histories}
        assert sum(len(share.of_token) for share in shares) == 140


def test_sums_of_texts_are_added_up_in_the_task():
    # Before, every share sent its own sums of every text.
    body = [kneser_ney.pack((np.array(d, np.uint16), *(np.array(v, float) for v in (s, s)), np.array(k, np.uint32), 9)) for d, s, k in (([0, 2], [1, 2], [1, 1]), ([2, 3], [4, 8], [2, 3]))]
    added = kneser_ney.AddedUp()
    for uid, b in ((7, body[0]), (7, body[1]), (8, body[1])):
        added.add(uid, b)
    out = added.rows().to_pylist()
    assert [(r["uid"], r["kind"]) for r in out] == [(7, 0), (8, 0)] and not added.held
    docs, scores, _, known, tokens = kneser_ney.unpack(out[0]["body"])
    assert (docs.tolist(), scores.tolist(), known.tolist(), tokens) == ([0, 2, 3], [1, 6, 8], [1, 3, 3], 9)


def test_tokens_of_a_slice_of_texts():
    texts = ["a b", "", " \t", "Émile said\x0bÉMILE\x85x", " The\u00a0end  the ", "x"] * 3
    frequent = kneser_ney.Frequent(np.array([kneser_ney.START, kneser_ney.END, kneser_ney.hash_of(b"the")], np.uint64), np.ones(3, int))
    for start in (0, 2, 5):
        sizes, codes, names = kneser_ney._codes(pa.array(texts).slice(start), frequent)
        wanted = [tokens(t) for t in texts[start:]]
        assert sizes.tolist() == [len(w) for w in wanted]
        hashes = {"</s>": kneser_ney.END}
        assert names[codes].tolist() == [hashes.get(w, kneser_ney.hash_of(w.encode())) for words in wanted for w in words]


@pytest.mark.parametrize("bits", [48, 64])
def test_distinct_keys_also_where_their_upper_bits_agree(bits):
    rng = np.random.default_rng(2)
    spread = rng.integers(0, 1 << bits, 3000, np.uint64)
    near = np.uint64(1 << (bits - 1)) + rng.integers(0, 9, 3000, np.uint64)
    for keys in (np.append(spread, spread[:500]), np.concatenate([spread, near]), near[:1], near[:0]):
        names, first, inverse = kneser_ney.distinct(keys, bits)
        assert names.tolist() == np.unique(keys).tolist()
        assert (names[inverse] == keys).all() and (keys[first] == names).all()


def test_registered_query_scores_with_two_words_of_history(spark):
    small = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    wanted = brute([(t, zlib.crc32(str(i).encode()) % 5 != 1) for i, t in rows], 3)
    got = {r.doc_id: tuple(r)[1:] for r in queries.op6_kneser_ney(spark, small).collect()}
    assert len(got) == len(rows)
    for (doc_id, _), row in zip(rows, wanted, strict=True):
        np.testing.assert_allclose(got[doc_id], row, rtol=1e-9)
