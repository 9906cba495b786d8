from __future__ import annotations

import os
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orderloom.llm import packing
from orderloom.llm.byte_tokens import ByteTokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "B", " ", "  ", "\n", "\t", "é", "漢", "😀", "1", "'s", "’s", ".", "\x1c", "\x85", "\xa0", "　", "<|endoftext|>", "_", "the", "²", "​", "ſ"]


@pytest.fixture(scope="module")
def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def test_ids_equal_the_library(library):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(60))) for _ in range(1500)]
    with open(PATH, "rb") as file:
        tokens = ByteTokens(file.read())
    for text, packed in zip(texts, tokens.encode_batch(texts), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_cut():
    assert packing.cut(5, 10) == [5] and packing.cut(10, 10) == [10]
    assert packing.cut(11, 10) == [1, 10] and packing.cut(40, 10) == [10] * 4


@pytest.mark.parametrize("capacity, sizes", [(10, [6, 6, 4, 4, 3, 3, 2, 2]), (100, [51, 27, 26, 23, 24, 25, 12, 6, 6])])
def test_search_reaches_the_least_number(capacity, sizes):
    sequences = packing.pack_lengths(sizes, capacity)
    assert sorted(p for s in sequences for p in s) == list(range(len(sizes)))
    assert all(sum(sizes[p] for p in s) <= capacity for s in sequences)
    assert len(sequences) == -(-sum(sizes) // capacity)


def test_search_saves_sequences():
    rng = random.Random(1)
    sizes = [rng.choice([700, 680, 1000, 650, 660]) for _ in range(300)]
    bins = packing._Bins(sizes, 2048)
    bins.best_fit()
    before, squares = bins.count(), sum(f * f for f in bins.fill)
    bins.search()
    assert bins.count() < before and sum(f * f for f in bins.fill) > squares
    assert all(f == sum(sizes[p] for p in h) <= 2048 for f, h in zip(bins.fill, bins.held, strict=True))


@pytest.mark.parametrize("per_partition", [3, 100_000])
def test_pieces_are_whole_and_sequences_gapless(documents, odd_rows, library, per_partition):
    rng = random.Random(6)
    rows = [r[:2] for r in odd_rows] + [(100 + i, "the cat " * rng.randrange(300)) for i in range(40)]
    packed = packing.pack(packing.token_pieces(documents(rows), PATH, capacity=256), 256, per_partition).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 256
    wanted = defaultdict(list)
    for doc_id, text in rows:
        ids, start = library.encode(text or "", add_special_tokens=False).ids + [0], 0
        for piece, length in enumerate(packing.cut(len(ids), 256)):
            part = np.array(ids[start : start + length], "<u4").tobytes()
            wanted[doc_id].append((piece, start, length, zlib.crc32(part)))
            start += length
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in wanted.items()}


def test_assembled_sequences_hold_the_ids(documents, library):
    rows = [(i, f"text number {i} " * (i + 1)) for i in range(30)]
    pieces = packing.token_pieces(documents(rows), PATH, 64, with_ids=True)
    sequences = packing.assemble(packing.pack(pieces, 64), pieces).collect()
    total = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sum(len(s.ids) for s in sequences) == total and max(len(s.ids) for s in sequences) <= 64


def test_empty_table(documents):
    assert packing.pack(packing.token_pieces(documents([]), PATH)).count() == 0
