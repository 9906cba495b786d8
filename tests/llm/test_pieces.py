from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from orderloom.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "ab e▁ \n\t éß漢字😀​\x00~ing the <s></s><0x41>ñ,.'-_"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as file:
        return pieces.PieceModel(file.read())


def texts():
    rng = random.Random(2)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(120))) for _ in range(800)]
    return ["", " ", "   ", "\n", "▁", "▁▁ a", "a" * 3000, "ab" * 2000, "x " * 50, "Don't,stop.me - now", *made]


def test_ids_spans_and_decoding_equal_the_library(library, model):
    for text, one in zip(texts(), model.encode_batch(texts()), strict=True):
        wanted = library.encode(text, add_bos=True, add_eos=True)
        assert one.ids.tolist() == wanted
        assert model.decode(one.ids) == library.decode(wanted)
        begins, ends = one.spans()
        proto = library.encode(text, return_type="proto")
        assert list(zip(begins[1:-1], ends[1:-1], strict=True)) == [(p.begin, p.end) for p in proto.pieces]


def test_decoding_any_ids(library, model):
    rng = random.Random(4)
    bytes_ = model.byte_ids.tolist()
    for _ in range(300):
        ids = [rng.choice([1, 2, rng.randrange(3, 32000), rng.choice(bytes_), rng.choice(bytes_)]) for _ in range(rng.randrange(8))]
        assert model.decode(np.array(ids, np.int64)) == library.decode(ids)


def test_side_by_side_and_heap_merge_alike(model):
    rng = random.Random(5)
    units = ["".join(rng.choice("▁abcdeinorst") for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    symbols, covers = model.merge_all(units)
    for row, unit in enumerate(units):
        held = symbols[row] > -2
        one, size = model.merge_long(unit)
        assert (one.tolist(), size.tolist()) == (symbols[row, held].tolist(), covers[row, held].tolist())


def compiled(replacements: dict[str, str]) -> bytes:
    """A compiled character map: a double array with every node's children at their own offset."""
    tree: dict = {}
    for key in replacements:
        node = tree
        for byte in key.encode():
            node = node.setdefault(byte, {})
        node[None] = key
    blob, starts = b"", {}
    for key, value in replacements.items():
        starts[key] = len(blob)
        blob += value.encode() + b"\0"
    units = {0: 0}
    free = 256

    def place(node, at):
        nonlocal free
        base, free = free, free + 256
        units[at] = units[at] & 0x800001FF | (at ^ base) << 10
        for byte, child in node.items():
            if byte is None:
                units[at] |= 1 << 8
                units[base] = 0x80000000 | starts[child]
            else:
                units[base ^ byte] = byte
        for byte, child in node.items():
            if byte is not None:
                place(child, base ^ byte)

    place(tree, 0)
    array = np.zeros(free, "<u4")
    array[list(units)] = list(units.values())
    return len(array.tobytes()).to_bytes(4, "little") + array.tobytes() + blob


def test_longest_prefix_normalisation_keeps_offsets():
    blob = compiled({"a": "x", "ab": "yy", "é": "e", "　": " ", "­": ""})
    found = pieces.CharMap(blob)
    assert found.longest(b"abc", 0) == (2, b"yy") and found.longest(b"ac", 0) == (1, b"x")
    assert found.longest(b"bc", 0) is None and found.longest("é".encode(), 0) == (2, b"e")

    model = object.__new__(pieces.PieceModel)

    class Spec:
        add_dummy_prefix, remove_extra_whitespaces = True, True

    model.map, model.norm = found, Spec
    text, offsets = model.normalise(" ab　 é­c ")
    assert text == "▁yy▁ec"
    #                 dummy y  y  space é  c  end
    assert offsets.tolist() == [1, 1, 1, 3, 7, 11, 12]
    assert model.normalise("   ") == ("", None)


def test_operator_on_odd_rows(documents, odd_rows, library):
    outputs = ["ids", "begins", "ends", "decoded", "n_tokens", "ids_sha256", "covered_bytes"]
    rows = pieces.encode(documents(odd_rows), PATH, outputs).collect()
    assert len(rows) == len(odd_rows)
    assert "text" not in rows[0] and rows[0].kept == "a"
    by_id = {}
    for doc_id, text, *_ in odd_rows:
        by_id.setdefault(doc_id, []).append(library.encode(text or "", add_bos=True, add_eos=True))
    for r in rows:
        assert r.ids in by_id[r.doc_id] and r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
        assert r.decoded == library.decode(r.ids) and len(r.begins) == len(r.ends) == len(r.ids)


def test_empty_table(documents):
    assert pieces.encode(documents([]), PATH).count() == 0
