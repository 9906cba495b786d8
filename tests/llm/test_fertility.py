from __future__ import annotations

import math
import random
import re
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from orderloom.llm import common, fertility

PATH = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\t-\r]+")


def base(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed


def prose(rng, n):
    return " ".join(rng.choice(PROSE) for _ in range(n))


PROSE = """the of and to in that was he for it with as his on be at by had not are but from or have an they which you were her
all she there would their we him been has when who will more no if out so said what up its about into than them can only other
new some could time these two may then do first any my now such like our over man me even most made after also did many before
must through back years where much your way well down should because each just those people how too little state good very
make world still own see men work long get here between both life being under never day same another know while last might us
great old year off come since against go came right used take three""".split()


def test_base_against_brute_force(documents, odd_rows):
    rng = random.Random(1)
    rows = [(r[0], r[1]) for r in odd_rows]
    rows += [(100 + i, "\n".join(" ".join(rng.choice("abcde#|") for _ in range(rng.randrange(9))) for _ in range(rng.randrange(40)))) for i in range(60)]
    found = fertility.assess(documents(rows), PATH, lang_col=None)
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found.collect())
    assert got == Counter((doc_id, *base(text)) for doc_id, text in rows)
    assert found.where("base_failed and kept").count() == 0


def test_token_measures_equal_the_library(documents):
    rng = random.Random(2)
    text = prose(rng, 200)
    (r,) = fertility.assess(documents([(1, text, "en")]), PATH).collect()
    ids = sentencepiece.SentencePieceProcessor(model_file=PATH).encode(text)
    assert r.n_tokens == len(ids)
    assert r.chars_per_token == sum(map(len, text.split())) / len(ids)
    assert r.kept and r.reason == ""


def plain_verdict(processor, text, band):
    """The measures and the verdict from the library's pieces, by the wording of the rules."""
    ids = processor.encode(text)
    pieces = [processor.id_to_piece(i) for i in ids]
    raw = [int(p[3:5], 16) if processor.is_byte(i) else None for i, p in zip(ids, pieces, strict=True)]
    sizes = []
    for at, (piece, byte) in enumerate(zip(pieces, raw, strict=True)):
        following = raw[at + 1] if at + 1 < len(raw) else None
        more = byte is not None and byte >= 0x80 and following is not None and 0x80 <= following < 0xC0
        sizes.append(len(piece) if byte is None else int(not more))
    n = len(ids)
    blanks = [(p.startswith("▁") or (b is not None and b in b" \t\n\v\f\r")) for p, b in zip(pieces, raw, strict=True)]
    only_blank = [p.strip("▁") == "" or (b is not None and b in b" \t\n\v\f\r") for p, b in zip(pieces, raw, strict=True)]
    endings = [i for at, i in enumerate(ids) if not only_blank[at] and (at + 1 == n or blanks[at + 1])]

    def entropy(held):
        counts = Counter(held)
        total = len(held)
        plain = -sum(c / total * math.log2(c / total) for c in counts.values())
        second = sum(c / total * math.log2(c / total) ** 2 for c in counts.values())
        return plain + (len(counts) - 1) / (2 * total * math.log(2)), math.sqrt(max(second - plain**2, 0) / total)

    words = WORD.findall(text)
    chars = sum(map(len, words)) / n
    spread = math.sqrt(sum((s - sum(sizes) / n) ** 2 for s in sizes) / n) / math.sqrt(n)
    share = sum(b is not None for b in raw) / n
    (h, h_error), (e, e_error) = entropy(ids), entropy(endings)
    good = (
        chars + spread >= band.least_chars_per_token
        and chars - spread <= band.most_chars_per_token
        and share - math.sqrt(share * (1 - share) / n) <= band.most_byte_share
        and h + h_error >= band.least_entropy
        and e + e_error >= band.least_ending_entropy
    )
    return good, chars, share, h, e


def test_verdicts_against_the_library(documents):
    rng = random.Random(11)
    processor = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = []
    for i in range(60):
        words = prose(rng, rng.randrange(50, 400)).split()
        for at in range(0, len(words), rng.choice([2, 5, 50])):
            words[at] = rng.choice([words[at].upper() + "!!", "字" * rng.randrange(1, 5), "%%", words[at], "12", "é\n"])
        if i % 3 == 0:
            words = [w.upper() + rng.choice(["!!", "##", "$"]) for w in words]
        rows.append((i, " ".join(words[: rng.choice([len(words), 60])]), rng.choice(["en", "fr", None])))
    found = {r.doc_id: r for r in fertility.assess(documents(rows), PATH).collect()}
    verdicts = Counter()
    for doc_id, text, lang in rows:
        band = fertility.band_of(lang, text, fertility.LANGUAGES, fertility.SCRIPTS)
        good, *measures = plain_verdict(processor, text, band)
        r = found[doc_id]
        assert [r.chars_per_token, r.byte_share, r.token_entropy, r.ending_entropy] == pytest.approx(measures)
        assert r.kept == (good and not base(text)[5])
        verdicts[r.kept] += 1
    assert min(verdicts[True], verdicts[False]) > 5


def test_slices_change_nothing(documents):
    rng = random.Random(12)
    rows = [(i, None if i == 7 else prose(rng, rng.randrange(1, 300)), "en") for i in range(40)]
    whole = sorted(map(str, fertility.assess(documents(rows), PATH).collect()))
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["id", "text"])
    parts = list(common.sliced(batch, 1, 700))
    assert len(parts) > 10 and pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert [p.num_rows for p in common.sliced(batch, 1, 1 << 40)] == [40] and not list(common.sliced(batch.slice(0, 0), 1))
    assert sorted(map(str, fertility.assess(documents(rows).repartition(1), PATH).collect())) == whole


def test_junk_goes_and_prose_stays(documents):
    rng = random.Random(3)
    rows, wanted = [], {}
    for i in range(40):
        text = prose(rng, 60 + 20 * i)
        for k, (made, kept) in enumerate(
            [
                (text, True),
                (text.replace(" ", "!! ").upper(), False),
                (re.sub(" ", lambda m: rng.choice(["*** ", "$$$ ", "%%% ", "&&& "]), text), False),
                (text.replace(" ", " | "), False),
            ]
        ):
            rows.append((4 * i + k, made, "en"))
            wanted[4 * i + k] = kept
    found = {r.doc_id: r.kept for r in fertility.assess(documents(rows), PATH).collect()}
    assert found == wanted


def test_script_decides_without_a_language():
    assert fertility.script_of("Слово и дело 12") == "CYRILLIC"
    assert fertility.script_of("12 ..") == ""
    band = fertility.band_of(None, "Слово", fertility.LANGUAGES, fertility.SCRIPTS)
    assert band == fertility.SCRIPTS["CYRILLIC"]
    assert fertility.band_of("en", "Слово", fertility.LANGUAGES, fertility.SCRIPTS) == fertility.LANGUAGES["en"]


def test_script_counts_the_whole_text(documents):
    assert fertility.script_of("word " * 500 + "слово " * 5_000) == "CYRILLIC"
    assert fertility.script_of("12 | 34 " * 500 + "word") == "LATIN"
    # Figures before words that end alike: junk for LATIN, nothing for texts without letters.
    rng = random.Random(4)
    figures = " ".join(str(rng.randrange(10_000)) for _ in range(600))
    junk = " ".join(rng.choice(PROSE).upper() + "!!" for _ in range(6_000))
    # Chinese behind a Latin head: many bytes, as its own band allows.
    chinese = " ".join("".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(6)) for _ in range(3_000))
    rows = [(1, f"{figures} {junk}", None), (2, f"{prose(rng, 600)} {chinese}", "zh")]
    found = {r.doc_id: r.kept for r in fertility.assess(documents(rows), PATH).collect()}
    assert found == {1: False, 2: True}


def test_keep_good_keeps_columns(documents, odd_rows):
    docs = documents(odd_rows)
    left = fertility.keep_good(docs, PATH)
    assert [c for c in docs.columns if c != "kept"] == left.columns
    assert fertility.assess(documents([]), PATH).count() == 0
