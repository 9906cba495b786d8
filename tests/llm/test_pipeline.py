from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
import public_tokenizers
import tokenizers

import __spark_entry__ as driver
import corpus_pipeline
from orderloom.session import settle
from test_chosen_path import shingles
from test_fertility import PROSE, base, prose

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_pack_what_is_left(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    names = [name for name, _ in corpus_pipeline.STAGES]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = settle(stage(spark, docs, SMALL))
        assert docs.columns == columns, name
        assert 0 < docs.count() <= rows
        rows = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert len(names) == 5


def small_corpus():
    """(rows, ids of junk): prose, junk, exact copies, near copies, shared passages, NULL and empty texts, repeated rows."""
    rng = random.Random(7)
    texts = {i: prose(rng, rng.randrange(80, 200)) for i in range(30)}
    passage = prose(rng, 90)  # over 400 bytes
    for i in range(4, 9):
        words = texts[i].split()
        at = rng.randrange(len(words))
        texts[i] = " ".join([*words[:at], passage, *words[at:]])
    rows = list(texts.items())
    rows += [(100 + i, texts[i].upper() if i % 2 else texts[i]) for i in range(6)]  # copies, but for the case
    for i in range(10, 16):
        words = texts[i].split()
        words[rng.randrange(len(words))] = rng.choice(PROSE) + "x"
        rows.append((200 + i, " ".join(words)))
    rows += [(300, texts[20]), (300, texts[20]), (None, texts[21]), (None, texts[21]), (400, None), (401, ""), (402, "too short")]
    junk = {500: texts[25].replace(" ", "!! ").upper(), 501: texts[26].replace(" ", " | "), 502: " ".join(["again and again"] * 60)}
    rows += list(junk.items())
    rng.shuffle(rows)
    return rows, {500, 501}


def plainly(stage, rows, junk):
    """(doc_id, text) rows that a stage leaves, by the wording of its rule."""
    if stage == "quality rules":
        return [r for r in rows if not base(r[1])[5] and r[0] not in junk]
    if stage == "exact dedup":
        best = {}
        for doc_id, text in rows:
            key = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
            if key not in best or (best[key][0] is None) or (doc_id is not None and doc_id > best[key][0]):
                best[key] = (doc_id, text) if key not in best or doc_id is not None else best[key]
        return list(best.values())
    if stage == "n-gram Jaccard join":
        sets, above = [shingles(t) for _, t in rows], list(range(len(rows)))

        def root(i):
            while above[i] != i:
                i = above[i]
            return i

        for i, a in enumerate(sets):
            for j in range(i):
                if a and sets[j] and 10 * len(a & sets[j]) >= 8 * len(a | sets[j]):
                    above[max(root(i), root(j))] = min(root(i), root(j))
        classes = defaultdict(list)
        for i, row in enumerate(rows):
            classes[root(i)].append(row)
        return [min(held, key=lambda r: (r[0] is None, r[0] or 0)) for held in classes.values()]
    length = 400
    starts = Counter((t or "")[i : i + length] for _, t in rows for i in range(len(t or "") - length + 1))
    out = []
    for doc_id, text in rows:
        covered = bytearray(len(text or ""))
        for i in range(len(covered) - length + 1):
            if starts[text[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        out.append((doc_id, "".join(c for c, gone in zip(text or "", covered, strict=True) if not gone)))
    return out


def pairs(df):
    return Counter((r.doc_id, r.text or "") for r in df.collect())


def test_every_stage_against_plain_python(spark, documents):
    rows, junk = small_corpus()
    docs = documents([(d, t, "en") for d, t in rows])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = settle(stage(spark, docs, SMALL))
        assert pairs(docs) == Counter((d, t or "") for d, t in plainly(name, before, junk)), name
        assert docs.columns == [c for c in documents([]).columns if c in docs.columns]
    left = {(r.doc_id, r.text): r.n_chars for r in docs.collect()}
    assert all(n == len(text) for (_, text), n in left.items())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    encode = tokenizers.Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.BYTES)).encode
    sizes = {d: len(encode(t, add_special_tokens=False).ids) + 1 for d, t in left}
    assert {d: sum(r.length for r in packed if r.doc_id == d) for d in sizes} == sizes
    for sequence in {r.sequence_id for r in packed}:
        at = 0
        for r in sorted((r for r in packed if r.sequence_id == sequence), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048


def test_passages_of_over_fifty_words_go_and_shorter_repeats_stay(spark, documents):
    """A passage of 52 words is far under 400 bytes; one of 44 stays."""
    rng = random.Random(11)

    def made(count):
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(count))

    passage, idiom = made(52), made(44)
    assert 260 < len(idiom) + 2 < len(passage) < 400
    own = [made(80) for _ in range(6)]
    texts = [f"{own[i]} {shared} {i}" for i, shared in enumerate([passage] * 3 + [idiom] * 3)]
    stage = dict(corpus_pipeline.STAGES)["suffix-array dedup"]
    left = {r.doc_id: r.text for r in stage(spark, documents(list(enumerate(texts))), SMALL).collect()}
    assert all(passage not in left[i] and own[i] in left[i] for i in range(3))
    assert [left[i] for i in range(3, 6)] == texts[3:]


@pytest.mark.parametrize("stage", [stage for _, stage in corpus_pipeline.STAGES], ids=[name for name, _ in corpus_pipeline.STAGES])
def test_odd_and_no_rows_pass_every_stage(spark, documents, odd_rows, stage):
    assert stage(spark, documents([]), SMALL).count() == 0
    for row in stage(spark, documents(odd_rows), SMALL).collect():
        assert "doc_id" in row.asDict()


def test_registered():
    queries = driver.queries()
    assert [q for q in queries if q.startswith("op")] == sorted((q for q in queries if q.startswith("op")), key=lambda q: int(q[2:].split("_")[0]))
    assert {int(q[2:].split("_")[0]) for q in queries if q.startswith("op")} == set(range(1, 14))
    assert queries["pipeline"] is corpus_pipeline.run
