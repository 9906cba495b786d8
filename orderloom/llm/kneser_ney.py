"""Scores by an interpolated modified Kneser-Ney n-gram model, counted and applied by shares.

The corpus' n-grams are dealt by a hash of the word before their last, so a share knows all
counts and continuation counts of its n-grams of order two and up, and all that follows their
histories. N-grams of a word too frequent for that are dealt by their last two words over as
many shares as it takes. What a probability also needs - how often a word continues, and a
history of such a frequent word, whatever the n-gram - is summed up by key: shares send what
they hold of each key to the key's place and get the totals back. A share then
writes the log probabilities of the n-grams it has to score as sorted arrays of 64-bit hashes,
maps them into memory for the one task, and scores its n-grams of all documents by binary
search; document sums meet again at the end. No model is kept after that, so texts outside the
frame cannot be scored. So neither the model nor the corpus is ever whole in one place, both grow with the
number of shares, and text is shuffled once, as packed codes.

Which words are frequent is estimated beforehand from a bounded sample. It decides where n-grams
go and which words travel as short codes, never what is counted: results don't depend on it.

Counts, hashes and sums are numpy arrays inside tasks; Spark deals, shuffles and repeats them.
"""

from __future__ import annotations

import math
import pickle
import tempfile
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from orderloom.llm.common import UPPER, quoted, sliced, whole

LOWER = str.maketrans(UPPER, UPPER.lower())
LOWER_BYTES = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
ORDER = 2
#: Bytes of text whose bigrams one share holds (longer n-grams: fewer), and that are dealt at a time.
SHARE_BYTES = 8 << 20
DEALT_BYTES = 8 << 20
#: Of the sample that frequent words are looked for in: bytes of text, and of a stretch of it.
SAMPLE_BYTES = 16 << 20
STRETCH = 4096
#: Frequent words known everywhere by a short code, START and END aside.
MOST_FREQUENT = 50_000
#: A word that by itself would make more than this part of a share is dealt over several.
PARTS = 8
#: Tasks that score shares one after the other, and shares for each task beyond them: a task adds up
#: what its shares say of a text, so that sums of texts don't grow with the number of shares.
TASKS = 16
SHARES_A_TASK = 128
#: Shares for each place that adds up words and histories.
SHARES_A_PLACE = 4
#: Packed sums of texts that a task holds at most.
HELD_BYTES = 32 << 20
#: No word hashes to these: what stands before a text, and what ends it.
START, END = 1, 2
#: Words and histories are known by 48 bits.
KEY_BITS = np.uint64((1 << 48) - 1)
SUMS = 4  # count, and kinds seen once, twice, more often


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(value: object) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(value, protocol=5))


def unpack(blob: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def pack_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys as small steps and lower halves, which compress better than the keys."""
    upper = (keys >> np.uint64(32)).astype(np.uint16)
    return np.diff(upper, prepend=np.uint16(0)), keys.astype(np.uint32)


def unpack_keys(steps: np.ndarray, lower: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint64) << np.uint64(32) | lower


def smallest(values: np.ndarray, most: int) -> np.ndarray:
    return values.astype(np.uint16 if most <= 1 << 16 else np.uint32)


def planes(values: np.ndarray) -> np.ndarray:
    """Bytes of equal weight side by side, which compress better than the numbers."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)


def unplaned(bytes_of: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(bytes_of.T).view(f"u{len(bytes_of)}").ravel()


def distinct(keys: np.ndarray, bits: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of so many evenly spread bits in order, a place of each, and where each place's key is.

    Upper bits and places are sorted as one number, several times faster than sorting places by
    keys. Where keys that differ agree in these bits, places are sorted by keys after all.
    """
    n = len(keys)
    low = max(n.bit_length(), 1)
    shift = np.uint64(max(bits + low - 64, 0))
    packed = keys >> shift << np.uint64(low)
    packed |= np.arange(n, dtype=np.uint64)
    packed.sort()
    packed &= np.uint64((1 << low) - 1)
    order = packed.view(np.int64)
    ordered = keys[order]
    if (ordered[1:] < ordered[:-1]).any():
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    inverse = np.empty(n, np.int32)
    inverse[order] = np.cumsum(new, dtype=np.int32) - 1
    return ordered[new], order[new], inverse


# Hashes of histories and n-grams. words[:, -1] is the predicted word, what is before it the history.


def history(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the last ``size`` words before the predicted one."""
    found = np.full(len(words), size, np.uint64)
    for back in range(size, 0, -1):
        found = _mix(found * np.uint64(0x9E3779B97F4A7C15) + words[:, -1 - back])
    return found


def gram(words: np.ndarray, order: int) -> np.ndarray:
    return _mix(history(words, order - 1) * np.uint64(0xD1342543DE82EF95) + words[:, -1])


def discounts(kinds: np.ndarray) -> np.ndarray:
    """What counts of 0, 1, 2 and more lose, from the kinds counted once to four times."""
    n1, n2, n3, n4 = kinds.astype(float)
    if not n1 or not n2:
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(min(max(d, 0.1), k + 0.9) for k, d in enumerate(found))])


def kinds_of(counts: np.ndarray) -> np.ndarray:
    """Kinds counted once, twice, three and four times."""
    return np.bincount(counts[counts <= 4], minlength=5)[1:5]


class SortedHashes:
    """Hashes in order with a value each, in an unnamed file mapped into memory."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        self.size, self.file = len(hashes), tempfile.TemporaryFile()
        hashes.astype(np.uint64).tofile(self.file)
        values.astype(np.float64).tofile(self.file)
        self.file.flush()

    def __enter__(self):
        if self.size:
            self.hashes = np.memmap(self.file, np.uint64, "r", 0, (self.size,))
            self.values = np.memmap(self.file, np.float64, "r", 8 * self.size, (self.size,))
        else:
            self.hashes, self.values = np.zeros(0, np.uint64), np.zeros(0)
        return self

    def __exit__(self, *_):
        del self.hashes, self.values
        self.file.close()

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Values of hashes that are all there."""
        return self.values[np.searchsorted(self.hashes, hashes)]


# Dealing


def hash_of(word: bytes) -> int:
    """A word's hash, never START or END."""
    value = xxhash.xxh3_64_intdigest(word) & int(KEY_BITS)
    return value if value > END else value + 7


@dataclass(frozen=True)
class Frequent:
    """Hashes of frequent words, the most frequent first, and over how many shares each is dealt."""

    names: np.ndarray
    spread: np.ndarray

    def find(self, names: np.ndarray) -> np.ndarray:
        """Places in ``names``, -1 for what is not there."""
        order = np.argsort(self.names)
        at = order[np.minimum(np.searchsorted(self.names, names, sorter=order), len(order) - 1)]
        return np.where(self.names[at] == names, at, -1)

    def is_spread(self, names: np.ndarray) -> np.ndarray:
        at = self.find(names)
        return (at >= 0) & (self.spread[at] > 1)


def _sampled(step: int):
    """(word, count) in a stretch of every ``step`` bytes of text; word 0 counts the bytes looked at."""

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            text = b" ".join(batch.column(0).cast(pa.binary()).to_pylist())
            for start in range(0, len(text), step):
                stretch = text[start : start + STRETCH].translate(LOWER_BYTES)
                counts.update(stretch.split()[1:-1])  # those at the edges may be cut
                counts[b""] += len(stretch)
        words = [hash_of(w) if w else 0 for w in counts]
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    return run


def frequent_words(text: DataFrame, held: int, rows: int, shares: int) -> Frequent:
    """The frequent words of a column of texts of ``held`` bytes together, by their estimated counts."""
    step = STRETCH * max(1, held // SAMPLE_BYTES)
    counted = text.mapInArrow(_sampled(step), "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    found = counted.orderBy(F.desc("n"), "word").limit(MOST_FREQUENT).collect()
    seen = max(sum(r["n"] for r in found if r["word"] == 0), 1)
    found = [r for r in found if r["word"]]
    # START stands before every text, but an n-gram's word before the last is never END.
    names = np.array([START, END, *(r["word"] for r in found)], np.uint64)
    counts = np.array([rows, 0, *(r["n"] * held / seen for r in found)])
    parts = np.ceil(PARTS * shares * counts / max(counts.sum(), 1))
    return Frequent(names, np.clip(parts, 1, shares).astype(np.int64))


def _codes(text: pa.Array, frequent: Frequent) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of each text, all tokens as codes, hashes of codes: frequent words, then others by hash."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text))
    words = lists.flatten()
    there = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    kept = np.append(0, np.cumsum(there))
    offsets = lists.offsets.to_numpy()
    sizes = np.diff(kept[offsets - offsets[0]]) + 1
    if not there.all():
        words = words.filter(pa.array(there))
    words = words.dictionary_encode()
    named = np.fromiter(map(hash_of, words.dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(words.dictionary))
    code = frequent.find(named)
    others, _, place = distinct(named[code < 0], 48)
    code[code < 0] = len(frequent.names) + place
    flat = np.full(int(sizes.sum()), 1, np.int32)  # END, where no word is
    inside = np.ones(len(flat), bool)
    inside[np.cumsum(sizes) - 1] = False
    flat[inside] = code[words.indices.to_numpy()]
    return sizes, flat, np.concatenate([frequent.names, others])


def _dealt_to(before: np.ndarray, last: np.ndarray, names: np.ndarray, frequent: Frequent, shares: int) -> np.ndarray:
    share = (_mix(names) % np.uint64(shares)).astype(np.int64)[before]
    parts = np.append(frequent.spread, 1)[np.minimum(before, len(frequent.spread))]
    apart = np.flatnonzero(parts > 1)
    both = _mix(_mix(names[before[apart]]) + names[last[apart]])
    share[apart] += (both % parts[apart].astype(np.uint64)).astype(np.int64)
    return (share % shares).astype(np.uint16 if shares <= 1 << 16 else np.int64)


def _deal(order: int, shares: int, frequent: Frequent):
    """Packed n-grams of every share from each batch of texts, and a row that describes the texts."""
    known = len(frequent.names)

    def run(batches):
        number, task = 0, TaskContext.get().partitionId()
        for batch in (part for whole_batch in batches for part in sliced(whole_batch, 1, DEALT_BYTES)):
            uid = (task << 24) + number
            number += 1
            train = batch.column(2).to_numpy(zero_copy_only=False)
            sizes, codes, names = _codes(batch.column(1), frequent)
            count, total = len(sizes), len(codes)
            doc = np.repeat(np.arange(count, dtype=np.int32), sizes)
            place = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            columns = [np.where(place >= back, np.roll(codes, back), 0) for back in range(order - 1, -1, -1)]
            del place
            share = _dealt_to(columns[-2], columns[-1], names, frequent, shares)
            sort = np.argsort(share, kind="stable")  # the texts' order in each share
            bounds = np.append(0, np.cumsum(np.bincount(share, minlength=shares)))
            meta = pa.RecordBatch.from_arrays([batch.column(0), pa.array(~train), pa.array(sizes)], names=["id", "held_out", "n_tokens"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, meta.schema) as writer:
                writer.write_batch(meta)
            rows = [(uid % shares, uid, 1, sink.getvalue().to_pybytes())]
            used, short = np.zeros(len(names), bool), np.arange(len(names), dtype=np.int32)
            for part in np.flatnonzero(bounds[1:] > bounds[:-1]).tolist():
                at = sort[bounds[part] : bounds[part + 1]]
                own = [c[at] for c in columns]
                # Words that are not frequent are numbered anew.
                for c in own:
                    used[c] = True
                others = known + np.flatnonzero(used[known:])
                used[:] = False
                short[others] = np.arange(known, known + len(others))
                # So are all the words before the last, of which a share has few.
                before = short[own[-2]]
                used[before] = True
                few = np.flatnonzero(used)
                used[few] = False
                numbered = np.empty(few[-1] + 1, np.int32)
                numbered[few] = np.arange(len(few))
                own = [short[c] for c in own]
                own[-2] = numbered[before]
                kinds = [len(few) if i == order - 2 else known + len(others) for i in range(order)]
                docs = doc[at]
                body = (
                    count,
                    np.packbits(train),
                    pack_keys(names[others]),
                    smallest(np.diff(few, prepend=0), known + len(others)),
                    [planes(smallest(c, k)) for c, k in zip(own, kinds, strict=True)],
                    planes(smallest(np.diff(docs, prepend=np.int32(0)), count)),
                )
                rows.append((part, uid, 0, pack(body)))
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["part", "uid", "kind", "body"]
            )

    return run


def _opened(body: bytes, frequent: Frequent) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Texts of the batch, which of them train, n-grams as hashes of words, and the text of each."""
    count, train, others, few, columns, docs = unpack(body)
    names = np.concatenate([frequent.names, unpack_keys(*others)])
    columns = [unplaned(c) for c in columns]
    columns[-2] = np.cumsum(few, dtype=np.int64)[columns[-2]]
    doc = np.cumsum(unplaned(docs), dtype=np.int32)
    return count, np.unpackbits(train, count=count).astype(bool), np.stack([names[c] for c in columns]).T, doc


class Share:
    """The n-grams of one share and what they count in the training texts."""

    def __init__(self, bodies: list[bytes], order: int, frequent: Frequent):
        self.order = order
        words, keys, train, self.doc, self.docs = [], [], [], [], []
        for body in bodies:
            n, teaches, grams, doc = _opened(body, frequent)
            words.append(grams.T)
            keys.append(gram(grams, order))
            train.append(teaches[doc])
            self.doc.append(doc)
            self.docs.append(n)
        # One row for each n-gram of whole order; every token points at its row.
        self.keys, first, self.of_token = distinct(np.concatenate(keys))
        del keys
        self.words = np.empty((order, len(first)), np.uint64).T
        for i in range(order):
            self.words[:, i] = np.concatenate([w[i] for w in words])[first]
        del words, first
        raw = np.bincount(self.of_token[np.concatenate(train)], minlength=len(self.keys))
        self.word, _, self.word_of = distinct(self.words[:, -1], 48)
        self.word_raw = np.bincount(self.word_of, weights=raw, minlength=len(self.word)).astype(np.int64)
        # Orders from the highest to two: n-grams, their counts, their histories, and which of
        # these histories may stand in other shares too.
        self.levels = []
        key, of_row, count, first = self.keys, np.arange(len(self.keys)), raw, np.arange(len(self.keys))
        for m in range(order, 1, -1):
            if m < order:
                lower, at, back = distinct(gram(self.words, m))
                # Distinct n-grams one longer that end in each.
                seen = np.bincount(back[first[count > 0]], minlength=len(lower))
                key, of_row, count, first = lower, back, seen, at
            histories, of_history, history_of = distinct(history(self.words[first], m - 1) & KEY_BITS, 48)
            sums = np.empty((len(histories), SUMS), np.int64)
            sums[:, 0] = np.bincount(history_of, weights=count, minlength=len(histories))
            for k, which in ((1, count == 1), (2, count == 2), (3, count > 2)):
                sums[:, k] = np.bincount(history_of[which], minlength=len(histories))
            apart = np.flatnonzero(frequent.is_spread(self.words[first[of_history], -2]))
            self.levels.append((of_row, count, histories, history_of, sums, apart))
        self.word_continues = np.bincount(self.word_of[first[count > 0]], minlength=len(self.word))

    def kinds(self) -> np.ndarray:
        return np.stack([kinds_of(level[1]) for level in self.levels])

    def asked(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(keys, own sums) of the words, then of the histories of spread words by order."""
        words = self.word, np.stack([self.word_continues, self.word_raw], 1)
        return [words, *((histories[apart], sums[apart]) for _, _, histories, _, sums, apart in self.levels)]


def _partial_sums(order: int, places: int, frequent: Frequent):
    """What each share holds of the keys of each place."""

    def run(batches):
        for part, bodies in _by_part(batches):
            share = Share(bodies, order, frequent)
            asked, kinds, rows = share.asked(), share.kinds(), []
            del share
            for place in range(places):
                here = [np.flatnonzero(keys % np.uint64(places) == place) for keys, _ in asked]
                sections = [(pack_keys(k[h]), np.ascontiguousarray(s[h].astype(np.uint32).T)) for (k, s), h in zip(asked, here, strict=True)]
                rows.append((place, part, pack((kinds, sections))))
            del asked
            at, parts, bodies = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array(parts, pa.int32()), pa.array(bodies, pa.binary())], names=["place", "part", "body"]
            )

    return run


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Bodies of n-grams, a part after the other; rows come sorted by part and uid."""
    held: list[bytes] = []
    last = None
    for batch in batches:
        for part, kind, body in zip(*(batch.column(n).to_pylist() for n in ("part", "kind", "body")), strict=True):
            if part != last and held:
                yield last, held
                held = []
            last = part
            if kind == 0:
                held.append(body)
    if held:
        yield last, held


def _totals(table: pa.Table) -> pa.Table:
    """Totals of one place's keys, sent back to every share that asked, in the order it asked."""
    packed = [unpack(b) for b in table["body"].to_pylist()]
    asked = [(kinds, [(unpack_keys(*keys), sums.T) for keys, sums in sections]) for kinds, sections in packed]
    kinds = sum(a[0] for a in asked)
    answers: list[list[np.ndarray]] = [[] for _ in asked]
    whole_words = np.zeros(6 + SUMS, np.int64)
    for section in range(len(asked[0][1])):
        keys = np.concatenate([a[1][section][0] for a in asked])
        sums = np.concatenate([a[1][section][1] for a in asked])
        names, _, of = distinct(keys, 48)
        total = np.stack([np.bincount(of, weights=s, minlength=len(names)).astype(np.int64) for s in sums.T], 1)
        if section == 0:
            continues, raw = total[:, 0], total[:, 1]
            once = [(continues == k).sum() for k in (1, 2)]
            whole_words[:] = [*kinds_of(continues), raw.sum(), (raw > 0).sum(), continues.sum(), *once, (continues > 2).sum()]
        stops = np.cumsum([0, *(len(a[1][section][0]) for a in asked)])
        for i in range(len(asked)):
            answers[i].append(np.ascontiguousarray(total[of[stops[i] : stops[i + 1]]].astype(np.uint64 if total.max(initial=0) >> 32 else np.uint32).T))
    bodies = [pack((kinds, whole_words, a)) for a in answers]
    return pa.table({"part": table["part"], "place": table["place"], "body": pa.array(bodies, pa.binary())})


def log10_probabilities(share: Share, kinds: np.ndarray, words: np.ndarray, answers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(log10 of the model's probability, raw count of its word) for every n-gram of the share.

    ``words`` are the sums over the whole vocabulary: kinds of continuation counts, tokens,
    distinct words, continuations and kinds of them.
    """
    continues, raw = answers[0][:, 0], answers[0][:, 1]
    distinct, total, by_kind = words[5], words[6], words[7:]
    nothing = 1.0 / (distinct + 1)  # any word, one never seen included
    if total:
        d = discounts(words[:4])
        spare = float((d[1:] * by_kind).sum()) / total
        of_word = np.maximum(continues - d[np.minimum(continues, 3)], 0) / total + spare * nothing
    else:
        of_word = np.full(len(continues), nothing)
    p = of_word[share.word_of]
    for i in range(len(share.levels) - 1, -1, -1):
        of_row, count, _, history_of, sums, apart = share.levels[i]
        sums = sums.copy()
        sums[apart] = answers[1 + i]
        d = discounts(kinds[i])
        held = np.maximum(sums[:, 0], 1)
        spare = np.where(sums[:, 0] > 0, (d[1:] * sums[:, 1:]).sum(1) / held, 1.0)
        own = np.maximum(count - d[np.minimum(count, 3)], 0) / held[history_of]
        p = own[of_row] + spare[history_of][of_row] * p
    return np.log10(p), raw[share.word_of]


def _sums_of(part: int, replies: list[tuple[int, bytes]], grams: list[tuple[int, bytes]], order: int, places: int, frequent: Frequent) -> Iterator[tuple[int, bytes]]:
    """Sums over each text's tokens in one share: log10 probability, base score, known tokens."""
    share = Share([b for _, b in grams], order, frequent)
    asked = share.asked()
    answers = [np.zeros(sums.shape, np.int64) for _, sums in asked]
    vocabulary = np.zeros(6 + SUMS, np.int64)
    assert len(replies) == places, f"share {part}: totals of {len(replies)} of {places} places"
    for place, reply in replies:
        kinds, own, totals = unpack(reply)
        vocabulary += own
        for answer, (keys, _), total in zip(answers, asked, totals, strict=True):
            answer[keys % np.uint64(places) == place] = total.T
    log10p, raw = log10_probabilities(share, kinds, vocabulary, answers)
    del asked, answers
    tokens, distinct_words = int(vocabulary[4]), int(vocabulary[5])
    base = np.log10((raw + 0.5) / (tokens + 0.5 * (distinct_words + 1)))
    with SortedHashes(share.keys, log10p) as model:
        log10p = model.find(share.keys)
    at = 0
    for (uid, _), doc, n in zip(grams, share.doc, share.docs, strict=True):
        of = share.of_token[at : at + len(doc)]
        at += len(doc)
        starts = np.flatnonzero(np.diff(doc, prepend=np.int32(-1)))
        sums = [np.add.reduceat(w, starts) for w in (log10p[of], base[of], (raw[of] > 0).astype(np.uint32))]
        yield uid, pack((smallest(doc[starts], n), *sums, tokens))


def _added(bodies: list[bytes]) -> bytes:
    """Sums over the texts of one batch in several shares, added up."""
    docs, *sums, tokens = zip(*map(unpack, bodies), strict=True)
    here, of = np.unique(np.concatenate(docs), return_inverse=True)
    sums = [np.bincount(of, weights=np.concatenate(s), minlength=len(here)) for s in sums]
    return pack((here, sums[0], sums[1], sums[2].astype(np.uint32), tokens[0]))


class AddedUp:
    """What the shares of a task say of each batch of texts, as one row for each."""

    def __init__(self):
        self.held: dict[int, list[bytes]] = {}
        self.size = 0

    def add(self, uid: int, body: bytes) -> None:
        self.held.setdefault(uid, []).append(body)
        self.size += len(body)

    def rows(self) -> pa.RecordBatch:
        bodies = [b[0] if len(b) == 1 else _added(b) for b in self.held.values()]
        columns = [pa.array(self.held, pa.int64()), pa.array([0] * len(bodies), pa.int32()), pa.array(bodies, pa.binary())]
        self.held, self.size = {}, 0
        return pa.RecordBatch.from_arrays(columns, names=["uid", "kind", "body"])


def _score(order: int, places: int, frequent: Frequent):
    """Sums of the texts in all shares of a task, a share after the other: totals first, then its n-grams."""

    def run(batches):
        added, last = AddedUp(), None
        replies: list[tuple[int, bytes]] = []
        grams: list[tuple[int, bytes]] = []

        def finish():
            if grams:
                for uid, body in _sums_of(last, replies, grams, order, places, frequent):
                    added.add(uid, body)
            replies.clear()
            grams.clear()

        for batch in batches:
            described = batch.filter(pc.equal(batch.column("kind"), 1)).select(["uid", "kind", "body"])
            if described.num_rows:
                yield described
            for part, uid, kind, body in zip(*(batch.column(n).to_pylist() for n in ("part", "uid", "kind", "body")), strict=True):
                if part != last:
                    finish()
                    last = part
                    if added.size > HELD_BYTES:
                        yield added.rows()
                if kind != 1:
                    (grams if kind == 0 else replies).append((uid, body))
        finish()
        if added.held:
            yield added.rows()

    return run


RESULT = "held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _gather(table: pa.Table) -> pa.Table:
    """Rows of one batch of texts from what its shares sent."""
    meta, sums, tokens = None, None, 0
    parts = []
    for kind, body in zip(table["kind"].to_pylist(), table["body"].to_pylist(), strict=True):
        if kind == 1:
            meta = pa.ipc.open_stream(body).read_all()
        else:
            parts.append(unpack(body))
    sums = np.zeros((3, len(meta)))
    # Always in the same order, so that sums of floats repeat.
    for docs, *columns, tokens in sorted(parts, key=lambda p: (len(p[0]), p[1].tobytes())):
        for i, column in enumerate(columns):
            sums[i, docs] += column
    return pa.table(
        {
            "id": meta["id"],
            "held_out": meta["held_out"],
            "n_tokens": meta["n_tokens"],
            "n_known": pa.array(sums[2].astype(np.int64)),
            "train_tokens": pa.array(np.full(len(meta), tokens, np.int64)),
            "base_score": pa.array(sums[1]),
            "score": pa.array(sums[0]),
        }
    )


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, share_bytes: int = SHARE_BYTES) -> DataFrame:
    """(id_col, and the columns of ``RESULT``) for every row.

    Rows where ``train`` holds teach the model; NULL there is false. Tokens are words with A-Z
    lower-cased, then one end; NULL text is the empty text, which is the end alone. ``score``
    is the log10 probability of all tokens, ``base_score`` that of a smoothed unigram count.
    Without training rows every token is equally unlikely. Repeated rows are texts of their
    own. No rows give no rows. ``order`` is two or more.
    """
    text = whole(quoted(text_col))
    size = docs.agg(F.sum(F.octet_length(text)).alias("n"), F.count("*").alias("rows")).first()
    held = size["n"] or 0
    shares = max(1, math.ceil(held * order / (2 * share_bytes)))
    id_field = StructField("id", docs.schema[id_col].dataType)
    source = docs.select(quoted(id_col).alias("id"), text.alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    frequent = frequent_words(source.select("text"), held, size["rows"], shares)
    dealt = source.mapInArrow(_deal(order, shares, frequent), "part int, uid bigint, kind int, body binary")
    places = math.ceil(shares / SHARES_A_PLACE)
    tasks = min(shares, TASKS + shares // SHARES_A_TASK)
    dealt = dealt.repartition(tasks, "part")
    asked = dealt.sortWithinPartitions("part", "uid").mapInArrow(_partial_sums(order, places, frequent), "place int, part int, body binary")
    told = asked.repartition(min(places, tasks), "place").groupBy("place").applyInArrow(_totals, "part int, place int, body binary")
    told = told.selectExpr("part", "cast(place as bigint) uid", "2 kind", "body").repartition(tasks, "part")
    # The numbers bring the rows of a share together, its totals first; a task goes through all of its shares.
    first = Window.partitionBy("part").orderBy(F.desc("kind"), "uid")
    together = dealt.unionByName(told).withColumn("number", F.row_number().over(first))
    scored = together.mapInArrow(_score(order, places, frequent), "uid bigint, kind int, body binary")
    gathered = scored.groupBy("uid").applyInArrow(_gather, StructType([id_field, *StructType.fromDDL(RESULT).fields]))
    return gathered.withColumnRenamed("id", id_col)
